"""Registered queries of the preparation operators and their SQL.

Each query runs over whole tables. The SQL is written from the rules, not from
the plans, and serves as their oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taskmill.functions import accessors, answers, render
from taskmill.functions import text as tx
from taskmill.operators import adapters, ordering, prepare, subjects
from taskmill.runtime import shared_dir, stored, table
from taskmill.sources import config, lines, sinks

WS = tx.WS
_STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{WS}+|{WS}+\z', '', 'g')"


def _clean(c: str) -> str:
    return f"coalesce({_strip(c)}, '')"


def _blank_null(c: str) -> str:
    return f"nullif({_strip(c)}, '')"


def _tidy(c: str) -> str:
    return f"list_transform(coalesce({c}, []), lambda x: {_clean('x')})"


def _clean_list(c: str) -> str:
    return f"list_filter({_tidy(c)}, lambda y: y <> '')"


# Subject inference


def token_index(spark: SparkSession, d: str) -> DataFrame:
    return subjects.token_index(table(spark, d, "documents"), "source", "text")


def subject_infer(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return subjects.infer_subject(docs, "doc_id", "text", stored(subjects.token_index(docs, "source", "text")))


def index_cache(spark: SparkSession, d: str) -> DataFrame:
    """The token index built into a cache, then read from it, and summed up."""
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}.parquet"
    docs = table(spark, d, "documents")
    for _ in range(2):
        index = subjects.cached_index(spark, path, lambda: subjects.token_index(docs, "source", "text"))
    return index.groupBy("config").agg(F.sum("n").alias("total"), F.count("*").alias("tokens"), F.max_by("token", F.struct("n", "token")).alias("top_token"))


_TOKENS = rf"""
WITH tok AS (
  SELECT doc_id, source AS config, token FROM (
    SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9_+-]{{2,}}')) AS token FROM documents)
  WHERE token NOT IN ({_STOP})),
idx AS (SELECT config, token, count(*) AS n FROM tok GROUP BY ALL)
"""

# Text rules


def text_clean(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items")
    choices = tx.clean_list(F.col("choices"))
    named = F.lower(tx.clean(F.col("question_type")))
    return t.select(
        "task_key", tx.clean(F.col("question_text")).alias("question_text"), choices.alias("choices"), tx.tidy_list(F.col("choices")).alias("kept_choices"),
        tx.domain_name(F.col("domain"), F.lit("unknown")).alias("domain"), tx.subject_name(F.col("domain")).alias("subject"),
        F.when(named != "", named).when(F.size(choices) > 0, "multiple_choice").otherwise("open_qa").alias("question_type"),
    )


def stable_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "task_items").select("task_key", tx.stable_id("task", F.col("question_text"), F.col("reference_answer")).alias("stable_id"))


def order_key(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items")
    return t.select("task_key", tx.order_key(F.col("data_split"), F.col("domain"), F.col("question_id")).alias("order_key"))


def alias_build(spark: SparkSession, d: str) -> DataFrame:
    a = tx.trivia_answer(F.col("answer"))
    return table(spark, d, "trivia_rows").select("question_id", "data_split", a["value"].alias("value"), a["aliases"].alias("aliases"))


# Answers


def _raw_answers(spark: SparkSession, d: str) -> DataFrame:
    """The original answer of pool records with its JSON kind."""
    p = table(spark, d, "question_pool").withColumn("choices", tx.tidy_list(F.col("choices")))
    v = F.variant_get(F.try_parse_json("meta"), "$.original_answer", "variant")
    return p.withColumn("raw", F.try_variant_get(v, "$", "string")).withColumn("kind", lines._kind(v))


def answer_index(spark: SparkSession, d: str) -> DataFrame:
    p = _raw_answers(spark, d).withColumn("i", answers.adapter_index(F.col("raw"), F.col("choices"), F.col("kind")))
    return p.select(
        "pool_key", F.col("i").alias("answer_index"), answers.canonical_answer(F.col("raw"), F.col("i"), F.col("choices")).alias("answer"), answers.answer_label(F.col("i")).alias("label")
    )


def answer_index_reader(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items").withColumn("c", tx.clean_list(F.col("choices")))
    kind = F.when(F.col("reference_answer_index").isNotNull(), "number").otherwise("null")
    i = answers.schema_index(tx.clean(F.col("reference_answer")), F.col("reference_answer_index").cast("string"), F.col("c"), kind)
    return t.select("task_key", i.alias("answer_index"))


def sampled_answer(spark: SparkSession, d: str) -> DataFrame:
    p = _raw_answers(spark, d)
    return p.select("pool_key", answers.sampled_answer(F.col("raw"), F.col("choices"), F.coalesce("kind", F.lit("null"))).alias("answer"))


def option_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", answers.option_label(F.col("p_partkey") - 1).alias("label"))


# Rendering


def question_render(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "question_pool").withColumn("c", tx.tidy_list(F.col("choices")))
    subject, question = tx.clean(F.col("subject")), tx.clean(F.col("question"))
    kind = F.when(F.size("c") > 0, "multiple_choice").otherwise("open_qa")
    return p.select(
        "pool_key", render.adapter_prompt(subject, question, F.col("c")).alias("adapter_prompt"), render.task_prompt(subject, kind, question, F.col("c")).alias("task_prompt"),
        render.sample_prompt(F.col("question"), F.col("choices")).alias("sample_prompt"),
    )


# Reading and writing


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "task_lines").select("line_id", F.col("raw_json").alias("line"))


def task_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.tasks_from_lines(_lines(spark, d))
    ok = lines.accepted(rows)
    return ok.drop("line", "metadata")


def task_scan_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.tasks_from_lines(_lines(spark, d)).filter("error IS NOT NULL")
    return rows.groupBy("error").agg(F.count("*").alias("rows"))


def legacy_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The benchmark name, the number of members and each member's text of the metadata."""
    rows = lines.accepted(lines.tasks_from_lines(_lines(spark, d)))
    return rows.select("line_id", F.get_json_object("metadata", "$.benchmark_name").alias("benchmark_name"), F.array_sort(F.json_object_keys("metadata")).alias("members"))


def object_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sample lines: objects only, blank lines skipped; none at all is an error."""
    rows = lines.accepted(lines.samples_from_lines(_lines(spark, d)))
    return lines.not_empty(rows, "task_lines").select("line_id", F.size(F.json_object_keys("record")).alias("members"))


def dataset_scan(spark: SparkSession, d: str) -> DataFrame:
    """A local copy of a dataset, its validation split found under the other name."""
    root = f"{shared_dir(spark)}/copy-{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    orders.orderBy("o_orderkey").write.parquet(f"{root}/depot/orders/main/val.parquet")
    source = config.Source("orders", "huggingface", "own", "orders_tasks.jsonl", repo_id="depot/orders", config_name="main")
    return prepare.read_split(spark, root, source, "validation", "o_orderkey bigint, o_orderpriority string, missing string")


def task_accessors(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.accepted(lines.tasks_from_lines(_lines(spark, d)))
    return rows.select("line_id", *accessors.task_accessors())


def pool_label(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "question_pool").select("pool_key", accessors.answer_label(F.col("meta")).alias("answer_label"))


def _two_sources(spark: SparkSession, d: str, limit: int | None) -> DataFrame:
    """Suppliers, then customers as tasks, written as files and prepared as a merged set."""
    root = f"{shared_dir(spark)}/prepared-{uuid.uuid4().hex}"
    tables = {"supplier": ("s_suppkey", "s_name"), "customer": ("c_custkey", "c_name")}

    def build(source: config.Source) -> DataFrame:
        key, name = tables[source.name]
        t = table(spark, d, source.name)
        none = F.array().cast("array<string>")
        return t.select(
            F.lit(0).alias("part"), F.col(key).cast("bigint").alias("position"), F.concat(F.lit(f"{source.name}::dev::"), F.col(key)).alias("question_id"), F.lit("dev").alias("data_split"),
            F.lit("names").alias("domain"), F.lit("open_qa").alias("question_type"), F.col(name).alias("question_text"), none.alias("choices"), F.col(key).cast("string").alias("reference_answer"),
            F.lit(None).cast("int").alias("reference_answer_index"), none.alias("reference_aliases"), F.lit("{}").alias("metadata"),
        )

    sources = tuple(config.Source(n, "local_jsonl", "own", f"{n}_tasks.jsonl") for n in tables)
    prepare.prepare(spark, config.DatasetConfig("names", root, "tasks.jsonl", sources), build, limit=limit)
    return prepare.read_tasks(spark, f"{root}/tasks.jsonl").select("position", "question_id", "question_text", "reference_answer")


def prepare_all(spark: SparkSession, d: str) -> DataFrame:
    return _two_sources(spark, d, None)


def prepare_limit(spark: SparkSession, d: str) -> DataFrame:
    return _two_sources(spark, d, 150)


def sample_records(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw_answers(spark, d).select("pool_key", "question", "choices", F.col("raw").alias("answer"), F.coalesce("kind", F.lit("null")).alias("kind"))
    return prepare.sample_records(rows, ["pool_key"], 100, 300, "all", F.col("kind"))


def pool_scan(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "question_pool")
    names = ["source_dataset", "source_split", "subject", "question", "choices", "answer", "answer_index", "prompt_text"]
    plain = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    line = F.concat(F.regexp_replace(plain, r"\}\z", ""), F.lit(',"meta":'), F.coalesce("meta", F.lit("null")), F.lit("}"))
    rows = lines.accepted(lines.pool_from_lines(p.select("pool_key", line.alias("line"))))
    return rows.drop("line", "meta")


def task_sink(spark: SparkSession, d: str) -> DataFrame:
    """Tasks written as files of JSON lines, read back and validated; good rows."""
    t = table(spark, d, "task_items").filter("question_text IS NOT NULL").withColumn("choices", F.coalesce("choices", F.array().cast("array<string>")))
    t = t.withColumn("reference_aliases", F.coalesce("reference_aliases", F.array().cast("array<string>")))
    path = f"{shared_dir(spark)}/tasks-{uuid.uuid4().hex}.jsonl"
    sinks.write_tasks(t.withColumn("metadata", F.to_json(F.struct("task_key"))), path)
    rows = lines.accepted(lines.tasks_from_lines(lines.read_numbered(spark, path)))
    return rows.select(F.get_json_object("metadata", "$.task_key").cast("bigint").alias("task_key"), "question_text", "choices", "reference_answer", "reference_answer_index")


def enabled_sources(spark: SparkSession, d: str) -> DataFrame:
    return config.enabled_sources(table(spark, d, "dataset_sources"))


def config_listing(spark: SparkSession, d: str) -> DataFrame:
    return config.subject_configs(table(spark, d, "question_pool"), "subject")


# Adapters


def _config_of(c: str):
    return F.replace(F.lower(tx.non_blank(F.col(c))), F.lit(" "), F.lit("_"))


def _meta(*paths: str) -> list[Column]:
    return [F.get_json_object("metadata", f"$.{p}").alias(f"meta_{p.rsplit('.', 1)[-1]}") for p in paths]


def _adapter_columns(tasks: DataFrame, *more: str) -> DataFrame:
    return tasks.select(
        "question_id", "data_split", "domain", "question_text", "choices", "reference_answer", "reference_answer_index", "reference_aliases",
        *_meta("benchmark_name", "source_dataset", "source_split", *more),
    )


def adapter_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "question_pool").withColumn("config", _config_of("subject")).filter("config IS NOT NULL")
    p = p.withColumn("split", adapters.split_name(F.col("source_split")))
    index = stored(adapters.config_index(p, "config", "split"))
    rows = adapters.of_split(table(spark, d, "task_items").withColumn("split", F.col("data_split")), "auxiliary_train")
    rows = rows.select("task_key", F.col("question_text").alias("question"), "choices", F.col("reference_answer").alias("answer"))
    tasks = adapters.build("mmlu_auxiliary_train", rows, index, "bench", "depot/bench", "auxiliary_train", ["task_key"])
    return _adapter_columns(tasks, "source_meta.source_subset", "source_meta.subject_source", "source_meta.subject_inference_score", "source_meta.source_subject_config", "source_meta.original_answer", "source_meta.answer_label")


def adapter_cais(spark: SparkSession, d: str) -> DataFrame:
    """The whole adapter: auxiliary_train, dev and validation in all their spellings."""
    p = table(spark, d, "question_pool").withColumn("config", _config_of("subject"))
    rows = p.select("pool_key", F.col("source_split").alias("split"), "config", "subject", "question", "choices", "answer")
    tasks = adapters.build("mmlu_cais", rows, "bench", "depot/bench", None, ["pool_key"])
    return _adapter_columns(tasks, "source_meta.source_subset", "source_meta.subject_source", "source_meta.subject_inference_score", "source_meta.source_subject_config", "source_meta.original_answer", "source_meta.answer_label")


def adapter_trivia(spark: SparkSession, d: str) -> DataFrame:
    """The whole adapter, rows with a fallback id included. Rows are ordered by all that
    tells them apart and a running number of those that nothing does."""
    a, none = F.col("answer"), F.lit("")
    key = F.concat_ws("\x1f", F.coalesce("question_id", none), F.coalesce("question", none), F.coalesce(a["value"], none),
                      F.array_join(F.coalesce(a["aliases"], F.array().cast("array<string>")), "|"), F.array_join(F.coalesce(a["normalized_aliases"], F.array().cast("array<string>")), "|"))
    t = table(spark, d, "trivia_rows").withColumn("key", key)
    copies = t.groupBy("key", "question_id", "question", "answer", F.col("data_split").alias("split")).agg(F.count("*").alias("n"))
    rows = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).drop("n")
    # Rows that differ only by null and empty parts share a key; their hash parts them.
    rows = rows.withColumn("form", F.xxhash64(F.to_json(F.struct("question_id", "question", "answer", "split"))))
    tasks = adapters.build("trivia_qa_rc", rows, "trivia", "depot/trivia", None, ["key", "form", "copy"])
    return tasks.select("question_id", "data_split", "question_text", "reference_answer", "reference_aliases", *_meta("benchmark_name", "source_dataset", "source_split"))


def adapter_pool(spark: SparkSession, d: str) -> DataFrame:
    tasks = adapters.build("question_pool_mcq", table(spark, d, "question_pool"), "pool", ["pool_key"])
    return _adapter_columns(tasks, "prompt_text", "source_meta.original_answer", "source_meta.answer_label", "source_meta.subject_source")


# Order, union, limits


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    out = ordering.interleaved(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"])
    return out.select("doc_id", "source", "position", F.concat(F.col("source"), F.lit("::"), F.col("position")).alias("positional_id"))


def round_robin_limit(spark: SparkSession, d: str) -> DataFrame:
    return ordering.interleaved(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"], 100).select("doc_id", "position")


def union_limit(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return prepare.merged([s, c], ["key"], 1000).select("source_pos", "key", "name")


def union_lazy(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return prepare.merged_lazily([lambda: c, lambda: s], ["key"], 100).select("source_pos", "key", "name")


def union_all(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return prepare.merged([c, s], ["key"]).select("source_pos", "key", "name")


def source_count(spark: SparkSession, d: str) -> DataFrame:
    return prepare.source_counts(table(spark, d, "documents"), "source")


def anti_append(spark: SparkSession, d: str) -> DataFrame:
    samples = table(spark, d, "task_items").select(F.col("task_key").alias("sample_id"), "question_id")
    written = table(spark, d, "parsed_responses").select(F.col("task_key").alias("sample_id"))
    return sinks.append_new(samples, written, "sample_id")


def slice_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return prepare.samples(rows, ["o_orderkey"], 500, 1000).select("sample_id", "o_orderkey", "o_custkey")


QUERIES = {
    f.__name__: f
    for f in (
        token_index, subject_infer, index_cache, text_clean, stable_id, order_key, alias_build, answer_index, answer_index_reader, sampled_answer, option_label,
        question_render, task_scan, task_scan_errors, legacy_metadata, pool_scan, task_sink, enabled_sources, config_listing, adapter_unlabelled,
        adapter_trivia, adapter_cais, adapter_pool, object_lines, dataset_scan, task_accessors, pool_label, prepare_all, prepare_limit, sample_records, round_robin, round_robin_limit, union_limit, union_lazy, union_all, source_count, anti_append, slice_rows,
    )
}


def _index_sql(raw: str, choices: str) -> str:
    return f"""CASE WHEN {raw} IS NULL OR {raw} = '' THEN NULL
      WHEN regexp_full_match({raw}, '[0-9]+') THEN CAST({raw} AS BIGINT)
      WHEN regexp_full_match(upper({raw}), '[A-Z]') THEN ascii(upper({raw})) - 65
      WHEN list_contains({choices}, {raw}) THEN list_position({choices}, {raw}) - 1 END"""


def _label_sql(i: str) -> str:
    """Bijective base 26 by number of letters."""
    return f"""CASE WHEN {i} < 0 THEN NULL WHEN {i} < 26 THEN chr(CAST(65 + {i} AS INT))
      WHEN {i} < 702 THEN chr(CAST(65 + ({i} - 26) // 26 AS INT)) || chr(CAST(65 + {i} % 26 AS INT))
      WHEN {i} < 18278 THEN chr(CAST(65 + ({i} - 702) // 676 AS INT)) || chr(CAST(65 + (({i} - 26) // 26) % 26 AS INT)) || chr(CAST(65 + {i} % 26 AS INT))
      ELSE chr(CAST(65 + ({i} - 18278) // 17576 AS INT)) || chr(CAST(65 + (({i} - 702) // 676) % 26 AS INT)) || chr(CAST(65 + (({i} - 26) // 26) % 26 AS INT)) || chr(CAST(65 + {i} % 26 AS INT)) END"""


_OPTION_LINES = "array_to_string(list_transform(range(len(c)), lambda i: (CASE WHEN i < 26 THEN chr(CAST(65 + i AS INT)) ELSE 'Option ' || (i + 1) END) || '. ' || c[i + 1]), chr(10))"
_RAW = rf"""
WITH p AS (
  SELECT pool_key, {_tidy('choices')} AS c, json_extract_string(meta, '$.original_answer') AS raw, json_type(meta, '$.original_answer') AS k FROM question_pool),
q AS (SELECT *, {_clean('raw')} AS r FROM p),
a AS (SELECT *, CASE WHEN k IN ('BIGINT', 'UBIGINT') THEN CAST(raw AS BIGINT) WHEN k = 'VARCHAR' THEN {_index_sql('r', 'c')} END AS i FROM q)
"""


def _member(*names: str) -> str:
    out = f"json_extract(raw_json, '$.{names[-1]}')"
    for n in reversed(names[:-1]):
        out = f"CASE WHEN list_contains(json_keys(raw_json), '{n}') THEN json_extract(raw_json, '$.{n}') ELSE {out} END"
    return f"({out})"


def _value(m: str) -> str:
    return f"CASE WHEN json_type({m}) = 'NULL' THEN NULL ELSE {m} ->> '$' END"


_SCAN = rf"""
WITH l AS (
  SELECT line_id, raw_json FROM (SELECT line_id, CASE WHEN json_valid(raw_json) THEN raw_json END AS raw_json FROM task_lines)
  WHERE raw_json IS NOT NULL AND json_type(raw_json) = 'OBJECT'),
m AS (SELECT line_id, raw_json,
  {_clean(_value(_member('question_text', 'question')))} AS question_text,
  {_clean(_value(_member('reference_answer', 'answer', 'gold_answer')))} AS reference_answer,
  {_clean_list("CAST(json_extract(raw_json, '$.choices') AS VARCHAR[])")} AS choices,
  {_clean_list(f"CAST({_member('reference_aliases', 'answer_aliases', 'gold_aliases')} AS VARCHAR[])")} AS reference_aliases,
  lower({_clean(_value("json_extract(raw_json, '$.question_type')"))}) AS qt,
  {_member('reference_answer_index', 'answer_index', 'gold_answer_index')} AS ij,
  coalesce({_blank_null(_value(_member('data_split', 'split')))}, 'train') AS data_split,
  coalesce({_blank_null(_value("json_extract(raw_json, '$.domain')"))}, 'unknown') AS domain,
  coalesce({_blank_null("raw_json ->> '$.question_id'")}, {_blank_null("raw_json ->> '$.seed_id'")}, {_blank_null("raw_json ->> '$.id'")}) AS given
  FROM l),
x AS (SELECT *, upper({_strip("ij ->> '$'")}) AS it FROM m),
y AS (SELECT line_id, raw_json, question_text, reference_answer, choices, reference_aliases, data_split, domain,
  coalesce(given, 'task::' || substr(sha256(concat_ws('||', nullif(question_text, ''), nullif(reference_answer, ''))), 1, 16)) AS question_id,
  CASE WHEN qt <> '' THEN qt WHEN len(choices) > 0 THEN 'multiple_choice' ELSE 'open_qa' END AS question_type,
  CASE WHEN len(choices) = 0 THEN NULL
    WHEN json_type(ij) IN ('BIGINT', 'UBIGINT') THEN CAST(it AS BIGINT)
    WHEN json_type(ij) = 'VARCHAR' AND regexp_full_match(it, '[A-Z]') THEN ascii(it) - 65
    WHEN json_type(ij) = 'VARCHAR' AND regexp_full_match(it, '[0-9]+') THEN CAST(it AS BIGINT)
    WHEN list_contains(choices, reference_answer) THEN list_position(choices, reference_answer) - 1 END AS reference_answer_index FROM x),
ok AS (SELECT * FROM y WHERE question_text <> '' AND reference_answer <> '' AND question_type IN ('multiple_choice', 'open_qa')
  AND coalesce(raw_json ->> '$.contract', 'task_v1') IN ('task_v1', 'task_item_v1', 'seed_input_v1', 'world_question_v1')
  AND (question_type <> 'multiple_choice' OR (len(choices) > 0 AND reference_answer_index >= 0 AND reference_answer_index < len(choices))))
"""

def _tasks_sql(rows: str, more: str) -> str:
    return rf"""
      SELECT question_id, data_split, domain, question_text, c AS choices, a AS reference_answer, i AS reference_answer_index,
        CASE WHEN a <> '' THEN [a] ELSE [] END AS reference_aliases, {more}
      FROM (SELECT *, {_strip("CASE WHEN i >= 0 AND i < len(c) THEN c[i + 1] ELSE r END")} AS a FROM (SELECT *, {_index_sql('r', 'c')} AS i FROM {rows}))"""



def _split(c: str) -> str:
    return f"CASE WHEN lower({_strip(c)}) = 'val' THEN 'validation' ELSE lower({_strip(c)}) END"


_SAMPLED = rf"""SELECT pool_key, CASE WHEN k IN ('BIGINT', 'UBIGINT') THEN CASE WHEN CAST(raw AS BIGINT) BETWEEN 0 AND len(c) - 1 THEN {_label_sql('CAST(raw AS BIGINT)')} ELSE r END
        WHEN k <> 'VARCHAR' THEN r
        WHEN regexp_full_match(upper(r), '[A-Z]') AND ascii(upper(r)) - 65 < len(c) THEN upper(r)
        WHEN regexp_full_match(r, '[0-9]+') AND CAST(r AS BIGINT) < len(c) THEN {_label_sql('CAST(r AS BIGINT)')}
        WHEN list_contains(c, r) THEN {_label_sql('(list_position(c, r) - 1)')} ELSE r END AS answer FROM q"""
_CONFIG = f"replace(lower({_blank_null('subject')}), ' ', '_')"
_POOL_TEXT = f"{_clean('question')} || ' ' || array_to_string({_tidy('choices')}, ' ')"
#: Rows without subjects, by inferred subject and in round-robin order, as tasks.
_INFERRED = rf"""
      WITH p AS (@LABELLED@),
      idx AS (SELECT config, token, count(*) AS n FROM (SELECT config, unnest(regexp_extract_all(lower(t), '[a-z][a-z0-9_+-]{{2,}}')) AS token FROM p WHERE config IS NOT NULL) WHERE token NOT IN ({_STOP}) GROUP BY ALL),
      q AS (@ROWS@),
      tok AS (SELECT DISTINCT id, unnest(regexp_extract_all(lower(question_text || ' ' || array_to_string(c, ' ')), '[a-z][a-z0-9_+-]{{2,}}')) AS token FROM q),
      s AS (SELECT id, config, sum(n) AS score FROM tok JOIN idx USING (token) GROUP BY ALL),
      b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, config) = 1),
      g AS (SELECT q.*, config, score, coalesce(CASE WHEN config IS NOT NULL THEN coalesce(nullif({_strip("replace(config, '_', ' ')")}, ''), 'bench') END, 'general knowledge') AS domain, coalesce(config, 'general knowledge') AS grp FROM q LEFT JOIN b USING (id)),
      o AS (SELECT *, row_number() OVER (ORDER BY rn, grp) - 1 AS pos FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id) AS rn FROM g)),
      oi AS (SELECT *, {_index_sql('r', 'c')} AS i FROM o),
      oa AS (SELECT *, {_strip("CASE WHEN i >= 0 AND i < len(c) THEN c[i + 1] ELSE r END")} AS a FROM oi),
      built AS (SELECT 'bench::auxiliary_train::' || pos AS question_id, 'auxiliary_train' AS data_split, domain, question_text, c AS choices, a AS reference_answer, i AS reference_answer_index,
        CASE WHEN a <> '' THEN [a] ELSE [] END AS reference_aliases, 'bench' AS meta_benchmark_name, 'depot/bench' AS meta_source_dataset, 'auxiliary_train' AS meta_source_split, 'all' AS meta_source_subset,
        CASE WHEN config IS NULL THEN 'fallback_default' ELSE 'inferred_from_labeled_splits' END AS meta_subject_source, CAST(CAST(coalesce(score, 0) AS BIGINT) AS VARCHAR) AS meta_subject_inference_score,
        config AS meta_source_subject_config, raw AS meta_original_answer, CASE WHEN i >= 0 AND i < 26 THEN chr(CAST(65 + i AS INT)) END AS meta_answer_label FROM oa)
      """


def _inferred(labelled: str, rows: str) -> str:
    return _INFERRED.replace("@LABELLED@", labelled).replace("@ROWS@", rows)


_PREPARED = """
      SELECT position, question_id, question_text, reference_answer FROM (
        SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS position, 'supplier::dev::' || s_suppkey AS question_id, s_name AS question_text, CAST(s_suppkey AS VARCHAR) AS reference_answer FROM supplier
        UNION ALL SELECT (SELECT count(*) FROM supplier) + row_number() OVER (ORDER BY c_custkey) - 1, 'customer::dev::' || c_custkey, c_name, CAST(c_custkey AS VARCHAR) FROM customer)"""


SQL = {
    "token_index": _TOKENS + "SELECT config, token, n FROM idx",
    "subject_infer": _TOKENS
    + """, s AS (SELECT doc_id, idx.config, sum(n) AS score FROM (SELECT DISTINCT doc_id, token FROM tok) t JOIN idx USING (token) GROUP BY ALL),
      b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, config) = 1)
      SELECT d.doc_id, config, coalesce(trim(replace(config, '_', ' ')), 'general knowledge') AS subject, CAST(coalesce(score, 0) AS BIGINT) AS score
      FROM documents d LEFT JOIN b USING (doc_id)""",
    "index_cache": _TOKENS + "SELECT config, CAST(sum(n) AS BIGINT) AS total, count(*) AS tokens, arg_max(token, (n, token)) AS top_token FROM idx GROUP BY config",
    "text_clean": rf"""
      SELECT task_key, {_clean('question_text')} AS question_text, {_clean_list('choices')} AS choices, {_tidy('choices')} AS kept_choices,
        coalesce(replace({_blank_null('domain')}, '_', ' '), 'unknown') AS domain, {_clean("replace(domain, '_', ' ')")} AS subject,
        CASE WHEN {_clean('question_type')} <> '' THEN lower({_clean('question_type')}) WHEN len({_clean_list('choices')}) > 0 THEN 'multiple_choice' ELSE 'open_qa' END AS question_type
      FROM task_items""",
    "stable_id": rf"""SELECT task_key, 'task::' || substr(sha256(concat_ws('||', {_blank_null('question_text')}, {_blank_null('reference_answer')})), 1, 16) AS stable_id FROM task_items""",
    "order_key": rf"""SELECT task_key, concat_ws('::', {_blank_null('data_split')}, {_blank_null('domain')}, {_blank_null('question_id')}) AS order_key FROM task_items""",
    "alias_build": rf"""
      SELECT question_id, data_split, v AS value, CASE WHEN answer IS NULL THEN [] WHEN v <> '' AND NOT list_contains(l, v) THEN list_prepend(v, l) ELSE l END AS aliases
      FROM (SELECT *, {_clean('answer.value')} AS v, list_concat({_clean_list('answer.aliases')}, {_clean_list('answer.normalized_aliases')}) AS l FROM trivia_rows)""",
    "answer_index": _RAW + "SELECT pool_key, i AS answer_index, CASE WHEN i >= 0 AND i < len(c) THEN c[i + 1] ELSE r END AS answer, CASE WHEN i >= 0 AND i < 26 THEN chr(CAST(65 + i AS INT)) END AS label FROM a",
    "answer_index_reader": rf"""
      SELECT task_key, CASE WHEN len(c) = 0 THEN NULL WHEN reference_answer_index IS NOT NULL THEN reference_answer_index
        WHEN list_contains(c, r) THEN list_position(c, r) - 1 END AS answer_index
      FROM (SELECT *, {_clean_list('choices')} AS c, {_clean('reference_answer')} AS r FROM task_items)""",
    "sampled_answer": _RAW + _SAMPLED,
    "option_label": f"SELECT p_partkey, {_label_sql('(p_partkey - 1)')} AS label FROM part",
    "question_render": rf"""
      SELECT pool_key, CASE WHEN len(c) > 0 THEN {_strip(f"'Subject: ' || s || chr(10) || chr(10) || 'Question:' || chr(10) || q || chr(10) || chr(10) || 'Options:' || chr(10) || {_OPTION_LINES}")} ELSE q END AS adapter_prompt,
        {_strip(f"'Domain: ' || s || chr(10) || 'Question Type: ' || CASE WHEN len(c) > 0 THEN 'multiple_choice' ELSE 'open_qa' END || chr(10) || chr(10) || 'Question:' || chr(10) || q || CASE WHEN len(c) > 0 THEN chr(10) || chr(10) || 'Options:' || chr(10) || {_OPTION_LINES} ELSE '' END")} AS task_prompt,
        'Question: ' || {_strip('question')} || CASE WHEN len(c) > 0 THEN chr(10) || {_OPTION_LINES} ELSE '' END AS sample_prompt
      FROM (SELECT *, {_tidy('choices')} AS c, {_clean('subject')} AS s, {_clean('question')} AS q FROM question_pool)""",
    "task_scan": _SCAN + "SELECT line_id, question_id, data_split, domain, question_type, question_text, choices, reference_answer, reference_answer_index, reference_aliases FROM ok",
    "task_scan_errors": _SCAN
    + rf""", e AS (
      SELECT CASE WHEN coalesce(raw_json ->> '$.contract', 'task_v1') NOT IN ('task_v1', 'task_item_v1', 'seed_input_v1', 'world_question_v1') THEN 'unsupported contract'
        WHEN question_text = '' THEN 'no question_text' WHEN reference_answer = '' THEN 'no reference_answer' WHEN question_type NOT IN ('multiple_choice', 'open_qa') THEN 'unsupported question_type'
        WHEN question_type = 'multiple_choice' AND len(choices) = 0 THEN 'multiple_choice without choices'
        WHEN question_type = 'multiple_choice' AND (reference_answer_index IS NULL OR reference_answer_index < 0 OR reference_answer_index >= len(choices)) THEN 'multiple_choice without a valid index' END AS error FROM y
      UNION ALL SELECT CASE WHEN json_valid(raw_json) THEN 'not an object' ELSE 'not JSON' END FROM task_lines
        WHERE {_clean('raw_json')} <> '' AND line_id NOT IN (SELECT line_id FROM l))
      SELECT error, count(*) AS rows FROM e WHERE error IS NOT NULL GROUP BY error""",
    "legacy_metadata": _SCAN
    + rf"""SELECT line_id, CASE WHEN raw_json ->> '$.contract' = 'world_question_v1' THEN coalesce({_blank_null("raw_json ->> '$.benchmark_name'")}, raw_json ->> '$.metadata.benchmark_name') ELSE raw_json ->> '$.metadata.benchmark_name' END AS benchmark_name,
      list_sort(list_distinct(list_concat(coalesce(json_keys(raw_json, '$.metadata'), []), CASE WHEN raw_json ->> '$.contract' = 'world_question_v1' THEN ['benchmark_name'] ELSE [] END))) AS members FROM ok""",
    "pool_scan": """
      SELECT pool_key, source_dataset, source_split, subject, question, choices, answer, answer_index, prompt_text FROM question_pool
      WHERE source_dataset IS NOT NULL AND source_split IS NOT NULL AND subject IS NOT NULL AND question IS NOT NULL AND answer IS NOT NULL AND prompt_text IS NOT NULL
        AND choices IS NOT NULL AND meta IS NOT NULL AND json_type(meta) = 'OBJECT'""",
    "task_sink": rf"""
      SELECT task_key, q AS question_text, c AS choices, a AS reference_answer, i AS reference_answer_index FROM (
        SELECT *, CASE WHEN t <> '' THEN t WHEN len(c) > 0 THEN 'multiple_choice' ELSE 'open_qa' END AS k,
          CASE WHEN len(c) = 0 THEN NULL WHEN reference_answer_index IS NOT NULL THEN reference_answer_index WHEN list_contains(c, a) THEN list_position(c, a) - 1 END AS i
        FROM (SELECT task_key, reference_answer_index, {_clean('question_text')} AS q, {_clean_list('choices')} AS c, {_clean('reference_answer')} AS a, lower({_clean('question_type')}) AS t FROM task_items))
      WHERE q <> '' AND a <> '' AND k IN ('multiple_choice', 'open_qa') AND (k = 'open_qa' OR (len(c) > 0 AND i >= 0 AND i < len(c)))""",
    "enabled_sources": """
      SELECT source_pos, source_name, provider, adapter, CASE WHEN provider = 'local_jsonl' THEN local_path ELSE repo_id END AS location,
        source_name || '_tasks.jsonl' AS output_file, coalesce(merge_into_world, true) AS merge_into_world FROM dataset_sources WHERE coalesce(enabled, true)""",
    "config_listing": "SELECT DISTINCT subject AS config FROM question_pool WHERE subject IS NOT NULL AND subject NOT IN ('all', 'auxiliary_train')",
    "adapter_unlabelled": _inferred(
        labelled=f"SELECT {_CONFIG} AS config, {_POOL_TEXT} AS t FROM question_pool WHERE {_split('source_split')} IN ('dev', 'validation')",
        rows=f"SELECT task_key AS id, {_clean('question_text')} AS question_text, {_tidy('choices')} AS c, reference_answer AS raw, {_clean('reference_answer')} AS r FROM task_items WHERE {_split('data_split')} = 'auxiliary_train'",
    ) + "SELECT * FROM built",
    "adapter_cais": _inferred(
        labelled=f"SELECT {_CONFIG} AS config, {_POOL_TEXT} AS t FROM question_pool WHERE {_split('source_split')} IN ('dev', 'validation')",
        rows=f"SELECT pool_key AS id, {_clean('question')} AS question_text, {_tidy('choices')} AS c, answer AS raw, {_clean('answer')} AS r FROM question_pool WHERE {_split('source_split')} = 'auxiliary_train'",
    ) + rf""", l AS (
        SELECT pool_key AS id, {_split('source_split')} AS s, {_CONFIG} AS config, {_blank_null("replace(subject, '_', ' ')")} AS sub, {_clean('question')} AS question_text, {_tidy('choices')} AS c, answer AS raw, {_clean('answer')} AS r
        FROM question_pool WHERE {_split('source_split')} IN ('dev', 'validation') AND {_CONFIG} IS NOT NULL),
      lo AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY rn, config) - 1 AS pos FROM (SELECT *, row_number() OVER (PARTITION BY s, config ORDER BY id) AS rn FROM l)),
      li AS (SELECT *, {_index_sql('r', 'c')} AS i FROM lo),
      la AS (SELECT *, {_strip("CASE WHEN i >= 0 AND i < len(c) THEN c[i + 1] ELSE r END")} AS a FROM li)
      SELECT * FROM built UNION ALL BY NAME
      SELECT 'bench::' || s || '::' || pos AS question_id, s AS data_split, coalesce(sub, nullif({_strip("replace(config, '_', ' ')")}, ''), 'bench') AS domain, question_text, c AS choices, a AS reference_answer, i AS reference_answer_index,
        CASE WHEN a <> '' THEN [a] ELSE [] END AS reference_aliases, 'bench' AS meta_benchmark_name, 'depot/bench' AS meta_source_dataset, s AS meta_source_split, config AS meta_source_subset,
        CAST(NULL AS VARCHAR) AS meta_subject_source, CAST(NULL AS VARCHAR) AS meta_subject_inference_score, config AS meta_source_subject_config, raw AS meta_original_answer,
        CASE WHEN i >= 0 AND i < 26 THEN chr(CAST(65 + i AS INT)) END AS meta_answer_label FROM la""",
    "adapter_pool": _tasks_sql(rf"""(
      SELECT 'pool::' || coalesce(source_split, 'None') || '::' || (row_number() OVER (ORDER BY pool_key) - 1) AS question_id, coalesce({_blank_null('source_split')}, 'train') AS data_split,
        coalesce(replace({_blank_null('subject')}, '_', ' '), 'pool') AS domain, {_clean('question')} AS question_text, choices AS c, answer AS r, answer_index,
        source_dataset, source_split, prompt_text, meta FROM question_pool)""", "'pool' AS meta_benchmark_name, source_dataset AS meta_source_dataset, source_split AS meta_source_split, prompt_text AS meta_prompt_text, "
        "meta ->> '$.original_answer' AS meta_original_answer, meta ->> '$.answer_label' AS meta_answer_label, meta ->> '$.subject_source' AS meta_subject_source").replace(
        _index_sql("r", "c") + " AS i", "answer_index AS i").replace("CASE WHEN i >= 0 AND i < len(c) THEN c[i + 1] ELSE r END", "coalesce(r, '')"),
    "adapter_trivia": rf"""
      WITH t AS (SELECT *, {_split('data_split')} AS s, concat_ws(chr(31), coalesce(question_id, ''), coalesce(question, ''), coalesce(answer.value, ''),
          coalesce(array_to_string(answer.aliases, '|'), ''), coalesce(array_to_string(answer.normalized_aliases, '|'), '')) AS k FROM trivia_rows),
      p AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY k) - 1 AS pos, {_clean('answer.value')} AS v, list_concat({_clean_list('answer.aliases')}, {_clean_list('answer.normalized_aliases')}) AS l
        FROM t WHERE s IN ('train', 'validation'))
      SELECT {_strip("coalesce(nullif(question_id, ''), 'trivia::' || s || '::' || pos)")} AS question_id, s AS data_split, {_clean('question')} AS question_text, v AS reference_answer,
        CASE WHEN NOT list_contains(l, v) THEN list_prepend(v, l) ELSE l END AS reference_aliases, 'trivia' AS meta_benchmark_name, 'depot/trivia' AS meta_source_dataset, s AS meta_source_split
      FROM p WHERE v <> ''""",
    "object_lines": "SELECT line_id, len(list_distinct(json_keys(raw_json))) AS members FROM (SELECT line_id, CASE WHEN json_valid(raw_json) THEN raw_json END AS raw_json FROM task_lines) WHERE json_type(raw_json) = 'OBJECT'",
    "dataset_scan": "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row, o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS missing FROM orders",
    "task_accessors": _SCAN + "SELECT line_id, question_id AS seed_id, question_text AS question, reference_answer AS answer, reference_answer_index AS answer_index, reference_aliases AS answer_aliases FROM ok",
    "pool_label": "SELECT pool_key, CASE WHEN json_type(meta, '$.answer_label') = 'VARCHAR' THEN nullif(meta ->> '$.answer_label', '') END AS answer_label FROM question_pool",
    "prepare_all": _PREPARED,
    "prepare_limit": _PREPARED + " WHERE position < 150",
    "sample_records": _RAW
    + rf"""SELECT printf('mmlu_%06d', n) AS sample_id, 'all' AS subject, question, c AS choices, answer FROM (
        SELECT row_number() OVER (ORDER BY pool_key) - 1 AS n, {_clean('question')} AS question, c, answer FROM ({_SAMPLED}) JOIN (SELECT pool_key, question FROM question_pool) USING (pool_key) JOIN (SELECT pool_key, c FROM q) USING (pool_key))
      WHERE n BETWEEN 100 AND 399""",
    "round_robin": """
      SELECT doc_id, source, position, source || '::' || position AS positional_id FROM (
        SELECT doc_id, source, row_number() OVER (ORDER BY rn, source NULLS FIRST) - 1 AS position FROM (
          SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents))""",
    "round_robin_limit": """
      SELECT doc_id, row_number() OVER (ORDER BY rn, source NULLS FIRST) - 1 AS position FROM (
        SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) ORDER BY position LIMIT 100""",
    "union_limit": """SELECT * FROM (SELECT 0 AS source_pos, s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT 1, c_custkey, c_name FROM customer) ORDER BY source_pos, key LIMIT 1000""",
    "union_lazy": """SELECT 0 AS source_pos, c_custkey AS key, c_name AS name FROM customer ORDER BY key LIMIT 100""",
    "union_all": """SELECT 0 AS source_pos, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_name FROM supplier""",
    "source_count": "SELECT source, count(*) AS rows FROM documents GROUP BY source",
    "anti_append": "SELECT task_key AS sample_id, question_id FROM task_items t WHERE NOT EXISTS (SELECT 1 FROM parsed_responses r WHERE r.task_key = t.task_key)",
    "slice_rows": "SELECT printf('mmlu_%06d', n) AS sample_id, o_orderkey, o_custkey FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS n, o_orderkey, o_custkey FROM orders) WHERE n BETWEEN 500 AND 1499",
}
