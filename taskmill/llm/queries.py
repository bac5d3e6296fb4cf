"""The pN_ queries of the training-data operators and their SQL."""

from __future__ import annotations

import os
from importlib.util import module_from_spec, spec_from_file_location

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.llm import defects, keep_together, leaks, likeness, looks, quota_sample, sorted_runs, trie_bpe
from taskmill.llm.words import passage_number, split_kind
from taskmill.runtime import table

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}


def _question_records(spark: SparkSession, d: str) -> DataFrame:
    """(rec_id, side, source, split, text) of both question tables; side 0 is training, 1 held out."""
    t = table(spark, d, "task_items")
    t = t.select(F.col("task_key").alias("rec_id"), split_kind(F.col("data_split")).alias("split"), F.col("question_text").alias("text"), F.get_json_object("metadata", "$.benchmark_name").alias("source"))
    p = table(spark, d, "question_pool")
    p = p.select(F.col("pool_key").alias("rec_id"), split_kind(F.col("source_split")).alias("split"), F.col("question").alias("text"), F.regexp_replace(F.lower(F.trim("source_dataset")), "^.*/", "").alias("source"))
    both = t.unionByName(p).filter("split IS NOT NULL")
    return both.withColumn("side", F.when(F.col("split") == "train", 0).otherwise(1))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return likeness.like_pairs(_question_records(spark, d).select("rec_id", "side", "text"), cross=True)


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each record with its class of equal words and its number of links to the other side."""
    return likeness.like_members(_question_records(spark, d).select("rec_id", "side", "text"), cross=True)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping pairs and held-out records per held-out split and source."""
    recs = _question_records(spark, d)
    pairs = likeness.like_pairs(recs.select("rec_id", "side", "text"), cross=True)
    ends = pairs.select(F.explode(F.array("key_a", "key_b")).alias("rec_id"))
    hits = ends.groupBy("rec_id").agg(F.count("*").alias("n"))
    held = recs.filter("side = 1").select("rec_id", "split", "source").distinct()
    return held.join(hits, "rec_id").groupBy("split", "source").agg(F.sum("n").alias("pairs"), F.count("*").alias("held_out_records"))


def _task_texts(spark: SparkSession, d: str) -> DataFrame:
    choices = F.array_join(F.coalesce("choices", F.array().cast("array<string>")), " ")
    text = F.concat_ws(" ", F.coalesce("question_text", F.lit("")), choices)
    return table(spark, d, "task_items").select(F.col("task_key").alias("rec_id"), F.lit(0).alias("side"), text.alias("text"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return likeness.like_pairs(_task_texts(spark, d))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each record with its class of equal words and its number of alike records."""
    return likeness.like_members(_task_texts(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return defects.defects(table(spark, d, "parsed_responses"), table(spark, d, "task_items"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    found = p2_found(spark, d)
    who = table(spark, d, "parsed_responses").select("response_id", "responder").distinct()
    return found.join(who, "response_id").groupBy("responder", "defect").agg(F.count("*").alias("responses"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return sorted_runs.copies_found(table(spark, d, "task_lines"))


def p3_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return sorted_runs.collapsed(table(spark, d, "task_lines"))


def _entities() -> dict:
    qid = F.lower(F.regexp_replace("question_id", r"[\s\p{Z}]+", ""))
    # The same words under two passages, too, keep their rows together.
    wording = F.concat_ws(" ", F.regexp_extract_all(F.lower("question_text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    return {"passage": passage_number(F.col("question_id")), "question": F.when(qid != "", qid), "wording": F.when(wording != "", wording)}


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items").select("task_key", "question_id", "question_text", "data_split")
    torn = keep_together.torn(t, "task_key", _entities(), split_kind(F.col("data_split")))
    return torn.select(F.col("value").alias("passage_no"))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items").select("task_key", "question_id", "question_text")
    out = keep_together.assign_splits(t, "task_key", _entities(), SHARES)
    return out.select(F.col("rec_id").alias("task_key"), F.col("split").alias("new_split"))


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows, share of all rows in thousandths and wanted thousandths of each new split."""
    n = p5_splits(spark, d).groupBy("new_split").agg(F.count("*").alias("rows"))
    n = n.withColumn("total", F.sum("rows").over(Window.partitionBy(F.lit(0))))  # one row a split
    wanted = F.create_map(*[F.lit(x) for k, v in SHARES.items() for x in (k, round(1000 * v))])
    return n.select("new_split", "rows", F.round(1000 * F.col("rows") / F.col("total"), 1).alias("permille"), wanted[F.col("new_split")].alias("wanted_permille"))


def _categories(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "task_items").select(F.lit("task_items").alias("table_name"), F.col("domain").alias("category"), F.col("task_key").alias("rec_id"))
    p = table(spark, d, "question_pool").select(F.lit("question_pool").alias("table_name"), F.col("subject").alias("category"), F.col("pool_key").alias("rec_id"))
    return t.unionByName(p)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.unmet(table(spark, d, "category_targets"), _categories(spark, d)).select("plan_id", "category")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.report(table(spark, d, "category_targets"), _categories(spark, d))


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.draw(table(spark, d, "category_targets"), _categories(spark, d)).select("plan_id", "category", "rec_id")


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the sample and distinct records by plan and category."""
    drawn = p6_sample(spark, d).groupBy("plan_id", "category")
    return drawn.agg(F.count("*").alias("drawn"), F.count_distinct("rec_id").alias("records"))


def vocabulary(name: str) -> tuple[str, str]:
    """(path, pattern) of a public tokenizer; the folder is a parameter of the environment."""
    folder = os.environ.get("TASKMILL_TOKENIZERS", "/opt/tokenizers")
    spec = spec_from_file_location("_tokenizers", os.path.join(os.path.realpath(folder), "__init__.py"))
    module = module_from_spec(spec)
    spec.loader.exec_module(module)
    return f"{folder}/{name}", module.PATTERN


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return trie_bpe.encoded(table(spark, d, "documents"), "doc_id", "text", *vocabulary("byte_bpe_50k.tiktoken"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return looks.same_look_pairs(table(spark, d, "documents"))


def p9_form(spark: SparkSession, d: str) -> DataFrame:
    return looks.normalized(table(spark, d, "documents"), "doc_id", "text")


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    return looks.look_classes(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_classes, p1_report, p2_found, p2_report, p3_found, p3_collapsed, p4_found, p4_classes, p5_found, p5_splits, p5_shares, p6_found, p6_report, p6_sample, p6_shares, p7_ids, p8_found, p8_items, p9_found, p9_form, p9_classes)
}

_KIND = (
    "CASE WHEN lower(trim(data_split)) IN ('train','auxiliary_train') THEN 'train' "
    "WHEN lower(trim(data_split)) IN ('dev','val','validation') THEN 'validation' "
    "WHEN lower(trim(data_split)) = 'test' THEN 'test' END"
)
_CAT = r"trim(regexp_replace(lower({0}), '[\s\p{{Z}}_-]+', ' ', 'g'))"

_NEEDS = f"""
WITH r AS (
  SELECT 'task_items' AS table_name, {_CAT.format('domain')} AS cat FROM task_items
  UNION ALL SELECT 'question_pool', {_CAT.format('subject')} FROM question_pool),
c AS (SELECT table_name, cat, count(*) AS n FROM r GROUP BY ALL),
s AS (SELECT table_name, count(*) AS total FROM r GROUP BY ALL),
x AS (
  SELECT plan_id, category, coalesce(n, 0) AS have,
    greatest(CAST(min_rows AS BIGINT), ((total * sample_permille // 1000) * target_permille + 999) // 1000) AS needed
  FROM category_targets t JOIN s USING (table_name)
  LEFT JOIN c ON c.table_name = t.table_name AND c.cat = {_CAT.format('category')})
"""

def _first(*names: str) -> str:
    out = f"raw ->> '$.{names[-1]}'"
    for n in reversed(names[:-1]):
        out = f"CASE WHEN list_contains(json_keys(raw), '{n}') THEN raw ->> '$.{n}' ELSE {out} END"
    return f"array_to_string(regexp_extract_all(lower(coalesce({out}, '')), '[\\p{{L}}\\p{{N}}]+'), ' ')"


_LINES = f"""
WITH l AS (SELECT line_id, CASE WHEN json_valid(raw_json) THEN raw_json END AS raw FROM task_lines),
k AS (SELECT line_id, {_first('question_text', 'question')} AS q, {_first('reference_answer', 'answer', 'gold_answer')} AS a
  FROM l WHERE raw IS NOT NULL AND json_type(raw) = 'OBJECT'),
g AS (SELECT line_id, min(line_id) OVER (PARTITION BY q, a) AS keep_id FROM k WHERE q <> '' OR a <> '')
"""

SQL = {
    "p3_found": _LINES + "SELECT keep_id, line_id AS copy_id FROM g WHERE keep_id <> line_id",
    "p3_collapsed": _LINES + "SELECT keep_id, count(*) AS copies FROM g GROUP BY keep_id",
    "p5_found": f"""
      SELECT CAST(p AS BIGINT) AS passage_no FROM (
        SELECT regexp_extract(question_id, '(?i)(?:^\\s*tq_|(?:::|/)\\s*p)0*(\\d+)\\s*(?:--|[-_.]q)\\s*\\d+\\s*$', 1) AS p,
               {_KIND} AS k FROM task_items)
      WHERE p <> '' AND k IS NOT NULL GROUP BY p HAVING count(DISTINCT k) > 1""",
    "p6_found": _NEEDS + "SELECT plan_id, category FROM x WHERE have < needed",
    "p6_report": _NEEDS + "SELECT plan_id, category, needed, have, least(needed, have) AS drawn, greatest(0, needed - have) AS deficit FROM x",
    "p6_shares": _NEEDS + "SELECT plan_id, category, least(needed, have) AS drawn, least(needed, have) AS records FROM x WHERE least(needed, have) > 0",
}
