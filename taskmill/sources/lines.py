"""Tasks, pool records and samples from JSON lines, validated as columns.

Lines are parsed once into a variant, which keeps JSON kinds apart (true, 1, "1")
and absent keys apart from null ones. A row that breaks a rule gets an ``error``
text; :func:`checked` turns errors into a failure, :func:`accepted` drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.functions import answers
from taskmill.functions.answers import schema_index
from taskmill.functions.text import clean_list, non_blank, stable_id, strip
from taskmill.sources.schema import BENCHMARK_CONTRACT, CONTRACTS, KEYS, QUESTION_TYPES, TASK_COLUMNS


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, source_file) of text files; only line feeds end a line. A missing path is an error."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"), F.input_file_name().alias("source_file"))


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line, source_file, line_no, row_pos): lines with their number in the file, from 1,
    and their position in all files by name, from 0.

    A file may be read in several blocks: numbers are those inside the block plus
    the lines of the blocks before, of which there is one small row each.
    """
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "\n").text(path)
    rows = rows.select(F.col("value").alias("line"), meta["file_path"].alias("source_file"), meta["file_block_start"].alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("source_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    of_file = F.sum("_n").over(Window.partitionBy("source_file").orderBy("_block")) - F.col("_n")
    of_all = F.sum("_n").over(Window.orderBy("source_file", "_block")) - F.col("_n")
    blocks = blocks.select("source_file", "_block", "_first", of_file.alias("_in_file"), of_all.alias("_in_all"))
    out = rows.join(blocks, ["source_file", "_block"])
    inside = F.col("_at") - F.col("_first")
    return out.select("line", "source_file", (F.col("_in_file") + inside + 1).alias("line_no"), (F.col("_in_all") + inside).alias("row_pos"))


def _placed(error: Column, columns: list[str]) -> Column:
    """The error with the number of its line, where lines are numbered."""
    if "line_no" not in columns:
        return error
    return F.when(error.isNotNull(), F.concat(F.lit("line "), F.col("line_no").cast("string"), F.lit(": "), error))


def read_lines_if_any(spark: SparkSession, path: str) -> DataFrame:
    """Like :func:`read_lines`, without rows where the path does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return read_lines(spark, path)
    return spark.createDataFrame([], "line string, source_file string")


def _kind(v: Column) -> Column:
    """JSON kind of a variant: string, number, boolean, array, object, null; null if absent."""
    return _kind_of(F.schema_of_variant(v))


def _kind_of(s: Column) -> Column:
    return (
        F.when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null")
        .when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").when(s.isNotNull(), "number")
    )


class _Row:
    """Access to the members of a parsed line."""

    def __init__(self, parsed: str = "_v"):
        self.v = F.col(parsed)

    def at(self, *names: str) -> Column:
        """The member under the first name that is present, null or not."""
        got = F.variant_get(self.v, f"$.{names[-1]}", "variant")
        for n in reversed(names[:-1]):
            m = F.variant_get(self.v, f"$.{n}", "variant")
            got = F.when(m.isNotNull(), m).otherwise(got)
        return got


def _text(v: Column) -> Column:
    """A scalar as Python would print it, stripped; null for JSON null."""
    s, kind = F.try_variant_get(v, "$", "string"), F.schema_of_variant(v)
    # A variant drops the zeros of 1.0, but keeps it apart from 1.
    integral = kind.startswith("DECIMAL") & ~s.contains(".")
    return strip(F.when(kind == "BOOLEAN", F.initcap(s)).when(integral, F.concat(s, F.lit(".0"))).otherwise(s))


def _strings(v: Column) -> Column:
    items = F.try_variant_get(v, "$", "array<variant>")
    return F.transform(items, _text)


def parsed(lines: DataFrame, col: str = "line") -> DataFrame:
    """Adds ``_v``, the variant of each line that is not blank, and drops blank lines."""
    kept = lines.filter(F.coalesce(strip(F.col(col)), F.lit("")) != "")
    # The parser stops after the first value; as the only element of a list, rubbish or
    # a second value behind it shows.
    value = strip(F.col(col))
    whole = value.rlike(r'(?s)^(?:\{.*\}|\[.*\]|"(?:[^"\\]|\\.)*+"|-?[0-9][0-9.eE+-]*|true|false|null)\z')
    rows = kept.withColumn("_a", F.when(whole, F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))))
    return rows.withColumn("_v", F.when(F.variant_get("_a", "$[1]", "variant").isNull(), F.variant_get("_a", "$[0]", "variant"))).drop("_a")


def _whole(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator, through which no filter is pushed: a test of
    ``error`` would otherwise be copied, with all it is made of, to below the parsing."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def tasks_from_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """Task columns and ``error`` beside the columns of ``lines``.

    Texts are stripped; blank choices and aliases are dropped; the id falls back
    from ``question_id`` over ``seed_id`` and ``id`` to a hash of question and answer.
    """
    r = _Row()
    members = {k: r.at(*v) for k, v in KEYS.items()}
    for k in ("contract", "choices", "metadata", "question_type", "domain", "question_id", "seed_id", "id", "benchmark_name"):
        members[k] = r.at(k)
    # In steps, so that no member is looked up or typed more than once.
    rows = parsed(lines, col).select(*lines.columns, "_v", *[m.alias(f"_m_{k}") for k, m in members.items()])
    typed = ("_v", "_m_reference_answer_index", "_m_choices", "_m_reference_aliases", "_m_metadata")
    rows = rows.select("*", *[F.schema_of_variant(k).alias(f"_s{k}") for k in typed])
    text = lambda k: _text(F.col(f"_m_{k}"))
    rows = rows.select(
        *lines.columns,
        F.col("_v").isNull().alias("_broken"),
        F.coalesce(text("question_text"), F.lit("")).alias("question_text"), F.coalesce(text("reference_answer"), F.lit("")).alias("reference_answer"),
        clean_list(_strings(F.col("_m_choices"))).alias("choices"), clean_list(_strings(F.col("_m_reference_aliases"))).alias("reference_aliases"),
        F.lower(F.coalesce(text("question_type"), F.lit(""))).alias("_named"),
        text("reference_answer_index").alias("_index"), _kind_of(F.col("_s_m_reference_answer_index")).alias("_index_kind"),
        _kind_of(F.col("_s_v")).alias("_kind"), _kind_of(F.col("_s_m_choices")).alias("_choices_kind"),
        _kind_of(F.col("_s_m_reference_aliases")).alias("_aliases_kind"), _kind_of(F.col("_s_m_metadata")).alias("_meta_kind"),
        F.when(F.col("_m_contract").isNull(), F.lit("task_v1")).otherwise(F.coalesce(F.try_variant_get("_m_contract", "$", "string"), F.lit("null"))).alias("_contract"),
        F.coalesce(non_blank(text("data_split")), F.lit("train")).alias("data_split"),
        F.coalesce(non_blank(text("domain")), F.lit("unknown")).alias("domain"),
        F.coalesce(*[non_blank(text(k)) for k in ("question_id", "seed_id", "id")]).alias("_id"),
        non_blank(text("benchmark_name")).alias("_benchmark"),
        F.coalesce(F.to_json("_m_metadata"), F.lit("{}")).alias("_meta"), "_m_metadata",
    )
    qt = F.when(F.col("_named") != "", F.col("_named")).when(F.size("choices") > 0, QUESTION_TYPES[0]).otherwise(QUESTION_TYPES[1])
    rows = rows.withColumn("question_type", qt)
    index = schema_index(F.col("reference_answer"), F.col("_index"), F.col("choices"), F.col("_index_kind"))
    rows = rows.withColumn("reference_answer_index", index)
    rows = rows.withColumn("question_id", F.coalesce("_id", stable_id("task", F.col("question_text"), F.col("reference_answer"))))
    given = F.coalesce(F.try_variant_get("_m_metadata", "$", "map<string,variant>"), F.try_variant_get(F.parse_json(F.lit("{}")), "$", "map<string,variant>"))
    # The row's own benchmark name replaces that of its metadata; without either it is null.
    own = F.when(F.col("_benchmark").isNotNull(), F.try_parse_json(F.to_json(F.array("_benchmark"))))
    name = F.coalesce(F.variant_get(own, "$[0]", "variant"), F.get(F.map_values(F.map_filter(given, lambda k, v: k == "benchmark_name")), F.lit(0)), F.parse_json(F.lit("null")))
    merged = F.to_json(F.map_concat(F.map_filter(given, lambda k, v: k != "benchmark_name"), F.create_map(F.lit("benchmark_name"), name)))
    rows = rows.withColumn("metadata", F.when(F.col("_contract") == BENCHMARK_CONTRACT, merged).otherwise(F.col("_meta")))
    i = F.col("reference_answer_index")
    bad_index = i.isNull() | (i < 0) | (i >= F.size("choices"))
    mc = F.col("question_type") == QUESTION_TYPES[0]
    error = (
        F.when(F.col("_broken"), "not JSON")
        .when(F.col("_kind") != "object", "not an object")
        .when(~F.col("_contract").isin(CONTRACTS), "unsupported contract")
        .when(F.col("question_text") == "", "no question_text")
        .when(F.col("reference_answer") == "", "no reference_answer")
        .when(~F.coalesce("_choices_kind", F.lit("null")).isin("array", "null"), "choices is no list")
        .when(~F.col("question_type").isin(QUESTION_TYPES), "unsupported question_type")
        .when(mc & (F.size("choices") == 0), "multiple_choice without choices")
        .when(mc & bad_index, "multiple_choice without a valid index")
        .when(F.coalesce("_meta_kind", F.lit("object")) != "object", "metadata is no object")
        .when(~F.coalesce("_aliases_kind", F.lit("null")).isin("array", "null"), "aliases is no list")
    )
    return _whole(rows.select(*lines.columns, *TASK_COLUMNS, _placed(error, lines.columns).alias("error")))


def _index(v: Column) -> Column:
    text = F.try_variant_get(v, "$", "string")
    return F.when(text == "true", 1).when(text == "false", 0).otherwise(answers.whole(text))


def pool_from_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """Question-pool columns and ``error``; every field is mandatory and typed."""
    r = _Row()
    rows = parsed(lines, col)
    texts = ["source_dataset", "source_split", "subject", "question", "answer", "prompt_text"]
    members = {k: r.at(k) for k in [*texts, "choices", "answer_index", "meta"]}
    error = F.when(F.col("_v").isNull(), "not JSON").when(_kind(F.col("_v")) != "object", "not an object")
    for k in texts:
        error = error.when(F.coalesce(_kind(members[k]), F.lit("null")) != "string", f"missing string field {k}")
    listed = F.try_variant_get(members["choices"], "$", "array<variant>")
    strings = F.forall(F.coalesce(listed, F.array().cast("array<variant>")), lambda x: _kind(x) == "string")
    error = error.when((F.coalesce(_kind(members["choices"]), F.lit("null")) != "array") | ~strings, "invalid choices")
    whole = F.try_variant_get(members["answer_index"], "$", "string").rlike(r"^-?[0-9]+\z|^true\z|^false\z")
    error = error.when(~F.coalesce(_kind(members["answer_index"]), F.lit("null")).isin("number", "null", "boolean") | ~F.coalesce(whole, F.lit(True)), "invalid answer_index")
    error = error.when(F.coalesce(_kind(members["meta"]), F.lit("null")) != "object", "invalid meta")
    return _whole(rows.select(
        *lines.columns,
        *[F.try_variant_get(members[k], "$", "string").alias(k) for k in texts[:4]],
        F.try_variant_get(members["choices"], "$", "array<string>").alias("choices"),
        F.try_variant_get(members["answer"], "$", "string").alias("answer"),
        F.when(F.coalesce(whole, F.lit(False)), _index(members["answer_index"])).alias("answer_index"),
        F.try_variant_get(members["prompt_text"], "$", "string").alias("prompt_text"),
        F.to_json(members["meta"]).alias("meta"),
        _placed(error, lines.columns).alias("error"),
    ))


def samples_from_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """(record, error) of object lines; blank lines are skipped."""
    rows = parsed(lines, col)
    error = F.when(F.col("_v").isNull(), "not JSON").when(_kind(F.col("_v")) != "object", "not an object")
    return rows.select(*lines.columns, F.to_json("_v").alias("record"), error.alias("error"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter("error IS NULL").drop("error")


def checked(rows: DataFrame) -> DataFrame:
    """Rows as they are; reading a row with an error fails the job."""
    fail = F.assert_true(F.col("error").isNull(), F.concat(F.lit("bad row: "), F.col("error")))
    return rows.filter(F.coalesce(fail, F.lit(None).cast("void")).isNull()).drop("error")


def not_empty(rows: DataFrame, what: str) -> DataFrame:
    if rows.isEmpty():
        raise ValueError(f"no rows in {what}")
    return rows
