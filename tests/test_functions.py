import json

import pytest
from pyspark.sql import functions as F

from taskmill.functions import answers, render
from taskmill.functions import text as tx


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()
    return row.asDict()


def test_strip_and_ids(spark):
    import hashlib

    got = one(
        spark, a=tx.strip(F.lit("  x y \t\n")), b=tx.clean(F.lit(None).cast("string")), c=tx.stable_id("task", F.lit(" q "), F.lit(None).cast("string"), F.lit("a")),
        d=tx.order_key(F.lit("a "), F.lit(" "), F.lit("b")), e=tx.domain_name(F.lit(" x_y "), F.lit("z")), f=tx.domain_name(F.lit("  "), F.lit("z")),
    )
    assert got["a"] == "x y" and got["b"] == "" and got["d"] == "a::b" and got["e"] == "x y" and got["f"] == "z"
    assert got["c"] == "task::" + hashlib.sha256(b"q||a").hexdigest()[:16]


def test_lists_keep_or_drop_blanks(spark):
    c = F.array(F.lit(" a "), F.lit(" "), F.lit(None).cast("string"))
    got = one(spark, kept=tx.tidy_list(c), dropped=tx.clean_list(c), none=tx.clean_list(F.lit(None).cast("array<string>")))
    assert got == {"kept": ["a", "", ""], "dropped": ["a"], "none": []}


def test_tokens_keep_repeats_and_drop_stopwords(spark):
    assert one(spark, t=tx.subject_tokens(F.lit("The tide, the TIDE of x9 c++a")))["t"] == ["tide", "tide", "c++a"]


def test_trivia_aliases(spark):
    schema = "answer struct<value:string,aliases:array<string>,normalized_aliases:array<string>>"
    df = spark.createDataFrame([((" X ", ["y", " ", "y"], ["z"]),), (("y", ["y"], None),), ((None, None, None),), (None,)], schema)
    got = [r[0] for r in df.select(tx.trivia_answer(F.col("answer"))).collect()]
    assert [(r["value"], r["aliases"]) for r in got] == [("X", ["X", "y", "y", "z"]), ("y", ["y"]), ("", []), ("", [])]


@pytest.mark.parametrize(
    "raw,kind,want",
    [("2", "string", 2), ("b", "string", 1), ("yes", "string", 0), ("no", "string", None), ("7", "number", 7), ("1.0", "number", 1), ("1.5", "number", None), ("20000000000", "string", (1 << 31) - 1), ("-" + "9" * 30, "number", -(1 << 31)), ("9" * 50 + ".0", "number", (1 << 31) - 1), ("true", "boolean", None), (None, "null", None), ("", "string", None)],
)
def test_adapter_index(spark, raw, kind, want):
    c = F.array(F.lit("yes"), F.lit("x"))
    assert one(spark, i=answers.adapter_index(F.lit(raw).cast("string"), c, F.lit(kind)))["i"] == want


@pytest.mark.parametrize("index,kind,answer,want", [("true", "boolean", "x", 1), ("C", "string", "x", 2), (" 1 ", "string", "x", 1), ("5", "number", "x", 5), (None, "null", "x", 1), ("zz", "string", "q", None)])
def test_schema_index(spark, index, kind, answer, want):
    c = F.array(F.lit("yes"), F.lit("x"))
    assert one(spark, i=answers.schema_index(F.lit(answer), F.lit(index).cast("string"), c, F.lit(kind)))["i"] == want
    none = F.array().cast("array<string>")
    assert one(spark, i=answers.schema_index(F.lit(answer), F.lit(index).cast("string"), none, F.lit(kind)))["i"] is None


def test_labels(spark):
    def label(i):
        out = ""
        while True:
            out, i = chr(65 + i % 26) + out, i // 26 - 1
            if i < 0:
                return out

    df = spark.range(20_000)
    got = df.select("id", answers.option_label(F.col("id")).alias("l"), answers.answer_label(F.col("id").cast("int")).alias("a")).collect()
    assert all(r["l"] == label(r["id"]) for r in got)
    assert [r["a"] for r in got[24:28]] == ["Y", "Z", None, None]


@pytest.mark.parametrize(
    "raw,kind,want", [("1", "number", "B"), ("9", "number", "9"), ("a", "string", "A"), ("1", "string", "B"), ("x", "string", "B"), (" no ", "string", "no"), ("true", "boolean", "B"), ("false", "boolean", "A"), ("1.5", "number", "1.5")]
)
def test_sampled_answer(spark, raw, kind, want):
    assert one(spark, a=answers.sampled_answer(F.lit(raw), F.array(F.lit("yes"), F.lit("x")), F.lit(kind)))["a"] == want


def test_renders(spark):
    c = F.array(F.lit("one"), F.lit("two"))
    none = F.array().cast("array<string>")
    got = one(
        spark, a=render.adapter_prompt(F.lit("s"), F.lit("q?"), c), b=render.adapter_prompt(F.lit("s"), F.lit("q?"), none), t=render.task_prompt(F.lit("d"), F.lit("open_qa"), F.lit("q?"), none),
        m=render.task_prompt(F.lit("d"), F.lit("multiple_choice"), F.lit("q?"), c), s=render.sample_prompt(F.lit(" q? "), c),
    )
    assert got["a"] == "Subject: s\n\nQuestion:\nq?\n\nOptions:\nA. one\nB. two" and got["b"] == "q?"
    assert got["t"] == "Domain: d\nQuestion Type: open_qa\n\nQuestion:\nq?"
    assert got["m"].endswith("Options:\nA. one\nB. two") and got["s"] == "Question: q?\nA. one\nB. two"
    many = one(spark, a=render.adapter_prompt(F.lit("s"), F.lit("q"), F.array(*[F.lit("x")] * 27)))["a"]
    assert many.endswith("Z. x\nOption 27. x")
    assert json.dumps(many)
