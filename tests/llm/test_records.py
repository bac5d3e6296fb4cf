"""Copies, splits, samples, looks and encoding on small fixtures."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from taskmill.llm import keep_together, looks, quota_sample, sorted_runs, trie_bpe
from taskmill.llm.words import passage_number, split_kind


def test_copies(spark):
    def line(i, q, a, key="question", akey="answer"):
        return (i, json.dumps({"x": i, akey: a, key: q}))

    rows = [line(5, "A b, c", "D"), line(3, "a  B c!", "d.", "question_text", "gold_answer"), line(9, "a b", "c d"), line(4, "a b c", "d"), (1, ""), (2, "{broken"), (6, "[1]"), (7, None), line(8, None, "  "), line(10, None, None)]
    df = spark.createDataFrame(rows * 2, "line_id bigint, raw_json string").withColumn("keep_id", F.lit("x"))
    assert sorted(map(tuple, sorted_runs.copies_found(df).collect())) == [(3, 4), (3, 5)]
    assert sorted_runs.copies_found(df.limit(0)).count() == 0


def test_one_key_over_many_partitions(spark):
    rows = [(i, json.dumps({"question": "same", "answer": "x"})) for i in range(500)] + [(1000 + i, json.dumps({"question": f"q{i}", "answer": "x"})) for i in range(50)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "line_id bigint, raw_json string")
    got = {tuple(r) for r in sorted_runs.copies_found(df).collect()}
    assert got == {(0, i) for i in range(1, 500)}
    assert dict(map(tuple, sorted_runs.collapsed(df).collect()))[0] == 500


def test_ids_and_splits(spark):
    rows = [("a::train::p0012-q3", 12), ("tq_7--1", 7), ("TQ_007--1", 7), (" s :: dev :: p5-q1 ", 5), ("s/val/p0_q01", 0), ("S::x::P9.Q2", 9), ("task::12ab", None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "q string, want bigint")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", passage_number(F.col("q"))).collect())
    kinds = spark.createDataFrame([(" Dev ", "validation"), ("AUXILIARY_TRAIN", "train"), ("test", "test"), ("other", None), (None, None)], "s string, want string")
    assert all(r["got"] == r["want"] for r in kinds.withColumn("got", split_kind(F.col("s"))).collect())


def test_forest_equals_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(1, 60), rnd.randint(1, 60)) for _ in range(45)] + [(None, 1), (5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u and v and u != v:
            parent[find(u)] = find(v)
    forest, labels, _ = keep_together.spanning_forest(spark.createDataFrame(edges, "u bigint, v bigint"))
    got = {r["node"]: r["root"] for r in labels.collect()}
    assert set(got) == set(parent) and len({(find(n), r) for n, r in got.items()}) == len(set(got.values())) == len({find(n) for n in got})
    assert forest.count() == len(got) - len(set(got.values()))


def test_related_rows_share_a_split(spark):
    rows = [(i, f"a{i // 10}", f"e{i % 25}" if i < 30 else None) for i in range(1, 200)] + [(500, None, None), (501, None, "e3")]
    df = spark.createDataFrame(rows, "k bigint, author string, entity string")
    out = keep_together.assign_splits(df, "k", {"author": F.col("author"), "entity": F.col("entity")}, {"train": 0.5, "test": 0.5})
    got = {r["rec_id"]: (r["root"], r["split"]) for r in out.collect()}
    assert len(got) == len(rows)
    for i, author, entity in rows:
        for j, other, theirs in rows:
            if author and author == other or entity and entity == theirs:
                assert got[i] == got[j]
    assert keep_together.assign_splits(df.limit(0), "k", {"author": F.col("author")}, {"train": 1}).count() == 0


@pytest.mark.parametrize("sizes", [[1 + i % 3 for i in range(3000)], [1500] + [1 + i % 40 for i in range(400)], [7], [100, 90, 80, 3, 2, 1], [2 ** (i % 11) for i in range(300)]])
def test_dealing_keeps_proportions(spark, sizes):
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    comps = spark.createDataFrame(list(enumerate(sizes)), "root bigint, rows bigint")
    got = {r["split"]: r["n"] for r in keep_together.deal(comps, shares).groupBy("split").agg(F.sum("rows").alias("n")).collect()}
    assert sum(got.values()) == sum(sizes)
    for k, v in shares.items():
        assert abs(got.get(k, 0) - v * sum(sizes)) <= max(sizes)


def test_registered_splits_run_the_forest(spark):
    from taskmill.llm import queries

    d = "/root/testdata/sf0.001"
    t = queries.table(spark, d, "task_items").select("task_key", "question_id", "question_text")
    related = keep_together.related_rows(t, "task_key", queries._entities())
    assert related.forest.rounds >= 2 and related.forest.edges.count() > 0
    sizes = related.roots.groupBy("root").agg(F.sum("n").alias("rows"))
    largest, total = sizes.agg(F.max("rows"), F.sum("rows")).first()
    shares = {r["new_split"]: r["rows"] for r in queries.p5_shares(spark, d).collect()}
    assert sum(shares.values()) == total == t.count()
    for k, v in queries.SHARES.items():
        assert abs(shares[k] - v * total) <= largest
    joined = t.join(queries.p5_splits(spark, d), "task_key").withColumns({k: v for k, v in queries._entities().items()})
    for kind in queries._entities():
        assert joined.filter(F.col(kind).isNotNull()).groupBy(kind).agg(F.count_distinct("new_split").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("slack", [6.0, 0.0, -3.0])
def test_quota_sample(spark, monkeypatch, slack):
    rows = [("t", ["Red_fish", "red  FISH", "red-fish"][i % 3], i) for i in range(3000)] + [("t", "blue", 5000 + i) for i in range(4)] + [("t", None, 9000)]
    df = spark.createDataFrame(rows, "table_name string, category string, rec_id bigint")
    targets = spark.createDataFrame([(1, "t", "red fish", 500, 2, 100), (1, "t", "blue", 1, 5, 100), (1, "t", "none", 10, 1, 100)], "plan_id int, table_name string, category string, target_permille int, min_rows int, sample_permille int")
    targets = targets.withColumn("n", F.lit(1)).withColumn("cat", F.lit("x")).withColumn("total", F.lit(0))
    assert {tuple(r) for r in quota_sample.unmet(targets, df).collect()} == {(1, "blue", 5, 4), (1, "none", 3, 0)}
    monkeypatch.setattr(quota_sample, "SLACK", slack)
    assert {tuple(r) for r in quota_sample.report(targets, df).collect()} == {(1, "red fish", 150, 3000, 150, 0), (1, "blue", 5, 4, 4, 1), (1, "none", 3, 0, 0, 3)}
    drawn = quota_sample.draw(targets, df).collect()
    counts = {c: sum(r["category"] == c for r in drawn) for c in ("red fish", "blue")}
    assert counts == {"red fish": 150, "blue": 4} and len({r["rec_id"] for r in drawn}) == 154
    assert quota_sample.draw(targets, df.limit(0)).count() == 0 and quota_sample.unmet(targets.limit(0), df).count() == 0


def test_quota_of_one_repeated_record(spark):
    """A third of a category is one id, which is accepted or rejected as a block."""
    rows = spark.createDataFrame([("t", "a", i) for i in range(60)] + [("t", "a", 1000)] * 30 + [("t", "b", None)], "table_name string, category string, rec_id bigint")
    targets = spark.createDataFrame([(k, "t", "A", 1000, 0, 700) for k in range(12)] + [(0, "t", None, 5, 1, 10)], "plan_id int, table_name string, category string, target_permille int, min_rows int, sample_permille int")
    got = {r["plan_id"]: r["n"] for r in quota_sample.draw(targets, rows).groupBy("plan_id").agg(F.count("*").alias("n")).collect()}
    assert got == dict.fromkeys(range(12), 63)


def test_looks(spark, monkeypatch):
    same = ["Café 12", "Café 12", "Ｃafé​ 12", "Сaf­é １２"]
    other = ["café 12", "Cafe 12", "Café l2", "Café 12!"]
    emoji = ["\U0001f468‍\U0001f3eb", "\U0001f468\U0001f3eb"]
    rows = list(enumerate([*same, *other, *emoji, None, "", " ", same[0]]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {tuple(r) for r in looks.same_look_pairs(df).collect()}
    group = [0, 1, 2, 3, 13]
    assert got == {(a, b) for a in group for b in group if a < b and rows[a][1] != rows[b][1]}
    forms = dict(map(tuple, looks.normalized(df, "doc_id", "text").collect()))
    assert len({forms[i] for i in [*group, 4]}) == 1 and forms[10] is None and forms[12] == ""
    assert looks.same_look_pairs(df.limit(0)).count() == 0
    assert [tuple(r) for r in looks.look_classes(df.withColumn("raw", F.lit(1))).collect()] == [(0, 4, 5)]
    monkeypatch.setattr(looks, "DOCS_A_BUCKET", 2)
    many = spark.createDataFrame([(i, same[i % 3]) for i in range(30)], "doc_id bigint, text string")
    assert looks.same_look_pairs(many).count() == 300 and looks.look_classes(many).first()["docs"] == 30


def test_texts_of_one_look_have_one_form():
    rnd = random.Random(6)
    letters = looks.CYRILLIC + looks.GREEK + looks.OTHERS + looks.CYRILLIC_LATIN + looks.GREEK_LATIN
    odd = "\u0301\u0308\u00ad\u200b\u200d\ufe0f\u00a0\u2003\u3000\r\n\t ＡｅÉёЙΆ１①ﬁⅯⅱßŉİ\u1e9e가한\u1112\u1161ﾊﾞ\ud800"
    seen = {}
    for _ in range(60_000):
        t = "".join(rnd.choice(letters if rnd.random() < 0.5 else odd) for _ in range(rnd.randint(1, 3)))
        form = looks.consistent_form(t)
        assert seen.setdefault(looks.look_of(t), form) == form, ascii(t)
    every = "".join(map(chr, range(0x110000)))
    assert looks._translated(every) == every.translate(looks._FORM_TABLE)
    texts = ["É x", "plain", "", "Ａ\uffff", "б", "\uffffz\ufffe", "".join(map(chr, [*range(0xFDD0, 0xFDF0), 0xFFFE, 0xFFFF]))]
    assert looks.consistent_forms(texts) == [looks.consistent_form(t) for t in texts]


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers"), reason="no vocabulary files")
def test_encoding_equals_the_library(spark):
    from taskmill.llm.queries import vocabulary

    path, pattern = vocabulary("byte_bpe_50k.tiktoken")
    import tiktoken

    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=trie_bpe.read_ranks(path), special_tokens={})
    rnd = random.Random(2)
    texts = ["", None, " ", "a", "<|endoftext|>", "don't", "naïve 中文 привет \U0001f600", "x" * 3000, " \n\n  tabs\t", *["".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(0x400, 0x45F), rnd.randint(0x4E00, 0x4E40), 32])) for _ in range(80)) for _ in range(60)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = dict(map(tuple, trie_bpe.encoded(df, "doc_id", "text", path, pattern).collect()))
    assert all(got[i] == ref.encode_ordinary(t or "") for i, t in enumerate(texts))
