"""Registered reports and classes against what the found pairs and rows say."""

import os
from collections import Counter

import pytest

from taskmill.llm import queries
from taskmill.llm.queries import QUERIES

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(D), reason="no test tables")


@pytest.fixture(scope="module")
def run(spark):
    known = {}

    def get(name):
        if name not in known:
            known[name] = [r.asDict() for r in QUERIES[name](spark, D).collect()]
        return known[name]

    return get


def test_overlap_report_and_classes(spark, run):
    pairs = {(r["key_a"], r["key_b"]) for r in run("p1_found")}
    assert pairs
    records = {r["rec_id"]: r for r in queries._question_records(spark, D).collect()}
    held = Counter()
    for p in pairs:
        a, b = (records[k] for k in p)
        assert {a["side"], b["side"]} == {0, 1}
        held[max(p, key=lambda k: records[k]["side"])] += 1
    want = {}
    for k, n in held.items():
        at = want.setdefault((records[k]["split"], records[k]["source"]), [0, 0])
        at[0] += n
        at[1] += 1
    assert {(r["split"], r["source"]): [r["pairs"], r["held_out_records"]] for r in run("p1_report")} == want
    links = Counter(k for p in pairs for k in p)
    classes = run("p1_classes")
    assert {r["rec_id"]: r["links"] for r in classes if r["links"]} == links and len({r["rec_id"] for r in classes}) == len(classes)


def test_classes_of_alike_tasks(run):
    links = Counter(k for r in run("p4_found") for k in (r["key_a"], r["key_b"]))
    classes = run("p4_classes")
    assert links and {r["rec_id"]: r["links"] for r in classes if r["links"]} == links
    assert all(r["class_id"] <= r["rec_id"] for r in classes)


def test_defect_report(spark, run):
    who = {r["response_id"]: r["responder"] for r in queries.table(spark, D, "parsed_responses").collect()}
    want = Counter((who[r["response_id"]], r["defect"]) for r in run("p2_found"))
    assert want and {(r["responder"], r["defect"]): r["responses"] for r in run("p2_report")} == want


def test_leaked_items(run):
    want = Counter(r["item_id"] for r in run("p8_found"))
    assert want and {r["item_id"]: r["documents"] for r in run("p8_items")} == want


def test_look_classes_hold_the_pairs(run):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in run("p9_found"):
        a, b = sorted((find(r["doc_a"]), find(r["doc_b"])))
        parent[b] = a
    groups = Counter(find(x) for x in list(parent))
    assert groups and {r["class_id"]: r["docs"] for r in run("p9_classes")} == dict(groups)


def test_sample_keeps_to_its_targets(run):
    drawn = Counter((r["plan_id"], r["category"]) for r in run("p6_sample"))
    report = run("p6_report")
    assert {(r["plan_id"], r["category"]): r["drawn"] for r in report if r["drawn"]} == drawn
    assert all(r["drawn"] == min(r["needed"], r["have"]) for r in report)
    assert {(r["plan_id"], r["category"]) for r in run("p6_found")} == {(r["plan_id"], r["category"]) for r in report if r["deficit"]}
