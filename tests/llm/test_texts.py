"""Leaks and response defects on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taskmill.llm import defects, leaks

LETTERS = "bcdfghjklmnp"


def vocabulary(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) + rnd.choice("aeiou") for _ in range(3)) for _ in range(n)]


def test_leaks(spark, monkeypatch):
    v = vocabulary(400, 1)
    item, other, short = v[:60], v[100:160], v[200:212]
    stock = "Read the passage and choose the best answer. "
    items = [(1, stock + " ".join(item)), (2, " ".join(other)), (3, " ".join(short)), (4, None), (5, " "), *[(10 + i, stock + " ".join(v[300 + 5 * i : 330 + 5 * i])) for i in range(4)]]
    noise = vocabulary(200, 9)
    edited = item[5:30]
    edited[10:11] = ["changed"]
    edited.insert(20, "added")
    shuffled = item[:]
    random.Random(4).shuffle(shuffled)
    cyr = " ".join(item[10:32]).replace("a", "а").upper()
    docs = [
        (1, " ".join(noise[:50] + item + noise[50:])), (2, " ".join(noise[:30] + edited + noise[30:60])), (3, " ".join(shuffled)), (4, " ".join(noise[:20] + item[:12] + noise[20:40])),
        (5, cyr), (6, "x <b>" + "</b> <br/> ".join(item[20:41]) + " y"), (7, None), (8, ""), (9, stock + " ".join(item[:12])), (10, " ".join(short)), (11, " ".join(other[:19])), (11, " ".join(other[:19])),
        (12, " ".join(noise * 40 + other[7:29])),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    its = spark.createDataFrame(items, "item_id bigint, item_text string")
    got = {tuple(r) for r in leaks.leaks(df, its).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (10, 3), (12, 2)}
    for common in (0, 2):  # every seed, or those of several items, are left out where that may be
        monkeypatch.setattr(leaks, "COMMON", common)
        assert {tuple(r) for r in leaks.leaks(df, its).collect()} == got
    report = {(r["item_id"], r["documents"]) for r in leaks.leak_report(df.withColumn("seed", F.lit(1)), its).collect()}
    assert report == {(1, 4), (2, 1), (3, 1)}
    assert leaks.leaks(df.limit(0), its).count() == 0 and leaks.leaks(df, its.limit(0)).count() == 0


def test_defects(spark):
    v = vocabulary(60, 5)
    tasks, responses = [], []
    for k in range(40):
        a, b, c = v[k], v[k + 7], v[k + 11]
        q = f"The {a} of the harbor was joined by the {b} and then by the {c}. Which wheel is moved by the {a} of the {b}?"
        tasks.append((k, q, ["the wheel of the harbor", "the council refused to answer"], "the wheel of the harbor", [f"{a} hollow"]))
    good = "The wheel of the harbor was moved by the quarry. "
    rid = iter(range(1000))

    def say(k, fa, why=good, raw="{}"):
        i = next(rid)
        responses.append((i, k, fa, why, raw))
        return i

    want = {}
    for k in range(40):
        say(k, "the wheel of the harbor")
        say(k, "The council refused to answer")
    say(1, "the wheel of the harbor", good + "The quarry was moved by the harbor")
    say(2, "the quarry of the harbor")
    say(3, "the wheel of the harbor", None)
    for k in range(5):
        want[say(k, f"Sadly my rules forbid judging {v[k]} today, friend.")] = "refusal"
    for k in range(3):
        want[say(9 + k, f"{('Well,', 'Hmm,', 'Regarding ' + v[30 + k] + ':')[k]} I'm sorry, but I cannot help with that request.")] = "refusal"
    say(20, "I would rather climb quietly, says a lone voice.")
    for fa in ("", None, " \n", "N/A", "null", "[]", "…"):
        want[say(4, fa)] = "empty_answer"
    want[say(5, tasks[5][1])] = "question_copy"
    want[say(6, "Question: " + tasks[6][1][:-12])] = "question_copy"
    want[say(7, "La casa de la playa fue movida por el viento y por las olas.", "")] = "other_language"
    want[say(8, "Старый порт хранил остров за маяк.", "Порт хранил остров.")] = "other_language"
    say(8, "La casa de la playa fue movida por el viento y por las olas.", good)
    want[say(10, "the wheel of the har")] = "truncated_answer"
    want[say(11, "the wheel of the harbor", good + "The quarry was moved by the")] = "truncated_answer"
    want[say(12, "the wheel of the harbor", "The wheel of the ha", '{"answer": "x", "reasoning": "The wheel of the ha')] = "truncated_answer"
    say(999, "the quarry", good)
    say(None, "the quarry", good)
    r = spark.createDataFrame(responses, "response_id bigint, task_key bigint, final_answer string, reasoning string, raw_response string")
    t = spark.createDataFrame(tasks, "task_key bigint, question_text string, choices array<string>, reference_answer string, reference_aliases array<string>")
    got = dict(map(tuple, defects.defects(r, t).collect()))
    assert got == want
    assert defects.defects(r.limit(0), t).count() == 0
    assert defects.defects(r, t.limit(0)).count() > 0


def _tables(spark, responses, n=40):
    v = vocabulary(60, 5)
    tasks = [(k, f"The {v[k]} of the harbor was joined by the {v[k + 7]} and then by the {v[k + 11]}. Which wheel is moved?", ["the wheel of the harbor"], "the wheel of the harbor", None) for k in range(n)]
    r = spark.createDataFrame(responses, "response_id bigint, task_key bigint, final_answer string, reasoning string, raw_response string")
    return r, spark.createDataFrame(tasks, "task_key bigint, question_text string, choices array<string>, reference_answer string, reference_aliases array<string>"), tasks


def test_defects_beside_many_null_task_keys(spark):
    nulls = [(i, None, "the wheel of the harbor", None, "{}") for i in range(150)]
    _, _, tasks = _tables(spark, nulls)
    own = [(1000, 3, tasks[3][1], None, "{}"), (1001, 4, "", None, "{}"), (1002, None, "", None, "{}")]
    hot = [(2000 + i, 5, tasks[5][1] if i == 7 else "the wheel of the harbor", None, "{}") for i in range(150)]
    r, t, _ = _tables(spark, nulls + own + hot)
    assert dict(map(tuple, defects.defects(r, t).collect())) == {1000: "question_copy", 1001: "empty_answer", 1002: "empty_answer", 2007: "question_copy"}


def test_templates_behind_other_first_words(spark):
    base = "I do not feel comfortable choosing an answer at this time"
    said = [(1, 1, base, None, "{}"), (2, 2, "Hmm, " + base, None, "{}"), (3, 3, "Unfortunately, dear friend, " + base, None, "{}"), (4, 4, "the wheel of the harbor", None, "{}")]
    r, t, _ = _tables(spark, said)
    assert dict(map(tuple, defects.defects(r, t).collect())) == {1: "refusal", 2: "refusal", 3: "refusal"}
    assert defects.defects(r.filter("response_id <> 3"), t).filter("defect = 'refusal'").count() == 0


def test_a_wrapped_empty_object_is_no_refusal(spark):
    said = [(i, i, None, None, 'Sure, here is what you asked. {"answer": null}') for i in range(6)] + [(10 + i, i, "", None, "I will not be choosing here, please ask someone else.") for i in range(6)]
    r, t, _ = _tables(spark, said)
    assert dict(map(tuple, defects.defects(r, t).collect())) == dict.fromkeys(range(6), "empty_answer") | dict.fromkeys(range(10, 16), "refusal")


def test_ten_times_the_table_gives_the_same_labels(spark):
    base = "I do not feel comfortable choosing an answer at this time"
    said = [(i, i, base if i % 4 == 0 else "the wheel of the harbor" if i % 4 < 3 else f"the {LETTERS} quarry", None, "{}") for i in range(40)]
    one, t, tasks = _tables(spark, said)
    want = dict(map(tuple, defects.defects(one, t).collect()))
    more = [(1000 * k + r[0], 1000 * k + r[1], *r[2:]) for k in range(10) for r in said]
    grown = [(1000 * k + x[0], x[1] + f" Round {k}?", *x[2:]) for k in range(10) for x in tasks]
    r, t2 = spark.createDataFrame(more, one.schema), spark.createDataFrame(grown, t.schema)
    assert dict(map(tuple, defects.defects(r, t2).collect())) == {1000 * k + i: d for k in range(10) for i, d in want.items()}


def test_longer_openings_cluster_with_one_shingle_less(spark, monkeypatch):
    monkeypatch.setattr(defects, "OPENING", 12)
    ws = [f"w{i}" for i in range(12)]
    texts = [" ".join(ws), " ".join(ws[:11]), " ".join(ws[1:]), " ".join([*ws[:6], "x", *ws[7:]]), "other words"]
    got = dict(map(tuple, defects.clusters(spark.createDataFrame([(x,) for x in texts], "opening string")).collect()))
    assert len(got) == 5 and got[texts[0]] == got[texts[1]] == got[texts[2]] and len(set(got.values())) == 3


def test_openings_that_differ_in_one_word_are_one_template(spark):
    say = lambda i, fa: (i, i, fa, None, "{}")
    one = [say(i, f"My rules forbid judging {w} questions today") for i, w in enumerate(("such", "those", "your"))]
    two = [say(10 + i, f"Perhaps nobody {a} these {b} could settle") for i, (a, b) in enumerate((("with", "means"), ("having", "tools"), ("using", "methods")))]
    r, t, _ = _tables(spark, one + two + [say(30, "the wheel of the harbor")])
    assert dict(map(tuple, defects.defects(r, t).filter("defect = 'refusal'").collect())) == dict.fromkeys(range(3), "refusal")
    assert defects.defects(r.filter("response_id <> 2"), t).filter("defect = 'refusal'").count() == 0


def test_links_of_openings(spark):
    texts = ["a b c d e f", "a b x d e f", "a b c d e y", "a b c d e", "b c d e f g", "a z x d q f", "_ _ _ d e f", "_ _ _ d e g", "a b c"]
    pairs = [(x, p) for p, x in enumerate(texts)] + [(texts[0], 20), (texts[2], 21)]
    df = spark.createDataFrame(pairs, "opening string, prompt bigint")
    got = dict(map(tuple, defects.clusters(df.select("opening")).collect()))
    assert len({got[x] for x in texts[:4]}) == 1 and len(set(got.values())) == 6
    # Without the third word two prompts have them, without the sixth one five.
    got = dict(map(tuple, defects.clusters(df, 4).collect()))
    assert got[texts[0]] == got[texts[2]] == got[texts[3]] != got[texts[1]] and len(set(got.values())) == 7


def test_leaks_of_a_passage_that_many_items_share(spark):
    v, noise = vocabulary(400, 3), vocabulary(200, 9)
    first, passage = v[:9], v[10:40]
    items = [(i, " ".join(first) + ". " + " ".join(passage + v[50 + 9 * i : 59 + 9 * i])) for i in range(12)]
    docs = [(1, " ".join(noise[:30] + passage[:25] + noise[30:60])), (2, " ".join(first + passage[:11])), (3, " ".join(passage[:12]))]
    df, its = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    assert {tuple(r) for r in leaks.leaks(df, its).collect()} == {(d, i) for d in (1, 2) for i in range(12)}


@pytest.mark.parametrize("share", [2, 3, 4, 5, 6, 20, 50])
def test_leaks_however_many_items_share_the_passage(spark, share):
    rnd = random.Random(share)
    v, noise = vocabulary(3000, 3), vocabulary(200, 9)
    passage, sentence = v[:60], v[60:120]
    items = [(i, " ".join(passage + v[200 + 12 * i : 212 + 12 * i])) for i in range(share)]
    items += [(100 + i, " ".join(sentence) + ". " + " ".join(v[1000 + 12 * i : 1012 + 12 * i])) for i in range(share)]
    items += [(1000 + i, " ".join(rnd.sample(v, 40))) for i in range(100 - share)]
    docs = [(1, " ".join(noise[:30] + passage + noise[30:60])), (2, " ".join(noise[:30] + sentence[5:50] + noise[30:60])), (3, " ".join(noise))]
    df, its = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    assert {tuple(r) for r in leaks.leaks(df, its).collect()} == {(1, i) for i in range(share)} | {(2, 100 + i) for i in range(share)}


def test_common_seeds_leave_enough_rare_ones():
    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.randint(16, 60)
        owners = [rnd.choice([1, 1, 500, 900]) for _ in range(n)]
        kept, need = leaks.rare_places(owners, 5, leaks.WINDOW)
        gone = np.ones(n, int)
        gone[kept] = 0
        assert all(gone[i : i + leaks.WINDOW].sum() <= 4 for i in range(n)) and all(owners[p] > leaks.COMMON for p in np.flatnonzero(gone))
        assert need == (1 if gone.any() else 5)


def test_leaks_of_short_items(spark):
    v, noise = vocabulary(400, 3), vocabulary(200, 9)
    items, docs, want = [], [], set()
    at = 0
    for m in range(1, 20):
        w = v[at : at + m]
        at += m
        items.append((m, " ".join(w)))
        for edits in range(4):
            x = w[:]
            for k in range(min(edits, m)):
                x[(k + 1) * m // (edits + 1)] = "changed"
            docs.append((100 * m + edits, " ".join(noise[:30] + x + noise[30:60])))
            if edits <= m // 8:
                want.add((100 * m + edits, m))
    for m in (8, 17):  # an edit at the end, a word added, a word missing
        w = items[m - 1][1].split()
        for n, x in enumerate((["changed", *w[1:]], w[:4] + ["added"] + w[4:], w[:3] + w[4:], w[1:])):
            docs.append((10_000 + 10 * m + n, " ".join(noise[:9] + x + noise[9:20])))
            want.add((10_000 + 10 * m + n, m))
    df, its = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    assert {tuple(r) for r in leaks.leaks(df, its).collect()} == want
