"""Likeness joins against brute force, on random and on awkward inputs."""

import random
from collections import Counter

import numpy as np
import pytest

from taskmill.llm import likeness
from taskmill.llm.words import words


def like(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    common = sum((x & y).values())
    return common / max(1, sum(x.values()) + sum(y.values()) - common)


def brute(rows, cross, t=0.7):
    rows = [r for r in set(rows) if r[0] is not None and words(r[2])]
    out = set()
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[0] != b[0] and (not cross or a[1] != b[1]) and like(a[2], b[2]) >= t:
                out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


def corpus(seed, n=160):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    rows, last = [], None
    for i in range(n):
        if last and rnd.random() < 0.6:
            ws = list(last)
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randrange(len(ws))
                op = rnd.random()
                if op < 0.4:
                    ws[at] = rnd.choice(vocab)
                elif op < 0.7:
                    ws.insert(at, rnd.choice(vocab[:5]))
                elif len(ws) > 1:
                    ws.pop(at)
            rnd.shuffle(ws)
        else:
            ws = [rnd.choice(vocab[: rnd.choice([3, 60])]) for _ in range(rnd.randint(1, 30))]
        last = ws
        rows.append((i, rnd.randint(0, 1), "  ".join(w.upper() if rnd.random() < 0.3 else w for w in ws)))
    return rows


@pytest.mark.parametrize("cross", [False, True])
@pytest.mark.parametrize("cost,texts", [(24, 200_000), (1, 200_000), (0, 200_000), (0, 1)])
def test_equals_brute_force(spark, monkeypatch, cross, cost, texts):
    monkeypatch.setattr(likeness, "SUBSET_COST", cost)
    monkeypatch.setattr(likeness, "LIST_TEXTS", texts)
    rows = corpus(7 if cross else 8)
    df = spark.createDataFrame(rows, "rec_id bigint, side int, text string")
    got = {tuple(r) for r in likeness.like_pairs(df, cross=cross).collect()}
    assert got == brute(rows, cross) and got


def test_low_threshold_and_tiny_texts(spark, monkeypatch):
    monkeypatch.setattr(likeness, "SUBSET_COST", 0)
    monkeypatch.setattr(likeness, "LIST_TEXTS", 1)
    rows = [(i, 0, t) for i, t in enumerate(["a", "a b", "a b c", "b", "b c", "a a", "c b a d", "a b c d e", "x"] * 3)] + [(100 + r[0], 0, r[2]) for r in corpus(5, 60)]
    df = spark.createDataFrame(rows, "rec_id bigint, side int, text string")
    assert {tuple(r) for r in likeness.like_pairs(df, 1, 2).collect()} == brute(rows, False, 0.5)


def test_awkward_rows(spark):
    long = " ".join(f"z{i % 997}" for i in range(30_000))
    rows = [(1, 0, None), (2, 0, ""), (3, 1, " \n!? "), (4, 0, "one"), (5, 1, "ONE."), (5, 1, "ONE."), (6, 0, long), (7, 1, long + " more"), (None, 1, "one"), (8, 0, "a a a a"), (9, 1, "a a a")]
    df = spark.createDataFrame(rows, "rec_id bigint, side int, text string")
    want = {(4, 5), (6, 7), (8, 9)}
    assert {tuple(r) for r in likeness.like_pairs(df).collect()} == want
    assert {tuple(r) for r in likeness.like_pairs(df, cross=True).collect()} == want
    assert likeness.like_pairs(df.limit(0)).count() == 0 and likeness.like_pairs(df.limit(0), cross=True).count() == 0 and likeness.like_members(df.limit(0)).count() == 0


def test_hot_group_of_copies(spark, monkeypatch):
    rows = [(i, 0, "the same words here") for i in range(40)] + [(100, 1, "the same words here now")]
    df = spark.createDataFrame(rows, "rec_id bigint, side int, text string")
    for bucket in (5_000, 7):
        monkeypatch.setattr(likeness, "MEMBERS_A_BUCKET", bucket)
        assert likeness.like_pairs(df).count() == 40 * 39 // 2 + 40
        assert likeness.like_pairs(df, cross=True).count() == 40


@pytest.mark.parametrize("cross", [False, True])
def test_members_count_links_without_pairs(spark, cross):
    rows = corpus(9, 120)
    rows += [(1000 + i, i % 2, rows[3][2]) for i in range(5)] + [(1000, 0, rows[3][2])]
    df = spark.createDataFrame(rows, "rec_id bigint, side int, text string")
    got = {r["rec_id"]: (r["class_id"], r["links"]) for r in likeness.like_members(df, cross=cross).collect()}
    pairs = brute(rows, cross)
    texts = {r[0]: tuple(sorted(words(r[2]))) for r in rows}
    assert set(got) == set(texts)
    for i, (c, n) in got.items():
        assert c == min(k for k, v in texts.items() if v == texts[i])
        assert n == sum(i in p for p in pairs)


def lists(rows, cross):
    bounds = likeness._Bounds(7, 10)
    canons = [" ".join(sorted(words(r[2]))) for r in rows]
    order = likeness._Order(np.zeros(0, np.int64), np.zeros(0), np.zeros(1 << likeness.COUNT_BITS, np.uint8), len(rows))
    x = likeness._Prefixes(canons, likeness._Hashes(), order, bounds, 10**9)
    t = likeness._Texts.__new__(likeness._Texts)
    t.bounds, t.cross, t.counts, t.sizes = bounds, cross, {"scanned": 0, "expanded": 0}, x.sizes
    t.low, t.high = x.bits[:, 0].copy(), x.bits[:, 1].copy()
    t.index, t.probe, t.ends, t.pre, t.pre_start = bounds.index_last(x.sizes), bounds.probe_last(x.sizes), x.keep, x.code, x.starts
    t.most, t.least = bounds.most_size(x.sizes), bounds.least_size(x.sizes)
    t.held = np.array([r[1] != 0 for r in rows])
    t.set_slack()
    return t, x


def test_small_texts_are_expanded_and_large_ones_scan():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(40)]
    short = [(i, 0, " ".join(rnd.choice(vocab) for _ in range(6))) for i in range(900)]
    large = [(5000 + i, 0, " ".join(rnd.choice(vocab) for _ in range(40 + 8 * i))) for i in range(12)]
    both = [(6000 + i, 0, large[i][2] + " w1") for i in range(3)]
    for rows, expands, scans in ((short, True, False), (large + both, False, True), (short + large + both, True, True)):
        t, x = lists(rows, False)
        out = []
        likeness._candidates(t, x.key, x.doc, x.pos, 1, out)
        got = {(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in np.concatenate(out)}
        assert (t.counts["expanded"] > 0) == expands and (not scans or t.counts["scanned"] > 0)
        at = {r[0]: k for k, r in enumerate(rows)}
        for a, b in brute(rows, False):
            if words(rows[at[a]][2]) != words(rows[at[b]][2]):
                assert tuple(sorted((at[a], at[b]))) in got


def test_training_texts_never_meet_each_other():
    t, x = lists([(i, int(i % 10 == 0), " ".join(f"w{(i + k) % 13}" for k in range(8))) for i in range(300)], True)
    for cost in (0, 6, 10**9):
        old, likeness.SUBSET_COST = likeness.SUBSET_COST, cost
        out = []
        likeness._candidates(t, x.key, x.doc, x.pos, 1, out)
        likeness.SUBSET_COST = old
        pairs = np.concatenate(out)
        assert len(pairs) and (t.held[pairs >> 32] != t.held[pairs & 0xFFFFFFFF]).all()
