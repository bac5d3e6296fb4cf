"""Evaluation texts leaking into a corpus: n-gram seeds, then alignment.

The items' seeds (runs of up to five words) make a table and a bitmap of fixed
size. One pass over the corpus hashes its words and passes on the seeds that the
bitmap knows; they meet the seed table in a salted join. Common seeds are looked up
only where an item's rare ones may not be enough, which loses no case; pairs of
document and item with enough seeds are aligned (Smith-Waterman), and only
the alignment decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskmill.llm import bitmap
from taskmill.llm.looks import consistent_forms
from taskmill.llm.words import WORD
from taskmill.runtime import cut, stored

#: Words of a seed.
SEED = 5
#: A stretch of so many words of an item counts, with one edit in EDIT_IN of them at most.
STRETCH, EDIT_IN = 20, 8
#: Seeds in the shortest stretch that keeps fewest of them.
WINDOW = 20
#: A short first sentence that this share of the items begins with, and at least so many
#: different texts follow, is an instruction, no content.
STOCK_SHARE, STOCK_LEAST = 0.001, 5
#: A seed of more items than this is common.
COMMON = 100
#: Parts into which the documents that ask for one seed are dealt.
SALTS = 8
MATCH, MISS, GAP = 1, -2, 2

_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,80}>|<!--|-->|&(?:[a-zA-Z]{2,8}|#\d{1,6});")
_ESCAPED = re.compile(r"\\u([0-9a-fA-F]{4})")
_SHORT_ESCAPE = re.compile(r"\\[nrtbf]")


def _bare(text: str | None) -> str:
    """Without markup and JSON escapes."""
    if not text:
        return ""
    if "\\" in text:
        text = _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), text)
        text = _SHORT_ESCAPE.sub(" ", text).encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    return text


def bare_words(texts: list[str | None]) -> list[list[str]]:
    """Words of texts with case, punctuation, markup, JSON escapes and look-alikes made one."""
    return [WORD.findall(f) for f in consistent_forms([_bare(t) for t in texts])]


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        if len(self) > 2_000_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def seed_length(m: int) -> int:
    """Words of a seed such that a case of an item of m words keeps at least one."""
    edits = m // EDIT_IN if m < STRETCH else 0
    return max(1, min(SEED, -(-(m - edits) // (edits + 1))))


def least_seeds(m: int) -> int:
    """Seeds that a case of an item of m words keeps: an edit destroys at most as many as a seed has words."""
    k = seed_length(m)
    lengths = [m] if m < STRETCH else range(STRETCH, min(m, 2 * STRETCH) + 1)
    return max(1, min(n - k + 1 - k * (n // EDIT_IN) for n in lengths))


def seed_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the words at each position and the length - 1 after it."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, length, np.uint64)
    for k in range(length):
        h = (h ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def rare_places(owners: list[int], least: int, window: int) -> tuple[list[int], int]:
    """(places of the seeds to look up, seeds of a case among them at least).

    Any ``window`` seeds in a row hold a case's stretch that keeps ``least`` of them, so
    up to least - 1 in each window may be left out; the most common are.
    """
    n = len(owners)
    dropped = np.zeros(n, bool)
    for p in sorted((p for p in range(n) if owners[p] > COMMON), key=lambda p: -owners[p]):
        lo, hi = max(0, p - window + 1), min(n, p + window)
        dropped[p] = True
        sums = np.convolve(dropped[lo:hi], np.ones(min(window, hi - lo), np.int64), "valid")
        if sums.max() >= least:
            dropped[p] = False
    return np.flatnonzero(~dropped).tolist(), 1 if dropped.any() else least


def whole_item(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether some part of the text is all of the item with at most one edit in EDIT_IN words."""
    n = len(text)
    d = np.zeros(n + 1, np.int64)
    ramp = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        x = np.full(n + 1, i, np.int64)
        x[1:] = np.minimum(d[:-1] + (text != w), d[1:] + 1)
        d = np.minimum.accumulate(x - ramp) + ramp
    return int(d.min()) <= len(item) // EDIT_IN


def aligned_stretch(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether the best local alignment holds STRETCH words of the item in order
    with at most one edit in EDIT_IN words; a shorter item must stand there whole."""
    m, n = len(item), len(text)
    if m < STRETCH:
        return whole_item(item, text)
    need = STRETCH
    h = np.zeros((m + 1, n + 1), np.int32)
    ramp = GAP * np.arange(n + 1)
    for i in range(1, m + 1):
        x = np.zeros(n + 1, np.int64)
        x[1:] = np.maximum(h[i - 1, :-1] + np.where(text == item[i - 1], MATCH, MISS), h[i - 1, 1:] - GAP)
        np.maximum(x, 0, out=x)
        h[i] = np.maximum.accumulate(x + ramp) - ramp
    i, j = divmod(int(h.argmax()), n + 1)
    edits = need // EDIT_IN
    if h[i, j] < need - edits + MISS * edits:
        return False
    # Backwards: words of the item and edits so far; a stretch is any part of the path.
    used = edits = 0
    low = [(0, 0)]
    while i > 0 and j > 0 and h[i, j] > 0:
        if text[j - 1] == item[i - 1] and h[i, j] == h[i - 1, j - 1] + MATCH:
            i, j, used = i - 1, j - 1, used + 1
        elif h[i, j] == h[i - 1, j - 1] + MISS:
            i, j, used, edits = i - 1, j - 1, used + 1, edits + 1
        elif h[i, j] == h[i - 1, j] - GAP:
            i, used, edits = i - 1, used + 1, edits + 1
        else:
            j, edits = j - 1, edits + 1
        low.append((used, edits))
        for u, e in low:
            if used - u < need:
                break
            if (edits - e) * EDIT_IN <= used - u:
                return True
    return False


def carries(item: np.ndarray, text: np.ndarray, pos: np.ndarray, place: np.ndarray, least: int) -> bool:
    """Whether the text carries the item, given the shared seeds (position, place in the item)."""
    drift = len(item) // EDIT_IN + 1
    diagonal = pos - place
    order = np.argsort(diagonal, kind="stable")
    pos, place, diagonal = pos[order], place[order], diagonal[order]
    cuts = np.flatnonzero(np.diff(diagonal) > drift) + 1  # groups of diagonals that edits can bridge
    for p, q in zip(np.split(pos, cuts), np.split(place, cuts)):
        if len(np.unique(q)) < least:
            continue
        # A text that repeats the item has seeds far apart; only near ones are aligned together.
        p = np.sort(p)
        reach = len(item) + SEED + STRETCH + 2 * drift
        for near in np.split(p, np.flatnonzero(np.diff(p) > reach) + 1):
            a, b = max(0, int(near[0]) - len(item) - drift), int(near[-1]) + len(item) + SEED + drift
            if aligned_stretch(item, text[a:b]):
                return True
    return False


def prepared_items(items: DataFrame) -> DataFrame:
    """(item_id, words binary, m): hashed words of each item with words, without a short
    stock sentence at its head. Questions on one passage share its first sentence too,
    but also what follows; only one that many different texts follow is an instruction."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        schema = pa.schema([("item_id", pa.int64()), ("head", pa.string()), ("next", pa.string()), ("whole", pa.binary()), ("tail", pa.binary())])
        for b in batches:
            texts = b.column(1).to_pylist()
            split = [(t or "").partition(".") for t in texts]
            whole, heads, tails = bare_words(texts), bare_words([x[0] for x in split]), bare_words([x[2] for x in split])
            rows = [
                {"item_id": i, "head": " ".join(h) if t and 0 < len(h) < STRETCH else None, "next": " ".join(t[:SEED]), "whole": hashes.of(w).tobytes(), "tail": hashes.of(t).tobytes()}
                for i, w, h, t in zip(b.column(0).to_pylist(), whole, heads, tails)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)

    src = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("item_text").cast("string").alias("item_text")).filter("item_id IS NOT NULL")
    rows = stored(src.mapInArrow(run, "item_id bigint, head string, next string, whole binary, tail binary"))
    least = max(STOCK_LEAST, int(STOCK_SHARE * rows.count()))
    stock = rows.groupBy("head").agg(F.count_distinct("next").alias("n")).filter(F.col("n") >= least).select("head", F.lit(True).alias("stock"))
    words = F.when(F.col("stock"), F.col("tail")).otherwise(F.col("whole"))
    out = rows.join(stock, "head", "left").select("item_id", words.alias("words")).distinct()
    return out.filter(F.length("words") > 0).withColumn("m", (F.length("words") / 8).cast("int"))


def seed_table(items: DataFrame) -> DataFrame:
    """(seed, item_id, place, length, need): the seeds of items to look up."""

    def seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, places, hashed = [], [], [np.zeros(0, np.uint64)]
            for i, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = np.frombuffer(w, np.uint64)
                h = seed_hashes(w, seed_length(len(w)))
                ids += [i] * len(h)
                places += range(len(h))
                hashed.append(h)
            cols = [pa.array(ids, pa.int64()), pa.array(places, pa.int32()), pa.array(np.concatenate(hashed).view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["item_id", "place", "seed"])

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seed", pa.int64()), ("item_id", pa.int64()), ("place", pa.int32()), ("length", pa.int32()), ("need", pa.int32())])
        for b in batches:
            rows = []
            for i, m, listed in zip(*(c.to_pylist() for c in b.columns)):
                listed.sort(key=lambda x: x["place"])
                kept, need = rare_places([x["owners"] for x in listed], least_seeds(m), WINDOW if m >= STRETCH else len(listed))
                rows += [{"seed": listed[p]["seed"], "item_id": i, "place": listed[p]["place"], "length": seed_length(m), "need": need} for p in kept]
            yield pa.RecordBatch.from_pylist(rows, schema)

    every = items.select("item_id", "words").mapInArrow(seeds, "item_id bigint, place int, seed bigint")
    owners = every.groupBy("seed").agg(F.count_distinct("item_id").alias("owners"))
    listed = every.join(owners, "seed").groupBy("item_id").agg(F.collect_list(F.struct("place", "seed", "owners")).alias("listed"))
    listed = items.select("item_id", "m").join(listed, "item_id")
    return listed.mapInArrow(chosen, "seed bigint, item_id bigint, place int, length int, need int")


def _hits(docs: DataFrame, known: np.ndarray, lengths: list[int], least: int) -> DataFrame:
    """One pass over the corpus: (doc_id, text_key, seed, pos) of every seed that the bitmap
    knows, and one row with the hashed ``words`` of each text, of texts that have at least
    ``least`` such seeds, the fewest that a case of any item has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = _WordHashes()
        names = ["doc_id", "text_key", "seed", "pos", "words"]
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            listed = bare_words(texts)
            flat = hashes.of([w for ws in listed for w in ws])
            ends = np.cumsum([len(ws) for ws in listed])
            starts = np.concatenate(([0], ends[:-1]))
            at, seed = [], []
            for k in lengths:
                h = seed_hashes(flat, k)
                hit = np.flatnonzero(bitmap.has(known, h))
                doc = np.searchsorted(ends, hit, "right")
                hit = hit[hit + k <= ends[doc]]  # within one text
                at.append(hit)
                seed.append(h[hit])
            at, seed = np.concatenate(at), np.concatenate(seed)
            doc = np.searchsorted(ends, at, "right")
            enough = np.bincount(doc, minlength=1)[doc] >= least
            at, seed, doc = at[enough], seed[enough], doc[enough]
            own = np.unique(doc)
            keys = {d: xxhash.xxh64_intdigest(flat[starts[d] : ends[d]].tobytes()) - (1 << 63) for d in own.tolist()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()), pa.array([keys[d] for d in doc.tolist()], pa.int64()), pa.array(seed.view(np.int64)),
                 pa.array((at - starts[doc]).astype(np.int32)), pa.nulls(len(at), pa.binary())], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_ids[d] for d in own.tolist()], pa.int64()), pa.array([keys[d] for d in own.tolist()], pa.int64()), pa.nulls(len(own), pa.int64()),
                 pa.nulls(len(own), pa.int32()), pa.array([flat[starts[d] : ends[d]].tobytes() for d in own.tolist()], pa.binary())], names)

    return docs.mapInArrow(run, "doc_id bigint, text_key bigint, seed bigint, pos int, words binary")


def _aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for item, need, seen, text in zip(*(c.to_pylist() for c in b.columns[2:])):
            pos, place = np.array([x["pos"] for x in seen]), np.array([x["place"] for x in seen])
            keep.append(carries(np.frombuffer(item, np.uint64), np.frombuffer(text, np.uint64), pos, place, need))
        yield pa.RecordBatch.from_arrays(b.columns[:2], ["doc_id", "item_id"]).filter(pa.array(keep, pa.bool_()))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id): documents that carry an item or a stretch of it.

    items: (item_id, item_text) of any number; neither they nor the documents pass
    through the driver. The corpus is read once and no text of it is shuffled, only
    the seeds that items have and the hashed words of texts that have any. Null and
    blank texts carry nothing; repeated document rows give one row, rows of one id
    with different texts are each looked at; items without words are no case; no
    items or documents give no rows.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = src.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    its = stored(prepared_items(items))
    seeds = stored(seed_table(its))

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = bitmap.Seen()
        for b in batches:
            seen.add(b.column(0).to_numpy().view(np.uint64))
        yield seen.rows()

    needs = {r[0]: r[1] for r in seeds.groupBy("length").agg(F.min("need")).collect()}  # SEED rows at most
    if not needs:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint")
    known = bitmap.assembled(seeds.select("seed").mapInArrow(marks, bitmap.SLOTS))
    hits = stored(_hits(src, known, sorted(needs), min(needs.values())))
    asked = hits.filter("seed IS NOT NULL").select("doc_id", "text_key", "seed", "pos", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int").alias("salt"))
    salted = seeds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = asked.join(salted, ["seed", "salt"]).groupBy("doc_id", "text_key", "item_id")
    pairs = pairs.agg(F.max("need").alias("need"), F.count_distinct("place").alias("places"), F.collect_set(F.struct("pos", "place")).alias("seen"))
    pairs = cut(pairs.filter("places >= need").select("doc_id", "text_key", "item_id", "need", "seen"))
    texts = hits.filter("words IS NOT NULL").select("doc_id", "text_key", "words").dropDuplicates(["doc_id", "text_key"])
    full = pairs.join(its.select("item_id", F.col("words").alias("item")), "item_id").join(texts, ["doc_id", "text_key"])
    return full.select("doc_id", "item_id", "item", "need", "seen", "words").mapInArrow(_aligned, "doc_id bigint, item_id bigint").distinct()


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, documents): how many documents carry each leaked item."""
    return leaks(docs, items).groupBy("item_id").agg(F.count("*").alias("documents"))
