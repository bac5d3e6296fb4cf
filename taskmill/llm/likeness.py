"""Exact joins of texts by likeness: prefix filter on rare tokens and their subsets.

Likeness of two texts is words in common over words in either, both counted
with repeats, so a shingle is one word with its occurrence number (a token):
longer runs of words would lose texts whose words are reordered. Tokens are
ordered from rare to common by their counts in the corpus. Two texts with
likeness t or more share ceil(t/(1+t) * (n + m)) tokens, so their first shared
token lies in a short prefix of both; the first k shared tokens lie in prefixes
longer by k - 1. Texts of equal words are one class and meet as one text.

Across two sides (:func:`like_classes` with ``cross``) the prefixes of the held-out
side are an inverted index; training texts send only tokens that the index has
(a bitmap of fixed size tells), probe its lists within their range of sizes, and
never meet each other. Within one table the lists are joined size-aware: in each
list small texts are expanded into their fixed-size token subsets and large ones
scan the list, with the boundary between them chosen by cost
(:func:`_candidates`). Nothing is capped: every pair that reaches the threshold
meets in at least one list, and is verified by its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskmill.llm import bitmap
from taskmill.llm.bitmap import mix as _mix
from taskmill.runtime import shuffle_partitions, stored

#: A token is heavy if it is in more than one of so many texts. There are at most
#: HEAVY_ONE_IN * (words per text) heavy tokens, whatever the size of the corpus.
HEAVY_ONE_IN = 5000
#: Texts expected in one shuffled list; longer lists are shuffled by two to MAX_DEPTH tokens.
LIST_TEXTS = 200_000
#: Cost of expanding a text by one more token, in comparisons of a list scan (measured).
SUBSET_COST = 24
#: Members that a task expands, and comparisons it makes, at once.
BLOCK = 500_000
#: A list partition, which one task holds, takes the lists of so many texts at most on average.
TEXTS_A_PARTITION = 20_000
#: Texts in one block of signatures.
TEXTS_A_BLOCK = 50_000
MAX_DEPTH = 4
#: Bits of the count table that orders light tokens; it is fixed, so what is broadcast
#: never grows.
COUNT_BITS = 20
#: Members of a class that one task expands into pairs at once.
MEMBERS_A_BUCKET = 5_000

_COMMON = np.int64(1) << np.int64(60)


class _Bounds:
    """Sizes of prefixes and overlaps for likeness num/den, in integers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def least_size(self, n):
        return -(-self.num * n // self.den)

    def most_size(self, n):
        return self.den * n // self.num

    def overlap(self, both):
        return -(-self.num * both // (self.num + self.den))

    def probe_last(self, n):
        """Last position of the first shared token in the larger text."""
        return n - self.least_size(n)

    def index_last(self, n):
        """The same in a text that is not the larger one."""
        return n - self.overlap(2 * n)

    def tiny(self, depth):
        """Largest size at which so many shared tokens may be enough."""
        return depth * self.den // self.num


def _pack(a: np.ndarray) -> bytes:
    """Smallest unsigned type, bytes by significance, compressed."""
    import zstandard

    kind = np.min_scalar_type(int(a.max())) if len(a) else np.dtype(np.uint8)
    planes = np.ascontiguousarray(a.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    return np.ascontiguousarray(planes.T).view(f"u{b[0]}").ravel()


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh32_intdigest(word)
        return h


def _tokens(canons: list[str], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, tokens): word hash and occurrence number of every word, text by text.

    Equal hashes of different words only raise the overlap, so they can add
    candidates but never lose a pair; candidates are verified by the words.
    """
    if len(hashes) > 2_000_000:
        hashes.clear()
    get = hashes.__getitem__
    flat: list[int] = []
    sizes = np.empty(len(canons), np.int64)
    for i, c in enumerate(canons):
        ws = c.split(" ")
        sizes[i] = len(ws)
        flat.extend(map(get, ws))
    doc = np.repeat(np.arange(len(canons), dtype=np.uint64), sizes)
    key = np.sort((doc << np.uint64(32)) | np.array(flat, np.uint64))
    at = np.arange(len(key))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    occurrence = at - np.maximum.accumulate(np.where(first, at, 0))
    token = ((key & np.uint64(0xFFFFFFFF)).astype(np.int64) << np.int64(24)) | np.minimum(occurrence, (1 << 24) - 1)
    return sizes, token


def canonical(text: str) -> str:
    """SQL expression of the sorted words of a text, joined by blanks."""
    return f"array_join(sort_array(regexp_extract_all(lower({text}), '[\\\\p{{L}}\\\\p{{N}}]+', 0)), ' ')"


def _token_order(base: DataFrame, total: int) -> _Order:
    """How tokens are ordered: heavy ones one by one by their counts, light ones by the
    size of the count in a table of 2 ** COUNT_BITS hashed counts, then by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            if not b.num_rows:
                continue
            _, token = _tokens(b.column(0).to_pylist(), hashes)
            values, counts = np.unique(token, return_counts=True)
            slot = (_mix(values) >> np.uint64(64 - COUNT_BITS)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(values), pa.array(counts.astype(np.int64))], ["slot", "token", "texts"])

    tokens = base.select("canon").mapInArrow(run, "slot int, token bigint, texts bigint")
    tokens = tokens.groupBy("slot", "token").agg(F.sum("texts").alias("texts"))
    # At most HEAVY_ONE_IN * (words a text) heavy tokens, and 2 ** COUNT_BITS slots.
    is_heavy = F.col("texts") > max(1, total // HEAVY_ONE_IN)
    slots = tokens.groupBy("slot").agg(
        F.sum("texts").alias("texts"), F.collect_list(F.when(is_heavy, F.col("token"))).alias("heavy"), F.collect_list(F.when(is_heavy, F.col("texts"))).alias("counts")
    ).toArrow()
    table = np.zeros(1 << COUNT_BITS, np.uint8)
    texts = slots.column("texts").to_numpy()
    table[slots.column("slot").to_numpy()] = np.minimum(np.log2(np.maximum(texts, 1)).astype(np.int64) + 1, 15)
    flat = [pa.chunked_array([c.flatten() for c in slots.column(n).chunks], pa.int64()).to_numpy().astype(np.int64) for n in ("heavy", "counts")]
    by = np.lexsort((flat[0], flat[1]))
    return _Order(flat[0][by], flat[1][by].astype(np.float64), table, total)


class _Order:
    def __init__(self, heavy: np.ndarray, counts: np.ndarray, table: np.ndarray, total: int):
        by = np.argsort(heavy)
        self.heavy, self.rank, self.counts, self.table, self.total = heavy[by], by.astype(np.int64), counts, table, total

    def places(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the order, expected texts, whether heavy) of each token."""
        slot = (_mix(token) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
        place = (self.table[slot].astype(np.int64) << np.int64(56)) | token
        texts = np.full(len(token), max(1.0, self.total / HEAVY_ONE_IN))
        is_heavy = np.zeros(len(token), bool)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, token), len(self.heavy) - 1)
            is_heavy = self.heavy[at] == token
            rank = self.rank[at[is_heavy]]
            place[is_heavy] = _COMMON | rank
            texts[is_heavy] = self.counts[rank]
        return place, texts, is_heavy


_BLOCK_SCHEMA = "part int, keys binary, docs binary, pos binary, digests binary, bits binary, sides binary, sizes binary, froms binary, pre binary"
#: Lists are known by 30 bits of a hash below the number of tokens they share; lists that
#: fall together only cost time.
_KEY = np.uint64((1 << 30) - 1)


def _level(depth: int) -> np.uint64:
    return np.uint64(depth - 1) << np.uint64(30)


class _Prefixes:
    """The ordered tokens of a block of texts and their postings in lists."""

    def __init__(self, canons: list[str], hashes: _Hashes, order: _Order, bounds: _Bounds, list_texts: int):
        sizes, token = _tokens(canons, hashes)
        doc = np.repeat(np.arange(len(canons)), sizes)
        place, texts, is_heavy = order.places(token)
        by = np.lexsort((place, doc))
        place, texts, is_heavy = place[by], texts[by], is_heavy[by]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        mixed = _mix(place)
        total = order.total
        # One bit a token; tokens that are nearly everywhere tell nothing apart.
        bit = np.where(texts * 5 <= total, np.uint64(1) << (mixed >> np.uint64(58)), np.uint64(0))
        upper = (mixed >> np.uint64(57)) & np.uint64(1) == 1
        halves = [np.bitwise_or.reduceat(np.where(upper == u, bit, np.uint64(0)), starts) for u in (False, True)]
        self.bits = np.stack(halves, axis=1)
        probe = bounds.probe_last(sizes)
        position = np.arange(len(place)) - starts[doc]
        inside = position <= probe[doc]
        long_list = texts > list_texts
        at = np.flatnonzero(inside & ~long_list)
        keys, docs, last = [mixed[at] & _KEY], [doc[at]], [position[at]]
        # Long lists are split by later tokens, the prefix one longer each time, until the
        # expected list is short. Texts too small to share another token stay in the long one.
        now = np.flatnonzero(inside & long_list)
        key, expect, depth = mixed[now], texts[now], 1
        while len(now):
            stay = bounds.least_size(sizes[doc[now]]) <= depth
            keys.append(key[stay] & _KEY | _level(depth))
            docs.append(doc[now[stay]])
            last.append(position[now[stay]])
            found = []
            step = 1
            while len(now):
                ok = (position[now] + step <= probe[doc[now]] + depth) & (position[now] + step < sizes[doc[now]])
                now, key, expect = now[ok], key[ok], expect[ok]
                found.append((now + step, _mix(key ^ (mixed[now + step] >> np.uint64(1))), expect * texts[now + step] / total))
                step += 1
            now, key, expect = (np.concatenate(x) for x in zip(*found))
            depth += 1
            done = (expect <= list_texts) | (depth == MAX_DEPTH)
            keys.append(key[done] & _KEY | _level(depth))
            docs.append(doc[now[done]])
            last.append(position[now[done]])
            now, key, expect = now[~done], key[~done], expect[~done]
        self.key, self.doc, self.pos = np.concatenate(keys), np.concatenate(docs), np.concatenate(last)
        self.sizes, self.starts, self.keep = sizes, starts, np.minimum(sizes, probe + MAX_DEPTH)
        self.code = np.where(is_heavy, place & 0xFFFF, (mixed >> np.uint64(7)).astype(np.int64) & 0xFFFF).astype(np.uint16)


def _index_bitmap(held: DataFrame, order: _Order, bounds: _Bounds) -> np.ndarray:
    """One bit for every list that the index side has a text in."""
    list_texts = LIST_TEXTS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _Hashes(), bitmap.Seen()
        for b in batches:
            if b.num_rows:
                seen.add(_Prefixes(b.column(0).to_pylist(), hashes, order, bounds, list_texts).key)
        yield seen.rows()

    return bitmap.assembled(held.select("canon").mapInArrow(run, bitmap.SLOTS))


def _signature_blocks(base: DataFrame, order: _Order, parts: int, bounds: _Bounds, known: np.ndarray | None = None) -> DataFrame:
    """Columnar blocks, one row per (block of texts, list partition). With ``known``, a
    bitmap, only postings of lists that it has are sent."""
    list_texts, texts_a_block = LIST_TEXTS, TEXTS_A_BLOCK

    def block(digests: list[bytes], sides: np.ndarray, canons: list[str], hashes: _Hashes) -> Iterator[dict]:
        x = _Prefixes(canons, hashes, order, bounds, list_texts)
        key, d, pos = x.key, x.doc, x.pos
        if known is not None:
            there = bitmap.has(known, key)
            key, d, pos = key[there], d[there], pos[there]
        part = (_mix(key) >> np.uint64(20)) % np.uint64(parts)
        dig = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        by = np.lexsort((key, part))
        key, d, pos, part = key[by], d[by], pos[by], part[by]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        for p in range(parts):
            lo, hi = cuts[p], cuts[p + 1]
            if lo == hi:
                continue
            own, local = np.unique(d[lo:hi], return_inverse=True)
            # Only what follows a text's first position in this partition can extend it here.
            froms = np.full(len(own), 1 << 62, np.int64)
            np.minimum.at(froms, local, pos[lo:hi] + 1)
            lens = np.maximum(x.keep[own] - froms, 0)
            take = np.repeat(x.starts[own] + froms - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
            yield {
                "part": p, "keys": _pack(key[lo:hi]), "docs": _pack(local), "pos": _pack(pos[lo:hi]),
                "digests": dig[own].tobytes(), "bits": x.bits[own].tobytes(), "sides": _pack(sides[own]), "sizes": _pack(x.sizes[own]),
                "froms": _pack(froms), "pre": _pack(x.code[take]),
            }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        seen: dict[tuple[bytes, int], str] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            if seen:
                ids = list(seen)
                rows = list(block([i[0] for i in ids], np.array([i[1] for i in ids], np.uint8), list(seen.values()), hashes))
                seen.clear()
                schema = pa.schema([("part", pa.int32()), *((c.split()[0], pa.binary()) for c in _BLOCK_SCHEMA.split(", ")[1:])])
                for r in rows:
                    yield pa.RecordBatch.from_pylist([r], schema)

        size = 0
        for b in batches:
            for dig, side, canon in zip(*(c.to_pylist() for c in b.columns)):
                if (dig, side) not in seen:  # copies of one text count once
                    seen[dig, side] = canon
                    size += len(canon)
                if len(seen) >= texts_a_block or size > 40_000_000:
                    yield from flush()
                    size = 0
        yield from flush()

    return base.select("digest", "side", "canon").mapInArrow(run, _BLOCK_SCHEMA)


class _Texts:
    """The texts of one list partition, copies once."""

    def __init__(self, rows: list[dict], bounds: _Bounds, cross: bool):
        col = lambda c: [_unpack(r[c]) for r in rows]
        pairs = lambda c: np.concatenate([np.frombuffer(r[c], np.uint64).reshape(-1, 2) for r in rows])
        digests, bits = pairs("digests"), pairs("bits")
        sides, sizes = np.concatenate(col("sides")), np.concatenate(col("sizes")).astype(np.int64)
        self.froms = np.concatenate(col("froms")).astype(np.int64)
        self.probe, self.index = bounds.probe_last(sizes), bounds.index_last(sizes)
        self.ends = np.minimum(sizes, self.probe + MAX_DEPTH)
        lens = np.maximum(self.ends - self.froms, 0)
        self.pre = np.concatenate(col("pre"))
        self.pre_start = np.concatenate(([0], np.cumsum(lens)[:-1])) - self.froms
        keys = col("keys")
        base = np.repeat(np.cumsum([0, *(len(r["digests"]) // 16 for r in rows)])[:-1], [len(k) for k in keys])
        self.key = np.concatenate(keys).astype(np.uint64)
        self.doc = np.concatenate(col("docs")).astype(np.int64) + base
        self.pos = np.concatenate(col("pos")).astype(np.int64)
        by = np.lexsort((sides, digests[:, 1], digests[:, 0]))
        s = digests[by]
        again = np.zeros(len(by), bool)
        again[1:] = (s[1:] == s[:-1]).all(axis=1) & (sides[by][1:] == sides[by][:-1])
        copy = np.zeros(len(by), bool)
        copy[by] = again
        keep = ~copy[self.doc]
        self.key, self.doc, self.pos = self.key[keep], self.doc[keep], self.pos[keep]
        self.digests, self.sizes, self.low, self.high = digests, sizes, bits[:, 0].copy(), bits[:, 1].copy()
        self.most, self.least = bounds.most_size(sizes), bounds.least_size(sizes)
        self.held = sides != 0
        self.bounds, self.cross = bounds, cross
        self.counts = {"scanned": 0, "expanded": 0}
        self.set_slack()

    def set_slack(self) -> None:
        """Words that two texts may hold apart, by the sum of their sizes."""
        top = 2 * int(self.sizes.max(initial=0)) + 1
        both = np.arange(min(top, 1 << 20), dtype=np.int64)
        self.table = both - 2 * self.bounds.overlap(both)

    def slack(self, both: np.ndarray) -> np.ndarray:
        if len(both) and int(both.max()) >= len(self.table):
            return both - 2 * self.bounds.overlap(both)
        return self.table[both]


def _candidates(t: _Texts, key: np.ndarray, doc: np.ndarray, pos: np.ndarray, depth: int, out: list[np.ndarray]) -> None:
    """Adds candidate pairs (a << 32 | b, local numbers) of the lists in ``key``.

    Within one table the members of each list are classed by size. A large one scans
    the list: it meets all smaller members whose size is in range, tested by
    positions and bits. A small one is expanded into its subsets, i.e. put into
    the lists of one more shared token. The boundary is the size at which the
    estimated comparisons of the scans and the cost of the subsets are least
    together. Two members so small that ``depth`` tokens may be all they share
    are met by scanning in either case (a pair with a larger member shares more).
    Across two sides only training members scan, and only the held-out members in
    range; all members are expanded if that costs less.
    """
    by = np.lexsort((t.sizes[doc], key))
    key, doc, pos = key[by], doc[by], pos[by]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    run = np.cumsum(first) - 1
    members = np.bincount(run)
    if t.cross:
        held = np.bincount(run, t.held[doc])
        paired = ((held > 0) & (held < members))[run]
    else:
        paired = (members > 1)[run]
    key, doc, pos, first = key[paired], doc[paired], pos[paired], first[paired]
    if not len(key):
        return
    run = np.cumsum(first) - 1
    lists, first = int(run[-1]) + 1, np.flatnonzero(first)
    if t.cross:
        at = np.flatnonzero(t.held[doc])
        asks = np.flatnonzero(~t.held[doc])
    else:
        # Who is met as the smaller text shares its first tokens in a shorter prefix.
        indexed = pos <= t.index[doc] + depth - 1
        at, asks = np.flatnonzero(indexed), np.arange(len(doc))
    sizes = t.sizes[doc]
    place = ((run << 32) | sizes)[at]
    low = np.searchsorted(place, (run[asks] << 32) | t.least[doc[asks]])
    high = np.searchsorted(place, (run[asks] << 32) | np.minimum(t.most[doc[asks]], (1 << 32) - 1), "right") if t.cross else np.cumsum(indexed) - indexed
    scans = np.maximum(high - low, 0)
    room = np.minimum(t.ends[doc] - 1, t.probe[doc] + depth) - pos
    small = np.zeros(len(doc), bool)
    if depth < MAX_DEPTH:
        cost = SUBSET_COST * np.maximum(room, 0)
        if t.cross:
            small = (np.bincount(run[asks], scans, lists) > np.bincount(run, cost, lists))[run]
        else:
            # Members below the boundary pay for subsets, those from it on for scans.
            gain = np.cumsum(scans - cost)
            gain -= np.repeat(np.concatenate(([0], gain[first[1:] - 1])), np.diff(np.append(first, len(run))))
            best = np.maximum.reduceat(gain, first)
            # Sizes up to that of the last member with the greatest gain are small.
            top = np.where((gain == best[run]) & (best[run] > 0), sizes, -1)
            small = sizes <= np.maximum.reduceat(top, first)[run]
    tiny = t.bounds.tiny(depth)
    tiny_end = np.searchsorted(place, (run[asks] << 32) | tiny, "right")
    more = np.where(small[asks], np.where(sizes[asks] <= tiny, np.minimum(tiny_end - low, scans), 0), scans)
    more = np.maximum(more, 0)
    t.counts["scanned"] += int(more.sum())
    scan = np.flatnonzero(more > 0)
    bits, rest = (t.low[doc], t.high[doc]), sizes - pos
    ends, begin_at = np.cumsum(more[scan]), 0
    while begin_at < len(scan):
        done = ends[begin_at - 1] if begin_at else 0
        end = max(begin_at + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        who, n = scan[begin_at:end], more[scan[begin_at:end]]
        a = np.repeat(asks[who], n)
        b = at[np.repeat(low[who] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
        # Tests from the one that drops most; what is left is looked at further.
        apart = np.bitwise_count(bits[0][a] ^ bits[0][b])
        both = sizes[a] + sizes[b]
        ok = np.flatnonzero(apart <= t.slack(both))
        a, b, apart, both = a[ok], b[ok], apart[ok], both[ok]
        apart += np.bitwise_count(bits[1][a] ^ bits[1][b])
        need = t.bounds.overlap(both)
        ok = (apart <= both - 2 * need) & (depth + np.minimum(rest[a], rest[b]) - 1 >= need)
        da, db = doc[a[ok]], doc[b[ok]]
        da, db = da[da != db], db[da != db]
        out.append(np.unique((np.minimum(da, db) << 32) | np.maximum(da, db)))
        begin_at = end
    inner = np.flatnonzero(small & (room > 0))
    room = room[inner]
    t.counts["expanded"] += int(room.sum())
    ends, begin_at = np.cumsum(room), 0
    while begin_at < len(inner):
        done = ends[begin_at - 1] if begin_at else 0
        end = int(np.searchsorted(ends, done + BLOCK, "right"))
        if end < len(inner):  # whole lists only
            end = int(np.searchsorted(run[inner], run[inner[max(end, begin_at)]]))
            if end <= begin_at:
                end = int(np.searchsorted(run[inner], run[inner[begin_at]], "right"))
        m, r = inner[begin_at:end], room[begin_at:end]
        rep = np.repeat(m, r)
        nxt = pos[rep] + 1 + np.arange(len(rep)) - np.repeat(np.concatenate(([0], np.cumsum(r)[:-1])), r)
        code = t.pre[t.pre_start[doc[rep]] + nxt]
        sub = _mix(key[rep] ^ (code.astype(np.uint64) << np.uint64(17)))
        _candidates(t, sub, doc[rep], nxt, depth + 1, out)
        begin_at = end


def _list_pairs(bounds: _Bounds, cross: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[dict]] = {}
        for b in batches:
            for r in b.to_pylist():
                by_part.setdefault(r["part"], []).append(r)
        for part in list(by_part):
            t = _Texts(by_part.pop(part), bounds, cross)
            out: list[np.ndarray] = []
            level = t.key >> np.uint64(30)
            for depth in range(1, MAX_DEPTH + 1):
                sel = level == depth - 1
                if sel.any():
                    _candidates(t, t.key[sel], t.doc[sel], t.pos[sel], depth, out)
            if not out:
                continue
            pairs = np.unique(np.concatenate(out))
            ends = [t.digests[x].view("V16").ravel().tolist() for x in (pairs >> 32, pairs & 0xFFFFFFFF)]
            for at in range(0, len(pairs), 100_000):
                cols = [pa.array([bytes(x) for x in e[at : at + 100_000]], pa.binary()) for e in ends]
                yield pa.RecordBatch.from_arrays(cols, ["da", "db"])

    return run


def _verify(bounds: _Bounds):
    """Keeps the pairs whose words, counted with repeats, overlap enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            known: dict[str, Counter] = {}
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                xs, ys = (known.get(c) or known.setdefault(c, Counter(c.split(" "))) for c in (x, y))
                keep.append((xs & ys).total() >= bounds.overlap(xs.total() + ys.total()))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["da", "db"]).filter(pa.array(keep, pa.bool_()))

    return run


def like_classes(docs: DataFrame, num: int = 7, den: int = 10, cross: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members(digest, side, rec_id), pairs(da, db)): texts with equal words are one
    class; pairs are the verified links between different classes.

    docs: (rec_id bigint, side int, text string). With ``cross`` side 0 is training,
    which probes, any other side is held out, which is indexed, and only texts of
    different sides are linked. Null texts and texts without words are left out;
    an empty table gives empty results; repeated rows of one id are one.
    """
    bounds = _Bounds(num, den)
    side = F.when(F.col("side") == 0, 0).otherwise(1) if cross else F.lit(0)
    base = docs.select("rec_id", side.alias("side"), F.expr(canonical("text")).alias("canon"))
    base = stored(base.filter("rec_id IS NOT NULL AND canon <> ''").withColumn("digest", F.unhex(F.md5("canon"))))
    total = base.count()
    order = _token_order(base, total)
    parts = max(shuffle_partitions(docs.sparkSession), total // TEXTS_A_PARTITION + 1)
    if cross:
        held, training = base.filter("side = 1"), base.filter("side = 0")
        known = _index_bitmap(held, order, bounds)
        blocks = _signature_blocks(held, order, parts, bounds).unionByName(_signature_blocks(training, order, parts, bounds, known))
    else:
        blocks = _signature_blocks(base, order, parts, bounds)
    found = blocks.repartitionById(parts, "part").mapInArrow(_list_pairs(bounds, cross), "da binary, db binary")
    found = found.filter("da <> db").select(F.least("da", "db").alias("da"), F.greatest("da", "db").alias("db")).distinct()
    one = base.groupBy("digest").agg(F.first("canon").alias("canon"))
    first = one.select(F.col("digest").alias("da"), F.col("canon").alias("ca"))
    second = one.select(F.col("digest").alias("db"), F.col("canon").alias("cb"))
    checked = found.join(first, "da").join(second, "db").select("da", "db", "ca", "cb").mapInArrow(_verify(bounds), "da binary, db binary")
    return base.select("digest", "side", "rec_id"), checked


def like_pairs(docs: DataFrame, num: int = 7, den: int = 10, cross: bool = False) -> DataFrame:
    """(key_a, key_b), key_a < key_b: all pairs of records of likeness num/den or more,
    copies included, each once.

    Members of a class are dealt to buckets of MEMBERS_A_BUCKET, and every pair of
    buckets is joined on its own, so a class of any size is spread over tasks.
    """
    members, pairs = like_classes(docs, num, den, cross)
    sizes = members.groupBy("digest").agg(F.count("*").alias("n"))
    buckets = F.coalesce(F.expr(f"1 + n div {MEMBERS_A_BUCKET}"), F.lit(1))
    # Classes of one member have nothing to pair within and one bucket.
    large = sizes.filter("n > 1")
    same = large.select(F.col("digest").alias("da"), F.col("digest").alias("db"))
    split = large.select("digest", buckets.alias("k")).filter("k > 1")
    dealt = members.join(split, "digest", "left").withColumn("k", F.coalesce("k", F.lit(1).cast("bigint")))
    dealt = dealt.select("digest", "side", "rec_id", F.pmod(F.xxhash64("rec_id"), "k").alias("bucket"))
    ends = pairs.unionByName(same)
    for d in ("da", "db"):
        ends = ends.join(split.select(F.col("digest").alias(d), F.col("k").alias(f"k{d}")), d, "left")
        ends = ends.withColumn(f"b{d}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(f"k{d}", F.lit(1).cast("bigint")) - 1)))
    ends = ends.select("da", "bda", "db", "bdb")
    x = dealt.select(F.col("digest").alias("da"), F.col("bucket").alias("bda"), F.col("side").alias("sa"), F.col("rec_id").alias("x"))
    y = dealt.select(F.col("digest").alias("db"), F.col("bucket").alias("bdb"), F.col("side").alias("sb"), F.col("rec_id").alias("y"))
    both = ends.join(x, ["da", "bda"]).join(y, ["db", "bdb"])
    both = both.filter("sa <> sb AND x <> y" if cross else "da <> db AND x <> y OR x < y")
    return both.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()


def like_members(docs: DataFrame, num: int = 7, den: int = 10, cross: bool = False) -> DataFrame:
    """(rec_id, class_id, links): every record with words, the smallest id of the records
    with equal words, and the number of other records it is like (with ``cross`` those of
    the other side). No pair of records is made: links are sums of class sizes."""
    members, pairs = like_classes(docs, num, den, cross)
    members = members.distinct()
    sizes = members.groupBy("digest", "side").agg(F.count("*").alias("n"))
    both = pairs.unionByName(pairs.select(F.col("db").alias("da"), F.col("da").alias("db")))
    own = sizes.select(F.col("digest").alias("da"), F.col("digest").alias("db"), "side", "n")
    near = both.join(sizes.withColumnRenamed("digest", "db"), "db").unionByName(own, allowMissingColumns=True)
    near = near.groupBy(F.col("da").alias("digest"), F.col("side").alias("their")).agg(F.sum("n").alias("n"))
    classes = members.groupBy("digest").agg(F.min("rec_id").alias("class_id"))
    ends = near.groupBy("digest").agg(F.sum(F.when(F.col("their") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("their") == 1, F.col("n")).otherwise(0)).alias("n1"))
    out = members.join(classes, "digest").join(ends, "digest", "left")
    links = F.when(F.col("side") == 0, F.col("n1")).otherwise(F.col("n0")) if cross else F.col("n0") - 1
    return out.select("rec_id", "class_id", F.coalesce(links, F.lit(0).cast("bigint")).alias("links"))
