"""Byte-level BPE ids of whole corpora by prefix-sharing trie traversal.

The last token of a BPE encoding, together with the encoding of what precedes
it, determines the encoding; and ``encode(a + t) == encode(a) + [t]`` exactly if
the last token of ``encode(a)`` and ``t`` stay apart when merged as a pair. So the
encoding of every prefix of a word follows from the last-token states of its
shorter prefixes. Sorted distinct words are a trie in depth-first order: the
states of a shared prefix are kept on a stack and computed once.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct words a worker remembers between batches; beyond it the memory starts anew.
MEMORY_WORDS = 1_000_000


class TrieEncoder:
    """Encodes with a rank file (base64 token, rank) and a pre-tokenising pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.longest = max(map(len, ranks), default=1)
        self.token = {i: b for b, i in ranks.items()}
        self.apart: dict[tuple[int, int], bool] = {}
        self.memory: dict[str, list[int]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain merging: the pair of lowest rank first, leftmost of equals."""
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            pair = parts[at] + parts[at + 1]
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] + parts[i + 1] == pair and ranks[pair] == best:
                    out.append(pair)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [ranks[p] for p in parts]

    def _stay_apart(self, a: int, b: int) -> bool:
        got = self.apart.get((a, b))
        if got is None:
            got = self.apart[a, b] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return got

    def encode_words(self, words: Iterable[str]) -> None:
        """Remembers the ids of the given distinct words."""
        ranks, apart, stay = self.ranks, self.apart, self._stay_apart
        stack: list[int] = []  # last token of each prefix of the current word
        starts: list[int] = []  # where that token begins
        prev = b""
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            if raw in ranks:
                self.memory[word] = [ranks[raw]]
                continue
            keep = len(os.path.commonprefix((prev, raw)))
            keep = min(keep, len(stack))
            del stack[keep:], starts[keep:]
            for end in range(keep + 1, len(raw) + 1):
                for begin in range(max(0, end - self.longest), end):
                    t = ranks.get(raw[begin:end])
                    if t is None:
                        continue
                    if begin == 0:
                        break
                    before = stack[begin - 1]
                    ok = apart.get((before, t))
                    if stay(before, t) if ok is None else ok:
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
                stack.append(t)
                starts.append(begin)
            prev = raw
            ids, end = [], len(raw)
            while end:
                ids.append(stack[end - 1])
                end = starts[end - 1]
            ids.reverse()
            self.memory[word] = ids

    def encode_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts; null and empty ones have no ids."""
        split = self.split
        pieces = [split(t) if t else [] for t in texts]
        if len(self.memory) > MEMORY_WORDS:
            self.memory.clear()
        new = set(chain.from_iterable(pieces)).difference(self.memory)
        if new:
            self.encode_words(new)
        get = self.memory.__getitem__
        offsets, flat = [0], []
        for p in pieces:
            flat.extend(chain.from_iterable(map(get, p)))
            offsets.append(len(flat))
        return np.array(offsets, np.int32), np.array(flat, np.int32)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_encoders: dict[tuple[str, str], TrieEncoder] = {}


def encoder(path: str, pattern: str) -> TrieEncoder:
    """One per worker process, with what it has learnt. The vocabulary is read from
    ``path`` where the worker has it, else from the copy that came with the job."""
    key = (path, pattern)
    if key not in _encoders:
        local = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        _encoders[key] = TrieEncoder(read_ranks(local), pattern)
    return _encoders[key]


def encoded(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """(id, ids array<int>): the token ids of every text, special tokens as plain text.

    Empty and null texts both give an empty list. A map over the scan without a
    shuffle; the vocabulary at ``path`` on the driver is sent to the workers as a file.
    A batch is cut so that a block of texts stays below 16 million characters.
    """
    df.sparkSession.sparkContext.addFile(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < 16_000_000):
                    size += len(texts[end] or "")
                    end += 1
                offsets, ids = enc.encode_texts(texts[at:end])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), lists], [id_col, "ids"])
                at = end

    src = df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"{id_col} bigint, ids array<int>")
