"""One consistent form for texts that look the same but differ in code points."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskmill.runtime import cut

# Letters of Cyrillic and Greek that are drawn like Latin ones, in pairs.
CYRILLIC = "аеорсухіѕјһԁԛԝ АВЕКМНОРСТХІЅЈ"
CYRILLIC_LATIN = "aeopcyxisjhdqw ABEKMHOPCTXISJ"
GREEK = "ον ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
GREEK_LATIN = "ov ABEZHIKMNOPTYX"
# The same for Armenian and Cherokee, and the script g of Latin.
OTHERS = "օոսհց ՕՍՏԼ ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏚᏙᏢᏞᏟᏦᏴ ɡ"
OTHERS_LATIN = "onuhg OUSL DRTAJEWMHYGZSVPLCKB g"

#: Default-ignorable code points (Unicode property) as ranges; the joiners are kept apart.
IGNORABLE_RANGES = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200B), (0x200E, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F),
    (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
]
#: Blocks in which a joiner between two characters changes what is drawn: Arabic to Thaana,
#: the Indic scripts, Mongolian, and emoji sequences.
JOINING_RANGES = [(0x0600, 0x08FF), (0x0900, 0x0DFF), (0x1800, 0x18AF), (0x2190, 0x2BFF), (0x1F000, 0x1FAFF)]

_JOINERS = re.compile("[\u200c\u200d]+")


def _look_table() -> dict[int, str | None]:
    """Code point to what stands for it, made from the Unicode data by rule."""
    letters = {a: b for a, b in zip(CYRILLIC + GREEK, CYRILLIC_LATIN + GREEK_LATIN) if a != " "}
    table: dict[int, str | None] = {}
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        kind, _, codes = unicodedata.decomposition(ch).partition(" ")
        if kind in ("<wide>", "<narrow>", "<noBreak>"):
            table[cp] = "".join(chr(int(c, 16)) for c in codes.split())
        elif 0x0370 <= cp < 0x0530 or 0x1F00 <= cp < 0x2000:
            full = unicodedata.normalize("NFD", ch)
            if full[0] in letters:
                table[cp] = unicodedata.normalize("NFC", letters[full[0]] + full[1:])
        elif 0x2160 <= cp < 0x2180 and len(codes) == 4:  # a Roman numeral that is one letter
            table[cp] = chr(int(codes, 16))
        if ch.isspace():
            table[cp] = " "
    table |= {ord(a): b for a, b in zip(OTHERS, OTHERS_LATIN) if a != " "}
    table |= dict.fromkeys((0x85, 0x2028, 0x2029), "\n")
    table |= {c: " " for c in range(0x20) if chr(c).isspace() and c != 0x0A}
    for lo, hi in IGNORABLE_RANGES:
        table |= dict.fromkeys(range(lo, hi + 1))
    return table


_TABLE = _look_table()
#: Documents of one raw text that one task pairs at once.
DOCS_A_BUCKET = 5_000
_ODD_SPACE = re.compile(r"[^\S\n ]")


def _joins(ch: str) -> bool:
    return any(lo <= ord(ch) <= hi for lo, hi in JOINING_RANGES)


def _drop_joiners(s: str) -> str:
    def one(m: re.Match) -> str:
        a, b = m.start() - 1, m.end()
        return m.group() if a >= 0 and b < len(s) and _joins(s[a]) and _joins(s[b]) else ""

    return _JOINERS.sub(one, s)


def look_of(text: str) -> str:
    """The text as drawn: widths, spaces, invisible and look-alike characters made one,
    canonical composition, LF line ends; case, accents, digits and punctuation stay."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if text.isascii():
        return _ODD_SPACE.sub(" ", text)
    if "\u200d" in text or "\u200c" in text:
        text = _drop_joiners(text)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(_TABLE))


#: What stands for a character in the consistent form: as drawn, and no joiner at all.
_FORM_TABLE = _TABLE | dict.fromkeys((0x200C, 0x200D))
_GONE = 0x110000
#: The same as an array: what stands for a code point, or _GONE; longer replacements apart.
_FORM_ARRAY = np.arange(_GONE + 1, dtype=np.uint32)
for _cp, _to in _FORM_TABLE.items():
    _FORM_ARRAY[_cp] = _GONE if not _to else ord(_to[0]) if len(_to) == 1 else _cp
_FORM_LONGER = {chr(cp): to for cp, to in _FORM_TABLE.items() if to and len(to) > 1}
#: Characters that go through the steps as one string.
CHARACTERS = 2_000_000


def _translated(s: str) -> str:
    """``s.translate(_FORM_TABLE)``, for long strings."""
    for c, to in _FORM_LONGER.items():
        if c in s:
            s = s.replace(c, to)
    codes = _FORM_ARRAY[np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return codes[codes != _GONE].tobytes().decode("utf-32-le", "surrogatepass")


def consistent_forms(texts: list[str]) -> list[str]:
    """The consistent form of every text: compatibility composition, one look-alike
    alphabet, no default-ignorable characters, full case folding, single spaces.

    All texts with more than ASCII are joined by a character that none of them holds
    and go through each step as one string, so a step is one native call.
    """
    out = [t if t.isascii() else "" for t in texts]
    wide = [i for i, t in enumerate(texts) if not t.isascii()]
    at = 0
    while at < len(wide):
        end, size = at, 0
        while end < len(wide) and (end == at or size < CHARACTERS):
            size += len(texts[wide[end]])
            end += 1
        some, at = wide[at:end], end
        joined = "".join(texts[i] for i in some)
        # Noncharacters compose with nothing, fold to themselves and are no space.
        sep = next((c for c in ("\uffff", "\ufffe", *map(chr, range(0xFDD0, 0xFDF0))) if c not in joined), None)
        parts = [sep.join(texts[i] for i in some)] if sep else [texts[i] for i in some]
        done = []
        for s in parts:
            s = _translated(unicodedata.normalize("NFKC", s))
            s = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", s).casefold())
            done.append(unicodedata.normalize("NFKC", _translated(s)))
        for i, s in zip(some, done[0].split(sep) if sep else done):
            out[i] = s
    return [" ".join(s.casefold().split()) for s in out]


def consistent_form(text: str | None) -> str | None:
    """The consistent form of one text. Null stays null."""
    return None if text is None else consistent_forms([text])[0]


def normalized(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, form): the consistent form of every text, computed once per distinct
    value of an Arrow batch. Null texts give null, blank ones the empty string."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            enc = b.column(1).dictionary_encode()
            forms = pa.array(consistent_forms(enc.dictionary.to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), forms.take(enc.indices)], [id_col, "form"])

    src = df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("form"))
    return src.mapInArrow(run, f"{id_col} bigint, form string")


def _digest(s: str) -> bytes:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _form_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        enc = b.column(1).dictionary_encode()
        texts = enc.dictionary.to_pylist()
        form = [_digest(f) if f else None for f in consistent_forms(texts)]
        cols = [pa.array(x, pa.binary()).take(enc.indices) for x in (form, [_digest(t) for t in texts])]
        out = pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "form", "raw"])
        yield out.filter(pc.is_valid(out.column(1)))


def _looks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        enc = b.column(1).dictionary_encode()
        texts = enc.dictionary.to_pylist()
        look = pa.array([look_of(t) for t in texts], pa.string()).take(enc.indices)
        raw = pa.array([_digest(t) for t in texts], pa.binary()).take(enc.indices)
        yield pa.RecordBatch.from_arrays([b.column(0), look, raw], ["doc_id", "look", "raw"])


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.filter("doc_id IS NOT NULL AND text IS NOT NULL")


def same_look(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(class_id, raw, doc_id): members of looks that are written in more than one way.

    The consistent form blocks: only texts that share a form with a different text
    are looked at again. Inside a form the exact look (which keeps case, accents
    and punctuation) is compared as text. ``class_id`` is the smallest id of a look.
    Texts that look the same have the same form, so no pair is lost between forms.
    """
    src = _texts(df, id_col, text_col)
    keys = cut(src.mapInArrow(_form_keys, "doc_id bigint, form binary, raw binary"))
    # Copies count once: a form held by a third of all rows is one row an Arrow batch here.
    mixed = keys.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).filter("lo <> hi").select("form")
    again = keys.join(mixed, "form", "left_semi").select("doc_id").distinct()
    looks = src.join(again, "doc_id", "left_semi").mapInArrow(_looks, "doc_id bigint, look string, raw binary")
    classes = looks.groupBy("look").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.min("doc_id").alias("class_id"))
    classes = classes.filter("lo <> hi").select("look", "class_id")
    return looks.join(classes, "look").select("class_id", "raw", "doc_id").distinct()


def same_look_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_a, doc_b): documents whose texts look the same but differ in code points.

    Only the pairs asked for are written out, by pairs of different raw texts of a
    look; the documents of one raw text are dealt to buckets, so that its pairs
    spread over tasks. Null and blank texts are in no pair; repeated rows of one id
    count once; a row of no or several texts is judged by each of them.
    """
    docs = cut(same_look(df, id_col, text_col))
    variants = docs.groupBy("class_id", "raw").agg(F.expr(f"1 + count(*) div {DOCS_A_BUCKET}").alias("k"))
    dealt = docs.join(variants, ["class_id", "raw"]).select("class_id", "raw", "doc_id", F.pmod(F.xxhash64("doc_id"), "k").alias("bucket"))
    pairs = variants.alias("a").join(variants.alias("b"), "class_id").filter("a.raw < b.raw").select(
        "class_id", F.col("a.raw").alias("raw"), F.col("b.raw").alias("raw_b"), F.explode(F.expr("sequence(0, a.k - 1)")).alias("bucket"), F.col("b.k").alias("kb")
    )
    left = pairs.join(dealt, ["class_id", "raw", "bucket"]).select(
        "class_id", F.col("raw_b").alias("raw"), F.col("doc_id").alias("x"), F.explode(F.expr("sequence(0, kb - 1)")).alias("bucket")
    )
    both = left.join(dealt, ["class_id", "raw", "bucket"])
    return both.filter("x <> doc_id").select(F.least("x", "doc_id").alias("doc_a"), F.greatest("x", "doc_id").alias("doc_b")).distinct()


def look_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(class_id, texts, docs): per look with more than one raw text, its smallest id, how
    many different raw texts it has and how many documents."""
    docs = same_look(df, id_col, text_col)
    return docs.groupBy("class_id").agg(F.count_distinct("raw").alias("texts"), F.count_distinct("doc_id").alias("docs"))
