"""Text, identifier and alias expressions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip removes.
WS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP = rf"^{WS}+|{WS}+\z"
# What a token of a subject is.
TOKEN = r"[a-z][a-z0-9_+-]{2,}"

# Words that tell nothing about a subject.
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "how", "if", "in", "into", "is", "it", "of", "on", "or",
    "that", "the", "their", "these", "this", "those", "to", "what", "which", "who", "why", "with",
]


def strip(c: Column) -> Column:
    """Without outer white space of any kind; null stays null."""
    return F.regexp_replace(c, STRIP, "")


def clean(c: Column) -> Column:
    """Stripped text, empty for null."""
    return F.coalesce(strip(c), F.lit(""))


def non_blank(c: Column) -> Column:
    """Stripped text, null for blank."""
    return F.nullif(strip(c), F.lit(""))


def clean_list(c: Column) -> Column:
    """Cleaned elements with blank ones dropped, as the task reader has it."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), clean), lambda x: x != "")


def tidy_list(c: Column) -> Column:
    """Cleaned elements with blank ones kept, as the source adapters have it."""
    return F.transform(F.coalesce(c, F.array().cast("array<string>")), clean)


def subject_name(c: Column) -> Column:
    return clean(F.replace(c, F.lit("_"), F.lit(" ")))


def domain_name(c: Column, fallback: Column) -> Column:
    return F.coalesce(F.replace(non_blank(c), F.lit("_"), F.lit(" ")), fallback)


def joined(sep: str, *parts: Column) -> Column:
    """Non-blank parts, stripped, joined by ``sep``."""
    return F.concat_ws(sep, *[non_blank(p) for p in parts])


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix::`` and 16 hex digits of the SHA-256 of the joined parts."""
    return F.concat(F.lit(f"{prefix}::"), F.substring(F.sha2(joined("||", *parts), 256), 1, 16))


def order_key(*parts: Column) -> Column:
    return joined("::", *parts)


def subject_tokens(c: Column) -> Column:
    """Tokens of a lower-cased text without stopwords, repeats kept."""
    found = F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(STOPWORDS))


def trivia_answer(answer: Column) -> Column:
    """struct(value, aliases): aliases, then normalised ones, non-blank with repeats;
    the canonical value comes first if it is not among them. Null answers give "" and []."""
    none = F.array().cast("array<string>")
    listed = F.concat(clean_list(answer["aliases"]), clean_list(answer["normalized_aliases"]))
    value = clean(answer["value"])
    aliases = F.when((value != "") & ~F.array_contains(listed, value), F.concat(F.array(value), listed)).otherwise(listed)
    return F.struct(value.alias("value"), F.when(answer.isNull(), none).otherwise(aliases).alias("aliases"))
