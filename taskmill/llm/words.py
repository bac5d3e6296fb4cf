"""Words, splits and category spellings as the test-data description defines them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Maximal runs of letters and digits.
WORD = re.compile(r"[^\W_]+")

# Split spellings of the data description.
TRAINING = ["train", "auxiliary_train"]
VALIDATION = ["dev", "val", "validation"]
TEST = ["test"]


def words(text: str | None) -> list[str]:
    """Lower-cased words of ``text``; null, empty and blank texts have none."""
    return WORD.findall(text.lower()) if text else []


def split_kind(col: Column) -> Column:
    """``train``, ``validation``, ``test`` or null, ignoring case and outer spaces."""
    s = F.lower(F.regexp_replace(col, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return (
        F.when(s.isin(TRAINING), "train")
        .when(s.isin(VALIDATION), "validation")
        .when(s.isin(TEST), "test")
    )


def category_key(col: Column) -> Column:
    """Lower case with underscores, hyphens and any spacing read as one space."""
    return F.trim(F.regexp_replace(F.lower(col), r"[\s\p{Z}_-]+", " "))


def passage_number(question_id: Column) -> Column:
    """The passage number named in a question id, or null (hash ids, null ids).

    Accepts ``source::split::p12-q3`` with any of ``::`` or ``/`` between the
    parts and ``-q``, ``.q`` or ``_q`` before the question, and ``tq_12--3``.
    """
    digits = F.regexp_extract(
        question_id, r"(?i)(?:^\s*tq_|(?:::|/)\s*p)0*(\d+)\s*(?:--|[-_.]q)\s*\d+\s*$", 1
    )
    return F.when(digits != "", digits).cast("bigint")
