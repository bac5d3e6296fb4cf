"""Answer indices, labels and canonical answers.

Two index rules exist and stay apart: the adapters' rule reads raw answers
(any digits or one letter) and does not check the range; the task reader's
rule needs choices and takes an explicit index first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskmill.functions.text import clean, strip

LEAST, MOST = -(1 << 31), (1 << 31) - 1


def _letter_index(c: Column) -> Column:
    return F.when(F.upper(c).rlike(r"^[A-Z]\z"), F.ascii(F.upper(c)) - F.lit(65))


def whole(c: Column) -> Column:
    """Digits with or without a minus as an int. A number beyond the type becomes its
    greatest or smallest value, which is out of the range of any choices as well."""
    n = F.coalesce(c.try_cast("bigint"), F.when(c.startswith("-"), LEAST).otherwise(MOST))
    return F.greatest(F.least(n, F.lit(MOST)), F.lit(LEAST)).cast("int")


def _digits(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]+\z"), whole(c))


def _position(choices: Column, text: Column) -> Column:
    at = F.array_position(choices, text).cast("int") - 1
    return F.when(at >= 0, at)


def adapter_index(raw: Column, choices: Column, kind: Column | None = None) -> Column:
    """Index of a raw answer: integer, integral float, digits, one letter, or an exact choice.

    ``kind`` is the JSON kind of the raw answer where it is known; booleans have no index.
    """
    text = clean(raw)
    number = F.when(text.rlike(r"^-?[0-9]+\.0+\z"), whole(F.split(text, r"\.")[0]))
    negative = F.when(text.rlike(r"^-[0-9]+\z"), whole(text))
    as_text = F.coalesce(_digits(text), _letter_index(text), _position(choices, text))
    if kind is None:
        return F.when(text != "", as_text).cast("int")
    as_number = F.coalesce(_digits(text), negative, number)
    out = F.when(kind == "boolean", F.lit(None)).when(kind == "number", as_number).when(text != "", as_text)
    return out.cast("int")


def schema_index(answer: Column, index: Column, choices: Column, kind: Column | None = None) -> Column:
    """Index by the reader's rule: none without choices; integers (true counts as 1) as
    they are, a letter or digits, else the exact answer text."""
    text = F.upper(strip(index))
    given = F.coalesce(_letter_index(text), _digits(text))
    if kind is not None:
        number = F.when(strip(index).rlike(r"^-?[0-9]+\z"), whole(strip(index)))
        given = F.when(kind == "boolean", F.when(F.lower(index) == "true", 1).otherwise(0)).when(kind == "number", number).when(kind == "string", given)
    return F.when(F.size(choices) > 0, F.coalesce(given, F.when(answer != "", _position(choices, answer)))).cast("int")


def canonical_answer(raw: Column, index: Column, choices: Column) -> Column:
    """The choice at an index in range, else the cleaned raw answer."""
    inside = (index >= 0) & (index < F.size(choices))
    return F.when(inside, F.get(choices, index)).otherwise(clean(raw))


def answer_label(index: Column) -> Column:
    """A letter for 0 to 25, else null."""
    return F.when((index >= 0) & (index < 26), F.char(index + 65))


def option_label(index: Column) -> Column:
    """Bijective base 26: 0 is A, 25 Z, 26 AA, up to the seven letters of the largest int."""
    def digit(n: Column) -> Column:
        return F.char((n % 26).cast("int") + 65)

    carry = [index.cast("bigint")]
    for _ in range(6):
        carry.append(F.floor(carry[-1] / 26) - 1)
    out = F.lit("")
    for c in carry:
        out = F.concat(F.when(c >= 0, digit(c)).otherwise(F.lit("")), out)
    return F.when(index >= 0, out)


def sampled_answer(raw: Column, choices: Column, kind: Column) -> Column:
    """Answer of a sample as a label: an integer in range (booleans are integers), a valid
    label, digits in range, an exact choice; otherwise the stripped text."""
    n = F.size(choices)
    text = strip(raw)
    as_int = F.when(kind == "boolean", F.when(F.lower(raw) == "true", 1).otherwise(0))
    as_int = F.coalesce(as_int, F.when((kind == "number") & text.rlike(r"^-?[0-9]+\z"), whole(text)))
    spelled = F.when(kind == "boolean", F.initcap(raw)).otherwise(text)
    labels = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), option_label)
    valid = (n > 0) & F.array_contains(labels, F.upper(text))
    digits = _digits(text)
    inside = lambda c: (c >= 0) & (c < n)
    return (
        F.when(as_int.isNotNull(), F.when(inside(as_int), option_label(as_int)).otherwise(spelled))
        .when(kind != "string", spelled)
        .when(valid, F.upper(text))
        .when(inside(digits), option_label(digits))
        .when(F.array_position(choices, text) > 0, option_label(F.array_position(choices, text) - 1))
        .otherwise(text)
    )
