"""Other names under which a row's members are known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accessor name and the task column it stands for.
TASK_ACCESSORS = {
    "seed_id": "question_id", "question": "question_text", "answer": "reference_answer", "answer_index": "reference_answer_index", "answer_aliases": "reference_aliases",
}


def task_accessors() -> list[Column]:
    return [F.col(c).alias(a) for a, c in TASK_ACCESSORS.items()]


def answer_label(meta: Column) -> Column:
    """The answer label that a pool record's meta object names, null if blank or no text."""
    label = F.variant_get(F.try_parse_json(meta), "$.answer_label", "variant")
    text = F.when(F.schema_of_variant(label) == "STRING", F.try_variant_get(label, "$", "string"))
    return F.nullif(text, F.lit(""))
