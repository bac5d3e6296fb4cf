"""Question texts as blocks of lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taskmill.functions.answers import answer_label, option_label
from taskmill.functions.text import strip


def _options(choices: Column) -> Column:
    def line(text: Column, i: Column) -> Column:
        label = F.coalesce(answer_label(i), F.concat(F.lit("Option "), (i + 1).cast("string")))
        return F.concat(label, F.lit(". "), F.coalesce(text, F.lit("")))

    return F.array_join(F.transform(choices, line), "\n")


def adapter_prompt(subject: Column, question: Column, choices: Column) -> Column:
    """Subject, question and options; the bare question without choices."""
    block = F.concat(F.lit("Subject: "), subject, F.lit("\n\nQuestion:\n"), question, F.lit("\n\nOptions:\n"), _options(choices))
    return F.when(F.size(choices) > 0, strip(block)).otherwise(question)


def task_prompt(domain: Column, question_type: Column, question: Column, choices: Column) -> Column:
    """Domain, type and question; options for multiple choice."""
    head = F.concat(F.lit("Domain: "), domain, F.lit("\nQuestion Type: "), question_type, F.lit("\n\nQuestion:\n"), question)
    tail = F.when(F.size(choices) > 0, F.concat(F.lit("\n\nOptions:\n"), _options(choices))).otherwise(F.lit("\n\nOptions:"))
    return strip(F.when(question_type == "multiple_choice", F.concat(head, tail)).otherwise(head))


def sample_prompt(question: Column, choices: Column) -> Column:
    """The question and one labelled line a choice."""
    lines = F.transform(choices, lambda t, i: F.concat(option_label(i), F.lit(". "), F.coalesce(strip(t), F.lit(""))))
    return F.array_join(F.concat(F.array(F.concat(F.lit("Question: "), strip(question))), lines), "\n")
