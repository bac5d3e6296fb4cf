"""Adapters from benchmark rows to tasks, and the registry of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskmill.functions.answers import adapter_index, answer_label, canonical_answer
from taskmill.functions.render import adapter_prompt
from taskmill.functions.text import clean, domain_name, non_blank, strip, subject_name, tidy_list, trivia_answer
from taskmill.operators.ordering import interleaved, ranked
from taskmill.operators.subjects import checked_index, infer_subject, token_index
from taskmill.runtime import stored
from taskmill.sources.config import pick_split, subject_configs
from taskmill.sources.schema import TASK_COLUMNS

CAIS_SPLITS = ("auxiliary_train", "dev", "validation")
TRIVIA_SPLITS = ("train", "validation")


def _json(*parts: Column) -> Column:
    """A JSON object of the parts, nulls kept."""
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def built(rows: DataFrame, dataset: str, split: Column, subject: Column) -> DataFrame:
    """Adds the built record: cleaned question and choices, index, canonical answer, prompt."""
    out = rows.withColumn("source_dataset", F.lit(dataset)).withColumn("source_split", split).withColumn("_subject", subject)
    out = out.withColumn("question", clean(F.col("question"))).withColumn("choices", tidy_list(F.col("choices"))).withColumn("raw_answer", F.col("answer"))
    out = out.withColumn("answer_index", adapter_index(F.col("raw_answer"), F.col("choices")))
    out = out.withColumn("answer", canonical_answer(F.col("raw_answer"), F.col("answer_index"), F.col("choices")))
    out = out.withColumn("prompt_text", adapter_prompt(F.col("_subject"), F.col("question"), F.col("choices")))
    return out.drop("subject").withColumnRenamed("_subject", "subject").withColumn("answer_label", answer_label(F.col("answer_index")))


def as_tasks(rows: DataFrame, benchmark: str, question_id: Column, keep: tuple[str, ...] = (), pool: bool = False) -> DataFrame:
    """Task columns of built records or pool records (all multiple choice). The metadata
    holds the record's ``meta`` object, that of a pool record its prompt, too."""
    answer = clean(F.col("answer"))
    prompt = [F.col("prompt_text")] if pool else []
    meta = _json(F.lit(benchmark).alias("benchmark_name"), F.col("source_dataset"), F.col("source_split"), *prompt, F.try_parse_json("meta").alias("source_meta"))
    return rows.select(
        *keep, question_id.alias("question_id"), F.coalesce(non_blank(F.col("source_split")), F.lit("train")).alias("data_split"),
        domain_name(F.col("subject"), F.lit(benchmark)).alias("domain"), F.lit("multiple_choice").alias("question_type"),
        clean(F.col("question")).alias("question_text"), F.coalesce("choices", F.array().cast("array<string>")).alias("choices"), answer.alias("reference_answer"),
        F.col("answer_index").cast("int").alias("reference_answer_index"), F.when(answer != "", F.array(answer)).otherwise(F.array().cast("array<string>")).alias("reference_aliases"),
        meta.alias("metadata"),
    )


def labelled_pool(rows: DataFrame, name: str, dataset: str, split: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Tasks of one labelled split: configurations interleaved round-robin.

    rows: (config, subject, question, choices, answer) and a unique order key.
    """
    subject = F.coalesce(F.nullif(subject_name(F.col("subject")), F.lit("")), subject_name(F.col("config")))
    out = built(rows, dataset, F.lit(split), subject)
    config = F.col("config")
    out = out.withColumn("meta", _json(config.alias("source_subset"), config.alias("source_subject_config"), F.col("raw_answer").alias("original_answer"), F.col("answer_label")))
    out = interleaved(out, "config", order, limit)
    return as_tasks(out, name, F.concat(F.lit(f"{name}::{split}::"), F.col("position")), ("position",))


def unlabelled_pool(rows: DataFrame, index: DataFrame, name: str, dataset: str, split: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Tasks of a split without subjects: inferred from the token index, grouped by
    the inferred configuration (else subject), interleaved round-robin."""
    text = F.concat_ws(" ", clean(F.col("question")), F.array_join(tidy_list(F.col("choices")), " "))
    texts = rows.withColumn("_text", text)
    guess = infer_subject(texts, order[0], "_text", index).select(order[0], F.col("config").alias("_config"), F.col("subject").alias("_guess"), F.col("score"))
    out = built(rows.drop("config"), dataset, F.lit(split), F.lit(None).cast("string")).drop("subject").join(guess, order[0])
    out = out.withColumnRenamed("_guess", "subject").withColumn("_group", F.coalesce("_config", "subject"))
    out = out.withColumn("prompt_text", adapter_prompt(F.col("subject"), F.col("question"), F.col("choices")))
    head, tail = [F.lit("all").alias("source_subset")], [F.col("raw_answer").alias("original_answer"), F.col("answer_label")]
    score, config = F.col("score").alias("subject_inference_score"), F.col("_config").alias("source_subject_config")
    inferred = _json(*head, F.lit("inferred_from_labeled_splits").alias("subject_source"), score, config, *tail)
    default = _json(*head, F.lit("fallback_default").alias("subject_source"), score, *tail)
    out = out.withColumn("meta", F.when(F.col("_config").isNotNull(), inferred).otherwise(default))
    out = interleaved(out, "_group", order, limit)
    return as_tasks(out, name, F.concat(F.lit(f"{name}::{split}::"), F.col("position")), ("position", "score"))


def trivia(rows: DataFrame, name: str, dataset: str, split: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Open questions: rows without a canonical answer are skipped but still counted
    by the position in the fallback id; the limit is on rows that remain."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all rows")
    out = ranked(rows, None, order, "position").withColumn("_a", trivia_answer(F.col("answer"))).filter("_a.value <> ''")
    qid = F.coalesce(F.nullif(F.col("question_id"), F.lit("")), F.concat(F.lit(f"{name}::{split}::"), F.col("position")))
    meta = F.to_json(F.struct(F.lit(name).alias("benchmark_name"), F.lit(dataset).alias("source_dataset"), F.lit(split).alias("source_split")))
    tasks = out.select(
        "position", strip(qid).alias("question_id"), F.lit(split).alias("data_split"), F.lit(name).alias("domain"), F.lit("open_qa").alias("question_type"),
        clean(F.col("question")).alias("question_text"), F.array().cast("array<string>").alias("choices"), F.col("_a.value").alias("reference_answer"),
        F.lit(None).cast("int").alias("reference_answer_index"), F.col("_a.aliases").alias("reference_aliases"), meta.alias("metadata"),
    )
    return tasks if limit is None else tasks.orderBy("position").limit(limit)


def question_pool(rows: DataFrame, name: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Pool records as tasks; ids carry the global position and each row's own split."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all rows")
    out = ranked(rows, None, order, "position", limit)
    qid = F.concat(F.lit(f"{name}::"), F.coalesce("source_split", F.lit("None")), F.lit("::"), F.col("position"))
    return as_tasks(out, name, qid, ("position",), pool=True)


def config_index(rows: DataFrame, config: str, split: str) -> DataFrame:
    """Token index over question and choices of the dev and validation rows."""
    text = F.concat_ws(" ", clean(F.col("question")), F.array_join(tidy_list(F.col("choices")), " "))
    return token_index(rows.filter(F.col(split).isin("dev", "validation")).withColumn("_text", text), config, "_text")


def split_name(c: Column) -> Column:
    """A split's name whatever case, outer spaces and short form it is written in."""
    name = F.lower(strip(c))
    return F.when(name == "val", "validation").otherwise(name)


def of_split(rows: DataFrame, split: str) -> DataFrame:
    """Rows of the split, whatever case, outer spaces and short form ``split`` has; if
    there are none, of the split's other names."""
    return pick_split(rows.withColumn("split", split_name(F.col("split"))), "split", split)


def subject_rows(rows: DataFrame) -> DataFrame:
    """Labelled rows of the configurations that are subjects; none at all is an error."""
    names = subject_configs(rows, "config")
    if names.isEmpty():
        raise ValueError("no subject configurations")
    return rows.join(names, "config", "left_semi")


def mmlu_cais(rows: DataFrame, name: str, dataset: str, split: str | None, order: list[str], limit: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Tasks of one labelled split, or for null of all three splits of rows with a
    ``split`` besides: auxiliary_train by inferred subject, dev and validation by
    configuration. The limit and the positions are per split. The token index is made of
    the labelled rows unless it is given; a configuration without tokens is an error."""
    if split is not None:
        return labelled_pool(rows, name, dataset, split, order, limit)
    parts = {s: of_split(rows, s) for s in CAIS_SPLITS}
    labelled = {s: parts[s].filter("config IS NOT NULL") for s in ("dev", "validation")}
    if index is None:
        both = labelled["dev"].unionByName(labelled["validation"])
        index = checked_index(stored(config_index(both, "config", "split")), both)
    out = unlabelled_pool(parts["auxiliary_train"].drop("split"), index, name, dataset, "auxiliary_train", order, limit).drop("score").withColumn("part", F.lit(0))
    for i, (s, part) in enumerate(labelled.items()):
        out = out.unionByName(labelled_pool(part.drop("split"), name, dataset, s, order, limit).withColumn("part", F.lit(i + 1)))
    return out


def trivia_qa_rc(rows: DataFrame, name: str, dataset: str, split: str | None, order: list[str], limit: int | None = None) -> DataFrame:
    """Tasks of one split, or for null of train and validation of rows with a
    ``split`` besides. The limit and the positions are per split."""
    if split is not None:
        return trivia(rows, name, dataset, split, order, limit)
    train, validation = (trivia(of_split(rows, s), name, dataset, s, order, limit).withColumn("part", F.lit(i)) for i, s in enumerate(TRIVIA_SPLITS))
    return train.unionByName(validation)


ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "mmlu_cais": mmlu_cais,
    "mmlu_auxiliary_train": unlabelled_pool,
    "trivia_qa_rc": trivia_qa_rc,
    "question_pool_mcq": question_pool,
}


def build(adapter: str, *args, **kwargs) -> DataFrame:
    """(part, position, task columns) by the adapter of that name; an unknown name is an
    error. ``part`` numbers the splits of an adapter; rows are in order of both."""
    if adapter not in ADAPTERS:
        raise ValueError(f"unsupported adapter {adapter!r}")
    out = ADAPTERS[adapter](*args, **kwargs)
    return (out if "part" in out.columns else out.withColumn("part", F.lit(0))).select("part", "position", *TASK_COLUMNS)
