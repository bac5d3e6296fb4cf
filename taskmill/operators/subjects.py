"""Subject inference from a token index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskmill.functions.text import subject_name, subject_tokens
from taskmill.runtime import exists

INDEX_SCHEMA = "config string, token string, n bigint"
FALLBACK = "general knowledge"
#: Configurations scored as columns of one row; more are scored as rows.
WIDE = 200
#: Parts into which the rows that hold one token are dealt; the index is small beside them.
SALTS = 8


def token_index(rows: DataFrame, config: str, text: str) -> DataFrame:
    """(config, token, n): how often each token stands in the texts of a configuration.
    Null texts have no tokens; a configuration without tokens has no rows."""
    tokens = rows.select(F.col(config).alias("config"), F.explode(subject_tokens(F.col(text))).alias("token"))
    return tokens.groupBy("config", "token").agg(F.count("*").alias("n"))


def checked_index(index: DataFrame, configs: DataFrame) -> DataFrame:
    """The index as it is; a configuration (``config``) without any token is an error."""
    empty = configs.select("config").distinct().join(index.select("config").distinct(), "config", "left_anti").orderBy("config").first()
    if empty is not None:
        raise ValueError(f"no labelled vocabulary for configuration {empty[0]!r}")
    return index


def cached_index(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The token index kept at ``path``: read if it has any row, else built and written there,
    by configuration and descending count."""
    if exists(spark, path):
        kept = spark.read.schema(INDEX_SCHEMA).parquet(path)
        if not kept.isEmpty():
            return kept
    build().sort("config", F.col("n").desc(), "token").write.mode("overwrite").parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def _salted(index: DataFrame) -> DataFrame:
    return index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def infer_subject(rows: DataFrame, row_id: str, text: str, index: DataFrame) -> DataFrame:
    """(row_id, config, subject, score) of every row.

    The score of a configuration is the sum of its counts over the row's
    distinct tokens; ties go to the first name. No token in the index: the
    fallback subject with score 0 and no configuration. The index is one row a
    token with a column a configuration, so a row's tokens meet it once and one
    partial aggregate a row is shuffled.
    """
    configs = [r[0] for r in index.select("config").distinct().orderBy("config").limit(WIDE + 1).collect()]
    tokens = rows.select(F.col(row_id), F.explode(F.array_distinct(subject_tokens(F.col(text)))).alias("token"))
    tokens = tokens.withColumn("salt", F.pmod(F.xxhash64(row_id), F.lit(SALTS)).cast("int"))
    if len(configs) <= WIDE:
        by_token = index.groupBy("token").agg(
            *[F.sum(F.when(F.col("config").eqNullSafe(c), F.col("n"))).alias(f"c{i}") for i, c in enumerate(configs)]
        )
        sums = tokens.join(_salted(by_token), ["token", "salt"]).groupBy(row_id).agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(configs))])
        if not configs:
            best = sums.select(row_id, F.lit(None).cast("string").alias("config"), F.lit(0).cast("bigint").alias("score"))
        else:
            scores = F.array(*[F.col(f"c{i}") for i in range(len(configs))])
            top = F.array_max(scores)
            names = F.array(*[F.lit(c) for c in configs])
            best = sums.select(row_id, F.get(names, F.array_position(scores, top).cast("int") - 1).alias("config"), top.alias("score"))
    else:
        scored = tokens.join(_salted(index), ["token", "salt"]).groupBy(row_id, "config").agg(F.sum("n").alias("score"))
        best = scored.groupBy(row_id).agg(F.max_by("config", F.struct("score")).alias("_"), F.max("score").alias("score"))
        best = scored.join(best.select(row_id, "score"), [row_id, "score"]).groupBy(row_id, "score").agg(F.min("config").alias("config"))
    best = best.filter("score > 0").select(row_id, "config", "score")
    out = rows.select(row_id).join(best, row_id, "left")
    return out.select(
        row_id, "config", F.when(F.col("config").isNotNull(), subject_name(F.col("config"))).otherwise(FALLBACK).alias("subject"), F.coalesce("score", F.lit(0).cast("bigint")).alias("score")
    )
