"""Samples that match target category shares, with a report of what cannot be met."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.llm.words import category_key
from taskmill.runtime import stored

#: Oversampling of the independent draw, in standard deviations of a binomial count.
SLACK = 6.0
#: Bins of the draw value; only the one bin at the cut is ranked.
BINS = 4096
#: What names a target.
BY = ["plan_id", "table_name", "category"]


def needs(targets: DataFrame, counts: DataFrame) -> DataFrame:
    """Targets with ``needed`` and ``have``.

    counts: (table_name, cat, n) over all rows, null categories included.
    The sample size is all rows * sample_permille / 1000 rounded down; needed is
    the larger of min_rows and size * target_permille / 1000 rounded up. Null
    targets count as 0.
    """
    totals = counts.groupBy("table_name").agg(F.sum("n").alias("total"))
    t = targets.select("plan_id", "table_name", "category", "target_permille", "min_rows", "sample_permille", category_key(F.col("category")).alias("cat"))
    t = t.join(totals, "table_name", "left").join(counts, ["table_name", "cat"], "left")
    z = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint"))
    size = F.expr("coalesce(total, 0) * coalesce(cast(sample_permille as bigint), 0) div 1000")
    share = F.expr("(size * coalesce(cast(target_permille as bigint), 0) + 999) div 1000")
    return t.withColumn("size", size).withColumn("needed", F.greatest(z("min_rows"), share)).withColumn("have", z("n"))


def category_counts(rows: DataFrame) -> DataFrame:
    """(table_name, cat, n) of (table_name, category) rows: combined map-side, so an
    uneven category costs nothing."""
    return rows.groupBy("table_name", category_key(F.col("category")).alias("cat")).agg(F.count("*").alias("n"))


def counted(targets: DataFrame, rows: DataFrame) -> DataFrame:
    """Targets with ``needed``, ``have`` and ``drawn``, the rows that :func:`draw` got."""
    n = needs(targets, category_counts(rows))
    got = draw(targets, rows).groupBy("plan_id", "table_name", "category").agg(F.count("*").alias("drawn"))
    return n.join(got, BY, "left").withColumn("drawn", F.coalesce("drawn", F.lit(0).cast("bigint")))


def unmet(targets: DataFrame, rows: DataFrame) -> DataFrame:
    """(plan_id, category, needed, drawn) of the targets that the drawn sample misses."""
    return counted(targets, rows).filter("drawn < needed").select("plan_id", "category", "needed", "drawn")


def report(targets: DataFrame, rows: DataFrame) -> DataFrame:
    """(plan_id, category, needed, have, drawn, deficit) of all targets."""
    n = counted(targets, rows)
    return n.select("plan_id", "category", "needed", "have", "drawn", F.greatest(F.lit(0).cast("bigint"), F.col("needed") - F.col("drawn")).alias("deficit"))


def _accepted(keyed: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Rows accepted with their plan's probability, with the bin of their draw value.
    A table of plans is broadcast only while Spark measures it as small."""
    u = F.pmod(F.xxhash64("rec_id", "plan_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    drawn = keyed.join(plan, ["table_name", "cat"]).withColumn("u", u).filter("u < p")
    return drawn.withColumn("bin", F.floor(F.col("u") / F.col("p") * BINS).cast("int"))


def _histogram(drawn: DataFrame) -> DataFrame:
    return drawn.groupBy(*BY, "bin").agg(F.count("*").alias("c"))


def draw(targets: DataFrame, rows: DataFrame, seed: int = 1) -> DataFrame:
    """(plan_id, table_name, category, rec_id) from rows (table_name, category, rec_id).

    Every row gets an independent uniform value per plan and is accepted below
    its category's probability plus slack; counts are then corrected exactly: a
    histogram of the accepted values finds the bin in which the count is
    reached, and only rows of that bin are ranked. A category of which too few
    rows were accepted (rows of one id stand or fall together) is drawn again
    with probability one. Rows of null ids are no rows; repeated rows are rows of
    their own; targets that repeat are one; empty tables draw nothing.
    """
    keyed = rows.filter("rec_id IS NOT NULL").withColumn("cat", category_key(F.col("category"))).select("table_name", "cat", "rec_id")
    n = needs(targets, category_counts(rows)).filter("needed > 0 AND have > 0")
    p = F.col("needed") / F.col("have")
    slack = SLACK * F.sqrt(F.col("needed").cast("double")) / F.col("have") + SLACK * SLACK / F.col("have")
    plan = stored(n.select(*BY, "cat", "needed", "have", F.least(F.lit(1.0), p + slack).alias("p")).distinct())
    hist = stored(_histogram(_accepted(keyed, plan, seed)))
    got = hist.groupBy(*BY).agg(F.sum("c").alias("accepted"))
    short = plan.join(got, BY, "left").filter("p < 1 AND coalesce(accepted, 0) < least(needed, have)").select(*BY, F.lit(1.0).alias("again"))
    if not short.isEmpty():
        plan = stored(plan.join(short, BY, "left").withColumn("p", F.coalesce("again", "p")).drop("again"))
        redo = plan.join(short.select(*BY), BY, "left_semi")
        hist = stored(hist.join(short, BY, "left_anti").unionByName(_histogram(_accepted(keyed, redo, seed))))
    upto = F.sum("c").over(Window.partitionBy(*BY).orderBy("bin"))
    cuts = hist.withColumn("before", upto - F.col("c")).join(plan.select(*BY, "needed"), BY).filter("before < needed")
    cuts = cuts.select(*BY, "bin", (F.col("needed") - F.col("before")).alias("room"), "c")
    kept = _accepted(keyed, plan, seed).join(cuts, [*BY, "bin"])
    edge = kept.filter("c > room").withColumn("r", F.row_number().over(Window.partitionBy(*BY, "bin").orderBy("u", "rec_id"))).filter("r <= room")
    cols = [*BY, "rec_id"]
    return kept.filter("c <= room").select(*cols).unionByName(edge.select(*cols))
