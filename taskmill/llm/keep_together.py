"""Splits that keep related records together: a Borůvka forest over shared entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.runtime import cut, shuffle_partitions, stored


class Forest(NamedTuple):
    """edges(u, v) of the persisted forest, labels(node, root), rounds of contraction."""

    edges: DataFrame
    labels: DataFrame
    rounds: int


def _node(kind: str, col: Column) -> Column:
    return F.when(col.isNotNull(), F.xxhash64(F.lit(kind), col.cast("string")))


def _step(df: DataFrame) -> DataFrame:
    """A written table, whose size Spark knows. A checkpoint would carry its plan's size
    estimate on, and that of a table joined to itself is squared in every step."""
    return stored(df)


def spanning_forest(edges: DataFrame) -> Forest:
    """Minimum-edge contraction of an undirected graph (u bigint, v bigint).

    Each round every component picks its smallest edge (order: hash of the two
    original ends, then the ends), the picks become forest edges, and pointer
    doubling finds the new roots. The number of components at least halves, so
    there are at most log2(nodes) rounds; each is written to the checkpoint
    folder. Null ends and loops are no edges; repeated edges are one.
    """
    spark = edges.sparkSession
    e = edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(F.least("u", "v").alias("ou"), F.greatest("u", "v").alias("ov")).distinct()
    e = _step(e.select("ou", "ov", F.xxhash64("ou", "ov").alias("w"), F.col("ou").alias("u"), F.col("ov").alias("v")))
    labels = e.select(F.explode(F.array("u", "v")).alias("node")).distinct().select("node", F.col("node").alias("root"))
    forest = spark.createDataFrame([], "u bigint, v bigint")
    rounds = 0
    while not e.isEmpty():
        rounds += 1
        both = e.unionByName(e.select("ou", "ov", "w", F.col("v").alias("u"), F.col("u").alias("v")))
        best = _step(both.groupBy("u").agg(F.min(F.struct("w", "ou", "ov", "v")).alias("b")).select("u", "b.ou", "b.ov", F.col("b.v").alias("p")))
        forest = forest.unionByName(best.select(F.col("ou").alias("u"), F.col("ov").alias("v")).distinct())
        # Two components that picked the same edge: the smaller one becomes the root.
        up = best.select("u", "p")
        back = up.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        up = _step(up.join(back, "p").select("u", F.when((F.col("pp") == F.col("u")) & (F.col("u") < F.col("p")), F.col("u")).otherwise(F.col("p")).alias("p")))
        while True:
            nxt = _step(up.alias("x").join(up.alias("y"), F.col("x.p") == F.col("y.u")).select(F.col("x.u"), F.col("y.p").alias("p"), (F.col("x.p") != F.col("y.p")).alias("moved")))
            moved = not nxt.filter("moved").isEmpty()
            up = nxt.select("u", "p")
            if not moved:
                break
        labels = _step(labels.join(up, labels.root == up.u, "left").select("node", F.coalesce("p", "root").alias("root")))
        a, b = up.select("u", F.col("p").alias("pu")), up.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        e = _step(
            e.join(a, "u").join(b, "v").filter("pu <> pv")
            .groupBy(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .agg(F.min(F.struct("w", "ou", "ov")).alias("m"))
            .select("m.ou", "m.ov", "m.w", "u", "v")
        )
    return Forest(_step(forest.distinct()), labels, rounds)


class Related(NamedTuple):
    """rows(rec_id, anchor, *keep), roots(anchor, n, root), the forest of what bridges."""

    rows: DataFrame
    roots: DataFrame
    forest: Forest


def related_rows(df: DataFrame, id_col: str, entities: Mapping[str, Column], keep: Sequence[str] = ()) -> Related:
    """Rows with their anchor, and the root of the component of every anchor.

    ``entities`` maps kinds to columns, most telling first; a null value links
    nothing, and a row without any entity is its own component. A row's anchor is
    its first entity. An entity that occurs with one anchor is a leaf, contracted
    by the aggregation that finds it; every entity that bridges anchors is a node
    of the graph, whose forest is built in rounds and persisted. Roots are kept a
    row an anchor, so an anchor of a third of all rows is one row there.
    """
    kinds = list(entities)
    rows = df.select(
        F.col(id_col).cast("bigint").alias("rec_id"),
        *[_node(k, entities[k]).alias(f"n{i}") for i, k in enumerate(kinds)],
        *[F.col(c) for c in keep],
    )
    own = F.xxhash64(F.lit("row"), "rec_id")
    rows = stored(rows.withColumn("anchor", F.coalesce(*[F.col(f"n{i}") for i in range(len(kinds))], own)))
    anchors = rows.groupBy("anchor").agg(F.count("*").alias("n"))
    ends = None
    for i in range(1, len(kinds)):
        n = f"n{i}"
        known = rows.filter(F.col(n).isNotNull() & (F.col(n) != F.col("anchor"))).select(F.col(n).alias("u"), F.col("anchor").alias("v")).distinct()
        ends = known if ends is None else ends.unionByName(known)
    if ends is None:
        ends = df.sparkSession.createDataFrame([], "u bigint, v bigint")
    ends = stored(ends)
    bridges = ends.groupBy("u").agg(F.count("*").alias("k")).filter("k > 1").select("u")
    forest = spanning_forest(ends.join(bridges, "u", "left_semi"))
    roots = anchors.join(forest.labels, anchors.anchor == forest.labels.node, "left").select("anchor", "n", F.coalesce("root", "anchor").alias("root"))
    return Related(rows.select("rec_id", "anchor", *keep), roots, forest)


def running_rows(components: DataFrame) -> DataFrame:
    """Adds ``band``, the power of two of ``rows``, and ``start``, the rows of all
    components before in order of band (large first), hash and root. Ranges of the order
    are summed apart, so no task holds more than one of them."""
    c = components.withColumn("band", F.floor(F.log2(F.col("rows"))).cast("int")).withColumn("_h", F.xxhash64("root", F.lit(11)))
    order = [F.col("band").desc(), F.col("_h"), F.col("root")]
    c = cut(c.repartitionByRange(shuffle_partitions(c.sparkSession), *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")  # one row a partition
    offsets = c.groupBy("_part").agg(F.sum("rows").alias("_rows")).withColumn("_before", before).select("_part", "_before")
    own = F.sum("rows").over(Window.partitionBy("_part").orderBy(*order)) - F.col("rows")
    c = c.withColumn("_own", own).join(F.broadcast(offsets), "_part")
    return c.select("root", "rows", "band", (F.col("_before") + F.col("_own")).alias("start"))


def deal(components: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """(root, rows, split) from (root, rows): systematic dealing inside size bands.

    Components fall into bands by the power of two of their size. A band, in order
    of a hash, is cut at running sums of rows: each split gets the part of the
    band that it still lacks of its share of all rows. What a cut through a
    component of one band leaves over is made up by the bands of smaller ones, so a
    split misses its share by less than a component where small ones remain.
    """
    c = cut(running_rows(components))
    bands = [tuple(r) for r in c.groupBy("band").agg(F.sum("rows"), F.min("start")).orderBy(F.col("band").desc()).collect()]  # 63 at most
    names, whole = list(shares), sum(shares.values())
    left = sum(b[1] for b in bands)
    lack = {k: shares[k] / whole * left for k in names}
    pick = F.lit(names[-1])
    for band, rows, start in bands:
        due = {k: max(0.0, v) for k, v in lack.items()}
        total = sum(due.values()) or 1.0
        at, chosen = float(start), F.lit(names[-1])
        marks = []
        for k in names[:-1]:
            at += due[k] / total * rows
            marks.append((k, at))
        for k, mark in reversed(marks):
            chosen = F.when(F.col("start") + F.col("rows") / 2.0 < mark, k).otherwise(chosen)
        pick = F.when(F.col("band") == band, chosen).otherwise(pick)
        for k, n in c.filter(F.col("band") == band).groupBy(chosen.alias("k")).agg(F.sum("rows")).collect():
            lack[k] -= n
    return c.select("root", "rows", pick.alias("split"))


def assign_splits(df: DataFrame, id_col: str, entities: Mapping[str, Column], shares: Mapping[str, float]) -> DataFrame:
    """(rec_id, root, split): every row, with related rows in one split. Null ids stay."""
    related = related_rows(df, id_col, entities)
    roots = stored(related.roots)
    dealt = deal(roots.groupBy("root").agg(F.sum("n").alias("rows")), shares)
    placed = roots.join(dealt.select("root", "split"), "root").select("anchor", "root", "split")
    return related.rows.join(placed, "anchor").select("rec_id", "root", "split")


def torn(df: DataFrame, id_col: str, entities: Mapping[str, Column], split: Column) -> DataFrame:
    """(value, root, splits): values of the first entity kind whose own rows now lie in
    more than one split, with the root of the component that holds them together.
    Rows without a split or value do not count."""
    first = next(iter(entities))
    src = df.withColumn("_value", entities[first]).withColumn("_split", split)
    related = related_rows(src, id_col, entities, keep=("_value", "_split"))
    rows = related.rows.filter("_value IS NOT NULL AND _split IS NOT NULL")
    seen = rows.groupBy("anchor", "_value").agg(F.sort_array(F.collect_set("_split")).alias("splits")).filter(F.size("splits") > 1)
    return seen.join(related.roots, "anchor").select(F.col("_value").alias("value"), "root", "splits")
