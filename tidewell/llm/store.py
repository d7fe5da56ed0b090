"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ORDERS = 4
SMALL_GROUP = 64


def stored(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts the lineage and survives lost executors.

    Shuffle files of what led here are of no use once the rows are written. Spark removes them at the end of the write, when a setting asks for it,
    instead of when the driver happens to collect its garbage. ``free`` also collects the driver's garbage, for broadcast tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_path = path
    if free:
        gc.collect()
        spark._jvm.System.gc()
    return back


def discard(*frames: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(id, component): the smallest id reachable from each endpoint of an edge. Ids are longs; nulls and loops are ignored.

    Contraction: every node points to itself or a neighbour, whichever ranks first, and edges are carried over to those. Even levels rank
    by degree, so stars fold into their centres at once; odd levels by hash alone, which removes a fixed share of the nodes in expectation
    whatever the shape of the graph. Levels end when no edge is left. Grouping is by partial aggregates, and joins are plain
    equi-joins, so a hub is no single task's work.
    """
    spark = edges.sparkSession
    found = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).filter("u <> v").distinct()
    left_over = stored(found, "edges")
    levels: list[DataFrame] = []
    while not left_over.isEmpty():
        seed = F.lit(len(levels))
        both = left_over.select("u", "v").union(left_over.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if len(levels) % 2 == 0:
            both = both.join(both.groupBy(F.col("u").alias("v")).agg(F.count("*").alias("d")), "v")
        else:
            both = both.withColumn("d", F.lit(0).cast("long"))
        own = F.struct((F.count("*") if len(levels) % 2 == 0 else F.lit(0).cast("long")).alias("d"), F.xxhash64("u", seed).alias("h"), F.col("u").alias("id"))
        near = F.max(F.struct(F.col("d"), F.xxhash64("v", seed).alias("h"), F.col("v").alias("id")))
        step = both.groupBy("u").agg(F.greatest(near, own).getField("id").alias("to")).select(F.col("u").alias("id"), "to")
        # Follow the pointers one step further: fewer levels.
        step = stored(step.join(step.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")), "step")
        levels.append(step)
        next_edges = (
            left_over.join(step.toDF("u", "a"), "u").join(step.toDF("v", "b"), "v")
            .filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        )
        before, left_over = left_over, stored(next_edges, "edges")
        discard(before)
    discard(left_over)
    if not levels:
        return spark.createDataFrame([], "id long, component long")
    roots = levels[-1]
    for step in reversed(levels[:-1]):
        roots = step.join(roots.toDF("to", "root"), "to", "left").select("id", F.coalesce("root", "to").alias("to"))
    least = roots.groupBy("to").agg(F.min("id").alias("component"))
    result = stored(roots.join(least, "to").select("id", "component"), "components")
    discard(*levels)
    return result


def forest(similar: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the similarity matrix of rows ``a`` and columns ``b`` joins, at most one fewer than there are vectors."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    rows, columns = np.nonzero(similar)
    if not len(rows):
        return edges
    first = np.full(similar.shape[1], -1)
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    for k, at in enumerate(starts):
        own = columns[at : starts[k + 1] if k + 1 < len(starts) else len(columns)]
        row = rows[at]
        fresh = own[first[own] < 0]
        first[fresh] = row
        linked = np.unique(first[own[first[own] >= 0]])
        targets = [int(a[x]) for x in linked if x != row] + [int(b[x]) for x in fresh]
        for other in targets:
            p, q = root(int(a[row])), root(other)
            if p != q:
                parent[max(p, q)] = min(p, q)
                edges.append((int(a[row]), other))
    return edges


def cluster(in_band: DataFrame, can_link: Callable, prepare: Callable, settle: Callable | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """(id, component) of the links found in buckets of (rep, n, key): every ``key`` is a bucket of ``rep`` ids with sizes ``n``.
    Wide ``n`` come as ``sizes`` of (rep, n) instead, and only members of shared buckets get theirs.

    A bucket proposes stars, never all its pairs. Each round picks a centre for every bucket, by a hashed order of the ids, and compares it
    with the members that are not in its class yet, so large groups of similar documents end as one class. The first round has one order,
    so that buckets with the same members have the same centre; later ones have ``ORDERS``. When a round confirms less than a twentieth of
    its pairs, stars have done their work: members still outside the class of their centre are compared with the bucket's members of other
    classes. No link inside a bucket is lost, however the stars fell. With ``settle`` they are compared with all of the centre's class and
    all others outside it: groups of up to ``SMALL_GROUP`` ids form pairs for this, at most that many per id; larger ones go to ``settle``
    as (grp, id, outside, m), which compares block by block and returns enough links (u, v) to join what it finds.
    ``can_link(a, b)`` is a condition on two size columns. ``prepare(reps)`` gets the distinct members of shared buckets and returns
    (confirm, stored tables to drop at the end), where ``confirm`` keeps the true links among pairs (u, v) with u < v.
    """
    shared = in_band.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    members = in_band.join(shared, "key")
    members = stored(members if sizes is None else members.join(sizes, "rep"), "members", free=True)
    reps = members.select("rep").distinct()
    confirm, kept = prepare(reps)
    names = stored(reps.select("rep", F.col("rep").alias("label")), "names")

    def joined(names: DataFrame, links: DataFrame) -> DataFrame:
        """The classes after joining those that new links connect. A label is the least id of its class."""
        ends = links.join(names.toDF("u", "lu"), "u").join(names.toDF("v", "lv"), "v")
        least = components(ends, "lu", "lv").toDF("label", "component")
        after = stored(names.join(least, "label", "left").select("rep", F.coalesce("component", "label").alias("label")), "names")
        discard(names)
        return after

    def around(names: DataFrame, number: int) -> DataFrame:
        """Members outside the class of their bucket's centre of this round, with the centre."""
        orders = ORDERS if number else 1
        order = F.struct(F.xxhash64("rep", F.lit(number * ORDERS) + F.pmod("key", F.lit(orders))), F.col("rep"))
        named = members.join(names, "rep")
        centres = named.groupBy("key").agg(F.min_by(F.struct("rep", "n", "label"), order).alias("c"))
        return named.join(centres, "key").filter(F.col("label") != F.col("c.label")).select("key", "rep", "n", "label", "c")

    number, productive = 0, True
    while productive:
        stars = around(names, number).filter(can_link("n", "c.n")).select(F.least("rep", "c.rep").alias("u"), F.greatest("rep", "c.rep").alias("v"))
        stars = stored(stars.distinct(), "stars")
        found = stored(confirm(stars), "links", free=True)
        kept += [stars, found]
        links = found.count()
        productive = links * 20 >= stars.count() > 0
        if links:
            names = joined(names, found)
        number += 1
    left = around(names, 0)
    if settle is None:
        xs = left.select("key", F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("label").alias("lx"), F.col("c.label").alias("lc"))
        ys = members.join(names, "rep").select("key", F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("label").alias("ly"))
        pairs = xs.join(ys, "key").filter("lx <> ly and (ly = lc or x < y)")
    else:
        outside = left.select(F.col("c.label").alias("grp"), F.col("rep").alias("id"), "n").distinct()
        sizes = members.select("rep", "n").distinct()
        inside = names.withColumnRenamed("label", "grp").join(outside.select("grp").distinct(), "grp").join(sizes, "rep").select("grp", F.col("rep").alias("id"), "n")
        groups = stored(outside.withColumn("outside", F.lit(True)).union(inside.withColumn("outside", F.lit(False))), "groups")
        kept.append(groups)
        counted = groups.groupBy("grp").agg(F.count("*").alias("m"))
        small = groups.join(counted.filter(F.col("m") <= SMALL_GROUP), "grp")
        xs = small.filter("outside").select("grp", F.col("id").alias("x"), F.col("n").alias("nx"))
        ys = small.select("grp", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("outside").alias("open"))
        pairs = xs.join(ys, "grp").filter("x <> y and (not open or x < y)")
    open_links = confirm(pairs.filter(can_link("nx", "ny")).select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct())
    if settle:
        open_links = open_links.union(settle(groups.join(counted.filter(F.col("m") > SMALL_GROUP), "grp"), kept[0]))
    found = stored(open_links, "links")
    if not found.isEmpty():
        names = joined(names, found)
    discard(members, found, *kept)
    return names.toDF("id", "component")
