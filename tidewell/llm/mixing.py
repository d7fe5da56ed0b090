"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document has a 60-bit hash. Words are summed by source and the leading ``CELL_BITS`` bits of the hash; running sums over the cells of
a source find the cell where its budget ends, and only that boundary cell is divided further, ``CELL_BITS`` bits at a time, down to one
hash value. A source takes every document as often as its whole size fits into the target, and once more where the hash lies below the
threshold, so the documents of a smaller budget are among those of a larger one. Nothing is sorted but the cells. The document at the
threshold gives as many of its leading words as are still wanted, so that a source misses its target by less than a word, however long its
documents are.

Targets: sources in code-point order, null last, weigh ``weights``, repeating, and share ``percent`` per cent of all words. A target stops
at ``most`` times its source's size; the excess is shared by weight among the others until none is above. That is one level of words per
weight, found from running sums over the sources in order of the size a unit of weight would fill.

Nulls: a null text has no words, a null source is a source, a null id hashes as an empty one. Empty texts take part with size 0. Texts are
counted whole at any length. Repeated rows, equal in id and text, share one hash and so are taken alike; where they lie at the threshold
each gives the same number of words, rounded down. Ties between documents are broken by the hash alone. An empty table gives no rows.
Columns of the input stay, but for those named like an added one, which are replaced.

The histogram has at most 4,096 cells per source and task; per source one row of thresholds is joined to the documents. A source that holds
a third of all rows is summed map-side and never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.store import discard, stored

HASH_DIGITS, CELL_BITS = 15, 12
WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "taken")


def size_of(text: Column) -> Column:
    """The number of words between ASCII white space; of a null text, 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(ident: Column, text: Column) -> Column:
    """The leading 60 bits of the MD5 of id and text."""
    digest = F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place - 1, F.lit(len(weights))) + 1)
    named = per.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    # Were a source and all fuller ones uncapped, each unit of weight would get this much; the highest such level is the true one.
    upto = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(percent) / 100 - F.sum("cap").over(upto) + F.col("cap")) / (
        F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight")
    )
    levelled = named.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levelled.select("source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``times`` all documents are taken, and the ``edge`` hash where one more time ends: of the
    ``edge_words`` words at that hash, ``rest`` are wanted. ``sizes`` has (source, h, size)."""
    goal = F.floor("target")
    times = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    wanted = stored(targets.withColumn("times", times).withColumn("rest", goal - F.col("times") * F.col("source_size")), "mix-targets")
    left, rows, tables = wanted.select("source", "rest"), sizes, []
    for shift in range(4 * HASH_DIGITS - CELL_BITS, -1, -CELL_BITS):
        cell = F.shiftright("h", shift)
        cells = rows.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
        cells = cells.withColumn("before", F.coalesce(before, F.lit(0)))
        edge = cells.join(left.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).filter("before <= rest and before + words > rest")
        edge = stored(edge.select("source", "cell", "words", (F.col("rest") - F.col("before")).alias("rest")), "mix-edge")
        if shift:
            inside = edge.select(F.col("source").alias("of"), "cell")
            rows = stored(rows.join(inside, F.col("source").eqNullSafe(F.col("of")) & (cell == F.col("cell"))).select("source", "h", "size"), "mix-boundary")
            tables.append(rows)
        tables.append(edge)
        left = edge.select("source", "rest")
    last = edge.select(F.col("source").alias("of"), F.col("cell").alias("edge"), F.col("words").alias("edge_words"), F.col("rest").alias("edge_rest"))
    joined = wanted.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    result = stored(joined.select("source", "source_size", "target", "times", "edge", "edge_words", F.col("edge_rest").alias("rest")), "mix-thresholds")
    discard(wanted, *tables)
    return result


def mixed(documents: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2, id_column: str = "doc_id",
          text_column: str = "text", source_column: str = "source") -> DataFrame:
    """All documents with ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes of them, repeats counted."""
    text, source = F.col(f"`{text_column}`"), F.col(f"`{source_column}`").cast("string")
    h = hash_of(F.col(f"`{id_column}`"), text)
    sizes = stored(documents.select(source.alias("source"), h.alias("h"), size_of(text).alias("size")), "mix-sizes")
    plan = thresholds(sizes, source_targets(sizes, weights, percent, most))
    discard(sizes)
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    kept = [c for c in documents.columns if c not in ADDED]
    sized = documents.withColumns({"__size": size_of(text), "__h": h}).join(plan, source.eqNullSafe(F.col("__source")), "left")
    part = F.expr("CAST(CAST(__size AS DECIMAL(19,0)) * CAST(__rest AS DECIMAL(19,0)) DIV __edge_words AS LONG)")
    once = F.when(F.col("__h") < F.col("__edge"), F.col("__size")).when(F.col("__h") == F.col("__edge"), part).otherwise(F.lit(0))
    return sized.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__times") * F.col("__size") + once).cast("long").alias("taken"),
    )


def mixture(chosen: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of the mix from ``mixed``: every document once per ``copy`` (from 1) that it is taken, the last one cut to the words left."""
    text = F.col(f"`{text_column}`")
    copies = chosen.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})")), F.lit(1), left.cast("int")), " ")
    return copies.withColumn(text_column, F.when(left < F.col("size"), cut).otherwise(text))
