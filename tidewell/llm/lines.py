"""Fuzzy line deduplication by MinHash, in DataFrame functions alone.

A line's shingles are all its runs of ``SHINGLE_CHARS`` characters; a shorter line is its own run. A hash deals them into ``GROUPS`` groups, and each
group keeps its least member under ``ORDERS`` orders: 64 values, a MinHash sketch. Bands of ``ROWS`` values, each of another group, are buckets. Lines
that share a bucket and enough of their values are candidates; they are verified by the exact Jaccard similarity of all their shingles, linked lines
are joined by distributed union-find, and the first line of each component, by document id and place, stays. Equal lines are one line from the start.
Two lines at a similarity of 0.8 share a band with a probability of 0.99, at 0.85 with 0.999. Sets of up to eight runs are found for certain.

A line is four bytes a character while it is cut, so that a run is a piece of known place, and runs are rows, so that no lambda sees a character
before candidates are verified.

Lines are separated by line feeds. Lines of white space alone, a carriage return included, always stay. A null text stays null and has no
lines; an empty one has one blank line. Very long lines and texts are read whole. A document that loses all its lines keeps its row, with
an empty text. Rows without an id are neither searched nor changed. Rows that share id and text are treated alike; of lines at the same place of
different texts under one id the least by text hash comes first. An empty table gives no rows. The columns of the input stay, but for those
named like an added one, which are replaced; ``n_chars``, where it is there, follows the text. Lines are identified by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.store import cluster, discard, stored

SHINGLE_CHARS = 5
GROUPS, ORDERS = 16, 4
BANDS, ROWS = 12, 5
SMALL = 8
BLOCK = 512
SLACK = 13
WHITE = " \t\r\x0b\x0c"
ADDED = ("lines_in", "lines_dropped")


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, key, place, line) of all lines that are not blank."""
    found = documents.filter("doc_id is not null").select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return found.filter(F.trim("line", F.lit(WHITE)) != "")


def _run(wide: Column, at: Column) -> Column:
    """The hash of the run that begins at a byte of a line in UTF-32."""
    return F.xxhash64(wide.substr(at, F.lit(4 * SHINGLE_CHARS)))


def _starts(wide: Column) -> Column:
    """The bytes, from one, where the runs of a line in UTF-32 begin."""
    return F.sequence(F.lit(1), F.greatest(F.length(wide) - (4 * SHINGLE_CHARS - 1), F.lit(1)), F.lit(4))


def run_hashes(line: Column) -> Column:
    """The hashes of all runs of a line, repeats included. The line is encoded once, although it is used inside a lambda."""
    return F.transform(F.array(F.encode(line, "UTF-32")), lambda wide: F.transform(_starts(wide), lambda at: _run(wide, at)))[0]


def sketched(lines: DataFrame) -> DataFrame:
    """(id, bands, marks) of distinct lines (id, line): the keys of their buckets, and four bits of each value of their sketches in ``ORDERS`` longs.

    A group without runs has no values; it agrees with another such group. Small sets that are similar differ by one member at most, so beside the bands
    they have a bucket for all groups and one for all but each: no such pair is missed.
    """
    wide = lines.withColumn("wide", F.encode("line", "UTF-32"))
    runs = wide.select("id", "wide", F.explode(_starts(F.col("wide"))).alias("at")).select("id", _run(F.col("wide"), F.col("at")).alias("h"))
    least = [F.min(F.shiftleft("h", 14 * k)).alias(f"m{k}") for k in range(ORDERS)]
    groups = runs.groupBy("id", F.col("h").bitwiseAND(F.lit(GROUPS - 1)).cast("int").alias("g")).agg(*least)

    def band(number: int) -> Column:
        """The values ``ROWS * number`` and following; value k is that of group k modulo ``GROUPS``."""
        own = [(k % GROUPS, F.xxhash64(F.lit(k), f"m{k // GROUPS}")) for k in range(number * ROWS, (number + 1) * ROWS)]
        return F.bit_xor(F.coalesce(*[F.when(F.col("g") == g, value) for g, value in own]))

    marks = [F.bit_or(F.expr(f"shiftleft(xxhash64(m{k}) & 15L, 4 * g)")).alias(f"l{k}") for k in range(ORDERS)]
    whole = groups.withColumn("all", F.xxhash64("g", *[f"m{k}" for k in range(ORDERS)]))
    parts = [F.max(F.when(F.col("g") == g, F.col("all"))).alias(f"a{g}") for g in range(GROUPS)]
    rows = whole.groupBy("id").agg(*[band(k).alias(f"b{k}") for k in range(BANDS)], *marks, F.bit_xor("all").alias("every"), F.count("*").alias("filled"), *parts)
    without = F.array(F.col("every"), *[F.col("every").bitwiseXOR(F.col(f"a{g}")) for g in range(GROUPS)])
    bands = F.array(*[F.when(F.col(f"b{k}").isNotNull(), F.xxhash64(F.lit(k), f"b{k}")) for k in range(BANDS)])
    keys = F.when(F.col("filled") <= SMALL, F.concat(bands, F.transform(without, lambda x: F.when(x.isNotNull(), F.xxhash64(F.lit(-1), x))))).otherwise(bands)
    return rows.select("id", F.array_compact(keys).alias("bands"), F.struct(*[f"l{k}" for k in range(ORDERS)]).alias("marks"))


def marks_allow(a: str, b: str, percent: int) -> Column:
    """Whether sketches agree in nearly as many values as sets at the threshold do: ``SLACK`` of 64 fewer are four standard deviations."""

    def differing(k: int) -> Column:
        x = F.col(f"{a}.l{k}").bitwiseXOR(F.col(f"{b}.l{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    return reduce(Column.__add__, map(differing, range(ORDERS))) <= F.lit(GROUPS * ORDERS * (100 - percent) / 100 + SLACK)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of (u, v): those whose lines have 100 * intersection >= percent * union of their sets. ``texts`` has id, line and n, the size of its set."""
    left, right = texts.toDF("u", "a", "na"), texts.toDF("v", "b", "nb")
    both = pairs.join(left, "u").join(right, "v").filter(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
    common = F.size(F.array_intersect(run_hashes(F.col("a")), run_hashes(F.col("b"))))
    return both.filter(F.lit(100 + percent) * common >= F.lit(percent) * (F.col("na") + F.col("nb"))).select("u", "v")


def _block_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """(u, v) of large groups of (grp, id, n, outside, m): those outside with everyone of the group whose marks allow it, in blocks of about ``BLOCK`` lines."""
    of = groups.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    xs = of.filter("outside").select("grp", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("block").alias("bx"), every.alias("by"))
    ys = of.select("grp", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("outside").alias("open"), F.col("block").alias("by"), every.alias("bx"))
    pairs = xs.join(ys, ["grp", "bx", "by"]).filter("x <> y and (not open or x < y)").filter(marks_allow("nx", "ny", percent))
    return pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def duplicate_lines(documents: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, key, place) of all lines to drop. ``documents`` has doc_id, key and text."""
    lines = lines_of(documents).withColumn("id", F.xxhash64("line"))
    sketches = stored(sketched(lines.select("id", "line").dropDuplicates(["id"])), "lines", free=True)

    def with_texts(seen: DataFrame):
        texts = lines.select("id", "line").join(seen.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"])
        texts = stored(texts.withColumn("n", F.size(F.array_distinct(run_hashes(F.col("line"))))), "line-texts", free=True)
        return lambda pairs: confirmed(pairs, texts, percent), [texts]

    in_band = sketches.select(F.col("id").alias("rep"), F.explode("bands").alias("key"))
    marks = sketches.select(F.col("id").alias("rep"), F.col("marks").alias("n"))
    linked = cluster(in_band, lambda a, b: marks_allow(a, b, percent), with_texts, lambda groups, texts: confirmed(_block_pairs(groups, percent), texts, percent), marks)
    # Only lines that stand more than once or are linked can lose a place.
    first = lines.groupBy("id").agg(F.min(F.struct("doc_id", "place", "key")).alias("first"), F.count("*").alias("times"))
    named = first.join(linked, "id", "left").filter("times > 1 or component is not null").select("id", "first", F.coalesce("component", "id").alias("component"))
    named = stored(named, "line-classes", free=True)
    keeper = named.groupBy("component").agg(F.min("first").alias("keeper"))
    keepers = named.join(keeper, "component").select("id", "keeper.doc_id", "keeper.place").toDF("id", "keep_doc", "keep_place")
    drops = lines.select("doc_id", "key", "place", "id").join(keepers, "id").filter((F.col("doc_id") != F.col("keep_doc")) | (F.col("place") != F.col("keep_place")))
    drops = stored(drops.select("doc_id", "key", "place").distinct(), "line-drops", free=True)
    discard(sketches, named)
    return drops


def lines_deduplicated(documents: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without repeated lines, with the columns they came with, and two more: ``lines_in`` and ``lines_dropped``."""
    out = _shortened(documents, percent, id_column, text_column)
    return out.select(*[F.col(f"`{c}`") for c in documents.columns if c not in ADDED], F.col("__in").alias("lines_in"), F.col("__dropped").alias("lines_dropped"))


def without_repeated_lines(documents: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without repeated lines, with exactly the columns they came with."""
    return _shortened(documents, percent, id_column, text_column).select(*[F.col(f"`{c}`") for c in documents.columns])


def _shortened(documents: DataFrame, percent: int, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    plain = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), key.alias("key"), text.cast("string").alias("text"))
    drops = duplicate_lines(plain, percent)
    per_document = drops.groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.collect_set("place").alias("__drops"))
    joined = documents.withColumn("__key2", key).join(
        per_document, (F.col(f"`{id_column}`").cast("long") == F.col("__id")) & (F.col("__key2") == F.col("__key")), "left"
    )
    parts = F.split(text, "\n")
    whole = lambda p: F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("__drops")), lambda k: F.get(p, k))
    # The lines are split once, although they are used inside a lambda.
    kept = F.array_join(F.transform(F.array(parts), whole)[0], "\n")
    out = joined.withColumn("__in", F.when(text.isNull(), 0).otherwise(F.size(parts))).withColumn("__dropped", F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")))
    out = out.withColumn(text_column, F.when(F.col("__dropped") > 0, kept).otherwise(text))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("__dropped") > 0, F.char_length(text).cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
