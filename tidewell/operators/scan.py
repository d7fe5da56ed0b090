"""Ordered computations inside groups that stay safe when one group is huge.

A plain window sends each group to one task. ``scan`` counts the groups first and
uses plain windows while every group is small. When some group holds more than
``hot_rows`` rows it splits the data by range of (keys, order) instead: each block is
computed on its own, one summary row per (key, block) carries the prefix forward, and
the last rows of a block are lent to the next one for lag, lead and moving frames.
Both ways give the same result, so the choice is one of cost only. ``ranks`` does the same for ranks in several groupings at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import durable, forget, slice_count, slices, stored

HOT_ROWS_CONF = "spark.tidewell.hotGroupRows"
HOT_ROWS_DEFAULT = 5_000_000

#: Blocks by value have about so many rows, and are no more than that.
VALUE_BLOCK_ROWS = 500_000
MAX_VALUE_BLOCKS = 4096

_BLOCK = "__block"
_ROW = "__row"


def hot_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group; only partial counts are shuffled.

    Scans add columns and no rows, so a scan of a scan counts the frame that the first one began with, without what was computed since, and
    groups by the same keys are counted once.
    """
    root = df.__dict__.get("_scanned", df)
    root = root if set(keys) <= set(root.columns) else df
    sizes = root.__dict__.setdefault("_group_sizes", {})
    name = tuple(sorted(keys))
    if name not in sizes:
        sizes[name] = (root.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0) if keys else root.count()
    return sizes[name]


def count_groups(df: DataFrame, *key_sets: Sequence[str]) -> DataFrame:
    """Count the groups of several key sets in one pass over ``df``, from the rows per combination of keys; later scans find them counted."""
    every = sorted({k for keys in key_sets for k in keys})
    root = df.__dict__.get("_scanned", df)
    root = root if set(every) <= set(root.columns) else df
    sizes = root.__dict__.setdefault("_group_sizes", {})
    names = [n for n in dict.fromkeys(tuple(sorted(keys)) for keys in key_sets) if n not in sizes]
    if len(names) > 1:
        cells = root.groupBy(*every).agg(F.count(F.lit(1)).alias("__n"))
        sets = [F.struct(F.lit(i).alias("i"), *[(F.col(k) if k in name else F.lit(None)).alias(k) for k in every]) for i, name in enumerate(names)]
        groups = cells.select("__n", F.explode(F.array(*sets)).alias("__set")).groupBy("__set").agg(F.sum("__n").alias("__n"))
        found = {r["i"]: r["n"] for r in groups.groupBy(F.col("__set.i").alias("i")).agg(F.max("__n").alias("n")).collect()}
        sizes.update({name: found.get(i, 0) for i, name in enumerate(names)})
    return df


def _from(df: DataFrame, out: DataFrame) -> DataFrame:
    """``out`` as a frame with the rows of ``df`` and further columns."""
    out._scanned = df.__dict__.get("_scanned", df)
    return out


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``"-name"`` sorts descending with nulls last, ``"name"`` ascending with nulls first."""
    return [F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_first() for o in order]


@dataclass(frozen=True)
class Prefix:
    """A running value: ``local(window)`` inside a block, ``carry(column, window)`` over blocks."""

    local: Callable
    carry: Callable
    merge: Callable


@dataclass(frozen=True)
class Near:
    """A value that looks at most ``reach`` rows back or ahead."""

    value: Callable
    back: int
    ahead: int


@dataclass(frozen=True)
class Peer:
    """``rank`` or ``dense_rank`` where rows equal in ``by`` are peers."""

    dense: bool
    by: tuple[str, ...]


def _rows(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _add(carry: Column, local: Column) -> Column:
    return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)


def row_number() -> Prefix:
    return Prefix(lambda w: F.row_number().over(w).cast("long"), F.sum, _add)


def running_sum(value) -> Prefix:
    return Prefix(lambda w: F.sum(value).over(_rows(w)), F.sum, _add)


def running_count(value="*") -> Prefix:
    return Prefix(lambda w: F.count(value).over(_rows(w)), F.sum, _add)


def running_max(value) -> Prefix:
    return Prefix(lambda w: F.max(value).over(_rows(w)), F.max, F.greatest)


def running_min(value) -> Prefix:
    return Prefix(lambda w: F.min(value).over(_rows(w)), F.min, F.least)


def latest(value) -> Prefix:
    """Last non-null value up to and including the current row."""
    return Prefix(
        lambda w: F.last(value, ignorenulls=True).over(_rows(w)),
        lambda c: F.last(c, ignorenulls=True),
        lambda carry, local: F.coalesce(local, carry),
    )


def earliest(value) -> Prefix:
    """First non-null value of the group so far."""
    return Prefix(
        lambda w: F.first(value, ignorenulls=True).over(_rows(w)),
        lambda c: F.first(c, ignorenulls=True),
        lambda carry, local: F.coalesce(carry, local),
    )


def lag(value, n: int = 1, default=None) -> Near:
    return Near(lambda w: F.lag(value, n, default).over(w), n, 0)


def lead(value, n: int = 1, default=None) -> Near:
    return Near(lambda w: F.lead(value, n, default).over(w), 0, n)


def moving(aggregate: Callable[[Column], Column], value, k: int) -> Near:
    """``aggregate`` of the last ``k`` rows including the current one."""
    return Near(lambda w: aggregate(value).over(w.rowsBetween(-(k - 1), 0)), k - 1, 0)


def rank(*by: str) -> Peer:
    return Peer(False, by)


def dense_rank(*by: str) -> Peer:
    return Peer(True, by)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *steps: dict[str, Prefix | Near | Peer],
    bounded: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add window columns to ``df``; later steps may use columns of earlier ones.

    ``order`` should be total inside a group. ``bounded=True`` skips the size check where
    the group size is limited by construction, for instance one row per calendar day.
    """
    keys = list(keys)
    limit = hot_limit(df) if hot_rows is None else hot_rows
    if bounded or largest_group(df, keys) <= limit:
        out = df
        for step in steps:
            out = _plain(out, keys, order, step)
        return _from(df, out)
    return _from(df, _blocked(df, keys, order, steps))


def _plain(df, keys, order, step):
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    columns = {}
    for name, spec in step.items():
        if isinstance(spec, Peer):
            peers = Window.partitionBy(*keys).orderBy(*sort_columns(spec.by))
            columns[name] = (F.dense_rank() if spec.dense else F.rank()).over(peers).cast("long")
        elif isinstance(spec, Near):
            columns[name] = spec.value(window)
        else:
            columns[name] = spec.local(window)
    return df.withColumns(columns)


def _blocked(df, keys, order, steps):
    names = [*df.columns, *(name for step in steps for name in step)]
    blocks = durable(
        df.repartitionByRange(*[F.col(k) for k in keys], *sort_columns(order)).withColumn(
            _BLOCK, F.spark_partition_id()
        )
    )
    work = []
    for step in steps:
        near = {n: s for n, s in step.items() if isinstance(s, Near)}
        prefix = {n: s for n, s in step.items() if isinstance(s, Prefix)}
        peers = {n: s for n, s in step.items() if isinstance(s, Peer)}
        if near:
            work.append(partial(_lend_neighbours, keys=keys, order=order, specs=near))
        if prefix:
            work.append(partial(_carry_prefixes, keys=keys, order=order, specs=prefix))
        if peers:
            work.extend(_peer_work(keys, order, peers))
    for position, step in enumerate(work, start=1):
        blocks = step(blocks)
        # Each piece of work reads its input more than once, so the next one starts from stored rows.
        if position < len(work):
            blocks = durable(blocks)
    return blocks.select(*names)


def ranks(
    df: DataFrame, order: Sequence[str], groups: dict[str, tuple[Sequence[str], bool]], hot_rows: int | None = None
) -> DataFrame:
    """Ranks of each row inside several groupings by the one value ``order[0]``; ``groups`` maps a name to (keys, is it dense).

    Small groups of a small source are ranked by plain windows. Otherwise the value's range is cut into blocks that serve all groupings: rows are
    dealt out once, and a rank is the rank inside the block plus what the blocks before hold. Rows and ranks are then stored in slices, so that the disk
    holds the shuffle files of one slice.
    """
    limit = hot_limit(df) if hot_rows is None else hot_rows
    key_sets = [list(keys) for keys, _ in groups.values()]
    large = slice_count(df) > 1
    if not large:
        count_groups(df, *key_sets)
    if large or max([largest_group(df, keys) for keys in key_sets]) > limit:
        own = "_stored_at" not in df.__dict__
        rows = stored(slices(df, [order[1].lstrip("-")] if len(order) > 1 else [order[0].lstrip("-")]), "to-rank") if own else df
        out = stored(_ranks_by_value(rows, order, groups, min(limit, VALUE_BLOCK_ROWS)), "ranked")
        if own:
            forget(rows)
        return out
    out = df
    for name, (keys, dense) in groups.items():
        out = scan(out, keys, order, {name: dense_rank(order[0]) if dense else rank(order[0])}, bounded=True)
    return _from(df, out)


def _value_cuts(df: DataFrame, value: str, blocks: int) -> tuple[list, list[bool]]:
    """Cuts of a value's range into about so many blocks of equal size, and which cut is a value that fills more than one."""
    found = df.agg(F.percentile_approx(value, [k / blocks for k in range(1, blocks)], max(10_000, 20 * blocks))).first()[0] if blocks > 1 else None
    cuts, heavy = [], []
    for cut in found or []:
        # NaN counts as equal to itself.
        if cuts and (cut == cuts[-1] or (cut != cut and cuts[-1] != cuts[-1])):
            heavy[-1] = True
        else:
            cuts.append(cut)
            heavy.append(False)
    return cuts, heavy


def with_position(df: DataFrame, name: str, x: Column, cuts: Sequence) -> DataFrame:
    """Add how many of the rising ``cuts`` are not above ``x``, found by bisection; 0 for NULL."""
    df, at, found = df.withColumn(name, F.lit(0)), F.array(*[F.lit(c) for c in cuts]), F.col(name)
    step = (1 << len(cuts).bit_length()) >> 1
    while step:
        # A step per projection: inside one expression each step would repeat all those before it.
        df = df.withColumn(name, F.when(x >= F.get(at, found + (step - 1)), found + step).otherwise(found))
        step >>= 1
    return df


def _with_value_block(df: DataFrame, value: str, cuts: list, heavy: list[bool]) -> DataFrame:
    """Number the block of each row by bisection of the cuts. An even number is a block of one value alone, -2 that of NULL."""
    x, block = F.col(value), F.col(_BLOCK)
    df = with_position(df, _BLOCK, x, cuts)
    alone = F.lit(False)
    if cuts:
        alone = F.get(F.array(*[F.lit(h) for h in heavy]), block - 1) & (x == F.get(F.array(*[F.lit(c) for c in cuts]), block - 1))
    return df.withColumn(_BLOCK, F.when(x.isNull(), -2).when(alone, block * 2).otherwise(block * 2 + 1))


def _ranks_by_value(df, order, groups, block_rows) -> list[DataFrame]:
    """The ranked rows as slices of the value's range."""
    value, falling = order[0].lstrip("-"), order[0].startswith("-")
    blocks = min(max(1, -(-df.count() // block_rows)), MAX_VALUE_BLOCKS)
    cuts, heavy = _value_cuts(df, value, blocks)
    salts = min(blocks, 64)
    # A block of one value alone needs no order, so its rows are dealt out further.
    salt = F.when(F.col(_BLOCK) % 2 == 0, F.pmod(F.xxhash64(*[F.col(c.lstrip("-")) for c in order[1:]]), F.lit(salts)).cast("int")).otherwise(0)
    carries = []
    for kind, (keys, dense) in enumerate(groups.values(), start=1):
        counted = df.select(*keys, value).distinct() if dense else df.select(*keys, value)
        cells = _with_value_block(counted, value, cuts, heavy).groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("__n"))
        along = Window.partitionBy(*keys).orderBy(F.col(_BLOCK).desc() if falling else F.col(_BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
        carry = cells.select(*keys, _BLOCK, F.coalesce(F.sum("__n").over(along), F.lit(0)).cast("long").alias("__carry"), F.lit(kind).alias("__kind"))
        carries.append(stored([carry], "carry"))

    def ranked(low: int, high: int) -> DataFrame:
        """Rows from cut number ``low`` up to cut number ``high``."""
        x = F.col(value)
        inside, here = [], []
        if low:
            inside.append(x >= F.lit(cuts[low - 1]))
            here.append(F.col(_BLOCK) >= 2 * low)
        if high <= len(cuts):
            inside.append(x < F.lit(cuts[high - 1]) if low else (x < F.lit(cuts[high - 1])) | x.isNull())
            here.append(F.col(_BLOCK) < 2 * high)
        rows, before = df, carries
        for condition in inside:
            rows = rows.filter(condition)
        for condition in here:
            before = [c.filter(condition) for c in before]
        rows = _with_value_block(rows, value, cuts, heavy).withColumns({"__salt": salt, "__kind": F.lit(0)})
        # Beside the rows of a cell lies one row with what the blocks before it hold.
        every = F.when(F.col(_BLOCK) % 2 == 0, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        for carry in before:
            rows = rows.unionByName(carry.withColumn("__salt", F.explode(every)), allowMissingColumns=True)
        rows = rows.repartition(_BLOCK, "__salt")
        for kind, (name, (keys, dense)) in enumerate(groups.items(), start=1):
            cell = Window.partitionBy(F.col("__kind") > kind, *keys, _BLOCK, "__salt").orderBy(F.col("__kind") == 0, *sort_columns(order[:1]))
            inner = (F.dense_rank() if dense else F.rank()).over(cell).cast("long") - 1
            rows = rows.withColumn(name, inner + F.first("__carry").over(_rows(cell))).filter(F.col("__kind") != kind)
        return rows.select(*df.columns, *groups)

    n = min(slice_count(df), len(cuts) + 1)
    bounds = [(len(cuts) + 1) * k // n for k in range(n + 1)]
    return [ranked(low, high) for low, high in zip(bounds, bounds[1:], strict=False)]


def _block_window(keys, order):
    return Window.partitionBy(*keys, _BLOCK).orderBy(*sort_columns(order))


def _carry_prefixes(df, keys, order, specs):
    window = _block_window(keys, order)
    local_names = {name: f"__local_{name}" for name in specs}
    local = df.withColumns(
        {local_names[n]: s.local(window) for n, s in specs.items()} | {_ROW: F.row_number().over(window)}
    )
    ends = (
        local.groupBy(*keys, _BLOCK)
        .agg(F.max_by(F.struct(*local_names.values()), F.col(_ROW)).alias("__end"))
        .select(*keys, _BLOCK, "__end.*")
    )
    over_blocks = Window.partitionBy(*keys).orderBy(_BLOCK)
    before = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    # A block continues at most one group of the block before it, so this table has
    # fewer rows than there are blocks and may be broadcast.
    carried = (
        ends.withColumns(
            {f"__carry_{n}": s.carry(F.col(local_names[n])).over(before) for n, s in specs.items()}
            | {"__part": F.row_number().over(over_blocks)}
        )
        .filter(F.col("__part") > 1)
        .select(
            *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
            F.col(_BLOCK).alias("__carry_block"),
            *[f"__carry_{n}" for n in specs],
        )
    )
    condition = F.col(_BLOCK) == F.col("__carry_block")
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"__key_{i}"))
    joined = local.join(F.broadcast(carried), condition, "left")
    return joined.select(
        *df.columns,
        *[s.merge(F.col(f"__carry_{n}"), F.col(local_names[n])).alias(n) for n, s in specs.items()],
    )


def _lend_neighbours(df, keys, order, specs):
    back = max(s.back for s in specs.values())
    ahead = max(s.ahead for s in specs.values())
    window = _block_window(keys, order)
    reverse = Window.partitionBy(*keys, _BLOCK).orderBy(*sort_columns([o[1:] if o.startswith("-") else f"-{o}" for o in order]))
    # Blocks of one group numbered without gaps, kept only where the group has several:
    # at most two rows per block boundary.
    along = Window.partitionBy(*keys).orderBy(_BLOCK)
    spans = (
        df.groupBy(*keys, _BLOCK)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumns(
            {
                "__part": F.row_number().over(along),
                "__parts": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
                "__upto": F.sum("__n").over(_rows(along)),
            }
        )
        .filter(F.col("__parts") > 1)
        .select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], F.col(_BLOCK).alias("__from"), "__part", "__n", "__upto")
    )
    key_names = [f"__key_{i}" for i in range(len(keys))]
    out = df.withColumn("__lent", F.lit(False))
    for reach, ordering, sign in ((back, reverse, 1), (ahead, window, -1)):
        if not reach:
            continue
        # Which block lends to which: neighbours with fewer than ``reach`` rows in between.
        target = spans.select(
            *[F.col(k).alias(f"{k}_to") for k in key_names], F.col("__from").alias("__to"), F.col("__part").alias("__part_to"),
            F.col("__n").alias("__n_to"), F.col("__upto").alias("__upto_to"),
        )
        match = F.col("__want") == F.col("__part_to")
        for k in key_names:
            match = match & F.col(k).eqNullSafe(F.col(f"{k}_to"))
        wanted = spans.withColumn("__want", F.explode(F.sequence(F.lit(1), F.lit(reach)))).withColumn(
            "__want", F.col("__part") + F.lit(sign) * F.col("__want")
        )
        between = F.col("__upto_to") - F.col("__n_to") - F.col("__upto") if sign == 1 else F.col("__upto") - F.col("__n") - F.col("__upto_to")
        lenders = wanted.join(target, match).filter(between < reach).select(*key_names, "__from", "__to")
        edge = df.withColumn(_ROW, F.row_number().over(ordering)).filter(F.col(_ROW) <= reach)
        borrowed = F.col(_BLOCK) == F.col("__from")
        for i, key in enumerate(keys):
            borrowed = borrowed & F.col(key).eqNullSafe(F.col(f"__key_{i}"))
        lent = edge.join(F.broadcast(lenders), borrowed).select(
            *[F.col("__to").alias(_BLOCK) if c == _BLOCK else F.col(c) for c in df.columns], F.lit(True).alias("__lent")
        )
        out = out.unionByName(lent)
    return (
        out.withColumns({n: s.value(window) for n, s in specs.items()})
        .filter(~F.col("__lent"))
        .drop("__lent")
    )


def _peer_work(keys, order, specs):
    """Ranks as: compare with the row before, number the rows, carry the number where a run of peers starts."""
    values = {n: F.struct(*[F.col(b.lstrip("-")) for b in s.by]) for n, s in specs.items()}
    starts = {n: (F.col("__peer_rn") == 1) | ~F.col(f"__peer_{n}").eqNullSafe(v) for n, v in values.items()}
    ranks = {
        n: running_sum(F.when(starts[n], 1).otherwise(0).cast("long")) if s.dense else running_max(F.when(starts[n], F.col("__peer_rn")))
        for n, s in specs.items()
    }
    return [
        partial(_lend_neighbours, keys=keys, order=order, specs={f"__peer_{n}": lag(v) for n, v in values.items()}),
        partial(_carry_prefixes, keys=keys, order=order, specs={"__peer_rn": row_number()}),
        partial(_carry_prefixes, keys=keys, order=order, specs=ranks),
    ]


def with_totals(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Whole-group values beside each row: aggregate first, then join one row per group.

    The join is left to the optimiser, which splits a skewed left side at run time.
    """
    if not keys:
        return df.crossJoin(F.broadcast(df.agg(*[a.alias(n) for n, a in aggregates.items()])))
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    renamed = totals.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *aggregates)
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__key_{key}"))
    return df.join(renamed, condition, "left").drop(*[f"__key_{k}" for k in keys])


def range_totals(
    df: DataFrame,
    keys: Sequence[str],
    seconds: str,
    id_columns: Sequence[str],
    spans: dict[str, tuple[Column | str, int]],
    hot_rows: int | None = None,
) -> DataFrame:
    """Sums over the last ``span`` units of the numeric column ``seconds``, current row included.

    ``spans`` maps a name to (value, span). Small groups use a RANGE frame. For a hot group
    each row becomes an entry at its time, an exit one span later and a question in between,
    and the answer is a running sum over those.
    """
    keys = list(keys)
    limit = hot_limit(df) if hot_rows is None else hot_rows
    if largest_group(df, keys) <= limit:
        window = Window.partitionBy(*keys).orderBy(seconds)
        return _from(df, df.withColumns({n: F.sum(v).over(window.rangeBetween(-s, 0)) for n, (v, s) in spans.items()}))
    for name, (value, span) in spans.items():
        value = F.col(value) if isinstance(value, str) else value
        columns = [F.col(c) for c in df.columns]
        zero = F.lit(0).cast(df.select(value.alias("v")).schema["v"].dataType)
        ask = df.select(*columns, F.col(seconds).alias("__t"), F.lit(1).alias("__kind"), zero.alias("__v"))
        empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in (*keys, *id_columns) else F.col(f.name) for f in df.schema]
        enter = df.select(*empty, F.col(seconds).alias("__t"), F.lit(0).alias("__kind"), F.coalesce(value, zero).alias("__v"))
        leave = df.select(
            *empty, (F.col(seconds) + span).alias("__t"), F.lit(2).alias("__kind"), (-F.coalesce(value, zero)).alias("__v")
        )
        steps = enter.unionByName(ask).unionByName(leave)
        df = (
            scan(steps, keys, ["__t", "__kind", *id_columns], {name: running_sum(F.col("__v"))}, hot_rows=limit)
            .filter(F.col("__kind") == 1)
            .drop("__t", "__kind", "__v")
        )
    return df
