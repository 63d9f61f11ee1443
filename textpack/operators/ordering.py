"""Global order without a single-partition window.

Rows are put into buckets by an order-preserving function of the sort key. Bucket totals are
pre-aggregated before any shuffle, running totals are taken over the small bucket table, and only
then is each row placed inside its own bucket. No task ever holds more than one bucket, however
the partition keys are skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textpack.constants import SEED, VAL_FRACTION
from textpack.session import materialize

# Four hex digits: at most 65,536 buckets, so the bucket table has a fixed size bound.
HASH_DIGITS = 4
# Rows per chunk of one source or conversation; few have more than one chunk.
CHUNK_WIDTH = 1 << 16
# Chunks that one window looks at, and the largest key of a source: a byte of a file of 256 TB.
FAN_OUT = 1 << 12
LONGEST = 1 << 48


def hash_key(seed: int | str, *parts: Column | str) -> Column:
    """md5 hex of ``seed:part:...``: the seeded order used for every shuffle."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_buckets(key: Column | str) -> list[Column]:
    key = F.col(key) if isinstance(key, str) else key
    return [F.substring(key, 1, HASH_DIGITS)]


RANGE = "_range"


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows, written with the number of the range of the sort key that each falls in.

    Spark takes the bounds from a sample of the keys, so ranges are even for any orderable key, sparse,
    hashed or composite, and there are no more of them than shuffle partitions. Give narrow rows: they are
    written once, which also fixes the numbers.
    """
    return materialize(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def range_buckets() -> list[Column]:
    return [F.col(RANGE)]


def chunk_buckets(key: Column | str, width: int = CHUNK_WIDTH, longest: int = LONGEST) -> list[Column]:
    """Chunks of ``width`` consecutive keys within one source or conversation, chunks of chunks and so on.

    There are as many levels as keys up to ``longest`` need for at most ``width`` (or FAN_OUT, if that is more) chunks to lie in one of
    the next level, so no window over chunks holds more, however sparse the keys are.
    """
    key = F.col(key) if isinstance(key, str) else key
    fan_out = max(width, FAN_OUT)
    levels, size = [F.floor(key / F.lit(width))], width
    while longest > size * fan_out:
        size *= fan_out
        levels.append(F.floor(key / F.lit(size)))
    return levels


def running(
    df: DataFrame,
    order: Column | str,
    buckets: list[Column],
    partition: list[str] | None = None,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add exclusive running sums and maxima per partition in the given order.

    ``buckets`` lists order-preserving bucket columns, finest first. ``totals`` maps a new column
    to the name of a sum whose partition total it receives. ``order`` must be unique per partition.
    """
    partition, sums, maxes = partition or [], sums or {}, maxes or {}
    totals = totals or {}
    order = F.col(order) if isinstance(order, str) else order
    levels = [f"_b{i}" for i in range(len(buckets))]
    rows = df.withColumns(dict(zip(levels, buckets)))
    outs = [*sums, *maxes]
    local = {out: f"_l_{out}" for out in outs}

    def combine(out: str, inner: Column) -> Column:
        return F.sum(inner) if out in sums else F.max(inner)

    def before(out: str, inner: Column, window) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        value = combine(out, inner).over(frame)
        return F.coalesce(value, F.lit(0)) if out in sums else value

    def add(out: str, base: Column, inner: Column) -> Column:
        return base + inner if out in sums else F.greatest(base, inner)

    # Pre-aggregate bottom up: rows -> buckets -> groups of buckets.
    source = {**sums, **maxes}
    tables = [rows.groupBy(*partition, *levels).agg(
        *[combine(out, source[out]).alias(local[out]) for out in outs])]
    for i in range(1, len(levels)):
        tables.append(tables[-1].groupBy(*partition, *levels[i:]).agg(
            *[combine(out, F.col(local[out])).alias(local[out]) for out in outs]))

    # Running values top down; the topmost table is small.
    top = tables[-1]
    window = Window.partitionBy(*partition).orderBy(levels[-1])
    bases = top.select(
        *partition, levels[-1],
        *[before(out, F.col(local[out]), window).alias(out) for out in outs],
        *[F.sum(local[name]).over(Window.partitionBy(*partition)).alias(total)
          for total, name in totals.items()])
    for i in range(len(levels) - 2, -1, -1):
        keys = [*partition, *levels[i + 1:]]
        window = Window.partitionBy(*keys).orderBy(levels[i])
        bases = tables[i].join(bases, keys, "left").select(
            *partition, *levels[i:],
            *[add(out, F.col(out), before(out, F.col(local[out]), window)).alias(out)
              for out in outs],
            *totals)

    keys = [*partition, *levels]
    window = Window.partitionBy(*keys).orderBy(order)
    base_names = {out: f"_base_{out}" for out in outs}
    # Every bucket is in ``bases``. As an outer join only that side may be broadcast, and only when
    # its size at run time allows; the rows never are.
    placed = rows.join(bases.withColumnsRenamed(base_names), keys, "left")
    # All window columns in one select, so they share one sort.
    return placed.select(
        *[F.col(c) for c in df.columns],
        *[add(out, F.col(base_names[out]), before(out, source[out], window)).alias(out)
          for out in outs],
        *totals)


def global_offset(
    df: DataFrame,
    weight: Column | str,
    order: Column | str,
    buckets: list[Column],
    partition: list[str] | None = None,
    out: str = "start",
    total: str | None = None,
) -> DataFrame:
    """Where each row begins when rows of the given lengths are laid end to end in order."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    return running(df, order, buckets, partition, sums={out: weight.cast("long")},
                   totals={total: out} if total else None)


def seeded_shuffle(df: DataFrame, row_id: list[str], seed: int | str = SEED,
                   out: str = "position", total: str | None = None) -> DataFrame:
    """Position of each row in a seeded permutation of all rows. ``row_id`` must be unique."""
    keyed = df.withColumn("_key", hash_key(seed, *row_id))
    placed = global_offset(keyed, F.lit(1), F.struct("_key", *row_id), hash_buckets("_key"),
                           out=out, total=total)
    return placed.drop("_key")


def _split_column(fraction: float) -> Column:
    in_val = F.col("position") < F.rint(F.col("_total") * F.lit(fraction))
    return F.when(in_val, "val").otherwise("train")


def exact_split(df: DataFrame, row_id: list[str], fraction: float = VAL_FRACTION,
                seed: int | str = SEED) -> DataFrame:
    """Add ``split`` and ``position``: the first ``round(n * fraction)`` of the permutation is
    ``val``, halves going to the even count."""
    placed = seeded_shuffle(df, row_id, seed, total="_total")
    return placed.withColumn("split", _split_column(fraction)).drop("_total")


def split_and_place(encoded: DataFrame, row_id: list[str], fraction: float = VAL_FRACTION,
                    seed: int | str = SEED) -> DataFrame:
    """Shuffle, split, and place each row in its split's token stream, in one pass.

    Adds ``position``, ``split`` and ``start``. The validation rows come first in the permutation,
    so a training row's start is its place in the whole stream less the validation tokens. Only ids
    and lengths take part in the ordering; the token arrays are joined to the result once.
    """
    narrow = encoded.select(*row_id, "n_tokens").withColumn("_key", hash_key(seed, *row_id))
    placed = running(
        narrow, F.struct("_key", *row_id), hash_buckets("_key"),
        sums={"position": F.lit(1).cast("long"), "start": F.col("n_tokens").cast("long")},
        totals={"_total": "position"}).withColumn("split", _split_column(fraction))
    # Read twice, placed once.
    placed = materialize(placed.select(*row_id, "n_tokens", "position", "start", "split"), "placed")
    val_tokens = placed.where("split = 'val'").agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0))).scalar()
    own = F.col("start") - F.when(F.col("split") == "train", val_tokens).otherwise(0)
    places = placed.select(*row_id, "position", "split", own.alias("start"))
    # Only the places are shuffled if the ids lie in buckets of the row id.
    return encoded.join(places, row_id, "left")


def _literal(value) -> Column:
    if isinstance(value, Row):
        return F.struct(*[_literal(v).alias(name) for name, v in value.asDict().items()])
    return F.lit(value)


def _upto(column: str, value) -> Column:
    """Rows whose value is the given one or sorts before it; nulls come first."""
    return F.col(column).isNull() if value is None else F.col(column).isNull() | (F.col(column) <= _literal(value))


def _at(columns: list[str], bound: Row) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(_literal(bound[c])) for c in columns])


def _before(columns: list[str], bound: Row) -> Column:
    """Rows that sort before the bound, column by column."""
    first, rest = columns[0], columns[1:]
    less = _upto(first, bound[first]) & ~_at([first], bound)
    return less | (_at([first], bound) & _before(rest, bound)) if rest else less


def nth_smallest(rows: DataFrame, columns: list[str], n: int) -> tuple[Row | None, int]:
    """The ``n``-th row (from 1) in the order of the columns, and how many rows sort before it; none if there
    are fewer. Give the columns alone: they are dealt to ranges, and only the range that holds the row is sorted."""
    ranged = in_ranges(rows.select(*columns), *columns)
    counts = sorted(map(tuple, ranged.groupBy(RANGE).agg(F.count(F.lit(1))).collect()))  # a row per shuffle partition
    below = 0
    for number, size in counts:
        if below + size >= n:
            break
        below += size
    else:
        return None, below
    inside = ranged.where(F.col(RANGE) == number).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = inside.withColumn("_upto", F.sum("_n").over(upto)).where(F.col("_upto") >= n - below)
    bound = found.orderBy("_upto").first()
    return bound, below + bound["_upto"] - bound["_n"]


def limit_n(df: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of one or more orderable columns.

    The last key that belongs to them is selected first, from the keys alone; the rows are then a filter on the key, which
    sources can push down, and no other column is shuffled or written. Where that key has more rows than are left
    to take, they are told apart by a hash of all their columns in the same way, so the result is the same in every run;
    rows alike in all columns are interchangeable.
    """
    if n < 1:
        raise ValueError("the limit must be at least 1")
    keys = [key] if isinstance(key, str) else key
    bound, below = nth_smallest(df, keys, n)
    if bound is None:
        return df
    near = df.where(_upto(keys[0], bound[keys[0]]))  # a filter that sources understand
    if bound["_n"] == n - below:
        return near.where(_before(keys, bound) | _at(keys, bound))
    tied = near.where(_at(keys, bound)).withColumn("_tie", F.xxhash64(*df.columns))
    last, fewer = nth_smallest(tied, ["_tie"], n - below)
    alike = tied.where(F.col("_tie") == last["_tie"]).limit(1)
    copies = F.explode(F.sequence(F.lit(1), F.lit(n - below - fewer).cast("long")))
    return near.where(_before(keys, bound)).unionByName(tied.where(F.col("_tie") < last["_tie"]).select(df.columns)) \
        .unionByName(alike.select(*df.columns, copies.alias("_copy")).select(df.columns))


def with_previous(df: DataFrame, partition: str, order: str, columns: list[str],
                  width: int = CHUNK_WIDTH) -> DataFrame:
    """Add ``previous``, the given columns of the row before, per partition.

    Partitions are cut into chunks of ``width`` keys, so a partition holding a large share of all
    rows is spread over many tasks. The last row of a chunk is copied into the next one.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(width)))
    ends = rows.groupBy(partition, "_chunk").agg(F.max(order).alias(order))
    following = F.lead("_chunk").over(Window.partitionBy(partition).orderBy("_chunk"))
    # Only partitions with several chunks leave rows here.
    crossing = ends.select(partition, order, following.alias("_chunk")).where(
        F.col("_chunk").isNotNull())
    copies = df.join(crossing, [partition, order]).withColumn("_copy", F.lit(True))
    both = rows.withColumn("_copy", F.lit(False)).unionByName(copies)
    window = Window.partitionBy(partition, "_chunk").orderBy(order)
    return (
        both.withColumn("previous", F.lag(F.struct(*columns)).over(window))
        .where(~F.col("_copy")).drop("_copy", "_chunk"))


def union_in_order(parts: list[DataFrame]) -> DataFrame:
    """Lay several tables end to end: ``part``, then each table's own key, orders the whole."""
    tagged = [p.withColumn("part", F.lit(i).cast("long")) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, tagged)
