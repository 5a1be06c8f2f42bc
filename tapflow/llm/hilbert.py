"""Sharding along a Hilbert curve through several metadata dimensions; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tapflow.llm.order import in_global_order

BITS = 5


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Next state and rank of each (state, corner) of a Hilbert curve in ``dims`` dimensions.

    A state is the entry corner and the direction of a cell. The corner's Gray rank inside
    the rotated and reflected cell is the next digit of the curve index, and it fixes the
    entry and direction of the cell below.
    """
    corners = 1 << dims

    def turned(value: int, by: int) -> int:
        by %= dims
        return (value << by | value >> (dims - by)) & (corners - 1)

    def gray(value: int) -> int:
        return value ^ value >> 1

    rank_of = {gray(value): value for value in range(corners)}

    def entry(rank: int) -> int:
        return 0 if rank == 0 else gray((rank - 1) // 2 * 2)

    def direction(rank: int) -> int:
        if rank == 0:
            return 0
        odd = rank if rank % 2 else rank - 1
        return ((odd + 1) & -(odd + 1)).bit_length() - 1

    states, after, ranks = {(0, 0): 0}, [], []
    queue = [(0, 0)]
    for start, axis in queue:
        for corner in range(corners):
            rank = rank_of[turned(corner ^ start, dims - (axis + 1) % dims)]
            below = (start ^ turned(entry(rank), axis + 1), (axis + direction(rank) + 1) % dims)
            if below not in states:
                states[below] = len(states)
                queue.append(below)
            after.append(states[below])
            ranks.append(rank)
    return after, ranks


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index along the curve of a point given by one cell number (0 to 2**bits - 1) per dimension."""
    dims = len(cells)
    after, ranks = curve_tables(dims)
    corners = 1 << dims
    digits = F.array(*[
        sum((F.shiftright(cell.cast("int"), bit).bitwiseAND(F.lit(1)) * (1 << axis) for axis, cell in enumerate(cells)), F.lit(0))
        for bit in range(bits - 1, -1, -1)
    ])
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    step = lambda kept, digit: F.struct(
        F.lit(after)[kept["state"] * corners + digit].alias("state"),
        (kept["index"] * corners + F.lit(ranks)[kept["state"] * corners + digit]).alias("index"),
    )
    return F.aggregate(digits, start, step, lambda kept: kept["index"])


def _text_cuts(df: DataFrame, name: str, most: int) -> list[str]:
    """First value of each of ``most`` ranges of about as many rows, in the order of values.

    Rows are counted by value before anything is ordered, so a hot value is one row.
    """
    counted = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("value")).agg(F.count("*").alias("n"))
    placed = in_global_order(counted, ["value"], "before", value="n")
    total = placed.agg(F.sum("n")).first()[0] or 1
    ranged = placed.groupBy(F.floor(F.col("before") * most / total).alias("range")).agg(F.min("value").alias("value"))
    return sorted(row["value"] for row in ranged.collect())  # at most ``most`` rows


def cells(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Cell number of each dimension: ranges of about as many rows, in the order of its values.

    The cut points are a list of fixed length per dimension. Null is cell 0.
    """
    most = (1 << bits) - 1
    kinds = {field.name: field.dataType for field in df.schema.fields}
    numeric = [name for name in dims if isinstance(kinds[name], (T.NumericType, T.DateType, T.TimestampType))]
    points = [i / most for i in range(1, most)]
    cuts = {}
    if numeric:
        found = df.agg(*[F.percentile_approx(F.col(name).cast("double"), points, 1000).alias(name) for name in numeric]).first()
        cuts = {name: sorted(set(found[name] or [])) for name in numeric}
    out = []
    for name in dims:
        if name in cuts:
            value = F.col(name).cast("double")
            cell = sum((F.when(value > cut, 1).otherwise(0) for cut in cuts[name]), F.lit(1))
        else:
            value = F.col(name).cast("string")
            cell = sum((F.when(value >= cut, 1).otherwise(0) for cut in _text_cuts(df, name, most)), F.lit(0))
        out.append(F.when(F.col(name).isNull(), 0).otherwise(cell).cast("int"))
    return out


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, ties: list[str], bits: int = BITS) -> DataFrame:
    """Add curve_index, shard and slot: runs of the curve with row counts at most one apart.

    Rows are sorted along the curve through ``dims``, then by ``ties`` (keys that make the
    order unique; rows equal in all of them are interchangeable), and cut into ``shards``
    runs, so a shard spans few cells and its ranges in every dimension are narrow enough to
    skip files. slot counts from 0 in each shard. A hot cell is cut like any other run.
    Columns of ``df`` with one of the three names are replaced, all others stay whatever
    their names. An empty table stays empty; with fewer rows than shards some have none.
    """
    kept = [c for c in df.columns if c not in ("curve_index", "shard", "slot")]
    order = [F.col(name).alias(f"tie_{i}") for i, name in enumerate(ties)]
    packed = df.select(F.struct(*kept).alias("row"), hilbert_index(cells(df, dims, bits), bits).alias("curve_index"), *order)
    placed = in_global_order(packed, ["curve_index", *(f"tie_{i}" for i in range(len(ties)))], "at")
    rows = placed.count()
    shard = F.expr(f"at * {shards} div {max(rows, 1)}")
    first = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("at") - first).cast("long")).select(
        "row.*", "curve_index", "shard", "slot"
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write placed rows with a folder per shard, in the order of slots."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_ranges(placed: DataFrame, dims: list[str]) -> DataFrame:
    """shard, n_rows, and for each dimension its smallest and largest value and number of nulls: what
    a reader needs to pass over shards that a filter on any of the dimensions can't meet."""
    asked = [F.count("*").alias("n_rows")]
    for name in dims:
        asked += [F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}"), F.count_if(F.col(name).isNull()).alias(f"nulls_{name}")]
    return placed.groupBy("shard").agg(*asked)
