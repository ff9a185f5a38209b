"""Building blocks that keep the other operators safe at any size and skew.

Every lookup table passes `fetch_small` before it is broadcast; above the bound
the operators take a shuffled path with the same result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.session import settle

SMALL_ROWS = 10_000
SMALL_BYTES = 32 * 1024 * 1024
HOT_KEYS = 1_000
SALTS = 32
FAN = 4_096


def fetch_small(df: DataFrame, max_rows: int | None = None) -> pa.Table | None:
    """The whole table if it is within the broadcast bound, else None.

    Rows and bytes are counted where the rows are, so a table beyond the bound sends
    nothing but that fact to the driver.
    """
    max_rows = SMALL_ROWS if max_rows is None else max_rows
    rows = F.collect_list(F.struct(*[F.col(c) for c in df.columns]))
    sized = df.limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
        rows.alias("rows"),
    )
    fits = (F.col("n") <= max_rows) & (F.col("bytes") <= SMALL_BYTES)
    found = sized.select(F.when(fits, F.col("rows")).alias("rows")).toArrow().column("rows")
    if not found[0].is_valid:
        return None
    columns = found[0].values.flatten()
    return pa.Table.from_arrays(columns, names=df.columns)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: those of its texts, and eight for any other column."""
    texts = [f.name for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts]
    return sum(sizes, F.lit(8 * (len(df.columns) - len(texts)))).cast("bigint")


def is_small(stored: DataFrame, max_rows: int) -> bool:
    """Whether a stored table may be broadcast, by its rows and its text bytes."""
    size = stored.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(_row_bytes(stored)), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= SMALL_BYTES


def use_all_cores(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of fewer splits than cores before costly work per row.

    What Spark already splits over all cores passes unchanged, and so does a frame
    that is not read directly from files.
    """
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    if "FileScan" not in plan or "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = execution.toRdd().getNumPartitions()
    return df if splits >= cores else df.repartition(cores, *keys)


def lookup_join(
    big: DataFrame, table: DataFrame, on: str, how: str, spread_by: list[str]
) -> DataFrame:
    """Join a big table with a lookup table that is unique in `on`.

    Within the bound the table is broadcast. Above it both sides are shuffled,
    and rows of the most frequent keys are spread over `SALTS` sub-keys by
    `spread_by`, columns that tell rows of one key apart. The salt is a hash of
    stored values, so a rerun task sends its rows to the same place.
    """
    small = fetch_small(table)
    if small is not None:
        local = big.sparkSession.createDataFrame(small, schema=table.schema)
        return big.join(F.broadcast(local), on, how)
    return spread_join(big, table, on, how, spread_by)


def spread_join(
    big: DataFrame,
    table: DataFrame,
    on: str,
    how: str,
    spread_by: list[str],
    counts: DataFrame | None = None,
) -> DataFrame:
    """The shuffled form of `lookup_join`.

    `counts` has the rows of each key in `big` as `count`, if they are known already.
    """
    counts = big.groupBy(on).count() if counts is None else counts
    frequent = counts.orderBy(F.desc("count")).limit(HOT_KEYS)
    hot = frequent.where(F.col(on).isNotNull()).select(on, F.lit(True).alias("_hot"))
    hot = settle(hot, "hot-keys")  # at most HOT_KEYS rows, so safe to broadcast
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    # null keys match nothing, they only have to be spread as well
    salted = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(on).isNull(), spread).otherwise(F.lit(0))
    )
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
    copies = table.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.coalesce(salts, F.array(F.lit(0))))
    )
    joined = salted.drop("_hot").join(copies.drop("_hot"), [on, "_salt"], how)
    return joined.drop("_salt")


def first_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int
) -> DataFrame:
    """The first n rows of each group, however large a group is.

    A first cut runs per group and map-partition class: every task sends at most
    n rows per group (WindowGroupLimit), and a group that holds much of the data
    is spread over `SALTS` reducers. The second cut sees SALTS * n rows at most.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    local = Window.partitionBy(*group, "_salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(local))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the 0-based position in ascending order of `keys` (unique together)."""
    small = fetch_small(df)
    if small is None:
        return _numbered_by_range(df, keys, name)
    small = small.sort_by([(key, "ascending") for key in keys])
    small = small.append_column(name, pa.array(range(small.num_rows), pa.int64()))
    return df.sparkSession.createDataFrame(small)


def _numbered_by_range(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Positions without a one-task sort: range partitions plus their offsets.

    The range bounds are sampled, so partition and sequence numbers are written
    down before use; a recomputed task could otherwise number rows differently.
    """
    sequence = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = (
        settle(df, "to-number")  # sampling the bounds and sorting both read it
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", sequence)
    )
    ranged = settle(ranged, "ranged")
    # one row per shuffle partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .select("_part", "_offset")
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_seq"))
        .drop("_part", "_seq", "_offset")
    )


def running_sums(df: DataFrame, position: str, columns: list[str]) -> DataFrame:
    """Replace `columns` by their sums up to each row in order of `position`.

    Within the small bound this is one window. Above it sums run within groups of
    FAN positions, then over FAN groups, then over the rest, so the only one-task
    window sees one row per FAN * FAN positions.
    """
    rows = settle(df, "to-sum")
    small = fetch_small(rows)
    if small is not None:
        local = df.sparkSession.createDataFrame(small, schema=df.schema)
        so_far = Window.orderBy(position).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return local.withColumns({c: F.sum(c).over(so_far) for c in columns})
    return _sums_in_levels(rows, position, columns)


def _sums_in_levels(df: DataFrame, position: str, columns: list[str]) -> DataFrame:
    fan = F.lit(FAN).cast("bigint")
    rows = df.withColumn("_group", F.floor(F.col(position) / fan))
    groups = (
        rows.groupBy("_group")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .withColumn("_top", F.floor(F.col("_group") / fan))
    )
    tops = groups.groupBy("_top").agg(*[F.sum(c).alias(c) for c in columns])

    before = (Window.unboundedPreceding, -1)
    over_tops = Window.orderBy("_top").rowsBetween(*before)
    over_groups = Window.partitionBy("_top").orderBy("_group").rowsBetween(*before)
    within = (
        Window.partitionBy("_group")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    top_sums = tops.select(
        "_top",
        *[F.coalesce(F.sum(c).over(over_tops), F.lit(0)).alias(f"_t_{c}") for c in columns],
    )
    group_sums = groups.select(
        "_group",
        "_top",
        *[F.coalesce(F.sum(c).over(over_groups), F.lit(0)).alias(f"_g_{c}") for c in columns],
    )
    totals = {c: F.sum(c).over(within) for c in columns}
    offsets = {c: F.col(f"_g_{c}") + F.col(f"_t_{c}") for c in columns}
    return (
        rows.withColumns(totals)
        .join(group_sums, "_group")
        .join(top_sums, "_top")
        .select(
            *[
                (F.col(c) + offsets[c]).alias(c) if c in columns else F.col(c)
                for c in df.columns
            ]
        )
    )
