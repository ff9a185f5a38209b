"""Seeded class-capped samples and batch assignment."""

from __future__ import annotations

from functools import reduce
from hashlib import md5
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.operators.scale import SMALL_ROWS, is_small, numbered
from intentloom.session import settle

# Positions are counted per hash prefix of this many hex digits: 65,536 even groups.
PREFIX_DIGITS = 4


def sample_capped_per_class(
    df: DataFrame,
    label: str,
    id: str,
    n: int = fixed.TRAIN_ROWS_PER_CLASS,
    seed: int = fixed.SEED,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """At most n rows per class, the same rows for the same seed.

    `within` names further grouping columns, such as the split. Rows without a label
    are left out; a null id is an id like any other. Rows are drawn in the order of a
    hash of seed and id, rows of one id in that of a hash of the whole row, and of equal
    rows any are drawn: they don't differ.

    No class is sorted. Rows are counted by class and the first digits of the hash, which
    gives the digits at which the n-th row of each class lies; the rows there are
    counted by more digits, until few are left. A filter by these digits then takes what
    lies before, and only the few rows at the limit are put in order. Columns beside
    group and id are read for the result alone, unless ids repeat at the limit.
    """
    groups = [*within, label]
    rows = df.where(F.col(label).isNotNull())
    order = [_shuffled(F.lit(f"{seed}:"), F.col(id)), _row_digits(df)]
    limits = _limits(rows, groups, order, n)
    digits, depth, wanted = (unused_name(df, c) for c in ("_digits", "_depth", "_wanted"))
    limits = limits.withColumnsRenamed({"digits": digits, "depth": depth, "wanted": wanted})
    if is_small(limits, SMALL_ROWS):
        limits = F.broadcast(limits)
    sides = limits.select(*[F.col(g).alias(f"{digits}_{k}") for k, g in enumerate(groups)], digits, depth, wanted)
    same = [rows[g].eqNullSafe(sides[f"{digits}_{k}"]) for k, g in enumerate(groups)]
    near = rows.join(sides, reduce(and_, same), "left")
    # classes without a limit have no more than n rows; '~' comes after all digits
    own = _first_digits(order, F.col(depth))
    near = near.withColumn(digits, F.when(F.col(depth).isNull(), F.lit("~")).otherwise(F.col(digits)))
    before = near.where(F.col(depth).isNull() | (own < F.col(digits))).select(df.columns)
    at_limit = near.where(own == F.col(digits))
    return before.unionByName(_first_of_few(at_limit, df.columns, groups, order, id, wanted))


#: Digits of the order by which rows are counted: of the hash of the id (32), then of the row.
DEPTHS = (4, 8, 36, 40, 48)
#: Rows at the limit of a class that are put in order at once.
FEW_ROWS = 64


def _row_digits(df: DataFrame) -> Column:
    return F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), 16, "0")


def _first_digits(order: list[Column], depth: Column | int) -> Column:
    by_id, by_row = order
    if isinstance(depth, int):  # the row's hash is worked out only where it counts
        return F.substring(by_id if depth <= 32 else F.concat(by_id, by_row), 1, depth)
    whole = F.when(depth <= 32, by_id).otherwise(F.concat(by_id, by_row))
    return F.substring(whole, F.lit(1), depth)


def unused_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _limits(rows: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """(groups, digits, depth, wanted) of each class of more than n rows: its n-th row
    has these first digits, and so many rows with them belong to the first n."""
    open_rows, done = rows, None
    wanted = F.lit(n).cast("bigint")
    kept: DataFrame | None = None
    for depth in DEPTHS:
        counts = open_rows.groupBy(*groups, _first_digits(order, depth).alias("_d")).agg(
            F.count("*").alias("_rows"), *([] if kept is None else [F.max("_left").alias("_left")])
        )
        so_far = Window.partitionBy(*groups).orderBy("_d")
        placed = counts.withColumn("_upto", F.sum("_rows").over(so_far)).withColumn(
            "_wanted", wanted if kept is None else F.col("_left")
        )
        crossing = placed.where("_upto >= _wanted and _upto - _rows < _wanted")
        total = F.sum("_rows").over(Window.partitionBy(*groups))
        if kept is None:  # classes of n rows and fewer have no limit
            crossing = placed.withColumn("_all", total).where(
                "_all > _wanted and _upto >= _wanted and _upto - _rows < _wanted"
            )
        found = settle(
            crossing.select(
                *groups,
                F.col("_d").alias("digits"),
                F.lit(depth).alias("depth"),
                (F.col("_wanted") - F.col("_upto") + F.col("_rows")).alias("wanted"),
                (F.col("_rows") > FEW_ROWS).alias("_many"),
            ),
            "limits",
        )
        few = found.where("not _many" if depth != DEPTHS[-1] else F.lit(True)).drop("_many")
        done = few if done is None else done.unionByName(few)
        if depth == DEPTHS[-1] or found.where("_many").isEmpty():
            return settle(done, "limits")
        kept = found.where("_many").select(
            *[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)],
            F.col("digits").alias("_at"),
            F.col("wanted").alias("_left"),
        )
        same = [rows[g].eqNullSafe(kept[f"_g{k}"]) for k, g in enumerate(groups)]
        side = F.broadcast(kept) if is_small(kept, SMALL_ROWS) else kept
        open_rows = rows.join(side, reduce(and_, same)).where(
            _first_digits(order, depth) == F.col("_at")
        )
    raise AssertionError("the last depth returns")


def _first_of_few(
    at_limit: DataFrame, columns: list[str], groups: list[str], order: list[Column], id: str, wanted: str
) -> DataFrame:
    """The first rows at the limit of each class; equal rows are counted.

    The few rows are stored. Their hashes and ids alone are put in order, as one array
    per class, and tell how many of each row are taken.
    """
    same = f"{wanted}_rows"
    by_id, by_row = order
    counted = at_limit.groupBy(*columns, wanted).agg(F.count("*").alias(same))
    few = settle(counted.withColumns({f"{wanted}_hash": by_id, f"{wanted}_row": by_row}), "at-limit")
    keys = [f"{wanted}_hash", id, f"{wanted}_row"]
    key = F.struct(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)], F.col(same).alias("_same"))
    listed = few.groupBy(*groups).agg(
        F.array_sort(F.collect_list(key)).alias("_keys"), F.max(wanted).alias("_wanted")
    )

    def left(one: Column, place: Column) -> Column:
        before = F.aggregate(
            F.slice("_keys", F.lit(1), place), F.lit(0).cast("bigint"), lambda all, k: all + k["_same"]
        )
        return one.withField("_times", F.least(F.col("_wanted") - before, one["_same"]))

    side = listed.select(
        *[F.col(g).alias(f"_g{n}") for n, g in enumerate(groups)],
        F.inline(F.filter(F.transform("_keys", left), lambda k: k["_times"] > 0)),
    )
    if is_small(few.select(*groups, *keys), SMALL_ROWS):
        side = F.broadcast(side)
    equal = [few[g].eqNullSafe(side[f"_g{n}"]) for n, g in enumerate(groups)]
    equal += [few[k].eqNullSafe(side[f"_{n}"]) for n, k in enumerate(keys)]
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), side["_times"])).alias(f"{wanted}_no")
    met = few.join(side, reduce(and_, equal))
    return met.select(*[few[c] for c in columns], copies).select(*columns)


def stratified_split(
    df: DataFrame, label: str, id: str, share: float, seed: int = fixed.SEED
) -> DataFrame:
    """(id, label, split): the first rows of each class in shuffled order validate.

    A class of n rows gives floor(share * n). Rows are ordered by a hash; its prefix
    cuts each class into even ranges whose counts tell where they lie, so no class is
    ever sorted as a whole. Rows without a label are left out.
    """
    ranged = (
        df.where(F.col(label).isNotNull())
        .select(F.col(id).alias("id"), F.col(label).alias("label"))
        .withColumn("_order", _shuffled(F.lit(f"{seed}:"), F.col("id")))
        .withColumn("_range", F.substring("_order", 1, PREFIX_DIGITS))
    )
    counts = ranged.groupBy("label", "_range").agg(F.count("*").alias("_rows"))
    by_range = Window.partitionBy("label").orderBy("_range")
    offsets = counts.select(
        "label",
        "_range",
        (
            F.sum("_rows").over(by_range.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_rows")
        ).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy("label")).alias("_all"),
    )
    inside = Window.partitionBy("label", "_range").orderBy("_order", "id")
    place = F.col("_offset") + F.row_number().over(inside)
    return (
        ranged.join(offsets, ["label", "_range"])
        .withColumn("_place", place)
        .select(
            "id",
            "label",
            F.when(F.col("_place") <= F.floor(F.lit(share) * F.col("_all")), "validation")
            .otherwise("train")
            .alias("split"),
        )
    )


def training_batches(
    df: DataFrame,
    id: str,
    batch: int = fixed.BATCH_ROWS,
    accumulation: int = fixed.ACCUMULATION,
    epochs: int = fixed.EPOCHS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Shuffled position, micro-batch and optimizer step of each id and epoch.

    The shuffle order is that of a hash, so its hex prefix cuts every epoch into
    even ranges: a row's position is its rank in the range plus the size of the
    ranges before. No sort sees more than one range, and a rerun changes nothing.
    """
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    ranged = (
        df.select(F.col(id).alias("id"), epoch)
        .withColumn(
            "_order",
            _shuffled(F.concat(F.lit(f"{seed}:"), F.col("epoch"), F.lit(":")), F.col("id")),
        )
        .withColumn("_range", F.substring("_order", 1, PREFIX_DIGITS))
    )
    before = (
        Window.partitionBy("epoch").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy("epoch", "_range")
        .agg(F.count("*").alias("_rows"))
        .select(
            "epoch", "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
        )
    )
    inside = Window.partitionBy("epoch", "_range").orderBy("_order", "id")
    pos = F.col("_offset") + F.row_number().over(inside) - 1
    return (
        ranged.join(offsets, ["epoch", "_range"])
        .withColumn("pos", pos)
        .select(
            "epoch",
            "pos",
            F.floor(F.col("pos") / batch).alias("micro_batch"),
            F.floor(F.col("pos") / (batch * accumulation)).alias("step"),
            "id",
        )
    )


def permuted_batches(
    df: DataFrame,
    id: str,
    batch: int = fixed.BATCH_ROWS,
    accumulation: int = fixed.ACCUMULATION,
    epochs: int = fixed.EPOCHS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """As `training_batches`, with one sort for any number of epochs.

    Ids are numbered once, in their order. Each epoch's position is a keyed permutation
    of that number, worked out per row by the swap-or-not shuffle: in each round the
    numbers x and key - x (modulo the rows) are partners, and one hashed bit decides for
    both whether they change places. Rows with equal or null ids have numbers of their own.
    """
    ids = settle(df.select(F.col(id).alias("id")), "ids")
    n = max(ids.count(), 1)
    per_epoch = F.array(
        *[
            F.struct(F.lit(epoch).alias("epoch"), F.array(*_swap_keys(seed, epoch, n)).alias("keys"))
            for epoch in range(epochs)
        ]
    )
    drawn = numbered(ids, ["id"], "number").select("id", "number", F.inline(per_epoch))

    def swapped(x: Column, key: Column) -> Column:
        partner = F.pmod(key["key"] - x, F.lit(n).cast("bigint"))
        digest = F.md5(F.concat(key["prefix"], F.greatest(x, partner).cast("string")))
        return F.when(F.substring(digest, 1, 1) >= "8", partner).otherwise(x)

    placed = drawn.withColumn("pos", F.aggregate("keys", F.col("number").cast("bigint"), swapped))
    return placed.select(
        "epoch",
        "pos",
        F.floor(F.col("pos") / batch).alias("micro_batch"),
        F.floor(F.col("pos") / (batch * accumulation)).alias("step"),
        "id",
    )


def _swap_keys(seed: int, epoch: int, n: int) -> list[Column]:
    """Key of each round and the beginning of what its bits are hashed from."""
    keys = []
    for turn in range(fixed.SWAP_ROUNDS):
        prefix = f"{seed}:{epoch}:{turn}"
        key = int(md5(prefix.encode()).hexdigest()[:12], 16) % n
        fields = F.lit(f"{prefix}:").alias("prefix"), F.lit(key).cast("bigint").alias("key")
        keys.append(F.struct(*fields))
    return keys


#: Stands for an id that is null.
NO_ID = "null"


def _shuffled(prefix: Column, id: Column) -> Column:
    return F.md5(F.concat(prefix, F.coalesce(id.cast("string"), F.lit(NO_ID))))
