"""Parallel reading of CSV files whose quoted fields may hold line breaks.

Spark's text source splits files over tasks at any line break, whether it ends a row or
stands in a quoted field. Which it is depends on all that comes before, so every split
is followed for both cases, that it begins outside and inside quotes. One row per split
then says where each of them leads; composed in file order these rows settle the case
of every split. Lines of which both cases say that they belong to one row are joined
where they are, which is nearly all: the cases agree from the first line on that ends
alike in both. Only the other parts of rows are brought together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from intentloom.session import settle

# Ship this module inside the pickled functions: executors then need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What stands between a closing quote, or an unquoted field's start, and the comma.
_REST = '(?:[^",][^,]*)?'
#: What is left of a quoted field, with its closing quote.
_CLOSING = f'(?:[^"]|"")*"{_REST}'
#: A whole field outside quotes, or a quoted one that ends in the same line.
_FIELD = f'(?:"{_CLOSING}|{_REST})'
#: Lines that end outside quotes, if they begin outside or inside.
CLOSED = (f"\\A{_FIELD}(?:,{_FIELD})*\\z", f"\\A{_CLOSING}(?:,{_FIELD})*\\z")


def line_ends(lines: pa.Array) -> np.ndarray:
    """Whether a quoted field is open at the end of each line: if none is open at its
    start, and if one is.

    A quote opens a field only at its start, two quotes in a quoted field are one, and
    what stands between a closing quote and the next comma belongs to the field.
    """
    data = lines.cast(pa.binary())
    ends = np.zeros((2, len(lines)), dtype=bool)
    ends[1] = True
    quoted = np.flatnonzero(pc.match_substring(data, '"').to_numpy(zero_copy_only=False))
    chosen = data.take(pa.array(quoted))
    for inside, pattern in enumerate(CLOSED):
        closed = pc.match_substring_regex(chosen, pattern)
        ends[inside, quoted] = ~closed.to_numpy(zero_copy_only=False)
    return ends


def ends_inside(line: str, inside: bool) -> bool:
    """`line_ends` of one line."""
    return bool(line_ends(pa.array([line]))[int(inside), 0])


def _followed(ends: np.ndarray, state: bool) -> np.ndarray:
    """The state before every line and after the last, from `state` on."""
    after = np.arange(ends.shape[1])
    alike = np.maximum.accumulate(np.where(ends[0] == ends[1], after, -1))
    # behind a line that ends alike in both cases only lines count that turn the state
    turned = np.cumsum(ends[0] & ~ends[1])
    known = alike >= 0
    base = np.where(known, ends[0][alike], state)
    turns = turned - np.where(known, turned[alike], 0)
    return np.concatenate([[state], base ^ (turns % 2 == 1)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines, those joined that belong to one row in either case, and what they are.

    `line` is the number of the first one in the split. `starts` and `ends` say whether
    they begin and end inside quotes, first if the split begins outside, then if it
    begins inside; `row_0` and `row_1` count the rows begun so far in these cases.
    """
    here = None
    for batch in batches:
        files, blocks = (batch.column(k).dictionary_encode() for k in range(2))
        names = [files.dictionary.to_pylist(), blocks.dictionary.to_pylist()]
        codes = np.stack([c.indices.to_numpy(zero_copy_only=False) for c in (files, blocks)])
        turns = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
        limits = [0, *turns.tolist(), batch.num_rows]
        for begin, end in zip(limits[:-1], limits[1:]):
            if begin == end:
                continue
            own = (names[0][codes[0, begin]], names[1][codes[1, begin]])
            if own != here:
                here, number, states, rows = own, 0, [False, True], [0, 0]
            values = batch.column(2).slice(begin, end - begin).cast(pa.string())
            ends = line_ends(values)
            followed = np.stack([_followed(ends, s) for s in states])
            counts = np.cumsum(~followed[:, :-1], axis=1) + np.array(rows)[:, None]
            fresh = ~followed[:, :-1].all(axis=0)
            fresh[0] = True
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(values)) - 1
            offsets = np.append(first, len(values)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), values)
            joined = pc.binary_join(lists, "\n")
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own[0]] * n, pa.string()),
                    pa.array([own[1]] * n, pa.int64()),
                    pa.array(first + number, pa.int64()),
                    joined,
                    pc.is_in(joined, pa.array(["", "\r"])),
                    _pairs(followed[:, first]),
                    _pairs(followed[:, last + 1]),
                    pa.array(counts[0, first], pa.int64()),
                    pa.array(counts[1, first], pa.int64()),
                ],
                ["file", "block", "line", "value", "blank", "starts", "ends", "row_0", "row_1"],
            )
            number += len(values)
            states, rows = followed[:, -1].tolist(), counts[:, -1].tolist()


def _pairs(cases: np.ndarray) -> pa.Array:
    offsets = np.arange(0, cases.size + 1, 2, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(cases.T.reshape(-1)))


JOINED = (
    "file string, block bigint, line bigint, value string, blank boolean,"
    " starts array<boolean>, ends array<boolean>, row_0 bigint, row_1 bigint"
)


def read_quoted_csv(
    spark: SparkSession, path: str, schema: str, options: dict[str, str]
) -> DataFrame:
    """Rows of CSV files (a path or glob) in the columns of `schema`.

    The same rows as Spark's own reader gives with `multiLine`, but any number of tasks
    read one file, and line ends in fields stay as written in any file. Every file begins
    with a header, which has to name the columns of the schema in order; blank lines are
    left out. Quotes are doubled inside quoted fields.
    A quoted field that nothing closes ends with its file.

    Joined lines are stored once with what either case makes of them; that job runs when
    this is called. Of splits only one row each is gathered, and for the check of the
    headers only their lines. A row has to fit a task.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = settle(
        text.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        ).mapInArrow(_joined, JOINED),
        "csv-lines",
    )
    blocks = settle(_settled_blocks(lines), "csv-splits")
    placed = lines.join(blocks, ["file", "block"])
    case = F.col("begins").cast("int")
    started = F.get("starts", case)
    row = F.when(F.col("begins"), F.col("row_1")).otherwise(F.col("row_0"))
    # rows that began in an earlier split go to the last row of that split
    placed = placed.select(
        "file",
        F.when(row > 0, F.col("block")).otherwise(F.col("owner.block")).alias("owner"),
        F.when(row > 0, row).otherwise(F.col("owner.rows")).alias("row"),
        "block",
        "line",
        "value",
        (~started & ~F.get("ends", case)).alias("whole"),
        "first",
    )
    columns = spark.createDataFrame([], schema).schema
    head = F.struct("owner", "row") == F.struct("first.block", "first.row")
    head = F.coalesce(head, F.lit(False))
    # stored, or the parsing that checks them would be done for all lines before the join
    _check_headers(settle(_rows(placed.where(head)), "csv-heads"), columns, options)
    data = _rows(placed.where(~head))
    return data.select(_fields(columns, options).alias("_row")).select("_row.*")


def _rows(placed: DataFrame) -> DataFrame:
    """(file, value) of each row; the parts of those that span several come together."""
    alone = placed.where("whole").select("file", "value")
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    spanning = (
        placed.where("not whole")
        .groupBy("file", "owner", "row")
        .agg(F.array_join(parts["value"], "\n").alias("value"))
    )
    # a return before the line break belongs to the break
    shorter = F.left("value", F.length("value") - 1)
    record = F.when(F.endswith("value", F.lit("\r")), shorter).otherwise(F.col("value"))
    rows = alone.unionByName(spanning.select("file", "value"))
    return rows.select("file", record.alias("value")).where("value <> ''")


def _settled_blocks(lines: DataFrame) -> DataFrame:
    """(file, block, begins, owner, first): the case of every split of every file.

    `owner` is the split and number of the last row that begins before the split, `first`
    those of the file's first row that is not blank, the header.
    """
    last = F.max_by(F.col("ends"), F.col("line"))
    filled = F.when(~F.col("blank"), F.struct("line", "row_0"))
    blocks = lines.groupBy("file", "block").agg(
        last.alias("ends"),
        F.max("row_0").alias("rows_0"),
        F.max("row_1").alias("rows_1"),
        F.min(filled).alias("filled"),
    )
    # what the splits before make of the start outside quotes: [if outside, if inside]
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    maps = F.collect_list("ends").over(before)
    begins = F.aggregate(maps, F.lit(False), lambda s, ends: F.get(ends, s.cast("int")))
    known = blocks.withColumn("begins", begins).withColumn(
        "rows", F.when(F.col("begins"), F.col("rows_1")).otherwise(F.col("rows_0"))
    )
    own = F.when(F.col("rows") > 0, F.struct("block", "rows"))
    # only a split that begins outside quotes can hold the first row that is not blank
    head = F.when(
        ~F.col("begins") & F.col("filled").isNotNull(),
        F.struct(F.col("block"), F.col("filled.row_0").alias("row")),
    )
    return known.select(
        "file",
        "block",
        "begins",
        F.last(own, ignorenulls=True).over(before).alias("owner"),
        F.min(head).over(Window.partitionBy("file")).alias("first"),
    )


def _fields(columns: StructType, options: dict[str, str]) -> Column:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    own = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    return F.from_csv(F.col("value"), ddl, own)


def _check_headers(heads: DataFrame, columns: StructType, options: dict[str, str]) -> None:
    """One row per file is looked at; the first that names other columns is an error."""
    names = StructType.fromDDL(", ".join(f"`{f.name}` string" for f in columns))
    wanted = F.array(*[F.lit(f.name) for f in columns])
    shown = heads.select("file", "value", _fields(names, options).alias("_names"))
    found = F.array(*[F.col(f"_names.`{f.name}`") for f in columns])
    wrong = shown.where(~found.eqNullSafe(wanted)).select("file", "value").first()
    if wrong is not None:
        raise ValueError(f"{wrong['file']}: header {wrong['value']!r} is not that of the schema")
