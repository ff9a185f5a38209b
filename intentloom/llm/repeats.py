"""Passages of many bytes that stand in two places, found by a prefix-free parse.

A rolling hash of the bytes before a place triggers a phrase border there, so equal
text has equal borders, and a passage that stands twice is made of phrases that stand
twice, but for its two ends. Phrases are counted first: a window of SPAN bytes that holds
a phrase of which the corpus has only one cannot stand twice. Most text ends here, and
only hashes of phrases were shuffled.

Every window that is left is named by the phrases it holds whole: from its first border
to its last. Neighbouring windows with the same borders make a cell. Windows can only be
equal in cells of one name and at the same distance from the border, so:

- a cell whose name stands alone in the corpus holds no repeated window;
- where all cells of a name are equal throughout, all their windows are repeated;
- only the cells of the other names, at the ends of repeated passages, are cut into
  small cells that go through the same, and of what is left single windows are
  compared, by their own hash.

A text that has copies stands for them with their number, and only texts with cells to
cut, or with bytes to remove, are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.llm.shared import lists, once
from intentloom.operators.presence import BITMAP_BITS, BITS_PER_KEY, MOST_BITMAPS, may_be_listed
from intentloom.operators.scale import spread_join
from intentloom.session import settle

SPAN = 400
#: Bytes that a border depends on.
TRIGGER = 24
#: Windows of the small cells at the ends of repeated passages.
SMALL_CELL = 8
#: Rows of a batch that are worked on at a time.
ROWS = 256
#: One border in so many bytes; each further level serves windows without any so far.
LEVELS = (192, 48, 8)
#: One border in so many bytes, for the phrases that are counted.
PHRASE = 48
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)

CELL_DDL = "array<struct<name:bigint,content:bigint,start:int,size:int,lead:int>>"
_CELL_FIELDS = (
    ("name", pa.int64()),
    ("content", pa.int64()),
    ("start", pa.int32()),
    ("size", pa.int32()),
    ("lead", pa.int32()),  # from the first window to its first border
)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    size = 1 << max(12, n.bit_length())

    def build() -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(BASE, -1, 1 << 64)
        return tuple(
            np.concatenate(
                [np.ones(1, np.uint64), np.full(size - 1, b, dtype=np.uint64)]
            ).cumprod(dtype=np.uint64)
            for b in (BASE, inverse)
        )

    up, down = once(("powers", size), build)
    return up[:n], down[:n]


class Hashed:
    """Rolling hashes of a text: of any stretch of it, from sums over its beginnings."""

    def __init__(self, data: bytes):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(np.frombuffer(data, dtype=np.uint8) * up[:-1], out=self.sums[1:])
        self.triggers = self.sums[TRIGGER:] - self.sums[:-TRIGGER]
        self.triggers *= self.down[:-TRIGGER]

    @staticmethod
    def _mixed(hashes: np.ndarray) -> np.ndarray:
        hashes ^= hashes >> np.uint64(32)
        hashes *= MIX
        hashes ^= hashes >> np.uint64(29)
        return hashes

    def borders(self, every: int) -> np.ndarray:
        """Places before which TRIGGER bytes ask for a border: their hash is among the highest.

        The highest bits depend on all bytes, and NUL bytes, of hash 0, ask for none.
        """
        return np.flatnonzero(self.triggers >= np.uint64((1 << 64) - (1 << 64) // every)) + TRIGGER

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first and end byte of each stretch between borders, triggers included."""
        borders = self.borders(PHRASE)
        begins, ends = borders[:-1] - TRIGGER, borders[1:]
        hashes = (self.sums[ends] - self.sums[begins]) * self.down[begins]
        return self._mixed(hashes + (ends - begins).astype(np.uint64) * MIX), begins, ends


def phrase_hashes(data: bytes) -> np.ndarray:
    """Signed hashes of a text's phrases; a text without a window has none."""
    if len(data) < SPAN:
        return np.empty(0, dtype=np.int64)
    return Hashed(data).phrases()[0].view(np.int64)


def open_runs(hashed: Hashed, last: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of windows, up to `last`, that hold only phrases whose
    bit in `known` is on."""
    hashes, begins, ends = hashed.phrases()
    at = hashes & np.uint64(len(known) * 8 - 1)
    bits = known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
    lone = np.flatnonzero(bits == 0)
    # windows that hold the phrase whole begin at low..high; both rise from phrase to phrase
    low, high = np.maximum(ends[lone] - SPAN, 0), np.minimum(begins[lone], last)
    low, high = low[low <= high], high[low <= high]
    begins, limits = np.append(0, high + 1), np.append(low, last + 1)
    return begins[begins < limits], limits[begins < limits]


def open_windows(hashed: Hashed, last: int, known: np.ndarray) -> np.ndarray:
    """Whether each window up to `last` is in one of the open runs."""
    begins, limits = open_runs(hashed, last, known)
    places = np.arange(last + 1)
    return np.searchsorted(begins, places, "right") > np.searchsorted(limits, places, "right")


def _changes(borders: np.ndarray, last: int) -> np.ndarray:
    """Window starts up to `last` from which on the first or last border is another."""
    moves = np.concatenate([borders - TRIGGER + 1, borders - SPAN])
    return moves[(moves > 0) & (moves <= last)]


def cells(data: bytes, known: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """A text's cells as columns, see _CELL_FIELDS; with `known`, those of open windows."""
    last = len(data) - SPAN
    if last < 0:
        return _columns()
    hashed = Hashed(data)
    if known is None:
        begins, limits = np.array([0]), np.array([last + 1])
    else:
        begins, limits = open_runs(hashed, last, known)
    if not len(begins):
        return _columns()

    def usable_changes(borders: np.ndarray) -> np.ndarray:
        moves = _changes(borders, last)
        run = np.searchsorted(begins, moves, "right") - 1
        return moves[(run >= 0) & (moves < limits[run])]

    def ends_of(starts: np.ndarray) -> np.ndarray:
        run_ends = limits[np.searchsorted(begins, starts, "right") - 1]
        return np.minimum(np.append(starts[1:], last + 1), run_ends)

    borders = hashed.borders(LEVELS[0])
    starts = np.unique(np.concatenate([usable_changes(borders), begins]))
    held = _ends(starts, borders)
    for every in [*LEVELS[1:], None]:
        # windows without a border of the levels so far are cut by the next one
        empty = held[0] > held[1]
        if not empty.any():
            break
        borders = hashed.borders(every) if every else None
        if borders is None:
            more = np.concatenate(
                [np.arange(a, b) for a, b in zip(starts[empty], ends_of(starts)[empty])]
            )
        else:
            more = usable_changes(borders)
            more = more[empty[np.searchsorted(starts, more, "right") - 1]]
        all_starts = np.unique(np.concatenate([starts, more]))
        of_cell = np.searchsorted(starts, all_starts, "right") - 1
        ends = [h[of_cell] for h in held]
        if borders is not None:
            again = _ends(all_starts, borders)
            ends = [np.where(empty[of_cell], new, old) for new, old in zip(again, ends)]
        starts, held = all_starts, ends
    sizes = ends_of(starts) - starts
    # without any border: a cell of one window, named by its bytes
    bare = held[0] > held[1]
    leads = np.where(bare, 0, held[0] - starts)
    names = np.where(bare, starts, held[0] - TRIGGER), np.where(bare, starts + SPAN, held[1])
    return _columns(
        _digests(data, *names, bare.astype(np.int64)),
        _digests(data, starts, starts + sizes - 1 + SPAN, np.where(bare, 1, leads)),
        starts, sizes, leads,
    )


def small_cells(
    data: bytes, at: np.ndarray, size: np.ndarray, lead: np.ndarray, width: int
) -> tuple[np.ndarray, ...]:
    """The cells cut where the distance to their border passes a multiple of `width`.

    A small cell is named by the bytes that all windows of its distances have in common,
    so cells that share no window mostly have names of their own.
    """
    at, size, lead = (column.astype(np.int64) for column in (at, size, lead))
    most, least = lead // width, (lead - size + 1) // width  # distances fall along a cell
    pieces = most - least + 1
    of_cell = np.repeat(np.arange(len(at)), pieces)
    within = np.arange(len(of_cell)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    multiple = most[of_cell] - within
    leads = np.minimum(lead[of_cell], multiple * width + width - 1)
    sizes = leads + 1 - np.maximum((lead - size + 1)[of_cell], multiple * width)
    border = (at + lead)[of_cell]
    starts, inside = border - leads, border - multiple * width
    return _columns(
        _digests(data, inside, inside - width + 1 + SPAN, multiple),
        _digests(data, starts, starts + sizes - 1 + SPAN, ~leads & 0xFFFFFFFF),
        starts, sizes, leads,
    )


def _digests(data: bytes, begins: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> list[int]:
    """A hash of each stretch of a text, with a seed of its own."""
    digest = xxhash.xxh3_64_intdigest
    rows = zip(begins.tolist(), ends.tolist(), seeds.tolist())
    return [digest(data[begin:end], seed) for begin, end, seed in rows]


def _columns(
    names: Sequence[int] = (), contents: Sequence[int] = (), *places: np.ndarray
) -> tuple[np.ndarray, ...]:
    places = places or [()] * (len(_CELL_FIELDS) - 2)
    return _signed(names), _signed(contents), *[np.asarray(p, dtype=np.int32) for p in places]


def _ends(starts: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last border of the windows at `starts`; first > last if there is none."""
    padded = np.concatenate([[-1], borders, [np.iinfo(np.int64).max]])
    first = padded[np.searchsorted(borders, starts + TRIGGER) + 1]
    last = padded[np.searchsorted(borders, starts + SPAN, "right")]
    return first, last


def _signed(values: Sequence[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _cell_lists(texts: list[tuple[np.ndarray, ...]]) -> pa.Array:
    """Arrow list array of the cells of several texts."""
    arrays = [
        lists([text[k] for text in texts], kind) for k, (_, kind) in enumerate(_CELL_FIELDS)
    ]
    rows = pa.StructArray.from_arrays(
        [a.values for a in arrays], fields=[pa.field(*f) for f in _CELL_FIELDS]
    )
    return pa.ListArray.from_arrays(arrays[0].offsets, rows)


def _slices(*arrays: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    for start in range(0, len(arrays[0]), ROWS):
        yield tuple(a.slice(start, ROWS) for a in arrays)


def _utf8(texts: pa.Array) -> list[bytes]:
    """The bytes of texts; a null has none."""
    return texts.cast(pa.large_binary()).fill_null(b"").to_pylist()


def _fields(rows: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of lists of structs, a null's is 0, and the fields of all structs in turn."""
    sizes = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
    columns = rows.flatten().flatten()
    return sizes, [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]


def _phrases_udf() -> Callable:
    @F.arrow_udf("array<bigint>")
    def phrases(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in _slices(batch):
                yield lists([phrase_hashes(text) for text in _utf8(texts)], pa.int64())

    return phrases


def _repeated_bits(texts: DataFrame) -> Broadcast:
    """A bit for the hash of each phrase that stands twice, in at most 8 MiB.

    With very many such phrases more bits are on than need be, never fewer.
    """
    hashes = texts.select(F.explode(_phrases_udf()(F.col("text"))).alias("phrase"))
    twice = hashes.groupBy("phrase").count().where("count > 1").select("phrase")
    twice = settle(twice, "phrases")
    wanted = -(-twice.count() * BITS_PER_KEY // BITMAP_BITS)
    bitmaps = min(1 << max(wanted - 1, 0).bit_length(), MOST_BITMAPS)
    place = F.col("phrase").bitwiseAND(F.lit(bitmaps * BITMAP_BITS - 1)) + 1
    bits = twice.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    known = np.zeros((bitmaps, BITMAP_BITS // 8), dtype=np.uint8)
    for row in bits.collect():  # at most MOST_BITMAPS rows of 4 KiB
        known[row["bucket"] - 1] = np.frombuffer(row["bits"], dtype=np.uint8)
    return texts.sparkSession.sparkContext.broadcast(known.reshape(-1))


def _cells_udf(known: Broadcast) -> Callable:
    @F.arrow_udf(CELL_DDL)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (texts,) in _slices(batch):
                yield _cell_lists([cells(text, known.value) for text in _utf8(texts)])

    return parse


def _small_cells_udf(width: int) -> Callable:
    """Arrow UDF: (text, its cells to cut) -> small cells."""

    @F.arrow_udf(CELL_DDL)
    def refine(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for written, wanted in batches:
            for texts, own in _slices(written, wanted):
                sizes, columns = _fields(own)
                cuts = np.cumsum(sizes)[:-1]
                parts = zip(_utf8(texts), *(np.split(column, cuts) for column in columns))
                yield _cell_lists([small_cells(*part, width) for part in parts])

    return refine


CUT_DDL = "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>"
_CUT = pa.struct(
    [
        ("kept", pa.binary()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
    ]
)


def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without all bytes that windows at start..start+size-1 of their spans cover."""
    rows = _utf8(texts)
    sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)  # the texts as one
    counts, (starts, windows) = _fields(spans)
    row = np.repeat(np.arange(len(rows)), counts)
    begins = (np.cumsum(sizes) - sizes)[row] + starts
    order = np.argsort(begins, kind="stable")
    row, begins, ends = row[order], begins[order], (begins + windows - 1 + SPAN)[order]
    ends = np.maximum.accumulate(ends)
    # a removed run ends before a gap, and with its text
    fresh = (begins[1:] > ends[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(np.append(True, fresh)[: len(row)])
    of_run, run_begins = row[first], begins[first]
    run_ends = ends[np.append(first, len(row))[1:] - 1]
    edges = np.zeros(len(data) + 1, dtype=np.int8)
    edges[run_begins] += 1
    edges[run_ends] -= 1
    kept = data[np.cumsum(edges[:-1], dtype=np.int8) == 0]
    removed = np.zeros(len(rows), dtype=np.int64)
    np.add.at(removed, of_run, run_ends - run_begins)
    offsets = np.append(0, np.cumsum(sizes - removed)).astype(np.int32)
    left = [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    columns = [
        pa.Array.from_buffers(pa.binary(), len(rows), left),
        pa.array(sizes),
        pa.array(removed),
        pa.array(np.bincount(of_run, minlength=len(rows)), pa.int64()),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_CUT))


def _cut_udf() -> Callable:
    @F.arrow_udf(CUT_DDL)
    def remove(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            for part, own in _slices(texts, spans):
                yield cut(part, own)

    return remove.asNondeterministic()  # else each field of the result would run it anew


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every text without the bytes of SPAN-byte strings that also start elsewhere.

    Returns `id_col`, `kept` binary (the bytes left; they need not be whole
    characters), `n_bytes`, `n_removed`, `n_spans` bigint; one row per row. "Elsewhere"
    is any other place in any row, the same text included; matches end with their text.
    A null text counts as empty. Repeated rows and exact copies of SPAN bytes or more
    are repeated throughout and lose everything. Null ids stay, other columns are not
    read. Runs jobs when called; what is left to do is one join.

    Texts are named by 128-bit hashes. Copies are one text with their number in all
    tables of cells, and the last join salts the names of many copies.
    """
    text = F.coalesce(text_col, F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5("text")))
    long = keyed.where(F.octet_length("text") >= SPAN)
    known = _repeated_bits(long.select("text"))
    parsed = long.select("key", F.explode(_cells_udf(known)(F.col("text"))).alias("cell"))
    parsed = parsed.groupBy("key", "cell").agg(F.count("*").alias("copies"))
    parsed = settle(parsed.select("key", "copies", "cell.*"), "cells")
    coarse = settle(_repeated(parsed), "repeated-cells")
    met = settle(_with_text(long, coarse), "mixed-texts")
    small = settle(_cut_small(met, SMALL_CELL), "small-cells")
    fine = settle(_repeated(small), "repeated-small-cells")
    met = met.drop("mixed").join(_mixed(fine), ["key", "copies"])
    windows = settle(_cut_small(met, 1), "windows")
    single = _repeated(windows)  # windows of one name are alike or have another content
    spans = coarse.select("key", "copies", "whole")
    for found in (fine, single):
        spans = spans.unionByName(found.select("key", "copies", "whole"))
    spans = spans.groupBy("key", "copies").agg(F.flatten(F.collect_list("whole")).alias("whole"))
    copied = F.col("copies") > 1  # such texts are repeated throughout
    spans = spans.where(copied | (F.size("whole") > 0)).select(
        "key", F.when(~copied, F.col("whole")).alias("whole"), copied.alias("copied")
    )
    return _removed(keyed, settle(spans, "spans"), id_col)


def _removed(keyed: DataFrame, spans: DataFrame, id_col: str) -> DataFrame:
    """The rows with what is left of their texts; only those that may lose bytes move."""
    flagged = may_be_listed(keyed, "key", spans.select("key"), "listed")
    size = F.octet_length("text").cast("bigint")
    none = F.lit(0).cast("bigint")
    as_they_are = flagged.where(~F.col("listed")).select(
        F.col("id").alias(id_col),
        F.col("text").cast("binary").alias("kept"),
        size.alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
    )
    met = spread_join(flagged.where("listed").drop("listed"), spans, "key", "left", ["id", "key"])
    whole = F.array(F.struct(none.cast("int").alias("start"), (size - SPAN + 1).cast("int").alias("size")))
    whole = F.when(F.col("copied"), whole).otherwise(F.col("whole"))
    cut_off = met.select(F.col("id").alias(id_col), _cut_udf()(F.col("text"), whole).alias("_cut"))
    return as_they_are.unionByName(cut_off.select(id_col, "_cut.*"))


def _repeated(found: DataFrame) -> DataFrame:
    """Per text the cells whose windows are all repeated (`whole`), and those whose name
    stands elsewhere with other content (`mixed`). Cells of a name of its own are left out.

    `found` is a stored table, read twice; a text's copies are one row per cell.
    """
    a, b = F.min("content"), F.max("content")
    names = found.groupBy("name").agg(
        F.sum("copies").alias("n"), F.count("*").alias("count"), (a == b).alias("alike")
    )
    names = settle(names.where("n > 1").drop("n"), "names")
    counts, names = names.select("name", "count"), names.select("name", "alike")
    whole = F.when(F.col("alike"), F.struct("start", "size"))
    mixed = F.when(~F.col("alike"), F.struct("start", "size", "lead"))
    return (
        spread_join(found.drop("content"), names, "name", "inner", ["key", "start"], counts)
        .groupBy("key", "copies")
        .agg(F.collect_list(whole).alias("whole"), F.collect_list(mixed).alias("mixed"))
    )


def _mixed(found: DataFrame) -> DataFrame:
    return found.where(F.size("mixed") > 0).select("key", "copies", "mixed")


def _with_text(long: DataFrame, found: DataFrame) -> DataFrame:
    """The texts with mixed cells, once each however many copies there are."""
    flagged = may_be_listed(long, "key", _mixed(found).select("key"), "listed")
    texts = flagged.where("listed").groupBy("key").agg(F.first("text").alias("text"))
    return texts.join(_mixed(found), "key")


def _cut_small(met: DataFrame, width: int) -> DataFrame:
    """The small cells of the mixed cells of every text."""
    small = _small_cells_udf(width)(F.col("text"), F.col("mixed"))
    return met.select("key", "copies", F.explode(small).alias("cell")).select("key", "copies", "cell.*")
