"""Packing of tokenized documents into sequences of one length.

Which lengths share a sequence is decided on the histogram of lengths, which has no
more entries than a sequence has places (see `binpack`). Spark does the rest: it
encodes and cuts the documents, numbers the pieces of each length, and gives the k-th
piece of a length the k-th place that the packing has for that length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentloom.llm.binpack import complete_bins
from intentloom.llm.merging import LONGEST, Merger
from intentloom.llm.shared import once, slices, unused
from intentloom.session import settle

CAPACITY = 4096
#: Sets and lengths that bin completion looks at, if best fit is not proved the smallest.
EFFORT = 400_000
#: Words kept with their ids per worker, of which the half used last stays when there
#: are more, and the longest kept word.
KEPT_WORDS = 240_000
KEPT_LENGTH = 64
#: Python splits at these, the vocabulary's white space does not hold them.
NOT_SPACE = re.compile("[\x1c-\x1f]")
#: Characters that no library cases, composes or classes differently: Latin without
#: combining marks, raised digits and fractions, Greek without the sigma of two forms,
#: Cyrillic.
COMMON = (
    "!-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u02ff\u0370-\u0373\u0375-\u037d\u037f-\u0386"
    "\u0388-\u03a2\u03a4-\u0481\u048a-\u052f"
)
COMMON_TEXT = re.compile(f"[\\s{COMMON}]*")
COMMON_WORD = re.compile(f"[{COMMON}]+")
#: Texts that are split many at a time, if no small letter of theirs is WIDE.
PLAIN_TEXT = re.compile(f"[\t-\r {COMMON}]*")
#: Fixed value: the vocabulary's split, for common characters: words, single digits,
#: contractions, signs.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
COMMON_SPLIT = re.compile(r"[^\W\d_]+|\d|'(?:[stmd]|re|ve|ll)|(?:[^\w\s]|_)+").findall
#: Begins what goes to the library as a whole; no part of a split text has it.
WHOLE = b"\x1f"
#: Characters that are split at a time, if no single text is longer.
LOT_CHARACTERS = 1 << 22
#: What a byte or character is for COMMON_SPLIT.
SPACE, LETTER, DIGIT, SIGN = range(4)
#: First byte of a character of three or more bytes.
WIDE = re.compile(b"[\xe0-\xff]")


def _kinds() -> np.ndarray:
    """The kind of every character of one or two bytes, as COMMON_SPLIT's patterns tell."""
    patterns = ((LETTER, r"[^\W\d_]"), (DIGIT, r"\d"), (SIGN, r"[^\w\s]|_"))
    kinds = np.full(0x800, SPACE, dtype=np.uint8)
    for kind, pattern in patterns:
        same = re.compile(pattern).fullmatch
        kinds[[c for c in range(len(kinds)) if same(chr(c))]] = kind
    return kinds


def split_common(data: bytes, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What COMMON_SPLIT finds in lower-cased text without WIDE characters; a space ends it.

    Returns the runs of like characters that the text consists of, which of them are
    parts, and where they start. Runs of spaces, and letters that a contraction before
    them has used up, are no parts.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    kind = kinds[codes]
    first = np.flatnonzero(codes >= 0xC2)
    kind[first] = kinds[(codes[first] & 0x1F).astype(np.int64) << 6 | codes[first + 1] & 0x3F]
    kind[first + 1] = kind[first]
    begins = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) + 1
    starts = np.concatenate([[0], begins, [len(codes)]]).astype(np.int32)
    runs = kind[starts[:-1]]
    # a contraction is a single ' and the first one or two letters behind it
    marks = np.flatnonzero((codes[starts[:-2]] == ord("'")) & (np.diff(starts[:-1]) == 1))
    marks = marks[runs[marks + 1] == LETTER]
    at = starts[marks + 1]
    one, two = codes[at], codes[at + 1]  # the last byte is no letter
    single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    double |= (one == ord("l")) & (two == ord("l"))
    starts[marks + 1] += np.where(single, 1, np.where(double, 2, 0)).astype(np.int32)
    parts = (runs != SPACE) & (np.diff(starts) > 0)
    buffers = [None, pa.py_buffer(starts), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(runs), buffers), parts, starts[:-1]


class WordIds:
    """Ids of whole texts by a vocabulary that drops white space, word by word.

    No token reaches over a border of the vocabulary's own split, so the ids of a text
    are those of its parts in turn; a part is encoded once while it is remembered. Parts
    of common characters are merged together; the library takes all others. Texts of
    common characters are split many at a time and only their distinct parts looked up.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(definition)
        rules = json.loads(definition)
        if rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError("another split of words is not handled")
        model = rules["model"]
        self.merger = Merger(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.kinds = _kinds()
        #: remembered parts, their ids and the latest look-up that used each
        self.words, self.ids = pa.array([], pa.binary()), pa.array([], pa.large_binary())
        self.used, self.looks = np.zeros(0, dtype=np.int64), 0

    def _encoded(self, parts: pa.Array) -> pa.Array:
        """The ids of parts that are not remembered."""
        singly = pc.starts_with(parts, WHOLE).to_numpy(zero_copy_only=False)
        singly |= pc.binary_length(parts).to_numpy() > LONGEST
        if not singly.any():
            return self.merger.encode_array(parts)
        texts = [p.removeprefix(WHOLE).decode() for p in parts.filter(pa.array(singly)).to_pylist()]
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        others = pa.array([array("I", e.ids).tobytes() for e in found], pa.large_binary())
        merged = self.merger.encode_array(parts.filter(pa.array(~singly)))
        back = np.argsort(np.argsort(singly, kind="stable"))
        return pa.concat_arrays([merged, others]).take(pa.array(back))

    def _parts(self, text: str) -> list[bytes]:
        if NOT_SPACE.search(text):
            return [WHOLE + text.encode()]
        if COMMON_TEXT.fullmatch(text) and "<|" not in text:
            return [p.encode() for p in COMMON_SPLIT(text.lower())]
        parts: list[bytes] = []
        for word in text.split():
            if COMMON_WORD.fullmatch(word) and "<|" not in word:
                parts += (p.encode() for p in COMMON_SPLIT(word.lower()))
            else:
                parts.append(WHOLE + word.encode())
        return parts

    def _ids(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of many parts, and where among them those of each given one are.

        The given parts are distinct. The remembered ones are looked up among the given
        ones, which are fewer, so that the smaller table is built.
        """
        self.looks += 1
        at = pc.index_in(self.words, value_set=parts).fill_null(-1).to_numpy()
        hit = np.flatnonzero(at >= 0)
        self.used[hit] = self.looks
        place = np.full(len(parts), -1, dtype=np.int64)
        place[at[hit]] = hit
        new = np.flatnonzero(place < 0)
        if not len(new):
            return self.ids, place
        place[new] = len(self.words) + np.arange(len(new))
        fresh = parts.take(pa.array(new))
        words = pa.concat_arrays([self.words, fresh])
        ids = pa.concat_arrays([self.ids, self._encoded(fresh)])
        used = np.concatenate([self.used, np.full(len(new), self.looks)])
        self._remember(words, ids, used)
        return ids, place

    def _remember(self, words: pa.Array, ids: pa.Array, used: np.ndarray) -> None:
        stay = np.flatnonzero(pc.binary_length(words).to_numpy() <= KEPT_LENGTH)
        if len(stay) > KEPT_WORDS:
            stay = np.sort(stay[np.argsort(used[stay], kind="stable")[-(KEPT_WORDS // 2) :]])
        if len(stay) < len(words):
            words, ids, used = words.take(pa.array(stay)), ids.take(pa.array(stay)), used[stay]
        self.words, self.ids, self.used = words, ids, used

    def _common_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of lower-cased texts of common characters."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        runs, parts, starts = split_common(b"\n".join(texts) + b"\n", self.kinds)
        numbered = runs.filter(pa.array(parts)).dictionary_encode()
        ids, place = self._ids(numbered.dictionary)
        number = numbered.indices.to_numpy(zero_copy_only=False)
        _, behind, all_ids = ids.take(pa.array(place[number])).buffers()
        behind = np.frombuffer(behind, np.int64)
        limits = behind[np.searchsorted(starts[parts], ends)].tolist()
        all_ids = memoryview(all_ids or b"")
        return [bytes(all_ids[a:b]) for a, b in zip([0, *limits], limits)]

    def _lots(self, texts: list[str]) -> Iterator[list[tuple[int, bytes | None]]]:
        """Number and lower-cased bytes of the texts, in lots; without bytes if not common."""
        lot, size = [], 0
        for k, text in enumerate(texts):
            common = PLAIN_TEXT.fullmatch(text) and "<|" not in text
            data = text.lower().encode() if common else None
            if data is not None and not data.isascii() and WIDE.search(data):
                data = None
            if lot and size + len(text) > LOT_CHARACTERS:
                yield lot
                lot, size = [], 0
            lot.append((k, data))
            size += len(text)
        yield lot

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        found = [b""] * len(texts)
        for lot in self._lots(texts):
            common = [(k, data) for k, data in lot if data is not None]
            if common:
                for (k, _), ids in zip(common, self._common_ids([data for _, data in common])):
                    found[k] = ids
            others = [(k, self._parts(texts[k])) for k, data in lot if data is None]
            if others:
                distinct = list(set().union(*(own for _, own in others)))
                ids, place = self._ids(pa.array(distinct, pa.binary()))
                look = dict(zip(distinct, ids.take(pa.array(place)).to_pylist())).__getitem__
                for k, own in others:
                    found[k] = b"".join(map(look, own))
        return found


def _pieces_udf(spark: SparkSession, path: str, capacity: int, end_id: int, with_ids: bool) -> Callable:
    with open(path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    ids_ddl = ",ids:array<bigint>" if with_ids else ""
    end = np.array([end_id], dtype="<u4").tobytes()
    wide = capacity * 4

    @F.arrow_udf(f"array<struct<length:bigint,ids_crc32:bigint{ids_ddl}>>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = once(("words", path), lambda: WordIds(definition.value))
        for part in slices(batches):
            found = []
            for ids in coder.encode([text or "" for text in part.to_pylist()]):
                ids += end
                cut = [ids[at : at + wide] for at in range(0, len(ids), wide)]
                found.append(
                    [
                        {"length": len(c) // 4, "ids_crc32": zlib.crc32(c)}
                        | ({"ids": np.frombuffer(c, "<u4").tolist()} if with_ids else {})
                        for c in cut
                    ]
                )
            fields = [("length", pa.int64()), ("ids_crc32", pa.int64())]
            fields += [("ids", pa.list_(pa.int64()))] * with_ids
            yield pa.array(found, type=pa.list_(pa.struct(fields)))

    return pieces


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ids of every whole text and an end id, cut into pieces of `capacity`.

    Returns `id_col`, `piece` (from 0), `start`, `length`, `ids_crc32` (of the ids as
    little-endian unsigned 32-bit numbers) and, if asked for, `ids`. Only longer texts are
    cut, and only the last piece may be shorter. A null text counts as empty: one piece
    of the end id. Repeated rows and null ids give pieces of their own; other columns
    are not read.
    """
    cut = _pieces_udf(docs.sparkSession, vocabulary, capacity, end_id, with_ids)
    pieces = docs.select(F.col(id_col).alias(id_col), cut(F.col(text_col)).alias("_pieces"))
    placed = pieces.select(id_col, F.posexplode("_pieces").alias("piece", "_piece"))
    return placed.select(
        id_col,
        "piece",
        (F.col("piece").cast("bigint") * capacity).alias("start"),
        "_piece.*",
    )


def _numbered(pieces: DataFrame, length_col: str, capacity: int, task: str, rank: str) -> DataFrame:
    """Every row with its task and its place among the task's rows of that length."""
    at = pieces.columns.index(length_col)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 2, dtype=np.int64)
        for batch in batches:
            lengths = batch.column(at).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            lengths = np.clip(lengths, 0, capacity + 1)
            order = np.argsort(lengths, kind="stable")
            found, first, times = np.unique(lengths[order], return_index=True, return_counts=True)
            within = np.arange(len(lengths)) - np.repeat(first, times)
            ranks = np.empty(len(lengths), dtype=np.int64)
            ranks[order] = within + np.repeat(seen[found], times)
            seen[found] += times
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([own] * len(ranks), pa.int32()), pa.array(ranks)],
                [*batch.schema.names, task, rank],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.mapInArrow(number, f"{kinds}, {task} int, {rank} bigint")


def _places(packing: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """(length, first rank, copies in a sequence, first sequence, offset), sorted.

    One row per filling and length: few, as the packing has few fillings.
    """
    rows, ranked, sequence = [], {}, 0
    for filling, times in packing:
        offset = 0
        for length, n in sorted(filling.items(), reverse=True):
            rank = ranked.get(length, 0)
            rows.append((length, rank, n, sequence, offset))
            ranked[length] = rank + n * times
            offset += length * n
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_best_fit(
    pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", effort: int = EFFORT
) -> DataFrame:
    """Adds `sequence_id` and `offset`: few sequences of at most `capacity`, without gaps.

    Best fit of falling lengths packs first; where it is not proved the smallest, bin
    completion looks for fewer sequences, with `effort` as its bound. Both see
    the histogram of lengths only. Rows of a length have no order among themselves, so
    ties and repeated rows need no rule: each gets a place of its own. A length that is
    null, under 1 or over the capacity gets null for both. Columns of these names are
    replaced; an empty table gives an empty one.
    """
    pieces = pieces.drop("sequence_id", "offset")
    task, rank, base = (unused(pieces, c) for c in ("_task", "_rank", "_base"))
    rows = settle(_numbered(pieces, length_col, capacity, task, rank), "pieces")
    # one row per task and length, then the ranks of the tasks before it
    by_task = settle(
        rows.where(F.col(length_col).between(1, capacity))
        .groupBy(F.col(length_col).cast("bigint").alias(length_col), task)
        .agg(F.count("*").alias(base)),
        "lengths",
    )
    found = by_task.groupBy(length_col).agg(F.sum(base).alias(base)).collect()
    packing = complete_bins({r[length_col]: r[base] for r in found}, capacity, effort)
    places = _places(packing)
    before = Window.partitionBy(length_col).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    table = pieces.sparkSession.sparkContext.broadcast(places)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = table.value
        key = known[:, 0] * (1 << 48) + known[:, 1]
        for lengths, ranks in batches:
            fits = pc.is_valid(ranks).to_numpy(zero_copy_only=False)
            length = lengths.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            number = ranks.fill_null(0).to_numpy(zero_copy_only=False)
            if len(known):
                found = known[np.clip(np.searchsorted(key, length * (1 << 48) + number, "right") - 1, 0, None)]
            else:
                found = np.ones((len(length), 5), dtype=np.int64)
            number = number - found[:, 1]
            sequence = found[:, 3] + number // found[:, 2]
            offset = found[:, 4] + number % found[:, 2] * length
            yield pa.StructArray.from_arrays(
                [pa.array(sequence, mask=~fits), pa.array(offset, mask=~fits)],
                names=["sequence_id", "offset"],
            )

    joined = rows.join(bases, [length_col, task], "left")
    spot = unused(joined, "_spot")
    joined = joined.withColumn(spot, place(F.col(length_col), F.col(rank) + F.col(base)))
    return joined.select(*pieces.columns, f"{spot}.sequence_id", f"{spot}.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id` and `ids` of every sequence, from packed pieces with their `ids`.

    A sequence is of bounded length, so grouping by it is safe. The offsets say where a
    piece begins; rows without a sequence are left out.
    """
    rows = packed.where(F.col("sequence_id").isNotNull())
    grouped = rows.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_pieces")
    )
    return grouped.select("sequence_id", F.flatten("_pieces.ids").alias("ids"))
