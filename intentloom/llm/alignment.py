"""Alignment of two tokenizations of the same texts, by the bytes of their tokens.

Tokens of both are intervals of bytes. Sorted by start, with the running maximum of
their ends, they fall apart into groups wherever a start reaches that maximum; inside
a group every two tokens that overlap are linked. A batch of documents is one line of
bytes, so this is a few vectorised steps per batch.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from intentloom.llm.merging import LONGEST, Merger
from intentloom.llm.shared import lists, once, slices, unused
from intentloom.llm.tokens import PATTERN, byte_characters
from intentloom.session import settle

#: Parts of texts kept with their ids per worker, in two generations, and the longest.
KEPT_PARTS = 250_000
KEPT_LENGTH = 64
#: Distinct pairs that a task counts before it sends them on.
TASK_PAIRS = 2_000_000
#: Pairs whose counts are broadcast, the most frequent ones: 20 bytes each.
SENT_PAIRS = 1_000_000
SPACE = "▁"
#: Both vocabularies begin a token anew at a single space before anything but white space.
CUT = re.compile(r"(?<! ) (?=\S)")
IRREGULAR = re.compile(r" (?=\s|$)")
#: Characters that every library puts into the same class: ASCII, and letters and signs
#: up to Cyrillic.
COMMON = re.compile("[\t\n\r -\u02ff\u0370-\u0481\u048a-\u052f]+")
SPLIT = regex.compile(PATTERN).findall
#: White space to one side's rules only; such texts are encoded whole.
DOUBTFUL = re.compile("[\x1c-\x1f᠎]")


class TwoVocabularies:
    """Ids and token bytes of texts by a byte-level vocabulary (A) and a piece model (B)."""

    def __init__(self, definition: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        characters = byte_characters()
        rules = json.loads(definition)["model"]
        vocabulary = rules["vocab"]
        self.merger = Merger(vocabulary, rules["merges"])
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(characters[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece model that keeps words apart is needed")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.a_sizes = np.array(list(map(len, self.a_bytes)), dtype=np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        #: the pair's number is a_id * width + b_id
        self.width = len(pieces)
        digits = [str(k).encode() for k in range(max(len(self.a_bytes), self.width))]
        #: ids with the sign that follows: the next id of the side, the other side, a group
        self.written = [d + sign for sign in (b",", b"|", b";") for d in digits]
        self.numbers = len(digits)
        #: part -> ids of A, and of B, as bytes; parts whose bytes differ stand in `unlike`
        self.new: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.unlike: set[str] = set()

    def _first(self, parts: list[str]) -> list[bytes | None]:
        """Ids of A for a space and each part, None if they have other bytes.

        Parts of common letters are split as the vocabulary does and merged together,
        which keeps their bytes; the library takes all others.
        """
        found: dict[str, bytes | None] = {}
        split: dict[str, list[bytes]] = {}
        others = []
        for part in parts:
            if part.isascii() and part.isalpha():
                own = [b" " + part.encode()]
            elif COMMON.fullmatch(part):
                own = [p.encode() for p in SPLIT(" " + part)]
            else:
                others.append(part)
                continue
            if max(map(len, own)) > LONGEST:
                others.append(part)
            else:
                split[part] = own
        distinct = list(set().union(*split.values()))
        ids = dict(zip(distinct, self.merger.encode(distinct)))
        for part, own in split.items():
            found[part] = ids[own[0]] if len(own) == 1 else b"".join([ids[p] for p in own])
        singly = self.a.encode_batch_fast([" " + p for p in others], add_special_tokens=False)
        for part, encoded in zip(others, singly):
            own = encoded.ids
            same = b"".join([self.a_bytes[k] for k in own]) == b" " + part.encode()
            found[part] = array("i", own).tobytes() if same else None
        return [found[p] for p in parts]

    def _encoded(self, parts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides; None where their bytes are not a space and the part."""
        found: list[tuple[bytes, bytes] | None] = []
        seconds = self.b.encode(parts, num_threads=1)
        surface = self.b_bytes
        for part, a, b in zip(parts, self._first(parts), seconds):
            same = a is not None and b"".join([surface[k] for k in b]) == b" " + part.encode()
            found.append((a, array("i", b).tobytes()) if same else None)
        return found

    def _remember(self, parts: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids of all these parts and of those that are remembered."""
        if len(self.new[0]) > KEPT_PARTS:
            self.old, self.new, self.unlike = self.new, ({}, {}), set()
        first, second = self.new
        unseen = parts.difference(first)
        again = unseen.intersection(self.old[0])
        for kept, old in zip(self.new, self.old):
            kept.update((p, old[p]) for p in again)
        unseen = list(unseen - again)
        long: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        for part, ids in zip(unseen, self._encoded(unseen)):
            into = self.new if len(part) <= KEPT_LENGTH else long
            if ids is None:
                self.unlike.add(part)
            into[0][part], into[1][part] = ids or (b"", b"")
        return (first | long[0], second | long[1]) if long[0] else self.new

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """32-bit ids of both sides for each text; None for one that has no tokens.

        A text is cut where both sides begin a token in any case. If the bytes of a part
        differ, the whole text is encoded and compared as one.
        """
        parts: list[list[str]] = []
        for text in texts:
            if DOUBTFUL.search(text):
                parts.append([])
            elif not IRREGULAR.search(text) and text[:1] != " ":
                parts.append(text.split(" "))
            else:
                first, *rest = CUT.split(" " + text)
                parts.append([first[1:], *rest] if first else rest)
        known = [ids.__getitem__ for ids in self._remember(set().union(*parts))]
        found: list[tuple[bytes, bytes] | None] = []
        for text, own in zip(texts, parts):
            if not text:
                found.append(None)
            elif not own or not self.unlike.isdisjoint(own):
                found += self._encoded([text])
            else:
                found.append((b"".join(map(known[0], own)), b"".join(map(known[1], own))))
        return found


def coalesce(
    a_sizes: np.ndarray, b_sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of the tokens of A and B, and the links as positions in A and in B.

    The sizes are those of consecutive tokens over the same bytes, in any number of texts
    one after another.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_starts, b_starts = a_ends - a_sizes, b_ends - b_sizes
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    side = np.repeat(np.array([0, 1], dtype=np.int8), [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), dtype=bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks) - 1
    a_group, b_group = group[: len(a_sizes)], group[len(a_sizes) :]
    # tokens of B that overlap a token of A lie next to each other, in its group
    first = np.searchsorted(b_ends, a_starts, side="right")
    last = np.searchsorted(b_starts, a_ends, side="left")
    times = last - first
    a_link = np.repeat(np.arange(len(a_sizes)), times)
    b_link = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
    return a_group, b_group, a_link, b_link


def _written(
    own: TwoVocabularies, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray
) -> list[bytes]:
    """The ids in the order of their groups, those of A first, each with the sign after it."""
    groups = int(a_group[-1]) + 1
    a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_before, b_before = np.cumsum(a_in) - a_in, np.cumsum(b_in) - b_in
    code = np.empty(len(a) + len(b), dtype=np.int64)
    code[np.arange(len(a)) + b_before[a_group]] = a
    code[np.arange(len(b)) + (a_before + a_in)[b_group]] = b
    end = np.cumsum(a_in + b_in)
    code[end - 1] += 2 * own.numbers
    code[end - b_in - 1] += own.numbers
    written = own.written
    return [written[k] for k in code.tolist()]


class _Aligned:
    """What is found for the documents of a slice."""

    def __init__(self, own: TwoVocabularies, texts: list[str]):
        tokens = own.encode(texts)
        empty = (b"", b"")
        a_parts, b_parts = zip(*[t or empty for t in tokens]) if tokens else ((), ())
        a = np.frombuffer(b"".join(a_parts), dtype=np.int32)
        b = np.frombuffer(b"".join(b_parts), dtype=np.int32)
        self.n_a = np.array([len(p) // 4 for p in a_parts], dtype=np.int64)
        self.n_b = np.array([len(p) // 4 for p in b_parts], dtype=np.int64)
        a_group, b_group, a_link, b_link = coalesce(own.a_sizes[a], own.b_sizes[b])
        # where each document's groups and links end
        a_end, b_end = np.cumsum(self.n_a), np.cumsum(self.n_b)
        groups = np.concatenate([[0], a_group + 1])[a_end]
        self.n_groups = np.diff(groups, prepend=0)
        links = np.searchsorted(a_link, a_end, side="left")
        self.n_links = np.diff(links, prepend=0)
        self.texts, at = [], 0
        written = _written(own, a, b, a_group, b_group) if len(a) else []
        for end in (a_end + b_end).tolist():
            self.texts.append(b"".join(written[at:end])[:-1])
            at = end
        # distinct pairs of each document and how often they are linked in it
        pairs = a[a_link].astype(np.int64) * own.width + b[b_link]
        document = np.repeat(np.arange(len(tokens)), self.n_links)
        found, times = np.unique(document << 40 | pairs, return_counts=True)
        cuts = np.searchsorted(found, np.arange(1, len(tokens)) << 40)
        self.pairs = np.split(found & ((1 << 40) - 1), cuts) if tokens else []
        self.times = np.split(times, cuts) if tokens else []


_FIELDS = {
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups": pa.string(),
    "pairs": pa.list_(pa.int64()),
    "times": pa.list_(pa.int32()),
}
_DDL = (
    "struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,"
    "pairs:array<bigint>,times:array<int>>"
)


def _align_udf(spark: SparkSession, vocabulary: str, model: str) -> Callable:
    with open(vocabulary, encoding="utf-8") as file, open(model, "rb") as other:
        files = spark.sparkContext.broadcast((file.read(), other.read()))

    @F.arrow_udf(_DDL)
    def align(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = once(("aligned", vocabulary, model), lambda: TwoVocabularies(*files.value))
        for part in slices(batches):
            found = _Aligned(own, [text or "" for text in part.to_pylist()])
            yield pa.StructArray.from_arrays(
                [
                    *[pa.array(v) for v in (found.n_a, found.n_b, found.n_groups, found.n_links)],
                    pa.array(found.texts, type=pa.string()),
                    lists(found.pairs, pa.int64()),
                    lists(found.times, pa.int32()),
                ],
                fields=[pa.field(n, k) for n, k in _FIELDS.items()],
            )

    return align


def piece_count(model: str) -> int:
    """How many pieces a model has: what `pairs` are counted by."""
    return sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()


def align_tokens(
    docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Groups and links of the tokens of two vocabularies, one row per row.

    Returns `id_col`, `n_a`, `n_b`, `n_groups`, `n_links`, `groups` (`a1,a2|b1;a3|b2`: the
    ids of both sides, group after group), `pairs` (the distinct linked pairs, as a_id *
    pieces of B + b_id) and `times` (how often each is linked). A text that is null or
    empty, or whose tokens do not give back a space and the text, has no tokens. Repeated
    rows and null ids stay as they are; other columns are not read.
    """
    align = _align_udf(docs.sparkSession, vocabulary, model)
    aligned = docs.select(F.col(id_col).alias(id_col), align(F.col(text_col)).alias("_aligned"))
    return aligned.select(id_col, "_aligned.*")


def pair_counts(aligned: DataFrame, width: int, pairs_col: str = "pairs") -> DataFrame:
    """(pair, n, best): in how many rows a pair is linked, and whether that is the most
    of all pairs of its A id.

    The pairs of a row are distinct. A task adds up what it reads before it sends counts
    on, so a pair that every row holds is sent once per task; `width` is the number of
    pieces of B, and there is one highest count per A id.
    """

    def compacted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            keys, counts = np.unique(
                batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True
            )
            parts.append((keys.astype(np.int64), counts))
            held += len(keys)
            if held > 2 * TASK_PAIRS:
                parts = [compacted(parts)]
                held = len(parts[0][0])
                if held > TASK_PAIRS:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, parts[0])), ["pair", "n"])
                    parts, held = [], 0
        if parts:
            keys, counts = compacted(parts)
            for at in range(0, len(keys), 100_000):
                own = [pa.array(c[at : at + 100_000]) for c in (keys, counts)]
                yield pa.RecordBatch.from_arrays(own, ["pair", "n"])

    sent = aligned.select(pairs_col).mapInArrow(count, "pair bigint, n bigint")
    pairs = settle(sent.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_a = F.floor(F.col("pair") / width).alias("_a")
    most = pairs.groupBy(of_a).agg(F.max("n").alias("_most"))
    # one row per id of A: bounded by the vocabulary
    return pairs.withColumn("_a", of_a).join(F.broadcast(most), "_a").select(
        "pair", "n", (F.col("n") == F.col("_most")).alias("best")
    )


def score_links(aligned: DataFrame, width: int, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """Adds `n_best` and `count_sum` to the rows of `align_tokens`, without pairs and times.

    A pair's count is the number of rows that hold it. The counts of the most frequent
    pairs, `sent_pairs` at most, are broadcast; the rows' other pairs, of which each is in
    few rows, meet their counts by a join. An empty table gives an empty one.
    """
    spark = aligned.sparkSession
    row = unused(aligned, "_row")
    rows = settle(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = settle(pair_counts(rows, width), "pairs")
    # a pair is sent if its count has as many bits as those that fit
    bits = F.length(F.conv(F.col("n").cast("string"), 10, 2))
    sizes = dict(counts.groupBy(bits.alias("bits")).count().collect())
    least, room = max(sizes, default=0) + 1, sent_pairs
    while least > 1 and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    frequent = counts.where(bits >= least).toArrow()
    order = np.argsort(frequent.column("pair").to_numpy())
    known = [frequent.column(c).to_numpy()[order] for c in ("pair", "n", "best")]
    table = spark.sparkContext.broadcast(known)
    whole = least <= 1

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint,rare:array<struct<pair:bigint,times:int>>>")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        keys, n, best = table.value
        for pairs, times in batches:
            size = np.diff(pairs.offsets.to_numpy())
            pair, time = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, times))
            distinct, at = np.unique(pair, return_inverse=True)
            place = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
            there = keys[place] == distinct if len(keys) else np.zeros(len(distinct), dtype=bool)
            place, there = place[at], there[at]
            document = np.repeat(np.arange(len(size)), size)
            counted = np.where(there, n[place] if len(keys) else 0, 0) * time
            topmost = np.where(there & (best[place] if len(keys) else False), time, 0)
            sums = []
            for values in (topmost, counted):
                total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
                end = np.cumsum(size)
                sums.append(pa.array(total[end] - total[end - size]))
            rare = ~there
            held = np.bincount(document[rare], minlength=len(size))
            ends = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
            links = pa.StructArray.from_arrays(
                [pa.array(pair[rare]), pa.array(time[rare].astype(np.int32))], ["pair", "times"]
            )
            yield pa.StructArray.from_arrays(
                [*sums, pa.ListArray.from_arrays(ends, links)], ["n_best", "count_sum", "rare"]
            )

    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    scored = rows.withColumn("_scored", score("pairs", "times"))
    if whole:
        return scored.select(*kept, "_scored.n_best", "_scored.count_sum")
    scored = settle(scored.select(*kept, row, "_scored.*"), "scored")
    links = scored.select(row, F.explode("rare").alias("_link")).select(row, "_link.*")
    met = links.join(counts, "pair").groupBy(row).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("n") * F.col("times")).alias("_sum"),
    )
    both = scored.join(met, row, "left")
    return both.select(
        *kept,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )
