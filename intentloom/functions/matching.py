"""Closest labels of a string by difflib's similarity ratio, as an Arrow UDF.

`closest_labels` makes no pairs: it gets one string per row and tries it against the
label list that its Python worker holds. Character counts bound the ratio from
above, so the exact ratio is computed only while a label can still win.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import functions as F

# Ship this module inside the pickled UDF: executors then need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MATCHES_DDL = "array<struct<label:string,ratio:double>>"
MATCHES_ARROW = pa.list_(pa.struct([("label", pa.string()), ("ratio", pa.float64())]))
REMEMBERED_STRINGS = 50_000
CHAR_CLASSES = 128
# Tokens that are told apart by how common they are; all others count as rarer.
COMMON_TOKENS = 4_095
# A token: its rank, then the code point (21 bits), then the occurrence (30 bits).
POINT_SHIFT, RANK_SHIFT = 30, 51


class LabelMatcher:
    """The n labels most similar to a string, best first, ratio >= cutoff.

    Equal ratios are ordered by label, the larger first. `ratio` takes the label
    as first and the string as second sequence; the order changes the result.
    """

    def __init__(self, labels: list[str], cutoff: float, n: int):
        self.labels = labels
        self.cutoff = cutoff
        self.n = n
        self.lengths = np.array([len(label) for label in labels], dtype=np.int64)
        self.counts = np.stack([_char_counts(label) for label in labels or [""]])

    def upper_bounds(self, text: str) -> np.ndarray:
        """Ratio each label would have if all shared characters lined up."""
        mine = _char_counts(text)
        used = np.flatnonzero(mine)
        shared = np.minimum(self.counts[:, used], mine[used]).sum(axis=1)
        return 2.0 * shared / (self.lengths + len(text))

    def best(self, text: str) -> list[tuple[float, str]]:
        if not self.labels or not text:
            return []
        bounds = self.upper_bounds(text)
        possible = np.flatnonzero(bounds >= self.cutoff)
        found: list[tuple[float, str]] = []
        matcher = SequenceMatcher()
        matcher.set_seq2(text)
        for row in possible[np.argsort(-bounds[possible], kind="stable")]:
            if len(found) == self.n and bounds[row] < found[-1][0]:
                break
            matcher.set_seq1(self.labels[row])
            ratio = matcher.ratio()
            if ratio >= self.cutoff:
                found = sorted([*found, (ratio, self.labels[row])], reverse=True)[: self.n]
        return found


def _char_counts(text: str) -> np.ndarray:
    """Characters per class of code points; sharing a class only loosens the bound."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.bincount(points % CHAR_CLASSES, minlength=CHAR_CLASSES).astype(np.int32)


def closest_labels(labels: Broadcast, cutoff: float, n: int) -> Callable:
    """Arrow UDF: string -> its closest labels; null and empty strings have none."""

    @F.arrow_udf(MATCHES_DDL)
    def closest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = LabelMatcher(labels.value, cutoff, n)

        def matches(text: str | None) -> list[dict]:
            return [{"label": label, "ratio": ratio} for ratio, label in matcher.best(text or "")]

        return _by_distinct(batches, matches, MATCHES_ARROW)

    return closest


def closest_label(labels: Broadcast, cutoff: float) -> Callable:
    """Arrow UDF: string -> its closest label, or null."""

    @F.arrow_udf("string")
    def closest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = LabelMatcher(labels.value, cutoff, 1)

        def match(text: str | None) -> str | None:
            found = matcher.best(text or "")
            return found[0][1] if found else None

        return _by_distinct(batches, match, pa.string())

    return closest


def letter_tokens(common: Broadcast | None) -> Callable:
    """Arrow UDF: string -> its (character, occurrence) tokens as sorted numbers.

    `common` lists unranked tokens, rarer ones first; tokens it does not list precede
    them. The same list has to be used for all strings that are compared.
    """

    @F.arrow_udf("array<bigint>")
    def tokens(texts: pa.Array) -> pa.Array:
        listed = np.array(common.value if common else [], dtype=np.int64)
        order = np.argsort(listed)
        found = [_tokens(text, listed[order], order + 1) for text in texts.to_pylist()]
        ends = np.cumsum([0] + [len(one) for one in found], dtype=np.int32)
        values = np.concatenate([*found, np.empty(0, np.int64)])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return tokens


def _tokens(text: str | None, listed: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.sort(points).astype(np.int64)
    at = np.arange(len(points))
    first = np.searchsorted(points, points)
    tokens = (points << POINT_SHIFT) | (at - first)
    if len(listed):
        place = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
        known = listed[place] == tokens
        tokens = tokens | (np.where(known, ranks[place], 0) << RANK_SHIFT)
    return np.sort(tokens)


def similarity() -> Callable:
    """Arrow UDF: (label, string) -> difflib's ratio; strings are analysed once per batch."""

    @F.arrow_udf("double")
    def ratio(labels: pa.Array, texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        strings, names = coded.dictionary.to_pylist(), labels.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ratios = np.zeros(len(codes))
        matcher, current = SequenceMatcher(), None
        for row in np.argsort(codes, kind="stable"):
            if codes[row] != current:
                current = codes[row]
                matcher.set_seq2(strings[current])
            matcher.set_seq1(names[row])
            ratios[row] = matcher.ratio()
        return pa.array(ratios)

    return ratio


def _by_distinct(
    batches: Iterator[pa.Array], answer: Callable, kind: pa.DataType
) -> Iterator[pa.Array]:
    """Answer each distinct string once per batch, and mostly once per task."""
    known: dict[str | None, object] = {}
    for batch in batches:
        coded = batch.dictionary_encode()
        if len(known) > REMEMBERED_STRINGS:
            known.clear()
        answers = []
        for text in [*coded.dictionary.to_pylist(), None]:
            if text not in known:
                known[text] = answer(text)
            answers.append(known[text])
        rows = coded.indices.fill_null(len(answers) - 1)
        yield pa.array(answers, type=kind).take(rows)
