"""Benchmark passages in documents, found with a suffix automaton over item words.

All items are read into one generalised suffix automaton over word numbers. A
document's words stream through it; the automaton holds the longest match that
ends at each word. Where that match is as long as a window of some item that ends
there, the window's words are hit.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentloom.llm.shared import once, slices, unused
from intentloom.session import settle

#: Words are runs of letters and digits; bytes from 0x80 on belong to words.
_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
WINDOW = 10
#: Bytes of item words in one automaton; more items make more automata.
SHARD_BYTES = 16 * 1024 * 1024
#: Parts of which a lot is made up, and lots that a pass over the documents takes.
PARTS_OF_A_LOT, LOTS_AT_ONCE = 64, 4


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD).split()


class ItemAutomaton:
    """Generalised suffix automaton of items, with the windows that end in its states."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        windows: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        for name, words in items:
            size = min(window, len(words))
            state = matched = 0
            for word in words:
                state, matched = self.step(state, matched, word)
                if matched >= size:
                    own = windows[self._holding(state, size)][size]
                    if name is not None:
                        own.add(name)
        self._mark(windows)

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:  # another item has brought this string already
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        state = self._add({}, self.length[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last < 0:
            self.link[state] = 0
        else:
            target = self.next[last][word]
            fits = self.length[target] == self.length[last] + 1
            self.link[state] = target if fits else self._split(last, word, target)
        return state

    def _add(self, ways: dict[bytes, int], length: int, link: int = -1) -> int:
        self.next.append(ways)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, before: int, word: bytes, target: int) -> int:
        """A state of its own for the shorter strings of `target`."""
        copy = self._add(dict(self.next[target]), self.length[before] + 1, self.link[target])
        self.link[target] = copy
        while before >= 0 and self.next[before].get(word) == target:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def step(self, state: int, matched: int, word: bytes) -> tuple[int, int]:
        while (following := self.next[state].get(word)) is None and state:
            state = self.link[state]
            matched = self.length[state]
        return (0, 0) if following is None else (following, matched + 1)

    def _holding(self, state: int, size: int) -> int:
        """The state of the last `size` words of a match."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, windows: dict[int, dict[int, set[str]]]) -> None:
        """For each state the windows that end there, from long to short: (size, items)."""
        self.ends: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = sorted(windows.get(state, {}).items(), reverse=True)
            shorter = self.ends[self.link[state]]
            self.ends[state] = tuple((s, frozenset(n)) for s, n in own) + shorter
        self.least = min((s for sizes in windows.values() for s in sizes), default=0)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words as (start, end), and the items whose windows occur."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.least:
            return runs, items
        ways, link, length, ends, least = self.next, self.link, self.length, self.ends, self.least
        state = matched = 0
        for at, word in enumerate(words, 1):
            following = ways[state].get(word)
            if following is None:
                while state and following is None:
                    state = link[state]
                    matched = length[state]
                    following = ways[state].get(word)
                if following is None:
                    continue
            state = following
            matched += 1
            if matched < least:
                continue
            size = 0
            for longest, names in ends[state]:
                if longest <= matched:
                    size = size or longest
                    items |= names
            if size:
                start = at - size
                if runs and runs[-1][1] >= start:
                    start = min(start, runs[-1][0])
                    while len(runs) > 1 and runs[-2][1] >= start:
                        runs.pop()
                        start = min(start, runs[-1][0])
                    runs[-1] = (start, at)
                else:
                    runs.append((start, at))
        return runs, items


FOUND_DDL = (
    "struct<n_words:bigint,hits:array<struct<start:int,end:int>>,items:array<string>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FOUND = pa.struct(
    [("n_words", pa.int64()), ("hits", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))]
)


def _item_lots(
    items: DataFrame, id_col: str, text_col: str
) -> Iterator[list[tuple[str | None, str]]]:
    """Distinct items in lots of bounded bytes, fetched one after another.

    They are dealt by a hash over parts much smaller than a lot, whose bytes are counted
    first; as many parts make a lot as fit it.
    """
    items = items.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")
    ).where("text is not null").distinct()
    items = settle(items, "items")
    size = F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0))
    total = items.agg(F.sum(size)).first()[0] or 0
    parts = PARTS_OF_A_LOT * max(1, -(-total // SHARD_BYTES))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    bytes_of = dict(items.groupBy(part).agg(F.sum(size)).collect())
    first, held = 0, 0
    for k in range(parts + 1):
        own = bytes_of.get(k, 0)
        if k == parts or held and held + own > SHARD_BYTES:
            lot = items.where((part >= first) & (part < k))
            yield [(r["id"], r["text"]) for r in lot.collect()]
            first, held = k, 0
        held += own


def _automaton(items: list[tuple[str | None, str]], window: int) -> ItemAutomaton:
    digest = hashlib.sha256(repr((items, window)).encode()).hexdigest()
    read = lambda: ItemAutomaton([(n, words_of(t)) for n, t in items], window)
    return once(("items", digest), read)


def match_udf(items: object, window: int) -> Callable:
    """Arrow UDF: text -> its words, hit runs and items, for one broadcast lot of items."""

    @F.arrow_udf(FOUND_DDL)
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = _automaton(items.value, window)
        for part in slices(batches):
            rows = []
            for text in part.to_pylist():
                words = words_of(text or "")
                runs, names = automaton.hits(words)
                spans = [{"start": a, "end": b} for a, b in runs]
                rows.append({"n_words": len(words), "hits": spans, "items": sorted(names)})
            yield pa.array(rows, type=_FOUND)

    return match.asNondeterministic()  # else a filter on its result would run it twice


def _joined(found: list[Column]) -> Column:
    """What several lots of items found in one text, put together."""
    if len(found) == 1:
        return found[0]
    spans = F.sort_array(F.flatten(F.array(*[f["hits"] for f in found])))
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, span: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], span["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(span))),
    )
    items = F.sort_array(F.array_distinct(F.flatten(F.array(*[f["items"] for f in found]))))
    return F.struct(
        found[0]["n_words"].alias("n_words"), merged.alias("hits"), items.alias("items")
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    out: str,
    window: int = WINDOW,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """`docs` with a column `out`: struct(n_words, hits array<struct(start, end)>, items).

    Words are lower-cased (A-Z) runs of letters, digits and all characters beyond
    ASCII. A window is `window` consecutive words of an item; an item with fewer
    words is one window, one with none has no window. `hits` are the maximal runs of
    document words that lie in windows, `items` the sorted ids of the items with
    windows in the text. Null texts have no words, items with a null text no windows. The
    words of an item with a null id are hit like those of any other, but it adds no id;
    items with the same id count as one. All other columns stay.

    Items are broadcast in lots of SHARD_BYTES (or one of some items' texts more). A pass
    over the documents takes LOTS_AT_ONCE of them, so the memory of a worker and of the
    driver is bounded however many items there are.
    """
    context = docs.sparkSession.sparkContext
    so_far = unused(docs, "_so_far")
    lots, done = _item_lots(items, item_id, item_text), False
    while sent := [context.broadcast(lot) for lot in itertools.islice(lots, LOTS_AT_ONCE)]:
        if done:  # the next lots go over stored rows, after the workers gave up the last ones
            docs = settle(docs, "leaks")
        names = [unused(docs, f"_lot_{k}") for k in range(len(sent))]
        for name, lot in zip(names, sent):
            docs = docs.withColumn(name, match_udf(lot, window)(F.col(text_col)))
        found = [F.col(n) for n in names] + [F.col(so_far)] * done
        docs = docs.withColumn(so_far, _joined(found)).drop(*names)
        done = True
    others = [c for c in docs.columns if c not in (out, so_far)]
    return docs.select(*others, F.col(so_far).alias(out))


_ANY_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def without_spans(text: str, spans: list[dict]) -> str:
    """The text without the characters from the first to the last word of each run."""
    if not spans:
        return text
    places = [m.span() for m in _ANY_WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return "".join([*kept, text[at:]])


@F.arrow_udf(T.StringType())
def cut_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    cut = [
        None if text is None else without_spans(text, runs or [])
        for text, runs in zip(texts.to_pylist(), spans.to_pylist())
    ]
    return pa.array(cut, pa.string())


def remove_leaks(
    docs: DataFrame,
    items: DataFrame,
    coverage: float = 0.5,
    window: int = WINDOW,
    text_col: str = "text",
) -> DataFrame:
    """Documents without the passages of items; all columns stay.

    A run of hit words is cut out of its text. A document whose hit words are more
    than `coverage` of its words goes as a whole. Other documents, null and empty
    texts among them, stay as they are.
    """
    found = unused(docs, "_leaks")
    hit = F.aggregate(
        F.col(found)["hits"], F.lit(0), lambda n, span: n + span["end"] - span["start"]
    )
    return (
        find_leaks(docs, items, found, window, text_col)
        .where(hit <= F.lit(coverage) * F.col(found)["n_words"])
        .withColumn(
            text_col,
            F.when(
                F.size(F.col(found)["hits"]) > 0,
                cut_spans(F.col(text_col), F.col(found)["hits"]),
            ).otherwise(F.col(text_col)),
        )
        .drop(found)
    )
