"""Token counts of a byte-level merge vocabulary, mostly without merging.

A pre-token that is itself a vocabulary string is nearly always one token. Which
strings are is proved once, by merging each of them: those that come out whole
are counted by a lookup. Only the other pre-tokens are merged, each once per
worker while it is remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm.shared import once

#: Fixed value: the split pattern of the public byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_TOKENS = 400_000
KEPT_LENGTH = 64


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file.

    Printable Latin-1 characters stand for themselves, the other bytes take the
    characters from U+0100 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Merging of one vocabulary, by the rank of each pair."""

    def __init__(self, definition: bytes):
        found = json.loads(definition)
        model = found["model"]
        splitter = found["pre_tokenizer"]
        if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or found["normalizer"]:
            raise ValueError("a byte-level merge vocabulary without normalizer is needed")
        if splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError("only the plain byte-level split is handled")
        self.byte = byte_characters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.vocabulary = list(model["vocab"])
        self.specials = [t["content"] for t in found["added_tokens"]]
        self.character = {b: c for c, b in self.byte.items()}

    def count(self, characters: str) -> int:
        """Tokens of one pre-token in byte characters: the lowest rank merges first."""
        parts: list[str | None] = list(characters)
        end = len(parts)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        ranks = self.ranks
        queue = [
            (ranks[pair], k) + pair
            for k, pair in enumerate(zip(parts, parts[1:]))
            if pair in ranks
        ]
        heapq.heapify(queue)
        left = end
        while queue:
            _, k, a, b = heapq.heappop(queue)
            other = after[k]
            if parts[k] != a or other >= end or parts[other] != b:
                continue  # one of the two has been merged meanwhile
            parts[k], parts[other] = a + b, None
            left -= 1
            after[k] = beyond = after[other]
            if beyond < end:
                before[beyond] = k
                if (pair := (parts[k], parts[beyond])) in ranks:
                    heapq.heappush(queue, (ranks[pair], k) + pair)
            if before[k] >= 0 and (pair := (parts[before[k]], parts[k])) in ranks:
                heapq.heappush(queue, (ranks[pair], before[k]) + pair)
        return left

    def whole_tokens(self) -> list[str]:
        """Vocabulary strings that are texts and proved to merge into one token."""
        whole = []
        for token in self.vocabulary:
            try:
                text = bytes(self.byte[c] for c in token).decode()
            except (KeyError, UnicodeDecodeError):  # a special token, or part of a character
                continue
            if self.count(token) == 1:
                whole.append(text)
        return whole


class TokenCounter(dict):
    """Pre-token -> its number of tokens; what is missing is merged."""

    def __init__(self, merges: Merges, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merges = merges
        self.limit = len(self) + KEPT_TOKENS
        self.whole = whole
        self.split = regex.compile(PATTERN).findall
        marks = sorted(merges.specials, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    def __missing__(self, token: str) -> int:
        characters = "".join(map(self.merges.character.__getitem__, token.encode()))
        count = self.merges.count(characters)
        if len(token) <= KEPT_LENGTH:
            if len(self) >= self.limit:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[token] = count
        return count

    def tokens(self, text: str) -> int:
        parts = self.marks.split(text) if self.marks else [text]
        known = self.__getitem__
        return len(parts) - 1 + sum(sum(map(known, self.split(part))) for part in parts)


def counter(definition: bytes, whole: list[str]) -> TokenCounter:
    key = ("tokens", hashlib.sha256(definition).hexdigest())
    return once(key, lambda: TokenCounter(Merges(definition), whole))


def read_vocabulary(path: str) -> tuple[bytes, list[str]]:
    """A vocabulary file and its whole tokens; proved here once, for all workers."""
    with open(path, "rb") as file:
        definition = file.read()
    key = ("whole", hashlib.sha256(definition).hexdigest())
    return definition, once(key, lambda: Merges(definition).whole_tokens())


def count_udf(spark: SparkSession, vocabulary_path: str) -> Callable:
    """Arrow UDF: text -> number of tokens. Null and empty: 0.

    The vocabulary (a few MB, whatever the data) is broadcast.
    """
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(*shared.value)
        for batch in batches:
            yield pa.array([own.tokens(text.as_py() or "") for text in batch], pa.int64())

    return count


def token_counts(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every whole text: `id_col`, `n_bytes` bigint, `n_tokens` bigint.

    One row per row, repeated rows included. A null text counts as empty: 0 bytes
    and 0 tokens. Strings of special tokens inside texts are one token each, as the
    vocabulary's library reads them by default. Null ids stay null, other columns
    are not read.
    """
    count = count_udf(docs.sparkSession, vocabulary_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias(id_col),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        count(text).alias("n_tokens"),
    )
