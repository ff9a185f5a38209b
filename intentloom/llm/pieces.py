"""Piece encoding of whole texts with a merge-type SentencePiece model, and decoding.

The model merges the adjacent pair with the best score, leftmost first, until no
pair of neighbours is a piece. The same pieces are found here without a queue of
merges: a sequence of pieces is the encoding exactly if every two neighbours stay
apart when their joined text is merged anew. So the encoder takes the longest
piece at each place (Aho-Corasick), goes to shorter ones while it does not stand
beside the piece before it, and steps back where none does; a bitfield marks the
places from which no way leads on, so each is left once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from intentloom.llm.shared import lists, once, slices

SPACE = "▁"
REPLACEMENT = "�"
NO_PIECE = float("-inf")
#: Segments kept with their ids per worker, in two generations of this size each,
#: and the longest segment that is kept.
KEPT_SEGMENTS = 150_000
KEPT_LENGTH = 64
KEPT_PAIRS = 200_000


class PieceCoder:
    """Encoder and decoder of one model; built once per worker."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or rules.precompiled_charsmap:
            raise ValueError("a merge-type model without character mapping is needed")
        if not rules.escape_whitespaces or rules.remove_extra_whitespaces:
            raise ValueError("a model that keeps and marks white space is needed")
        self.dummy_prefix = rules.add_dummy_prefix
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not handled")
        self.scores, self.ids, self.bytes = {}, {}, {}
        self.surfaces: list[bytes] = []
        self.byte_ids: set[int] = set()
        self.unknown = proto.trainer_spec.unk_id
        for number, piece in enumerate(proto.pieces):
            surface = b""
            if piece.type == kinds.NORMAL:
                self.scores[piece.piece] = piece.score
                self.ids[piece.piece] = number
                surface = piece.piece.replace(SPACE, " ").encode()
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[1:-1], 16)
                self.bytes[value] = number
                self.byte_ids.add(number)
                surface = bytes([value])
            elif piece.type == kinds.UNKNOWN:
                surface = proto.trainer_spec.unk_surface.encode()
            self.surfaces.append(surface)
        self.silent = {k for k, surface in enumerate(self.surfaces) if not surface}
        self.marked = [p.piece.startswith(SPACE) for p in proto.pieces]
        self._prepare()

    def _prepare(self) -> None:
        # a piece that merging does not bring about can never be part of an encoding
        reached = [p for p in self.ids if self.merged(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        self.single = {p: p for p in reached if len(p) == 1}
        for piece in reached:
            if len(piece) > 1:
                self.automaton.add_word(piece, piece)
        if not len(self.automaton):
            self.automaton.add_word("\0\0", "\0\0")
        self.automaton.make_automaton()
        known = set(reached)
        if any(c not in known for p in reached for c in p):
            raise ValueError("a model with all characters of its pieces is needed")
        self.shorter = {
            p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None)
            for p in reached
        }
        self.beside: dict[tuple[str, str], bool] = {}
        self.joined = {pair for p in self.ids for pair in zip(p, p[1:])}
        self.segments = re.compile(self._segment_pattern()).findall
        self.known: dict[str, Sequence[int]] = {}
        self.earlier: dict[str, Sequence[int]] = {}

    def _segment_pattern(self) -> str:
        """Pattern of parts that end before a space mark or around a line end.

        No piece reaches over such a border, so nothing merges across it.
        """
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return "(?s:.+)"
        apart = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        parts = f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+"
        return parts + (f"|[{apart}]" if apart else "")

    def _parts(self, segment: str) -> list[str]:
        """The segment cut between characters that are neighbours in no piece."""
        cuts = [k for k, pair in enumerate(zip(segment, segment[1:]), 1) if pair not in self.joined]
        if not cuts:
            return [segment]
        return [segment[a:b] for a, b in zip([0, *cuts], [*cuts, len(segment)])]

    def merged(self, text: str) -> list[str]:
        """The model's own merging, for the short texts of one or two pieces."""
        parts = list(text)
        score = self.scores.get
        pairs = [score(a + b, NO_PIECE) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > NO_PIECE:
            at = pairs.index(best)
            joined = parts[at] + parts[at + 1]
            parts[at : at + 2] = [joined]
            del pairs[at]
            if at:
                pairs[at - 1] = score(parts[at - 1] + joined, NO_PIECE)
            if at + 1 < len(parts):
                pairs[at] = score(joined + parts[at + 1], NO_PIECE)
        return parts

    def stand(self, pair: tuple[str, str]) -> bool:
        """Whether two pieces stay apart when their joined text is merged anew."""
        if len(self.beside) >= KEPT_PAIRS:
            self.beside.clear()
        found = self.beside[pair] = self.merged(pair[0] + pair[1]) == [*pair]
        return found

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text; a character of no piece is a part of its own."""
        longest = list(map(self.single.get, text))
        for end, piece in self.automaton.iter(text):  # a later end is a longer piece
            longest[end + 1 - len(piece)] = piece
        if None not in longest:
            return self._backtracked(longest, 0, len(text))
        found: list[str] = []
        start = 0
        for at, piece in enumerate(longest):
            # all single characters that are pieces start one, so nothing lies over this
            if piece is None:
                found += self._backtracked(longest, start, at)
                found.append(text[at])
                start = at + 1
        return found + self._backtracked(longest, start, len(text))

    def _backtracked(self, longest: list[str | None], start: int, end: int) -> list[str]:
        found: list[str] = []
        failed = bytearray((end - start) // 8 + 1)
        beside, shorter = self.beside.get, self.shorter
        at, last = start, None
        piece = longest[start] if start < end else None
        while at < end:
            while piece is not None:
                stop = at + len(piece)
                offset = stop - start
                if not failed[offset >> 3] >> (offset & 7) & 1:
                    if last is None:
                        break
                    pair = (last, piece)
                    fits = beside(pair)
                    if fits or (fits is None and self.stand(pair)):
                        break
                piece = shorter[piece]
            if piece is not None:
                found.append(piece)
                at, last = stop, piece
                if at < end:
                    piece = longest[at]
            else:
                offset = at - start
                failed[offset >> 3] |= 1 << (offset & 7)
                piece = found.pop()
                last = found[-1] if found else None
                at -= len(piece)
        return found

    def _segment_ids(self, segment: str) -> Sequence[int]:
        parts = self._parts(segment)
        ids: list[int] = []
        for part in parts:
            known = self.known.get(part) if len(parts) > 1 else self.earlier.get(part)
            if known is None:
                known = self._part_ids(part)
            ids += self._keep(part, known)
        return ids if len(parts) == 1 else self._keep(segment, ids)

    def _part_ids(self, part: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pieces(part):
            number = self.ids.get(piece)
            if number is not None:
                ids.append(number)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        return ids

    def _keep(self, text: str, ids: Sequence[int]) -> Sequence[int]:
        if len(text) <= KEPT_LENGTH:
            if len(self.known) >= KEPT_SEGMENTS:
                self.earlier, self.known = self.known, {}
            self.known[text] = ids = tuple(ids)  # tuples of numbers cost the garbage collector nothing
        return ids

    def forget(self) -> None:
        """Drop the older half of what was remembered of texts, so idle workers hold less.

        Which pieces stand beside each other depends on the model alone and is kept.
        """
        self.earlier = {}

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        ids: list[int] = []
        known = self.known.get
        for segment in self.segments(text):
            ids += known(segment) or self._segment_ids(segment)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the mark added in front goes, bytes are joined to characters."""
        joined = b"".join([self.surfaces[i] for i in ids])
        if ids and self.dummy_prefix and self.marked[ids[0]]:
            joined = joined[1:]
        try:
            if self.silent.isdisjoint(ids):
                return joined.decode()
        except UnicodeDecodeError:
            pass
        return self._decode_parts(ids)  # ids that are no encoding of a text

    def _decode_parts(self, ids: list[int]) -> str:
        parts: list[str] = []
        run = b""
        start = True
        for number in [*ids, None]:
            if number in self.byte_ids:
                run += self.surfaces[number]
                continue
            while run:
                for size in range(1, 5):
                    try:
                        parts.append(run[:size].decode())
                        run = run[size:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    parts.append(REPLACEMENT)
                    run = run[1:]
                start = False
            if number is not None and self.surfaces[number]:
                text = self.surfaces[number].decode()
                if start and self.dummy_prefix and self.marked[number]:
                    text = text[1:]
                parts.append(text)
                start = False
        return "".join(parts)


def coder(model: bytes) -> PieceCoder:
    key = ("pieces", hashlib.sha256(model).hexdigest())
    return once(key, lambda: PieceCoder(model))


def read_model(path: str) -> bytes:
    """The model file, checked to be one that the library itself can load."""
    with open(path, "rb") as file:
        model = file.read()
    sentencepiece.SentencePieceProcessor(model_proto=model)
    return model


ENCODED_DDL = "ids array<int>, decoded string"
ENCODED = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def piece_udf(spark: SparkSession, model_path: str) -> Callable:
    """Arrow UDF: text -> struct(ids, decoded). Null and empty: no ids, empty text.

    The model file (about half a MB, whatever the data) is broadcast; each worker
    builds the coder once.
    """
    model = spark.sparkContext.broadcast(read_model(model_path))

    @F.arrow_udf(f"struct<{ENCODED_DDL.replace(' ', ':', 1).replace('decoded ', 'decoded:')}>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = coder(model.value)
        for part in slices(batches):
            ids, texts = [], []
            for text in part.to_pylist():
                numbers = own.encode(text or "")
                texts.append(own.decode(numbers))
                ids.append(np.array(numbers, dtype=np.int32))
            yield pa.StructArray.from_arrays(
                [lists(ids, pa.int32()), pa.array(texts, pa.string())], fields=list(ENCODED)
            )
        own.forget()

    return encode


def encode_pieces(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every whole text, and the text decoded from them.

    Returns `id_col`, `ids` array<int>, `decoded` string; one row per row. A null
    text counts as empty: no ids, empty decoded text. Repeated rows give repeated
    results, null document ids stay null, other columns are not read. The decoded
    text is the input but for U+2581, which the model uses for the space.
    """
    encode = piece_udf(docs.sparkSession, model_path)
    return docs.select(
        F.col(id_col).alias(id_col), encode(F.col(text_col)).alias("_encoded")
    ).select(id_col, "_encoded.ids", "_encoded.decoded")
