"""Piece encoding and token counts against the libraries."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import DATA
from intentloom.llm import pieces, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    " ", "  ", "    ", "\n", "\t", "\r\n", "a", "the", " th", "é", "你", "🤗", "▁", "▁▁", "ing",
    "12", "<s>", "<0x0A>", "<unk>", "ß", "\x00", "က", "...", "----", "==", '"', "'s",
    "<|endoftext|>", "\x1c", "\x85", "　", "²", "_",
]


def texts(n=4000, seed=1):
    draw = random.Random(seed)
    made = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(n)]
    runs = [c * k + tail for c in (" ", "a", "ab", "=", ". ") for k in (1, 7, 33, 500) for tail in ("", "x")]
    return [*made, *runs, "ab" * 30_000, " " * 20_000, "你" * 5_000]


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.read_model(MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_the_librarys(coder, library):
    made = texts()
    for text, expected in zip(made, library.encode(made, num_threads=1)):
        ids = coder.encode(text)
        assert ids == expected, text[:80]
        assert coder.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(coder, library):
    draw = random.Random(2)
    for _ in range(4000):
        ids = [draw.choice([draw.randrange(300), draw.randrange(32000)]) for _ in range(draw.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_counts_are_the_librarys():
    definition, whole = tokens.read_vocabulary(VOCABULARY)
    own = tokens.counter(definition, whole)
    library = Tokenizer.from_file(VOCABULARY)
    made = texts(seed=3)
    expected = [len(e.ids) for e in library.encode_batch(made, add_special_tokens=False)]
    assert [own.tokens(t) for t in made] == expected
    assert len(whole) > 49_000


ROWS = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "x" * 50_000)]
SCHEMA = "doc_id bigint, text string, ids string, n_tokens string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)


def test_nulls_repeats_and_clashing_names(spark, library):
    found = pieces.encode_pieces(frame(spark), MODEL).collect()
    assert sorted(len(r["ids"]) for r in found) == sorted(
        len(library.encode(t or "")) for _, t in ROWS
    )
    assert sorted(r["decoded"] for r in found) == sorted(t or "" for _, t in ROWS)
    counted = tokens.token_counts(frame(spark), VOCABULARY).collect()
    by_id = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in counted}
    assert len(counted) == 5 and by_id[2] == by_id[None] == (0, 0)
    empty = frame(spark, [])
    assert pieces.encode_pieces(empty, MODEL).count() == 0
    assert tokens.token_counts(empty, VOCABULARY).count() == 0


def test_queries_on_whole_texts(spark, library):
    from intentloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()
    ids = {r["doc_id"]: library.encode(r["text"] or "") for r in docs}
    shown = [(k, ",".join(map(str, v)), library.decode(v)) for k, v in ids.items()]
    expected = spark.createDataFrame(shown, "doc_id bigint, ids string, text string").select(
        "doc_id", F.sha2("ids", 256), F.sha2("text", 256)
    )
    found = QUERIES["op2_sentencepiece"](spark, f"{DATA}/sf0.001")
    assert sorted(map(tuple, found.drop("n_tokens").collect())) == sorted(map(tuple, expected.collect()))
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {k: len(v) for k, v in ids.items()}
    library = Tokenizer.from_file(VOCABULARY)
    counted = QUERIES["op8_token_counts"](spark, f"{DATA}/sf0.001").collect()
    encoded = library.encode_batch([r["text"] for r in docs], add_special_tokens=False)
    expected = {r["doc_id"]: len(e.ids) for r, e in zip(docs, encoded)}
    assert {r["doc_id"]: r["n_tokens"] for r in counted} == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in counted)
