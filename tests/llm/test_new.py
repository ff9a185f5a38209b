"""Packing, alignment of two vocabularies and whitening against brute force."""

import hashlib
import json
import random
import struct
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import DATA
from intentloom.llm import alignment, binpack, charpoly, merging, packing, queries, whitening

SMALL = f"{DATA}/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    " ", "  ", "    ", "\n", "\t", "\r\n", "a", "the", " th", "é", "你", "🤗", "▁", "ing", "12",
    "<s>", "<0x0A>", "<unk>", "ß", "\x00", "\x01", "က", "...", "==", "'s", "<|endoftext|>", "ΑΣ ",
    "<|startoftext|>", "\x1c", "\x85", "　", "²", "_", "᠎", "​", "́", "ﬁ", "¨",
]
DOCS = "doc_id bigint, text string, length string, piece string, pairs string, groups string"


def texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(n)]


def documents(spark, given):
    return spark.createDataFrame([(*r, "own", "own", "own", "own") for r in given], DOCS)


# packing


def smallest(items, capacity):
    best, items = [len(items)], sorted(items, reverse=True)

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for at in {r: i for i, r in enumerate(rooms) if r >= items[k]}.values():
            place(k + 1, [r - items[k] * (i == at) for i, r in enumerate(rooms)])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best[0]


def best_fit_bins(items, capacity):
    rooms = []
    for x in sorted(items, reverse=True):
        fitting = [k for k, r in enumerate(rooms) if r >= x]
        if fitting:
            rooms[min(fitting, key=lambda k: rooms[k])] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_packings_are_the_smallest():
    draw, better = random.Random(3), 0
    for trial in range(300):
        capacity = draw.choice([10, 20, 50, 100])
        low, high = (1, capacity) if trial % 2 else (capacity // 5, capacity // 2)
        items = [draw.randint(low, high) for _ in range(draw.randint(0, 13))]
        counts = dict(Counter(items))
        first = binpack.best_fit(counts, capacity)
        assert binpack.bins(first) == best_fit_bins(items, capacity)
        packed = binpack.complete_bins(counts, capacity, 10**6)
        used = Counter()
        for filling, times in packed:
            assert sum(x * n for x, n in filling.items()) <= capacity
            used.update({x: n * times for x, n in filling.items()})
        assert used == Counter(items)
        least = smallest(items, capacity)
        assert binpack.bins(packed) == least, (items, capacity)
        histogram = np.bincount(items, minlength=capacity + 1)
        assert binpack.lower_bound(histogram, capacity) <= least
        better += binpack.bins(first) > least
    assert better  # branch and bound was needed


def test_a_search_that_runs_out_is_still_whole():
    lengths = np.random.default_rng(1).integers(1200, 1900, 3000)
    counts = dict(Counter(lengths.tolist()))
    for effort in (0, 1, 500, 50_000):
        packed = binpack.complete_bins(counts, 4096, effort)
        used = Counter()
        for filling, times in packed:
            used.update({x: n * times for x, n in filling.items()})
        assert used == Counter(counts)
        assert binpack.bins(packed) <= binpack.bins(binpack.best_fit(counts, 4096))


def check_packing(rows, given, capacity=4096):
    """Pieces are those of the library, sequences have no gaps, few are used."""
    library = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text in given:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            expected[doc_id, k, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))] += 1
    found = Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows
    )
    assert found == expected
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled.get(r["sequence_id"], 0) == r["offset"]
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= capacity for n in filled.values())
    lengths = [r["length"] for r in rows]
    assert len(filled) <= best_fit_bins(lengths, capacity)
    least = binpack.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    assert len(filled) <= 1.01 * least + 1


def test_documents_are_packed(spark):
    found = queries.op11_best_fit_packing(spark, SMALL).collect()
    given = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    check_packing(found, [(d["doc_id"], d["text"]) for d in given])


def test_common_texts_are_split_many_at_a_time(monkeypatch):
    """No text of common letters is split by itself; the ids stay the library's."""
    marks = ["'s", "'t", "'re", "'ll", "'l", "'", "''", " ", "\n", "\u00a0", "a", "B", "s", "\u00e9", "\u0416", "1", "23", "-", "_", "x" * 70]
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(marks, k=rnd.randrange(14))) for _ in range(3000)]
    definition = open(WORDS, encoding="utf-8").read()
    library = Tokenizer.from_str(definition)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(packing, "COMMON_SPLIT", None)
    found = packing.WordIds(definition).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected


def test_parts_are_looked_up_and_merged_together(monkeypatch):
    """No part is an object of its own; forgetting parts leaves the ids the library's."""
    rnd = random.Random(6)
    words = ["".join(rnd.choices("aeinorst'\u00e9", k=rnd.randint(1, 80))) for _ in range(300)]
    lots = [[" ".join(rnd.choices(words + PARTS, k=rnd.randrange(30))) for _ in range(40)] for _ in range(9)]
    lots += [[""], [" ", "\n"], ["a"], words]
    definition = open(WORDS, encoding="utf-8").read()
    library = Tokenizer.from_str(definition)
    expected = [[e.ids for e in library.encode_batch(lot, add_special_tokens=False)] for lot in lots]
    monkeypatch.setattr(merging.Merger, "encode", None)
    for kept in (packing.KEPT_WORDS, 20):
        monkeypatch.setattr(packing, "KEPT_WORDS", kept)
        coder = packing.WordIds(definition)
        for lot, ids in zip(lots, expected):
            assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(lot)] == ids
            assert len(coder.words) <= kept
            assert all(len(p) <= packing.KEPT_LENGTH for p in coder.words.to_pylist())


def test_odd_documents_are_packed(spark):
    given = [(k % 50, t) for k, t in enumerate(texts(600, 4))]
    given += [(None, None), (1, ""), (1, ""), (2, "a " * 9000), (2, "a " * 9000), (3, "ab" * 9000)]
    pieces = packing.token_pieces(documents(spark, given), WORDS, with_ids=True)
    packed = packing.pack_best_fit(pieces).collect()
    check_packing(packed, given)
    names = ["sequence_id", "offset", "ids"]
    stored = spark.createDataFrame(
        [tuple(r[c] for c in names) for r in packed], "sequence_id bigint, offset bigint, ids array<bigint>"
    )
    whole = packing.sequences(stored).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in packed)
    for r in whole:
        own = sorted((p for p in packed if p["sequence_id"] == r["sequence_id"]), key=lambda p: p["offset"])
        assert r["ids"] == [x for p in own for x in p["ids"]]
    nothing = packing.pack_best_fit(packing.token_pieces(documents(spark, []), WORDS))
    assert nothing.count() == 0 and nothing.columns[-2:] == ["sequence_id", "offset"]


def test_lengths_that_fit_nowhere_stay_without_a_place(spark):
    rows = [(1, 5, "x"), (2, None, "x"), (3, 0, "x"), (4, 11, "x"), (5, 10, "x"), (6, 5, "x"), (6, 5, "x")]
    table = spark.createDataFrame(rows, "id int, length int, _rank string")
    packed = packing.pack_best_fit(table, 10).collect()
    assert sorted(r["id"] for r in packed if r["sequence_id"] is None) == [2, 3, 4]
    assert len({r["sequence_id"] for r in packed} - {None}) == 3
    assert all(r["_rank"] == "x" for r in packed)


# alignment


@pytest.fixture(scope="module")
def both():
    with open(BYTES, encoding="utf-8") as file, open(PIECES, "rb") as other:
        return alignment.TwoVocabularies(file.read(), other.read())


class Plain:
    """The contract, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        with open(BYTES, encoding="utf-8") as file:
            self.named = {v: k for k, v in json.load(file)["model"]["vocab"].items()}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}

    def b_bytes(self, k):
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def aligned(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        parts = [bytes(self.byte[c] for c in self.named[k]) for k in a], [self.b_bytes(k) for k in b]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return None
        sides = []
        for ids, own in zip((a, b), parts):
            at, spans = 0, []
            for k, p in zip(ids, own):
                spans.append((at, at + len(p), k))
                at += len(p)
            sides.append(spans)
        groups, low = [], 0
        for end in sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]}):
            groups.append("|".join(",".join(str(k) for s, e, k in side if low <= s and e <= end) for side in sides))
            low = end
        starts = [s for s, _, _ in sides[1]]
        links, first = [], 0
        for s, e, k in sides[0]:
            while sides[1][first][1] <= s:
                first += 1
            j = first
            while j < len(starts) and starts[j] < e:
                links.append((k, sides[1][j][2]))
                j += 1
        return len(a), len(b), len(groups), len(links), ";".join(groups), links


def scored(given):
    """Expected rows of the whole table."""
    plain, held, found = Plain(), Counter(), []
    for doc_id, text in given:
        found.append((doc_id, plain.aligned(text)))
        held.update(set(found[-1][1][5]) if found[-1][1] else ())
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    return Counter(
        (d, *x[:5], sum(held[p] == most[p[0]] for p in x[5]), sum(held[p] for p in x[5]))
        if x
        else (d, 0, 0, 0, 0, "", 0, 0)
        for d, x in found
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def odd_documents():
    given = [(k % 70, t) for k, t in enumerate(texts(900, 6))]
    given += [(None, None), (None, "the end"), (1, ""), (2, "ab " * 4000), (2, "ab " * 4000)]
    return given + [(3, "你" * 2000), (4, " " * 3000)]


@pytest.mark.parametrize("sent", [1_000_000, 40, 0])
def test_alignment_is_that_of_the_plain_tokens(spark, sent):
    given = odd_documents()
    aligned = alignment.align_tokens(documents(spark, given).repartition(5), BYTES, PIECES)
    found = alignment.score_links(aligned, alignment.piece_count(PIECES), sent).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in found) == scored(given)


def test_the_query_on_documents(spark):
    found = queries.op12_cross_tokenizer(spark, SMALL).collect()
    given = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = scored([(d["doc_id"], d["text"]) for d in given])
    digested = Counter(
        (*x[:5], hashlib.sha256(x[5].encode()).hexdigest() if x[1] else "", *x[6:]) for x in expected.elements()
    )
    names = [c if c != "groups" else "groups_sha256" for c in COLUMNS]
    assert Counter(tuple(r[c] for c in names) for r in found) == digested


def test_alignment_of_nothing(spark):
    aligned = alignment.align_tokens(documents(spark, []), BYTES, PIECES)
    assert alignment.score_links(aligned, alignment.piece_count(PIECES)).collect() == []


def test_a_full_memory_of_parts_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PARTS", 50)
    made = texts(400, 9)
    expected = [both._encoded([t])[0] if t else None for t in made]
    with open(BYTES, encoding="utf-8") as file, open(PIECES, "rb") as other:
        fresh = alignment.TwoVocabularies(file.read(), other.read())
    assert [x for at in range(0, 400, 20) for x in fresh.encode(made[at : at + 20])] == expected


# whitening


def test_polynomials_roots_and_vectors():
    draw = np.random.default_rng(1)
    for size in (1, 2, 5, 12):
        rows = draw.integers(-50, 50, (40, size))
        if size == 5:
            rows[:, 3] = rows[:, 2]  # a root of zero
        matrix = (40 * rows.T @ rows - np.outer(rows.sum(0), rows.sum(0))).tolist()
        moduli = charpoly.primes(charpoly.primes_needed(sum(matrix[i][i] for i in range(size)), size))
        polynomial = charpoly.remaindered(charpoly.polynomials_modulo(matrix, moduli).tolist(), moduli)
        # Faddeev and LeVerrier in fractions
        exact, last, plain = np.array(matrix, dtype=object), np.zeros((size, size), dtype=object), [1]
        unit = np.array([[int(i == j) for j in range(size)] for i in range(size)], dtype=object)
        for k in range(1, size + 1):
            last = exact.dot(last) + plain[-1] * unit
            plain.append(-Fraction(sum(exact.dot(last)[i, i] for i in range(size)), k))
        assert polynomial == plain[::-1]
        roots = charpoly.largest_roots(polynomial, size)
        values = [float(r) for r, n in roots for _ in range(n)]
        expected = np.linalg.eigvalsh(np.array(matrix, dtype=float))[::-1][: len(values)]
        assert np.allclose(values, expected, rtol=1e-9)
        vectors = np.array([[float(x) for x in v] for r, n in roots for v in charpoly.null_vectors(matrix, r, n)])
        assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-14)
        assert np.allclose(np.array(matrix, float) @ vectors.T, vectors.T * values, atol=1e-12 * values[0])


def test_equal_and_close_roots():
    matrix = np.diag([7, 7, 7, 3, 0, 5, 5]).tolist()
    moduli = charpoly.primes(charpoly.primes_needed(34, 7))
    polynomial = charpoly.remaindered(charpoly.polynomials_modulo(matrix, moduli).tolist(), moduli)
    assert charpoly.largest_roots(polynomial, 4) == [(7, 3), (5, 2)]
    vectors = np.array([[float(x) for x in v] for v in charpoly.null_vectors(matrix, 7, 3)])
    assert np.allclose(vectors[:, 3:], 0) and np.allclose(vectors @ vectors.T, np.eye(3))
    near = [[10**40, 0], [0, 10**40 + 1]]
    moduli = charpoly.primes(charpoly.primes_needed(2 * 10**40 + 1, 2))
    polynomial = charpoly.remaindered(charpoly.polynomials_modulo(near, moduli).tolist(), moduli)
    assert [(int(r.to_integral_value()), n) for r, n in charpoly.largest_roots(polynomial, 2)] == [(10**40 + 1, 1), (10**40, 1)]


def whitened(vectors, rows, components):
    """The contract in plain numpy: eigh of the covariance of distinct vectors."""
    x = {k: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for k, v in enumerate(vectors)}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, sums, x, values[order], directions[:, order], values.sum()


def check_whitening(found, vectors, ids, components=16):
    n, sums, x, values, directions, trace = whitened(vectors, ids, components)
    by_row = {}
    for r in found:
        by_row.setdefault(r["vec_id"], []).append(r)
    assert Counter(r["vec_id"] for r in found) == Counter({i: ids.count(i) * len(values) for i in set(ids)})
    signs = None
    for k, i in enumerate(ids):
        if ids.count(i) > 1 or i is None:
            continue
        own = sorted(by_row[i], key=lambda r: r["component"])
        assert [r["component"] for r in own] == list(range(1, len(values) + 1))
        exact = sum((n * a - int(s)) ** 2 for a, s in zip(x[k], sums))
        assert all(r["n"] == n and r["deviation"] == (exact if exact < 2**63 else None) for r in own)
        expected = (np.array(x[k]) - sums / n) @ directions / np.sqrt(values)
        got = np.array([r["whitened"] for r in own])
        if signs is None and np.abs(got).min() > 1e-3:
            signs = np.sign(got * expected)
        if signs is not None:
            assert np.allclose(got, signs * expected, atol=1e-6)
        assert np.allclose([r["explained"] for r in own], values / trace, rtol=1e-9)
        assert all(0 <= r["identity_error"] < 1e-9 for r in own)


def test_embeddings_are_whitened(spark):
    found = queries.op13_whitening(spark, SMALL).collect()
    given = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    check_whitening(found, [d["embedding"] for d in given], [d["vec_id"] for d in given])


def test_odd_embeddings(spark):
    draw = np.random.default_rng(2)
    good = [(k, draw.normal(size=5).tolist()) for k in range(60)]
    good += [(60, good[0][1]), (61, good[0][1]), (62, [1e9, -1e9, 0.0, 3.0, 1e-9])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5),
           (104, [float("inf")] * 5), (105, [1.0, 2.0]), (106, [1e300] * 5)]
    schema = "vec_id bigint, embedding array<double>, _vector string, _id string"
    table = spark.createDataFrame([(*r, "own", "own") for r in good + odd], schema).repartition(4)
    found = whitening.whiten(table).collect()
    assert Counter(r["vec_id"] for r in found) == Counter({k: 5 for k, _ in good})
    usual = [r for r in good if r[0] != 62]
    table = spark.createDataFrame([(*r, "own", "own") for r in usual + odd + [(7, usual[7][1]), (None, usual[3][1])]], schema)
    found = whitening.whiten(table, components=3).collect()
    check_whitening(found, [v for _, v in usual], [k for k, _ in usual] + [7, None], 3)


def test_embeddings_without_variance(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        found = whitening.whiten(spark.createDataFrame(rows, schema))
        assert found.collect() == []
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = spark.createDataFrame([(k, [float(k % 3), 5.0, float(k % 3)]) for k in range(6)], schema)
    found = whitening.whiten(flat).collect()  # one direction only
    assert {r["component"] for r in found} == {1} and len(found) == 6
    assert found[0]["explained"] == 1.0 and found[0]["n"] == 3


def test_whole_numbers_of_any_size_add_up(spark):
    rows = [[2**61, -(2**61)], [2**61 - 1, 5], [-(2**61), 7]]
    table = spark.createDataFrame([(r,) for r in rows], "v array<bigint>")
    count, sums, matrix = whitening.scatter(table, "v", 2)
    assert (count, sums) == (3, [sum(r[i] for r in rows) for i in range(2)])
    expected = [[3 * sum(r[i] * r[j] for r in rows) - sums[i] * sums[j] for j in range(2)] for i in range(2)]
    assert matrix == expected
