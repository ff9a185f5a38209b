"""SimHash, benchmark passages and repeated passages against brute force."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from helpers import DATA
from intentloom.llm import graph, leaks, repeats, shared, simhash, surrogates, toxicity

DOCS = "doc_id bigint, text string, fingerprint string, kept string"
SMALL = f"{DATA}/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], DOCS)


def words(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghij", k=5)) for _ in range(n)]


def groups(keys, linked):
    """Smallest key of each key's component."""
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def defined_fingerprint(text, shingle):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    split = lower.translate(dict.fromkeys(range(9, 14), " ")).split(" ")
    tokens = [w for w in split if w]
    if not tokens:
        return 0
    spans = [tokens[k : k + shingle] for k in range(max(1, len(tokens) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [3, 12])
def test_links_are_those_of_all_pairs(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCKS", {4: 8, 1: 8})
    draw = random.Random(7)
    prints = [draw.getrandbits(64) for _ in range(60)]
    for base in prints[:20]:  # around a few, others within and beyond the radius
        for _ in range(6):
            flips = draw.sample(range(64), draw.randint(1, radius + 2))
            prints.append(base ^ sum(1 << b for b in flips))
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    found = {r["node"]: r["root"] for r in graph.components(simhash.close_pairs(table, radius)).collect()}
    bits = np.array(prints).view(np.uint64)
    near = [
        (prints[i], prints[j])
        for i in range(len(prints))
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits) <= radius)
    ]
    expected = groups(prints, near)
    assert {p: found.get(p, p) for p in prints} == expected
    assert len(set(expected.values())) < len(prints)


def test_many_links_are_thinned_without_losing_a_component(spark):
    near = np.array([1 << b for b in range(40)] + [0], dtype=np.uint64)
    links = simhash._close(near, near, 3, True)
    assert len(links) <= 2 * len(near)
    assert len(set(groups(near.tolist(), links.tolist()).values())) == 1


def test_components_of_long_chains_and_empty_links(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (200, 200)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in graph.components(links).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert graph.components(links.where("a < 0")).count() == 0


def test_near_duplicates_by_definition(spark):
    base = words(60, 1)
    rows = [
        (5, " ".join(base)),
        (3, "  ".join(base).upper()),
        (3, "  ".join(base).upper()),
        (9, " ".join([*base[:-1], "other"])),
        (None, None),
        (7, ""),
        (8, " \t\n"),
        (11, "One TWO"),
        (12, " ".join(words(60, 2))),
        (13, " ".join(words(30_000, 3))),
    ]
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    prints = {(i, defined_fingerprint(t, 3)) for i, t in rows}
    assert {(r["doc_id"], r["fingerprint"] % (1 << 64)) for r in found} == prints
    assert len(found) == len(rows)
    component = {r["doc_id"]: r["component"] for r in found}
    assert component[5] == component[3] == 3
    assert component[7] == component[8] == component[None] == 7
    assert component[12] == 12 and component[13] == 13


def test_one_document_of_each_group_stays(spark):
    base = words(200, 4)
    near = [*base[:100], "changed", *base[101:]]
    far = [*base[:60], *words(140, 5)]
    rows = [(1, base), (2, near), (2, near), (4, far), (6, base)]
    rows = [(i, " ".join(w)) for i, w in rows] + [(None, "  "), (None, None)]
    prints = [defined_fingerprint(t, 3) for _, t in rows]
    assert 0 < (prints[0] ^ prints[1]).bit_count() <= 3 < (prints[0] ^ prints[3]).bit_count()
    kept = simhash.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4]
    assert simhash.drop_near_duplicates(frame(spark, [])).count() == 0


def test_ties_and_repeated_rows_have_one_that_stays(spark):
    schema = "doc_id bigint, text string, _hash string, _known string, tags map<string,string>"
    text = " ".join(words(50, 3))
    rows = [(1, text, "a", "x", {"k": "v"}), (1, text, "a", "x", {"k": "v"}), (1, text, "b", "x", {}),
            (1, text.upper(), "c", None, None), (3, text, "d", "y", None), (9, "one", None, None, None),
            (9, "one", None, None, None)]
    kept = []
    for turn in (1, -1):
        docs = spark.createDataFrame(rows[::turn], schema).repartition(3)
        kept.append(sorted((tuple(r) for r in simhash.drop_near_duplicates(docs).collect()), key=str))
    assert kept[0] == kept[1] and sorted(r[0] for r in kept[0]) == [1, 9]


def test_one_row_of_each_group_of_the_query_stays(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    twice = docs.unionByName(docs.where("doc_id % 3 = 0"))
    found = simhash.near_duplicates(twice).collect()
    kept = [r["doc_id"] for r in simhash.drop_near_duplicates(twice).collect()]
    assert sorted(kept) == sorted({r["component"] for r in found})


def test_simhash_query_on_whole_texts(spark):
    from intentloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in QUERIES["op1_simhash"](spark, SMALL).collect()}
    prints = {r["doc_id"]: defined_fingerprint(r["text"], 3) for r in docs}
    ids = list(prints)
    near = [(a, b) for a in ids for b in ids if (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = groups(ids, near)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {
        i: (f"{prints[i]:016x}", expected[i]) for i in ids
    }


def marked(document, items, window):
    """Hit words and items, by comparing every window with every place."""
    hit, names = [False] * len(document), set()
    for name, item in items:
        size = min(window, len(item))
        for s in range(len(item) - size + 1 if size else 0):
            for at in range(len(document) - size + 1):
                if document[at : at + size] == item[s : s + size]:
                    names.add(name)
                    hit[at : at + size] = [True] * size
    return hit, names


def test_automaton_finds_what_comparing_finds():
    draw = random.Random(2)
    for _ in range(300):
        items = [
            (str(i), [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 9))])
            for i in range(draw.randint(0, 6))
        ]
        window = draw.randint(1, 5)
        document = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 40))]
        runs, names = leaks.ItemAutomaton(items, window).hits(document)
        hit = [False] * len(document)
        for start, end in runs:
            hit[start:end] = [True] * (end - start)
        assert (hit, names) == marked(document, items, window)
        assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


ITEMS = [(1, "alpha beta GAMMA delta, eins zwei drei vier fünf sechs sieben"), (2, "tiny item"),
         (3, None), (None, "lost words"), (4, " .,"), (2, "tiny item")]


@pytest.mark.parametrize("lot", [1 << 24, 20])
def test_leaks_and_their_removal(spark, lot, monkeypatch):
    monkeypatch.setattr(leaks, "SHARD_BYTES", lot)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    passage = "Alpha beta gamma DELTA eins zwei drei vier fünf sechs"
    rows = [(1, f"Before, {passage}! after {'word ' * 20}"), (2, "a Tiny-ITEM."), (3, None), (4, ""),
            (5, "alpha beta gamma"), (1, f"Before, {passage}! after {'word ' * 20}"),
            (6, "Lost words of an item without an id: five more")]
    found = leaks.find_leaks(frame(spark, rows), items, "kept").collect()
    shown = {r["doc_id"]: (r["kept"]["n_words"], [tuple(h) for h in r["kept"]["hits"]], r["kept"]["items"]) for r in found}
    assert shown == {1: (32, [(1, 11)], ["1"]), 2: (3, [(1, 3)], ["2"]), 3: (0, [], []),
                     4: (0, [], []), 5: (3, [], []), 6: (10, [(0, 2)], [])}
    cleaned = leaks.remove_leaks(frame(spark, rows), items)
    assert sorted((r["doc_id"], r["text"]) for r in cleaned.collect() if r["text"] is not None) == [
        (1, f"Before, ! after {'word ' * 20}"), (1, f"Before, ! after {'word ' * 20}"), (4, ""),
        (5, "alpha beta gamma"), (6, " of an item without an id: five more"),
    ]
    assert leaks.find_leaks(frame(spark, []), items, "out").count() == 0
    assert leaks.find_leaks(frame(spark, rows), items.limit(0), "out").count() == len(rows)


def cut_by_definition(texts):
    counts = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    results = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 399):
            if counts[text[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        results.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return results


def test_repeats_are_those_of_comparing_all_places(spark):
    draw = random.Random(5)

    def text(n):
        return "".join(draw.choice("abcdefgh ") for _ in range(n))

    passage, short, exact = text(700), text(403), text(400)
    docs = [
        passage + text(50), text(333) + passage[:500] + text(20), text(7) + short + text(9),
        short[1:] + text(30), short[:402], "a" * 2000, "ab" * 900, text(399), exact, exact, None, "",
        text(100) + passage[100:600] + text(5) + passage[150:650], "é" * 350,
        text(10) + passage[300:700] + passage[:400], ("xyz" + text(64)) * 20, text(20_000),
    ]
    rows = [(None if i == 3 else i, t) for i, t in enumerate(docs)]
    found = repeats.remove_repeats(frame(spark, rows)).collect()
    results = [
        (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in found
    ]
    assert sorted(results) == sorted(cut_by_definition([(t or "").encode() for t in docs]))
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_repeats_of_copies_that_are_many_and_nearly_alike(spark):
    """One text has most rows, some with the same id, and others differ from it in a place."""
    draw = random.Random(8)
    base = "".join(draw.choice("abcdefgh ") for _ in range(1500))
    near = [base[:k] + "#" + base[k + 1 :] for k in (0, 399, 400, 700, 701, 1100, 1499)]
    docs = [base] * 40 + near + [base[450:1000] + "!", "x" + base[:398], near[2]]
    rows = [(3 if i < 30 else None if i < 35 else i, t) for i, t in enumerate(docs)]
    found = repeats.remove_repeats(frame(spark, rows)).collect()
    results = [
        (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in found
    ]
    assert sorted(results) == sorted(cut_by_definition([t.encode() for t in docs]))


def test_windows_are_closed_by_lone_phrases_only():
    draw = random.Random(9)
    data = bytes(draw.choice(b"abcdef") for _ in range(4000))
    last = len(data) - repeats.SPAN
    hashed = repeats.Hashed(data)
    hashes, begins, ends = hashed.phrases()
    assert len(hashes) > 20
    all_on = np.full(4096, 255, dtype=np.uint8)
    assert repeats.open_windows(hashed, last, all_on).all()
    all_off = np.zeros(4096, dtype=np.uint8)
    held = [any(i <= b and e <= i + 400 for b, e in zip(begins, ends)) for i in range(last + 1)]
    assert (repeats.open_windows(hashed, last, all_off) == ~np.array(held)).all()
    # the hash of a phrase depends on its bytes alone
    moved = repeats.Hashed(b"zz" + data[begins[0] :])
    assert moved.phrases()[0].tolist()[-len(hashes) :] == hashes.tolist()


def test_cutting_off_spans_makes_no_python_object_of_each():
    draw = random.Random(10)
    texts = ["".join(draw.choice("abé\0") for _ in range(n)) for n in (900, 400, 450, 0, 2000, 1200)]
    texts[1] = "x" * 400  # nothing is left between its run and the next text's
    spans = [
        [(300, 5), (0, 2), (10, 1)], [(0, 1)], [(0, 3), (3, 48)], None, [], [(5, 20), (700, 1)],
    ]
    expected = []
    for text, found in zip(texts, spans):
        data = text.encode()
        gone = bytearray(len(data))
        for start, size in found or []:
            gone[start : start + size + 399] = b"\1" * len(gone[start : start + size + 399])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        expected.append((kept, len(data), len(data) - len(kept), runs))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    rows = [s and [{"start": a, "size": n} for a, n in s] for s in spans]
    for texts, rows, expected in ((texts, rows, expected), (texts[1:], rows[1:], expected[1:])):
        found = repeats.cut(pa.array(texts), pa.array(rows, type=kind))
        assert [tuple(r.values()) for r in found.to_pylist()] == expected
    none = repeats.cut(pa.array([None, ""]), pa.array([None, []], type=kind)).to_pylist()
    assert [tuple(r.values()) for r in none] == [(b"", 0, 0, 0)] * 2

    text, many = pa.array(["x" * 40_000]), np.arange(200_000, dtype=np.int32) % 39_000
    structs = pa.StructArray.from_arrays([many, np.ones_like(many)], ["start", "size"])
    spans = pa.ListArray.from_arrays([0, len(many)], structs)
    began = time.process_time()
    spans.to_pylist()
    as_objects = time.process_time() - began
    began = time.process_time()
    assert repeats.cut(text, spans)[0]["n_removed"].as_py() == 39_399
    assert time.process_time() - began < as_objects


def test_repeats_of_runs_of_one_byte(spark):
    """A run of one byte has a border at each place or at none."""
    docs = ["\0" * 1300, "a" + "\0" * 500 + "b", "é" * 300 + "\0" * 399, "\0" * 399, "z" * 450, "yz"]
    found = repeats.remove_repeats(frame(spark, list(enumerate(docs)))).orderBy("doc_id").collect()
    results = [
        (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in found
    ]
    assert results == cut_by_definition([t.encode() for t in docs])


def test_repeats_query_on_whole_texts(spark):
    from intentloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    expected = cut_by_definition([(r["text"] or "").encode() for r in docs])
    found = QUERIES["op7_suffix_dedup"](spark, SMALL).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == expected


def test_work_without_models_gives_back_what_workers_keep(spark, monkeypatch):
    """In the pipeline a worker that has encoded pieces scores texts next."""
    lexicon = toxicity.Lexicon({"idiot": 2.5}, {})
    for make in (lambda: toxicity.features_udf(lexicon), surrogates._keys_udf):
        monkeypatch.setattr(shared, "_KEPT", {"pieces": "a large model"})
        assert list(make().func(iter([pa.array(["an idiot", None])])))
        assert not shared._KEPT
