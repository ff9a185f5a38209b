import random
from difflib import get_close_matches

import pytest
from pyspark.sql import functions as F

from helpers import executed_plan, rows, vocabulary
from intentloom.operators import nearest, resolve, scale


def resolved_in_python(raw, labels, cutoff=0.6):
    """The rules one by one: equal but for case, then closest, then unchanged."""
    raw = raw.strip()
    for label in labels:
        if label.lower() == raw.lower():
            return label, "exact"
    lower = [label.lower() for label in labels]
    close = get_close_matches(raw.lower(), lower, n=1, cutoff=cutoff) if raw else []
    return (labels[lower.index(close[0])], "fuzzy") if close else (raw, "none")


def noisy(names, seed, n):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        text = list(draw.choice(names))
        for _ in range(draw.randrange(6)):
            at = draw.randrange(len(text) + 1)
            text[at : at + draw.randrange(3)] = draw.choice(["", "x", "_", "é", "ca"])
        out.append(draw.choice(["", " ", "\t"]) + "".join(text) + draw.choice(["", "\n"]))
    return out + ["", "   ", "CARD_ARRIVAL", "zzzzzz", "a" * 250]


NAMES = ["card_arrival", "card_lost", "Top_Up", "top_up", "exchange_rate", "pin", "atm", "a", "Ünï"]


@pytest.fixture(params=["broadcast", "index"])
def path(request, monkeypatch):
    """Both ways to match: labels broadcast, or found by an index of their characters."""
    if request.param == "index":
        monkeypatch.setattr(scale, "SMALL_ROWS", 2)
    return request.param


def test_resolve_follows_the_rules(spark, path):
    raws = noisy(NAMES, 1, 200)
    df = spark.createDataFrame(list(enumerate(raws)), "id int, raw string")
    found = resolve.resolve_prediction(df, "raw", vocabulary(spark, NAMES)).collect()
    assert len(found) == len(raws)
    for row in found:
        expected = resolved_in_python(raws[row["id"]], NAMES)
        assert (row["y_pred"], row["match_kind"]) == expected, repr(row["raw"])


def test_topk_follows_difflib(spark, path):
    raws = sorted(set(noisy(NAMES, 2, 120)))
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    found = resolve.best_label_topk(df, vocabulary(spark, NAMES), 3, 0.5)
    by_raw = {}
    for row in sorted(found.collect(), key=lambda r: r["rank"]):
        by_raw.setdefault(row["raw"], []).append(row["label"])
    first = {}
    for name in NAMES:
        first.setdefault(name.lower(), name)
    for raw in raws:
        word = raw.strip().lower()
        close = get_close_matches(word, list(first), n=3, cutoff=0.5) if word else []
        assert by_raw.get(raw, []) == [first[c] for c in close], repr(raw)


def test_labels_equal_but_for_case(spark, path):
    df = spark.createDataFrame([("TOP_UP",), ("top_upp",)], "raw string")
    found = resolve.resolve_prediction(df, "raw", vocabulary(spark, NAMES))
    assert {r["y_pred"] for r in found.collect()} == {"Top_Up"}


def test_an_empty_vocabulary_leaves_answers_as_they_are(spark):
    df = spark.createDataFrame([(" x ",), ("",)], "raw string")
    found = resolve.resolve_prediction(df, "raw", vocabulary(spark, NAMES).where("label < 0"))
    assert sorted((r["y_pred"], r["match_kind"]) for r in found.collect()) == [
        ("", "none"),
        ("x", "none"),
    ]


def test_a_null_answer_stays_null(spark, path):
    df = spark.createDataFrame([(1, None), (2, "pin")], "id int, raw string")
    found = resolve.resolve_prediction(df, "raw", vocabulary(spark, NAMES))
    assert [(r["id"], r["y_pred"]) for r in found.orderBy("id").collect()] == [(1, None), (2, "pin")]


def test_exact_and_fuzzy_tables(spark, path):
    df = spark.createDataFrame([(r,) for r in ["PIN", "card arival", "zz"]], "raw string")
    vocab = vocabulary(spark, NAMES)
    assert rows(resolve.exact_match_label(df, vocab)) == [("PIN", "pin")]
    fuzzy = rows(resolve.fuzzy_match_label(df, vocab).select("raw", "label"))
    assert fuzzy == [("PIN", "pin"), ("card arival", "card_arrival")]


def test_invalid_predictions(spark):
    preds = spark.createDataFrame([("pin",), ("x",), ("x",), ("",)], "y_pred string")
    found = rows(resolve.invalid_predictions(preds, vocabulary(spark, NAMES)))
    assert found == [("", 1), ("x", 2)]


def test_resolving_does_not_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("card arriva"), "id").alias("raw"))
    plan = executed_plan(resolve.resolve_prediction(df, "raw", vocabulary(spark, NAMES)))
    assert "Exchange hashpartitioning" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_the_index_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(scale, "SMALL_ROWS", 2)
    df = spark.createDataFrame([(n,) for n in noisy(NAMES, 4, 50)], "raw string")
    plan = executed_plan(resolve.best_label_topk(df, vocabulary(spark, NAMES), 1))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def random_names(draw, n, letters):
    return sorted({"".join(draw.choices(letters, k=draw.randint(4, 14))) for _ in range(n)})


@pytest.mark.parametrize("cutoff", [0.0, 0.3, 0.6, 0.95])
def test_the_index_finds_what_difflib_finds(spark, cutoff):
    draw = random.Random(5)
    labels = random_names(draw, 150, "aabcdeü𝄞_ ")
    answers = random_names(draw, 60, "aabcdeü𝄞_ ") + labels[:5] + ["a" * 230, "zz", ""]
    table = spark.createDataFrame([(label,) for label in labels], "folded string")
    keys = spark.createDataFrame([(a,) for a in answers], "folded string")
    found = nearest.closest_by_index(keys, table, cutoff, 4).orderBy("key", "rank").collect()
    by_key = {}
    for row in found:
        assert row["rank"] == len(by_key.setdefault(row["key"], [])) + 1
        by_key[row["key"]].append(row["folded"])
    for answer in answers:
        expected = get_close_matches(answer, labels, n=4, cutoff=cutoff) if answer else []
        assert by_key.get(answer, []) == expected, repr(answer)


def test_few_pairs_are_candidates(spark):
    draw = random.Random(6)
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0x3B1, 0x3CA)]]
    labels = random_names(draw, 3000, letters)
    answers = [label[:3] + draw.choice(letters) + label[3:] for label in labels[::6]]
    table = spark.createDataFrame([(label,) for label in labels], "folded string")
    index = nearest.LabelIndex.of(table)
    keys = spark.createDataFrame([(a,) for a in answers], "key string")
    keys = keys.withColumn("key_tokens", index.tokens_of(F.col("key")))
    pairs = len(labels) * len(answers)
    at_once = nearest.candidates(keys, index, 0.6)
    early = nearest.candidates(keys, index, 0.75)
    assert at_once.count() < pairs / 100 and early.count() < pairs / 1000
    assert at_once.count() == at_once.distinct().count()
