import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from intentloom.operators import classify, scale


def corpus(seed, n, classes="abc"):
    draw = random.Random(seed)
    words = [f"w{c}" for c in "defghijkl"]
    return [
        (i, " ".join(draw.choices(words + [label * 2] * 3, k=draw.randint(0, 9))), label)
        for i, label in ((i, draw.choice(classes)) for i in range(n))
    ]


def split(text):
    return [w for w in re.split("[^a-z]+", text.lower()) if w]


def predict(train, texts):
    """Scores every class for every text from the definition."""
    counts, docs = {}, Counter()
    for _, text, label in train:
        docs[label] += 1
        counts.setdefault(label, Counter()).update(split(text))
    vocabulary = {w for c in counts.values() for w in c}
    out = {}
    for id_, text in texts:
        known = [w for w in split(text) if w in vocabulary]
        scores = {}
        for label, seen in counts.items():
            norm = math.log(seen.total() + len(vocabulary))
            score = math.log(docs[label] / docs.total())
            score += sum(math.log(seen[w] + 1) - norm for w in known)
            scores[label] = round(score, 6)
        out[id_] = min(scores, key=lambda label: (-scores[label], label))
    return out


@pytest.mark.parametrize("classes", ["few", "few but wide", "many"])
@pytest.mark.parametrize("path", ["broadcast", "shuffled"])
def test_word_model_scores_as_defined(spark, monkeypatch, path, classes):
    if classes == "many":
        monkeypatch.setattr(classify, "FEW_CLASSES", 2)
    if classes == "few but wide":
        monkeypatch.setattr(classify, "SMALL_BYTES", 10)
    if path == "shuffled":
        monkeypatch.setattr(classify, "SMALL_WORDS", 3)
        monkeypatch.setattr(scale, "SMALL_ROWS", 2)
    train = corpus(1, 120) + [(900, "", "d"), (901, "only here", "e")]
    texts = [(i, t) for i, t, _ in corpus(2, 60)] + [(900, ""), (901, "unknown words"), (902, "only")]
    model = classify.train_classifier_nb(
        spark.createDataFrame(train, "id int, text string, label string"), "text", "label"
    )
    feed = spark.createDataFrame([*texts, (903, None)], "id int, text string")
    found = dict(rows(classify.score_classifier_nb(feed, "id", "text", model)))
    assert found == predict(train, [*texts, (903, "")])


def test_blocks_of_classes_that_cannot_win_are_skipped(spark, monkeypatch):
    draw = random.Random(6)
    common = [f"c{a}{b}" for a in "abcdef" for b in "abcde"]
    labels = [f"{a}{b}" for a in "ghijklmnop" for b in "ghijkl"]
    own = {x: [f"w{x}{c}" for c in "abcd"] for x in labels}

    def text(label):
        return " ".join(draw.choices(common, k=8) + draw.choices(own[label], k=draw.randint(1, 5)))

    train = [(i, text(x), x) for i, x in enumerate(labels * 20)]
    texts = [(i, text(draw.choice(labels))) for i in range(150)]
    monkeypatch.setattr(classify, "FEW_CLASSES", 10)
    monkeypatch.setattr(classify, "CLASS_BLOCK", 4)
    stored, settle = {}, classify.settle

    def kept(df, name="settled"):
        stored[name] = settle(df, name)
        return stored[name]

    monkeypatch.setattr(classify, "settle", kept)
    model = classify.train_classifier_nb(
        spark.createDataFrame(train, "id int, text string, label string"), "text", "label"
    )
    feed = spark.createDataFrame(texts, "id int, text string")
    assert dict(rows(classify.score_classifier_nb(feed, "id", "text", model))) == predict(train, texts)
    blocks = stored["class-blocks"].select("block").distinct().count()
    assert blocks == len(labels) // 4
    scored = len(texts) + stored["blocks-left"].count()
    print("blocks scored", scored, "of", blocks * len(texts))
    assert scored < 0.5 * blocks * len(texts)


def test_word_model_table(spark):
    train = [(1, "a b b", "x"), (2, "A-c", "y"), (3, None, "x"), (4, "z", None)]
    df = spark.createDataFrame(train, "id int, text string, label string")
    model = classify.train_classifier_nb(df, "text", "label")
    found = {(r["label"], r["word"]): (r["n"], r["log_likelihood"]) for r in model.table().collect()}
    assert found == {
        ("x", "a"): (1, pytest.approx(math.log(2 / 6))),
        ("x", "b"): (2, pytest.approx(math.log(3 / 6))),
        ("y", "a"): (1, pytest.approx(math.log(2 / 5))),
        ("y", "c"): (1, pytest.approx(math.log(2 / 5))),
    }


def test_word_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(corpus(3, 50), "id int, text string, label string")
    model = classify.train_classifier_nb(df, "text", "label")
    classify.save_model(model, f"{tmp_path}/m")
    loaded = classify.load_word_model(spark, f"{tmp_path}/m")
    assert rows(classify.score_classifier_nb(df, "id", "text", loaded)) == rows(
        classify.score_classifier_nb(df, "id", "text", model)
    )


def test_ml_model_learns_and_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(corpus(4, 200), "id int, text string, label string")
    model = classify.train_classifier_ml(df, "text", "label", {"features": 256, "max_iter": 20})
    scored = classify.score_classifier_ml(df.drop("label"), "id", model)
    # a text without the word of its class can only be guessed
    truth = {i: label for i, text, label in corpus(4, 200) if label * 2 in text}
    found = dict(rows(scored))
    assert len(found) == 200 and len(truth) > 100
    assert sum(found[i] == label for i, label in truth.items()) / len(truth) > 0.95
    classify.save_model(model, f"{tmp_path}/m")
    loaded = classify.load_ml_model(f"{tmp_path}/m")
    assert rows(classify.score_classifier_ml(df, "id", loaded)) == rows(scored)


def test_a_scorer_is_loaded_once_per_worker(spark, tmp_path):
    log = f"{tmp_path}/loads"

    def load():
        import os

        with open(log, "a") as out:
            out.write(f"{os.getpid()}\n")
        return lambda message: f"<{message}>"

    df = spark.range(0, 400, 1, 40).select(F.concat(F.lit(" M"), "id").alias("m"))
    scored = classify.batch_score_udf(df, "m", load)
    assert {r["decoded"] for r in scored.collect()} == {f"<m{i}>" for i in range(400)}
    with open(log) as lines:
        loads = lines.read().split()
    assert len(loads) == len(set(loads))


def test_a_scorer_can_get_the_message_as_it_is(spark):
    df = spark.createDataFrame([(" Hi\t",), (None,)], "m string")
    scored = classify.batch_score_udf(df, "m", lambda: str.swapcase, normalize=False)
    assert {r["decoded"] for r in scored.collect()} == {"hI", None}


def test_unscored_rows_are_those_without_a_prediction(spark):
    df, done = spark.range(6), spark.createDataFrame([(1, "x"), (4, "y")], "id bigint, p string")
    assert rows(classify.unscored_rows(df, done, "id")) == [(0,), (2,), (3,), (5,)]
