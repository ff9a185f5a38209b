"""Cleaning, checks of a corpus, splits and comparison of runs."""

from pathlib import Path

from pyspark.sql import functions as F

from helpers import executed_plan, rows, vocabulary
from intentloom import session
from intentloom.operators import checks, classify, evaluate, presence, resolve, sampling, scale

CORPUS = "id bigint, text string, intent string"


def test_clean_corpus_keeps_the_lowest_id_of_each_pair(spark):
    given = [(3, "a", "x"), (1, "a", "x"), (2, "a", "y"), (4, " \t", "x"), (5, None, "x"), (6, "b", None)]
    cleaned = checks.clean_corpus(spark.createDataFrame(given, CORPUS), "id", "text", "intent")
    assert rows(cleaned) == [(1, "a", "x"), (2, "a", "y")]


def test_validate_sft_counts_each_rule(spark):
    given = [(1, "a", "x"), (2, " A", "x"), (3, None, "x"), (4, "b", "z"), (5, "c", None)]
    found = checks.validate_sft(spark.createDataFrame(given, CORPUS), vocabulary(spark, ["x"]), 2)
    assert rows(found) == [("not_normalized", 1), ("over_cap", 1), ("unknown_label", 2)]
    none = checks.validate_sft(spark.createDataFrame([], CORPUS), vocabulary(spark, ["x"]), 2)
    assert rows(none) == [("not_normalized", 0), ("over_cap", 0), ("unknown_label", 0)]


def test_split_overlap_and_balance(spark):
    train = spark.createDataFrame([(1, " A", "x"), (2, "a", "x"), (3, "b", "y")], CORPUS)
    test = spark.createDataFrame([(4, "a ", "x"), (5, "c", "y"), (6, None, "y")], CORPUS)
    assert rows(checks.split_overlap(train, test, "text")) == [("a", 2, 1)]
    balance = checks.class_balance(train.withColumn("split", F.lit("train")))
    assert rows(balance) == [("train", "x", 2, 1, 2, 2.0), ("train", "y", 1, 1, 2, 2.0)]


def test_stratified_split_takes_a_share_of_every_class(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "big").otherwise("small").alias("c"))
    parts = sampling.stratified_split(df, "c", "id", 0.15)
    counts = parts.groupBy("label", "split").count()
    assert rows(counts) == [("big", "train", 765), ("big", "validation", 135),
                            ("small", "train", 85), ("small", "validation", 15)]
    again = sampling.stratified_split(df.repartition(5), "c", "id", 0.15)
    assert rows(again) == rows(parts)


def test_compare_runs_keeps_labels_of_one_run(spark):
    def confusion(pairs):
        return evaluate.confusion_counts(spark.createDataFrame(pairs, "y_true string, y_pred string"))

    found = evaluate.compare_runs(confusion([("a", "a"), ("a", "b")]), confusion([("a", "a"), ("a", "a")]))
    by_label = {(r["section"], r["label"]): r for r in found.collect()}
    assert by_label["class", "b"]["second_f1"] is None
    assert by_label["class", "b"]["first_support"] == 0
    assert by_label["accuracy", None]["f1_change"] == 0.5


def test_samples_sort_no_payload(spark, tmp_path):
    spark.range(500).select(
        "id", (F.col("id") % 3).alias("c"), F.repeat(F.lit("text"), 50).alias("text")
    ).write.parquet(f"{tmp_path}/t")
    sample = sampling.sample_capped_per_class(spark.read.parquet(f"{tmp_path}/t"), "c", "id", 7)
    assert rows(sample.groupBy("c").count()) == [(0, 7), (1, 7), (2, 7)]
    assert "Sort" not in executed_plan(sample) and sample.columns == ["id", "c", "text"]


def test_few_long_names_are_not_fetched(spark, monkeypatch):
    monkeypatch.setattr(scale, "SMALL_BYTES", 1000)
    assert scale.fetch_small(spark.createDataFrame([("x" * 990,)], "s string")).num_rows == 1
    assert scale.fetch_small(spark.createDataFrame([("x" * 1001,)], "s string")) is None
    assert scale.fetch_small(spark.createDataFrame([], "s string")).num_rows == 0


def test_scans_are_spread_only_where_they_have_few_splits(spark, tmp_path):
    spark.range(1000).repartition(12).write.parquet(f"{tmp_path}/many")
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")

    def spread(df):
        return "REPARTITION_BY_NUM" in scale.use_all_cores(df, "id")._jdf.queryExecution().toString()

    conf = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(128 * 1024 * 1024))  # one split per file
    try:
        assert not spread(spark.read.parquet(f"{tmp_path}/many"))
    finally:
        spark.conf.set(conf, before)
    assert spread(spark.read.parquet(f"{tmp_path}/one"))
    assert not spread(spark.range(0, 1000, 1, 64)) and not spread(spark.range(0, 1000, 1, 2))


def test_integer_classes_and_no_classes(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "red red", 0), (2, "blue", 1), (3, "green", 2), (4, "?", None)],
                                  "id int, text string, kind int")
    few = classify.score_classifier_nb(texts, "id", "text", classify.train_classifier_nb(texts, "text", "kind"))
    expected = rows(few)
    monkeypatch.setattr(classify, "FEW_CLASSES", 2)
    model = classify.train_classifier_nb(texts, "text", "kind")
    many = classify.score_classifier_nb(texts, "id", "text", model)
    assert rows(many) == expected and many.schema["label"].dataType == few.schema["label"].dataType
    nothing = classify.train_classifier_nb(texts.where("id > 3"), "text", "kind")
    assert rows(classify.score_classifier_nb(texts, "id", "text", nothing)) == [
        (1, None), (2, None), (3, None), (4, None)
    ]


def test_a_cutoff_of_zero_on_both_paths(spark, monkeypatch):
    vocab = vocabulary(spark, ["abcd", "wxyz", "a_much_longer_label"])
    raws = spark.createDataFrame([("abxd",), ("q",)], "raw string")
    small = rows(resolve.fuzzy_match_label(raws, vocab, 0.0))
    monkeypatch.setattr(scale, "SMALL_ROWS", 1)
    assert rows(resolve.fuzzy_match_label(raws, vocab, 0.0)) == small


def test_release_empties_what_was_written(spark):
    shared = session.shared_folder(spark)
    session.release(spark)
    kept = session.settle(spark.range(5), "five")
    assert rows(kept) == [(k,) for k in range(5)]
    assert list(Path(shared.removeprefix("file:"), "intentloom").glob("five-*"))
    assert session.release(spark) == 1 and session.release(spark) == 0
    assert not list(Path(shared.removeprefix("file:"), "intentloom").glob("five-*"))


def test_batched_scorers_and_nulls(spark):
    feed = spark.createDataFrame([("A",), (None,), ("b",)], "m string")

    def load():
        return lambda texts: [t * 2 for t in texts]

    found = classify.batch_score_udf(feed, "m", load, batched=True)
    assert rows(found.select("decoded")) == [("aa",), ("bb",), (None,)]


def exchanged_texts(plan, name):
    """Whether a shuffle that is not fed by an aggregate of flagged rows holds `name`."""
    lines = plan.splitlines()
    return [
        line
        for k, line in enumerate(lines)
        if "Exchange hashpartitioning" in line
        and name in line
        and not any("HashAggregate" in below for below in lines[k + 1 : k + 4])
    ]


def test_only_texts_of_repeated_keys_are_shuffled(spark, tmp_path):
    df = spark.range(3000).select(
        "id",
        F.concat(F.lit("text "), F.when(F.col("id") < 2900, F.col("id")).otherwise(F.col("id") % 7)).alias("text"),
        F.lit("x").alias("intent"),
    )
    df.write.parquet(f"{tmp_path}/t")
    given = spark.read.parquet(f"{tmp_path}/t")
    cleaned = checks.clean_corpus(given, "id", "text", "intent")
    expected = {}
    for row in df.collect():
        expected[row["text"]] = min(row["id"], expected.get(row["text"], row["id"]))
    assert {(r["text"], r["id"]) for r in cleaned.collect()} == set(expected.items())
    assert cleaned.count() == len(expected) == 2900

    keyed = given.withColumn("h", F.xxhash64("text", "intent"))
    listed = keyed.groupBy("h").count().where("count > 1").select("h")
    flagged = presence.may_be_listed(keyed, "h", session.settle(listed), "again")
    missed = flagged.where("not again").join(listed, "h", "left_semi").count()
    assert missed == 0 and 107 <= flagged.where("again").count() < 600
    assert not exchanged_texts(executed_plan(cleaned), "_text")


def test_presence_with_no_and_with_many_keys(spark, monkeypatch):
    monkeypatch.setattr(presence, "MOST_BITMAPS", 1)
    keys = spark.range(100_000).select(F.xxhash64("id").alias("h"))
    none = presence.may_be_listed(keys, "h", keys.where("false"), "f")
    assert none.where("f").count() == 0 and none.count() == 100_000
    assert presence.may_be_listed(keys, "h", keys, "f").where("f").count() == 100_000


def test_split_overlap_with_clashing_names_and_null_texts(spark):
    schema = "text string, train int, _hash string"
    one = spark.createDataFrame([("a", 5, "h"), (None, 6, "h"), ("", 7, None)], schema)
    two = spark.createDataFrame([(" A", 5, "h"), (None, 6, "h"), (" ", 8, None)], schema)
    assert rows(checks.split_overlap(one, two, "text")) == [("", 1, 1), ("a", 1, 1)]
    assert rows(checks.split_overlap(one, two.where("false"), "text")) == []
