"""Rows without a value, repeated ids and whole duplicates in evaluation and sampling."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import comparable, rows
from intentloom.operators import evaluate, sampling

PREDS = "row_id bigint, y_true string, y_pred string"
PAIRS = [(0, "a", "a"), (1, "a", None), (2, "b", "b"), (3, "b", ""), (4, None, None), (5, None, "a"), (6, "", "")]


def test_a_missing_prediction_is_a_miss_everywhere(spark):
    preds = spark.createDataFrame(PAIRS, PREDS)
    share = evaluate.accuracy(preds).first()["accuracy"]
    report = evaluate.full_report(evaluate.confusion_counts(preds))
    assert share == report.where("section = 'accuracy'").first()["f1"] == 3 / 7
    assert rows(evaluate.running_accuracy(preds, 7)) == [(7, 3 / 7)]
    database = duckdb.connect()
    database.register("preds", preds.toArrow())
    twin = database.sql("select avg(cast(coalesce(y_true = y_pred, false) as integer)) as accuracy from preds")
    assert comparable(twin.to_arrow_table()) == comparable(evaluate.accuracy(preds).toArrow())


def test_runs_with_null_and_empty_classes_are_compared_once(spark):
    first = spark.createDataFrame(PAIRS, PREDS)
    second = first.withColumn("y_pred", F.when(F.col("row_id") != 3, F.col("y_pred")).otherwise("b"))
    sides = [evaluate.confusion_counts(p) for p in (first, second)]
    found = evaluate.compare_runs(*sides).collect()
    for name, confusion in zip(("first", "second"), sides):
        report = {(r["section"], r["label"]): r for r in evaluate.full_report(confusion).collect()}
        shown = {(r["section"], r["label"]): r for r in found}
        assert len(found) == len(shown) == len(report) == 7
        for key, r in report.items():
            assert (shown[key][f"{name}_f1"], shown[key][f"{name}_support"]) == (r["f1"], r["support"])


@pytest.fixture(scope="module")
def odd(spark):
    data = [(k % 40 if k % 5 else None, f"t{k % 60}", "abc"[k % 3] if k % 11 else None) for k in range(600)]
    return spark.createDataFrame(data, "id bigint, text string, label string").repartition(5).cache()


def test_no_row_is_lost_to_a_null_id(odd):
    labelled = odd.where("label is not null").count()
    split = sampling.stratified_split(odd, "label", "id", 0.25)
    assert split.count() == labelled
    sizes = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    for label in "abc":
        whole = sizes[label, "train"] + sizes[label, "validation"]
        assert sizes[label, "validation"] == whole // 4
    batches = sampling.training_batches(odd, "id", epochs=2)
    assert batches.count() == 2 * odd.count()
    assert sorted(r["pos"] for r in batches.where("epoch = 1").collect()) == list(range(odd.count()))


@pytest.mark.parametrize("few", [64, 1])
@pytest.mark.parametrize("n", [1, 3, 50, 1000])
def test_never_more_than_n_rows_of_a_class(spark, odd, n, few, monkeypatch):
    monkeypatch.setattr(sampling, "FEW_ROWS", few)
    found = sampling.sample_capped_per_class(odd, "label", "id", n)
    assert found.columns == odd.columns
    drawn = Counter(r["label"] for r in found.collect())
    there = Counter(r["label"] for r in odd.collect() if r["label"])
    assert drawn == {k: min(v, n) for k, v in there.items()}
    # the drawn rows are rows of the table, none more often than there
    assert not Counter(map(tuple, found.collect())) - Counter(map(tuple, odd.collect()))
    again = sampling.sample_capped_per_class(odd.repartition(3), "label", "id", n)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found.collect()))


def test_the_sample_is_that_of_a_sort(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW_ROWS", 2)
    draw = random.Random(1)
    data = [(k, draw.choice("ab") if k % 50 else "rare", draw.choice(["x", "y", None]), f"t{k}") for k in range(3000)]
    table = spark.createDataFrame(data, "id bigint, label string, part string, text string")
    database = duckdb.connect()
    database.register("docs", table.toArrow())
    for n in (5, 70):
        found = sampling.sample_capped_per_class(table, "label", "id", n, within=("part",))
        twin = database.sql(f"""select * from docs qualify row_number() over (
            partition by part, label order by md5('42:' || id::varchar), id) <= {n}""")
        assert comparable(found.toArrow()) == comparable(twin.to_arrow_table())
    plan = sampling.sample_capped_per_class(table, "label", "id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "NestedLoop" not in plan


def test_one_key_that_is_every_row(spark):
    same = spark.range(5000).select(F.lit(7).alias("id"), F.lit("a").alias("label"), F.lit("t").alias("text"))
    assert sampling.sample_capped_per_class(same, "label", "id", 12).count() == 12
    texts = spark.range(5000).select(F.lit(None).cast("bigint").alias("id"), F.lit("a").alias("label"), F.col("id").alias("text"))
    found = sampling.sample_capped_per_class(texts, "label", "id", 12).collect()
    assert len({r["text"] for r in found}) == len(found) == 12
    assert sampling.sample_capped_per_class(texts.limit(0), "label", "id", 12).count() == 0
