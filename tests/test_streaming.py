import os

import pytest
from pyspark.sql import functions as F

from helpers import rows, vocabulary
from intentloom.operators import evaluate, resolve, scale
from intentloom.streaming import scoring

FEED = "id bigint, message string"
BATCHES = [
    [(1, "card arrival"), (2, " quit "), (3, "")],
    [(4, "PIN"), (5, "Q"), (6, "something else")],
]


def scorer(df):
    return df.withColumn("decoded", F.concat(F.lit("### Response:\n"), "message", F.lit("\nx")))


@pytest.fixture
def vocab(spark):
    return vocabulary(spark, ["card_arrival", "pin"])


def test_a_stream_gives_what_the_batch_gives_and_restarts_without_doubles(spark, vocab, tmp_path):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))

    def run():
        stream = spark.readStream.schema(FEED).parquet(feed)
        scoring.stream_score(stream, "message", scorer, vocab, out, state).awaitTermination()

    for batch in BATCHES:
        spark.createDataFrame(batch, FEED).coalesce(1).write.mode("append").parquet(feed)
        run()
    run()  # nothing new arrived
    expected = scoring.answer_messages(spark.read.parquet(feed), "message", scorer, vocab)
    found = scoring.read_stream_scores(spark, out)
    assert rows(found) == rows(expected.select(*found.columns))
    assert rows(found.select("id", "y_pred", "match_kind")) == [
        (1, "card_arrival", "fuzzy"), (4, "pin", "exact"), (6, "something else", "none")
    ]


def test_a_vocabulary_beyond_the_bound_gives_the_same(spark, vocab, tmp_path, monkeypatch):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))
    spark.createDataFrame(sum(BATCHES, []), FEED).write.parquet(feed)
    expected = rows(scoring.answer_messages(spark.read.parquet(feed), "message", scorer, vocab))
    monkeypatch.setattr(scale, "SMALL_ROWS", 1)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(FEED).parquet(feed)
        scoring.stream_score(stream, "message", scorer, vocab, out, state).awaitTermination()
    assert rows(scoring.read_stream_scores(spark, out)) == expected


def test_accuracy_of_raw_answers_with_any_vocabulary(spark, vocab, tmp_path, monkeypatch):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))
    raws = spark.range(200).select(
        F.col("id").alias("row_id"),
        F.lit("pin").alias("y_true"),
        F.when(F.col("id") % 4 == 0, "PIN").when(F.col("id") % 4 == 1, "pim")
        .otherwise("x").alias("raw"),
    )
    raws.write.parquet(feed)
    monkeypatch.setattr(scale, "SMALL_ROWS", 1)
    stream = spark.readStream.schema(raws.schema).parquet(feed)
    scoring.stream_accuracy(
        stream, out, state, prepare=lambda df: resolve.resolve_prediction(df, "raw", vocab)
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/figures").count() == 1
    assert rows(scoring.read_stream_accuracy(spark, out)) == [(200, 0.5)]


def test_running_accuracy_of_a_stream(spark, tmp_path):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))
    preds = spark.range(450).select(
        F.col("id").alias("row_id"),
        F.lit("a").alias("y_true"),
        F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("y_pred"),
    )

    def arrive(condition):
        preds.where(condition).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(preds.schema).parquet(feed)
        scoring.stream_accuracy(stream, out, state).awaitTermination()
        return rows(scoring.read_stream_accuracy(spark, out))

    expected = rows(evaluate.running_accuracy(preds))
    assert arrive("row_id < 250") == expected[:1]
    assert arrive("row_id >= 250") == expected
    assert len(expected) == 2


def test_the_state_holds_open_blocks_only(spark, tmp_path):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))
    preds = spark.range(2000).select(
        F.col("id").alias("row_id"),
        F.lit("a").alias("y_true"),
        F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 7 > 0, "a").alias("y_pred"),
    )
    arrived, reads = [], []

    def arrive(condition):
        arrived.append(condition)
        preds.where(condition).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(preds.schema).parquet(feed)
        scoring.stream_accuracy(stream, out, state, every=100).awaitTermination()
        kept = sorted(os.listdir(f"{out}/state"))
        number = max(int(k.split("=")[1]) for k in kept if "=" in k)
        blocks = spark.read.parquet(f"{out}/state/batch_number={number}").where("block is not null")
        reads.append((len([k for k in kept if "=" in k]), sorted(r["block"] for r in blocks.collect())))
        so_far = preds.where(" or ".join(f"({c})" for c in arrived))
        expected = rows(evaluate.running_accuracy(so_far, 100))
        assert rows(scoring.read_stream_accuracy(spark, out, 100)) == expected
        return len(expected)

    assert arrive("row_id < 250") == 2
    assert arrive("row_id >= 1000 and row_id < 1250") > 2  # full blocks that wait
    assert arrive("row_id >= 250 and row_id < 950") > 7
    assert arrive("row_id >= 950 and row_id < 1000 or row_id >= 1250 and row_id < 1999") == 19
    assert arrive("row_id = 1999") == 20
    assert [r[0] for r in reads] == [1, 2, 2, 2, 2]  # old versions are gone
    assert [r[1] for r in reads] == [[2], [2, 10, 11, 12], [9, 10, 11, 12], [19], []]
    stored = spark.read.parquet(f"{out}/figures")
    assert stored.count() == 20  # every figure was written once


def test_a_replayed_batch_replaces_its_figures(spark, tmp_path):
    feed, out, state = (f"{tmp_path}/{n}" for n in ("feed", "out", "state"))
    preds = spark.range(900).select(
        F.col("id").alias("row_id"), F.lit("a").alias("y_true"), F.lit("a").alias("y_pred")
    )
    for k in range(3):
        preds.where(f"row_id % 3 = {k}").coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(preds.schema).parquet(feed)
        scoring.stream_accuracy(stream, out, state, every=100).awaitTermination()
        # the stream has lost the note that this batch is done, so it comes again
        os.remove(f"{state}/commits/{k}")
        crc = f"{state}/commits/.{k}.crc"
        if os.path.exists(crc):
            os.remove(crc)
        stream = spark.readStream.schema(preds.schema).parquet(feed)
        scoring.stream_accuracy(stream, out, state, every=100).awaitTermination()
    assert rows(scoring.read_stream_accuracy(spark, out, 100)) == [(100 * k, 1.0) for k in range(1, 10)]
    assert spark.read.parquet(f"{out}/figures").count() == 9
