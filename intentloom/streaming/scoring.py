"""Continuous scoring and accuracy of a message feed.

Every micro-batch is worked on as a batch and stored under its number. What has to be
kept for the running accuracy is the state of the blocks that are not finished, and a
restart continues from the checkpoint and replaces what a broken batch has left, so no
row is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from intentloom.functions import fixed
from intentloom.functions.text import extract_answer, is_message
from intentloom.operators.evaluate import accuracy_blocks, merge_accuracy_blocks
from intentloom.operators.resolve import resolve_prediction
from intentloom.operators.scale import running_sums
from intentloom.session import settle

BATCH = "batch_number"


def message_gate(df: DataFrame, col: str) -> DataFrame:
    """Drop blank messages and control words, on a table or a stream."""
    return df.where(is_message(F.col(col)))


def answer_messages(
    df: DataFrame,
    message: str,
    scorer: Callable[[DataFrame], DataFrame],
    vocab: DataFrame,
    cutoff: float = fixed.FUZZY_CUTOFF,
) -> DataFrame:
    """Gate, score, extract and resolve: adds decoded, raw, y_pred, match_kind."""
    scored = scorer(message_gate(df, message))
    answers = scored.withColumn("raw", extract_answer(F.col("decoded")))
    return resolve_prediction(answers, "raw", vocab, cutoff)


def stream_score(
    stream: DataFrame,
    message: str,
    scorer: Callable[[DataFrame], DataFrame],
    vocab: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer messages as they arrive, with the batch operators and any vocabulary.

    `read_stream_scores` reads the answers. `trigger` is that of `writeStream`; the
    default answers what has arrived and ends.
    """

    def answered(batch: DataFrame) -> DataFrame:
        return answer_messages(batch, message, scorer, vocab)

    return _each_batch(stream, answered, out, checkpoint, trigger)


def read_stream_scores(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop(BATCH)


def stream_accuracy(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    every: int = fixed.ACCURACY_EVERY,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The running accuracy of a feed of predictions (row_id, y_true, y_pred).

    `prepare` makes predictions of what the stream delivers, such as resolving raw
    answers; it may be any batch operator. Under `out` are kept:

    - `figures`: (rows, accuracy) after each block that is full, as are all blocks
      before it; appended once and never read again by the stream,
    - `state`: the sums of the blocks that are still open or wait for one, and those of
      all blocks before; a version per micro-batch, of which the last two are kept.

    A micro-batch reads the state that the one before it has left and nothing else, so
    its work does not grow with the feed. A replay reads the same state and overwrites
    its own figures and state, so a restart neither loses nor doubles a row.
    """
    spark = stream.sparkSession

    def follow(batch: DataFrame, number: int) -> None:
        sums = accuracy_blocks(prepare(batch) if prepare else batch, every)
        held = _state(spark, out, number - 1)
        # the row without a block holds the sums of all finished blocks
        done = held.where("block is null").first()
        first, rows, correct = (done["first"], done["rows"], done["correct"]) if done else (0, 0, 0)
        waiting = held.where("block is not null").select("block", "rows", "correct")
        blocks = settle(
            waiting.unionByName(sums)
            .groupBy("block")
            .agg(F.sum("rows").alias("rows"), F.sum("correct").alias("correct"))
            .withColumn("blocks", F.lit(1).cast("bigint")),
            "open-blocks",
        )
        upto = running_sums(blocks, "block", ["rows", "correct", "blocks"])
        # all blocks up to this one are there and full
        finished = (F.col("blocks") == F.col("block") - first + 1) & (
            F.col("rows") == F.col("blocks") * every
        )
        finished = settle(upto.where(finished), "finished-blocks")
        figures = finished.select(
            (F.col("rows") + rows).alias("rows"),
            ((F.col("correct") + correct) / (F.col("rows") + rows)).alias("accuracy"),
        )
        figures.write.mode("overwrite").parquet(f"{out}/figures/{BATCH}={number}")
        last = finished.agg(
            F.count("*").alias("n"), F.max("rows").alias("rows"), F.max("correct").alias("correct")
        ).first()
        next_first = first + last["n"]
        total = spark.createDataFrame(
            [(None, rows + (last["rows"] or 0), correct + (last["correct"] or 0), next_first)],
            STATE,
        )
        still = blocks.where(F.col("block") >= next_first).select(
            "block", "rows", "correct", F.lit(next_first).cast("bigint").alias("first")
        )
        still.unionByName(total).write.mode("overwrite").parquet(_state_path(out, number))
        _delete(spark, _state_path(out, number - 2))

    return (
        stream.writeStream.foreachBatch(follow)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


STATE = "block bigint, rows bigint, correct bigint, first bigint"


def _state_path(out: str, number: int) -> str:
    return f"{out}/state/{BATCH}={number}"


def _state(spark: SparkSession, out: str, number: int) -> DataFrame:
    """The state after a micro-batch; nothing before the first one."""
    if number < 0:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(_state_path(out, number))


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_stream_accuracy(
    spark: SparkSession, out: str, every: int = fixed.ACCURACY_EVERY
) -> DataFrame:
    """(rows, accuracy) after each block that is full by now.

    The figures are as the stream has written them. Full blocks that wait for rows of an
    earlier one are added from the state with what is there of it.
    """
    figures = spark.read.schema("rows bigint, accuracy double").parquet(f"{out}/figures")
    figures = figures.drop(BATCH)
    state = spark.read.schema(f"{STATE}, {BATCH} bigint").parquet(f"{out}/state")
    newest = state.agg(F.max(BATCH)).first()[0]
    state = state.where(F.col(BATCH) == newest)
    done = state.where("block is null").first()
    waiting = state.where("block is not null").select("block", "rows", "correct")
    before = spark.createDataFrame(
        [(-1, done["rows"], done["correct"])], "block bigint, rows bigint, correct bigint"
    )
    late = merge_accuracy_blocks(before.unionByName(waiting), every)
    # the sums before may be as many rows as a block has, but they are no block
    return figures.unionByName(late.where(F.col("rows") > done["rows"]))


def _each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    """Store each micro-batch's result under its number; a replay overwrites it."""

    def store(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
