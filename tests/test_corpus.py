import pytest
from pyspark.sql import functions as F

from helpers import executed_plan, rows, vocabulary
from intentloom.functions import fixed
from intentloom.operators import corpus, sampling, scale
from intentloom.plans.preparation import prepare_records


def test_decode_label_keeps_undecodable_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 7), (3, -1), (4, None)], "id int, label bigint")
    vocab = vocabulary(spark, ["a", "b"])
    found = corpus.decode_label(df, vocab, ["id"]).select("id", "label", "intent")
    assert rows(found) == [(1, 0, "a"), (2, 7, None), (3, -1, None), (4, None, None)]
    rejects = corpus.undecodable_labels(df, vocab, ["id"]).select("id")
    assert rows(rejects) == [(2,), (3,), (4,)]


def test_instruction_lists_labels_in_id_order(spark):
    vocab = spark.createDataFrame([(1, "a"), (0, "z")], "label bigint, intent string")
    text = corpus.build_instruction(vocab).first()["instruction"]
    assert text == fixed.INSTRUCTION_TEMPLATE.format(label_list="z, a")
    assert corpus.instruction_text(vocab) == text


def test_instruction_without_labels_is_generic(spark):
    empty = vocabulary(spark, ["a"]).where("label < 0")
    assert corpus.instruction_text(empty) == fixed.INSTRUCTION_WITHOUT_LABELS


def test_record_columns(spark):
    df = spark.createDataFrame([("hi", 0, "greet")], "text string, label int, intent string")
    records = corpus.sft_columns(df, "do it")
    assert rows(records) == [("hi", 0, "greet", "do it", "hi", "greet")]
    assert corpus.project_sft(records).columns == ["instruction", "input", "output"]
    assert "Join" not in executed_plan(records)


def test_preview_cuts_long_columns(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in (3, 1, 2)], "id int, t string")
    found = corpus.preview_rows(df, "id", 2, {"t": 80})
    assert rows(found) == [(1, "x" * 80 + "..."), (2, "x" * 80 + "...")]
    assert "TakeOrderedAndProject" in executed_plan(found)


def test_profile_counts_rows_and_classes(spark):
    df = spark.createDataFrame(
        [("train", 0), ("train", 0), ("train", 1), ("test", 1), ("test", None)],
        "split string, label int",
    )
    assert rows(corpus.corpus_profile(df)) == [("test", 2, 1), ("train", 3, 2)]


def test_prompt_budget(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("a b  c\nd",)], "prompt string")
    found = corpus.prompt_budget(df, "prompt", limit=3).first()
    assert (found["prompts"], found["max_words"], found["p50"], found["over_limit"]) == (3, 4, 3.0, 1)


@pytest.fixture
def classes(spark):
    """One hot class, a small one and rows without a label."""
    label = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, "few")
    return spark.range(0, 1000, 1, 16).withColumn("label", label)


def test_sample_sizes_and_seeds(classes):
    def drawn(n, seed):
        return sampling.sample_capped_per_class(classes, "label", "id", n, seed)

    counts = {r["label"]: r["count"] for r in drawn(150, 42).groupBy("label").count().collect()}
    assert counts == {"hot": 150, "few": 100}
    assert rows(drawn(20, 42)) == rows(drawn(20, 42))
    assert rows(drawn(20, 42)) != rows(drawn(20, 43))
    assert set(rows(drawn(20, 42))) < set(rows(drawn(30, 42)))


def test_sample_shuffles_only_rows_at_the_limit(classes):
    plan = executed_plan(sampling.sample_capped_per_class(classes, "label", "id", 5))
    assert "WindowGroupLimit" not in plan
    lines = plan.splitlines()
    shuffles = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # equal rows at the limit are counted before each shuffle; the other rows are filtered
    assert shuffles
    for k in shuffles:
        assert any("HashAggregate" in line for line in lines[k + 1 : k + 4]), lines[k : k + 4]


def test_batches_cover_every_row_once_per_epoch(spark):
    ids = spark.range(101)
    found = sampling.training_batches(ids, "id", batch=8, accumulation=4, epochs=2).collect()
    orders = []
    for epoch in (0, 1):
        mine = sorted((r for r in found if r["epoch"] == epoch), key=lambda r: r["pos"])
        assert [r["pos"] for r in mine] == list(range(101))
        assert sorted(r["id"] for r in mine) == list(range(101))
        assert all(r["micro_batch"] == r["pos"] // 8 for r in mine)
        assert all(r["step"] == r["pos"] // 32 for r in mine)
        orders.append([r["id"] for r in mine])
    assert orders[0] != orders[1]
    other = sampling.training_batches(ids, "id", epochs=1, seed=7).orderBy("pos").collect()
    assert [r["id"] for r in other] != orders[0]


def test_batches_sort_no_whole_epoch(spark):
    plan = executed_plan(sampling.training_batches(spark.range(5000), "id"))
    assert "SinglePartition" not in plan


def test_prepare_records_normalizes_samples_and_decodes(spark):
    schema = "id bigint, text string, label bigint"
    train = spark.createDataFrame(
        [(i, f"  Train {i}\t", i % 2) for i in range(20)] + [(90, "lost", 7), (91, "none", None)],
        schema,
    )
    test = spark.createDataFrame([(i, f"Test {i}", 0) for i in range(5)], schema)
    vocab = vocabulary(spark, ["a", "b"])
    found = prepare_records({"train": train, "test": test}, vocab, {"train": 4, "test": 2})
    counts = {(r["split"], r["intent"]): r["count"] for r in
              found.groupBy("split", "intent").count().collect()}
    assert counts == {("train", "a"): 4, ("train", "b"): 4, ("test", "a"): 2}
    for row in found.collect():
        assert row["text"] == row["input"] == f"{row['split']} {row['id']}"
        assert row["output"] == row["intent"] == "ab"[row["label"]]
        assert row["instruction"] == corpus.instruction_text(vocab)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_permuted_batches_are_a_bijection_per_epoch(spark, monkeypatch, n):
    monkeypatch.setattr(scale, "SMALL_ROWS", 100)
    ids = spark.range(n).select(F.when(F.col("id") % 50 != 3, F.col("id") % 90).alias("id"))
    found = sampling.permuted_batches(ids, "id", batch=4, accumulation=2, epochs=3).collect()
    assert len(found) == 3 * n
    orders = []
    for epoch in range(3):
        ids_of = {r["pos"]: -1 if r["id"] is None else r["id"] for r in found if r["epoch"] == epoch}
        own = sorted(ids_of.items())
        assert [pos for pos, _ in own] == list(range(n))
        orders.append([id for _, id in own])
        assert sorted(map(str, orders[-1])) == sorted(map(str, orders[0]))
    assert all((r["micro_batch"], r["step"]) == (r["pos"] // 4, r["pos"] // 8) for r in found)
    if n == 300:
        assert orders[0] != orders[1] != orders[2]
        other = sampling.permuted_batches(ids, "id", epochs=1, seed=9).orderBy("pos").collect()
        assert [r["id"] for r in other] != [None if k == -1 else k for k in orders[0]]


def test_epochs_of_permuted_batches_shuffle_nothing(spark):
    def shuffles(epochs):
        plan = executed_plan(sampling.permuted_batches(spark.range(5000), "id", epochs=epochs))
        return plan.count("Exchange"), plan.count("Sort")

    assert shuffles(1) == shuffles(6)
