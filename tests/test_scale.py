import random

import pytest
from pyspark.sql import functions as F

from helpers import executed_plan, rows
from intentloom import session
from intentloom.operators import scale


def skewed(spark, n=3000):
    """(id, key): a third of the rows share key 0, some keys are null."""
    key = (
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 97)
        .cast("bigint")
    )
    return spark.range(n).withColumn("key", key)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_lookup_join_is_the_same_beyond_the_bound(spark, monkeypatch, how):
    big = skewed(spark)
    table = spark.range(60).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    expected = rows(big.join(table, "key", how))
    small = scale.lookup_join(big, table, "key", how, ["id"])
    assert "BroadcastHashJoin" in executed_plan(small)
    assert rows(small) == expected
    monkeypatch.setattr(scale, "SMALL_ROWS", 10)
    spread = scale.lookup_join(big, table, "key", how, ["id"])
    assert rows(spread) == expected
    assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_fetch_small_checks_rows_and_bytes(spark, monkeypatch):
    df = spark.range(20)
    assert scale.fetch_small(df).num_rows == 20
    assert scale.fetch_small(df, 19) is None
    monkeypatch.setattr(scale, "SMALL_BYTES", 50)
    assert scale.fetch_small(df) is None


def test_first_per_group_of_a_hot_group(spark):
    df = skewed(spark).where("key is not null").repartition(12)
    order = [F.desc("id")]
    found = scale.first_per_group(df, ["key"], order, 4)
    by_key = {}
    for id_, key in ((r["id"], r["key"]) for r in df.collect()):
        by_key.setdefault(key, []).append(id_)
    expected = sorted((i, k) for k, ids in by_key.items() for i in sorted(ids)[-4:])
    assert sorted((r["id"], r["key"]) for r in found.collect()) == expected


def test_numbered_beyond_the_bound(spark, monkeypatch):
    draw = random.Random(3)
    names = sorted({"".join(draw.choices("abéz_", k=6)) for _ in range(500)})
    shuffled = spark.createDataFrame([(n,) for n in draw.sample(names, len(names))], "n string")
    expected = sorted((n, i) for i, n in enumerate(names))
    local = scale.numbered(shuffled, ["n"], "pos")
    assert sorted((r["n"], r["pos"]) for r in local.collect()) == expected
    monkeypatch.setattr(scale, "SMALL_ROWS", 10)
    ranged = scale.numbered(shuffled.repartition(7), ["n"], "pos")
    assert sorted((r["n"], r["pos"]) for r in ranged.collect()) == expected


def test_running_sums_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(scale, "FAN", 4)
    df = spark.range(100).select(F.col("id").alias("pos"), (F.col("id") % 7).alias("v"))
    total, expected = 0, []
    for i in range(100):
        total += i % 7
        expected.append((i, total))
    assert sorted(map(tuple, scale.running_sums(df, "pos", ["v"]).collect())) == expected
    monkeypatch.setattr(scale, "SMALL_ROWS", 10)
    assert sorted(map(tuple, scale.running_sums(df, "pos", ["v"]).collect())) == expected


def test_settle_writes_to_the_shared_folder(spark):
    folder = session.shared_folder(spark)
    kept = session.settle(spark.range(5).withColumn("x", F.lit(None).cast("string")))
    assert all(folder in f for f in kept.inputFiles())
    assert kept.count() == 5
    assert session.shared_folder(spark) == folder


class _Context:
    def __init__(self, master):
        self.master, self.made = master, None

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


class _Session:
    def __init__(self, master, named=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_the_cluster_names_the_shared_folder():
    assert session.shared_folder(_Session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("yarn"))


def test_few_files_are_spread_and_many_are_not(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(100).repartition(8).write.parquet(f"{tmp_path}/many")
    one = scale.use_all_cores(spark.read.parquet(f"{tmp_path}/one"), "id")
    many = scale.use_all_cores(spark.read.parquet(f"{tmp_path}/many"), "id")
    assert "Exchange hashpartitioning(id" in executed_plan(one)
    assert "Exchange" not in executed_plan(many)


def test_is_small_counts_rows_and_text(spark, monkeypatch):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), F.lit(10)).alias("t"))
    assert scale.is_small(df, 10)
    assert not scale.is_small(df, 9)
    monkeypatch.setattr(scale, "SMALL_BYTES", 99)
    assert not scale.is_small(df, 10)
    assert scale.is_small(df.where("id < 0"), 10)
