import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import rows, vocabulary
from intentloom import schemas
from intentloom.operators import scale
from intentloom.sources import corpus


def test_scan_corpus_reads_several_files_per_split(spark, tmp_path):
    for name, texts in {"a": ["x"], "b": ["y", "z"], "t": ["w"]}.items():
        frame = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, label int")
        frame.write.parquet(f"{tmp_path}/{name}")
    found = corpus.scan_corpus(
        spark,
        {"train": [f"{tmp_path}/a", f"{tmp_path}/b"], "test": f"{tmp_path}/t*"},
        "text string, label int",
    )
    assert rows(found) == [("w", 0, "test"), ("x", 0, "train"), ("y", 0, "train"), ("z", 1, "train")]


def test_label_dim_is_in_code_point_order(spark, monkeypatch):
    names = ["b", "a_b", "ab", "Z", "é", "a b", None, "b"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    expected = [(i, n) for i, n in enumerate(sorted({n for n in names if n}))]
    assert rows(corpus.label_dim(df, "name")) == expected
    monkeypatch.setattr(scale, "SMALL_ROWS", 2)
    assert rows(corpus.label_dim(df, "name")) == expected


def test_label_file_round_trip(spark, tmp_path, monkeypatch):
    vocab = vocabulary(spark, ["card_arrival", "a", "Top_up"])
    corpus.write_label_vocab(vocab, f"{tmp_path}/labels")
    assert rows(corpus.load_label_vocab(spark, f"{tmp_path}/labels")) == rows(vocab)


@pytest.mark.parametrize("bound", [10_000, 3])
def test_label_file_lines_are_trimmed_and_keep_their_order(spark, tmp_path, monkeypatch, bound):
    """Also for a file large enough to be read in several splits."""
    names = [f"label_{i * 7919 % 2000}" for i in range(2000)]
    lines = []
    for name in names:
        lines += [f"  {name}\t", " ", ""]
    path = tmp_path / "labels.txt"
    path.write_text("\n".join(lines))
    monkeypatch.setattr(scale, "SMALL_ROWS", bound)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = corpus.load_label_vocab(spark, str(path)).orderBy("label").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [(r["label"], r["intent"]) for r in found] == list(enumerate(names))


def record(text, intent="i"):
    return (text, 1, intent, "do, \"this\"\nnow", text, intent)


NASTY = ['say "hi", ok\nnl', "NA", "null", "a\\b\\", "x\r\ny", " outer ", "'", '"', '""', "é,;\t"]


def test_csv_written_by_pandas_reads_back(spark, tmp_path):
    frame = pd.DataFrame([record(t) for t in NASTY], columns=schemas.SFT_COLUMNS)
    path = tmp_path / "train.csv"
    frame.to_csv(path, index=False, lineterminator="\n")
    found = corpus.read_sft_csv(spark, str(path))
    assert rows(found) == sorted((record(t) for t in NASTY), key=repr)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_records_round_trip(spark, tmp_path, fmt):
    data = [(*record(t), "train") for t in NASTY] + [(*record("t"), "test")]
    df = spark.createDataFrame(data, f"{schemas.SFT}, split string").select(
        "split", *reversed(schemas.SFT_COLUMNS), F.lit(1).alias("extra")
    )
    path = f"{tmp_path}/out"
    corpus.write_sft_dataset(df, path, fmt)
    if fmt == "csv":
        found = corpus.read_sft_csv(spark, f"{path}/split=train")
    else:
        found = spark.read.parquet(f"{path}/split=train").select(*schemas.SFT_COLUMNS)
    assert rows(found) == sorted((record(t) for t in NASTY), key=repr)
    assert os.path.isdir(f"{path}/split=test")


def test_csv_reads_an_empty_field_as_null_and_parquet_keeps_it(spark, tmp_path):
    data = [(*record(""), "train"), (*record(None), "train")]
    df = spark.createDataFrame(data, f"{schemas.SFT}, split string")
    for fmt in ("csv", "parquet"):
        corpus.write_sft_dataset(df, f"{tmp_path}/{fmt}", fmt)
    found = corpus.read_sft_csv(spark, f"{tmp_path}/csv/split=train")
    assert [r["text"] for r in found.collect()] == [None, None]
    kept = spark.read.parquet(f"{tmp_path}/parquet/split=train")
    assert {r["text"] for r in kept.collect()} == {"", None}


def test_unknown_format(spark, tmp_path):
    df = spark.createDataFrame([(*record("t"), "train")], f"{schemas.SFT}, split string")
    with pytest.raises(ValueError):
        corpus.write_sft_dataset(df, f"{tmp_path}/out", "xml")
