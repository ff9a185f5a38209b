"""Label names out of the footers of corpus files."""

import json

import pyarrow as pa
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from helpers import rows, vocabulary
from intentloom.operators import scale
from intentloom.sources import footers


def write_dataset_file(path, names):
    table = pa.table({"text": ["a", "b"], "label": [0, 1]})
    if names is not None:
        features = {"label": {"names": names, "_type": "ClassLabel"}, "text": {"dtype": "string"}}
        entry = json.dumps({"info": {"features": features}}).encode()
        table = table.replace_schema_metadata({b"huggingface": entry})
    pa.parquet.write_table(table, path)


def test_names_of_dataset_files(spark, tmp_path):
    (tmp_path / "part %20 one#").mkdir()
    for name in ("a.parquet", "part %20 one#/b.parquet"):
        write_dataset_file(tmp_path / name, ["card_lost", "pin"])
    found = footers.label_names_from_files(spark, str(tmp_path), "label")
    assert rows(found) == [(0, "card_lost"), (1, "pin")]


@pytest.mark.parametrize("other", [["pin", "card_lost"], None])
def test_files_that_disagree_are_an_error(spark, tmp_path, other):
    write_dataset_file(tmp_path / "a.parquet", ["card_lost", "pin"])
    write_dataset_file(tmp_path / "b.parquet", other)
    with pytest.raises(ValueError, match="differ"):
        footers.label_names_from_files(spark, str(tmp_path), "label")


def test_files_without_names_are_an_error(spark, tmp_path):
    write_dataset_file(tmp_path / "a.parquet", None)
    with pytest.raises(ValueError, match="no file"):
        footers.label_names_from_files(spark, str(tmp_path), "label")
    with pytest.raises(ValueError, match="no file"):
        footers.label_names_from_files(spark, str(tmp_path), "no such column")


def test_names_written_by_spark(spark, tmp_path, monkeypatch):
    vocab = vocabulary(spark, ["b", "a", "ü"])
    ids = spark.range(30).select((F.col("id") % 3).alias("label")).repartition(3)
    footers.with_label_names(ids, "label", vocab).write.parquet(f"{tmp_path}/named")
    found = footers.label_names_from_files(spark, f"{tmp_path}/named", "label")
    assert rows(found) == rows(vocab)
    with pytest.raises(ValueError, match="0, 1, 2"):
        footers.with_label_names(ids, "label", vocab.where("label > 0"))
    monkeypatch.setattr(scale, "SMALL_ROWS", 2)
    with pytest.raises(ValueError, match="too large"):
        footers.with_label_names(ids, "label", vocab)
