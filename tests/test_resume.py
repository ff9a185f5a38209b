"""Training that goes on: counts equal a fit from scratch, no file is half counted."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from intentloom.operators import classify, commits, resume

SCHEMA = "id int, text string, kind string"


def write(spark, path, given):
    spark.createDataFrame(given, SCHEMA).coalesce(1).write.parquet(path)


def same_model(found, expected):
    def shown(model):
        classes = model.classes.select("label", "docs", "tokens", "vocabulary", F.round("log_prior", 9))
        return rows(model.words), rows(classes)

    assert shown(found) == shown(expected)


FIRST = [(1, "red red blue", "x"), (2, None, "x"), (3, "", "y")]
SECOND = [(4, "green red", "y"), (5, "blue", None), (1, "red red blue", "x")]


def test_updates_equal_a_fit_from_scratch(spark, tmp_path):
    corpus, root = f"{tmp_path}/corpus", f"{tmp_path}/models"
    write(spark, f"{corpus}/a", FIRST)
    assert resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind") == 1
    write(spark, f"{corpus}/b", SECOND)
    assert resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind") == 1
    assert resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind") == 0
    whole = spark.createDataFrame(FIRST + SECOND, SCHEMA)
    same_model(resume.load_updated_model(spark, root, "m"), classify.train_classifier_nb(whole, "text", "kind"))
    assert resume.files_taken_in(spark, root, "m").count() == 2
    with pytest.raises(FileNotFoundError):
        resume.load_updated_model(spark, root, "another")


def test_a_broken_update_counts_nothing(spark, tmp_path, monkeypatch):
    corpus, root = f"{tmp_path}/corpus", f"{tmp_path}/models"
    write(spark, f"{corpus}/a", FIRST)
    resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind")
    write(spark, f"{corpus}/b", SECOND)
    with monkeypatch.context() as broken:

        def stop(*_):
            raise OSError("lost")

        broken.setattr(commits, "commit", stop)
        with pytest.raises(OSError, match="lost"):
            resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind")
    before = classify.train_classifier_nb(spark.createDataFrame(FIRST, SCHEMA), "text", "kind")
    same_model(resume.load_updated_model(spark, root, "m"), before)
    assert resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind") == 1
    whole = spark.createDataFrame(FIRST + SECOND, SCHEMA)
    same_model(resume.load_updated_model(spark, root, "m"), classify.train_classifier_nb(whole, "text", "kind"))


def test_of_two_updates_at_once_the_other_files_come_next(spark, tmp_path, monkeypatch):
    corpus, root = f"{tmp_path}/corpus", f"{tmp_path}/models"
    write(spark, f"{corpus}/a", FIRST)
    write(spark, f"{corpus}/b", SECOND)
    first_commit = commits.commit

    def overtaken(*given):
        monkeypatch.setattr(commits, "commit", first_commit)
        resume.update_classifier_nb(spark, root, "m", f"{corpus}/b", "text", "kind")
        return first_commit(*given)

    monkeypatch.setattr(commits, "commit", overtaken)
    resume.update_classifier_nb(spark, root, "m", f"{corpus}/a", "text", "kind")
    assert resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind") == 1
    whole = spark.createDataFrame(FIRST + SECOND, SCHEMA)
    same_model(resume.load_updated_model(spark, root, "m"), classify.train_classifier_nb(whole, "text", "kind"))


def test_a_file_that_was_rewritten_is_an_error(spark, tmp_path):
    corpus, root = f"{tmp_path}/corpus", f"{tmp_path}/models"
    write(spark, f"{corpus}/a", FIRST)
    resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind")
    (file,) = (tmp_path / "corpus" / "a").glob("*.parquet")
    write(spark, f"{tmp_path}/other", SECOND)
    (other,) = (tmp_path / "other").glob("*.parquet")
    file.write_bytes(other.read_bytes())
    for crc in (tmp_path / "corpus" / "a").glob(".*.crc"):
        crc.write_bytes(next((tmp_path / "other").glob(".part*.crc")).read_bytes())
    with pytest.raises(ValueError, match="changed"):
        resume.update_classifier_nb(spark, root, "m", corpus, "text", "kind")
