import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from intentloom.functions.text import extract_accuracy
from intentloom.operators import commits, ledger
from intentloom.plans.publishing import publish_run

RUNS = "run_name string, created_at_utc string, outputs string, sample_data string, " \
    "configs string, test_accuracy_percent string"


def runs(spark):
    return spark.createDataFrame(
        [
            ("a", "2024-01-02T00:00:00+00:00", "o", "s", "c", "91.50"),
            ("b", "2024-01-02T00:00:00.500000+00:00", "o", "s", "c", None),
            ("c", "2024-01-01T23:00:00.100000+00:00", "o", "s", "c", "9"),
        ],
        RUNS,
    )


def test_manifests_keep_a_missing_accuracy(spark, tmp_path):
    path = f"{tmp_path}/m"
    ledger.write_run_manifest(runs(spark), path)
    manifests = {m["run_name"]: m for m in (json.loads(r[0]) for r in spark.read.text(path).collect())}
    assert manifests["b"] == {
        "run_name": "b",
        "created_at_utc": "2024-01-02T00:00:00.500000+00:00",
        "source_paths": {"outputs": "o", "sample_data": "s", "configs": "c"},
        "test_accuracy_percent": None,
    }
    found = ledger.read_run_ledger(spark, path)
    assert rows(found.select("run_name", "outputs", "test_accuracy")) == [
        ("a", "o", 91.5), ("b", "o", None), ("c", "o", 9.0)
    ]


def test_latest_run_is_by_time(spark):
    assert rows(ledger.latest_run(runs(spark))) == [("b", "2024-01-02T00:00:00.500000+00:00", None)]
    assert rows(ledger.latest_run(runs(spark).where("run_name = 'none'"))) == []


def test_latest_version_is_by_number(spark):
    paths = [("r", "checkpoint-939"), ("r", "checkpoint-1000"), ("s", "x/checkpoint-7"), ("t", "none")]
    df = spark.createDataFrame(paths, "run string, path string")
    assert rows(ledger.latest_version(df)) == [("r", 1000), ("s", 7)]


def test_reports_are_read_one_row_per_file(spark, tmp_path):
    for name, text in {"a": "Test Accuracy: 1.5%\n\nrest\n", "b": "nothing\nhere"}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "eval_results.txt").write_text(text)
    found = ledger.read_eval_reports(spark, f"{tmp_path}/*/eval_results.txt")
    found = found.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1), extract_accuracy(F.col("content")))
    assert rows(found) == [("a", "1.5"), ("b", None)]


def snapshot(spark, n):
    return {name: spark.range(n) for name in ledger.RUN_TABLES}


def test_a_snapshot_replaces_its_own_run_only(spark, tmp_path):
    root = f"{tmp_path}/artifacts"
    ledger.snapshot_run(snapshot(spark, 2), "007", root)
    ledger.snapshot_run(snapshot(spark, 3), "run/b=1", root)
    ledger.snapshot_run(snapshot(spark, 1), "007", root)
    found = ledger.read_snapshots(spark, root, "outputs")
    assert rows(found.groupBy("run_name").count()) == [("007", 1), ("run/b=1", 3)]


def test_a_snapshot_needs_all_its_tables(spark, tmp_path):
    tables = snapshot(spark, 1)
    del tables["configs"]
    with pytest.raises(FileNotFoundError, match="configs"):
        ledger.snapshot_run(tables, "r", str(tmp_path))
    with pytest.raises(ValueError):
        ledger.snapshot_run(snapshot(spark, 1), " ", str(tmp_path))


def report(spark, share):
    rows = [("class", 0.5), ("accuracy", share)] if share is not None else []
    return spark.createDataFrame(rows, "section string, f1 double")


def test_published_runs_are_in_the_ledger(spark, tmp_path):
    root = f"{tmp_path}/artifacts"

    def publish(name, at, share):
        time = F.to_timestamp_ntz(F.lit(at))
        return publish_run(snapshot(spark, 1), report(spark, share), root, name, time)

    assert publish(" a ", "2024-05-01 10:00:00", 0.25) == "a"
    assert publish("", "2024-05-02 10:00:00.5", None) == "run_20240502_100000_utc"
    assert publish("a", "2024-05-01 11:00:00", 0.5) == "a"
    found = ledger.read_published_ledger(spark, root)
    assert rows(found.select("run_name", "created_at_utc", "test_accuracy_percent")) == [
        ("a", "2024-05-01T11:00:00.000000+00:00", "50.00"),
        ("run_20240502_100000_utc", "2024-05-02T10:00:00.500000+00:00", None),
    ]
    assert ledger.latest_run(found).first()["run_name"] == "run_20240502_100000_utc"
    assert ledger.read_snapshots(spark, root, "configs").count() == 2
    now = publish_run(snapshot(spark, 1), report(spark, 1.0), root)
    assert now.startswith("run_2") and ledger.read_snapshots(spark, root, "configs").count() == 3


def test_a_broken_publication_shows_nothing(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/runs"
    ledger.snapshot_run(snapshot(spark, 2), "a", root, '{"run_name":"a","created_at_utc":"1"}')
    real = commits.write_tables

    def breaks(version, tables):
        real(version, {"outputs": tables["outputs"]})
        raise OSError("gone")

    monkeypatch.setattr(commits, "write_tables", breaks)
    with pytest.raises(OSError):
        ledger.snapshot_run(snapshot(spark, 5), "a", root, '{"run_name":"a","created_at_utc":"2"}')
    monkeypatch.setattr(commits, "write_tables", real)

    # everything is written, only the commit is missing
    whole = commits.begin(root, "a")
    commits.write_tables(whole, snapshot(spark, 7))
    for table in ledger.RUN_TABLES:
        assert ledger.read_snapshots(spark, root, table).count() == 2
    assert ledger.read_published_ledger(spark, root).first()["created_at_utc"] == "1"
    commits.discard_uncommitted(spark, root, whole, list(ledger.RUN_TABLES))
    assert not os.path.exists(whole.folder("outputs"))
    commits.commit(spark, commits.begin(root, "b"), [])
    assert ledger.read_snapshots(spark, root, "outputs").count() == 2


def test_two_publishers_at_once_never_mix(spark, tmp_path):
    root = f"{tmp_path}/runs"
    first, second = (commits.begin(root, "a") for _ in range(2))
    for version, n in ((first, 1), (second, 4)):  # both write before either commits
        commits.write_tables(version, snapshot(spark, n))
    before = [commits.commit(spark, v, list(ledger.RUN_TABLES), f"{n}") for v, n in ((second, 4), (first, 1))]
    assert before == [0, 1]
    counts = {t: ledger.read_snapshots(spark, root, t).count() for t in ledger.RUN_TABLES}
    assert set(counts.values()) == {1} and commits.newest(spark, root).first()["note"] == "1"
    # the same number twice: the larger version id wins, for every table and for the note
    monkey = [commits.begin(root, "c") for _ in range(2)]
    for version, n in zip(monkey, (2, 3)):
        commits.write_tables(version, snapshot(spark, n))
    rows = [{"name": "c", "sequence": 9, "version": v.version, "tables": list(ledger.RUN_TABLES), "note": str(n)}
            for v, n in zip(monkey, (2, 3))]
    for row in rows:
        with open(f"{root}/_commits/{row['version']}.json", "w") as file:
            json.dump(row, file)
    won = max(rows, key=lambda r: r["version"])
    newest = {r["name"]: r["note"] for r in commits.newest(spark, root).collect()}
    assert newest == {"a": "1", "c": won["note"]}
    for table in ledger.RUN_TABLES:
        found = ledger.read_snapshots(spark, root, table).where("run_name = 'c'").count()
        assert found == int(won["note"])


def test_nothing_is_published_yet(spark, tmp_path):
    assert ledger.read_published_ledger(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(FileNotFoundError):
        ledger.read_snapshots(spark, f"{tmp_path}/none", "outputs")
