"""CSV with line breaks in fields, read by many tasks, against Spark's own reader."""

import random

import pyarrow as pa
import pytest

from helpers import rows
from intentloom import schemas
from intentloom.sources import corpus, quoted

SCHEMA = "text string, label int, intent string, instruction string, input string, output string"
BITS = ["a", '"', ",", "\n", "\r\n", "é", " ", "word ", '""', "\\", "", "1", "\n\n"]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "1500")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def own_reader(spark, path):
    return spark.read.schema(schemas.SFT).options(**corpus.CSV_OPTIONS, enforceSchema="false").csv(path)


def written(texts, end="\n"):
    """A file as the usual writers make it: quotes where they are needed."""

    def field(value):
        if any(c in value for c in '",\n\r') or value != value.strip():
            return '"' + value.replace('"', '""') + '"'
        return value

    head = ",".join(schemas.SFT_COLUMNS)
    lines = [",".join([field(t), "1", field(t[::-1]), "do", "x", field(t)]) for t in texts]
    return end.join([head, *lines]) + end


def test_states_at_line_ends():
    ends = quoted.ends_inside
    outside = ["a,b", 'a"b', '"a"', '"a","b"', '"a"x"y,b', 'a,"b",', "", '""', '"a""b"']
    assert not any(ends(line, False) for line in outside)
    assert all(ends(line, False) for line in ['"a', 'a,"b', '"a""', '"a","', '"a""",""",'])
    assert all(ends(line, True) for line in ["", "a,b", '""', 'x""y', '","b', '",""",'])
    assert not any(ends(line, True) for line in ['"', 'a"', 'x""y"', '",a', 'a"b,"c"'])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_are_those_of_sparks_reader(spark, tmp_path, small_splits, end):
    draw, every = random.Random(3), []
    for number in range(2):
        texts = ["".join(draw.choices(BITS, k=draw.randint(0, 30))) for _ in range(40)]
        texts.append("long " * 60 + "\n" * 80 + '"' * 40)
        every += texts
        (tmp_path / f"part-{number}.csv").write_bytes(written(texts, end).encode())
    (tmp_path / "part-4.csv").write_bytes(written([], end).encode())
    found = corpus.read_sft_csv(spark, str(tmp_path))
    truth = [(t or None, 1, t[::-1] or None, "do", "x", t or None) for t in every]
    assert rows(found) == sorted(truth, key=repr)
    if end == "\n":  # where lines end in two signs Spark's reader shortens those in fields
        assert rows(found) == rows(own_reader(spark, str(tmp_path)))
    assert found.schema == own_reader(spark, str(tmp_path)).schema


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    texts = [f'line {k}\nsays "{k}", and\n\nmore' for k in range(200)]
    path = tmp_path / "one.csv"
    path.write_text(written(texts), newline="")
    plain = spark.read.option("lineSep", "\n").text(str(path))
    assert plain.rdd.getNumPartitions() > 8
    assert own_reader(spark, str(path)).rdd.getNumPartitions() == 1
    found = corpus.read_sft_csv(spark, str(path))
    assert sorted(r["text"] for r in found.collect()) == sorted(texts)


def test_lines_of_a_row_are_joined_where_they_are():
    """A split of long rows gives about a part for each row, whatever its lines."""
    texts = [f'line {k}\nsays "{k}", and\n\nmore' for k in range(200)]
    lines = written(texts).split("\n")[:-1]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(["a"] * len(own)), pa.array([0] * len(own), pa.int64()), pa.array(own)],
            ["file", "block", "value"],
        )
        for own in (lines[:501], lines[501:])
    ]
    parts = [row for found in quoted._joined(iter(batches)) for row in found.to_pylist()]
    assert len(lines) > 1800 and len(parts) < 210
    assert [v for p in parts for v in p["value"].split("\n")] == lines
    state, row = [False, True], [0, 0]
    for part in parts:  # what one line after another gives
        assert part["starts"] == state
        for k, line in enumerate(part["value"].split("\n")):
            row = [n + (not s) for n, s in zip(row, state)]
            state = [quoted.ends_inside(line, s) for s in state]
            assert k or [part["row_0"], part["row_1"]] == row
        assert part["ends"] == state and [part["row_0"], part["row_1"]] == row


def test_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(written(["t"]))
    (tmp_path / "b.csv").write_text(written(["t"]).replace("intent", "topic", 1))
    with pytest.raises(ValueError, match="b.csv"):
        corpus.read_sft_csv(spark, str(tmp_path))


def test_blank_lines_missing_ends_and_open_quotes(spark, tmp_path):
    head = ",".join(schemas.SFT_COLUMNS)
    for name, body in {
        "blank": "\n\n" + head + "\n\na,1,b,c,d,e\n\n",
        "cut": head + "\na,1,b,c,d,e",
        "bare": head,
        "inner": head + '\na"x,1,b,c"y"z,d,e\n',
    }.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(body)
        assert rows(corpus.read_sft_csv(spark, str(path))) == rows(own_reader(spark, str(path))), name
