import pytest
from pyspark.sql import functions as F

from intentloom.functions import text
from intentloom.functions.fixed import WHITESPACE


def value(spark, column, **inputs):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return df.select(column.alias("v")).first()["v"]


STRINGS = [
    "\t  Hello \u001f\n",
    "  　 ",
    "",
    "İΑΣ",
    "  inner  blanks stay  ",
    "​zero width stays​",
]


def test_whitespace_is_what_python_strips():
    assert len(WHITESPACE) == 29
    assert all(c.isspace() for c in WHITESPACE)


@pytest.mark.parametrize("raw", STRINGS)
def test_strip_and_normalize_are_those_of_python(spark, raw):
    assert value(spark, text.strip_message(F.col("t")), t=raw) == raw.strip()
    assert value(spark, text.normalize_text(F.col("t")), t=raw) == raw.strip().lower()


@pytest.mark.parametrize(
    "decoded",
    [
        "p\n### Response:\ncard_arrival\nmore",
        "no mark at all",
        "### Response:",
        "a ### Response: first ### Response: \n\n  second  \nthird",
        "### Response:\n   label\t\n",
        "",
    ],
)
def test_extract_answer_takes_the_first_line_after_the_last_mark(spark, decoded):
    expected = decoded.split("### Response:")[-1].strip().split("\n")[0].strip()
    assert value(spark, text.extract_answer(F.col("d")), d=decoded) == expected


@pytest.mark.parametrize("message", ["50% of {} \"it\" 'is'", "a\nb", "x ### Response: y"])
def test_prompts_keep_any_text(spark, message):
    shown = value(
        spark,
        text.render_train_prompt(F.lit("instr {0} %s"), F.col("m"), F.lit("out"), "<end>"),
        m=message,
    )
    expected = (
        "Below is an instruction that describes a task, paired with an input that provides "
        "further context. Write a response that appropriately completes the request."
        "\n\n### Instruction:\ninstr {0} %s\n\n### Input:\n"
        + message
        + "\n\n### Response:\nout<end>"
    )
    assert shown == expected
    bare = value(spark, text.render_eval_prompt(F.lit("instr {0} %s"), F.col("m")), m=message)
    assert bare == expected.removesuffix("out<end>")


@pytest.mark.parametrize(
    "content, expected",
    [
        ("Test Accuracy: 92.10%\n\nrest", "92.10"),
        ("x Test Accuracy:\n 9% y", "9"),
        ("Test Accuracy: 1% Test Accuracy: 2%", "1"),
        ("Test Accuracy: .5%", None),
        ("nothing", None),
    ],
)
def test_extract_accuracy(spark, content, expected):
    assert value(spark, text.extract_accuracy(F.col("c")), c=content) == expected


def test_run_name_is_the_trimmed_name_or_the_time(spark):
    at = F.to_timestamp_ntz(F.lit("2024-03-05 06:07:08"))
    assert value(spark, text.run_name(F.col("n"), at), n="  mine\t") == "mine"
    assert value(spark, text.run_name(F.col("n"), at), n=" ") == "run_20240305_060708_utc"
    assert value(spark, text.run_name(F.lit(None), at), n="") == "run_20240305_060708_utc"


def test_utc_wall_clock_undoes_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = F.to_timestamp(F.lit("2024-03-05T00:30:00+09:00"))
        name = text.run_name(F.lit(""), text.utc_wall_clock(at))
        assert value(spark, name, n="") == "run_20240304_153000_utc"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("share", [0.0, 1.0, 0.00125, 0.39125, 0.005, 2 / 3, 0.02675, 0.999999])
def test_percent_text_rounds_like_a_percent_format(spark, share):
    assert value(spark, text.percent_text(F.col("s")), s=share) == f"{share * 100:.2f}"


def test_version_number(spark):
    number = text.version_number(F.col("p"))
    assert value(spark, number, p="outputs/checkpoint-1000") == 1000
    assert value(spark, number, p="outputs/final") is None


@pytest.mark.parametrize(
    "message, kept",
    [("", False), (" \t", False), ("QUIT", False), (" q ", False), ("Exit\n", False)]
    + [("quit now", True), ("hello", True)],
)
def test_is_message(spark, message, kept):
    assert value(spark, text.is_message(F.col("m")), m=message) is kept
