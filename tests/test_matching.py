import random
from difflib import SequenceMatcher, get_close_matches

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from intentloom.functions.matching import LabelMatcher, closest_labels

words = st.text(alphabet="abcde_ é", max_size=14)


def names(found):
    return [label for _, label in found]


@settings(max_examples=300, deadline=None)
@given(
    labels=st.lists(words.filter(bool), min_size=1, max_size=12, unique=True),
    text=words.filter(bool),
    n=st.integers(1, 4),
    cutoff=st.sampled_from([0.3, 0.6, 0.8]),
)
def test_matcher_agrees_with_difflib(labels, text, n, cutoff):
    assert names(LabelMatcher(labels, cutoff, n).best(text)) == get_close_matches(
        text, labels, n=n, cutoff=cutoff
    )


def test_matcher_agrees_on_long_texts_with_popular_characters():
    draw = random.Random(5)
    labels = ["".join(draw.choices("abcdefgh", k=draw.randint(150, 260))) for _ in range(20)]
    for _ in range(10):
        text = list(draw.choice(labels))
        for _ in range(60):
            text[draw.randrange(len(text))] = draw.choice("abcdefgh")
        text = "".join(text)
        expected = get_close_matches(text, labels, n=3, cutoff=0.2)
        assert names(LabelMatcher(labels, 0.2, 3).best(text)) == expected


def test_the_label_is_the_first_sequence():
    assert SequenceMatcher(None, "tide", "diet").ratio() == 0.25
    assert LabelMatcher(["tide"], 0.2, 1).best("diet") == [(0.25, "tide")]
    assert LabelMatcher(["diet"], 0.2, 1).best("tide") == [(0.5, "diet")]


def test_equal_ratios_go_to_the_larger_label():
    assert names(LabelMatcher(["abce", "abcf"], 0.6, 1).best("abcd")) == ["abcf"]
    assert names(LabelMatcher(["abcf", "abce"], 0.6, 2).best("abcd")) == ["abcf", "abce"]


def test_a_ratio_at_the_cutoff_is_kept():
    assert LabelMatcher(["abcxx"], 0.6, 1).best("abcyy") == [(0.6, "abcxx")]


@pytest.mark.parametrize("labels, text", [([], "abc"), (["abc"], ""), (["abc"], "xyz")])
def test_no_match(labels, text):
    assert LabelMatcher(labels, 0.6, 1).best(text) == []


def test_udf_handles_nulls_blanks_and_repeats(spark):
    shared = spark.sparkContext.broadcast(["card_arrival", "card_lost"])
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["card arrival", None, "", "card arrival", "zzz"])],
        "id int, t string",
    )
    found = df.select("id", closest_labels(shared, 0.6, 2)(F.col("t")).alias("m")).collect()
    by_id = {r["id"]: [m["label"] for m in r["m"]] for r in found}
    assert by_id == {0: ["card_arrival"], 1: [], 2: [], 3: ["card_arrival"], 4: []}
