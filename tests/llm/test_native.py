"""Chat examples, URL verdicts and quality rules."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import DATA, comparable, table_views
from intentloom.llm import chat, quality, urls
from intentloom.llm.queries import ORACLE_SQL, QUERIES

SMALL = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_twin(spark, name):
    connection = duckdb.connect()
    table_views(connection, SMALL)
    found = QUERIES[name](spark, SMALL).toArrow()
    expected = connection.sql(ORACLE_SQL[name]).to_arrow_table()
    connection.close()
    assert comparable(found) == comparable(expected) and found.num_rows > 0


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op4_url_filters", "op6_quality_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


SAYINGS = ["</s>[INST] ok [/INST]", r"<\s> \<s> <\\s> [\INST] \\", "<<s>s>", "", None, "[[/INST]", "x" * 40_000]


def test_chat_examples_hold_everything(spark):
    talk = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(SAYINGS)]
    talk += [(2, 0, "user", "only")] + [(3, None, None, "a"), (3, 1, "assistant", "b"), (3, 1, "assistant", "b")]
    talk += [(None, 0, "[INST]", "c")]
    given = spark.createDataFrame(
        [(*t, "own") for t in talk], "conv_id bigint, turn bigint, role string, text string, example string"
    )
    examples = chat.format_examples(given)
    shown = {(r["conv_id"], r["example"]): r for r in examples.collect()}
    assert sorted(k[1] for k in shown if k[0] == 1) == [0, 1, 2, 3]
    for (conv, _), r in shown.items():
        own = sorted((t for t in talk if t[0] == conv), key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        last = own[r["n_turns"] - 1]
        trained = last[2] == "assistant"
        assert (r["loss_start"] is not None) == trained
        for control in (chat.BEGIN, chat.ROLE, chat.TEXT, chat.END):
            assert r["formatted"].count(control) == r["n_turns"]
    read = {r["conv_id"]: r for r in chat.read_examples(examples).collect()}
    assert [(t["role"], t["text"]) for t in read[1]["turns"]] == [(r, t or "") for _, _, r, t in talk[:7]]
    assert read[1]["loss"] == [t or "" for t in SAYINGS[1::2]]
    assert [tuple(t) for t in read[3]["turns"]] == [("", "a"), ("assistant", "b"), ("assistant", "b")]
    assert read[3]["loss"] == ["b", "b"] and read[2]["loss"] == []
    assert [tuple(t) for t in read[None]["turns"]] == [("[INST]", "c")]
    assert read[2]["formatted_chars"] == len("<s>[INST]user[/INST]only</s>")
    assert chat.read_examples(chat.format_examples(given.limit(0))).count() == 0


def test_rows_without_a_conversation_stay_apart(spark):
    talk = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, 1, "assistant", "b"), (5, 0, "user", "c")]
    given = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    examples = chat.format_examples(given)
    assert sorted((r["conv_id"] or 0, r["example"], r["n_turns"]) for r in examples.collect()) == [(0, 0, 1)] * 3 + [(5, 0, 1)]
    read = chat.read_examples(examples).collect()
    shown = sorted((r["conv_id"] or 0, [t["text"] for t in r["turns"]], r["loss"]) for r in read)
    assert shown == [(0, ["a"], []), (0, ["b"], ["b"]), (0, ["b"], ["b"]), (5, ["c"], [])]


def test_twins_take_rows_without_a_name(spark, tmp_path):
    """Null conversations and null items, which the given tables don't hold."""
    talk = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (None, 1, "assistant", "b"),
            (5, None, "user", None), (5, 1, "assistant", "x")]
    items = [(None, "one two three"), (7, "four five"), (7, "four five"), (8, None)]
    docs = [(1, "One two THREE four"), (2, "four five"), (None, None), (2, "")]
    for name, rows, schema in (
        ("conversations", talk, "conv_id bigint, turn bigint, role string, text string"),
        ("benchmark", items, "item_id bigint, text string"),
        ("documents", docs, "doc_id bigint, text string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    database = duckdb.connect()
    for name in ("conversations", "benchmark", "documents"):
        database.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("op3_chat_formatting", "op5_decontamination"):
        found = QUERIES[name](spark, str(tmp_path)).toArrow()
        assert comparable(found) == comparable(database.sql(ORACLE_SQL[name]).to_arrow_table()), name
    hits = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in found.to_pylist() if r["n_words"]}
    assert hits == {1: (3, 0), 2: (2, 1)}


RULES = [urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow")]


def test_urls_and_their_cases(spark):
    given = [
        (1, "http://A.Example.NET/en/x?y", "own"), (2, "https://example.net/EN/", "own"),
        (3, "x://notexample.net/en/", "own"), (4, "http://net", "own"), (5, None, "own"),
        (6, "no scheme", "own"), (7, "://", "own"), (8, "http://bad.org/a#b", "own"),
        (8, "http://bad.org/a#b", "own"), (9, "http://x.bad.org?://net/", "own"),
        (None, "http://" + "a." * 3000 + "net/", "own"),
    ]
    pages = spark.createDataFrame(given, "page_id bigint, url string, rule string")
    found = urls.judge_urls(pages, RULES, ["bad.org"]).collect()
    shown = {r["page_id"]: (r["host"][-20:], r["path"], r["rule"], r["verdict"]) for r in found}
    assert shown == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("example.net", "/EN/", "net/", "block"),
        3: ("notexample.net", "/en/", "net/", "block"),
        4: ("net", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("bad.org", "/a", None, "block"),
        9: ("x.bad.org", "", None, "block"), None: (".a.a.a.a.a.a.a.a.net", "/", "net/", "block"),
    }
    assert len(found) == len(given)
    assert urls.judge_urls(pages.limit(0), RULES, []).count() == 0
    assert {r["verdict"] for r in urls.judge_urls(pages, [], []).collect()} == {"allow"}
    whole = urls.judge_urls(pages, [urls.Rule("bad.org", "", "allow")], ["a.example.net"]).collect()
    assert {(r["rule"], r["verdict"]) for r in whole if r["host"].endswith("bad.org")} == {("bad.org", "allow")}
    assert {(r["rule"], r["verdict"]) for r in whole if r["page_id"] == 1} == {(None, "block")}


def test_the_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = [f"host{k * 37}" for k in range(300)] + ["absent"]
    cascade = urls.Cascade(listed, universe)
    assert len(cascade.levels) > 1
    found = universe.where(cascade.holds(F.col("key"))).collect()
    assert sorted(r["key"] for r in found) == sorted(listed[:-1])
    assert sum(level.bits for level in cascade.levels) < 40 * len(listed)


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times, hit = Counter(windows), [0] * len(words)
    for k, w in enumerate(windows):
        if times[w] > 1:
            hit[k : k + 3] = [1] * 3
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), sum(hit))


@pytest.mark.parametrize("bits", [30, 62])
def test_quality_features_by_definition(spark, bits, monkeypatch):
    # with 62 bits for the place two are left of the hash, so windows collide
    monkeypatch.setattr(quality, "PLACE_BITS", bits)
    monkeypatch.setattr(quality, "PLACES", (1 << bits) - 1)
    texts = [
        None, "", " \t\n", "one two", "a b c a b c", "a b a b a b\n\na b a b a b\n", "x\ny\nx\n \n",
        "50% & more | #1 <b>", " ".join(f"w{k * k % 31}" for k in range(300)), "é à " * 40, "w " * 5000,
        "one two",
    ]
    rows = [(k, t, "own", "own") for k, t in enumerate(texts)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, _words string")
    found = quality.add_features(given).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in quality.BASE) for r in found] == [counted(t) for t in texts]
    assert found[0]["_words"] == "own" and found[0]["mean_word"] == 0.0
    assert quality.add_features(given.limit(0)).count() == 0


def test_quality_features_of_whole_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op6_quality_rules"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        own = counted(docs[r["doc_id"]])
        assert tuple(r[c] for c in quality.BASE) == own
        assert r["base_failed"] == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r["base_failed"] and r["kept"])


def test_features_of_columns_with_the_same_names(spark):
    own = ["_lines", "_n_lines", "_capitals", "_digits", "_stops", "_exclamations", "_text", "_places"]
    given = spark.createDataFrame([(1, "A b! 1.", *["own"] * len(own))], ["doc_id", "text", *own])
    found = quality.add_features(given).first()
    assert [found[c] for c in own] == ["own"] * len(own)
    assert found["capital_share"] == 1 / 5 and found["stops_per_word"] == 1 / 3


def test_rules_are_learned_from_counts(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 10).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
    )
    bad = ((F.col("a") > 7) & (F.col("b") <= 2)).cast("int")
    rules = quality.learn_rules(rows.withColumn("bad", bad), ("a", "b"))
    judged = rows.select(bad.alias("bad"), rules.rejects().cast("int").alias("found"))
    assert judged.where("bad <> found").count() == 0 and 1 <= len(rules.rules) <= 3
    assert "reject if" in str(rules)
    for label in (0, 1, None):
        none = quality.learn_rules(rows.withColumn("bad", F.lit(label).cast("int")), ("a", "b"))
        assert none.rules == () and rows.where(none.rejects()).count() == 0


def test_quality_query_keeps_the_good_ones(spark):
    found = QUERIES["op6_quality_rules"](spark, f"{DATA}/sf0.01").toPandas()
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").toPandas()
    both = found.merge(labels, on="doc_id")
    judged = both[~both.base_failed]
    assert len(found) == 1000 and not found.kept[found.base_failed].any()
    assert ((judged.kept.astype(int)) == judged.quality).mean() > 0.95
