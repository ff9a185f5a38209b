"""Toxicity scores, surrogates and the pipeline."""

import importlib.util
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import DATA
from intentloom.llm import simhash, surrogates, toxicity
from intentloom.llm.queries import QUERIES
from intentloom.session import settle

LARGE = f"{DATA}/sf0.1"
SMALL = f"{DATA}/sf0.01"


def auc(toxic, clean):
    return sum((clean < s).mean() + (clean == s).mean() / 2 for s in toxic) / len(toxic)


def test_held_out_texts_are_told_apart(spark):
    found = QUERIES["op9_toxicity"](spark, LARGE).toPandas()
    assert len(found) == 10_000 and found.score.between(0, 1).all()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").toPandas()
    held = found.merge(labels, on="doc_id")
    held = held[held.held_out]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert auc(toxic.score.values, clean.score.values) > 0.95
    assert toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.005


def test_features_of_odd_texts():
    lexicon = toxicity.Lexicon({"idiot": 3.0}, {"idio": 2.0})
    for text in ("", " \n", "!" * 1000, "\x00", "word " * 20_000, "É" * 500):
        assert len(toxicity.text_features(text, lexicon)) == len(toxicity.FEATURES)
    shown = dict(zip(toxicity.FEATURES, toxicity.text_features("You 1d10t, you IDIOT", lexicon)))
    assert shown["word_hits"] == shown["hits_near_second_person"] == shown["disguised_hits"] == 1


SCHEMA = "doc_id bigint, text string, _features string, prediction string"


@pytest.mark.parametrize("toxic", [0, 1, None])
def test_labels_of_one_kind_give_a_constant(spark, toxic):
    docs = spark.createDataFrame([(1, "a", "x", "y"), (1, "a", "x", "y"), (None, None, "x", "y")], SCHEMA)
    labels = spark.createDataFrame([(1, toxic), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(toxicity.labelled_texts(docs, labels))
    scored = toxicity.score_toxicity(docs, model, "score")
    assert [r["score"] for r in scored.collect()] == [float(toxic or 0)] * 3
    assert toxicity.score_toxicity(docs.limit(0), model, "score").count() == 0


def test_scores_leave_other_columns_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit_toxicity(toxicity.labelled_texts(docs, labels))
    assert model.trees is not None
    odd = spark.createDataFrame([(1, None, "x", "y"), (1, "", "x", "y"), (2, "w " * 30_000, "x", "y")], SCHEMA)
    scored = toxicity.score_toxicity(odd, model, "score").collect()
    assert [(r["_features"], r["prediction"]) for r in scored] == [("x", "y")] * 3
    assert all(0 <= r["score"] <= 1 for r in scored)


LETTER = (
    'Frau Anna Weber und Herr Weber, MR. WEBER: a.b@Mail.example.com, +1 (017) 555-7713 or '
    '+1 017 555 7713, DE89370400440532013000, 1.2.3.4. token = "04dbebab91ab85" '
    "4111 1111 1111 1111 Госпожа Ивана Петрова"
)


def test_formats_scripts_and_references_are_kept():
    new = surrogates._replaced(LETTER, "key", {})["text"]
    old, now = (
        [(t[a:b], k) for a, b, k in surrogates.find_entities(t)] for t in (LETTER, new)
    )
    assert [k for _, k in old] == [k for _, k in now] and len(old) == 13
    pairs = dict(zip([w for w, _ in old], [w for w, _ in now]))
    assert all(a != b for a, b in pairs.items())
    assert pairs["WEBER"] == pairs["Weber"].upper()  # one surname, in two cases
    assert surrogates.entity_key("phone", pairs["+1 (017) 555-7713"]) == surrogates.entity_key(
        "phone", pairs["+1 017 555 7713"]
    )
    card = pairs["4111 1111 1111 1111"]
    assert [len(p) for p in card.split(" ")] == [4] * 4 and surrogates._checks(card.replace(" ", ""))
    assert set(pairs["04dbebab91ab85"]) <= set("0123456789abcdef")
    assert "а" <= pairs["Петрова"][1] <= "я" and pairs["Ивана"][0].isupper()
    rest = LETTER, new
    for k, found in enumerate((old, now)):
        text = rest[k]
        for word, _ in sorted(found, key=lambda w: -len(w[0])):
            text = text.replace(word, "#")
        rest = (text, rest[1]) if k == 0 else (rest[0], text)
    assert rest[0] == rest[1]
    assert surrogates._replaced(LETTER, "other", {})["text"] != new


def test_no_two_values_share_a_surrogate(spark):
    ips = [f"10.0.{a}.{b}" for a in range(4) for b in range(250)]
    cards = [f"{k:04d}" * 4 for k in range(300)]
    rows = [("ip", v) for v in ips] + [("card", v) for v in cards]
    table = settle(spark.createDataFrame(rows, "kind string, key string"))
    found = surrogates.surrogate_table(table, "key").collect()
    assert len(found) == len(rows) == len({(r["kind"], r["surrogate"]) for r in found})
    assert not {(r["kind"], r["surrogate"]) for r in found} & set(rows)


def test_values_with_nothing_to_draw_get_surrogates(spark):
    rows = [("secret", v) for v in ("!?!?!?!?", "漢字漢字漢字漢字", "¡¿¡¿¡¿¡¿", "ёёёёёёёё", "ﬁﬁﬁﬁﬁﬁﬁﬁ")]
    rows += [("email", f"{c}@b.de") for c in "abcdefghijklmnopqrstuvwxyz_%+"]
    table = settle(spark.createDataFrame(rows, "kind string, key string"))
    found = surrogates.surrogate_table(table, "key").collect()
    assert len(found) == len(rows) == len({(r["kind"], r["surrogate"]) for r in found})
    assert not {(r["kind"], r["surrogate"]) for r in found} & set(rows)
    for kind, key in (("phone", "01512345678"), ("iban", "de89370400440532013000"), ("card", "4" * 16),
                      ("surname", "weber"), ("ip", "1.2.3.4"), ("secret", "0" * 8), ("email", "a@b.de")):
        early, late = (surrogates.surrogate_key("key", kind, key, n) for n in (0, 30))
        assert len(late) > len(early)
        assert surrogates.written_like(kind, key, late).casefold() == late


@pytest.mark.parametrize(
    "text, values",
    [
        ("Mr John Smith came. Smith said: JOHN, John's cat and John Smith.",
         "John Smith Smith JOHN John John Smith"),
        ("Anna wrote to Frau Anna O'Neil; O'Neil, Weber-Klein and Herr Weber-Klein.",
         "Anna Anna O'Neil O'Neil Weber-Klein Weber-Klein"),
        ("Mr Brown saw a brown dog; Brownie ran.", "Brown"),
        ("call 555-867-5309, or (017) 555-7713", "555-867-5309|(017) 555-7713"),
        ("0151 2345678; 030/1234567; 01.02.2024 0815 12 0.123456789 10-2024 007", "0151 2345678|030/1234567"),
        ("password: hunter2hunter. token=ab12cd34ef", "hunter2hunter|ab12cd34ef"),
        ("password: required, token: something", ""),
        (f'api_key = "{"k3y" * 100}"', "k3y" * 100),
    ],
)
def test_further_mentions_and_forms_are_found(text, values):
    expected = values.split("|" if "|" in values or values[:1].isdigit() else " ") if values else []
    found = surrogates.find_entities(text)
    assert [text[a:b] for a, b, _ in found] == expected
    pairs = {}
    for (a, b, kind), e in zip(found, surrogates._replaced(text, "key", {})["entities"]):
        key = (kind, text[a:b].casefold())
        assert pairs.setdefault(key, e["surrogate"].casefold()) == e["surrogate"].casefold()
        assert e["surrogate"] != text[a:b]


def test_masks_are_no_secrets(spark):
    text = 'password = "********" and password = "••••••••"'
    assert surrogates.find_entities(text) == []
    docs = spark.createDataFrame([(1, text, "x", "y")], SCHEMA)
    assert surrogates.replace_entities(docs, "key", "out").first()["out"]["text"] == text


def test_collisions_are_drawn_again_and_reach_the_texts(spark, monkeypatch):
    real = surrogates.surrogate_key

    def narrow(secret, kind, key, attempt):  # ten values only, until the third draw
        drawn = real(secret, kind, key, attempt)
        return f"9.9.9.{int(drawn[-1])}" if attempt < 2 else drawn

    given = [(k, f"at 10.0.0.{k} and 10.0.0.{k}", "x", "y") for k in range(1, 40)]
    given += [(1, given[0][1], "x", "y"), (50, None, "x", "y"), (51, "", "x", "y"), (None, "none", "x", "y")]
    docs = spark.createDataFrame(given, SCHEMA)
    keys = docs.select(F.explode(surrogates._keys_udf()("text")).alias("e")).select("e.*").distinct()
    drawn = spark.createDataFrame([(r["kind"], r["key"], k % 3) for k, r in enumerate(keys.collect())],
                                  "kind string, key string, attempt int")
    monkeypatch.setattr(surrogates, "surrogate_table", lambda entities, secret: drawn)
    texts = []
    for bound in (10_000, 1):  # broadcast, and joined
        monkeypatch.setattr(surrogates, "SMALL_ROWS", bound)
        out = surrogates.replace_entities(docs, "key", "prediction_2")
        assert out.columns == [*docs.columns, "prediction_2"]
        texts.append(sorted((r["doc_id"] or 0, r["prediction_2"]["text"] or "") for r in out.collect()))
    assert texts[0] == texts[1] and len(texts[0]) == len(given)
    attempts = {r["key"]: r["attempt"] for r in drawn.collect()}
    ip = real("key", "ip", "10.0.0.7", attempts["10.0.0.7"])
    assert (7, f"at {ip} and {ip}") in texts[0]
    assert narrow("key", "ip", "10.0.0.7", 2) == real("key", "ip", "10.0.0.7", 2)
    assert surrogates.replace_entities(docs.limit(0), "key", "out").count() == 0


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def test_only_numbers_with_a_check_digit_are_cards():
    for text, there in (("4111 1111 1111 1111", True), ("4111-1111-1111-1112", False), ("order 1234567812345678", False),
                        ("1234567812345670.", True), ("12345678123456701", False)):
        assert ([k for _, _, k in surrogates.find_entities(text)] == ["card"]) == there
    new = surrogates._replaced("4111 1111 1111 1111", "key", {})["text"]
    assert luhn([int(c) for c in new if c.isdigit()])


def test_keys_of_any_length_are_keys():
    long = "k" * 64
    drawn = {surrogates.surrogate_key(key, "phone", "0" * 16, 0) for key in (long, long + "a", long + "b", "k")}
    assert len(drawn) == 4


def test_values_found_by_another_search_are_gone(spark):
    """Addresses and card numbers found by splitting, not by the operator's patterns."""
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {r["doc_id"]: r["text"] or "" for r in QUERIES["op10_pii"](spark, SMALL).collect()}
    values = {}
    for i, text in docs.items():
        for word in text.split():
            own = word.strip("\"'.,;:!?()<>[]")
            local, at, domain = own.partition("@")
            if at and local.isascii() and local.replace(".", "").replace("_", "").isalnum():
                if domain.isascii() and domain.replace(".", "").isalnum() and "." in domain:
                    values.setdefault(own.lower(), set()).add(i)
        shown = "".join(c if c.isdigit() else " " if c in " -" else "x" for c in text)
        for run in shown.split("x"):
            digits = run.replace(" ", "")
            if len(digits) == 16 and set(map(len, run.split())) in ({16}, {4}) and luhn(list(map(int, digits))):
                values.setdefault(digits, set()).add(i)
    assert len(values) > 20 and sum(v.isdigit() for v in values) > 3
    for value, ids in values.items():
        for i in ids:
            now = "".join(c for c in found[i] if c not in " -") if value.isdigit() else found[i].lower()
            assert value not in now, (i, value)
    rest = [i for i in docs if not surrogates.find_entities(docs[i])]
    assert len(rest) > len(docs) / 2 and all(found[i] == docs[i] for i in rest)


def test_pii_query_covers_whole_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op10_pii"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        entities = surrogates.find_entities(docs[r["doc_id"]])
        assert r["n_entities"] == len(entities)
        for a, b, kind in entities:
            if kind in ("email", "phone", "card", "secret"):
                assert docs[r["doc_id"]][a:b] not in r["text"]
        if not entities:
            assert r["text"] == docs[r["doc_id"]]


def test_pipeline_stages_and_run(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "pieces"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        if name == "near_duplicates":  # against all pairs of this stage's input
            prints = [simhash.fingerprint(r["text"] or "", 3) for r in docs.collect()]
            bits = np.array(prints).view(np.uint64)
            parent = list(range(len(prints)))

            def root(k):
                while parent[k] != k:
                    k = parent[k]
                return k

            for k in range(len(prints)):
                for j in np.flatnonzero(np.bitwise_count(bits[:k] ^ bits[k]) <= 3).tolist():
                    parent[max(root(j), root(k))] = min(root(j), root(k))
            expected = len({root(k) for k in range(len(prints))})
        docs = settle(stage(spark, docs, SMALL), name)
        kept.append(docs.count())
        if name == "near_duplicates":
            assert kept[-1] == expected
        if name != "pieces":
            assert docs.columns == columns
    assert 1000 > kept[0] > kept[1] >= kept[2] == kept[3] == kept[4]
    assert corpus_pipeline.run(spark, SMALL).count() == kept[-1]


def test_stages_take_odd_documents(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _score string"
    rows = [(1, "a b", None, None, None, "x"), (1, "a b", None, None, None, "x"), (None, None, None, None, None, None),
            (2, "", "en", "s", 0, "x"), (3, "word " * 30_000, "en", "s", 150_000, "x")]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, SMALL), name)
        assert docs.count() == (4 if given else 0) or given


def test_the_rest_works_without_these_operators(tmp_path):
    repo = Path(__file__).parents[2]
    copy = tmp_path / "repo"
    shutil.copytree(repo, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()))"
    shown = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    count, pipeline, twins = shown.stdout.split()
    assert pipeline == "False" and int(count) - int(twins) == 1, shown.stderr
    assert importlib.util.find_spec("intentloom.llm") is not None
