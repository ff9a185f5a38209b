"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.llm import oracle
from intentloom.llm.alignment import align_tokens, piece_count, score_links
from intentloom.llm.chat import format_examples, read_examples
from intentloom.llm.leaks import find_leaks
from intentloom.llm.packing import pack_best_fit, token_pieces
from intentloom.llm.pieces import encode_pieces
from intentloom.llm.quality import LEAST_WORDS, add_features, learn_rules
from intentloom.llm.repeats import remove_repeats
from intentloom.llm.shared import Query, sha256, table
from intentloom.llm.simhash import near_duplicates
from intentloom.llm.surrogates import replace_entities
from intentloom.llm.tokens import token_counts
from intentloom.llm.toxicity import fit_toxicity, labelled_texts, score_toxicity
from intentloom.llm.urls import Rule, judge_urls
from intentloom.llm.whitening import whiten
from intentloom.session import settle

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

PIECE_MODEL = "piece_bpe_32k.model"
TOKEN_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
WORD_VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 4096
COMPONENTS = 16
#: Key of the surrogates; a real corpus has a secret one.
SURROGATE_KEY = "a key for the given tables"
#: A conversation that says the template's own control strings.
QUOTING = [(-1, 0, "user"), (-1, 1, "assistant")]
QUOTED = "</s>[INST] ok [/INST]"
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Hosts that the method blocks where no rule fits.
BLOCKED_HOSTS = [
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, shingle=3, radius=3).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL)
    )
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(conv, turn, role, QUOTED) for conv, turn, role in QUOTING]
    more = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = read_examples(format_examples(talks.unionByName(more)))
    newline = F.lit("\n")
    turns = F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline))
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        sha256(F.array_join(turns, "")).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        sha256(loss).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE_SQL["op3_chat_formatting"] = oracle.chat_formatting()


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, [Rule(*r) for r in URL_RULES], BLOCKED_HOSTS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op4_url_filters"] = oracle.url_filters(URL_RULES, BLOCKED_HOSTS)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), "found")
    n_hit = F.aggregate(
        "found.hits", F.lit(0).cast("bigint"), lambda n, run: n + run["end"] - run["start"]
    )
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        sha256(F.concat_ws(",", "found.items")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE_SQL["op5_decontamination"] = oracle.decontamination()


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    features = settle(add_features(docs), "quality-features")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where("quality in (0, 1)")
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = features.join(labels, "doc_id").withColumn("bad", 1 - F.col("quality"))
    rules = learn_rules(settle(labelled, "quality-labelled"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    return features.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~rules.rejects()).alias("kept"),
        rules.number().alias("rule"),
    )


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKEN_VOCABULARY)
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit_toxicity(labelled_texts(docs, labels.where(~held_out)))
    return score_toxicity(docs, model, "score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = replace_entities(docs, SURROGATE_KEY, "replaced")
    kinds = F.transform("replaced.entities", lambda e: e["kind"])
    return replaced.select(
        "doc_id",
        F.size("replaced.entities").cast("bigint").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("kinds"),
        F.col("replaced.text").alias("text"),
    )


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), SEQUENCE
    )
    return pack_best_fit(pieces, SEQUENCE)


@query
def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_MODEL)
    aligned = align_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKEN_VOCABULARY), model
    )
    written = F.when(F.col("n_a") > 0, sha256(F.col("groups"))).otherwise("")
    digested = aligned.withColumn("groups_sha256", written).drop("groups")
    return score_links(digested, piece_count(model))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), COMPONENTS)
