"""The registered queries: each operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentloom.functions import fixed
from intentloom.functions import text as t
from intentloom.operators import checks, classify, corpus, evaluate, ledger, resolve, resume, sampling
from intentloom.operators.scale import lookup_join
from intentloom.plans import publishing
from intentloom.plans import standins as s
from intentloom.plans.evaluation import score_and_evaluate as _evaluate
from intentloom.plans.preparation import prepare_records as _prepare
from intentloom.session import fresh_path, settle
from intentloom.sources import corpus as files
from intentloom.sources import footers
from intentloom.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs shared by several queries -----------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.messages(s.table(spark, sf_dir, "conversations"))


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.generations(s.table(spark, sf_dir, "part"))


def _extracted(generations: DataFrame) -> DataFrame:
    return generations.select(
        "row_id", "run", "y_true", t.extract_answer(F.col("decoded")).alias("raw")
    )


def _raws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(_generations(spark, sf_dir))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved prediction pairs (row_id, run, y_true, raw, y_pred, match_kind)."""
    return resolve.resolve_prediction(
        _raws(spark, sf_dir), "raw", s.part_labels(spark, sf_dir)
    )


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_counts(_resolved(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = s.source_labels(spark, sf_dir)
    instruction = corpus.instruction_text(vocab)
    return corpus.sft_columns(s.clean_documents(spark, sf_dir, vocab), instruction)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _language_model(spark: SparkSession, sf_dir: str) -> classify.WordModel:
    docs = s.table(spark, sf_dir, "documents")
    return classify.train_classifier_nb(docs, "text", "lang")


def _score(df: DataFrame) -> DataFrame:
    """Stand-in for a generating model: answers with the first word of the message."""
    mark = fixed.ANSWER_MARK

    def load() -> Callable[[str], str]:
        return lambda message: f"{mark}\n{message.split(' ')[0]}\nend"

    return classify.batch_score_udf(df, "message", load)


# --- sources and sinks ----------------------------------------------------------


@query
def scan_corpus(spark, sf_dir):
    names = {"train": "documents", "test": "conversations", "validation": "benchmark"}
    return files.scan_corpus(
        spark, {split: f"{sf_dir}/{name}.parquet" for split, name in names.items()}
    )


@query
def label_dim(spark, sf_dir):
    return s.source_labels(spark, sf_dir)


@query
def label_names_from_files(spark, sf_dir):
    """The corpus with ids for names, written with the names in its footers; these alone."""
    path, vocab = fresh_path(spark, "named"), s.source_labels(spark, sf_dir)
    docs = s.table(spark, sf_dir, "documents").withColumnRenamed("source", "intent")
    coded = lookup_join(docs, vocab, "intent", "inner", ["doc_id"]).select("text", "label")
    footers.with_label_names(coded, "label", vocab).write.parquet(path)
    return footers.label_names_from_files(spark, path, "label")


@query
def load_label_vocab(spark, sf_dir):
    path = fresh_path(spark, "labels")
    padded = s.source_labels(spark, sf_dir).select(
        "label", F.concat(F.lit(" \t"), "intent", F.lit("\n \n")).alias("intent")
    )
    files.write_label_vocab(padded, path)
    return files.load_label_vocab(spark, path)


@query
def vocab_from_data(spark, sf_dir):
    outputs = s.table(spark, sf_dir, "part").select(s.part_label().alias("output"))
    return files.vocab_from_data(outputs)


@query
def read_sft_csv(spark, sf_dir):
    path = fresh_path(spark, "records")
    records = _records(spark, sf_dir).withColumn("split", F.lit("train"))
    files.write_sft_dataset(records, path, "csv")
    return files.read_sft_csv(spark, f"{path}/split=train")


@query
def write_sft_dataset(spark, sf_dir):
    path = fresh_path(spark, "records")
    records = _records(spark, sf_dir).withColumn(
        "split", F.when(F.col("label") < 4, "test").otherwise("train")
    )
    files.write_sft_dataset(records, path)
    return spark.read.parquet(path)


@query
def write_label_vocab(spark, sf_dir):
    path = fresh_path(spark, "labels")
    files.write_label_vocab(s.part_labels(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("intent"))


@query
def write_eval_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    evaluate.write_eval_report(evaluate.full_report(_confusion(spark, sf_dir)), path)
    lines = spark.read.text(f"{path}/text").select(F.col("value").alias("line"))
    table = _rounded(evaluate.read_eval_table(spark, path), "precision", "recall", "f1")
    return table.unionByName(lines, allowMissingColumns=True)


@query
def read_eval_reports(spark, sf_dir):
    path = fresh_path(spark, "reports")
    heading = F.concat(
        F.lit(fixed.ACCURACY_HEADING), t.percent_text(F.avg(_is_hit())), F.lit("%\n\nend")
    )
    per_run = _resolved(spark, sf_dir).groupBy("run").agg(heading.alias("value"))
    per_run.write.partitionBy("run").text(path)
    return ledger.read_eval_reports(spark, f"{path}/run=*").select(
        F.regexp_extract("path", "run=([^/]+)/", 1).alias("run"),
        t.extract_accuracy(F.col("content")).alias("accuracy"),
        "content",
    )


def _is_hit():
    return F.coalesce(F.col("y_true") == F.col("y_pred"), F.lit(False)).cast("int")


@query
def write_run_manifest(spark, sf_dir):
    path = fresh_path(spark, "manifests")
    ledger.write_run_manifest(s.runs(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("manifest"))


@query
def read_run_ledger(spark, sf_dir):
    path = fresh_path(spark, "manifests")
    ledger.write_run_manifest(s.runs(spark, sf_dir), path)
    return ledger.read_run_ledger(spark, path)


@query
def snapshot_run(spark, sf_dir):
    root = fresh_path(spark, "artifacts")
    docs = s.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    tables = {
        "outputs": s.table(spark, sf_dir, "part"),
        "sample_data": s.table(spark, sf_dir, "labels"),
        "configs": s.part_labels(spark, sf_dir),
    }
    ledger.snapshot_run(tables, "run a", root)
    ledger.snapshot_run({**tables, "sample_data": docs}, "run a", root)
    shown = {
        "outputs": (F.col("p_partkey"), F.concat_ws("/", "p_name", "p_brand")),
        "sample_data": (F.col("doc_id"), F.concat_ws("/", "lang", "source", "n_chars")),
        "configs": (F.col("label"), F.col("intent")),
    }
    parts = [
        ledger.read_snapshots(spark, root, name).select(
            "run_name", F.lit(name).alias("table"), key.alias("key"), value.alias("value")
        )
        for name, (key, value) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- projections and filters ------------------------------------------------------


@query
def normalize_text(spark, sf_dir):
    clean = t.normalize_text(F.col("text")).alias("text")
    return s.table(spark, sf_dir, "documents").select("doc_id", clean)


@query
def strip_message(spark, sf_dir):
    bare = t.strip_message(F.col("message")).alias("message")
    return _messages(spark, sf_dir).select("conv_id", "turn", bare)


@query
def sft_columns(spark, sf_dir):
    return _records(spark, sf_dir).select(
        "doc_id", "text", "label", "intent", "instruction", "input", "output"
    )


@query
def project_sft(spark, sf_dir):
    return corpus.project_sft(_records(spark, sf_dir))


@query
def render_train_prompt(spark, sf_dir):
    prompt = t.render_train_prompt(
        F.col("instruction"), F.col("input"), F.col("output"), s.END_MARK
    )
    return _records(spark, sf_dir).select("doc_id", prompt.alias("prompt"))


@query
def render_eval_prompt(spark, sf_dir):
    instruction = F.lit(corpus.instruction_text(s.source_labels(spark, sf_dir)))
    message = t.strip_message(F.col("message"))
    prompt = t.render_eval_prompt(instruction, message)
    return _messages(spark, sf_dir).select("conv_id", "turn", prompt.alias("prompt"))


@query
def fallback_instruction(spark, sf_dir):
    no_labels = s.source_labels(spark, sf_dir).where("intent = ''")
    instruction = F.lit(corpus.instruction_text(no_labels))
    prompt = t.render_eval_prompt(instruction, t.strip_message(F.col("message")))
    return _messages(spark, sf_dir).select("conv_id", "turn", prompt.alias("prompt"))


@query
def extract_accuracy(spark, sf_dir):
    figure = t.extract_accuracy(F.col("content"))
    return s.reports(spark, sf_dir).select("doc_id", figure.alias("accuracy"))


@query
def extract_answer(spark, sf_dir):
    answer = t.extract_answer(F.col("decoded"))
    return _generations(spark, sf_dir).select("row_id", answer.alias("raw"))


@query
def run_name(spark, sf_dir):
    given = F.when(
        F.col("event_type") == "view", F.concat(F.lit("  run "), "user_id", F.lit("\t"))
    ).otherwise(F.lit("  "))
    name = t.run_name(given, F.col("ts"))
    return s.table(spark, sf_dir, "events").select("event_id", name.alias("run_name"))


@query
def preview_rows(spark, sf_dir):
    records = _records(spark, sf_dir).select("doc_id", "text", "intent", "instruction")
    return corpus.preview_rows(records, "doc_id", 5, {"instruction": 80, "text": 300})


@query
def message_gate(spark, sf_dir):
    return scoring.message_gate(_messages(spark, sf_dir), "message")


@query
def clean_corpus(spark, sf_dir):
    return checks.clean_corpus(s.raw_corpus(spark, sf_dir), "id", "text", "intent")


@query
def validate_sft(spark, sf_dir):
    vocab = s.source_labels(spark, sf_dir).where("label % 3 <> 0")
    return checks.validate_sft(s.documents(spark, sf_dir), vocab, 20)


@query
def split_overlap(spark, sf_dir):
    docs = s.table(spark, sf_dir, "documents").select("doc_id", "text")
    tests = F.col("doc_id") % 5 == 0
    return checks.split_overlap(docs.where(~tests), docs.where(tests), "text")


# --- joins -------------------------------------------------------------------------


def _sized_parts(spark, sf_dir):
    return s.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("label"))


@query
def decode_label(spark, sf_dir):
    vocab = s.source_labels(spark, sf_dir)
    return corpus.decode_label(_sized_parts(spark, sf_dir), vocab, ["p_partkey"])


@query
def undecodable_labels(spark, sf_dir):
    vocab = s.source_labels(spark, sf_dir)
    return corpus.undecodable_labels(_sized_parts(spark, sf_dir), vocab, ["p_partkey"])


@query
def exact_match_label(spark, sf_dir):
    return resolve.exact_match_label(_raws(spark, sf_dir), s.part_labels(spark, sf_dir))


@query
def fuzzy_match_label(spark, sf_dir):
    found = resolve.fuzzy_match_label(_raws(spark, sf_dir), s.part_labels(spark, sf_dir))
    return _rounded(found, "ratio")


@query
def best_label_topk(spark, sf_dir):
    found = resolve.best_label_topk(_raws(spark, sf_dir), s.part_labels(spark, sf_dir), 3)
    return _rounded(found, "ratio")


@query
def resolve_prediction(spark, sf_dir):
    return _resolved(spark, sf_dir).select("row_id", "y_true", "raw", "y_pred", "match_kind")


@query
def invalid_predictions(spark, sf_dir):
    return resolve.invalid_predictions(_resolved(spark, sf_dir), s.part_labels(spark, sf_dir))


@query
def unscored_rows(spark, sf_dir):
    docs = s.table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify.unscored_rows(docs, s.table(spark, sf_dir, "labels"), "doc_id")


# --- aggregations --------------------------------------------------------------------


@query
def corpus_profile(spark, sf_dir):
    full = s.corpus(spark, sf_dir).select("id", "intent", "split")
    sampled = sampling.sample_capped_per_class(full, "intent", "id", 20, within=("split",))
    before = corpus.corpus_profile(full, "intent").withColumn("stage", F.lit("full"))
    after = corpus.corpus_profile(sampled, "intent").withColumn("stage", F.lit("sampled"))
    return before.unionByName(after)


@query
def class_balance(spark, sf_dir):
    return _rounded(checks.class_balance(s.corpus(spark, sf_dir)), "ratio")


@query
def compare_runs(spark, sf_dir):
    """Answers as they came against answers mapped to labels."""
    resolved = _resolved(spark, sf_dir)
    plain = evaluate.confusion_counts(resolved.withColumn("y_pred", F.col("raw")))
    compared = evaluate.compare_runs(plain, evaluate.confusion_counts(resolved))
    return _rounded(compared, "first_f1", "second_f1", "f1_change")


@query
def build_instruction(spark, sf_dir):
    return corpus.build_instruction(s.part_labels(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    return _rounded(evaluate.accuracy(_resolved(spark, sf_dir)), "accuracy")


@query
def confusion_counts(spark, sf_dir):
    return _confusion(spark, sf_dir)


@query
def class_report(spark, sf_dir):
    report = evaluate.class_report(_confusion(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def report_averages(spark, sf_dir):
    report = evaluate.report_averages(_confusion(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def full_report(spark, sf_dir):
    report = evaluate.full_report(_confusion(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def prompt_budget(spark, sf_dir):
    prompt = t.render_train_prompt(
        F.col("instruction"), F.col("input"), F.col("output"), s.END_MARK
    )
    prompts = _records(spark, sf_dir).select(prompt.alias("prompt"))
    return _rounded(corpus.prompt_budget(prompts, "prompt"), "p50", "p90", "p99")


# --- windows, sorts and sets ------------------------------------------------------------


@query
def sample_capped_per_class(spark, sf_dir):
    docs = s.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return sampling.sample_capped_per_class(docs, "lang", "doc_id")


@query
def permuted_batches(spark, sf_dir):
    return sampling.permuted_batches(s.table(spark, sf_dir, "documents"), "doc_id")


@query
def stratified_split(spark, sf_dir):
    docs = s.table(spark, sf_dir, "documents")
    return sampling.stratified_split(docs, "lang", "doc_id", 0.1)


@query
def running_accuracy(spark, sf_dir):
    return _rounded(evaluate.running_accuracy(_resolved(spark, sf_dir)), "accuracy")


@query
def training_batches(spark, sf_dir):
    return sampling.training_batches(s.table(spark, sf_dir, "documents"), "doc_id")


@query
def latest_run(spark, sf_dir):
    return ledger.latest_run(s.runs(spark, sf_dir))


@query
def latest_version(spark, sf_dir):
    path = F.when(
        F.col("event_type") == "error", F.lit("outputs/logs")
    ).otherwise(F.concat(F.lit("outputs/checkpoint-"), "event_id"))
    return ledger.latest_version(
        s.table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), path.alias("path"))
    )


@query
def report_label_set(spark, sf_dir):
    return evaluate.report_label_set(_resolved(spark, sf_dir))


@query
def union_splits(spark, sf_dir):
    return s.corpus(spark, sf_dir).withColumn("text", t.normalize_text(F.col("text")))


@query
def prepare_records(spark, sf_dir):
    vocab = s.language_labels(spark, sf_dir)
    rows = lookup_join(s.corpus(spark, sf_dir), vocab, "intent", "inner", ["id"]).drop("intent")
    splits = {name: rows.where(F.col("split") == name).drop("split") for name in ("train", "test")}
    return _prepare(splits, vocab)


# --- classifier ----------------------------------------------------------------------------


@query
def train_classifier_nb(spark, sf_dir):
    return _rounded(_language_model(spark, sf_dir).table(), "log_likelihood")


@query
def resume_classifier_nb(spark, sf_dir):
    """The same counts, taken in by one update after another."""
    docs = s.table(spark, sf_dir, "documents").select("text", "lang", "doc_id")
    corpus_path, root = fresh_path(spark, "growing"), fresh_path(spark, "models")
    for k in range(2):
        docs.where(F.pmod("doc_id", F.lit(2)) == k).write.parquet(f"{corpus_path}/part{k}")
        resume.update_classifier_nb(spark, root, "lang", corpus_path, "text", "lang")
    return _rounded(resume.load_updated_model(spark, root, "lang").table(), "log_likelihood")


@query
def score_classifier_nb(spark, sf_dir):
    model = _language_model(spark, sf_dir)
    return classify.score_classifier_nb(s.table(spark, sf_dir, "pages"), "page_id", "html", model)


@query
def score_many_classes_nb(spark, sf_dir):
    """Who in which conversation most likely says a benchmark item: a class per speaker."""
    turns = s.table(spark, sf_dir, "conversations").dropna(subset=["conv_id", "role", "text"])
    turns = turns.select("text", F.concat("conv_id", F.lit("/"), "role").alias("label"))
    model = classify.train_classifier_nb(turns, "text", "label")
    return classify.score_classifier_nb(s.table(spark, sf_dir, "benchmark"), "item_id", "text", model)


@query
def train_classifier_ml(spark, sf_dir):
    docs = s.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = classify.train_classifier_ml(docs, "text", "lang")
    return classify.score_classifier_ml(docs, "doc_id", model)


@query
def save_load_model(spark, sf_dir):
    path = fresh_path(spark, "model")
    classify.save_model(_language_model(spark, sf_dir), path)
    model = classify.load_word_model(spark, path)
    feed = s.table(spark, sf_dir, "conversations").withColumn(
        "key", F.concat("conv_id", F.lit("/"), "turn")
    )
    return classify.score_classifier_nb(feed, "key", "text", model)


@query
def batch_score_udf(spark, sf_dir):
    return _score(_messages(spark, sf_dir)).select("conv_id", "turn", "decoded")


@query
def score_and_evaluate(spark, sf_dir):
    """Train on documents, score web pages, resolve the answers and report."""
    pages = s.table(spark, sf_dir, "pages").select(
        "page_id", "html", s.page_language().alias("y_true")
    )
    model = _language_model(spark, sf_dir)

    def scorer(df: DataFrame) -> DataFrame:
        scored = classify.score_classifier_nb(df, "page_id", "html", model)
        answer = F.concat(F.lit(f"{fixed.ANSWER_MARK}\n "), F.upper("label"), F.lit("\nend"))
        return df.select("page_id", "y_true").join(
            scored.select(F.col("id").alias("page_id"), answer.alias("decoded")), "page_id"
        )

    report = _evaluate(pages, scorer, s.language_labels(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


@query
def evaluate_answers(spark, sf_dir):
    """Stored answers to report in one plan: extract, resolve, count, average."""
    answers = _generations(spark, sf_dir)
    report = _evaluate(answers, lambda df: df, s.part_labels(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


QUERIES["eval_pipeline"] = evaluate_answers


@query
def answer_messages(spark, sf_dir):
    """A feed of messages to labels, as a batch."""
    vocab = s.part_labels(spark, sf_dir)
    return scoring.answer_messages(_messages(spark, sf_dir), "message", _score, vocab)


@query
def publish_run(spark, sf_dir):
    """Publish one run under a name and one under its time; what each has published."""
    root = fresh_path(spark, "artifacts")
    docs, events = (s.table(spark, sf_dir, name) for name in ("documents", "events"))
    times = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    report = settle(evaluate.full_report(_confusion(spark, sf_dir)), "report")
    tables = {
        "outputs": report,
        "sample_data": settle(sampling.sample_capped_per_class(docs, "lang", "doc_id"), "sample"),
        "configs": s.part_labels(spark, sf_dir),
    }
    for name, time in (("a", times["first"]), ("", times["last"])):
        publishing.publish_run(tables, report, root, name, F.to_timestamp_ntz(F.lit(str(time))))
    counts = [
        ledger.read_snapshots(spark, root, name)
        .groupBy("run_name", F.lit(name).alias("table"))
        .agg(F.count("*").alias("rows"))
        for name in tables
    ]
    runs = ledger.read_published_ledger(spark, root).select(
        "run_name", "created_at_utc", "test_accuracy_percent"
    )
    return runs.join(reduce(DataFrame.unionByName, counts), "run_name")


# --- streams -----------------------------------------------------------------------------------


@query
def stream_score(spark, sf_dir):
    feed = s.messages(s.table_stream(spark, sf_dir, "conversations"))
    out, state = fresh_path(spark, "answers"), fresh_path(spark, "state")
    vocab = s.part_labels(spark, sf_dir)
    scoring.stream_score(feed, "message", _score, vocab, out, state).awaitTermination()
    return scoring.read_stream_scores(spark, out)


@query
def stream_accuracy(spark, sf_dir):
    answers = _extracted(s.generations(s.table_stream(spark, sf_dir, "part")))
    vocab = s.part_labels(spark, sf_dir)

    def resolved(batch: DataFrame) -> DataFrame:
        return resolve.resolve_prediction(batch, "raw", vocab)

    out, state = fresh_path(spark, "marks"), fresh_path(spark, "state")
    scoring.stream_accuracy(answers, out, state, prepare=resolved).awaitTermination()
    return _rounded(scoring.read_stream_accuracy(spark, out), "accuracy")
