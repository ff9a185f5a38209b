"""DuckDB SQL that computes the registered queries independently of Spark."""

from __future__ import annotations

from string import Formatter

from intentloom.functions import fixed
from intentloom.plans.standins import ANSWER_HEAD, END_MARK


def _quoted(text: str) -> str:
    """A SQL string; line breaks as chr(10), so that any SQL client keeps them."""
    parts = ["'" + part.replace("'", "''") + "'" for part in text.split("\n")]
    return " || chr(10) || ".join(parts)


SPACES = " || ".join(f"chr({ord(c)})" for c in fixed.WHITESPACE)
MARK = _quoted(fixed.ANSWER_MARK)


def _strip(column: str) -> str:
    return f"trim({column}, {SPACES})"


def _answer(column: str) -> str:
    after = _strip(f"string_split({column}, {MARK})[-1]")
    return _strip(f"string_split({after}, chr(10))[1]")


def _filled(template: str, **fields: str) -> str:
    """SQL text of a template with SQL expressions in place of its named fields."""
    parts = []
    for text, field, _, _ in Formatter().parse(template):
        parts.append(_quoted(text))
        if field is not None:
            parts.append(fields[field])
    return " || ".join(parts)


def _prompt(instruction: str, message: str, answer: str = "''") -> str:
    return _filled(fixed.PROMPT_TEMPLATE, instruction=instruction, input=message, output=answer)


def _labels(name: str, source: str) -> str:
    """CTE (label, intent): distinct names numbered in name order."""
    return (
        f"{name} AS (SELECT row_number() OVER (ORDER BY intent) - 1 AS label, intent "
        f"FROM (SELECT DISTINCT {source}))"
    )


def _instruction(labels: str) -> str:
    listed = f"(SELECT string_agg(intent, ', ' ORDER BY label) FROM {labels})"
    return _filled(fixed.INSTRUCTION_TEMPLATE, label_list=listed)


SOURCE_LABELS = _labels("source_labels", "source AS intent FROM documents")
LANGUAGE_LABELS = _labels("language_labels", "lang AS intent FROM documents")
PART_LABELS = _labels("part_labels", "replace(p_name, ' ', '_') AS intent FROM part")

RECORDS = f"""{SOURCE_LABELS},
instruction AS (SELECT {_instruction("source_labels")} AS instruction),
records AS (
  SELECT d.doc_id, lower({_strip("d.text")}) AS text, v.label, d.source AS intent,
         (SELECT instruction FROM instruction) AS instruction,
         lower({_strip("d.text")}) AS input, d.source AS output
  FROM documents d JOIN source_labels v ON v.intent = d.source)"""

MESSAGES = """messages AS (
  SELECT conv_id, turn,
         CASE WHEN role = 'user' THEN text
              WHEN role = 'system' THEN ' ' || chr(9) || ' '
              WHEN length(text) > 1000 THEN ' QUIT' || chr(10)
              ELSE 'q ' || text END AS message
  FROM conversations)"""

GENERATIONS = f"""generations AS (
  SELECT p_partkey AS row_id, replace(p_brand, '#', '_') AS run,
         replace(p_name, ' ', '_') AS y_true,
         {_quoted(ANSWER_HEAD)} ||
         CASE p_partkey % 8
           WHEN 0 THEN replace(p_name, ' ', '_')
           WHEN 1 THEN upper(replace(p_name, ' ', '_'))
           WHEN 2 THEN '  ' || p_name || '  '
           WHEN 3 THEN substr(p_name, 1, length(p_name) - 2).replace(' ', '_')
           WHEN 4 THEN reverse(p_name)
           WHEN 5 THEN 'new_' || string_split(p_name, ' ')[-1]
           WHEN 6 THEN replace(p_name, ' ', '_') || chr(10) || 'extra line'
           ELSE '' END AS decoded
  FROM part)"""

FIRST_WORD = f"string_split(lower({_strip('message')}), ' ')[1]"
GATE = (
    f"{_strip('message')} <> '' AND lower({_strip('message')}) NOT IN "
    f"({', '.join(_quoted(w) for w in fixed.CONTROL_WORDS)})"
)
STORED_ANSWERS = f"""{GENERATIONS},
raws AS (SELECT row_id, run, y_true, {_answer("decoded")} AS raw FROM generations)"""
FEED_ANSWERS = f"""{MESSAGES},
scored_feed AS (
  SELECT conv_id, turn, message,
         {MARK} || chr(10) || {FIRST_WORD} || chr(10) || 'end' AS decoded
  FROM messages WHERE {GATE}),
raws AS (SELECT conv_id, turn, message, decoded, {_answer("decoded")} AS raw FROM scored_feed)"""


def _ratios(raws: str) -> str:
    """CTEs folded (vocabulary) and ranked (closest labels of each distinct raw).

    Longest common blocks are found again left and right of each block.
    """
    return f"""{PART_LABELS},
{raws},
keys AS (SELECT DISTINCT lower(raw) AS key FROM raws),
folded AS (SELECT lower(intent) AS folded, arg_min(intent, label) AS intent
           FROM part_labels GROUP BY 1),
pairs AS (
  SELECT folded, key, length(folded) AS la, length(key) AS lb
  FROM folded, keys
  WHERE key <> '' AND 2.0 * least(length(folded), length(key))
        >= {fixed.FUZZY_CUTOFF} * (length(folded) + length(key))),
common AS MATERIALIZED (
  SELECT folded, key, i, j, k
  FROM pairs, range(1, la + 1) a(i), range(1, lb + 1) b(j),
       range(1, least(la - i, lb - j) + 2) c(k)
  WHERE substr(folded, i, k) = substr(key, j, k)),
blocks AS (
  SELECT folded, key, 1::BIGINT AS alo, la + 1 AS ahi, 1::BIGINT AS blo, lb + 1 AS bhi,
         0::BIGINT AS k
  FROM pairs
  UNION ALL
  SELECT folded, key, side.alo, side.ahi, side.blo, side.bhi, side.k
  FROM (
    SELECT folded, key, unnest([
             {{'alo': alo, 'ahi': i, 'blo': blo, 'bhi': j, 'k': k}},
             {{'alo': i + k, 'ahi': ahi, 'blo': j + k, 'bhi': bhi, 'k': 0}}]) AS side
    FROM (
      SELECT s.folded, s.key, s.alo, s.ahi, s.blo, s.bhi, m.i, m.j, m.k
      FROM blocks s JOIN common m
        ON m.folded = s.folded AND m.key = s.key AND m.i >= s.alo AND m.i + m.k <= s.ahi
       AND m.j >= s.blo AND m.j + m.k <= s.bhi
      QUALIFY row_number() OVER (
        PARTITION BY s.folded, s.key, s.alo, s.ahi, s.blo, s.bhi
        ORDER BY m.k DESC, m.i, m.j) = 1))),
scored AS (
  SELECT folded, key,
         CAST(2 * sum(k) AS DOUBLE) / (length(folded) + length(key)) AS ratio
  FROM blocks GROUP BY folded, key),
ranked AS (
  SELECT key, f.intent AS label, ratio,
         row_number() OVER (PARTITION BY key ORDER BY ratio DESC, s.folded DESC) AS rank
  FROM scored s JOIN folded f USING (folded) WHERE ratio >= {fixed.FUZZY_CUTOFF})"""


def _resolved(raws: str) -> str:
    return f"""{_ratios(raws)},
resolved AS (
  SELECT r.*, coalesce(f.intent, n.label, r.raw) AS y_pred,
         CASE WHEN f.intent IS NOT NULL THEN 'exact'
              WHEN n.label IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS match_kind
  FROM raws r LEFT JOIN folded f ON f.folded = lower(r.raw)
  LEFT JOIN ranked n ON n.key = lower(r.raw) AND n.rank = 1)"""


#: A missing prediction is a miss.
HIT = "CAST(coalesce(y_true = y_pred, false) AS INTEGER)"
RATIOS = _ratios(STORED_ANSWERS)
RESOLVED = _resolved(STORED_ANSWERS)


def _report(source: str, prediction: str = "y_pred") -> str:
    """CTEs class_scores and report from a CTE with y_true and y_pred."""
    return f"""confusion AS (
  SELECT y_true, {prediction} AS y_pred, count(*) AS rows FROM {source} GROUP BY ALL),
names AS (SELECT y_true AS label FROM confusion UNION SELECT y_pred FROM confusion),
sides AS (
  SELECT label,
         coalesce((SELECT sum(rows) FROM confusion WHERE y_true = label), 0) AS support,
         coalesce((SELECT sum(rows) FROM confusion WHERE y_pred = label), 0) AS predicted,
         coalesce((SELECT sum(rows) FROM confusion
                   WHERE y_true = label AND y_pred = label), 0) AS hits
  FROM names),
class_scores AS (
  SELECT label,
         CASE WHEN predicted = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
         CAST(2 * hits AS DOUBLE) / (support + predicted) AS f1,
         CAST(support AS BIGINT) AS support, hits
  FROM sides),
averages AS (
  SELECT 1 AS section_no, 'accuracy' AS section, NULL AS precision, NULL AS recall,
         CAST(sum(hits) AS DOUBLE) / sum(support) AS f1,
         CAST(sum(support) AS BIGINT) AS support FROM class_scores
  UNION ALL
  SELECT 2, 'macro avg', avg(precision), avg(recall), avg(f1),
         CAST(sum(support) AS BIGINT) FROM class_scores
  UNION ALL
  SELECT 3, 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
         CAST(sum(support) AS BIGINT) FROM class_scores),
report AS (
  SELECT 0 AS section_no, 'class' AS section, label, precision, recall, f1, support
  FROM class_scores
  UNION ALL BY NAME
  SELECT section_no, section, NULL AS label, precision, recall, f1, support FROM averages)"""


FULL_REPORT = """SELECT CAST(section_no AS INTEGER) AS section_no, section, label,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM report ORDER BY section_no, label"""

RUNS = """runs AS (
  SELECT 'run_' || user_id AS run_name,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS created_at_utc,
         'outputs/run_' || user_id AS outputs, 'sample_data' AS sample_data,
         'configs' AS configs,
         CASE WHEN event_type <> 'error' THEN CAST(event_id % 100 AS VARCHAR) END
           AS test_accuracy_percent
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)"""

def _swapped_rounds() -> str:
    """The numbers of `documents` in each epoch, after every round of the shuffle."""
    rows = f"""SELECT CAST(epoch AS INTEGER) AS epoch, id, n, x FROM (
  SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS x, count(*) OVER () AS n
  FROM documents), range({fixed.EPOCHS}) e(epoch)"""
    for turn in range(fixed.SWAP_ROUNDS):
        key = f"'{fixed.SEED}:' || epoch || ':{turn}'"
        rows = f"""SELECT epoch, id, n,
  CASE WHEN substr(md5({key} || ':' || greatest(x, y)), 1, 1) >= '8' THEN y ELSE x END AS x
FROM (SELECT *, (CAST('0x' || substr(md5({key}), 1, 12) AS BIGINT) % n - x + n) % n AS y
FROM ({rows}))"""
    return rows




def _word_model(corpus: str) -> str:
    """CTEs words and classes of a corpus SELECT of (label, text)."""
    return f"""corpus_texts AS ({corpus}),
tokens AS (
  SELECT label, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word
  FROM corpus_texts),
words AS (SELECT label, word, count(*) AS n FROM tokens WHERE word <> '' GROUP BY ALL),
classes AS (
  SELECT label, coalesce(tokens, 0) AS tokens, ln(docs / (SELECT count(*) FROM corpus_texts)) AS prior,
         ln(coalesce(tokens, 0) + (SELECT count(DISTINCT word) FROM words)) AS norm
  FROM (SELECT label, count(*) AS docs FROM corpus_texts GROUP BY 1)
  LEFT JOIN (SELECT label, sum(n) AS tokens FROM words GROUP BY 1) USING (label))"""


WORD_MODEL = _word_model("SELECT lang AS label, text FROM documents")
SPEAKERS = """SELECT concat(conv_id, '/', role) AS label, text FROM conversations
  WHERE conv_id IS NOT NULL AND role IS NOT NULL AND text IS NOT NULL"""
ITEM_FEED = "SELECT item_id AS id, text FROM benchmark"
PAGE_FEED = "SELECT page_id AS id, html AS text FROM pages"


def _word_scores(feed: str, model: str = WORD_MODEL) -> str:
    """CTE predicted (id, label) for a feed SELECT of (id, text)."""
    return f"""{model},
feed AS ({feed}),
known AS (
  SELECT id, word, count(*) AS tf
  FROM (SELECT id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM feed)
  WHERE word IN (SELECT word FROM words) GROUP BY ALL),
likelihood AS (
  SELECT k.id, c.label, sum(k.tf * (ln(coalesce(w.n, 0) + 1) - c.norm)) AS loglik
  FROM known k CROSS JOIN classes c
  LEFT JOIN words w ON w.word = k.word AND w.label = c.label GROUP BY ALL),
predicted AS (
  SELECT f.id, c.label
  FROM feed f CROSS JOIN classes c
  LEFT JOIN likelihood l ON l.id = f.id AND l.label = c.label
  QUALIFY row_number() OVER (
    PARTITION BY f.id
    ORDER BY round(coalesce(l.loglik, 0) + c.prior, 6) DESC, c.label) = 1)"""


def _corpus(columns: str = "id, text, intent, split") -> str:
    return f"""corpus AS (
  SELECT {columns} FROM (
    SELECT doc_id AS id, text, lang AS intent, 'train' AS split FROM documents
    UNION ALL
    SELECT page_id, html, regexp_extract(html, '<html lang="([a-z]+)"', 1), 'test' FROM pages))"""


def _shuffled(prefix: str, column: str) -> str:
    return f"md5({prefix} || CAST({column} AS VARCHAR))"


def _running(source: str) -> str:
    return f"""SELECT row_id + 1 AS rows, round(accuracy, 6) AS accuracy FROM (
  SELECT row_id, avg({HIT}) OVER (ORDER BY row_id) AS accuracy
  FROM {source}) WHERE (row_id + 1) % {fixed.ACCURACY_EVERY} = 0"""


def _percent(share: str) -> str:
    return f"printf('%.2f', 100 * {share})"


def statements() -> dict[str, str]:
    pattern = _quoted(fixed.ACCURACY_PATTERN)
    record_columns = "text, label, intent, instruction, input, output"
    manifest = """SELECT '{"run_name":"' || run_name || '","created_at_utc":"' || created_at_utc ||
  '","source_paths":{"outputs":"' || outputs || '","sample_data":"' || sample_data ||
  '","configs":"' || configs || '"},"test_accuracy_percent":' ||
  coalesce('"' || test_accuracy_percent || '"', 'null') || '}' AS manifest FROM runs"""
    train_prompt = f"{_prompt('instruction', 'input', 'output')} || {_quoted(END_MARK)}"
    given = "CASE WHEN event_type = 'view' THEN '  run ' || user_id || chr(9) ELSE '  ' END"
    sample_order = _shuffled(f"'{fixed.SEED}:'", "id")
    answered = f"""WITH RECURSIVE {_resolved(FEED_ANSWERS)}
SELECT conv_id, turn, message, decoded, raw, y_pred, match_kind FROM resolved"""
    update = fixed.BATCH_ROWS * fixed.ACCUMULATION
    return {
        "scan_corpus": """SELECT text, 'train' AS split FROM documents
UNION ALL SELECT text, 'test' FROM conversations
UNION ALL SELECT text, 'validation' FROM benchmark""",
        "label_dim": f"WITH {SOURCE_LABELS} SELECT label, intent FROM source_labels",
        "label_names_from_files": f"WITH {SOURCE_LABELS} SELECT label, intent FROM source_labels",
        "load_label_vocab": f"WITH {SOURCE_LABELS} SELECT label, intent FROM source_labels",
        "vocab_from_data": f"WITH {PART_LABELS} SELECT label, intent FROM part_labels",
        "read_sft_csv": f"WITH {RECORDS} SELECT {record_columns} FROM records",
        "write_sft_dataset": f"""WITH {RECORDS} SELECT {record_columns},
  CASE WHEN label < 4 THEN 'test' ELSE 'train' END AS split FROM records""",
        "write_label_vocab": f"WITH {PART_LABELS} SELECT intent FROM part_labels",
        "write_eval_report": f"""WITH RECURSIVE {RESOLVED}, {_report("resolved")},
width AS (
  SELECT greatest(12, max(length(coalesce(label, section)))) AS w FROM report),
lines AS (
  SELECT lpad(coalesce(label, section), CAST(w AS INTEGER), ' ') || ' ' ||
    lpad(coalesce(printf('%.2f', precision), ''), 10, ' ') ||
    lpad(coalesce(printf('%.2f', recall), ''), 10, ' ') ||
    lpad(printf('%.2f', f1), 10, ' ') || lpad(support::VARCHAR, 10, ' ') AS line
  FROM report, width
  UNION ALL
  SELECT repeat(' ', CAST(w AS INTEGER) + 1) || lpad('precision', 10, ' ') ||
    lpad('recall', 10, ' ') || lpad('f1-score', 10, ' ') || lpad('support', 10, ' ') FROM width
  UNION ALL
  SELECT 'Test Accuracy: ' || {_percent("f1")} || '%' FROM report WHERE section = 'accuracy'
  UNION ALL SELECT unnest([{_quoted(fixed.REPORT_HEADING)}, '', '', '', '']))
SELECT *, NULL::VARCHAR AS line FROM ({FULL_REPORT})
UNION ALL BY NAME SELECT line FROM lines""",
        "read_eval_reports": f"""WITH RECURSIVE {RESOLVED}
SELECT run, {_percent("share")} AS accuracy,
  'Test Accuracy: ' || {_percent("share")} || '%' || chr(10) || chr(10) || 'end' || chr(10)
    AS content
FROM (SELECT run, avg({HIT}) AS share FROM resolved GROUP BY run)""",
        "write_run_manifest": f"WITH {RUNS} {manifest}",
        "read_run_ledger": f"""WITH {RUNS} SELECT run_name, created_at_utc, outputs, sample_data,
  configs, test_accuracy_percent, CAST(test_accuracy_percent AS DOUBLE) AS test_accuracy
FROM runs""",
        "snapshot_run": f"""WITH {PART_LABELS}
SELECT 'run a' AS run_name, 'sample_data' AS "table", doc_id AS key,
  lang || '/' || source || '/' || n_chars AS value FROM documents
UNION ALL SELECT 'run a', 'outputs', p_partkey, p_name || '/' || p_brand FROM part
UNION ALL SELECT 'run a', 'configs', label, intent FROM part_labels""",
        "normalize_text": f"SELECT doc_id, lower({_strip('text')}) AS text FROM documents",
        "strip_message": f"""WITH {MESSAGES}
SELECT conv_id, turn, {_strip('message')} AS message FROM messages""",
        "sft_columns": f"WITH {RECORDS} SELECT doc_id, {record_columns} FROM records",
        "project_sft": f"WITH {RECORDS} SELECT instruction, input, output FROM records",
        "render_train_prompt": f"""WITH {RECORDS}
SELECT doc_id, {train_prompt} AS prompt FROM records""",
        "render_eval_prompt": f"""WITH {SOURCE_LABELS}, {MESSAGES}
SELECT conv_id, turn, {_prompt(_instruction("source_labels"), _strip("message"))} AS prompt
FROM messages""",
        "fallback_instruction": f"""WITH {MESSAGES}
SELECT conv_id, turn,
  {_prompt(_quoted(fixed.INSTRUCTION_WITHOUT_LABELS), _strip("message"))} AS prompt
FROM messages""",
        "extract_accuracy": f"""WITH reports AS (
  SELECT doc_id,
    CASE lang WHEN 'es' THEN text
      WHEN 'de' THEN text || chr(10) || 'Test Accuracy:  ' || n_chars % 100 || '%'
      ELSE 'Test Accuracy: ' || n_chars % 100 || '.' || doc_id % 10 || '%' || chr(10) || chr(10)
           || text || chr(10) || 'Test Accuracy:  ' || n_chars % 100 || '%' END AS content
  FROM documents)
SELECT doc_id, nullif(regexp_extract(content, {pattern}, 1), '') AS accuracy FROM reports""",
        "extract_answer": f"""WITH {GENERATIONS}
SELECT row_id, {_answer("decoded")} AS raw FROM generations""",
        "run_name": f"""SELECT event_id, coalesce(nullif({_strip(given)}, ''),
  strftime(ts, 'run_%Y%m%d_%H%M%S_utc')) AS run_name FROM events""",
        "preview_rows": f"""WITH {RECORDS}
SELECT doc_id, substr(text, 1, 300) || '...' AS text, intent,
  substr(instruction, 1, 80) || '...' AS instruction
FROM records ORDER BY doc_id LIMIT 5""",
        "message_gate": f"WITH {MESSAGES} SELECT conv_id, turn, message FROM messages WHERE {GATE}",
        "decode_label": f"""WITH {SOURCE_LABELS}
SELECT p_partkey, p_size AS label, v.intent
FROM part LEFT JOIN source_labels v ON v.label = p_size""",
        "undecodable_labels": f"""WITH {SOURCE_LABELS}
SELECT p_partkey, p_size AS label FROM part
WHERE p_size NOT IN (SELECT label FROM source_labels)""",
        "exact_match_label": f"""WITH RECURSIVE {RATIOS}
SELECT DISTINCT raw, f.intent AS label FROM raws JOIN folded f ON f.folded = lower(raw)""",
        "fuzzy_match_label": f"""WITH RECURSIVE {RATIOS}
SELECT DISTINCT raw, label, round(ratio, 6) AS ratio
FROM raws JOIN ranked ON key = lower(raw) WHERE rank = 1""",
        "best_label_topk": f"""WITH RECURSIVE {RATIOS}
SELECT DISTINCT raw, CAST(rank AS INTEGER) AS rank, label, round(ratio, 6) AS ratio
FROM raws JOIN ranked ON key = lower(raw) WHERE rank <= 3""",
        "resolve_prediction": f"""WITH RECURSIVE {RESOLVED}
SELECT row_id, y_true, raw, y_pred, match_kind FROM resolved""",
        "invalid_predictions": f"""WITH RECURSIVE {RESOLVED}
SELECT y_pred, count(*) AS rows FROM resolved
WHERE y_pred NOT IN (SELECT intent FROM part_labels) GROUP BY y_pred""",
        "unscored_rows": """SELECT doc_id, text FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "corpus_profile": f"""WITH {_corpus()},
sampled AS (
  SELECT * FROM corpus
  QUALIFY row_number() OVER (PARTITION BY split, intent ORDER BY {sample_order}, id) <= 20)
SELECT split, CAST(count(*) AS BIGINT) AS rows, count(DISTINCT intent) AS classes, 'full' AS stage
FROM corpus GROUP BY split
UNION ALL
SELECT split, CAST(count(*) AS BIGINT), count(DISTINCT intent), 'sampled'
FROM sampled GROUP BY split""",
        "clean_corpus": f"""WITH {MESSAGES}, raw AS (
  SELECT doc_id AS id, text, lang AS intent FROM documents
  UNION ALL
  SELECT -1 - conv_id * 1000 - turn, message, CASE WHEN turn % 4 <> 3 THEN 'feed' END
  FROM messages)
SELECT min(id) AS id, text, intent FROM raw
WHERE intent IS NOT NULL AND {_strip("text")} <> '' GROUP BY text, intent""",
        "validate_sft": f"""WITH {SOURCE_LABELS}, counts AS (
  SELECT source AS intent, count(*) AS rows,
    count(*) FILTER (WHERE text <> lower({_strip("text")})) AS not_normalized
  FROM documents GROUP BY source)
SELECT 'not_normalized' AS rule, CAST(sum(not_normalized) AS BIGINT) AS violations FROM counts
UNION ALL SELECT 'unknown_label', CAST(sum(rows) AS BIGINT) FROM counts
WHERE intent NOT IN (SELECT intent FROM source_labels WHERE label % 3 <> 0)
UNION ALL SELECT 'over_cap', CAST(sum(greatest(rows - 20, 0)) AS BIGINT) FROM counts""",
        "split_overlap": f"""SELECT lower({_strip("text")}) AS text,
  count(*) FILTER (WHERE doc_id % 5 <> 0) AS train_rows,
  count(*) FILTER (WHERE doc_id % 5 = 0) AS test_rows
FROM documents GROUP BY 1 HAVING train_rows > 0 AND test_rows > 0""",
        "class_balance": f"""WITH {_corpus()}, counts AS (
  SELECT split, intent AS label, count(*) AS rows FROM corpus GROUP BY ALL)
SELECT split, label, rows, min(rows) OVER (PARTITION BY split) AS smallest,
  max(rows) OVER (PARTITION BY split) AS largest,
  round(max(rows) OVER (PARTITION BY split) / min(rows) OVER (PARTITION BY split), 6) AS ratio
FROM counts""",
        "compare_runs": f"""WITH RECURSIVE {RESOLVED},
plain AS (WITH {_report("resolved", "raw")} SELECT * FROM report),
mapped AS (WITH {_report("resolved")} SELECT * FROM report)
SELECT CAST(coalesce(a.section_no, b.section_no) AS INTEGER) AS section_no,
  coalesce(a.section, b.section) AS section, coalesce(a.label, b.label) AS label,
  round(a.f1, 6) AS first_f1, round(b.f1, 6) AS second_f1, round(b.f1 - a.f1, 6) AS f1_change,
  a.support AS first_support, b.support AS second_support
FROM plain a FULL JOIN mapped b
  ON a.section = b.section AND a.label IS NOT DISTINCT FROM b.label""",
        "stratified_split": f"""SELECT doc_id AS id, lang AS label,
  CASE WHEN row_number() OVER (PARTITION BY lang
      ORDER BY {_shuffled(f"'{fixed.SEED}:'", "doc_id")}, doc_id)
    <= floor(0.1::DOUBLE * count(*) OVER (PARTITION BY lang)) THEN 'validation'
    ELSE 'train' END AS split
FROM documents""",
        "build_instruction": f"""WITH {PART_LABELS}
SELECT {_instruction("part_labels")} AS instruction""",
        "accuracy": f"""WITH RECURSIVE {RESOLVED}
SELECT round(avg({HIT}), 6) AS accuracy FROM resolved""",
        "confusion_counts": f"""WITH RECURSIVE {RESOLVED}
SELECT y_true, y_pred, count(*) AS rows FROM resolved GROUP BY ALL""",
        "class_report": f"""WITH RECURSIVE {RESOLVED}, {_report("resolved")}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM class_scores""",
        "report_averages": f"""WITH RECURSIVE {RESOLVED}, {_report("resolved")}
SELECT CAST(section_no AS INTEGER) AS section_no, section, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM averages""",
        "full_report": f"WITH RECURSIVE {RESOLVED}, {_report('resolved')} {FULL_REPORT}",
        "prompt_budget": f"""WITH {RECORDS}, lengths AS (
  SELECT len(regexp_split_to_array({train_prompt}, '\\s+')) AS words FROM records)
SELECT count(*) AS prompts, max(words) AS max_words,
  round(quantile_cont(words, 0.5), 6) AS p50, round(quantile_cont(words, 0.9), 6) AS p90,
  round(quantile_cont(words, 0.99), 6) AS p99,
  count(*) FILTER (WHERE words > {fixed.PROMPT_LIMIT}) AS over_limit FROM lengths""",
        "sample_capped_per_class": f"""SELECT doc_id, text, lang FROM documents
QUALIFY row_number() OVER (
  PARTITION BY lang ORDER BY {_shuffled(f"'{fixed.SEED}:'", "doc_id")}, doc_id)
  <= {fixed.TRAIN_ROWS_PER_CLASS}""",
        "running_accuracy": f"WITH RECURSIVE {RESOLVED} {_running('resolved')}",
        "training_batches": f"""WITH placed AS (
  SELECT CAST(epoch AS INTEGER) AS epoch, doc_id AS id,
    row_number() OVER (PARTITION BY epoch
      ORDER BY {_shuffled(f"'{fixed.SEED}:' || epoch || ':'", "doc_id")}, doc_id) - 1 AS pos
  FROM documents, range({fixed.EPOCHS}) e(epoch))
SELECT epoch, pos, pos // {fixed.BATCH_ROWS} AS micro_batch, pos // {update} AS step, id
FROM placed""",
        "permuted_batches": f"""SELECT epoch, x AS pos, x // {fixed.BATCH_ROWS} AS micro_batch,
  x // {update} AS step, id
FROM ({_swapped_rounds()})""",
        "latest_run": f"""WITH {RUNS}
SELECT run_name, created_at_utc, test_accuracy_percent FROM runs
ORDER BY created_at_utc DESC, run_name DESC LIMIT 1""",
        "latest_version": """SELECT user_id AS run, max(event_id) AS version
FROM events WHERE event_type <> 'error' GROUP BY user_id""",
        "report_label_set": f"""WITH RECURSIVE {RESOLVED}
SELECT y_true AS label FROM resolved UNION SELECT y_pred FROM resolved""",
        "union_splits": f"""WITH {_corpus()}
SELECT id, lower({_strip("text")}) AS text, intent, split FROM corpus""",
        "prepare_records": f"""WITH {LANGUAGE_LABELS}, {_corpus()}, drawn AS (
  SELECT * FROM corpus
  QUALIFY row_number() OVER (PARTITION BY split, intent ORDER BY {sample_order}, id)
    <= CASE split WHEN 'train' THEN {fixed.TRAIN_ROWS_PER_CLASS}
                  ELSE {fixed.TEST_ROWS_PER_CLASS} END)
SELECT id, lower({_strip("text")}) AS text, label, split, intent,
  {_instruction("language_labels")} AS instruction,
  lower({_strip("text")}) AS input, intent AS output
FROM drawn JOIN language_labels USING (intent)""",
        "train_classifier_nb": f"""WITH {WORD_MODEL}
SELECT label, word, n, round(ln(n + 1) - norm, 6) AS log_likelihood
FROM words JOIN classes USING (label)""",
        "resume_classifier_nb": f"""WITH {WORD_MODEL}
SELECT label, word, n, round(ln(n + 1) - norm, 6) AS log_likelihood
FROM words JOIN classes USING (label)""",
        "score_classifier_nb": f"""WITH {_word_scores(PAGE_FEED)}
SELECT id, label FROM predicted""",
        "score_many_classes_nb": f"""WITH {_word_scores(ITEM_FEED, _word_model(SPEAKERS))}
SELECT id, label FROM predicted""",
        "save_load_model": f"""WITH {_word_scores(
            "SELECT conv_id || '/' || turn AS id, text FROM conversations")}
SELECT id, label FROM predicted""",
        "batch_score_udf": f"""WITH {MESSAGES}
SELECT conv_id, turn, {MARK} || chr(10) || {FIRST_WORD} || chr(10) || 'end' AS decoded
FROM messages""",
        "score_and_evaluate": f"""WITH
{_word_scores(PAGE_FEED)},
resolved AS (
  SELECT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS y_true, label AS y_pred
  FROM pages JOIN predicted ON id = page_id),
{_report("resolved")} {FULL_REPORT}""",
        "evaluate_answers": f"WITH RECURSIVE {RESOLVED}, {_report('resolved')} {FULL_REPORT}",
        "eval_pipeline": f"WITH RECURSIVE {RESOLVED}, {_report('resolved')} {FULL_REPORT}",
        "answer_messages": answered,
        "stream_score": answered,
        "publish_run": f"""WITH RECURSIVE {RESOLVED},
published AS (
  SELECT 'outputs' AS "table",
    (SELECT count(*) FROM (SELECT y_true FROM resolved UNION SELECT y_pred FROM resolved)) + 3
      AS rows
  UNION ALL SELECT 'configs', (SELECT count(*) FROM part_labels)
  UNION ALL SELECT 'sample_data', (SELECT CAST(sum(least(n, {fixed.TRAIN_ROWS_PER_CLASS})) AS BIGINT)
    FROM (SELECT count(*) AS n FROM documents GROUP BY lang))),
runs AS (
  SELECT 'a' AS run_name, min(ts) AS created FROM events
  UNION ALL SELECT strftime(max(ts), 'run_%Y%m%d_%H%M%S_utc'), max(ts) FROM events)
SELECT run_name, strftime(created, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS created_at_utc,
  (SELECT {_percent(f"avg({HIT})")} FROM resolved)
    AS test_accuracy_percent, "table", rows
FROM runs, published""",
        "stream_accuracy": f"WITH RECURSIVE {RESOLVED} {_running('resolved')}",
    }
