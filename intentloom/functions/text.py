"""Text columns: Column in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from intentloom.functions import fixed


def strip_message(text: Column) -> Column:
    """Remove white space (as Python defines it) from both ends; keep the case."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def normalize_text(text: Column) -> Column:
    """The training form of a message: stripped and lower-cased."""
    return F.lower(strip_message(text))


def extract_answer(decoded: Column) -> Column:
    """First line of what follows the last answer mark in generated text."""
    answer = strip_message(F.substring_index(decoded, fixed.ANSWER_MARK, -1))
    return strip_message(F.substring_index(answer, "\n", 1))


def fill_template(template: str, **columns: Column) -> Column:
    """A text template with columns in place of its named fields."""
    parts = []
    for text, field, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if field is not None:
            parts.append(columns[field])
    return F.concat(*parts)


def render_train_prompt(
    instruction: Column, message: Column, answer: Column, end_mark: str
) -> Column:
    """Full training prompt, answer and end-of-sequence mark included."""
    prompt = fill_template(
        fixed.PROMPT_TEMPLATE, instruction=instruction, input=message, output=answer
    )
    return F.concat(prompt, F.lit(end_mark))


def render_eval_prompt(instruction: Column, message: Column) -> Column:
    """The prompt a model completes: same template, empty answer, no end mark."""
    return fill_template(
        fixed.PROMPT_TEMPLATE, instruction=instruction, input=message, output=F.lit("")
    )


def extract_accuracy(content: Column) -> Column:
    """Accuracy figure, as text, of the first match in a report; null if none."""
    return F.nullif(F.regexp_extract(content, fixed.ACCURACY_PATTERN, 1), F.lit(""))


def run_name(name: Column, created_at: Column) -> Column:
    """The given name trimmed, or one made from a UTC TIMESTAMP_NTZ column."""
    given = F.nullif(strip_message(name), F.lit(""))
    return F.coalesce(
        given, F.date_format(created_at, "'run_'yyyyMMdd_HHmmss'_utc'")
    )


def utc_wall_clock(created_at: Column) -> Column:
    """A session-zone TIMESTAMP as the UTC TIMESTAMP_NTZ that `run_name` takes."""
    return F.convert_timezone(None, F.lit("UTC"), created_at)


def iso_utc(created_at: Column) -> Column:
    """A UTC TIMESTAMP_NTZ column as ISO text."""
    return F.date_format(created_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def percent_text(share: Column) -> Column:
    """A share as percent with two decimals, exact ties to the even digit."""
    return F.format_number(share * 100, 2)


def version_number(path: Column) -> Column:
    """The number in a checkpoint path, null when it has none."""
    digits = F.regexp_extract(path, fixed.VERSION_PATTERN, 1)
    return F.nullif(digits, F.lit("")).cast("bigint")


def is_message(text: Column) -> Column:
    """True for text to answer: not blank and not a control word."""
    bare = strip_message(text)
    return (bare != "") & ~F.lower(bare).isin(*fixed.CONTROL_WORDS)
