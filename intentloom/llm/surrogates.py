"""Personal data replaced by surrogates: keyed, of the same kind, format, script and gender.

A value's surrogate follows from the key, the kind and the value alone, so one
value has one surrogate in all documents, however it is written there, and no
table has to be joined. Only where two values would get the same surrogate, or a
surrogate is a real value of the corpus, has one of them to be drawn again; those
exceptions are found over the distinct values, in rounds of grouped minima.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.shared import release, slices, unused
from intentloom.operators.scale import SMALL_ROWS, is_small
from intentloom.session import settle

# Titles before names, by the gender they tell.
TITLES = {
    "m": "Mr Herr Herrn Monsieur Señor Sr Don Господин",
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Srta Doña Госпожа",
}
GENDER = {
    written: gender
    for gender, titles in TITLES.items()
    for title in titles.split()
    for written in (title, title.upper())
}
# Sounds and endings of invented names, by script and gender.
NAMES = {
    "LATIN": ("b d f g k l m n r s t v".split(), "a e i o u".split(), {"m": "n r s t o".split(), "f": "a ia ina ela ette".split()}),
    "CYRILLIC": ("б в г д к л м н п р с т".split(), "а е и о у".split(), {"m": "н р й в".split(), "f": "а ия ина ла".split()}),
    "GREEK": ("β γ δ κ λ μ ν π ρ σ τ φ".split(), "α ε η ι ο".split(), {"m": "ος ης ας".split(), "f": "α η ια ινα".split()}),
}

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)?"
_KEY = r"(?i:token|secret|password|passwd|api[_-]?key)\s{0,3}[=:]\s{0,3}"
#: Each kind's pattern; repeats are bounded, or end where no other match can have begun, so
#: long texts cost no more per character. Secrets without quotes have a digit near their start.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    "secret": rf"{_KEY}(?:[\"']([^\s\"']{{8,}})[\"']"
    rf"|(?=[^\s\"']{{0,200}}\d)([^\s\"'<>,;]{{7,}}[^\s\"'<>,;.:!?)\]}}]))",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
    r"|(?<![\w.,+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w|[.,-]\d)"
    r"|(?<![\w.,+-])0\d{1,4}[ /-]{1,3}\d{3,8}(?:[ -]\d{2,5}){0,3}(?!\w|[.,-]\d)",
    "card": r"(?<![\w.])(?:\d{4}[ -]?){3}\d{4}(?!\w)",
    "person": rf"(?<!\w)({'|'.join(GENDER)})\.?[ \t]({_NAME}(?:[ \t]{_NAME})?)",
}
NAME_KINDS = ("surname", "given_m", "given_f")
_WORD, _PART = re.compile(_NAME), re.compile(r"[^\W\d_]+")
_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_HEX = re.compile("[0-9a-f]+|[0-9A-F]+")
#: Digits of a national phone number with a leading 0.
NATIONAL = range(9, 14)
_MAYBE = re.compile(rf"[0-9@\"']|(?<!\w)(?:{'|'.join(GENDER)})\b")


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what is found, in order; where two overlap the earlier,
    or else the kind that stands first in PATTERNS, has it."""
    if not _MAYBE.search(text):
        return []
    found = []
    for rank, (kind, pattern) in enumerate(_COMPILED.items()):
        for match in pattern.finditer(text):
            if kind == "person":
                found += _names(match, rank)
            else:
                group = match.lastindex or 0
                if kind == "secret" and _masked(match[group]):
                    continue
                if kind == "card" and not _checks(entity_key(kind, match[0])):
                    continue
                if kind == "phone" and match[0][0] == "0" and not _phone_like(match[0]):
                    continue
                found.append((match.start(group), rank, match.end(group), kind))
    found += _later_mentions(text, [f for f in found if f[3] in NAME_KINDS])
    kept: list[tuple[int, int, str]] = []
    for start, _, end, kind in sorted(found):
        if not kept or start >= kept[-1][1]:
            kept.append((start, end, kind))
    return kept


def _phone_like(written: str) -> bool:
    return sum(c.isdigit() for c in written) in NATIONAL


def _later_mentions(text: str, titled: list) -> list[tuple[int, int, int, str]]:
    """Other places of the names that follow a title somewhere in the same text.

    They are written as there, capitalized or in capitals. A word that is both is a
    given name before a surname found there, and else a surname.
    """
    if not titled:
        return []
    kinds: dict[str, set[str]] = {}
    forms = set()
    for start, _, end, kind in titled:
        word = text[start:end]
        kinds.setdefault(word.casefold(), set()).add(kind)
        forms |= {word, word.capitalize(), word.upper()}
    starts = {start for start, *_ in titled}
    words = []
    for m in _WORD.finditer(text):
        if m[0] in forms:
            words.append(m)
        elif not m[0].isalpha():  # a part before or behind a hyphen or an apostrophe
            words += [x for x in _PART.finditer(text, *m.span()) if x[0] in forms]
    found = []
    for m in words:
        if m.start() in starts:
            continue
        known = kinds.get(m[0].casefold(), set())
        given = sorted(known - {"surname"})
        follows = _WORD.match(text, m.end() + 1) if text[m.end() : m.end() + 1] in (" ", "\t") else None
        before_surname = follows and "surname" in kinds.get(follows[0].casefold(), ())
        if given and (before_surname or "surname" not in known):
            found.append((m.start(), len(PATTERNS), m.end(), given[0]))
        elif known:
            found.append((m.start(), len(PATTERNS), m.end(), "surname"))
    return found


def _masked(value: str) -> bool:
    """Whether a sign repeated stands where a secret was."""
    return len(set(value)) == 1 and not value[0].isalnum()


def _names(match: re.Match, rank: int) -> list[tuple[int, int, int, str]]:
    """The words of a name: a given name of the title's gender, then the surname."""
    gender = GENDER[match[1]]
    words = [
        (m.start() + match.start(2), m.end() + match.start(2))
        for m in re.finditer(r"\S+", match[2])
        if m[0][0].isupper()
    ]
    if not words or words[0][0] != match.start(2):
        return []
    kinds = ["surname"] if len(words) == 1 else [f"given_{gender}", "surname"]
    return [(a, rank, b, kind) for (a, b), kind in zip(words, kinds)]


def entity_key(kind: str, written: str) -> str:
    """What makes two ways of writing the same value: digits of numbers, folded case."""
    if kind in ("phone", "card"):
        return "".join(c for c in written if c.isdigit())
    if kind == "secret":
        return written
    folded = written.casefold()
    return folded.replace(" ", "") if kind == "iban" else folded


def _numbers(secret: str, kind: str, key: str, attempt: int) -> Iterator[int]:
    """An endless keyed sequence of numbers below 2^32."""
    own, block = secret.encode(), 0
    if len(own) > 64:  # longer keys don't fit the hash and are hashed themselves
        own = hashlib.blake2b(own).digest()
    while True:
        seed = f"{kind}\0{key}\0{attempt}\0{block}".encode()
        digest = hashlib.blake2b(seed, key=own).digest()
        for k in range(0, len(digest), 4):
            yield int.from_bytes(digest[k : k + 4], "big")
        block += 1


#: Attempts from which signs are drawn, domains are drawn again, and surrogates get longer.
SIGNS_FROM, DOMAINS_FROM, LONGER_FROM = 2, 4, 8
SIGNS = "!#$%&*+-./:;=?@^_~"


def surrogate_key(secret: str, kind: str, key: str, attempt: int) -> str:
    """The key of the surrogate: as long as the value's, names apart.

    What can be drawn grows with the attempt, and in the end with its length, so
    every value gets one, whatever it consists of and however many are taken.
    """
    draw = _numbers(secret, kind, key, attempt)
    longer = max(0, attempt + 1 - LONGER_FROM)
    if kind == "ip":
        return ".".join(str(1 + next(draw) % 254) for _ in range(4 + longer))
    if kind in ("surname", "given_m", "given_f"):
        return _invented_name(kind, key + 2 * longer * "x" if longer else key, draw)
    if kind == "email":
        local, _, domain = key.rpartition("@")
        hosts, _, top = domain.rpartition(".")
        # one domain has one surrogate, whoever writes from it, unless its addresses run out
        of_host = _numbers(secret, "domain", hosts, max(0, attempt + 1 - DOMAINS_FROM))
        return f"{_like(local + longer * 'a', draw)}@{_like(hosts, of_host)}.{top}"
    if kind == "iban":
        return key[:2] + _like(key[2:] + longer * "0", draw)
    if kind in ("card", "phone"):
        key += longer * "0"
    if kind == "card" and _checks(key):
        new = _like(key[:-1], draw)
        return next(new + d for d in "0123456789" if _checks(new + d))
    if kind == "secret" and _HEX.fullmatch(key):
        return "".join(_hex_digit(c, draw) for c in key + longer * "0")
    if kind == "secret":
        key += longer * "a"
        if attempt >= SIGNS_FROM:
            parts = (_drawn(c, draw) if c.isalnum() else SIGNS[next(draw) % len(SIGNS)] for c in key)
            return "".join(parts)
    return _like(key, draw)


def _hex_digit(c: str, draw: Iterator[int]) -> str:
    """A digit for a digit, else a letter; so the text stays hexadecimal."""
    if c.isdigit():
        return str(next(draw) % 10)
    return ("abcdef" if c.islower() else "ABCDEF")[next(draw) % 6]


def _like(text: str, draw: Iterator[int]) -> str:
    """Letters and digits drawn anew, each within its own alphabet."""
    return "".join(_drawn(c, draw) for c in text)


def _drawn(c: str, draw: Iterator[int]) -> str:
    if c.isdigit():
        return str(next(draw) % 10)
    for first, last in ("az", "AZ", "ая", "АЯ", "αω", "ΑΩ"):
        if first <= c <= last:
            letters = [chr(k) for k in range(ord(first), ord(last) + 1) if chr(k).isalpha()]
            return letters[next(draw) % len(letters)]
    if c.isalpha():  # other letters: of the same 64 code points and case
        block = map(chr, range(ord(c) & ~63, (ord(c) & ~63) + 64))
        letters = [x for x in block if x.isalpha() and _case(x) == _case(c)]
        return letters[next(draw) % len(letters)]
    return c


def _case(letter: str) -> tuple:
    """What a letter and its replacement have in common: case, and whether it keeps its length."""
    lengths = len(letter.upper()), len(letter.casefold())
    return letter.isupper(), letter.islower(), *lengths


def _checks(digits: str) -> bool:
    """The check digit of card numbers."""
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _invented_name(kind: str, key: str, draw: Iterator[int]) -> str:
    script = unicodedata.name(key[0], "LATIN").split()[0]
    consonants, vowels, endings = NAMES.get(script, NAMES["LATIN"])
    parts = []
    for _ in range(max(3, len(key) // 2)):
        parts += [consonants[next(draw) % len(consonants)], vowels[next(draw) % len(vowels)]]
    ends = endings["f" if kind == "given_f" else "m"]
    tail = consonants[next(draw) % len(consonants)] if kind == "given_f" else ""
    return "".join(parts) + tail + ends[next(draw) % len(ends)]


def written_like(kind: str, written: str, surrogate: str) -> str:
    """A surrogate key in the format of one occurrence: separators, spaces, case."""
    if kind in ("surname", "given_m", "given_f"):
        return surrogate.upper() if written.isupper() else surrogate.capitalize()
    if kind in ("secret", "ip"):
        return surrogate
    if kind in ("phone", "card"):
        digits = iter(surrogate)
        return "".join(next(digits) if c.isdigit() else c for c in written) + "".join(digits)
    characters = iter(surrogate)
    parts = []
    for c in written:
        if kind == "iban" and c == " ":
            parts.append(c)
            continue
        new = next(characters, "")
        parts.append(new.upper() if c.isupper() else new)
    return "".join([*parts, *characters])


_ENTITY_DDL = "array<struct<kind:string,key:string>>"
_ENTITY = pa.list_(pa.struct([("kind", pa.string()), ("key", pa.string())]))
_ATTEMPT_DDL = "array<struct<kind:string,key:string,attempt:int>>"
_OUT_DDL = (
    "struct<text:string,entities:array<struct<kind:string,start:int,end:int,surrogate:string>>>"
)
_OUT = pa.struct(
    [
        ("text", pa.string()),
        (
            "entities",
            pa.list_(
                pa.struct(
                    [
                        ("kind", pa.string()),
                        ("start", pa.int32()),
                        ("end", pa.int32()),
                        ("surrogate", pa.string()),
                    ]
                )
            ),
        ),
    ]
)


def _keys_udf() -> Callable:
    @F.arrow_udf(_ENTITY_DDL)
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for part in slices(batches):
            rows = []
            for text in part.to_pylist():
                text = text or ""
                seen = {(k, entity_key(k, text[a:b])) for a, b, k in find_entities(text)}
                rows.append([{"kind": k, "key": v} for k, v in sorted(seen)])
            yield pa.array(rows, type=_ENTITY)

    return keys


def _surrogate_udf(secret: str) -> Callable:
    @F.arrow_udf("string")
    def draw(kinds: pa.Array, keys: pa.Array, attempts: pa.Array) -> pa.Array:
        columns = (kinds.to_pylist(), keys.to_pylist(), attempts.to_pylist())
        return pa.array([surrogate_key(secret, *row) for row in zip(*columns)], pa.string())

    return draw


def _replace_udf(secret: str, exceptions: object) -> Callable:
    """Arrow UDF: (text, exceptions of this text or null) -> struct(text, entities)."""

    @F.arrow_udf(_OUT_DDL)
    def replace(
        batches: Iterator[tuple[pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        release()
        shared = exceptions.value
        pairs = (pa.StructArray.from_arrays([*pair], names=["text", "own"]) for pair in batches)
        for part in slices(pairs):
            texts, own = part.field("text"), part.field("own")
            rows = []
            for text, more in zip(texts.to_pylist(), own.to_pylist()):
                attempts = {(e["kind"], e["key"]): e["attempt"] for e in more or ()} or shared
                rows.append(_replaced(text, secret, attempts))
            yield pa.array(rows, type=_OUT)

    return replace.asNondeterministic()  # else each field of the result would run it anew


def _replaced(text: str | None, secret: str, attempts: dict) -> dict:
    parts, entities, at = [], [], 0
    for start, end, kind in find_entities(text or ""):
        key = entity_key(kind, text[start:end])
        drawn = surrogate_key(secret, kind, key, attempts.get((kind, key), 0))
        new = written_like(kind, text[start:end], drawn)
        parts += [text[at:start], new]
        entities.append({"kind": kind, "start": start, "end": end, "surrogate": new})
        at = end
    new_text = text if not entities else "".join([*parts, text[at:]])
    return {"text": new_text, "entities": entities}


def surrogate_table(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, key, attempt, surrogate), stored: no two values of a kind share a surrogate.

    `entities` is a stored table of distinct (kind, key). No surrogate is a real value
    of its kind in the corpus either. In each round the smallest value keeps a
    surrogate that several have drawn, and the others draw again; rounds end when
    none is left, and each has a vanishing part of the values of the one before. A
    value with nothing to draw takes a few rounds more, until other signs or a longer
    surrogate are drawn for it.
    """
    draw = _surrogate_udf(secret)
    real = entities.select("kind", F.col("key").alias("surrogate"))
    left, attempt, done = entities, 0, None
    while True:
        drawn = settle(
            left.select("kind", "key", F.lit(attempt).alias("attempt")).withColumn(
                "surrogate", draw("kind", "key", "attempt")
            ),
            "drawn",
        )
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("key").alias("key"))
        won = won.select("kind", "key", F.lit(attempt).alias("attempt"), "surrogate")
        done = settle(won if done is None else done.unionByName(won), "surrogates")
        left = settle(drawn.select("kind", "key").join(done, ["kind", "key"], "left_anti"), "left")
        if left.isEmpty():
            return done
        attempt += 1


def _text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text), F.xxhash64(text, F.lit(1)), F.octet_length(text))


def replace_entities(
    docs: DataFrame, secret: str, out: str, text_col: str = "text"
) -> DataFrame:
    """`docs` with the column `out`: struct(text, entities array<struct(kind, start, end,
    surrogate)>); places are characters of the old text, entities stand in their order.

    Emails, secrets, account numbers, IP addresses, phone and card numbers, and names
    after a title, with their further mentions in the same text, are replaced. Texts without any, empty texts and nulls stay as they
    are, with no entities; all other columns and repeated rows stay. The same value has
    the same surrogate everywhere, other values have others, and the length, separators,
    case, script, check digit and gender of what is written are kept.

    Values that had to be drawn again are broadcast if they are few (size-checked);
    otherwise they are joined to the texts that hold them, with the same result.
    """
    spark = docs.sparkSession
    found = docs.select(F.explode(_keys_udf()(F.col(text_col))).alias("e")).select("e.*")
    entities = settle(found.distinct(), "entities")
    table = surrogate_table(entities, secret)
    again = settle(table.where("attempt > 0").select("kind", "key", "attempt"), "drawn-again")
    none = F.lit(None).cast(_ATTEMPT_DDL)
    if is_small(again, SMALL_ROWS):
        few = {(r["kind"], r["key"]): r["attempt"] for r in again.collect()}
        replace = _replace_udf(secret, spark.sparkContext.broadcast(few))
        return docs.withColumn(out, replace(F.col(text_col), none))
    replace = _replace_udf(secret, spark.sparkContext.broadcast({}))
    held = (
        docs.select(
            _text_key(F.col(text_col)).alias("text_key"),
            F.explode(_keys_udf()(F.col(text_col))).alias("e"),
        )
        .select("text_key", "e.kind", "e.key")
        .distinct()
        .join(again, ["kind", "key"])
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("kind", "key", "attempt")).alias("again"))
    )
    key, more = unused(docs, "_text_key"), unused(docs, "_again")
    held = held.select(F.col("text_key").alias(key), F.col("again").alias(more))
    joined = docs.withColumn(key, _text_key(F.col(text_col))).join(held, key, "left")
    return joined.withColumn(out, replace(F.col(text_col), F.col(more))).drop(key, more)
