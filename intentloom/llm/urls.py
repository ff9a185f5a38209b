"""URL verdicts by a cascade of Bloom filters, exact over a corpus's own keys.

The first level encodes the listed keys. The keys of the corpus that pass it by
mistake are encoded in the second, the listed keys that pass that one in the
third, and so on until a level is passed by none. Asked about keys of that corpus,
the first level that a key does not pass tells surely whether it is listed. The
levels are small (some bits per listed key), so they travel inside the plan and
the pages are judged where they are read, without a join or a shuffle.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.shared import unused
from intentloom.session import settle

WORD_BITS = 64
#: Share of the other side's keys that may pass a level beyond the first.
LATER_RATE = 0.5
LEAST_BITS = 64
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and all paths that begin with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    words: tuple[int, ...]
    bits: int
    hashes: int

    def holds(self, key: Column, number: int) -> Column:
        """Whether a key passes this level; parsed once, as a constant of the plan."""
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        passed = F.lit(True)
        for place in _places(key, number, self.bits, self.hashes):
            word = F.get(words, (place / WORD_BITS).cast("int"))
            passed = passed & (F.getbit(word, (place % WORD_BITS).cast("int")) == 1)
        return passed


def _places(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key, F.lit(number), F.lit(k)), F.lit(bits)) for k in range(hashes)
    ]


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    """A level of n keys. Its words are set in Spark; only they come to the driver."""
    hashes = max(1, math.ceil(-math.log2(rate)))
    bits = max(LEAST_BITS, math.ceil(n * hashes / math.log(2)))
    places = F.array(*_places(F.col("key"), number, bits, hashes))
    set_bits = keys.select(F.explode(places).alias("place")).select(
        (F.col("place") / WORD_BITS).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, int(place % {WORD_BITS}))").alias("bit"),
    )
    words = [0] * math.ceil(bits / WORD_BITS)
    for row in set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        words[row["word"]] = row["bits"]
    return Level(tuple(words), bits, hashes)


class Cascade:
    """Exact membership of corpus keys in a list that is given as a driver-side parameter."""

    def __init__(self, listed: list[str], universe: DataFrame):
        """`universe` has the column key, nulls and repeats allowed, with all keys to be asked.

        Every level's size follows from the number of listed keys: the first lets
        through about as many other keys as there are listed ones, whatever the
        corpus. Nothing of the corpus comes to the driver but counts and level bits.
        """
        self.levels: list[Level] = []
        listed = sorted(set(listed))
        if not listed:
            return
        spark = universe.sparkSession
        inside = spark.createDataFrame([(k,) for k in listed], "key string")
        n_inside = len(listed)
        n_all = universe.agg(F.approx_count_distinct("key")).first()[0]
        rate = min(LATER_RATE, n_inside / max(1, n_all) / math.sqrt(2))
        self.levels.append(_level(inside, n_inside, rate, 0))
        passed = universe.where(self.levels[0].holds(F.col("key"), 0))
        outside = settle(passed.distinct().join(inside, "key", "left_anti"), "passed")
        sides = [outside, inside]
        while (n := sides[0].count()) > 0:
            number = len(self.levels)
            level = _level(sides[0], n, LATER_RATE, number)
            self.levels.append(level)
            # of the other side, what passes the new level has to be told apart next
            rest = settle(sides[1].where(level.holds(F.col("key"), number)), "passed")
            sides = [rest, sides[0]]

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            passed = self.levels[number].holds(key, number)
            answer = F.when(passed, answer).otherwise(F.lit(number % 2 == 1))
        return answer


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _candidates(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The keys that could be listed for a url: host endings with path beginnings."""
    found = []
    for labels in sorted({r.host.count(".") + 1 for r in rules}):
        ending = F.substring_index(host, ".", -labels)
        for size in sorted({len(r.path) for r in rules}):
            beginning = F.substring(path, 1, size)
            found.append(
                F.when((host != "") & (F.length(path) >= size), F.concat(ending, beginning))
            )
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    blocked_hosts: list[str],
    url_col: str = "url",
) -> DataFrame:
    """`pages` with host, path, rule (the longest that fits, or null) and verdict.

    Rules are judged first, the longest key wins. Without a rule a url is blocked if
    its host or a parent domain is in `blocked_hosts`, else allowed. Null urls and
    urls without `://` have an empty host and path and are allowed. Columns of these
    four names are replaced; all others, and repeated rows, stay. The rules and hosts
    are parameters on the driver; two rules with one key but other verdicts are an
    error.
    """
    hosts = [Rule(h, "", BLOCK) for h in blocked_hosts]
    every = [*rules, *hosts]
    lists = {v: {r.key for r in every if r.verdict == v} for v in (ALLOW, BLOCK)}
    if lists[ALLOW] & lists[BLOCK]:
        raise ValueError("a key is both allowed and blocked")
    url = F.coalesce(F.col(url_col), F.lit(""))
    keys = _candidates(host_of(url), path_of(url), every)
    universe = pages.select(F.explode(keys).alias("key"))
    # keys of rules have a slash, but for rules of whole hosts
    bare = [r.key for r in rules if "/" not in r.key]
    cascades = {v: Cascade(sorted(keys), universe) for v, keys in lists.items()}

    def listed(verdict: str) -> Column:
        return F.transform(
            F.filter(F.col(candidates), cascades[verdict].holds),
            lambda key: F.struct(
                (key.contains("/") | key.isin(bare) if bare else key.contains("/")).alias("is_rule"),
                F.length(key).alias("size"),
                key.alias("key"),
                F.lit(verdict).alias("verdict"),
            ),
        )

    candidates, best = unused(pages, "_keys"), unused(pages, "_best")
    judged = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    judged = judged.withColumn(
        candidates, _candidates(F.col("host"), F.col("path"), every)
    ).withColumn(best, F.array_max(F.concat(listed(ALLOW), listed(BLOCK))))
    top = F.col(best)
    return judged.withColumns(
        {
            "rule": F.when(top["is_rule"], top["key"]),
            "verdict": F.coalesce(top["verdict"], F.lit(ALLOW)),
        }
    ).drop(candidates, best)
