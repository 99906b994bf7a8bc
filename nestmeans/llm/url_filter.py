"""URL filter by a cascade of Bloom filters.

Level 1 encodes the listed keys. Unlisted keys of the universe that pass it are encoded by level
2, listed keys that pass level 2 by level 3, and so on until nothing passes. A key's first failed
level then tells exactly whether it is listed, for every key of the universe, and judging a row
needs no join: each level is one array of 64-bit words, read as a scalar subquery.

All steps are built-in functions. Scale: one shuffle finds the distinct keys; each level is a
scan of the key table that sends at most one row per filter word. The levels together are held to
``max_bits``; a list that needs more is answered by a join with the key table instead.

Defined cases: a NULL key is judged as the empty key; repeated keys count once; a key given both
as listed and in the universe is listed; an empty list blocks nothing; keys outside of list and
universe get an answer that may be a false positive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.common import ascii_lower
from nestmeans.scratch import checkpoint

MAX_BITS = 1 << 26
LATER_RATE = 1 / 16
MAX_LEVELS = 40


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table with its words, and how keys are hashed into it."""

    number: int
    bits: int
    hashes: int
    words: DataFrame | None = None

    def positions(self, key: Column) -> list[Column]:
        first = F.pmod(F.xxhash64(F.lit(self.number), key), F.lit(self.bits))
        step = F.pmod(F.xxhash64(key, F.lit(-self.number)), F.lit(self.bits - 1)) + 1
        return [F.pmod(first + step * i, F.lit(self.bits)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        words = self.words.scalar()
        tests = [
            F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int"))
            for p in self.positions(key)
        ]
        passed = tests[0] == 1
        for test in tests[1:]:
            passed = passed & (test == 1)
        return passed


@dataclass(frozen=True)
class Cascade:
    """Levels of the cascade; ``keys`` answers instead when the levels would be too large."""

    levels: tuple[Level, ...]
    keys: DataFrame
    exact_by_join: bool = False

    def listed(self, key: Column) -> Column:
        """Whether ``key`` is listed: the parity of the first level it fails."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(~level.passes(key), F.lit(level.number % 2 == 0)).otherwise(answer)
        return answer

    def mark(self, df: DataFrame, key: str, into: str) -> DataFrame:
        """``df`` with the boolean column ``into``."""
        known = F.coalesce(F.col(key), F.lit(""))
        if not self.exact_by_join:
            return df.withColumn(into, self.listed(known))
        hits = self.keys.where("listed").select(F.col("key").alias("__key"), F.lit(True).alias("__hit"))
        joined = df.join(hits, known == F.col("__key"), "left")
        return joined.withColumn(into, F.coalesce("__hit", F.lit(False))).drop("__key", "__hit")


def _sized(number: int, count: int, rate: float) -> Level:
    bits = math.ceil(max(1, count) * math.log(1 / rate) / math.log(2) ** 2)
    bits = max(64, 64 * math.ceil(bits / 64))
    return Level(number, bits, max(1, round(math.log2(1 / rate))))


def _filled(level: Level, members: DataFrame) -> Level:
    """The level with the bits of ``members`` set, kept in the shared folder."""
    spark = members.sparkSession
    at = members.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    masks = at.select(
        F.shiftright("at", 6).alias("word"),
        F.expr("shiftleft(1L, cast(pmod(at, 64) as int))").alias("mask"),
    )
    masks = masks.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    blank = spark.range(level.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    words = blank.unionByName(masks).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("all"))
    row = row.select(F.transform("all", lambda x: x["mask"]).alias("words"))
    return Level(level.number, level.bits, level.hashes, checkpoint(row))


def build_cascade(
    listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, later_rate: float = LATER_RATE
) -> Cascade:
    """Cascade over two tables with one string column each (its name does not matter)."""
    def keyed(df: DataFrame, flag: bool) -> DataFrame:
        return df.select(F.coalesce(F.col(df.columns[0]), F.lit("")).alias("key"), F.lit(flag).alias("listed"))

    both = keyed(listed, True).unionByName(keyed(universe, False))
    keys = checkpoint(both.groupBy("key").agg(F.max("listed").alias("listed")))
    counted = keys.agg(F.count_if("listed").alias("yes"), F.count_if(~F.col("listed")).alias("no")).first()
    count, others = counted["yes"], counted["no"]
    if not count:
        return Cascade((), keys)
    rate = min(0.5, max(1e-9, count / (math.sqrt(2) * max(1, others))))
    levels: list[Level] = []
    while count:
        number = len(levels) + 1
        level = _sized(number, count, rate if number == 1 else later_rate)
        if sum(x.bits for x in levels) + level.bits > max_bits or number > MAX_LEVELS:
            return Cascade((), keys, exact_by_join=True)
        levels.append(_filled(level, _members(keys, levels, number)))
        count = _members(keys, levels, number + 1).count()
    return Cascade(tuple(levels), keys)


def _members(keys: DataFrame, levels: Sequence[Level], number: int) -> DataFrame:
    """What level ``number`` encodes: keys of its kind that pass all earlier levels of the other kind."""
    chosen = F.col("listed") if number % 2 else ~F.col("listed")
    for level in levels[: number - 1]:
        if (number - level.number) % 2:
            chosen = chosen & level.passes(F.col("key"))
    return keys.where(chosen)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest fitting rule, both NULL if none fits.

    A rule ``host/path`` fits its host and all subdomains when the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        cut = text.index("/")
        site, start = text[:cut], text[cut:]
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (),
    id_col: str = "page_id", url_col: str = "url", max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per page: id, host, path, rule, listed, verdict. ``listed`` has a column of hosts."""
    parsed = pages.select(
        F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    )
    cascade = build_cascade(listed, parsed.select("host"), max_bits)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return cascade.mark(parsed, "host", "listed").select(
        id_col, "host", "path", rule.alias("rule"), "listed", F.coalesce(verdict, method).alias("verdict")
    )
