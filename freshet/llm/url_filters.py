"""URL rules and host lists by a cascade of Bloom filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import UPPER, stored, table

# The rules as (host, path, verdict), and words that hosts of spam carry between dots and hyphens.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
SPAM = r"(^|[.-])(pills|casino|viagra|porn|xxx|bet|loans?|payday|poker|replica|cheap)([.-]|$)"

HASHES, BITS_PER_KEY = 7, 10
#: Largest number of listed keys whose filters are sent to every task; larger lists are joined by key.
MOST_LISTED = 20_000_000


def host(url: str = "url") -> Column:
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, UPPER.lower())


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _suffixes(name: str) -> Column:
    """A host and the domains above it, longest first; none for an empty host."""
    parts = F.split(F.col(name), r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    return F.when(F.col(name) == "", F.array().cast("array<string>")).otherwise(tails)


def keys(lengths: list[int]) -> Column:
    """All keys that could fit a row: each domain alone, and with the path's beginnings of the rules' lengths."""
    heads = F.array(*[F.substring("path", 1, n) for n in lengths]) if lengths else F.array().cast("array<string>")
    heads = F.filter(heads, lambda h: F.length(h) > 0)
    domains = _suffixes("host")
    return F.array_distinct(F.flatten(F.transform(domains, lambda d: F.concat(F.array(d), F.transform(heads, lambda h: F.concat(d, h))))))


def _places(bits: int, level: int) -> Column:
    first, second = F.xxhash64("key", F.lit(2 * level)), F.xxhash64("key", F.lit(2 * level + 1))
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda k: F.pmod(F.shiftright(first, 1) + k * F.shiftright(second, 9), F.lit(bits)))


class Filter:
    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def holds(self, places: np.ndarray) -> np.ndarray:
        return ((self.words[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def _encoded(members: DataFrame, n: int, level: int) -> Filter:
    """The members' bits, set in Spark; one byte per row reaches the driver, at most BITS_PER_KEY / 8 per key."""
    bits = max(64, n * BITS_PER_KEY)
    set_bits = members.select(F.explode(_places(bits, level)).alias("place"))
    rows = set_bits.groupBy(F.floor(F.col("place") / 8).alias("byte")).agg(F.expr("bit_or(shiftleft(1, cast(pmod(place, 8) AS int)))").alias("set")).toPandas()
    words = np.zeros(bits // 8 + 1, dtype=np.uint8)
    words[rows["byte"].to_numpy(np.int64)] = rows["set"].to_numpy(np.uint8)
    return Filter(bits, words)


def _passing(rows: DataFrame, made: Filter, level: int) -> DataFrame:
    def test(places: pd.Series) -> pd.Series:
        return pd.Series(made.holds(np.stack(places.to_numpy())) if len(places) else [], dtype=bool)

    return rows.where(F.pandas_udf(test, "boolean")(_places(made.bits, level)))


def cascade(universe: DataFrame, listed: DataFrame, most_levels: int = 40) -> list[Filter]:
    """Filters that together tell listed keys from all others of ``universe`` exactly.

    Level 0 holds the listed keys; the next the other keys that pass it by mistake; the next the listed keys that pass
    that one; and so on until nobody passes by mistake. Both tables have one column ``key`` without repeats.
    """
    inside, outside = listed.join(universe, "key", "left_semi"), universe.join(listed, "key", "left_anti")
    # listed keys that the corpus lacks are never asked for
    levels: list[Filter] = []
    members, others = stored(inside, "listed"), stored(outside, "others")
    while True:
        n = members.count()
        if not n:
            return levels
        if len(levels) == most_levels:
            raise RuntimeError("the cascade has not ended; are keys repeated between its sides?")
        made = _encoded(members, n, len(levels))
        levels.append(made)
        members, others = stored(_passing(others, made, len(levels) - 1), "false-positives"), members


def member(levels: list[Filter], column: str = "found_keys") -> Column:
    """The keys of an array column that are listed: those whose first refusing level is odd."""

    hashes = F.transform(F.col(column), lambda k: F.array(*[F.xxhash64(k, F.lit(j)) for j in range(2 * max(1, len(levels)))]))

    def listed(keys_: pd.Series, codes: pd.Series) -> pd.Series:
        out = []
        for names, rows in zip(keys_, codes, strict=True):
            if not len(names) or not levels:
                out.append([])
                continue
            code = np.stack([np.asarray(r, dtype=np.int64) for r in rows])
            verdict = np.full(len(names), len(levels) % 2 == 1)
            open_ = np.ones(len(names), dtype=bool)
            for level in range(len(levels)):
                steps = np.arange(HASHES, dtype=np.int64)
                places = ((code[:, 2 * level] >> 1)[:, None] + steps * (code[:, 2 * level + 1] >> 9)[:, None]) % levels[level].bits
                refused = open_ & ~levels[level].holds(places)
                verdict[refused] = level % 2 == 1
                open_ &= ~refused
            out.append([name for name, yes in zip(names, verdict, strict=True) if yes])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(listed, "array<string>")(F.col(column), hashes)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: DataFrame) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (they replace columns so named).

    ``blocked`` has a column ``key`` of listed domains; a page below one is blocked unless a rule, the longest that
    fits, says otherwise. Null urls and those without ``://`` have empty host and path, fit nothing and are allowed. Each row is
    judged by itself, so repeated rows repeat; empty tables and lists are fine.
    """
    spark = pages.sparkSession
    lengths = sorted({len(p) for _, p, _ in rules})
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "found_keys")]
    rows = pages.select(*own, host().alias("host"), path().alias("path")).withColumn("found_keys", keys(lengths))
    universe = stored(rows.select(F.explode("found_keys").alias("key")).distinct(), "universe")
    fixed = spark.createDataFrame([(h + p,) for h, p, _ in rules], "key string")
    listed = stored(fixed.union(blocked.select("key")).where("key is not null").distinct(), "listed")
    if listed.count() <= MOST_LISTED:
        hits = member(cascade(universe, listed))
        judged = rows.withColumn("found_keys", hits)
    else:
        spots = rows.withColumn("_row", F.expr("uuid()"))
        spots = stored(spots, "rows")
        found = spots.select("_row", F.explode("found_keys").alias("key")).join(listed, "key").groupBy("_row").agg(F.collect_set("key").alias("_hits"))
        judged = spots.join(found, "_row", "left").withColumn("found_keys", F.coalesce("_hits", F.array().cast("array<string>"))).drop("_row", "_hits")
    rule, verdict = F.lit(None).cast("string"), F.when(F.size("found_keys") > 0, "block").otherwise("allow")
    for h, p, say in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        hit = F.array_contains("found_keys", h + p)
        rule, verdict = F.when(hit, h + p).otherwise(rule), F.when(hit, say).otherwise(verdict)
    return judged.select(*own, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    spam = pages.select(host().alias("key")).distinct().where(F.col("key").rlike(SPAM))
    return judge(pages, RULES, spam).select("page_id", "host", "path", "rule", "verdict")
