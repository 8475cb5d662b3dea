"""Allow and block rules over URLs by cascades of Bloom filters: exact membership without joins.

DataFrame functions only; nothing here runs Python on the executors.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import narrow
from ebbtide.session import written

BITS_A_KEY = 10
PROBES = 5
#: The largest level, 2**26 bits or 8 MB: a list has at most some six million keys.
MAX_BITS = 1 << 26
#: Different (labels of the host, length of the path) that the rules of a list may have.
MAX_SHAPES = 4096


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty if there is no host part."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


class _Level:
    """One Bloom filter: its bits as an array literal, probed by hashes seeded with the level."""

    def __init__(self, keys: DataFrame, count: int, seed: int):
        self.bits = 1 << max(6, ceil(log2(count * BITS_A_KEY)))
        if self.bits > MAX_BITS:
            raise ValueError(f"{count} keys need more than {MAX_BITS} bits; split the list")
        self.seed = seed
        at = F.explode(F.array(*[self._place(F.col("key"), i) for i in range(PROBES)]))
        words = (
            keys.select(at.alias("at"))
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        )
        filled = ["0"] * (self.bits >> 6)
        for row in words.toLocalIterator():
            filled[row["word"]] = str(row["bits"])
        self.words = F.split(F.lit(",".join(filled)), ",").cast("array<bigint>")

    def _place(self, key: Column, probe: int) -> Column:
        return F.xxhash64(key, F.lit(self.seed), F.lit(probe)).bitwiseAND(F.lit(self.bits - 1))

    def holds(self, key: Column) -> Column:
        found = F.lit(True)
        for probe in range(PROBES):
            at = self._place(key, probe)
            word = F.get(self.words, F.shiftright(at, 6).cast("int"))
            found = found & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (both with a column ``key``).

    Level 1 holds the listed keys, level 2 the keys of the universe that level 1 takes for listed,
    level 3 the listed keys that level 2 holds, and so on until a level errs on nothing. A key is
    listed if the first level that lacks it is an even one. Levels shrink fast; only level 1 grows
    with the list, and its size is checked. Keys outside the universe may be misjudged.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame):
        inside = listed.select("key").where("key is not null").distinct()
        self.levels: list[_Level] = []
        count = inside.count()
        if not count:
            return
        self.levels.append(_Level(inside, count, 0))
        outside = written(
            universe.where(self.levels[0].holds(F.col("key"))).select("key").distinct().join(inside, "key", "left_anti"),
            "cascade",
        )
        sides = [outside, inside]
        while count := sides[0].count():
            self.levels.append(_Level(sides[0], count, len(self.levels)))
            sides = [sides[1].where(self.levels[-1].holds(F.col("key"))), sides[0]]

    def contains(self, key: Column) -> Column:
        found = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            found = F.when(self.levels[i].holds(key), found).otherwise(F.lit(i % 2 == 1))
        return found


def _candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """``(size, key)`` for every shape of rule that the URL could meet: a host suffix and a path prefix."""
    parts = F.split(host, r"\.")

    def one(shape: Column) -> Column:
        suffix = F.array_join(F.slice(parts, -shape["labels"], shape["labels"]), ".")
        fits = (F.size(parts) >= shape["labels"]) & (F.length(path) >= shape["path"])
        key = F.concat(suffix, F.substring(path, F.lit(1), shape["path"]))
        return F.when(fits, F.struct(F.length(key).alias("size"), F.length(suffix).alias("host_size"), key.alias("key")))

    literal = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(p).alias("path")) for n, p in shapes])
    return F.filter(F.transform(literal, one), lambda c: c.isNotNull())


def judge_urls(
    pages: DataFrame, allow: DataFrame, block: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``allow`` and ``block`` have the columns ``host, path``. A rule fits its host and all subdomains
    where the URL's path starts with its own; the longest fitting rule (then the one with the longer
    host, then a blocking one) decides, and ``default`` where none fits. Each list becomes a cascade
    over all keys that the URLs of ``pages`` yield, so judging is one pass without a join.

    A null URL, or one without ``://``, has an empty host and path and meets no rule; null ids stay
    null; repeated rows are judged each; empty lists and tables are fine. Rules with a null are
    ignored.
    """
    rules = allow.select("host", "path").unionByName(block.select("host", "path")).where("host is not null and path is not null")
    shapes = sorted(
        (r["labels"], r["size"])
        for r in rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("size"))
        .distinct()
        .limit(MAX_SHAPES + 1)
        .collect()
    )
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} different shapes; split the lists")
    rows = narrow(pages, page_id=id_col, url=url_col).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shapes:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tried = rows.withColumn("tried", _candidates(F.col("host"), F.col("path"), shapes))
    universe = tried.select(F.explode("tried.key").alias("key"))
    keys = lambda rules: rules.select(F.concat("host", "path").alias("key"))
    allowed, blocked = Cascade(keys(allow), universe), Cascade(keys(block), universe)

    def listed(c: Column) -> Column:
        verdict = F.when(blocked.contains(c["key"]), "block").when(allowed.contains(c["key"]), "allow")
        return F.struct(c["size"].alias("size"), c["host_size"].alias("host_size"), c["key"].alias("key"), verdict.alias("verdict"))

    met = F.filter(F.transform("tried", listed), lambda c: c["verdict"].isNotNull())
    return tried.withColumn("met", F.array_max(met)).select(
        "page_id", "host", "path", F.col("met.key").alias("rule"), F.coalesce("met.verdict", F.lit(default)).alias("verdict")
    )
