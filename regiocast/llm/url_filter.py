"""Allow and block lists over urls by a cascade of Bloom filters.

A rule is a host and a path prefix; it fits the host and its subdomains. The keys of a url are
all suffixes of its host, at label borders, with all prefixes of its path that are as long as
some rule's path. Level 1 of the cascade encodes the listed keys; level 2 the keys of the whole
corpus that pass level 1 without being listed; level 3 the listed keys that pass level 2; and
so on until nothing passes wrongly. A key belongs to the list when the first level it fails is
an even one, or when it passes all of an odd number of levels. Over the corpus the answer is
exact, and judging a url is arithmetic on the row: no join, and a hot host changes nothing.

A second cascade, over the listed keys, tells block rules from allow rules. The longest rule
that fits a url decides (of equally long ones, that with the longer host); a key both allowed
and blocked is blocked; a url without a rule is allowed.

Filters hold ``bits_per_key`` bits a key and travel as one value with the plan. Their size
follows the list, not the corpus; a list that needs more than ``MAX_BITS`` is refused.

Null urls, and urls without ``://``, have empty host and path and are allowed; very long urls
are read whole; repeated rows are judged each; an empty table, or an empty list, is fine; other
columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.llm.text import ascii_lower
from regiocast.session import cut_lineage

MAX_BITS = 1 << 28  # 32 MB
PROBES = 5
KEYS = "array<struct<size:int,host_size:int,key:string>>"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def url_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Array of structs (size, host_size, key): everything of a url that a rule can name."""
    labels = F.split(host, r"\.")
    suffixes = F.aggregate(F.array(labels), F.array().cast("array<string>"), lambda _, s: F.transform(
        F.sequence(F.lit(1), F.size(s)),
        lambda i: F.array_join(F.slice(s, i, F.size(s)), ".")))

    def keys(s: Column) -> Column:
        return F.filter(F.array(*[F.when(F.length(path) >= n, F.struct(
            (F.length(s) + n).alias("size"), F.length(s).alias("host_size"),
            F.concat(s, F.substring(path, 1, n)).alias("key"))) for n in lengths]),
            lambda k: k.isNotNull())

    return F.flatten(F.transform(suffixes, keys))


@dataclass(frozen=True)
class Level:
    bits: int
    seed: int
    words: DataFrame  # one row, one array of 64-bit words

    @staticmethod
    def positions(key: Column, bits: int, seed: int) -> list[Column]:
        first = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))
        step = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits - 1)) + 1
        return [(first + i * step) % bits for i in range(PROBES)]

    def passes(self, key: Column, words: Column) -> Column:
        found = F.lit(True)
        for p in self.positions(key, self.bits, self.seed):
            found = found & (F.getbit(F.get(words, (p / 64).cast("int")), (p % 64).cast("int"))
                             == 1)
        return found


def build_level(keys: DataFrame, n: int, seed: int, bits_per_key: int) -> Level:
    """Bloom filter of ``keys (key)``, put together on the executors, 64 bits to a word."""
    bits = 64 * max(1, -(-n * bits_per_key // 64))
    if bits > MAX_BITS:
        raise ValueError(f"a filter of {bits} bits is over the limit of {MAX_BITS}")
    at = keys.select(F.explode(F.array(*Level.positions(F.col("key"), bits, seed))).alias("p"))
    filled = at.groupBy(F.floor(F.col("p") / 64).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                 (F.col("p") % 64).cast("int"))).alias("w"))
    empty = keys.sparkSession.range(bits // 64).select("id", F.lit(0).cast("bigint").alias("w"))
    dense = filled.unionByName(empty).groupBy("id").agg(F.bit_or("w").alias("w"))
    words = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))),
                                  lambda x: x["w"]).alias("words"))
    return Level(bits, seed, cut_lineage(words))


class Cascade:
    """Exact membership of ``listed (key)`` within a universe of keys."""

    def __init__(self, listed: DataFrame, universe, bits_per_key: int = 12):
        """``universe(level)``: DataFrame (key) of the universe's keys that pass the level."""
        self.levels: list[Level] = []
        inside, n = listed, listed.count()
        outside = None
        while n:
            level = build_level(inside, n, len(self.levels) + 1, bits_per_key)
            self.levels.append(level)
            if outside is None:
                wrong = universe(level).distinct().join(listed, "key", "left_anti")
            else:
                wrong = outside.where(level.passes(F.col("key"), level.words.scalar()))
            wrong = cut_lineage(wrong)
            inside, outside, n = wrong, inside, wrong.count()

    def filters(self) -> Column:
        """The levels' words in one value: subqueries cannot stand inside a lambda."""
        return F.struct(F.lit(0).alias("levels"), *[
            level.words.scalar().alias(f"level{i}") for i, level in enumerate(self.levels, 1)])

    def has(self, key: Column, filters: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            answer = F.when(self.levels[i - 1].passes(key, filters[f"level{i}"]),
                            answer).otherwise(F.lit(i % 2 == 0))
        return answer


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]],
               bits_per_key: int = 12) -> DataFrame:
    """Per row of ``pages (page_id, url)``: page_id, host, path, rule, verdict.

    ``rules``: (allow or block, host, path prefix).
    """
    spark: SparkSession = pages.sparkSession
    rules = list(rules)
    lengths = sorted({len(path) for _, _, path in rules})
    listed = spark.createDataFrame(
        [(kind, host.lower() + path) for kind, host, path in rules], "kind string, key string")
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = urls.select("page_id", "host", "path", url_keys(
        F.col("host"), F.col("path"), lengths).alias("keys") if lengths else
        F.array().cast(KEYS).alias("keys"))
    all_keys = cut_lineage(listed.select("key").distinct())

    def chosen(value: Column, test) -> DataFrame:
        """``keyed`` with the keys of a url for which ``test(key, value)`` holds."""
        return keyed.select("*", value.alias("filters")).select(
            "page_id", "host", "path", F.aggregate(
                F.array("filters"), F.lit(None).cast(KEYS), lambda _, v: F.filter(
                    "keys", lambda k: test(k["key"], v))).alias("chosen"))

    def corpus(level: Level) -> DataFrame:
        return chosen(level.words.scalar(), level.passes).select(
            F.explode("chosen").alias("k")).select("k.key")

    members = Cascade(all_keys, corpus, bits_per_key)
    blocked = Cascade(cut_lineage(listed.where("kind = 'block'").select("key").distinct()),
                      lambda level: all_keys.where(
                          level.passes(F.col("key"), level.words.scalar())), bits_per_key)
    best = chosen(members.filters(), members.has).select(
        "page_id", "host", "path", F.array_max("chosen")["key"].alias("rule"))
    return best.select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNotNull() & blocked.has(F.col("rule"), blocked.filters()), "block")
        .otherwise("allow").alias("verdict"))
