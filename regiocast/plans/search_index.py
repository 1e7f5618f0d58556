"""Stored inverted index: posting lists written once, read by word.

Term counts are made inside the row (sorted words, run lengths), so building has one shuffle: the
postings by bucket, sorted by (bucket, term, document). A bucket too large for a task, as that of a
word that stands in a third of all documents, is split, hence spans many files. A search reads the
folders of its words' buckets, and of these the row groups whose bounds hold the words; scores
equal those of the full pass exactly.

Rows are told apart by a number of their own, so null and repeated doc_ids are ranked as in the
full pass. Documents without words count for the statistics only.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.functions.text import tokens
from regiocast.plans.retrieval import B, K1, SEARCH_BLOCK, SearchQuery, ranked


@dataclass(frozen=True)
class SearchIndex:
    """``buckets`` and ``schema`` (of the postings) stand in the statistics, see ``open_index``."""
    path: str
    buckets: int
    schema: str

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/postings")

    def stats(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/stats")


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """An index written before, by this or another session."""
    row = spark.read.parquet(f"{path}/stats").select("buckets", "schema").first()
    return SearchIndex(path, row["buckets"], row["schema"])


def _starts_run(words: str):
    return lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1))


def _run(words: str, starts: str):
    def one(start, k):
        stop = F.coalesce(F.get(starts, k + 1), F.size(words))
        return F.struct(F.get(words, start).alias("term"), (stop - start).alias("tf"))
    return one


def build_index(docs: DataFrame, path: str, keep: tuple[str, ...] = ("lang", "source"),
                buckets: int = 256) -> SearchIndex:
    """Write the postings and the statistics of ``docs (doc_id, text, *keep)`` below ``path``."""
    # sort_array compares the strings themselves, array_sort calls an interpreted comparator
    words = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *keep,
                        F.sort_array(F.coalesce(tokens("text"), F.array().cast("array<string>")))
                        .alias("_w")).withColumn("dl", F.size("_w"))
    # no filter on dl, which would be pushed below and split every text once more
    runs = words.withColumn("_s", F.when(F.col("dl") > 0, F.filter(
        F.sequence(F.lit(0), F.col("dl") - 1), _starts_run("_w"))))
    postings = runs.select("row", "doc_id", *keep, "dl",
                           F.inline(F.transform("_s", _run("_w", "_s"))))
    placed = postings.withColumn("bucket", F.pmod(F.crc32("term"), F.lit(buckets)).cast("int"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    place = ["bucket", "term", "row"]
    # a range exchange would split all texts a second time, to sample its bounds
    (placed.hint("rebalance", "bucket").sortWithinPartitions(*place)
     .write.partitionBy("bucket").parquet(f"{path}/postings"))
    index = SearchIndex(path, buckets, schema)
    # term counts add up to the words of all texts, so the texts need no look again
    total = index.postings(docs.sparkSession).agg(F.sum("tf")).scalar()
    docs.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.coalesce(total, F.when(F.col("n") > 0, 0)).cast("bigint").alias("dl"),
        F.lit(buckets).alias("buckets"), F.lit(schema).alias("schema")).write.parquet(
        f"{path}/stats")  # last: an index with statistics is whole
    return index


def lists_of(spark: SparkSession, index: SearchIndex, terms: list[str]) -> DataFrame:
    """Postings of the words alone: partitions by bucket, row groups by word."""
    held = sorted({zlib.crc32(t.encode()) % index.buckets for t in terms})
    return index.postings(spark).filter(
        F.col("bucket").isin(held) & F.col("term").isin(terms))


def search_index(spark: SparkSession, index: SearchIndex, queries: list[SearchQuery],
                 k: int) -> DataFrame:
    """BM25 top k per query, as ``keyword_search``: (query_id, doc_id, score, rank)."""
    queries = [q for q in queries if q.terms]
    if not queries:
        kind = dict(index.postings(spark).dtypes)["doc_id"]
        return spark.createDataFrame([], f"query_id string, doc_id {kind}, score double, rank int")
    return reduce(lambda a, b: a.unionByName(b), [
        _search_block(spark, index, queries[i:i + SEARCH_BLOCK], k)
        for i in range(0, len(queries), SEARCH_BLOCK)])


def _search_block(spark: SparkSession, index: SearchIndex, queries: list[SearchQuery],
                  k: int) -> DataFrame:
    terms = sorted({t for q in queries for t in q.terms})
    lists = lists_of(spark, index, terms)
    counts = lists.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    stats = index.stats(spark).select(F.struct(
        F.col("n").cast("double").alias("n"), F.col("dl").cast("double").alias("dl"))).scalar()
    # at most one row per word of a block of queries
    hits = lists.join(F.broadcast(counts), "term").withColumn("_st", stats)
    n, avg = F.col("_st.n"), F.col("_st.dl") / F.col("_st.n")
    df, tf = F.col("df"), F.col("tf").cast("double")
    idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    norm = tf + K1 * (F.lit(1.0 - B) + B * F.col("dl").cast("double") / avg)
    scored = hits.withColumn("_p", (idf * tf * (K1 + 1.0) / norm).cast("decimal(20,8)"))

    def entry(q: SearchQuery):
        match = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in q.filters.items()],
                       F.col("term").isin(q.terms))
        return F.struct(F.lit(q.query_id).alias("query_id"), F.when(match, F.col("_p")).alias("_p"))

    pieces = scored.select("row", "doc_id", F.inline(F.array(*map(entry, queries)))).filter(
        F.col("_p").isNotNull())
    totals = pieces.groupBy("query_id", "row", "doc_id").agg(
        F.sum("_p").cast("decimal(28,8)").alias("_s")).filter(F.col("_s") > 0)
    return ranked(totals, "doc_id", k).select(
        "query_id", "doc_id", F.col("_s").cast("double").alias("score"), "rank")
