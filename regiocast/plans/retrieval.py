"""Keyword and vector search with attribute filters, and citations.

The query side is a short list given by the caller; the documents are the large side and are
never paired with each other. Each task keeps its own best k per query before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocast.functions.text import tokens
from regiocast.operators.topk import top_k_per_group
from regiocast.plans import fixed
from regiocast.session import cut_lineage

K1, B = 1.2, 0.75
SEARCH_BLOCK = 64


@dataclass(frozen=True)
class SearchQuery:
    """Search words with optional attribute filters (column -> value)."""
    query_id: str
    text: str
    filters: dict[str, str] = field(default_factory=dict)

    @property
    def terms(self) -> list[str]:
        """Distinct words, by the same rule as the documents' (runs of letters)."""
        return list(dict.fromkeys(regex.findall(r"\p{L}+", self.text.lower())))


def _equal_to(term):
    return lambda word: word == term


def term_index(docs: DataFrame, terms: list[str], keep: list[str]) -> DataFrame:
    """Per document: length in words and the count of each search term.

    Reading and splitting the text is the expensive part, so the compact result is written
    once; statistics and scores both start from it.
    """
    words = docs.select("doc_id", *keep, tokens("text").alias("_w"))
    wanted = F.filter("_w", lambda w: w.isin(terms))
    counted = words.select("doc_id", *keep, F.size("_w").alias("dl"), wanted.alias("_hit"))
    tf = F.array(*[F.size(F.filter("_hit", _equal_to(t))) for t in terms])
    return cut_lineage(counted.select("doc_id", *keep, "dl", tf.alias("tf")))


def keyword_search(docs: DataFrame, queries: list[SearchQuery], k: int) -> DataFrame:
    """BM25 top k per query: (query_id, doc_id, score, rank). Ties go to the smaller id.

    Long lists of queries run block by block, each an exact pass over the documents. A query
    without words finds nothing.
    """
    queries = [q for q in queries if q.terms]
    if not queries:
        kind = dict(docs.dtypes)["doc_id"]
        return docs.sparkSession.createDataFrame(
            [], f"query_id string, doc_id {kind}, score double, rank int")
    return reduce(lambda a, b: a.unionByName(b), [
        _search_block(docs, queries[i:i + SEARCH_BLOCK], k)
        for i in range(0, len(queries), SEARCH_BLOCK)])


def _search_block(docs: DataFrame, queries: list[SearchQuery], k: int) -> DataFrame:
    terms = sorted({t for q in queries for t in q.terms})
    keep = sorted({c for q in queries for c in q.filters})
    index = term_index(docs, terms, keep)
    stats = index.agg(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("dl").cast("double").alias("dl"),
        F.array(*[F.count(F.when(F.col("tf")[i] > 0, 1)).cast("double")
                  for i in range(len(terms))]).alias("df"))).scalar()
    hits = index.filter(F.exists("tf", lambda x: x > 0)).withColumn("_st", stats)
    n, avg = F.col("_st.n"), F.col("_st.dl") / F.col("_st.n")

    def score(term: str) -> Column:
        i = terms.index(term)
        df, tf = F.col("_st.df")[i], F.col("tf")[i].cast("double")
        idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
        norm = tf + K1 * (F.lit(1.0 - B) + B * F.col("dl").cast("double") / avg)
        return F.when(tf > 0, (idf * tf * (K1 + 1.0) / norm).cast("decimal(20,8)")).otherwise(
            F.lit(0).cast("decimal(20,8)"))

    def entry(q: SearchQuery) -> Column:
        match = reduce(lambda a, b: a & b,
                       [F.col(c) == v for c, v in q.filters.items()], F.lit(True))
        total = reduce(lambda a, b: a + b, [score(t) for t in q.terms])
        return F.struct(F.lit(q.query_id).alias("query_id"),
                        F.when(match, total).cast("decimal(28,8)").alias("_s"))

    scored = hits.select("doc_id", F.inline(F.array(*[entry(q) for q in queries])))
    return ranked(scored.filter(F.col("_s") > 0), "doc_id", k).select(
        "query_id", "doc_id", F.col("_s").cast("double").alias("score"), "rank")


def ranked(scored: DataFrame, item: str, k: int) -> DataFrame:
    """Rows ranked per query by ``_s`` down and item up, the first k kept.

    A task sends at most k rows of a query into the shuffle.
    """
    order = [F.col("_s").desc(), F.col(item)]
    best = top_k_per_group(scored, ["query_id"], k, *order)
    return best.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(*order)))


QUERY_BLOCK = 1024  # query vectors of a block
ITEM_BLOCK = 4096  # item vectors of a block
BROADCAST_BYTES = 32 << 20  # query blocks up to this measured size are broadcast
SLACK = 1e-9  # what a matrix product may differ from the sum in order


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` with the vector ``b``, added up in order: equal vectors have
    equal cosines wherever they are computed."""
    dot, x, y = (np.cumsum(p, axis=1)[:, -1] for p in (a * b, a * a, (b * b)[None, :]))
    return dot / np.maximum(np.sqrt(x * y), 1e-300)


def item_blocks(items: DataFrame, item: str, vector: str) -> DataFrame:
    """Rows (ids, vectors): the items of a task packed into matrices. Items without a vector, or
    with a null inside, take no part."""
    kind = dict(items.dtypes)[item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ITEM_BLOCK):
                part = batch.slice(lo, ITEM_BLOCK)
                lengths = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
                for n in np.unique(lengths):  # vectors of one length make a matrix
                    own = part.filter(pa.array(lengths == n))
                    values = own.column(1).flatten().to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own.column(0).to_pylist()], pa.list_(own.column(0).type)),
                         pa.array([np.asarray(values, dtype="<f8").tobytes()], pa.binary())],
                        ["ids", "vectors"])

    good = items.select(item, vector).filter(
        F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull()))
    return good.mapInArrow(run, f"ids array<{kind}>, vectors binary")


def vector_search(items: DataFrame, item: str, vector: str, queries: DataFrame,
                  k: int) -> DataFrame:
    """Cosine top k for each row (query_id, vector) of ``queries``.

    Items and queries are packed into blocks on the executors; every item block meets every query
    block in one matrix product and gives k items a query. Query blocks are broadcast where their
    measured size allows it, else the blocks meet partition by partition. Ranks follow the
    unrounded cosine, then the item. An item of another length than the query is not compared.
    """
    kinds = {**dict(items.dtypes), "query_id": dict(queries.dtypes)["query_id"]}
    queries = cut_lineage(queries.select("query_id", F.col("vector").cast("array<double>").alias(
        "vector")).filter(F.col("vector").isNotNull()
                          & ~F.exists("vector", lambda x: x.isNull())))
    count, size = queries.agg(F.count(F.lit(1)), F.sum(F.size("vector") + 4)).first()
    blocks = queries.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(
        max(1, -(-count // QUERY_BLOCK)))).alias("block")).agg(
        F.collect_list(F.struct("query_id", "vector")).alias("queries")).select("queries")
    small = 8 * (size or 0) <= BROADCAST_BYTES
    pairs = item_blocks(items, item, vector).crossJoin(
        F.broadcast(blocks) if small else blocks.hint("shuffle_replicate_nl"))
    scored = pairs.mapInArrow(
        _best_of_blocks(item, k), f"query_id {kinds['query_id']}, {item} {kinds[item]}, _s double")
    return ranked(scored, item, k).select("query_id", item, F.col("_s").alias("score"), "rank")


def _best_of_blocks(item: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                names = np.array(ids.to_pylist())
                flat = np.frombuffer(batch.column("vectors")[row].as_buffer(), "<f8")
                v = flat.reshape(len(names), -1)
                asked = batch.column("queries")[row].values
                query_ids, vectors = asked.field("query_id"), asked.field("vector")
                same = np.flatnonzero(pc.list_value_length(vectors).to_numpy() == v.shape[1])
                if not len(same):
                    continue
                q = np.array(vectors.take(pa.array(same)).to_pylist(), dtype=np.float64)
                about = _unit(v) @ _unit(q).T
                where, found, scores = [], [], []
                for j in range(len(same)):
                    near = np.arange(len(names))
                    if len(near) > k:  # all that may belong to the k best, ties included
                        least = np.partition(about[:, j], -k)[-k]
                        near = np.flatnonzero(about[:, j] >= least - SLACK)
                    exact = cosine(v[near], q[j])
                    best = np.lexsort((names[near], -exact))[:k]
                    where.append(np.full(len(best), same[j]))
                    found.append(near[best])
                    scores.append(exact[best])
                yield pa.RecordBatch.from_arrays(
                    [query_ids.take(pa.array(np.concatenate(where))),
                     ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(scores))],
                    ["query_id", item, "_s"])
    return run


def centroids(items: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label (query_id, vector), summed exactly position by position."""
    parts = (items.select(F.col(label).alias("query_id"), F.posexplode(vector).alias("i", "x"))
             .groupBy("query_id", "i")
             .agg((F.sum(F.col("x").cast("double").cast("decimal(18,9)")).cast("double")
                   / F.count("x")).alias("x")))
    return parts.groupBy("query_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("vector"))


def citations(docs: DataFrame, queries: list[SearchQuery], k: int = fixed.CITATIONS,
              chars: int = fixed.CITATION_CHARS) -> DataFrame:
    """Best k documents per query with an excerpt, as one list per query.

    The hits are at most k per listed query, hence small enough to be broadcast.
    """
    hits = keyword_search(docs, queries, k)
    texts = docs.select("doc_id", "source", F.left("text", F.lit(chars)).alias("snippet"))
    joined = texts.join(F.broadcast(hits), "doc_id")
    return joined.groupBy("query_id").agg(F.sort_array(F.collect_list(
        F.struct("rank", "doc_id", "source", "snippet"))).alias("citations"))
