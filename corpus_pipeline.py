"""Corpus pipeline: five stages over ``documents``, each on all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the
shared folder and reads it back as the next stage's documents, so a lost executor costs a task
and never a stage. All stages but the last keep the columns of ``documents``.

Null and empty texts: scored like others by the classifier, rejected by the rules (fewer than ten
words). Null doc_ids and ids with several texts are rows like others; of repeated rows the join
keeps one. Equal scores, sizes or ids are settled by hashes, so reruns agree. An empty table gives
an empty result. Further columns of ``documents``, whatever their names, are carried to the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocast.llm.mixing import mix_documents
from regiocast.llm.ngram_join import near_duplicates
from regiocast.llm.packing import pack_documents
from regiocast.llm.quality_classifier import learn, score_column
from regiocast.llm.quality_rules import clean_documents
from regiocast.llm.text import fold, word_count
from regiocast.session import cut_lineage, scratch_path
from regiocast.sources.tables import Tables

THRESHOLD = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier scores below the threshold."""
    labels = Tables(spark, sf_dir).labels
    model = learn(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return docs.where(score_column(model)(F.col("text")) >= THRESHOLD)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base figures or lose half their words to line rules; the
    others go on without the lines that failed."""
    kept = clean_documents(docs, carry=True).where("kept")
    fresh = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("bigint")}
    return kept.select(*[fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that of the least doc_id (a null one last, equal
    ids by their texts' hashes), and one of repeated rows. Documents without words all stay."""
    key = F.xxhash64("text")
    found = cut_lineage(near_duplicates(docs, links_too=False, keys_too=True).where(
        "n_shingles > 0").select("doc_id", "text_key", "group_key"))
    first = found.groupBy("group_key").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")).select(
        F.col("best.doc_id").alias("_doc_id"), F.col("best.text_key").alias("_text_key"))
    times = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("_times"))
    chosen = cut_lineage(first.join(times, F.col("_doc_id").eqNullSafe(F.col("doc_id")) & (
        F.col("_text_key") == F.col("text_key"))).select("_doc_id", "_text_key", "_times"))

    def rows(condition: str) -> DataFrame:
        return docs.join(chosen.where(condition), docs.doc_id.eqNullSafe(F.col("_doc_id")) & (
            key == F.col("_text_key")), "left_semi")

    wordless = docs.where(word_count(F.col("text")) == 0)
    return rows("_times = 1").unionByName(rows("_times > 1").dropDuplicates(
        ["doc_id", "text"])).unionByName(wordless)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it, to the nearest whole number."""
    taken = mix_documents(docs).where("taken * 2 >= size AND size > 0").select(
        F.col("doc_id").alias("taken_doc_id"),
        F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int")
        .alias("copies")).groupBy("taken_doc_id").agg(F.max("copies").alias("copies"))
    rows = docs.select(F.struct("*").alias("row"))  # its names cannot clash with those above
    return rows.join(taken, F.col("row.doc_id").eqNullSafe(F.col("taken_doc_id"))).select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 1024 ids."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # neither compressed sizes nor token ids can be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents of ``sf_dir``."""
    docs = Tables(spark, sf_dir).documents
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
