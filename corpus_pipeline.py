"""A corpus from raw documents to sampled piece ids, stage by stage.

Every stage takes what its predecessor kept, read again from Parquet, and all
but the last return the columns of ``documents``. What a stage has staged in
the shared folder is deleted when the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import gam, jaccard, pieces, repeats, tiling
from lakeloom.llm.common import durable, table
from lakeloom.session import collecting, drop, tune

#: Bytes of a string that counts as a repeated passage: 50 words of some four letters. The length of op5 is its own.
PASSAGE = 240

_staged: dict[str, list[str]] = {}


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tune(spark)
        old = _staged.setdefault(spark.sparkContext.applicationId, [])
        drop(spark, old)
        with collecting() as paths:
            found = work(spark, docs, sf_dir)
        old += paths
        return found

    run.__name__, run.__doc__ = work.__name__, work.__doc__
    return run


@_stage
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    model = gam.quality_model(docs, table(spark, sf_dir, "labels"))
    return gam.keep_scored(docs, model, gam.GOOD)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; rows of one id with different texts all stay, and rows without an id."""
    gone = jaccard.ngram_jaccard_join(docs).filter("NOT kept").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").withColumn("__digest", F.sha2(F.col("text").cast("binary"), 256))
    return named.dropDuplicates(["doc_id", "__digest"]).select(docs.columns).union(docs.filter("doc_id IS NULL"))


@_stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated strings of ``PASSAGE`` bytes; ``n_chars`` follows the text."""
    cut = (repeats.remove_repeats(docs, length=PASSAGE).filter("n_removed > 0")
           .groupBy(F.col("digest").alias("__digest")).agg(F.first("kept_text").alias("__kept")))
    own = docs.withColumn("__digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    joined = own.join(cut, "__digest", "left")
    new = {"text": F.coalesce("__kept", "text"), "n_chars": F.when(F.col("__kept").isNotNull(), F.char_length("__kept")).otherwise(F.col("n_chars"))}
    return joined.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else c for c in docs.columns])


@_stage
def leaked_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows without an id stay."""
    leaks = tiling.decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


@_stage
def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document."""
    return pieces.sample_pieces(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("benchmark_decontamination", leaked_benchmarks),
    ("sentencepiece_encoding", piece_ids),
]
#: Trained models and sampling cannot be stated in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    held: list[str] = []
    for name, stage in STAGES[:-1]:
        with collecting() as made:
            docs = durable(stage(spark, docs, sf_dir), name)
        drop(spark, held + made[:-1])
        held = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
