"""From documents to packed training sequences, in five stages.

Each stage works on all documents that the one before kept, and its result is
written as Parquet and read again. ``run`` does so below ``spark.checkpoint.dir``.
All but the last return the columns of documents; ``n_chars`` follows the text.
Documents with a null id pass every filter that goes by id.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, documents
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.packing import pack_texts
from tidemark.llm.pii import redact_pii
from tidemark.llm.quality import quality_score, train_quality
from tidemark.session import configure, written


# What a stage that changes texts makes anew; all other columns go along as they are.
_OF_TEXT = ("text", "n_chars")


def _with_text(docs: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents with the text that ``change`` gives them; other columns travel apart, under any name."""
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in _OF_TEXT])
    changed = change(docs.select("doc_id", "text", rest.alias("row")))
    kinds = dict(docs.dtypes)
    made = {"text": F.col("text"), "n_chars": F.char_length("text").cast(kinds.get("n_chars", "long"))}
    return changed.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones; the fold of its query is held out."""
    spark = configure(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_quality(docs, labels, keep=F.crc32(F.col("_key").cast("string")) % 3 != 1)
    return docs.filter(quality_score("text", model) >= 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that an earlier one holds."""
    configure(spark)
    return _with_text(docs, dedup_lines)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    configure(spark)
    gone = near_duplicates(docs, words=5, percent=80).filter("not kept").select("doc_id").distinct()
    # A sort-merge join at every size: these ids grow with the input.
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    bounded_batches(configure(spark))
    return _with_text(docs, lambda rows: rows.withColumn("text", redact_pii("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of up to 1024 tokens."""
    configure(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack_texts(docs, tokenizer, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

# Models and sketches are nothing SQL can say; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
