"""Exact dedup against a persistent digest index."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.session import shared_dir, written


class DigestIndex:
    """Digests of all texts taken in so far, as a table bucketed and sorted by digest.

    ``append`` groups new rows by digest, keeps the groups the index does not
    hold (a sort-merge anti-join; the index side is read in its buckets, without
    a shuffle) and appends them. Appending the same rows again adds nothing, so
    a job that died after its append can simply run again.

    One index has one writer at a time. ``path`` lies on shared storage and keeps
    the number of buckets beside the data, so a later session opens the index as
    it was made, whatever its own settings; another number is refused. ``close``
    takes the table out of the catalog and leaves the files.
    """

    COLUMNS = "text_sha256 STRING, keep_id BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or shared_dir(spark, "digest-index")).rstrip("/")
        made_with = self._made_with()
        if made_with and buckets not in (None, made_with):
            raise ValueError(f"the index at {self.path} has {made_with} buckets, not {buckets}")
        # Not below the shuffle partitions: else the join deals the index out anew.
        self.buckets = made_with or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not made_with:
            made = spark.range(0, 1, 1, 1).select(F.lit(self.buckets).alias("buckets"))
            made.write.mode("overwrite").parquet(self._facts)
        self.name = "digests_" + hashlib.sha256(self.path.encode()).hexdigest()[:40]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    @property
    def _facts(self) -> str:
        return f"{self.path}-made-with"

    def _made_with(self) -> int | None:
        """Buckets of the index at this path; None if there is none yet."""
        try:
            return self.spark.read.schema("buckets int").parquet(self._facts).first()[0]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add the groups (text_sha256, keep_id) whose digest is new."""
        fresh = groups.select("text_sha256", "keep_id").join(
            self.table().select("text_sha256").hint("merge"), "text_sha256", "left_anti"
        )
        # Written aside first: a table can't be appended to by a plan that reads it.
        (
            written(fresh, "digests-new")
            .repartition(self.buckets, "text_sha256")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def exact_dedup(
    docs: DataFrame,
    index: DigestIndex | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=lambda text: text,
) -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if their SHA-256 after ``normalise`` (none by default) is;
    null counts as empty. Of equal new texts the largest id stays, unless the
    index already holds the text: then its ``keep_id`` stays and all new rows go.
    ``group_size`` counts the new rows with that text. A row that is there twice
    with the same id is one document: both rows say the same. A null id is
    smaller than any other; if a text has null ids only, ``keep_id`` is null and
    its rows stay. Other columns of any name are ignored. An empty table gives
    an empty result.
    """
    own = None if index else DigestIndex(docs.sparkSession)
    index = index or own
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            digest(normalise(text_of(text_col))).alias("text_sha256"),
        ),
        "digests",
    )
    groups = written(
        rows.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ),
        "digest-groups",
    )
    index.append(groups)
    # One row per text, in a plain table: the join with the rows of a very common
    # text can then be split at run time.
    held = written(
        groups.select("text_sha256", "group_size").join(
            index.table().hint("merge"), "text_sha256"
        ),
        "digests-held",
    )
    if own:
        own.close()
    joined = rows.join(held, "text_sha256")
    return joined.select(
        F.col("doc_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
