"""Joins that stay balanced when one key holds much of a table.

AQE can split a skewed partition only where both join sides come straight from a
shuffle, which is not so after a window or an aggregation on the same key, and
never on the side an outer join looks up. So frequent keys are found by a sketch,
in one pass over the keys, and their rows are spread by a salt in the one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

# A key with more than one in so many rows is frequent. There are fewer than so many,
# which bounds what the driver gets and how often rows of the other side are repeated.
SHARE = 1_000
# Stands for frequent keys where every key is one, because there are few.
ALL = None

_SALT = "__salt"


def frequent_keys(df: DataFrame, *keys: Sequence[str], share: int = SHARE) -> list[list[int]]:
    """Hashes of the frequent keys, for each of several keys in one pass over ``df``.

    A mergeable sketch of bounded size counts at least what a frequent key has, up
    to one in ten times ``share`` rows, so none is missed; a few others may pass.
    """
    tracked = min(10 * share, 1_000_000)
    hashed = df.select(*[F.xxhash64(*on).alias(f"k{i}") for i, on in enumerate(keys)])
    tops = [F.expr(f"approx_top_k(k{i}, {share}, {tracked})").alias(f"k{i}") for i in range(len(keys))]
    row = hashed.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    return [[t["item"] for t in row[f"k{i}"] or [] if t["count"] * share > row["n"]] for i in range(len(keys))]


def _salts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)


def _frequent(on: Sequence[str], frequent: Sequence[int] | None) -> Column:
    return F.lit(True) if frequent is ALL else F.xxhash64(*on).isin(list(frequent))


def _spread(df: DataFrame, on: Sequence[str], frequent: Sequence[int] | None) -> DataFrame:
    """Rows of frequent keys dealt out to salts by their content."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(_salts(df)))
    return df.withColumn(_SALT, F.when(_frequent(on, frequent), salt).otherwise(F.lit(0).cast("long")))


def _repeated(df: DataFrame, on: Sequence[str], frequent: Sequence[int] | None) -> DataFrame:
    """Rows of frequent keys once for every salt."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(_salts(df) - 1).cast("long"))
    once = F.array(F.lit(0).cast("long"))
    return df.withColumn(_SALT, F.explode(F.when(_frequent(on, frequent), every).otherwise(once)))


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    frequent: Sequence[int] | None = (),
) -> DataFrame:
    """``big`` joined to ``small``, where single keys may fill much of ``big``.

    ``small`` has one row per key; ``how`` is inner, left, left_semi or left_anti.
    ``frequent`` are the keys of ``big`` to spread, as ``frequent_keys`` finds them
    (null among them), or ``ALL`` where there are few keys. Each side is read once,
    and without frequent keys this is the plain join.
    """
    on = list(on)
    if frequent is not ALL and not frequent:
        return big.join(small, on, how)
    joined = _spread(big, on, frequent).join(_repeated(small, on, frequent), [*on, _SALT], how)
    return joined.drop(_SALT)


def left_join_hot_right(
    left: DataFrame, right: DataFrame, on: Sequence[str], frequent: Sequence[int] = ()
) -> DataFrame:
    """Left join of unique ``left`` keys to a side with very many rows for some keys.

    ``frequent`` are keys of ``right``. Rows of these are spread, and the left row is
    repeated for every salt; a salt that got none of them gives no row, since a
    frequent key has a match in another.
    """
    on = list(on)
    if not frequent:
        return left.join(right, on, "left")
    spread = _spread(right, on, frequent).withColumn("__matched", F.lit(True))
    joined = _repeated(left, on, frequent).join(spread, [*on, _SALT], "left")
    kept = F.col("__matched").isNotNull() | ~_frequent(on, frequent)
    # A null key is never matched: its row stays once.
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    return joined.filter(kept | (null_key & (F.col(_SALT) == 0))).drop(_SALT, "__matched")


def child_counts(
    parents: DataFrame, children: DataFrame, key: str, counted: str, alias: str
) -> DataFrame:
    """Parents with the number of non-null ``counted`` children; none counts 0.

    ``key`` must be unique in ``parents``. Children are counted before the join,
    so a parent with a third of all children costs one row per map task.
    """
    counts = (
        children.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias(alias))
    )
    joined = parents.join(counts, key, "left")
    return joined.withColumn(alias, F.coalesce(F.col(alias), F.lit(0).cast("bigint")))


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, field: str, alias: str = "n_rows"
) -> DataFrame:
    """Child keys without a parent, with their row counts; null keys are no orphans."""
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias(alias)
    )
    known = parent.select(F.col(field).alias(column)).distinct()
    return used.join(known, column, "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows without a parent.

    The missing keys are found first, on one column, and counted before they are
    joined; of each there is one row, so Spark broadcasts them if they are few, as
    in sound data, and the child table is then not shuffled.
    """
    missing = written(orphan_keys(child, column, parent, field).select(column), "orphan-keys")
    return child.join(missing, column, "left_semi").select(*child.columns)
