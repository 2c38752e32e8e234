"""Deterministic samples, limits per group and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rank_key(seed: int, *parts: str) -> Column:
    """A rank that depends on the seed and the row's key only."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p).cast("string") for p in parts]))


def first_per_group(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group.

    Groups may be of any size: Spark keeps n rows per group and task before the
    shuffle (window group limit).
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def stratified(rows: DataFrame, target: str, key: str, targets: int, quota: int, n: int | None = None, seed: int = 42) -> DataFrame:
    """Two stages: `targets` targets by rank, of each `quota` items by rank, of those n by rank."""
    chosen = rows.select(target).distinct().orderBy(rank_key(seed, target)).limit(targets)
    few = first_per_group(rows.join(chosen, target, "left_semi"), [target], [rank_key(seed, target, key)], quota)
    return few if n is None else few.orderBy(rank_key(seed, target, key)).limit(n)


# How many targets each source contributes, given how many there are.
def target_share(source: str, n: int) -> int:
    """Targets to sample of a source with n targets."""
    least = {"github": (5, 50), "jira": (3, 100), "slack": (10, 30), "google": (5, 50)}
    if source in least:
        floor, per = least[source]
        return max(floor, n // per)
    return 5 if source == "confluence" else min(n, 5)


def numeric_ts(ts: Column) -> Column:
    """A message time as a number; 0 where it is none."""
    return F.coalesce(ts.try_cast("double"), F.lit(0.0))
