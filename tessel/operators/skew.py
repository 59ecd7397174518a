"""Ranking and numbering that keep a hot key off a single task.

A plain ``row_number() over (partition by key)`` sorts all rows of a key in one task. Here rows are first
ranked within (key, salt); only rows that can still be within the limit meet again under the bare key, so
the second pass sees at most ``limit * salts`` rows of any key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

SALTS = 64


def salts_for(df: DataFrame) -> int:
    """How many parts a hot key is ranked in: as many as the session has shuffle partitions, ``SALTS`` at least. Ranks don't
    depend on it."""
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return max(SALTS, int(n)) if str(n).isdigit() else SALTS


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case of its columns."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def capped_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, salt_on: Sequence[str], out: str = "rank", salts: int | None = None) -> DataFrame:
    """Adds ``out``: the 1-based rank within keys for the first ``limit`` rows of each key, null for rows beyond.

    ``order`` must be a total order over the rows of a key for a repeatable result. Null keys form a key of their own.
    """
    s, r = fresh(df, "salt__"), fresh(df, f"{out}_in_salt__")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_on]), F.lit(salts or salts_for(df)))
    keyed = [F.col(f"`{k}`") for k in keys]
    first = df.withColumn(s, salt)
    first = first.withColumn(r, F.row_number().over(W.partitionBy(*keyed, s).orderBy(*order)))
    # rows beyond the limit within their salt stay where they are; the others meet under salt -1
    first = first.withColumn(s, F.when(F.col(r) > limit, F.col(s)).otherwise(F.lit(-1)))
    second = F.row_number().over(W.partitionBy(*keyed, s).orderBy(*order))
    return first.withColumn(out, F.when(F.col(s) == -1, second)).withColumn(out, F.when(F.col(out) <= limit, F.col(out))).drop(s, r)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], salt_on: Sequence[str], out: str, salts: int = SALTS) -> DataFrame:
    """Adds ``out``: a dense 0-based number within keys, unique per row. The order is by salt, then by ``order``.

    Only the counts of (key, salt) pass through a window over the bare key: at most ``salts`` rows of any key.
    """
    s, n, base = fresh(df, "salt__"), fresh(df, "n__"), fresh(df, "base__")
    keyed = [F.col(f"`{k}`") for k in keys]
    salted = df.withColumn(s, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_on]), F.lit(salts)))
    counts = salted.groupBy(*keyed, s).agg(F.count(F.lit(1)).alias(n))
    before = F.coalesce(F.sum(n).over(W.partitionBy(*keyed).orderBy(s).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(f"`{k}`").alias(f"k{i}__") for i, k in enumerate(keys)], F.col(s).alias("s__"), before.alias(base))
    at = F.col(s) == F.col("s__")
    for i, k in enumerate(keys):
        at = at & F.col(f"`{k}`").eqNullSafe(F.col(f"k{i}__"))
    local = salted.withColumn(out, F.row_number().over(W.partitionBy(*keyed, s).orderBy(*order)) - 1)
    joined = local.join(counts, at, "left").withColumn(out, F.col(out) + F.coalesce(F.col(base), F.lit(0)))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col(out).cast("bigint").alias(out))
