"""Caps per contributor as nested (laminar) limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import fresh, jobs_once, owner
from tessel.operators.skew import capped_rank


def nested_caps(df: DataFrame, levels: Sequence[tuple[str, int | Column]], order: Sequence[Column], salt_on: Sequence[str], out: str = "dropped_by") -> DataFrame:
    """Adds ``out``: null for rows that are kept, else the level whose cap dropped the row.

    Levels go from the innermost outwards (author, domain, parent organisation). The families of records are nested, so
    keeping the best rows greedily level by level is optimal for any quality order. Each pass ranks only the survivors
    of the pass before, in (key, salt) first, so a contributor with a third of all rows never sits in one task. Rows
    whose key of a level is null aren't limited by that level. Ties in ``order`` should be broken by a unique column.
    """
    r, alive = fresh(df, "rank__"), None
    df = df.withColumn(out, F.lit(None).cast("string"))
    for name, cap in levels:
        key = fresh(df, "key__")
        # rows dropped before, and rows without a key, are spread over keys of their own and not limited
        alive = F.col(out).isNull() & F.col(f"`{name}`").isNotNull()
        ranked = capped_rank(df.withColumn(key, alive), [name, key], order, int(cap), salt_on, r)
        df = ranked.withColumn(out, F.when(F.col(key) & F.col(r).isNull(), F.lit(name)).otherwise(F.col(out))).drop(key, r)
    return df


def cap_from_share(total: int, share: float) -> int:
    """A cap given as a share of all records, at least 1."""
    return max(1, int(total * share))


def samples_by_owner(samples: DataFrame, jobs: DataFrame) -> DataFrame:
    """Distinct samples with the owner and priority of their repository: (sample_id, repository_id, owner, host, priority).

    Repeated rows of a sample count once; a sample without a repository in jobs, or of one without an owner, has owner null.
    """
    s = samples.where("sample_id is not null").groupBy("sample_id").agg(F.min("repository_id").alias("repository_id"))
    j = jobs_once(jobs.select("repo_id", "full_name", "priority", "attempts", "started", "finished")).select(F.col("repo_id").alias("repository_id"), owner(F.col("full_name")).alias("owner"), "priority")
    return s.join(j, "repository_id", "left").select("sample_id", "repository_id", "owner", F.regexp_extract("repository_id", "^([^/]+)/", 1).alias("host"), "priority")


def best_first() -> list[Column]:
    return [F.desc_nulls_last("priority"), F.asc("sample_id")]
