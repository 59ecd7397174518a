"""What the training-data operators share: table access, labels, one row per repository, stable hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.operators.skew import fresh
from tessel.session import cut, shared_dir, table

__all__ = ["cut", "fresh", "jobs_once", "label", "owner", "shared_dir", "table", "unit_hash", "NO_LABEL"]

# Group labels that say nothing.
NO_LABEL = ["", "n/a", "none", "unknown", "-"]


def label(c: Column) -> Column:
    """A group label in lower case and trimmed, null if it says nothing."""
    x = F.lower(F.trim(F.regexp_replace(c, r"^\s+|\s+$", "")))
    return F.when(~x.isin(NO_LABEL), x)


def owner(full_name: Column) -> Column:
    """First path segment of owner/name, ignoring case, spaces and stray slashes; null if there is none."""
    bare = F.regexp_replace(F.lower(full_name), r"\s+", "")
    return F.nullif(F.regexp_extract(bare, r"^/*([^/]+)", 1), F.lit(""))


def jobs_once(jobs: DataFrame) -> DataFrame:
    """One row per repo_id: the latest attempt (highest attempts, then latest times, then the row's own text)."""
    rest = [c for c in jobs.columns if c != "repo_id"]
    best = F.max_by(F.struct(*rest), F.struct(*_order(jobs)))
    return jobs.where("repo_id is not null").groupBy("repo_id").agg(best.alias("j")).select("repo_id", "j.*")


def _order(jobs: DataFrame) -> list[Column]:
    by = [F.coalesce(F.col("attempts"), F.lit(-1))] if "attempts" in jobs.columns else []
    by += [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("finished", "started") if c in jobs.columns]
    return [*by, F.xxhash64(*[F.col(c) for c in jobs.columns])]


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of their hash."""
    h = F.xxhash64(*parts)
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / F.lit(float(1 << 52))


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    return df.select(*columns) if columns else df
