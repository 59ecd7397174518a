"""State of runs: tables that are replaced whole, recovery after a crash, markers of finished steps, measures of a step."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def path_of(spark: SparkSession, path: str):
    """(file system, path) of Hadoop: local, or whatever the session is set up for."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class StateTable:
    """Rows keyed by ``key``, kept as Parquet in numbered versions; the newest whole version counts.

    A save writes a new version beside the old one, and the commit protocol's _SUCCESS makes it whole; a crash leaves the
    old one in place. ``upsert`` replaces the rows of the keys it is given.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def versions(self) -> list[int]:
        fs, p = path_of(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[1:]) for n in names if n[1:].isdigit() and done(self.spark, f"{self.path}/{n}"))

    def load(self) -> DataFrame | None:
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/v{v[-1]}") if v else None

    def save(self, rows: DataFrame) -> None:
        v = self.versions()
        rows.write.mode("overwrite").parquet(f"{self.path}/v{(v[-1] if v else 0) + 1}")
        for old in v[:-1]:  # the one before stays, for readers that hold it
            fs, p = path_of(self.spark, f"{self.path}/v{old}")
            fs.delete(p, True)

    def upsert(self, rows: DataFrame) -> None:
        old = self.load()
        self.save(rows if old is None else old.join(rows.select(self.key), self.key, "left_anti").unionByName(rows, allowMissingColumns=True))


def recovered(jobs: DataFrame, state: str, running: Sequence[str] = ("running", "cloning", "processing"), back: str = "pending") -> DataFrame:
    """Jobs as they are to be taken up after a crash: states that only a live run has go back; ``recovered`` says which."""
    cut_off = F.coalesce(F.col(state).isin(list(running)), F.lit(False))
    return jobs.withColumn("recovered", cut_off).withColumn(state, F.when(F.col("recovered"), F.lit(back)).otherwise(F.col(state)))


def done(spark: SparkSession, path: str) -> bool:
    """Whether a step's output was written whole."""
    fs, p = path_of(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(p))


def step(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The output of a step: read if it was written whole, else made and written."""
    if not done(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """df with measures that are taken while it is written anyhow (a count, sums); read them from the observation after."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in measures.items()]), o


class Profile:
    """Driver-side timings of phases: count, total and mean in milliseconds, by name."""

    def __init__(self) -> None:
        self.phases: dict[str, list[float]] = {}

    def time(self, phase: str, run: Callable):
        began = time.perf_counter()
        try:
            return run()
        finally:
            self.phases.setdefault(phase, []).append((time.perf_counter() - began) * 1000)

    def snapshot(self) -> dict[str, dict[str, float]]:
        return {k: {"count": len(v), "total_ms": round(sum(v), 1), "mean_ms": round(sum(v) / len(v), 3)} for k, v in sorted(self.phases.items())}


def report(title: str, seconds: dict[str, float], before: dict[str, float] | None = None) -> str:
    """A Markdown table of timings, with the change against an earlier run where there is one."""
    rows = [f"# {title}", "", "| Query | s | before | change |", "|-|-|-|-|"]
    for q, s in sorted(seconds.items()):
        b = (before or {}).get(q)
        rows.append(f"| {q} | {s:.3f} | {'' if b is None else f'{b:.3f}'} | {'' if not b else f'{(s - b) / b:+.0%}'} |")
    return "\n".join([*rows, f"| all | {sum(seconds.values()):.3f} | {'' if not before else f'{sum(before.values()):.3f}'} | |", ""])
