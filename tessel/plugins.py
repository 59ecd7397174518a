"""The places where users put their own parts: enrichers, document lookups, writers, manifest readers, job stores."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.sources.files import read_lines, read_manifest, write_jsonl
from tessel.streaming.state import StateTable


class Enricher(Protocol):
    """Adds facts to batches of samples; ``schema`` is that of what it returns, with sample_id, status and reason first."""

    schema: str

    def enrich(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]: ...


class DocumentLookup(Protocol):
    def find(self, samples: DataFrame) -> DataFrame: ...


class RecordWriter(Protocol):
    def write(self, records: DataFrame, path: str) -> DataFrame: ...


class ManifestReader(Protocol):
    def read(self, spark: SparkSession, path: str) -> DataFrame: ...


class JobStore(Protocol):
    def load(self) -> DataFrame: ...

    def save(self, records: DataFrame) -> None: ...


class DocumentTable:
    """A DocumentLookup over a table of files (repository_id, relative_path, sha256, content): samples with the content of their
    file, or the reason why there is none. The digests decide before any content is joined."""

    def __init__(self, files: DataFrame):
        self.files = files

    def find(self, samples: DataFrame) -> DataFrame:
        key = ["repository_id", "relative_path"]
        have = self.files.groupBy(*key, F.col("sha256").alias("source_sha256")).agg(F.min("content").alias("content"), F.lit(True).alias("same"))
        there = self.files.select(*key, F.lit(True).alias("there")).distinct()
        j = samples.join(have, [*key, "source_sha256"], "left").join(there, key, "left")
        reason = F.when(F.col("same"), None).when(F.col("there"), "document_text_mismatch").otherwise("document_not_in_workspace")
        return j.withColumn("reason", reason).drop("same", "there")


class LineWriter:
    """A RecordWriter of JSON lines, whole or not at all."""

    def write(self, records: DataFrame, path: str) -> DataFrame:
        return write_jsonl(records, path)


class ManifestFile:
    """A ManifestReader of a text, csv or jsonl file."""

    def __init__(self, kind: str):
        self.kind = kind

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return read_manifest(read_lines(spark, path), self.kind)


class JobTable(StateTable):
    """A JobStore kept in versions of Parquet."""


class Overdue(Exception):
    """A sample took longer than it may."""


def limited(seconds: float | None, run: Callable[[], list[pd.DataFrame]]) -> list[pd.DataFrame]:
    """What run gives, or Overdue after so many seconds. Tasks run in the main thread of their worker, where a timer can end them."""
    if seconds is None or threading.current_thread() is not threading.main_thread():
        return run()

    def ring(*_: object) -> None:
        raise Overdue

    old = signal.signal(signal.SIGALRM, ring)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        return run()
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, old)


def enriched(samples: DataFrame, enricher: Enricher, required: bool = False, seconds: float | None = None) -> DataFrame:
    """Samples with their facts left-joined. A batch whose enricher raises, or takes more than ``seconds``, is done again sample by
    sample, and those that fail come out as failed with the reason (timeout, or the error's name), so one bad sample
    doesn't stop the run; with ``required`` samples without facts are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            try:
                yield from limited(seconds, lambda: list(enricher.enrich(iter([pdf]))))  # noqa: B023
            except Exception:  # the reason is found for each sample
                for i in range(len(pdf)):
                    one = pdf.iloc[i : i + 1]
                    try:
                        yield from limited(seconds, lambda: list(enricher.enrich(iter([one]))))  # noqa: B023
                    except Exception as e:
                        yield pd.DataFrame({"sample_id": one["sample_id"], "status": "failed", "reason": "timeout" if isinstance(e, Overdue) else type(e).__name__})

    facts = samples.mapInPandas(run, enricher.schema)
    joined = samples.join(facts, "sample_id", "left")
    return joined.where(F.col("status") == "resolved") if required else joined
