"""Job state: an append-only log replayed in batch or as a stream, legal transitions, windows over event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window as W

# The transitions of a repository's job.
LEGAL = [("pending", "cloning"), ("pending", "skipped"), ("cloning", "ready"), ("cloning", "failed"), ("ready", "processing"), ("processing", "complete"), ("processing", "failed"), ("failed", "pending"), ("cloning", "pending"), ("processing", "pending")]
RECORD = "repository_id string, state string, attempts int, error string, updated string"


def read_log(lines: DataFrame) -> DataFrame:
    """Records of a JSON-lines log with the number of their line; a line that isn't whole (a torn tail) is left out.

    lines: (value string, line_no bigint).
    """
    r = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", RECORD, {"mode": "PERMISSIVE"}))
    return r.where("r.repository_id is not null and r.state is not null").select("r.*", "line_no")


def replay(log: DataFrame) -> DataFrame:
    """The last record of each repository."""
    rest = [c for c in log.columns if c != "repository_id"]
    return log.groupBy("repository_id").agg(F.max_by(F.struct(*rest), "line_no").alias("r")).select("repository_id", "r.*")


def resumable(log: DataFrame, states: Sequence[str] = ("pending", "cloning", "processing", "failed")) -> DataFrame:
    return replay(log).where(F.col("state").isin(list(states)))


def check_transitions(log: DataFrame, key: str, state: str, order: Sequence[str], legal: Sequence[tuple[str, str]] = LEGAL) -> DataFrame:
    """Adds ``problem``: illegal_transition where a record doesn't follow legally from the one before it, else null."""
    before = F.lag(state).over(W.partitionBy(key).orderBy(*order))
    pair = F.concat_ws(">", before, F.col(state))
    return log.withColumn("problem", F.when(before.isNotNull() & ~pair.isin([f"{a}>{b}" for a, b in legal]), F.lit("illegal_transition")))


def transitions_stream(log: DataFrame, legal: Sequence[tuple[str, str]] = LEGAL) -> DataFrame:
    """The streaming form over (repository_id, state, line_no): state is kept per repository, and illegal records come out
    with a reason instead of stopping the stream."""
    allowed = set(legal)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for pdf in batches:
            for s, n in pdf.sort_values("line_no")[["state", "line_no"]].itertuples(index=False):
                bad = last is not None and (last, s) not in allowed
                out.append((key[0], s, n, "illegal_transition" if bad else None))
                last = last if bad else s
        state.update((last,))
        yield pd.DataFrame(out, columns=["repository_id", "state", "line_no", "problem"])

    return log.groupBy("repository_id").applyInPandasWithState(step, "repository_id string, state string, line_no bigint, problem string", "last string", "append", GroupStateTimeout.NoTimeout)


def windowed(events: DataFrame, ts: str, width: str, key: str, value: str, late: str | None = None) -> DataFrame:
    """Counts and sums per event-time window and key, for a batch or (with ``late``) a stream with a watermark."""
    e = events.withWatermark(ts, late) if late else events
    return e.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
