"""Filling containers of fixed capacity: best-fit decreasing with a segment tree over remaining capacities.

Best-fit decreasing takes the items by size, largest first, and puts each into the open container with the least
room that still holds it. Items of one size are interchangeable, so the packing is decided over the histogram of
sizes (at most ``capacity`` numbers, whatever the input) and then joined back to the items by their number within
their size. The result is the packing that best-fit decreasing gives item by item.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import cut
from tessel.operators.skew import numbered

CAPACITY = 2048
#: Parts of the items of one size that are numbered apart, so that a size that most items have is spread over tasks.
SALTS = 256


class RoomTree:
    """A segment tree over remaining capacities 0..capacity: each leaf knows whether containers with that room are open."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.width)

    def put(self, room: int, is_open: bool) -> None:
        i = room + self.width
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, size: int) -> int | None:
        """The least open room of at least ``size``, in logarithmic time: up to the first subtree on the right that is open, then down its left edge."""
        i = size + self.width
        if not self.open[i]:
            while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
        while i < self.width:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.width


def plan(histogram: Mapping[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (size, first, end, container, per): items first..end-1 of that size go to container + (number - first) // per; and the number of containers.

    Containers with the same room are held as runs of ids. Filling the tightest container with equal items goes on in
    that container until another doesn't fit, as its room stays the least that is large enough.
    """
    tree, runs, rows, bins = RoomTree(capacity), {}, [], 0

    def add(room: int, start: int, n: int) -> None:
        if n and room:
            runs.setdefault(room, []).append((start, n))
            tree.put(room, True)

    for size in sorted((s for s, n in histogram.items() if n and 0 < s <= capacity), reverse=True):
        done, total = 0, histogram[size]
        while done < total:
            room = tree.tightest(size)
            if room is None:
                per = capacity // size
                n = -(-(total - done) // per)
                start, bins, room = bins, bins + n, capacity
            else:
                per = room // size
                start, n = runs[room].pop()
                if not runs[room]:
                    tree.put(room, False)
            full = min(n, (total - done) // per)
            rest = min(total - done - full * per, per) if full < n else 0
            took = full * per + rest
            rows.append((size, done, done + took, start, per))
            add(room - per * size, start, full)
            if rest:
                add(room - rest * size, start + full, 1)
            left = n - full - (1 if rest else 0)
            add(room, start + full + (1 if rest else 0), left)
            done += took
    return rows, bins


def pieces(items: DataFrame, key: str, size: Column, capacity: int) -> DataFrame:
    """(key, piece, start, size): an item of up to the capacity is one piece; a larger one is cut into full pieces and a rest.

    Sizes of null or below 1 give no piece.
    """
    n = size.cast("bigint")
    out = items.select(F.col(key).alias("item"), n.alias("n")).where("n >= 1").select("item", "n", F.posexplode(F.when(F.col("n") >= 1, F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(capacity).cast("bigint")))).alias("piece", "start"))
    return out.select("item", "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(capacity)).cast("int").alias("size"))


def pack(items: DataFrame, key: str, size: Column, capacity: int = CAPACITY) -> DataFrame:
    """(item, piece, start, size, container) with containers numbered from 0; size and start in the items' unit.

    ``key`` should be unique; rows that repeat a key are items of their own. No container holds more than the capacity,
    and only items larger than the capacity are cut. Which of several equal items goes where follows the hash of the key.
    """
    spark = items.sparkSession
    p = cut(pieces(items, key, size, capacity))
    hist = {r[0]: r[1] for r in p.groupBy("size").count().collect()}  # at most `capacity` rows
    rows, _ = plan(hist, capacity)
    n = numbered(p, ["size"], [F.xxhash64("item", "piece"), F.col("item"), F.col("piece")], ["item", "piece"], "number__", SALTS)
    runs = pd.DataFrame(rows, columns=["size", "first", "end", "container", "per"]).sort_values(["size", "first"]).astype("int64") if rows else pd.DataFrame({c: [0] for c in ("size", "first", "end", "container", "per")})
    # the runs depend on the histogram alone: a few per size and open room, whatever the number of items
    known = spark.sparkContext.broadcast({c: runs[c].to_numpy() for c in runs})

    @F.pandas_udf("bigint")
    def container(size: pd.Series, number: pd.Series) -> pd.Series:
        r = known.value
        keys = (r["size"] << 44) + r["first"]
        at = np.searchsorted(keys, (size.to_numpy().astype("int64") << 44) + number.to_numpy(), side="right") - 1
        return pd.Series(r["container"][at] + (number.to_numpy() - r["first"][at]) // r["per"][at])

    return n.select("item", "piece", "start", "size", container("size", "number__").alias("container"))


def waste(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, items, used, room, fill): how many containers a packing takes, and what part of their room is used."""
    per = packed.groupBy("container").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("items"))
    all_ = per.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.coalesce(F.sum("load"), F.lit(0)).cast("bigint").alias("used"), F.max("load").alias("fullest"))
    return all_.withColumn("room", F.col("containers") * capacity - F.col("used")).withColumn("fill", F.col("used") / F.nullif(F.col("containers") * capacity, F.lit(0)))
