"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessel.llm.common import cut

#: Hash blocks per source: the boundary of a budget falls into one block, so one task orders 1/BLOCKS of a source at most.
BLOCKS = 4096


def tempered(shares: Mapping[str, float], exponent: float) -> dict[str, float]:
    """Shares to the power of the exponent, normalised: 1 keeps them, 0 makes them even."""
    p = {s: x**exponent if x > 0 else 0.0 for s, x in shares.items()}
    total = sum(p.values())
    return {s: x / total for s, x in p.items()} if total else p


def entropy(p: Mapping[str, float]) -> float:
    return -sum(x * math.log(x) for x in p.values() if x > 0)


def bisect(holds, lo: float, hi: float, steps: int = 60) -> float:
    """The least x in [lo, hi] at which a monotone condition holds; hi if it holds nowhere."""
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if holds(mid) else (mid, hi)
    return hi


def exponent_for_entropy(shares: Mapping[str, float], target: float) -> float:
    """The exponent in [0, 1] at which the tempered shares have the target entropy (which falls as the exponent rises)."""
    return bisect(lambda a: entropy(tempered(shares, a)) <= target, 0.0, 1.0)


def weights_within_repeats(have: Mapping[str, float], target: Mapping[str, float], repeats: Mapping[str, float], budget: float) -> tuple[dict[str, float], float]:
    """(weights, exponent): the target shares bent towards the natural ones, just so far that no source is repeated too often.

    The bent weight of a source is target * (natural / target) ** exponent, normalised: exponent 0 gives the targets,
    1 the natural shares. Sources without target or without tokens get none.
    """
    live = {s: t for s, t in target.items() if t > 0 and have.get(s, 0) > 0}
    if not live:
        return {}, 0.0
    total = sum(have[s] for s in live)

    def bent(x: float) -> dict[str, float]:
        w = {s: t * (have[s] / total / t) ** x for s, t in live.items()}
        z = sum(w.values())
        return {s: v / z for s, v in w.items()}

    fits = lambda x: all(w * budget <= have[s] * repeats.get(s, 1) * (1 + 1e-9) for s, w in bent(x).items())
    x = 0.0 if fits(0.0) else bisect(fits, 0.0, 1.0)
    return bent(x), x


def largest_budget(have: Mapping[str, float], target: Mapping[str, float], repeats: Mapping[str, float]) -> float:
    """The most tokens at which every source with a target holds exactly its share within its repeats."""
    live = {s: t for s, t in target.items() if t > 0 and have.get(s, 0) > 0}
    z = sum(live.values())
    return min((have[s] * repeats.get(s, 1) / (t / z) for s, t in live.items()), default=0.0)


def plan(have: Mapping[str, float], target: Mapping[str, float], repeats: Mapping[str, float], budget: float | None = None, entropy_wanted: float | None = None) -> tuple[dict[str, float], float, float]:
    """(weights, exponent, budget) of a mix.

    With ``entropy_wanted`` the natural shares are tempered to that entropy, and the budget is cut to what the repeats
    allow. With a ``budget`` the targets are bent towards the natural shares, by the least exponent at which no source
    is repeated too often; a budget beyond all repeats is cut to them. Without either the targets hold exactly, and the
    mix is as large as the scarcest source allows.
    """
    live = {s: t for s, t in target.items() if t > 0 and have.get(s, 0) > 0}
    if not live:
        return {}, 0.0, 0.0
    if entropy_wanted is not None:
        natural = {s: have[s] / sum(have[x] for x in live) for s in live}
        x = exponent_for_entropy(natural, entropy_wanted)
        w = tempered(natural, x)
        most = min(have[s] * repeats.get(s, 1) / w[s] for s in live)
        return w, x, min(most, budget or most)
    if budget is None:
        return *weights_within_repeats(have, target, repeats, 0.0), largest_budget(have, target, repeats)
    budget = min(budget, sum(have[s] for s in live) * min(repeats.get(s, 1) for s in live))
    return *weights_within_repeats(have, target, repeats, budget), budget


def mix(docs: DataFrame, targets: DataFrame, part: float | None = None, budget: float | None = None, entropy_wanted: float | None = None, seed: int = 20261009, blocks: int = BLOCKS, fillers: int = 4) -> DataFrame:
    """(doc_id, source, n_tokens, uses, position, exponent): how often each chosen text is used, its place in the source's
    permutation, and the exponent of the mix.

    docs: doc_id, source, text_key, n_tokens. targets: source, target_share, max_repeats (one row per source: bounded, read
    by the driver). A text that comes under several doc_ids or sources is one text: its smallest doc_id stands for it. Texts
    with no tokens, of a null source or of a source without target aren't used. The size is a ``budget`` in tokens
    or a ``part`` of all distinct tokens of the sources with a target; see ``plan`` for what it and ``entropy_wanted`` do.

    Each source gets floor(budget / available) whole passes; the rest of its budget is the start of a permutation of hash
    blocks. Only the block in which the budget ends is ordered text by text, so no task sees more than 1/blocks of a source.
    What the last text leaves open is filled by up to ``fillers`` further texts, each the largest that still fits.
    """
    spark = docs.sparkSession
    want = [(r[0], float(r[1] or 0), float(1 if r[2] is None else r[2])) for r in targets.where("source is not null").select("source", "target_share", "max_repeats").collect()]
    texts = docs.where("source is not null and text_key is not null and n_tokens > 0")
    one = texts.groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("d")).select("d.*")
    one = cut(one.join(F.broadcast(targets.where("target_share > 0").select("source").distinct()), "source", "left_semi").withColumn("at", F.xxhash64(F.lit(seed), "source", "doc_id")).withColumn("block", F.pmod(F.shiftrightunsigned("at", 20), F.lit(blocks)).cast("int")))
    per_block = cut(one.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("texts")))
    have = {r[0]: float(r[1]) for r in per_block.groupBy("source").agg(F.sum("tokens")).collect()}  # a row per source
    target, repeats = {s: t for s, t, _ in want}, {s: m for s, _, m in want}
    weights, exponent, budget = plan(have, target, repeats, budget if part is None else part * sum(have.values()), entropy_wanted)
    rows = []
    for s, w in sorted(weights.items()):
        passes, rest = divmod(min(w * budget, have[s] * repeats[s]), have[s])
        if rest > have[s] - 1e-6 * have[s]:
            passes, rest = passes + 1, 0.0
        rows.append((s, int(passes), float(rest)))
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("passes", T.LongType()), T.StructField("rest", T.DoubleType())])
    goal = F.broadcast(spark.createDataFrame(pd.DataFrame(rows, columns=["source", "passes", "rest"]) if rows else [], schema))
    order = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    edges = per_block.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).withColumn("texts_before", F.coalesce(F.sum("texts").over(order), F.lit(0)))
    edges = edges.select("source", "block", "tokens", "before", "texts_before")  # at most sources * blocks rows, whatever the input
    placed = one.join(goal, "source").join(F.broadcast(edges), ["source", "block"])
    ends_here = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest"))
    # texts outside the last block need no order for the choice: they are numbered within their block alone
    inner = W.partitionBy("source", "block").orderBy("at", "doc_id")
    placed = placed.withColumn("in_block", F.row_number().over(inner)).withColumn("cum", F.col("before") + F.sum("n_tokens").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    whole = F.col("before") + F.col("tokens") <= F.col("rest")
    extra = F.when(whole | (ends_here & (F.col("cum") <= F.col("rest"))), 1).otherwise(0)
    placed = cut(placed.withColumn("extra", extra).select("doc_id", "source", "n_tokens", "passes", "extra", (F.col("texts_before") + F.col("in_block")).cast("bigint").alias("position")))
    room = {s: rest for s, _, rest in rows}
    for r in placed.where("extra = 1").groupBy("source").agg(F.sum("n_tokens")).collect():
        room[r[0]] -= r[1]
    filled: list[tuple[str, int]] = []
    for _ in range(fillers):  # one row per source comes to the driver
        left = F.broadcast(spark.createDataFrame(pd.DataFrame([(s, float(x)) for s, x in sorted(room.items())], columns=["source", "room"]) if room else [], "source string, room double"))
        free = placed.where("extra = 0").join(left, "source").where("n_tokens <= room")
        if filled:
            free = free.join(F.broadcast(spark.createDataFrame(filled, "source string, doc_id bigint")), ["source", "doc_id"], "left_anti")
        got = free.groupBy("source").agg(F.max_by(F.struct("doc_id", "n_tokens"), F.struct(F.col("n_tokens"), -F.col("position"))).alias("b")).select("source", "b.*").collect()
        if not got:
            break
        for r in got:
            filled.append((r["source"], r["doc_id"]))
            room[r["source"]] -= r["n_tokens"]
    more = F.broadcast(spark.createDataFrame(filled, "source string, doc_id bigint").withColumn("more", F.lit(1)))
    placed = placed.join(more, ["source", "doc_id"], "left")
    uses = F.col("passes") + F.col("extra") + F.coalesce(F.col("more"), F.lit(0))
    return placed.withColumn("uses", uses.cast("int")).where("uses > 0").select("doc_id", "source", "n_tokens", "uses", "position", F.lit(float(exponent)).alias("exponent"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, share, tokens, texts, most_uses, exponent, entropy): what each source with a target holds of all
    tokens used, and the exponent and entropy of the whole mix. Entropy and exponent of an empty mix are null."""
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens"), F.count(F.lit(1)).alias("texts"), F.max("uses").alias("most_uses"), F.max("exponent").alias("x"))
    total = got.agg(F.sum("tokens").alias("all_tokens"), F.max("x").alias("exponent"), (F.log(F.sum("tokens")) - F.sum(F.col("tokens") * F.log("tokens")) / F.sum("tokens")).alias("entropy"))
    t = targets.where("source is not null").select("source", "target_share")
    out = t.join(F.broadcast(got), "source", "left").crossJoin(F.broadcast(total))  # one row on the right
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select("source", "target_share", (zero("tokens") / F.col("all_tokens")).alias("share"), zero("tokens").cast("bigint").alias("tokens"), zero("texts").cast("bigint").alias("texts"), zero("most_uses").cast("int").alias("most_uses"), "exponent", "entropy")
