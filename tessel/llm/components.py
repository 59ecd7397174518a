"""Connected groups by hash-to-min, and splits that keep each group together by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import cut, label, owner, unit_hash


def star_edges(ties: DataFrame, node: str = "node", key: str = "key") -> DataFrame:
    """Edges (a, b) from (node, key) rows: each node to the smallest node of its key. Linear in the rows, whatever the key's size.

    The smallest node is pre-aggregated per key before the shuffle, materialised and joined back: so both sides of the join
    come straight from their exchange, and adaptive execution splits a key with a third of all rows over many tasks (it
    would not, were the aggregate a part of the join's stage). Null nodes or keys tie nothing.
    """
    t = ties.select(F.col(node).alias("a"), F.col(key).alias("k__")).where("a is not null and k__ is not null")
    low = cut(t.groupBy("k__").agg(F.min("a").alias("b")))
    return t.join(low, "k__").where("a <> b").select("a", "b").distinct()


def hash_to_min(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node (as a string) of each node that has an edge.

    Hash-to-min: the relation C holds (v, u) for each member u of v's cluster. A round sends v's whole cluster to the
    minimum m(v) of it, and m(v) to every member; it ends when a round changes nothing. Each round is one aggregation
    and one join over C, both materialised in the shared folder, so that the rows of a large cluster's root are a skewed
    side that adaptive execution splits; C is kept as rows, so no cluster is ever collected.
    Nodes without an edge are not returned. Fails if ``rounds`` don't suffice (they grow with the log of the longest path).
    """
    e = edges.select(F.col(edges.columns[0]).cast("string").alias("v"), F.col(edges.columns[1]).cast("string").alias("u")).where("v is not null and u is not null")
    c = cut(e.union(e.select(F.col("u").alias("v"), F.col("v").alias("u"))).union(e.select("v", F.col("v").alias("u"))).union(e.select("u", F.col("u").alias("v"))).distinct())
    before = None
    for _ in range(rounds):
        low = cut(c.groupBy("v").agg(F.min("u").alias("m")))
        with_low = c.join(low, "v")
        pairs = with_low.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("p"))
        c = cut(pairs.select("p.v", "p.u").distinct())
        now = c.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if before == tuple(now):
            return c.groupBy("v").agg(F.min("u").alias("root")).withColumnRenamed("v", "node")
        before = tuple(now)
    raise RuntimeError(f"hash-to-min did not settle in {rounds} rounds")


def repository_ties(jobs: DataFrame, file_contexts: DataFrame) -> DataFrame:
    """(node, key): each repository with its owner and its labels (own id, jobs.grp, split_group of its files).

    Empty owners and labels that say nothing tie nobody. Owner and label keys are told apart by a prefix.
    """
    own = jobs.where("repo_id is not null").select(F.col("repo_id").alias("node"), F.concat(F.lit("o:"), owner(F.col("full_name"))).alias("key"))
    ids = jobs.where("repo_id is not null").select(F.col("repo_id").alias("node"), F.concat(F.lit("l:"), label(F.col("repo_id"))).alias("key"))
    grp = jobs.where("repo_id is not null").select(F.col("repo_id").alias("node"), F.concat(F.lit("l:"), label(F.col("grp"))).alias("key"))
    split = file_contexts.select(F.col("repository_id").alias("node"), F.concat(F.lit("l:"), label(F.col("split_group"))).alias("key"))
    return own.union(ids).union(grp).union(split).where("node is not null and key is not null").distinct()


def tied_groups(jobs: DataFrame, file_contexts: DataFrame) -> DataFrame:
    """(repo_id, root_repo_id) of every repository tied to at least one other. Ties through repositories that only
    file_contexts names count too. Empty tables give no rows."""
    return hash_to_min(star_edges(repository_ties(jobs, file_contexts))).select(F.col("node").alias("repo_id"), F.col("root").alias("root_repo_id"))


def rendezvous(groups: DataFrame, weights: Mapping[str, float], seed: int = 20261009, tries: int = 16, rounds: int = 4) -> DataFrame:
    """Adds ``split`` to (root, size) rows: the split with the highest -w / ln(u(seed, root, split)).

    A group larger than a split's share of all records can't go there. As whole groups are placed, the plain weights
    miss the proportions where groups are few or uneven; so ``tries`` seeds are weighed in one pass, and the weights of
    the best are corrected ``rounds`` times by the shares they reach. The driver sees one aggregated row per split and
    seed. Empty input gives no rows.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    want = {s: w / sum(weights.values()) for s, w in weights.items()}
    main = max(want, key=lambda s: (want[s], s))

    def chosen(w: Mapping[str, float], salt) -> object:
        scores = []
        for s in sorted(want):
            score = F.lit(float(w[s])) / -F.log(unit_hash(salt, F.col("root"), F.lit(s)))
            fits = F.lit(True) if s == main else F.col("size") <= F.lit(want[s] * total)
            scores.append(F.struct(F.when(fits, score).otherwise(F.lit(-1.0)).alias("score"), F.lit(s).alias("split")))
        return F.array_max(F.array(*scores))["split"]

    def reached(w: Mapping[str, float], salts: list[int]) -> list[tuple[float, int, dict[str, float]]]:
        tried = groups.withColumn("salt", F.explode(F.array(*[F.lit(x).cast("bigint") for x in salts])))
        got: dict[int, dict[str, float]] = {x: {} for x in salts}
        for r in tried.groupBy("salt", chosen(w, F.col("salt")).alias("split")).agg(F.sum("size").alias("n")).collect():
            got[r["salt"]][r["split"]] = r["n"] / total
        return sorted((sum(abs(g.get(s, 0) - want[s]) for s in want), x, g) for x, g in got.items())

    w, best = dict(want), (0.0, seed, dict(want))
    if total:
        off, salt, got = reached(w, list(range(seed, seed + tries)))[0]
        best = (off, salt, dict(w))
        for _ in range(rounds):
            if off < 0.005:
                break
            w = {s: w[s] * (want[s] / max(got.get(s, 0), want[s] / 8)) ** 0.7 for s in want}
            off, _, got = reached(w, [salt])[0]
            best = min(best, (off, salt, dict(w)), key=lambda b: b[0])
    return groups.withColumn("split", chosen(best[2], F.lit(best[1]).cast("bigint")))


def assign_splits(jobs: DataFrame, file_contexts: DataFrame, weights: Mapping[str, float] | None = None, seed: int = 20261009) -> DataFrame:
    """(repo_id, root_repo_id, split): every repository of jobs, one split per tied group.

    A repository without ties is its own group. The proportions count repositories.
    """
    weights = weights or {"train": 0.8, "validation": 0.1, "test": 0.1}
    tied = tied_groups(jobs, file_contexts)
    repos = jobs.where("repo_id is not null").select("repo_id").distinct()
    rooted = cut(repos.join(tied, "repo_id", "left").select("repo_id", F.coalesce("root_repo_id", "repo_id").alias("root_repo_id")))
    groups = cut(rooted.groupBy(F.col("root_repo_id").alias("root")).agg(F.count(F.lit(1)).alias("size")))
    return rooted.join(rendezvous(groups, weights, seed).select(F.col("root").alias("root_repo_id"), "split"), "root_repo_id").select("repo_id", "root_repo_id", "split")
