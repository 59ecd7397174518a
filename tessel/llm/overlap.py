"""Same or nearly same records across splits, by Aho-Corasick automata over shards of evaluation passages.

Evaluation records are normalised and cut into passages such that a training record can't be near enough without
containing some of them:

* files: the record is its sequence of tokens, and the passages are runs of five tokens. If the sets of runs A and B have
  Jaccard similarity s or more, then under any order of all runs the first |A| - ceil(s |A|) + 1 of A and the like of B share
  a run. The order is by how often a run occurs in the whole corpus, rare ones first (in a sketch of fixed size), then by hash.
* strings: of four pieces of a string, at most three edits leave one in place, moved by the edits before it.

A training text is routed by these passages, in one equi-join, to the shards of evaluation records that it can match, and
to no others; so shuffles grow with the data, not with the product of both sides. The automaton of a shard then scans the
texts routed to it, and the records whose passages occur are compared exactly, on 64-bit digests of the tokens. A shard
to which many texts are routed is scanned in several tasks.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import cut

#: Tokens of a file; fixed by the problem's statement.
TOKEN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*|\d+|[^\sA-Za-z0-9_]")
WORDS, SIMILARITY, EDITS = 5, 0.8, 3
#: Size of the evaluation records of a shard, and of the training records that one task scans with it: tokens or letters.
EVAL_BLOCK, TRAIN_BLOCK = 250_000, 4_000_000
#: Counters of the sketch that orders runs by frequency (8 bytes each, whatever the data), in chunks.
COUNTERS, CHUNKS = 1 << 18, 64


class Digests(dict):
    """Token -> its 64-bit digest, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token)
        return h


def token_digests(tokens: list[str], digests: Digests) -> np.ndarray:
    return np.fromiter(map(digests.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def run_digests(toks: np.ndarray, words: int = WORDS) -> np.ndarray:
    """A digest of each run of ``words`` tokens, in order."""
    n = max(0, len(toks) - words + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + toks[i : i + n]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def symbols(toks: np.ndarray) -> str:
    """One character per token, for the automaton: equal tokens have equal characters, different ones mostly others."""
    return (toks % np.uint64(980_000) + np.uint64(0x10000)).astype("<u4").tobytes().decode("utf-32-le")


def encode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, side, text) -> (id, side, key, n, data); key is a digest of all tokens, n their number, data their digests."""
    import xxhash

    digests = Digests()
    schema = pa.schema([("id", pa.string()), ("side", pa.int32()), ("key", pa.binary()), ("n", pa.int32()), ("data", pa.binary())])
    for b in batches:
        rows = []
        for i, side, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            tokens = TOKEN.findall(text)
            if len(tokens) >= 10:
                raw = token_digests(tokens, digests).tobytes()
                rows.append((i, side, xxhash.xxh3_128_digest(raw), len(tokens), raw))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema, strict=True)], schema=schema)


def tokens_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint64)


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(data) -> (chunk, counts): a task's counters of all its runs."""
    total = np.zeros(COUNTERS, dtype=np.int64)
    for b in batches:
        for data in b.column(0).to_pylist():
            at, n = np.unique(np.unique(run_digests(tokens_of(data))) % np.uint64(COUNTERS), return_counts=True)
            total[at.astype(np.int64)] += n
    parts = [(i, x.tobytes()) for i, x in enumerate(np.split(total, CHUNKS)) if x.any()]
    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=["chunk", "counts"])


def add_counts(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"chunk": [key[0]], "counts": [sum(np.frombuffer(x, dtype=np.int64) for x in pdf["counts"]).tobytes()]})


def frequencies(enc: DataFrame) -> np.ndarray:
    """How often runs occur, over all rows, by their digests modulo COUNTERS: an array of fixed size on the driver."""
    rows = enc.select("data").mapInArrow(count_runs, "chunk int, counts binary").groupBy("chunk").applyInPandas(add_counts, "chunk int, counts binary").collect()
    out = np.zeros(COUNTERS, dtype=np.int64)
    for r in rows:  # CHUNKS rows at most
        out[r["chunk"] * (COUNTERS // CHUNKS) : (r["chunk"] + 1) * (COUNTERS // CHUNKS)] = np.frombuffer(r["counts"], dtype=np.int64)
    return out


def prefixes(counts):
    """(id, side, key, data) -> (id, side, key, n, prefix): the distinct runs' number, and the first of them in the order."""
    schema = pa.schema([("id", pa.string()), ("side", pa.int32()), ("key", pa.binary()), ("n", pa.int32()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for b in batches:
            ids, sides, keys, datas = (b.column(k).to_pylist() for k in range(4))
            sizes, out = [], []
            for data in datas:
                r = np.unique(run_digests(tokens_of(data)))
                first = len(r) - math.ceil(SIMILARITY * len(r) - 1e-9) + 1
                order = np.lexsort((r, often[(r % np.uint64(COUNTERS)).astype(np.int64)]))
                sizes.append(len(r))
                out.append(r[order[:first]].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sides, pa.int32()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(out, schema.field(4).type)], schema=schema)

    return run


def scan_files(key: tuple, evals: pd.DataFrame, trains: pd.DataFrame) -> pd.DataFrame:
    """A shard of evaluation records against training records routed to it -> (train_key, eval_key, score, coverage)."""
    import ahocorasick

    found = []
    if len(evals) and len(trains):
        owners: dict[str, list[int]] = defaultdict(list)
        runs, sets = [], []
        for i, (data, prefix) in enumerate(zip(evals["data"], evals["prefix"], strict=True)):
            toks = tokens_of(data)
            r = run_digests(toks)
            runs.append(r)
            sets.append(np.unique(r))
            enc = symbols(toks)
            for x in {enc[k : k + WORDS] for k in np.flatnonzero(np.isin(r, np.asarray(prefix, dtype=np.int64).view(np.uint64)))}:
                owners[x].append(i)
        auto = ahocorasick.Automaton()
        for x, who in owners.items():
            auto.add_word(x, who)
        auto.make_automaton()
        ekeys = evals["key"].tolist()
        for tkey, data in zip(trains["key"], trains["data"], strict=True):
            toks = tokens_of(data)
            near = {i for _, who in auto.iter(symbols(toks)) for i in who}
            t = np.unique(run_digests(toks)) if near else None
            for i in near:
                e = sets[i]
                if min(len(e), len(t)) < SIMILARITY * max(len(e), len(t)) - 1e-9:
                    continue
                both = len(np.intersect1d(e, t, assume_unique=True))
                if both >= SIMILARITY * (len(e) + len(t) - both) - 1e-9:
                    found.append((tkey, ekeys[i], both / (len(e) + len(t) - both), coverage(np.isin(runs[i], t))))
    return pd.DataFrame(found, columns=["train_key", "eval_key", "score", "coverage"])


def coverage(shared: np.ndarray) -> float:
    """The part of a record's tokens that lie in the merged intervals of the runs it shares."""
    end, covered = 0, 0
    for i in np.flatnonzero(shared):
        covered += i + WORDS - max(i, end)
        end = i + WORDS
    return covered / (len(shared) + WORDS - 1)


def cuts(s: str) -> list[tuple[int, str]]:
    """Pieces of a string with their starts: up to 8, at least EDITS + 1 where its length allows."""
    k = min(8, max(EDITS + 1, len(s) // 4))
    at = [len(s) * j // k for j in range(k + 1)]
    return [(a, s[a:b]) for a, b in zip(at, at[1:], strict=False)]


def within(a: str, b: str, k: int = EDITS) -> bool:
    """Whether at most k single-character insertions, deletions or replacements turn a into b."""
    if abs(len(a) - len(b)) > k:
        return False
    p, top = 0, min(len(a), len(b))
    while p < top and a[p] == b[p]:
        p += 1
    q = 0
    while q < top - p and a[-1 - q] == b[-1 - q]:
        q += 1
    a, b = a[p : len(a) - q], b[p : len(b) - q]
    if max(len(a), len(b)) <= k:
        return True
    row = {j: j for j in range(min(k, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            v = min(row.get(j, 99) + 1, new.get(j - 1, 99) + 1) if j else i
            new[j] = min(v, row.get(j - 1, 99) + (x != b[j - 1])) if j else v
        if min(new.values()) > k:
            return False
        row = new
    return row.get(len(b), 99) <= k


def scan_strings(key: tuple, evals: pd.DataFrame, trains: pd.DataFrame) -> pd.DataFrame:
    """As scan_files, for strings within EDITS edits; coverage is the part of the evaluation string in matched pieces."""
    import ahocorasick

    found = []
    if len(evals) and len(trains):
        ekeys = evals["key"].tolist()
        texts = evals["data"].tolist()
        owners: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        need, short = [], []
        for i, s in enumerate(texts):
            if len(s) <= EDITS:
                need.append(0)
                short.append(i)
                continue
            parts = cuts(s)
            need.append(len(parts) - EDITS)
            for j, (at, piece) in enumerate(parts):
                owners[piece].append((i, j, at))
        auto = ahocorasick.Automaton()
        for piece, who in owners.items():
            auto.add_word(piece, (len(piece), who))
        if owners:
            auto.make_automaton()
        for key_t, tkey in zip(trains["key"], trains["data"], strict=True):
            seen: dict[int, set[tuple[int, int]]] = defaultdict(set)
            if owners:
                for end, (size, who) in auto.iter(tkey):
                    start = end + 1 - size
                    for i, j, at in who:
                        if -EDITS <= start - at <= EDITS:
                            seen[i].add((j, size))
            for i in [*(i for i, parts in seen.items() if len(parts) >= need[i]), *short]:
                if within(texts[i], tkey):
                    hit = sum(size for _, size in seen[i]) if i in seen else 0
                    found.append((key_t, ekeys[i], 1.0, hit / max(1, len(texts[i]))))
    return pd.DataFrame(found, columns=["train_key", "eval_key", "score", "coverage"])


def digest(*parts: object) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


#: The route of strings that are too short for pieces.
SHORT = 0


def quarters(n: int) -> list[int]:
    return [n * j // (EDITS + 1) for j in range(EDITS + 2)]


def own_routes(s: str) -> list[int]:
    """Of a training string: its four pieces with its length, or SHORT where edits can take away all of it."""
    at = quarters(len(s))
    return ([SHORT] if len(s) <= 2 * EDITS else []) + ([digest(len(s), j, s[at[j] : at[j + 1]]) for j in range(EDITS + 1)] if len(s) > EDITS else [])


def near_routes(s: str) -> list[int]:
    """Of an evaluation string: what of it may be a piece of a string within EDITS edits. If the first j of a string's
    pieces lie before the first piece that is whole, they hold at least j edits and the rest at most EDITS - j, so the piece
    is moved by at most j from the start and by at most EDITS - j from the end."""
    out = {SHORT} if len(s) <= 2 * EDITS else set()
    for n in range(max(EDITS + 1, len(s) - EDITS), len(s) + EDITS + 1):
        at, more = quarters(n), len(s) - n
        for j in range(EDITS + 1):
            for move in range(max(-j, more - (EDITS - j)), min(j, more + (EDITS - j)) + 1):
                a, b = at[j] + move, at[j + 1] + move
                if 0 <= a and b <= len(s):
                    out.add(digest(n, j, s[a:b]))
    return sorted(out)


def string_routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, key, text) -> (side, key, n, data, prefix)."""
    schema = pa.schema([("side", pa.int32()), ("key", pa.binary()), ("n", pa.int32()), ("data", pa.string()), ("prefix", pa.list_(pa.int64()))])
    for b in batches:
        sides, keys, texts = (b.column(k).to_pylist() for k in range(3))
        cols = [sides, keys, [len(t) for t in texts], texts, [near_routes(t) if s else own_routes(t) for s, t in zip(sides, texts, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def in_shards(once: DataFrame, data: DataFrame, scan, closeness) -> DataFrame:
    """(train_key, eval_key, score, coverage) of records near one another.

    once: (side, key, id, n, prefix) of the distinct records, data: (side, id, n_data, data). Evaluation records are dealt to shards by
    hash; a training record goes to the shards with a record that shares an entry of ``prefix`` and is of a similar
    size (``closeness`` of its n, and of the least and greatest n there). A shard's texts beyond TRAIN_BLOCK are divided over
    tasks, each with the shard's records. The driver reads one number, the size of all evaluation records.
    """
    once = once.select("side", "key", "id", "n", "prefix")
    size = data.where("side = 1").agg(F.sum(F.col("n_data").cast("bigint"))).first()[0] or 0
    shards = max(1, math.ceil(size / EVAL_BLOCK))
    evals = once.where("side = 1").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    # materialised, so that both sides of the join come from their exchange and hot passages are split over tasks
    to = cut(evals.select(F.explode("prefix").alias("route"), "shard", "n").groupBy("route", "shard").agg(F.min("n").alias("lo"), F.max("n").alias("hi")))
    trains = once.where("side = 0").select(F.explode("prefix").alias("route"), "id", F.col("n").alias("m"))
    routed = cut(trains.join(to, "route").where(closeness(F.col("m"), F.col("lo"), F.col("hi"))).select("id", "shard").distinct())
    t = data.where("side = 0").select("id", "n_data", "data")
    weight = routed.join(t.select("id", "n_data").distinct(), "id").groupBy("shard").agg(F.ceil(F.sum(F.col("n_data").cast("bigint")) / TRAIN_BLOCK).cast("int").alias("parts"))
    parts = cut(weight)
    e = evals.join(parts, "shard").join(data.where("side = 1").select("id", "data"), "id").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "key", "data", "prefix")
    keys = once.where("side = 0").select("id", "key")
    r = routed.join(parts, "shard").join(keys, "id").join(t.select("id", "data"), "id").select("shard", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "key", "data")
    out = "train_key binary, eval_key binary, score double, coverage double"
    return e.groupBy("shard", "part").cogroup(r.toDF("shard", "part", "key", "data").groupBy("shard", "part")).applyInPandas(scan, out).distinct()


def near_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """files: (id string, side 0 train / 1 evaluation, text). Returns the pairs of distinct token sequences
    (train_key, eval_key, score, coverage), and the members (id, side, key) of each sequence.

    Repeated rows count once; texts that are null or have fewer than 10 tokens take no part.
    """
    sc = files.sparkSession.sparkContext
    enc = cut(files.where("id is not null and text is not null").select("id", "side", "text").mapInArrow(encode_files, "id string, side int, key binary, n int, data binary"))
    counts = sc.broadcast(frequencies(enc))
    first = enc.select("id", "side", "key", "data").mapInArrow(prefixes(counts), "id string, side int, key binary, n int, prefix array<bigint>")
    once = cut(first.groupBy("side", "key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("prefix").alias("prefix")))
    data = enc.select("side", "id", F.col("n").alias("n_data"), "data")
    close = lambda m, lo, hi: (m >= SIMILARITY * lo - 1e-9) & (m * SIMILARITY <= hi + 1e-9)
    return in_shards(once, data, scan_files, close), enc.select("id", "side", "key").distinct()


def near_strings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: (id, side, text) with texts already normalised; as near_files. Keys are digests of the texts."""
    keyed = rows.where("id is not null and text is not null").select("id", "side", F.unhex(F.md5("text")).alias("key"), "text")
    distinct = keyed.groupBy("side", "key").agg(F.first("text").alias("text"))
    once = cut(distinct.mapInArrow(string_routes, "side int, key binary, n int, data string, prefix array<bigint>").withColumn("id", F.hex("key")))
    data = once.select("side", "id", F.col("n").alias("n_data"), "data")
    close = lambda m, lo, hi: (m >= lo - EDITS) & (m <= hi + EDITS)
    return in_shards(once, data, scan_strings, close), keyed.select("id", "side", "key").distinct()


def expand(pairs: DataFrame, members: DataFrame, scope: str) -> DataFrame:
    """(scope, train_id, eval_id, score, coverage) of the records behind pairs of keys."""
    t = members.where("side = 0").select(F.col("key").alias("train_key"), F.col("id").alias("train_id"))
    e = members.where("side = 1").select(F.col("key").alias("eval_key"), F.col("id").alias("eval_id"))
    return pairs.join(t, "train_key").join(e, "eval_key").select(F.lit(scope).alias("scope"), "train_id", "eval_id", "score", "coverage")


def matched(pairs: DataFrame, members: DataFrame, scope: str) -> DataFrame:
    """(scope, eval_id, pairs, coverage) of evaluation records: copies on the training side are counted, not listed."""
    copies = members.where("side = 0").groupBy(F.col("key").alias("train_key")).agg(F.count(F.lit(1)).alias("copies"))
    per = cut(pairs.join(copies, "train_key").groupBy("eval_key").agg(F.sum("copies").alias("pairs"), F.max("coverage").alias("coverage")))
    e = members.where("side = 1").select(F.col("key").alias("eval_key"), F.col("id").alias("eval_id"))
    return e.join(per, "eval_key").select(F.lit(scope).alias("scope"), "eval_id", "pairs", "coverage")


def sides_of(jobs: DataFrame) -> DataFrame:
    """(repository_id, split, side): 0 for train, 1 for validation and test; other repositories give no row."""
    side = F.when(F.col("split") == "train", 0).when(F.col("split").isin("validation", "test"), 1)
    return cut(jobs.where("repo_id is not null").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("split").alias("split")).select("repository_id", "split", side.alias("side")).where("side is not null"))


def both_scopes(corpus: DataFrame, samples: DataFrame, sides: DataFrame, min_chars: int = 60) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    s = sides.select("repository_id", "side")
    files = corpus.select(F.col("file_id").cast("string").alias("id"), "repository_id", F.col("content").alias("text")).join(s, "repository_id")
    texts = samples.where(F.length("target_text") >= min_chars).select(F.col("sample_id").alias("id"), "repository_id", F.regexp_replace(F.lower("target_text"), "[^a-z0-9]+", "").alias("text")).join(s, "repository_id")
    return near_files(files), near_strings(texts)


def cross_split(corpus: DataFrame, samples: DataFrame, jobs: DataFrame) -> DataFrame:
    """(scope, train_id, eval_id, score, coverage): overlaps of files and of long samples between train repositories and
    validation or test repositories of jobs. Repositories with another or no split take no part."""
    (fp, fm), (sp, sm) = both_scopes(corpus, samples, sides_of(jobs))
    return expand(fp, fm, "file").union(expand(sp, sm, "sample"))


def counts_per_split(corpus: DataFrame, samples: DataFrame, jobs: DataFrame) -> DataFrame:
    """(scope, split, repository_id, records, pairs, mean_coverage) of evaluation records with an overlap."""
    sides = sides_of(jobs)
    (fp, fm), (sp, sm) = both_scopes(corpus, samples, sides)
    hit = cut(matched(fp, fm, "file").union(matched(sp, sm, "sample")))
    where = corpus.select(F.lit("file").alias("scope"), F.col("file_id").cast("string").alias("eval_id"), "repository_id").union(samples.select(F.lit("sample"), "sample_id", "repository_id"))
    located = where.join(hit, ["scope", "eval_id"]).distinct().join(sides.select("repository_id", "split"), "repository_id")
    return located.groupBy("scope", "split", "repository_id").agg(F.count(F.lit(1)).alias("records"), F.sum("pairs").alias("pairs"), F.avg("coverage").alias("mean_coverage"))
