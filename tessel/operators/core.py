"""DataFrame operators: discovery, dedup, caps, splits, joins with reasons, prefix sums, overlaps and prompts.

All of them keep total orders where something is "first", keep rejected rows with a reason where that is the feature, and
pre-aggregate before they shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X
from tessel.operators.skew import capped_rank, fresh

# Path patterns, markers and credential formats of discovery.
EXCLUDE = ["**/obj/**", "**/bin/**", "**/.git/**"]
VENDORED = ["**/vendor/**", "**/third_party/**", "**/external/**", "**/wwwroot/lib/**"]
GENERATED = ["**/*.g.cs", "**/*.g.i.cs", "**/*.Designer.cs", "**/*.generated.cs", "**/*.AssemblyInfo.cs", "**/Migrations/**", "**/*ModelSnapshot.cs"]
TESTS = ["tests/**", "test/**", "**/*.Tests/**", "**/*.UnitTests/**", "**/*.FunctionalTests/**", "**/*Tests.cs"]
GENERATED_MARKER = r"(?i)<auto-?generated|This code was generated by a tool|\[(System\.CodeDom\.Compiler\.)?GeneratedCode(Attribute)?\("
SECRET_FILE = [r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"\bAKIA[0-9A-Z]{16}\b", r"\bgh[pousr]_[A-Za-z0-9]{36,}\b", r"\bxox[baprs]-[A-Za-z0-9-]{10,}", r"(?i)AccountKey=[A-Za-z0-9+/=]{20,}", r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"]
SECRET_LINE = r'(?i)\b\w*(password|passwd|pwd|secret|apikey|api_key|accesstoken|access_token)\w*"?\s*[:=]\s*@?"(?-i:(?![A-Z0-9_]+"))[^"\s{}]{8,}"'
SECRET_PAIR = r"(?i)\b(?:password|pwd)=[^;\"'\s]{6,};"
MAX_BYTES, MAX_LINE, MARKER_CHARS = 1 << 20, 2000, 4000


def discovery(files: DataFrame, content: str = "content", path: str = "relative_path", size: str = "bytes", sha: str = "sha256", scope: Sequence[str] = (), order: Sequence[str] | None = None, undecoded: Column | None = None, allowed: Column | None = None) -> DataFrame:
    """The files without their content, with ``reason`` (accepted, or the first rule that rejects the file) and ``duplicate_of``.

    Path and size rules come before those that read the content. ``undecoded`` is why the bytes of a file are no text
    (utf16_encoding, invalid_utf8, binary_nul; see sources.files.decoded), ``allowed`` whether its licence is; a null says it
    is. Exact duplicates are looked for among the files that no other rule rejects: the first path (by ``order``) of a
    digest within ``scope`` stays, and later ones name it. The content is dropped before anything is shuffled, and firsts are
    pre-aggregated, so a digest that recurs everywhere is one row per task.
    """
    c, p = F.col(content), F.col(path)
    long_line = F.exists(F.split(c, r"\r\n|\n|\r"), lambda x: F.length(x) > MAX_LINE)
    secret = F.lit(False)
    for rx in SECRET_FILE:
        secret = secret | c.rlike(rx)
    none = F.lit(None).cast("string")
    undecoded = none if undecoded is None else undecoded
    refused = F.lit(False) if allowed is None else ~allowed
    rule = F.coalesce(
        X.first_reason([("excluded_path", X.first_match(p, EXCLUDE).isNotNull()), ("too_large", F.col(size) > MAX_BYTES), ("vendored_path", X.first_match(p, VENDORED).isNotNull()), ("generated_path", X.first_match(p, GENERATED).isNotNull())]),
        undecoded,
        X.first_reason([("binary_nul", c.contains("\0")), ("empty", F.trim(c) == ""), ("generated_marker", F.substring(c, 1, MARKER_CHARS).rlike(GENERATED_MARKER)), ("long_lines", long_line), ("license_not_allowed", refused), ("secret_detected", secret)]),
    )
    by = [F.col(x) for x in (order or [path])]
    judged = files.withColumn("rule__", rule).drop(content)
    key = [*scope, sha]
    firsts = judged.where("rule__ is null").groupBy(*key).agg(F.min_by(F.struct(*by, F.col(path).alias("path__")), F.struct(*by)).alias("first__"))
    joined = judged.join(firsts.select(*[F.col(k).alias(f"{k}__k") for k in key], "first__"), [F.col(k).eqNullSafe(F.col(f"{k}__k")) for k in key], "left").drop(*[f"{k}__k" for k in key])
    same = F.lit(True)
    for x in order or [path]:
        same = same & F.col(x).eqNullSafe(F.col(f"first__.{x}"))
    dup = F.col("rule__").isNull() & ~same
    return joined.withColumn("reason", F.coalesce("rule__", F.when(dup, F.lit("exact_duplicate")), F.lit("accepted"))).withColumn("duplicate_of", F.when(dup, F.col("first__.path__"))).drop("rule__", "first__")


def hash_split(key: Column, seed: str, salt: str, shares: Sequence[tuple[str, float]], rest: str, overrides: Mapping[str, str] | None = None) -> Column:
    """The split of a key by its hash: shares are taken in order from 0 upwards, what is beyond them is ``rest``."""
    u, out, at = X.uniform(F.lit(seed), F.lit(salt), key), None, 0.0
    for name, share in shares:
        at += share
        out = F.when(u < at, name) if out is None else out.when(u < at, name)
    out = out.otherwise(rest)
    for k, v in (overrides or {}).items():
        out = F.when(key == k, v).otherwise(out)
    return out


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under a total order, by an aggregation (a row per key and task is shuffled, not all rows).

    order: columns, or expressions made of them; F.asc / F.desc marks aren't taken. Nulls come first.
    """
    named = [(k if isinstance(k, Column) else F.col(f"`{k}`")).alias(f"key{i}__") for i, k in enumerate(keys)]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*named).agg(F.min_by(row, F.struct(*order)).alias("r__")).select("r__.*")


def keep_first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salt_on: Sequence[str]) -> DataFrame:
    """The first n rows of each key, ranked within salts first, so a dominant key never sits in one task."""
    r = fresh(df, "rank__")
    return capped_rank(df, keys, order, n, salt_on, r).where(F.col(r).isNotNull()).drop(r)


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last record of each key by the order's columns: one aggregation, no sort."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r__")).select(key, "r__.*")


def owner_of(df: DataFrame, item: str, claimer: str, order: Sequence[Column]) -> DataFrame:
    """(item, owner): who claims an item first, by an order that doesn't depend on scheduling."""
    return df.groupBy(item).agg(F.min_by(F.col(claimer), F.struct(*order)).alias("owner"))


def admission(df: DataFrame, inner: str, inner_cap: int, outer: str, outer_cap: int, order: Sequence[Column], salt_on: Sequence[str]) -> DataFrame:
    """Adds ``drop_reason`` of two nested caps counted in admission order: outer_cap once the outer key is full, else inner_cap.

    Rows are ranked by salted windows. The row that fills an outer key is the outer_cap-th of those that its inner caps
    let in; it is found per key, and what comes after it is dropped by the outer cap. No window holds all rows of a key.
    """
    a = capped_rank(df, [inner], order, inner_cap, salt_on, "n1__")
    fits = F.col("n1__").isNotNull()
    b = capped_rank(a.withColumn("fits__", fits), [outer, "fits__"], order, outer_cap, salt_on, "n2__")
    at = F.struct(*order)
    full = b.where(F.col("fits__") & (F.col("n2__") == outer_cap)).select(F.col(outer).alias("full__"), at.alias("at__"))
    j = b.join(full, F.col(outer).eqNullSafe(F.col("full__")), "left")
    late = F.coalesce(at > F.col("at__"), F.lit(False))
    return j.withColumn("drop_reason", F.when(late, "outer_cap").when(~F.col("fits__"), "inner_cap")).drop("n1__", "n2__", "fits__", "full__", "at__")


def prefix_sum(df: DataFrame, order: str, value: str, buckets: int = 64, out: str = "offset") -> DataFrame:
    """Adds the sum of ``value`` over all rows before, by a unique ``order`` of numbers, in two phases.

    Rows are cut at quantiles of the order, so that ranges hold about as many rows each however the numbers lie; range totals
    are summed up in a window over the few ranges, rows in a window within their range. No window holds all rows.
    """
    b = fresh(df, "range__")
    at = F.percentile_approx(order, F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), F.lit(10_000)).alias("at__")
    ranged = df.crossJoin(F.broadcast(df.agg(at))).withColumn(b, F.size(F.filter("at__", lambda x: x < F.col(order)))).drop("at__")  # one row on the right
    totals = ranged.groupBy(b).agg(F.sum(value).alias("t__"))
    before = totals.select(F.col(b), F.coalesce(F.sum("t__").over(W.orderBy(b).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before__"))
    inside = F.coalesce(F.sum(value).over(W.partitionBy(b).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("inside__", inside).join(F.broadcast(before), b).withColumn(out, (F.col("before__") + F.col("inside__")).cast("bigint")).drop(b, "inside__", "before__")


def overlap_units(items: DataFrame, group: str, item: str, chunk: int = 256) -> DataFrame:
    """(u, n, shared_items, members): groups with n items of which the same ones lie in other groups too are alike for any
    comparison; up to ``chunk`` of them are one unit. shared_items: numbers of these items, rare ones first. Materialised."""
    from tessel.session import cut

    d = cut(items.select(F.col(group).alias("g"), F.col(item).alias("i")).where("g is not null and i is not null").distinct())
    often = cut(d.groupBy("i").agg(F.count(F.lit(1)).alias("k")).where("k > 1").withColumn("id", F.monotonically_increasing_id()))
    at = F.when(F.col("k").isNotNull(), F.struct("k", "id"))
    sets = d.join(often, "i", "left").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(at)), lambda x: x["id"]).alias("shared_items"))  # the items of one group
    alike = sets.where(F.size("shared_items") > 0).groupBy("n", "shared_items").agg(F.collect_list("g").alias("all"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / chunk).cast("int")), lambda c: F.slice("all", c * chunk + 1, F.lit(chunk)))
    return cut(alike.select("n", "shared_items", F.explode(chunks).alias("members")).withColumn("u", F.monotonically_increasing_id()))


def similar_units(units: DataFrame, least: float, part: int = 2048) -> DataFrame:
    """(ua, ub, xs, ys, shared, jaccard) of units, each pair once, whose groups are similar to ``least`` or more; xs, ys: their
    members. A unit of several groups that are similar to each other comes with itself.

    Prefix and position filter: with items ordered by rarity, two such groups share one of the first n - ceil(least n) + 1
    items of each, and after the first that they share, enough others can follow. Units meet by these items, each posting
    with the rest of its unit's items, so that a pair is counted exactly, and only at its first shared item, where it
    meets: pairs are never shuffled. Postings of frequent items are cut into parts.
    """
    bucket = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / min(least, 0.5))) + 1e-9)  # similar groups lie in one or in two next to each other
    p = F.col("n") - F.size("shared_items") + F.col("at") + 1
    keys = units.select("u", "n", "shared_items", F.size("members").alias("m"), F.posexplode("shared_items").alias("at", "i")).where(p <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    # a large unit that finds none of its size at an item needn't go there with its items
    near = keys.groupBy("i", bucket.alias("s")).agg(F.sum(F.least("m", F.lit(2))).alias("k"))
    met = near.select("i", "k", F.explode(F.array(*[F.col("s") + x for x in (-1, 0, 1)])).alias("s")).groupBy("i", "s").agg(F.sum("k").alias("k")).where("k > 1")
    parts = met.groupBy("i").agg(F.ceil(F.max("k") / part).cast("int").alias("parts"))
    posts = keys.select("u", "n", "i", "at", bucket.alias("s")).join(met.select("i", "s"), ["i", "s"]).join(parts, "i").join(units.select("u", "shared_items", "members"), "u")
    a = posts.select("i", "at", "parts", *[F.col(x).alias(y) for x, y in (("u", "ua"), ("n", "na"), ("shared_items", "ia"), ("members", "xs"))]).withColumn("part", F.pmod(F.xxhash64("ua"), F.col("parts")).cast("int")).drop("parts")
    b = posts.select("i", F.col("at").alias("atb"), *[F.col(x).alias(y) for x, y in (("u", "ub"), ("n", "nb"), ("shared_items", "ib"), ("members", "ys"))], F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    once = (F.col("ua") < F.col("ub")) | ((F.col("ua") == F.col("ub")) & (F.size("xs") > 1))
    enough = F.least(F.size("ia") - F.col("at"), F.size("ib") - F.col("atb")) >= (F.col("na") + F.col("nb")) * (least / (1 + least)) - 1e-9
    both = a.join(b, ["i", "part"]).where(once & enough).withColumn("common", F.array_intersect("ia", "ib")).where(F.element_at("common", 1) == F.col("i"))
    counted = both.select("ua", "ub", "xs", "ys", F.size("common").cast("bigint").alias("shared"), (F.col("na") + F.col("nb")).alias("n"))
    return counted.withColumn("jaccard", F.col("shared") / (F.col("n") - F.col("shared"))).where(F.col("jaccard") >= least).drop("n")


def overlap_pairs(items: DataFrame, group: str, item: str, least: float) -> DataFrame:
    """(a, b, shared, jaccard) of groups that share items to a Jaccard similarity of ``least`` or more, a < b. least must be
    above 0. See similar_units; groups that have the same shared items are compared once."""
    s = similar_units(overlap_units(items, group, item), least)
    each = s.select("ua", "ub", F.explode("xs").alias("x"), "ys", "shared", "jaccard").select("ua", "ub", "x", F.explode("ys").alias("y"), "shared", "jaccard")
    return each.where((F.col("ua") < F.col("ub")) | (F.col("x") < F.col("y"))).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "shared", "jaccard")


def overlap_components(items: DataFrame, group: str, item: str, least: float) -> DataFrame:
    """(node, root): components() over overlap_pairs(), without its pairs, whose number may grow with the square of the groups.

    Units take the place of their groups, and each task keeps only a spanning forest of the pairs that it finds.
    """
    units = overlap_units(items, group, item)
    c = components(forest(similar_units(units, least).select("ua", "ub")))
    found = units.join(c, F.col("node") == F.col("u")).select(F.col("root").alias("r"), F.explode("members").alias("node"))
    return found.join(found.groupBy("r").agg(F.min("node").alias("root")), "r").select("node", "root")


def forest(edges: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Of (a, b) edges between whole numbers, those that join two trees of their task, and loops once: the components of all
    edges. A task that holds ``most`` numbers begins anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}
        for batch in batches:
            kept: list[tuple[int, int]] = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if a == b:
                    if a not in up:
                        up[a] = a
                        kept.append((a, b))
                    continue
                x, y = a, b
                while (z := up.setdefault(x, x)) != x:
                    up[x] = x = up[z]
                while (z := up.setdefault(y, y)) != y:
                    up[y] = y = up[z]
                if x != y:
                    up[max(x, y)] = min(x, y)
                    kept.append((a, b))
            if len(up) > most:
                up = {}
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in kept], pa.int64()) for k in (0, 1)], ["a", "b"])

    return edges.toDF("a", "b").where("a is not null and b is not null").mapInArrow(run, "a bigint, b bigint")


def nearest_ancestor(paths: DataFrame, path: str, marked: DataFrame, folder: str, value: str) -> DataFrame:
    """Left-joins each path with the value of its nearest folder upwards that is marked."""
    parts = F.split(F.col(path), "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    up = paths.select(path).distinct().select(path, F.explode(ups).alias("dir__"))
    best = up.join(marked.select(F.col(folder).alias("dir__"), F.col(value).alias("v__")), "dir__").groupBy(path).agg(F.max_by("v__", F.struct(F.length("dir__"), "v__")).alias(value))
    return paths.join(best, path, "left")


def water_fill(sizes: DataFrame, key: str, size: str, budget: int) -> DataFrame:
    """(cap): the least whole cap such that the sizes, each cut to it, sum up to the budget; the largest size if they can't.

    A search by digits, most significant first: each round sums up the sizes of 256 ranges (a row per range comes to the
    driver) and goes on within the one that the cap lies in. Nothing is sorted, however many sizes there are.
    """
    from tessel.session import cut

    spark = sizes.sparkSession
    d = cut(sizes.where(F.col(size).isNotNull()).groupBy(F.col(size).cast("bigint").alias("s")).agg(F.count(F.lit(1)).alias("n")))
    top, total = d.agg(F.max("s"), F.sum(F.col("s") * F.col("n"))).first()
    if top is None or total < budget:
        return spark.createDataFrame([(top,)], "cap bigint")
    lo, width, below, above = 0, 1, 0, d.agg(F.sum("n")).first()[0]
    while lo + width * 256 <= top:
        width *= 256
    while width >= 1:
        each = {int(r[0]): (r[1], r[2]) for r in d.where(F.col("s").between(lo, lo + 256 * width - 1)).groupBy(F.floor((F.col("s") - lo) / width).alias("r")).agg(F.sum(F.col("s") * F.col("n")), F.sum("n")).collect()}
        for r in range(256):
            # at the last value of a range, sizes within it count as themselves or as the cap: the cap lies in the first that suffices
            total_in, n_in = each.get(r, (0, 0))
            end = lo + (r + 1) * width
            if below + total_in + end * (above - n_in) >= budget or r == 255:
                lo += r * width
                break
            below, above = below + total_in, above - n_in
        if width == 1:
            break
        width //= 256
    cap = -(-(budget - below) // above) if above else lo
    return spark.createDataFrame([(max(int(cap), 0),)], "cap bigint")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node of each connected group, by propagating the least label along edges until nothing
    changes. Each round is checkpointed in the shared folder."""
    from tessel.session import cut

    e = edges.toDF("a", "b").where("a is not null and b is not null")
    both = cut(e.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct())
    labels = cut(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("root")).withColumnRenamed("a", "node"))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("root", "low").alias("new"), "root")
        # and a jump to the root's own root, which halves long chains
        jump = cut(step.join(step.select(F.col("node").alias("root2"), F.col("new").alias("new2")), F.col("new") == F.col("root2"), "left").select("node", F.least("new", "new2").alias("new"), F.col("root").alias("old")))
        changed = jump.where("new <> old").limit(1).count()
        labels = jump.select("node", F.col("new").alias("root"))
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def cut_left(text: Column, most: int) -> Column:
    """The end of a text of at most ``most`` characters or a little less: cut after the next line break if there is one
    before the last character."""
    n = F.length(text)
    over = n - most
    tail = F.substr(text, over + 1)
    brk = F.instr(tail, "\n")
    inner = (brk > 0) & (over + brk < n)
    return F.when(n <= most, text).when(inner, F.substr(text, over + brk + 1)).otherwise(tail)


def budgeted_lines(lines: Column, budget: int, per_line: int) -> Column:
    """Greedy admission of fact lines into a budget of characters: struct<text, dropped>.

    lines: array of struct<order double, priority int, key string, items array<string>, sep string>. By priority (stable),
    each line takes at most ``per_line`` items, then the longest prefix of them whose text fits what is left; lines without
    items are skipped. Admitted lines come out by their order.
    """
    zero = F.struct(F.lit(budget).cast("int").alias("left"), F.lit(0).cast("int").alias("dropped"), F.array().cast("array<struct<o:double,i:int,t:string>>").alias("got"))
    ranked = F.array_sort(F.transform(F.filter(lines, lambda x: F.size(x["items"]) > 0), lambda x, i: F.struct(x["priority"].alias("priority"), i.alias("i"), x["order"].alias("order"), x["key"].alias("key"), x["items"].alias("items"), x["sep"].alias("sep"))))

    def admit(acc: Column, x: Column) -> Column:
        most = F.least(F.size(x["items"]), F.lit(per_line))
        text = lambda k: F.concat(x["key"], F.lit(" "), F.concat_ws("", F.transform(F.slice(x["items"], F.lit(1), k), lambda v, j: F.when(j == 0, v).otherwise(F.concat(x["sep"], v)))), F.lit("\n"))
        fits = F.filter(F.sequence(F.lit(1), most), lambda k: F.length(text(k)) <= acc["left"])
        k = F.coalesce(F.array_max(fits), F.lit(0))
        dropped = (acc["dropped"] + F.size(x["items"]) - k).cast("int")
        got = F.concat(acc["got"], F.array(F.struct(x["order"].cast("double").alias("o"), x["i"].cast("int").alias("i"), text(k).alias("t"))))
        return F.when(k > 0, F.struct((acc["left"] - F.length(text(k))).cast("int").alias("left"), dropped.alias("dropped"), got.alias("got"))).otherwise(F.struct(acc["left"].alias("left"), dropped.alias("dropped"), acc["got"].alias("got")))

    done = F.aggregate(ranked, zero, admit)
    return F.struct(F.array_join(F.transform(F.array_sort(done["got"]), lambda g: g["t"]), "").alias("text"), done["dropped"].alias("dropped"))
