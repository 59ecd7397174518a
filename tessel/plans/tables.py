"""Queries over tables: joins, aggregations, windows, sampling, sets, graphs, job state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X
from tessel.operators import core as O
from tessel.plans.files import files
from tessel.plans.registry import FILES, query, u_sql
from tessel.session import table
from tessel.streaming import jobs as J

# --- joins

_B = "(select distinct file_id, engine, parse_errors, min_position from bindings)"


def bindings(spark, d):
    return table(spark, d, "bindings").select("file_id", "engine", "parse_errors", "min_position").distinct()


def contexts(spark, d):
    return table(spark, d, "file_contexts").select("file_id", "repository_id", "is_test", "split", "split_group").distinct()


@query(f"select f.file_id, b.engine, b.parse_errors from {FILES} f left join {_B} b on f.file_id = b.file_id")
def j1_files_with_bindings(spark, d):
    return files(spark, d, "repository_id").join(bindings(spark, d), "file_id", "left").select("file_id", "engine", "parse_errors")


@query(f"select f.file_id, b.parse_errors from (select distinct file_id from corpus where language = 'csharp') f left join (select * from {_B} where engine = 'speculative') b on f.file_id = b.file_id")
def j2_one_policy(spark, d):
    f = table(spark, d, "corpus").where("language = 'csharp'").select("file_id").distinct()
    return f.join(bindings(spark, d).where("engine = 'speculative'").select("file_id", "parse_errors"), "file_id", "left")


@query("select l_orderkey, l_linenumber, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey")
def j3_inner(spark, d):
    line, orders = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderstatus")


@query(f"select file_id, max(parse_errors) filter (engine = 'adhoc') as adhoc, max(parse_errors) filter (engine = 'msbuild') as msbuild, max(parse_errors) filter (engine = 'speculative') as speculative from {_B} group by all")
def j4_policy_pivot(spark, d):
    return bindings(spark, d).groupBy("file_id").pivot("engine", ["adhoc", "msbuild", "speculative"]).agg(F.max("parse_errors"))


@query("select s.caret_kind, count(*) as n from (select distinct sample_id, caret_kind, repository_id, relative_path from samples) s join (select distinct repository_id, relative_path from bindings) b using (repository_id, relative_path) group by all")
def j5_kind_of_bound(spark, d):
    b = table(spark, d, "bindings").select("repository_id", "relative_path").distinct()
    s = table(spark, d, "samples").select("sample_id", "caret_kind", "repository_id", "relative_path").distinct()
    return s.join(b, ["repository_id", "relative_path"]).groupBy("caret_kind").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct repo_id from jobs j where not exists (select 1 from license_info l where l.repo_id = j.repo_id and l.license_text is not null)")
def j6_without_license_text(spark, d):
    have = table(spark, d, "license_info").where("license_text is not null").select("repo_id")
    return table(spark, d, "jobs").select("repo_id").distinct().join(have, "repo_id", "left_anti")


_OWN = f"(select sha256, arg_min(repository_id, (-p, repository_id)) as owner from (select f.sha256, f.repository_id, coalesce(max(j.priority), -1) as p from {FILES} f left join jobs j on j.repo_id = f.repository_id group by all) group by all)"


def owners(spark, d):
    pri = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.coalesce(F.max("priority"), F.lit(-1)).alias("p"))
    claims = files(spark, d, "sha256", "repository_id").select("sha256", "repository_id").distinct().join(pri, "repository_id", "left")
    return O.owner_of(claims, "sha256", "repository_id", [-F.coalesce("p", F.lit(-1)), F.col("repository_id")])


@query(f"select f.file_id from {FILES} f join {_OWN} o on f.sha256 = o.sha256 and f.repository_id = o.owner")
def j7_owned_files(spark, d):
    f = files(spark, d, "sha256", "repository_id")
    return f.join(owners(spark, d).withColumnRenamed("owner", "repository_id"), ["sha256", "repository_id"], "left_semi").select("file_id")


@query(f"select sha256, owner from {_OWN}")
def w13_content_owner(spark, d):
    return owners(spark, d)


@query("""with e as (select user_id, ts, event_type, event_id from events), a as (select * from e where event_type = 'purchase'), b as (select * from e where event_type = 'click')
select a.event_id, (select max(b.ts) from b where b.user_id = a.user_id and b.ts <= a.ts) as last_click from a""")
def j9_last_before(spark, d):
    """As-of: for each purchase the time of the user's last click at or before it, by one window over the union."""
    e = table(spark, d, "events").where(F.col("event_type").isin("purchase", "click")).select("user_id", "ts", "event_type", "event_id")
    w = W.partitionBy("user_id").orderBy("ts").rangeBetween(W.unboundedPreceding, W.currentRow)
    return e.withColumn("last_click", F.max(F.when(F.col("event_type") == "click", F.col("ts"))).over(w)).where("event_type = 'purchase'").select("event_id", "last_click")


@query(f"select f.file_id, coalesce(b.pe, c.lines) as value from {FILES} f left join (select file_id, max(parse_errors) as pe from bindings group by all) b on f.file_id = b.file_id join {FILES} c on c.file_id = f.file_id")
def j11_override(spark, d):
    fix = table(spark, d, "bindings").groupBy("file_id").agg(F.max("parse_errors").alias("pe"))
    return files(spark, d, "lines").join(fix, "file_id", "left").select("file_id", F.coalesce("pe", "lines").alias("value"))


@query(f"select file_id from {FILES} f where not exists (select 1 from bindings b where b.repository_id = f.repository_id and b.relative_path = f.relative_path)")
def j12_not_excluded(spark, d):
    out = table(spark, d, "bindings").select("repository_id", "relative_path").distinct()
    return files(spark, d, "repository_id", "relative_path").join(out, ["repository_id", "relative_path"], "left_anti").select("file_id")


@query("select count(*) as n from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')")
def j13_semi(spark, d):
    o = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey").join(o, "l_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("n"))


_PAIRS = "with d as (select distinct repository_id as g, trim(x) as i from (select repository_id, unnest(string_split(regexp_replace(relative_path, '\\.[A-Za-z]+$', ''), '/')) as x from corpus) where trim(x) <> ''), s as (select g, count(*) as n from d group by all), p as (select a.g as a, b.g as b, count(*) as shared from d a join d b on a.i = b.i and a.g < b.g group by all), q as (select a, b, shared, shared::double / (x.n + y.n - shared) as jaccard from p join s x on x.g = a join s y on y.g = b)"


def path_parts(spark, d):
    stem = F.regexp_replace("relative_path", r"\.[A-Za-z]+$", "")
    p = table(spark, d, "corpus").select("repository_id", F.explode(F.split(stem, "/")).alias("x"))
    return p.select("repository_id", F.trim("x").alias("x")).where("x <> ''")


@query(_PAIRS + " select a, b, shared, jaccard from q where jaccard >= 0.15")
def j15_overlap_pairs(spark, d):
    return O.overlap_pairs(path_parts(spark, d), "repository_id", "x", 0.15)


@query("""with n as (select distinct repo_id, regexp_replace(lower(split_part(repo_id, '/', 3)), '[^a-z]', '', 'g')[:4] as name, list_distinct(regexp_extract_all(lower(repo_id), '[a-z0-9]{2,}')) as w from jobs)
select a.repo_id as a, b.repo_id as b, len(list_intersect(a.w, b.w))::double / len(list_distinct(list_concat(a.w, b.w))) as jaccard from n a join n b on a.name = b.name and a.repo_id < b.repo_id where len(list_intersect(a.w, b.w))::double / len(list_distinct(list_concat(a.w, b.w))) >= 0.6""")
def j16_same_name_pairs(spark, d):
    """Repositories of one bare name whose word sets are similar."""
    n = table(spark, d, "jobs").select("repo_id").distinct().withColumn("name", F.substring(F.regexp_replace(F.lower(F.split_part("repo_id", F.lit("/"), F.lit(3))), "[^a-z]", ""), 1, 4)).withColumn("w", X.words(F.col("repo_id")))
    a, b = n.toDF("a", "name", "wa"), n.toDF("b", "name", "wb")
    return a.join(b, "name").where("a < b").select("a", "b", X.jaccard(F.col("wa"), F.col("wb")).alias("jaccard")).where("jaccard >= 0.6")


@query("select count(*) as n from (select distinct repo_id from jobs where split = 'train' intersect select distinct repo_id from jobs where split in ('validation', 'test'))")
def j18_isolation(spark, d):
    j = table(spark, d, "jobs").select("repo_id", "split")
    return j.where("split = 'train'").select("repo_id").intersect(j.where("split in ('validation', 'test')").select("repo_id")).agg(F.count(F.lit(1)).alias("n"))


@query("select count(*) filter (e.repo_id is not null) as known, count(*) as n from (select distinct lower(repo_id) as r from jobs where split is null) j left join (select distinct lower(repo_id) as repo_id from jobs where split = 'train') e on j.r = e.repo_id")
def f23_eligible(spark, d):
    """Candidates that no training id equals, whatever the case."""
    j = table(spark, d, "jobs")
    train = j.where("split = 'train'").select(F.lower("repo_id").alias("r"), F.lit(1).alias("t")).distinct()
    c = j.where("split is null").select(F.lower("repo_id").alias("r")).distinct()
    return c.join(train, "r", "left").agg(F.count("t").alias("known"), F.count(F.lit(1)).alias("n"))


# --- aggregations


@query("select 'files.' || coalesce(language, 'none') as counter, count(*) as value from (select distinct file_id, language from corpus) group by all union all select 'samples.' || caret_kind, count(*) from (select distinct sample_id, caret_kind from samples) group by all")
def a1_counters(spark, d):
    f = files(spark, d, "language").select(F.concat(F.lit("files."), F.coalesce("language", F.lit("none"))).alias("counter"))
    s = table(spark, d, "samples").select("sample_id", "caret_kind").distinct().select(F.concat(F.lit("samples."), "caret_kind").alias("counter"))
    return f.union(s).groupBy("counter").agg(F.count(F.lit(1)).alias("value"))


@query("select event_type, count(*) as n, avg(value) as mean, quantile_disc(value, 0.5) as p50, quantile_disc(value, 0.95) as p95, quantile_disc(value, 0.99) as p99, max(value) as top from events group by all")
def a2_latency_summary(spark, d):
    q = lambda x: F.expr(f"percentile_disc({x}) within group (order by value)")
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), q(0.5).alias("p50"), q(0.95).alias("p95"), q(0.99).alias("p99"), F.max("value").alias("top"))


@query("with v as (select event_type, value, row_number() over (partition by event_type order by value) as r, count(*) over (partition by event_type) as n from events where value is not null) select event_type, max(value) filter (r = least(n, floor(0.95 * n)::bigint + 1)) as p95 from v group by all")
def a3_floor_percentile(spark, d):
    """v[min(n-1, int(q n))] from counts of distinct values: ranks come from prefix sums over values, not from sorted lists."""
    v = table(spark, d, "events").where("value is not null").groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("k"))
    w = W.partitionBy("event_type")
    r = v.withColumn("n", F.sum("k").over(w)).withColumn("upto", F.sum("k").over(w.orderBy("value").rowsBetween(W.unboundedPreceding, 0)))
    rank = F.least(F.col("n"), F.floor(F.col("n") * 0.95) + 1)
    return r.where(F.col("upto") >= rank).groupBy("event_type").agg(F.min("value").alias("p95"))


@query("with s as (select distinct sample_id, project, caret_kind from samples where project is not null) select project, coalesce(caret_kind, '_total') as kind, count(*) as n from s group by grouping sets ((project, caret_kind), (project))")
def a5_kind_total_rollup(spark, d):
    s = table(spark, d, "samples").where("project is not null").select("sample_id", "project", "caret_kind").distinct()
    r = s.rollup("project", "caret_kind").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    return r.where("g < 3").select("project", F.when(F.col("g") == 1, "_total").otherwise(F.col("caret_kind")).alias("kind"), "n")


@query("with s as (select distinct sample_id, caret_kind, semantic_status, target_text, quality_flags from samples) select caret_kind, count(*) as n, round_even(avg(length(target_text)), 3)::double as mean_target, round_even(avg((semantic_status = 'complete')::int), 4)::double as complete, sum(len(quality_flags))::bigint as flags from s group by all")
def a6_kind_stats(spark, d):
    s = table(spark, d, "samples").select("sample_id", "caret_kind", "semantic_status", "target_text", "quality_flags").distinct()
    rate = F.avg(F.when(F.col("semantic_status").isNotNull(), (F.col("semantic_status") == "complete").cast("double")))
    return s.groupBy("caret_kind").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(F.length("target_text")), 3).alias("mean_target"), F.bround(rate, 4).alias("complete"), F.sum(F.size("quality_flags")).alias("flags"))


@query("with p as (select file_id, max(parse_errors) as e, min(min_position) as m from bindings group by all), s as (select p.*, c.lines from p join (select distinct file_id, lines from corpus) c using (file_id)) select avg((e = 0)::int) as clean, avg((m > 0)::int) as moved, avg((e > 0 and m > 0)::int) as both_, count(*) as n from s")
def a7_paired_fractions(spark, d):
    p = table(spark, d, "bindings").groupBy("file_id").agg(F.max("parse_errors").alias("e"), F.min("min_position").alias("m"))
    s = p.join(files(spark, d, "lines"), "file_id")
    part = lambda c: F.avg(c.cast("double"))
    return s.agg(part(F.col("e") == 0).alias("clean"), part(F.col("m") > 0).alias("moved"), part((F.col("e") > 0) & (F.col("m") > 0)).alias("both_"), F.count(F.lit(1)).alias("n"))


@query("select c.agree::double / nullif(c.known, 0) as agreement, c.known from (select count(*) filter (j.split = f.split) as agree, count(*) filter (j.split is not null) as known from (select distinct repository_id, split from file_contexts) f left join (select repo_id, min(split) as split from jobs group by all) j on j.repo_id = f.repository_id) c")
def a9_agreement(spark, d):
    j = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("split").alias("js"))
    f = table(spark, d, "file_contexts").select("repository_id", "split").distinct().join(j, "repository_id", "left")
    known = F.count_if(F.col("js").isNotNull())
    return f.agg((F.count_if(F.col("js") == F.col("split")) / F.nullif(known, F.lit(0))).alias("agreement"), known.alias("known"))


@query("with a as (select file_id, min(license) as license, min(license_reason) as reason, min(encoding) as enc from corpus group by all), b as (select repo_id, min(license) as license from jobs group by all), c as (select distinct file_id, repository_id from corpus) select count(*) filter (a.license is not distinct from b.license) as same, count(*) filter (a.license is distinct from b.license) as differ from a join c using (file_id) join b on b.repo_id = c.repository_id")
def a10_run_diff(spark, d):
    c = table(spark, d, "corpus").groupBy("file_id", "repository_id").agg(F.min("license").alias("a"))
    j = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("license").alias("b"))
    same = F.col("a").eqNullSafe(F.col("b"))
    return c.join(j, "repository_id").agg(F.count_if(same).alias("same"), F.count_if(~same).alias("differ"))


@query("with r as (select tag, repo_id, max(samples) as samples from jobs where tag is not null and status = 'packed' group by all), t as (select tag, sum(samples) as s from r group by all), b as (select arg_max(tag, (s, tag)) as tag from t), o as (select r.*, sum(samples) over (order by samples desc, repo_id rows between unbounded preceding and 1 preceding) as before from r join b using (tag)) select repo_id, tag from o where coalesce(before, 0) < 200")
def a11_batch_fill(spark, d):
    """The tag with most samples ready, filled with its largest repositories until the target is reached."""
    r = table(spark, d, "jobs").where("tag is not null and status = 'packed'").groupBy("tag", "repo_id").agg(F.max("samples").alias("samples"))
    best = r.groupBy("tag").agg(F.sum("samples").alias("s")).agg(F.max_by("tag", F.struct("s", "tag")).alias("tag"))
    o = r.join(F.broadcast(best), "tag").withColumn("before", F.sum("samples").over(W.partitionBy("tag").orderBy(F.desc("samples"), "repo_id").rowsBetween(W.unboundedPreceding, -1)))
    return o.where(F.coalesce("before", F.lit(0)) < 200).select("repo_id", "tag")


@query("select status, count(*) as n, coalesce(sum(samples), 0)::bigint as samples from jobs group by all")
def a12_status_rollup(spark, d):
    return table(spark, d, "jobs").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"))


@query("select flag, count(*) as n from (select unnest(quality_flags) as flag from (select distinct sample_id, quality_flags from samples)) group by all order by n desc, flag limit 20")
def a13_top_flags(spark, d):
    s = table(spark, d, "samples").select("sample_id", "quality_flags").distinct()
    return s.select(F.explode("quality_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "flag").limit(20)


@query(f"with s as (select sha256 from {FILES} group by all having count(*) > 1), r as (select repository_id, count(*) as n, count(*) filter (f.sha256 in (select sha256 from s)) as dup from {FILES} f group by all) select repository_id, n, dup, round_even(dup::double / n, 3)::double as share, n >= 5 and dup >= 0.5 * n as mostly from r where dup > 0")
def a14_duplicate_share(spark, d):
    f = files(spark, d, "sha256", "repository_id")
    twice = f.groupBy("sha256").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("sha256", F.lit(1).alias("two"))
    r = f.join(twice, "sha256", "left").groupBy("repository_id").agg(F.count(F.lit(1)).alias("n"), F.count("two").alias("dup"))
    return r.where("dup > 0").select("repository_id", "n", "dup", F.bround(F.col("dup") / F.col("n"), 3).alias("share"), ((F.col("n") >= 5) & (F.col("dup") >= 0.5 * F.col("n"))).alias("mostly"))


@query("select g.gate, count(*) as n, count(*) filter (value >= g.gate) as shown, avg((value >= g.gate and event_type = 'purchase')::int) as precise from events, (values (0.5), (0.7), (0.8)) g(gate) where value is not null group by all".replace("(0.5)", "(0.5::double)").replace("(0.7)", "(0.7::double)").replace("(0.8)", "(0.8::double)"))
def a19_gate_sweep(spark, d):
    """Rates at several gates in one pass: rows are exploded by a fixed list of gates after pre-aggregation by value."""
    e = table(spark, d, "events").where("value is not null").groupBy("value", (F.col("event_type") == "purchase").alias("hit")).agg(F.count(F.lit(1)).alias("k"))
    g = e.withColumn("gate", F.explode(F.array(*[F.lit(x) for x in (0.5, 0.7, 0.8)])))
    over = F.col("value") >= F.col("gate")
    k = F.col("k")
    return g.groupBy("gate").agg(F.sum(k).alias("n"), F.coalesce(F.sum(F.when(over, k)), F.lit(0)).alias("shown"), (F.coalesce(F.sum(F.when(over & F.col("hit"), k)), F.lit(0)) / F.sum(k)).alias("precise"))


@query()
def a20_paired_bootstrap(spark, d):
    """Mean difference of two paired measures with a 95 % interval over 2,000 seeded resamples, from counts of differences."""
    e = table(spark, d, "bindings").groupBy("file_id").agg(F.max("parse_errors").alias("a"), F.max("min_position").alias("b")).where("a is not null and b is not null")
    counts = e.groupBy(((F.col("b") > 0).cast("int") - (F.col("a") > 0).cast("int")).alias("diff")).agg(F.count(F.lit(1)).alias("k"))  # at most three rows

    def resample(key, pdf):
        import numpy as np
        import pandas as pd

        n, x = int(pdf["k"].sum()), pdf.sort_values("diff")
        draws = np.random.default_rng(1).multinomial(n, x["k"] / n, size=2000) @ x["diff"].to_numpy() / n
        return pd.DataFrame({"n": [n], "mean": [float((x["k"] * x["diff"]).sum() / n)], "low": [float(np.percentile(draws, 2.5))], "high": [float(np.percentile(draws, 97.5))]})

    return counts.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(resample, "n bigint, mean double, low double, high double")


@query()
def a22_water_fill(spark, d):
    sizes = files(spark, d, "repository_id", "bytes").groupBy("repository_id").agg(F.sum("bytes").alias("s"))
    return O.water_fill(sizes, "repository_id", "s", 400_000)


@query("select count(distinct user_id) as users, count(distinct event_type) as kinds from events")
def a25_distinct(spark, d):
    return table(spark, d, "events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("kinds"))


# --- windows and caps

_LINES = f"(select distinct sample_id, repository_id, relative_path, caret_line_zero_based as line, caret_utf16_offset as off, {u_sql(chr(39) + '7' + chr(39), 'sample_id')} as u from samples)"


def scored(spark, d):
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", F.col("caret_line_zero_based").alias("line"), F.col("caret_utf16_offset").alias("off")).distinct()
    return s.withColumn("u", X.uniform(F.lit("7"), F.col("sample_id")))


@query(f"with a as (select *, row_number() over (partition by repository_id, relative_path, line order by u, off, sample_id) as r from {_LINES}) select sample_id from a where r <= 2")
def w1_cap_per_line(spark, d):
    return O.keep_first_n(scored(spark, d), ["repository_id", "relative_path", "line"], [F.col("u"), F.col("off"), F.col("sample_id")], 2, ["sample_id"]).select("sample_id")


@query(f"with a as (select *, row_number() over (partition by repository_id, relative_path, line order by u, off, sample_id) as r from {_LINES}), b as (select *, row_number() over (partition by repository_id, relative_path order by u, off, sample_id) as q from a where r <= 2) select sample_id from b where q <= 3")
def w2_cap_per_file(spark, d):
    by = [F.col("u"), F.col("off"), F.col("sample_id")]
    first = O.keep_first_n(scored(spark, d), ["repository_id", "relative_path", "line"], by, 2, ["sample_id"])
    return O.keep_first_n(first, ["repository_id", "relative_path"], by, 3, ["sample_id"]).select("sample_id")


@query("""with s as (select distinct sample_id, repository_id, coalesce(project, '-') as project from samples), a as (select *, row_number() over (partition by repository_id, project order by sample_id) as r from s),
b as (select *, coalesce(sum((r <= 10)::int) over (partition by repository_id order by sample_id rows between unbounded preceding and 1 preceding), 0) as before from a) select sample_id, case when before >= 25 then 'outer_cap' when r > 10 then 'inner_cap' end as drop_reason from b""")
def w3_admission_caps(spark, d):
    s = table(spark, d, "samples").select("sample_id", "repository_id", F.coalesce("project", F.lit("-")).alias("project")).distinct()
    key = s.withColumn("inner", F.concat_ws("|", "repository_id", "project"))
    return O.admission(key, "inner", 10, "repository_id", 25, [F.col("sample_id")], ["sample_id"]).select("sample_id", "drop_reason")


@query("with l as (select distinct sample_id, relative_path, caret_utf16_offset as off, trim(left_context[-20:]) || chr(1) || target_text as k from samples), r as (select *, row_number() over (partition by k order by relative_path, off, sample_id) as n from l) select sample_id from r where n = 1")
def w4_first_of_duplicates(spark, d):
    s = table(spark, d, "samples").select("sample_id", "relative_path", F.col("caret_utf16_offset").alias("off"), F.concat(F.trim(F.right("left_context", F.lit(20))), F.lit("\x01"), "target_text").alias("k")).distinct()
    return s.groupBy("k").agg(F.min_by("sample_id", F.struct("relative_path", "off", "sample_id")).alias("sample_id")).select("sample_id")


@query("with j as (select distinct repo_id, reason from jobs where reason is not null), r as (select *, row_number() over (partition by reason order by repo_id) as n from j) select reason, repo_id from r where n <= 25")
def w5_examples_per_reason(spark, d):
    j = table(spark, d, "jobs").where("reason is not null").select("repo_id", "reason").distinct()
    return O.keep_first_n(j, ["reason"], [F.col("repo_id")], 25, ["repo_id"]).select("reason", "repo_id")


@query("with j as (select repo_id, max(priority) as p, max(size_kb) as k from jobs group by all), r as (select *, row_number() over (partition by split_part(repo_id, '/', 2) order by p desc nulls last, k desc nulls last, repo_id) as n from j) select repo_id from r where n <= 3")
def w6_owner_cap(spark, d):
    j = table(spark, d, "jobs").groupBy("repo_id").agg(F.max("priority").alias("p"), F.max("size_kb").alias("k")).withColumn("owner", F.split_part("repo_id", F.lit("/"), F.lit(2)))
    return O.keep_first_n(j, ["owner"], [F.desc_nulls_last("p"), F.desc_nulls_last("k"), F.asc("repo_id")], 3, ["repo_id"]).select("repo_id")


@query("select doc_id, (coalesce(sum(length(text)) over (order by doc_id rows between unbounded preceding and 1 preceding), 0))::bigint as start from documents where text is not null")
def w7_prefix_offsets(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.length("text").alias("n"))
    return O.prefix_sum(docs, "doc_id", "n", out="start").select("doc_id", "start")


@query("select lower(trim(grp)) as g, arg_max(repo_id, (coalesce(priority, -1), coalesce(size_kb, -1), repo_id)) as member from jobs where grp is not null group by all")
def w8_canonical_member(spark, d):
    j = table(spark, d, "jobs").where("grp is not null")
    return j.groupBy(F.lower(F.trim("grp")).alias("g")).agg(F.max_by("repo_id", F.struct(F.coalesce("priority", F.lit(-1)), F.coalesce("size_kb", F.lit(-1)), "repo_id")).alias("member"))


@query("with j as (select distinct repo_id, coalesce(tag, '-') as tag from jobs), r as (select *, row_number() over (partition by tag order by sha256('5:' || repo_id), repo_id) as n from j) select tag, repo_id from r where n <= 4")
def w9_draw_per_bucket(spark, d):
    j = table(spark, d, "jobs").select("repo_id", F.coalesce("tag", F.lit("-")).alias("tag")).distinct().withColumn("h", F.sha2(F.concat(F.lit("5:"), "repo_id"), 256))
    return O.keep_first_n(j, ["tag"], [F.col("h"), F.col("repo_id")], 4, ["repo_id"]).select("tag", "repo_id")


@query("with s as (select distinct sample_id, repository_id, sha256('3:' || sample_id) as h from samples), r as (select *, row_number() over (partition by repository_id order by h, sample_id) as n from s) select sample_id from (select sample_id, h from r where n <= 5 order by h, sample_id limit 230)")
def w10_cap_then_limit(spark, d):
    s = table(spark, d, "samples").select("sample_id", "repository_id").distinct().withColumn("h", F.sha2(F.concat(F.lit("3:"), "sample_id"), 256))
    return O.keep_first_n(s, ["repository_id"], [F.col("h"), F.col("sample_id")], 5, ["sample_id"]).orderBy("h", "sample_id").limit(230).select("sample_id")


@query("select repo_id, arg_max(status, (coalesce(attempts, 0), started, coalesce(finished, timestamp '1970-01-01'), status)) as status from jobs where started is not null group by all")
def w12_latest_record(spark, d):
    j = table(spark, d, "jobs").where("started is not null").select("repo_id", "status", F.coalesce("attempts", F.lit(0)).alias("a"), "started", F.coalesce("finished", F.expr("timestamp_ntz '1970-01-01'")).alias("f"))
    return O.latest(j, "repo_id", ["a", "started", "f", "status"]).select("repo_id", "status")


@query("""with s as (select distinct sample_id, caret_kind, sha256('9:' || sample_id) as h from samples), k as (select caret_kind, count(*) as n from s group by all), t as (select sum(n) as t from k), q as (select caret_kind, least(n, 20 + floor(200 * n / t)::bigint) as quota from k, t), r as (select s.*, row_number() over (partition by caret_kind order by h, sample_id) as i from s) select sample_id from r join q using (caret_kind) where i <= quota""")
def w14_stratified_quota(spark, d):
    s = table(spark, d, "samples").select("sample_id", "caret_kind").distinct().withColumn("h", F.sha2(F.concat(F.lit("9:"), "sample_id"), 256))
    k = s.groupBy("caret_kind").agg(F.count(F.lit(1)).alias("n"))
    t = k.agg(F.sum("n").alias("t"))
    q = k.crossJoin(F.broadcast(t)).select("caret_kind", F.least("n", F.lit(20) + F.floor(F.lit(200) * F.col("n") / F.col("t"))).alias("quota"))  # one row on the right
    ranked = O.capped_rank(s, ["caret_kind"], [F.col("h"), F.col("sample_id")], 220, ["sample_id"], "i").where("i is not null")
    return ranked.join(F.broadcast(q), "caret_kind").where("i <= quota").select("sample_id")


# --- sampling


@query(f"select sample_id from (select distinct sample_id, is_test from samples) where {u_sql(chr(39) + '7' + chr(39), chr(39) + 'keep' + chr(39), 'sample_id')} < 0.4 * (case when is_test then 0.5 else 1.0 end)")
def l4_thinning(spark, d):
    s = table(spark, d, "samples").select("sample_id", "is_test").distinct()
    return s.where(X.uniform(F.lit("7"), F.lit("keep"), F.col("sample_id")) < 0.4 * F.when(F.col("is_test"), 0.5).otherwise(1.0)).select("sample_id")


@query(f"select count(*) filter ({u_sql(chr(39) + 'semantic_subset' + chr(39), 'sample_id')} < 0.1) as n from (select distinct sample_id from samples)")
def l5_subset(spark, d):
    return table(spark, d, "samples").select("sample_id").distinct().agg(F.count_if(X.uniform(F.lit("semantic_subset"), F.col("sample_id")) < 0.1).alias("n"))


@query("with r as (select distinct file_id, repository_id, is_test from corpus), c as (select repository_id, count(*) as total, count(*) filter (is_test) as tests from r group by all) select repository_id, least(1.0, 4.0 / total)::double as keep, case when tests > 0 then least(1.0, 0.25 * total / tests)::double else 1.0::double end as test_keep from c")
def l8_budget_fractions(spark, d):
    c = files(spark, d, "repository_id", "is_test").groupBy("repository_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_test").alias("tests"))
    return c.select("repository_id", F.least(F.lit(1.0), F.lit(4.0) / F.col("total")).alias("keep"), F.when(F.col("tests") > 0, F.least(F.lit(1.0), 0.25 * F.col("total") / F.col("tests"))).otherwise(1.0).alias("test_keep"))


@query("with t as (select doc_id, length(text) as n, sha256('1:' || doc_id) as h from documents where text is not null), c as (select doc_id, n, sum(n) over (order by h, doc_id rows between unbounded preceding and current row) as upto from t) select doc_id from c where upto - n < 50000")
def l9_until_budget(spark, d):
    """Texts in hash order until a number of characters is reached: block totals first, order within the last block only."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.length("text").alias("n"), F.sha2(F.concat(F.lit("1:"), F.col("doc_id").cast("string")), 256).alias("h")).withColumn("b", F.substring("h", 1, 2))
    blocks = t.groupBy("b").agg(F.sum("n").alias("t")).withColumn("before", F.coalesce(F.sum("t").over(W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # 256 rows
    j = t.join(F.broadcast(blocks.where("before < 50000").select("b", "before")), "b")
    inner = F.coalesce(F.sum("n").over(W.partitionBy("b").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return j.withColumn("start", F.col("before") + inner).where("start < 50000").select("doc_id")


@query(f"select sample_id from (select distinct sample_id from samples) order by {u_sql(chr(39) + 'inspect' + chr(39), 'sample_id')}, sample_id limit 20")
def l10_inspect(spark, d):
    return table(spark, d, "samples").select("sample_id").distinct().orderBy(X.uniform(F.lit("inspect"), F.col("sample_id")), "sample_id").limit(20)


@query()
def l13_little_endian(spark, d):
    return table(spark, d, "jobs").select("repo_id").distinct().select("repo_id", X.uniform_le(F.lit("x"), F.col("repo_id")).alias("u"))


# --- dedup, sets, graphs


@query("select full_name, repo_id from (select *, row_number() over (partition by lower(full_name) order by repo_id, started nulls first, attempts) as r from jobs) where r = 1")
def d3_first_of_name(spark, d):
    j = table(spark, d, "jobs").select("full_name", "repo_id", "started", "attempts")
    return O.keep_first(j, [F.lower("full_name")], [F.col("repo_id"), F.col("started"), F.col("attempts")]).select("full_name", "repo_id")


@query(f"select count(*) as files, count(distinct sha256) as contents, count(*) - count(distinct sha256) as duplicates from {FILES}")
def d4_content_duplicates(spark, d):
    return files(spark, d, "sha256").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("sha256").alias("contents"), (F.count(F.lit(1)) - F.count_distinct("sha256")).alias("duplicates"))


@query("select repo_id from jobs intersect select repository_id from corpus")
def d6_intersect(spark, d):
    return table(spark, d, "jobs").select("repo_id").intersect(table(spark, d, "corpus").select("repository_id"))


@query("select repo_id from jobs except select repository_id from corpus")
def d6_except(spark, d):
    return table(spark, d, "jobs").select("repo_id").subtract(table(spark, d, "corpus").select("repository_id"))


@query("select id, min(source) as source from (select repo_id as id, 1 as source from jobs union all select repo_id, 2 from license_info union all select repository_id, 3 from corpus) where id not like '%ledgerkit' group by all")
def d8_union_of_manifests(spark, d):
    u = table(spark, d, "jobs").select(F.col("repo_id").alias("id"), F.lit(1).alias("source")).unionByName(table(spark, d, "license_info").select(F.col("repo_id").alias("id"), F.lit(2).alias("source"))).unionByName(table(spark, d, "corpus").select(F.col("repository_id").alias("id"), F.lit(3).alias("source")))
    return u.where(~F.col("id").endswith("ledgerkit")).groupBy("id").agg(F.min("source").alias("source"))


@query(_PAIRS.replace("with d", "with recursive d", 1) + ", e as (select a, b from q where jaccard >= 0.15 union select b, a from q where jaccard >= 0.15), reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a) select a as node, least(a, min(b)) as root from reach group by a")
def g1_components(spark, d):
    return O.overlap_components(path_parts(spark, d), "repository_id", "x", 0.15)


# --- job state


@query("select repo_id from (select repo_id, arg_max(status, (coalesce(attempts, 0), started, coalesce(finished, timestamp '1970-01-01'), status)) as status from jobs where started is not null group by all) where status in ('pending', 'running', 'failed')")
def k3_resumable(spark, d):
    return w12_latest_record(spark, d).where("status in ('pending', 'running', 'failed')").select("repo_id")


@query("""with e as (select user_id::varchar as id, event_type as state, ts, event_id from events), p as (select *, lag(state) over (partition by id order by ts, event_id) as prev from e)
select id, event_id, case when prev is null or (prev, state) in (('view', 'click'), ('click', 'purchase'), ('view', 'view'), ('click', 'click'), ('purchase', 'view')) then null else 'illegal_transition' end as problem from p""")
def k1_transitions(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("state"), "ts", "event_id")
    legal = [("view", "click"), ("click", "purchase"), ("view", "view"), ("click", "click"), ("purchase", "view")]
    return J.check_transitions(e, "id", "state", ["ts", "event_id"], legal).select("id", "event_id", "problem")


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n, sum(value) as total from events group by all")
def k9_hourly_throughput(spark, d):
    """Events per hour and kind. The streaming form of the same plan is in tessel.streaming."""
    return J.windowed(table(spark, d, "events"), "ts", "1 hour", "event_type", "value").select(F.col("window.start").alias("start"), "event_type", "n", "total")


@query("""with a as (select repo_id, status, samples, attempts from jobs where attempts = 1), b as (select repo_id, status, samples, attempts from jobs where attempts > 1),
x as (select repo_id, status, samples from a except all select repo_id, status, samples from b), y as (select repo_id, status, samples from b except all select repo_id, status, samples from a)
select 'first' as side, count(*) as rows_only_here from x union all select 'second', count(*) from y""")
def v7_identity(spark, d):
    """The rows in which two runs differ, by side: the first attempts of all jobs against the later ones."""
    j = table(spark, d, "jobs").select("repo_id", "status", "samples", "attempts")
    a, b = j.where("attempts = 1").drop("attempts"), j.where("attempts > 1").drop("attempts")
    side = lambda x, y, name: x.exceptAll(y).agg(F.count(F.lit(1)).alias("rows_only_here")).select(F.lit(name).alias("side"), "rows_only_here")
    return side(a, b, "first").union(side(b, a, "second"))


@query("select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, sum(l_extendedprice) as sum_base, sum(l_extendedprice * (1 - l_discount)) as sum_disc, avg(l_quantity) as avg_qty, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def q1_pricing(spark, d):
    line = table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return line.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_base"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_disc"), F.avg("l_quantity").alias("avg_qty"), F.count(F.lit(1)).alias("n"))


@query("select doc_id, count(*) as lines, count(*) filter (trim(line, ' ' || chr(9) || chr(13)) = '') as blank, max(length(line))::int as longest from (select doc_id, unnest(string_split(text, chr(10))) as line from documents where text is not null) group by all")
def u9_prose_lines(spark, d):
    line = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return line.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.regexp_replace("line", r"^[ \t\r]+|[ \t\r]+$", "") == "").alias("blank"), F.max(F.length("line")).alias("longest"))


@query(_PAIRS.replace("with d", "with recursive d", 1) + f", e as (select a, b from q where jaccard >= 0.15 union select b, a from q where jaccard >= 0.15), reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a), c as (select a as node, least(a, min(b)) as root from reach group by a), r as (select distinct repository_id, coalesce(root, repository_id) as root from corpus left join c on node = repository_id), u as (select *, {u_sql(chr(39) + '20261009' + chr(39), chr(39) + 'repo_split' + chr(39), 'root')} as u from r) select repository_id, root, case when u < 0.1 then 'validation' when u < 0.2 then 'test' else 'train' end as split from u")
def g3_group_split(spark, d):
    """Splits of whole groups of similar repositories, by the hash of the group's smallest member."""
    c = g1_components(spark, d).select(F.col("node").alias("repository_id"), "root")
    r = table(spark, d, "corpus").select("repository_id").distinct().join(c, "repository_id", "left").select("repository_id", F.coalesce("root", "repository_id").alias("root"))
    return r.withColumn("split", O.hash_split(F.col("root"), "20261009", "repo_split", [("validation", 0.1), ("test", 0.1)], "train"))


@query("with n as (select doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) as t from documents where text is not null), g as (select t, min(doc_id) as root, count(*) as n from n where length(t) >= 40 group by t having count(*) > 1) select doc_id, 'grp_' || substr(sha256(root::varchar), 1, 10) as grp, g.n as members from n join g using (t)")
def g4_same_text_groups(spark, d):
    """Texts of at least 40 characters that are equal after normalisation, with the id of their group."""
    t = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    n = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(t, 256).alias("t"), F.length(t).alias("k")).where("k >= 40")
    g = n.groupBy("t").agg(F.min("doc_id").alias("root"), F.count(F.lit(1)).alias("members")).where("members > 1")
    return n.join(g, "t").select("doc_id", F.concat(F.lit("grp_"), F.substring(F.sha2(F.col("root").cast("string"), 256), 1, 10)).alias("grp"), "members")


@query()
def x13_compact_signatures(spark, d):
    """Method signatures of C# files in their compact form."""
    rx = r"(?m)^[ \t]+(?:public|private|internal|protected)[ \t]+(?:static[ \t]+|async[ \t]+|override[ \t]+)*([\w<>,.?\[\] ]+ \w+\([^()\n]*\))"
    s = files(spark, d, "language", "content").where("language = 'csharp'").select("file_id", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(rx), 1))).alias("s"))
    return s.select("file_id", X.compact_signature(F.col("s")).alias("signature"))
