"""Reports and comparisons of runs: breakdowns, agreement, gates, checks of records, throughput, spans and profiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X
from tessel.operators import core as O
from tessel.plans.files import discovered, files
from tessel.plans.registry import FILES, ORACLES, query
from tessel.session import table
from tessel.streaming import jobs as J

_S = "(select distinct sample_id, repository_id, caret_kind, caret_subkind, project, is_test, semantic_status, quality_flags, target_text, end_of_line, tags from samples)"


def samples(spark, d):
    return table(spark, d, "samples").select("sample_id", "repository_id", "caret_kind", "caret_subkind", "project", "is_test", "semantic_status", "quality_flags", "target_text", "end_of_line", "tags").distinct()


_DISC = ORACLES["f1_discovery_files"]
_SPLITS = "(select repo_id, min(split) as split from jobs group by 1)"


@query(f"""with o as ({_DISC}), s as (select s.*, split from {_S} s left join {_SPLITS} j on repository_id = repo_id)
select 'files.reason' as breakdown, reason as value, count(*) as n from o group by all union all select 'files.status', case when reason = 'accepted' then 'accepted' else 'rejected' end, count(*) from o group by all
union all select 'samples.kind', caret_kind, count(*) from s group by all union all select 'samples.subkind', coalesce(caret_subkind, 'none'), count(*) from s group by all union all select 'samples.split', coalesce(split, 'none'), count(*) from s group by all
union all select 'samples.status', coalesce(semantic_status, 'none'), count(*) from s group by all union all select 'samples.end_of_line', coalesce(end_of_line, 'none'), count(*) from s group by all union all select 'samples.test', is_test::varchar, count(*) from s group by all
union all select 'samples.flag', f, count(*) from (select unnest(quality_flags) as f from s) group by all""")
def a4_run_summary(spark, d):
    """Nine breakdowns of a run as rows: the samples are read once, each gives a row per breakdown before the only aggregation."""
    o = discovered(spark, d).select("reason")
    split = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("split").alias("split"))
    s = samples(spark, d).join(split, "repository_id", "left")
    pair = lambda n, c: F.struct(F.lit(n).alias("breakdown"), c.alias("value"))
    or_none = lambda c: F.coalesce(F.col(c), F.lit("none"))
    of_file = F.array(pair("files.reason", F.col("reason")), pair("files.status", F.when(F.col("reason") == "accepted", "accepted").otherwise("rejected")))
    of_sample = F.concat(F.array(pair("samples.kind", F.col("caret_kind")), pair("samples.subkind", or_none("caret_subkind")), pair("samples.split", or_none("split")), pair("samples.status", or_none("semantic_status")), pair("samples.end_of_line", or_none("end_of_line")), pair("samples.test", F.col("is_test").cast("string"))), F.transform(F.coalesce("quality_flags", F.array().cast("array<string>")), lambda f: pair("samples.flag", f)))
    return o.select(F.inline(of_file)).union(s.select(F.inline(of_sample))).groupBy("breakdown", "value").agg(F.count(F.lit(1)).alias("n"))


@query(f"select round_even((count(*) - count(distinct target_text))::double / count(*), 6)::double as duplicate_fraction, round_even(avg(length(target_text)), 3)::double as mean_target_chars, count(*) as n from {_S}")
def a4_fractions(spark, d):
    """Duplicate fraction and mean length of targets, halves to even. Targets are counted by value first, so that one hot target isn't a hot row."""
    t = samples(spark, d).groupBy("target_text").agg(F.count(F.lit(1)).alias("k"))
    n = F.sum("k")
    return t.agg(F.bround((n - F.count(F.lit(1))) / n, 6).alias("duplicate_fraction"), F.bround(F.sum(F.col("k") * F.length("target_text")) / n, 3).alias("mean_target_chars"), n.alias("n"))


@query(f"select caret_kind, coalesce(semantic_status, 'none') as policy, count(*) as n, round_even(avg(length(target_text)), 4)::double as mean_target, round_even(avg((len(quality_flags) > 0)::int), 4)::double as flagged from {_S} group by all")
def a8_kind_by_policy(spark, d):
    s = samples(spark, d)
    return s.groupBy("caret_kind", F.coalesce("semantic_status", F.lit("none")).alias("policy")).agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(F.length("target_text")), 4).alias("mean_target"), F.bround(F.avg((F.size("quality_flags") > 0).cast("double")), 4).alias("flagged"))


_RUN = "(select repo_id, min(status) as status, min(reason) as reason, max(samples) as samples, max(semantic) as semantic, max(cs_bytes) as cs_bytes, min(split) as split, min(license) as license, min(tag) as tag, list_sort(list(coalesce(revision, ''))) as revisions from jobs where {} group by 1)"


@query(f"""with a as {_RUN.format('attempts = 1')}, b as {_RUN.format('attempts > 1')}, j as (select a.*, b.repo_id is not null as both_there, b.status as s2, b.reason as r2, b.samples as n2, b.semantic as m2, b.cs_bytes as c2, b.split as p2, b.license as l2, b.tag as t2, b.revisions as v2 from a full join b on a.repo_id = b.repo_id)
select count(*) filter (repo_id is not null and both_there) as compared, count(*) filter (repo_id is not null and not both_there) as only_first, count(*) filter (repo_id is null) as only_second, count(*) filter (both_there and status is distinct from s2) as status, count(*) filter (both_there and reason is distinct from r2) as reason,
 count(*) filter (repo_id is not null and both_there and samples is distinct from n2) as samples, count(*) filter (repo_id is not null and both_there and semantic is distinct from m2) as semantic, count(*) filter (repo_id is not null and both_there and cs_bytes is distinct from c2) as cs_bytes, count(*) filter (repo_id is not null and both_there and split is distinct from p2) as split,
 count(*) filter (repo_id is not null and both_there and license is distinct from l2) as license, count(*) filter (repo_id is not null and both_there and tag is distinct from t2) as tag, count(*) filter (repo_id is not null and both_there and revisions is distinct from v2) as revisions from (select j.*, true as x from j) where true""".replace("both_there and status", "repo_id is not null and both_there and status").replace("both_there and reason", "repo_id is not null and both_there and reason"))
def a10_run_comparison(spark, d):
    """Two runs of the same jobs (first and later attempts): in how many each of nine facts differs; lists are compared without
    their order, nulls are equal."""
    facts = ["status", "reason", "samples", "semantic", "cs_bytes", "split", "license", "tag", "revisions"]
    rows = table(spark, d, "jobs").withColumn("first", F.col("attempts") == 1)
    side = rows.where("attempts is not null").groupBy("repo_id", "first").agg(F.min("status").alias("status"), F.min("reason").alias("reason"), F.max("samples").alias("samples"), F.max("semantic").alias("semantic"), F.max("cs_bytes").alias("cs_bytes"), F.min("split").alias("split"), F.min("license").alias("license"), F.min("tag").alias("tag"), F.sort_array(F.collect_list(F.coalesce("revision", F.lit("")))).alias("revisions"))
    # one shuffle: both runs of a job meet in one group of two rows at most
    both = side.groupBy("repo_id").agg(*[F.max(F.when(F.col("first") == f, F.struct(*facts))).alias(n) for n, f in (("a", True), ("b", False))])
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.agg(F.count_if(there).alias("compared"), F.count_if(F.col("b").isNull()).alias("only_first"), F.count_if(F.col("a").isNull()).alias("only_second"), *[F.count_if(there & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))).alias(f) for f in facts])


_LATEST = "(select repo_id, arg_max(status, (coalesce(attempts, 0), repo_id, status)) as status, min(license) as license, min(reason) as reason, min(tag) as tag, max(lower(split_part(repo_id, '/', 2))) as owner from jobs group by 1)"


@query(f"""with j as {_LATEST}, u as (select 'status' as what, coalesce(status, 'none') as value from j union all select 'license', coalesce(license, 'none') from j union all select 'reason', coalesce(reason, 'none') from j union all select 'tag', coalesce(tag, 'none') from j union all select 'owner', owner from j),
c as (select what, value, count(*) as n from u group by all), r as (select *, row_number() over (partition by what order by n desc, value) as place from c) select what, value, n from r where place <= 20""")
def a13_selection_report(spark, d):
    """The twenty most frequent values of each of five columns, by count, then value."""
    j = table(spark, d, "jobs").groupBy("repo_id").agg(F.max_by("status", F.struct(F.coalesce("attempts", F.lit(0)), "repo_id", "status")).alias("status"), F.min("license").alias("license"), F.min("reason").alias("reason"), F.min("tag").alias("tag"))
    j = j.withColumn("owner", F.lower(F.split_part("repo_id", F.lit("/"), F.lit(2))))
    u = j.select(F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.coalesce(F.col(c), F.lit("none")).alias("value")) for c in ("status", "license", "reason", "tag", "owner")])))
    c = u.groupBy("what", "value").agg(F.count(F.lit(1)).alias("n"))
    return O.keep_first_n(c, ["what"], [F.desc("n"), F.asc("value")], 20, ["value"]).select("what", "value", "n")


_IMPORT = r'(?m)^(?:import[ \t]+(?:[\w.]+[ \t]+)?|[ \t]+(?:[\w.]+[ \t]+)?)"([\w.-]+(?:/[\w.~-]+)*)"'
_GO_ROOT = "case when not contains(split_part(p, '/', 1), '.') then null else array_to_string(string_split(p, '/')[1:3], '/') end"


@query(f"with i as (select distinct file_id, repository_id, unnest(regexp_extract_all(content, '{_IMPORT}', 1)) as p from {FILES} where language = 'go'), r as (select distinct repository_id, file_id, {_GO_ROOT} as root from i) select repository_id, root, count(*) as files, bool_or(repository_id = root) as own from r where root is not null group by all")
def x15_go_roots(spark, d):
    """Roots of Go imports: host, owner and name of the module, without the standard library; own are those of the repository itself."""
    f = files(spark, d, "repository_id", "language", "content").where("language = 'go'")
    p = f.select("repository_id", "file_id", F.explode(F.regexp_extract_all("content", F.lit(_IMPORT), 1)).alias("p"))
    root = F.when(F.split_part("p", F.lit("/"), F.lit(1)).contains("."), F.array_join(F.slice(F.split("p", "/"), 1, 3), "/"))
    r = p.select("repository_id", "file_id", root.alias("root")).where("root is not null").distinct()
    return r.groupBy("repository_id", "root").agg(F.count(F.lit(1)).alias("files"), F.bool_or(F.col("repository_id") == F.col("root")).alias("own"))


_A15 = ORACLES["a15_dependency_roots"]


@query(f"with n as ({_A15}), t as (select count(distinct repository_id) as repos from n), r as (select root, count(distinct repository_id) as repositories, sum(files)::bigint as files from n group by 1) select root, repositories, files, repositories::double / t.repos as share from r, t order by repositories desc, root limit 60")
def a15_top_roots(spark, d):
    """The sixty roots that most repositories use, with the part of repositories they cover."""
    from tessel.plans.files import file_roots

    n = file_roots(spark, d).groupBy("repository_id", "root").agg(F.count(F.lit(1)).alias("files"))
    total = n.agg(F.count_distinct("repository_id").alias("repos"))
    r = n.groupBy("root").agg(F.count(F.lit(1)).alias("repositories"), F.sum("files").alias("files")).crossJoin(F.broadcast(total))  # one row on the right
    return r.select("root", "repositories", "files", (F.col("repositories") / F.col("repos")).alias("share")).orderBy(F.desc("repositories"), "root").limit(60)


@query(ORACLES["x16_profile_roots"].replace("select file_id, root, others from p where others >= 2", "select file_id, list(root order by others desc, root) as profile from p where others >= 2 group by 1"))
def x16_ordered_profiles(spark, d):
    """For each file the roots of at least two other files of its repository, the most used first."""
    from tessel.plans.files import x16_profile_roots

    r = x16_profile_roots(spark, d)
    return r.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("others")).alias("o"), "root"))).alias("p")).select("file_id", F.transform("p", lambda x: x["root"]).alias("profile"))


_GOT, _LENIENT = "rtrim(left_context[-12:])", "(left_context like '% ' and ltrim(rtrim(left_context[-12:])) = ltrim(rtrim(target_text)))"


@query(f"""with s as (select distinct sample_id, caret_kind, left_context, target_text, length(target_text) / 10.0::double as conf from samples), g as (select unnest([0.5::double, 0.7::double, 0.8::double]) as gate),
h as (select s.*, {_GOT} = rtrim(target_text) as strict_hit, {_GOT} = rtrim(target_text) or {_LENIENT} as lenient_hit from s)
select gate, caret_kind, count(*) as n, count(*) filter (conf >= gate) as shown, count(*) filter (conf >= gate and strict_hit) as strict_hits, count(*) filter (conf >= gate and lenient_hit) as lenient_hits from h, g group by all""")
def a19_gates_by_kind(spark, d):
    """Strict and lenient hits among what is shown at three gates, by kind, on a stand-in model. Rows are pre-aggregated before
    they are exploded by the fixed list of gates."""
    from tessel.operators import edits as E

    s = table(spark, d, "samples").select("sample_id", "caret_kind", "left_context", "target_text").distinct()
    got = F.right("left_context", F.lit(12))
    hits = s.select("caret_kind", F.length("target_text").alias("len"), E.exact(got, F.col("target_text")).alias("strict"), E.exact(got, F.col("target_text"), F.col("left_context")).alias("lenient"))
    k = hits.groupBy("caret_kind", "len", "strict", "lenient").agg(F.count(F.lit(1)).alias("k")).withColumn("gate", F.explode(F.array(F.lit(0.5), F.lit(0.7), F.lit(0.8))))
    shown = F.col("len") / 10 >= F.col("gate")
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("k"))), F.lit(0))
    return k.groupBy("gate", "caret_kind").agg(F.sum("k").alias("n"), part(shown).alias("shown"), part(shown & F.col("strict")).alias("strict_hits"), part(shown & F.col("lenient")).alias("lenient_hits"))


@query("""with s as (select distinct sample_id, caret_kind, target_text, right_context, left_context, end_of_line, caret_utf16_offset as a, target_end_utf16_offset as b, line_end_utf16_offset as le from samples),
u as (select caret_kind, unnest([case when target_text = '' then 'empty_completion' end, case when contains(target_text, chr(10)) then 'newline_in_completion' end, case when b > le then 'beyond_line' end, case when a >= b then 'no_span' end, case when contains(target_text, '<|') then 'special_in_completion' end, case when contains(left_context, '<|') then 'special_in_prompt' end, case when right_context <> '' and not regexp_matches(right_context, '^\\s*(\\r|\\n|$)') then 'text_after_target' end]) as rule from s)
select caret_kind, rule, count(*) as n from u where rule is not null group by all""")
def a24_violations_by_kind(spark, d):
    """Which invariants of completion documents are broken, and how often, by kind."""
    s = table(spark, d, "samples").select("sample_id", "caret_kind", "target_text", "right_context", "left_context", "end_of_line", F.col("caret_utf16_offset").alias("a"), F.col("target_end_utf16_offset").alias("b"), F.col("line_end_utf16_offset").alias("le")).distinct()
    t = F.col("target_text")
    rules = {"empty_completion": t == "", "newline_in_completion": F.contains(t, F.lit("\n")), "beyond_line": F.col("b") > F.col("le"), "no_span": F.col("a") >= F.col("b"), "special_in_completion": F.contains(t, F.lit("<|")), "special_in_prompt": F.contains("left_context", F.lit("<|")), "text_after_target": (F.col("right_context") != "") & ~F.col("right_context").rlike(r"^\s*(\r|\n|\z)")}
    from tessel.operators.rules import all_reasons

    return s.select("caret_kind", F.explode(all_reasons(rules)).alias("rule")).groupBy("caret_kind", "rule").agg(F.count(F.lit(1)).alias("n"))


_LEGAL = ", ".join(f"('{a}', '{b}')" for a, b in J.LEGAL)


@query(f"""with e as (select user_id::varchar as id, event_id, ts, case event_type when 'signup' then 'pending' when 'view' then 'cloning' when 'click' then 'processing' when 'purchase' then 'complete' else 'failed' end as state from events), p as (select *, lag(state) over (partition by id order by ts, event_id) as prev from e)
select coalesce(prev, 'start') as before, state, count(*) as n, count(*) filter (prev is not null and (prev, state) not in ({_LEGAL})) as illegal from p group by all""")
def k1_job_transitions(spark, d):
    """Events read as states of jobs: how often each transition occurs, and which the state machine forbids."""
    kind = F.create_map(*[F.lit(x) for kv in {"signup": "pending", "view": "cloning", "click": "processing", "purchase": "complete", "error": "failed"}.items() for x in kv])
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("id"), "event_id", "ts", kind[F.col("event_type")].alias("state"))
    before = F.lag("state").over(W.partitionBy("id").orderBy("ts", "event_id"))
    t = J.check_transitions(e, "id", "state", ["ts", "event_id"]).withColumn("before", F.coalesce(before, F.lit("start")))
    return t.groupBy("before", "state").agg(F.count(F.lit(1)).alias("n"), F.count("problem").alias("illegal"))


@query("""with h as (select event_type, time_bucket(interval '1 hour', ts) as start, count(*) as n, sum(value) as total from events group by all)
select event_type, count(*) as hours, sum(n)::bigint as n, max(n) as busiest, round_even(avg(n), 6)::double as per_hour, round_even(sum(total) / sum(n), 6)::double as mean_value from h group by all""")
def k9_stage_rates(spark, d):
    """Throughput of each kind of event: hours seen, rate per hour, the busiest hour and the mean value."""
    h = J.windowed(table(spark, d, "events"), "ts", "1 hour", "event_type", "value")
    return h.groupBy("event_type").agg(F.count(F.lit(1)).alias("hours"), F.sum("n").alias("n"), F.max("n").alias("busiest"), F.bround(F.avg("n"), 6).alias("per_hour"), F.bround(F.sum("total") / F.sum("n"), 6).alias("mean_value"))


@query("""with t as (select distinct file_id, regexp_split_to_array(content, '\\r\\n|[\\r\\n\\x{85}\\x{2028}\\x{2029}]') as parts, regexp_extract_all(content, '\\r\\n|[\\r\\n\\x{85}\\x{2028}\\x{2029}]') as breaks from corpus),
l as (select file_id, generate_subscripts(parts, 1) - 1 as n, unnest(parts) as line, breaks from t), k as (select file_id, n, length(line) as len, case when n < len(breaks) then breaks[n + 1] else '' end as brk from l)
select file_id, count(*) as lines, sum(len)::bigint as chars, count(*) filter (brk = chr(10)) as lf, count(*) filter (brk = chr(13) || chr(10)) as crlf, count(*) filter (brk = '') as without_break, max(len)::int as longest from k group by all""")
def x5_lines_and_breaks(spark, d):
    """Lines of files with the kind of break each ends with: a last line always exists, even if empty."""
    rx = F.lit(f"({X.LINE_BREAK})")
    both = F.arrays_zip(F.transform(X.lines(F.col("content")), lambda x: F.length(x)).alias("len"), F.regexp_extract_all("content", rx, 1).alias("brk"))
    k = files(spark, d, "content").select("file_id", both.alias("z")).select("file_id", F.explode("z").alias("z")).select("file_id", F.col("z.len").alias("len"), F.coalesce(F.col("z.brk"), F.lit("")).alias("brk"))
    return k.groupBy("file_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("len").alias("chars"), F.count_if(F.col("brk") == "\n").alias("lf"), F.count_if(F.col("brk") == "\r\n").alias("crlf"), F.count_if(F.col("brk") == "").alias("without_break"), F.max("len").alias("longest"))


@query("""with c as (select repository_id, count(*) as total, count(*) filter (is_test) as tests from (select distinct sample_id, repository_id, is_test from samples) group by all), k as (select *, least(1.0::double, 40.0::double / total) as keep from c)
select repository_id, keep, case when tests = 0 then 1.0::double else least(1.0::double, greatest(0.0::double, 0.15::double * (total - tests) / 0.85::double / tests)) end as test_keep from k""")
def l8_keep_fractions(spark, d):
    """Keep fractions of each repository: the budget over its samples, and for test code the fraction at which it makes up no
    more than its share of what is kept."""
    c = table(spark, d, "samples").select("sample_id", "repository_id", "is_test").distinct().groupBy("repository_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_test").alias("tests"))
    share = F.lit(0.15) * (F.col("total") - F.col("tests")) / F.lit(0.85) / F.col("tests")
    return c.select("repository_id", F.least(F.lit(1.0), F.lit(40.0) / F.col("total")).alias("keep"), F.when(F.col("tests") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))).alias("test_keep"))


@query("""with s as (select distinct sample_id, repository_id, relative_path, source_sha256, caret_utf16_offset as a, target_end_utf16_offset as b, target_text, split_group, revision from samples), j as (select repo_id, min(split) as split, max(revision) as revision from jobs group by 1),
c as (select repository_id, relative_path, sha256, min(case when split = 'eval' then 'validation' else split end) as split from corpus group by all), g as (select s.split_group, count(distinct j.split) as k from s join j on repository_id = repo_id where s.split_group is not null group by 1),
x as (select s.*, j.split as js, c.split as cs, g.k from s left join j on repository_id = repo_id left join c on c.repository_id = s.repository_id and c.relative_path = s.relative_path and c.sha256 = s.source_sha256 left join g on g.split_group = s.split_group)
select count(*) as checked, count(distinct sample_id) as ids, count(*) filter (contains(target_text, chr(10))) as several_lines, count(*) filter (coalesce(k, 1) > 1) as torn_groups, count(*) filter (cs is null) as no_file, count(*) filter (cs is not null and js is distinct from cs) as other_split, count(*) filter (revision is null) as no_revision from x""")
def v3_sample_checks(spark, d):
    """The checks of samples: unique ids, one line, groups within one split, file there, its split the repository's, revision."""
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", F.col("source_sha256").alias("sha256"), "caret_utf16_offset", "target_end_utf16_offset", "target_text", "split_group", "revision").distinct()
    j = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("split").alias("js"))
    c = table(spark, d, "corpus").groupBy("repository_id", "relative_path", "sha256").agg(F.min(F.when(F.col("split") == "eval", "validation").otherwise(F.col("split"))).alias("cs"))
    located = s.join(j, "repository_id", "left").join(c, ["repository_id", "relative_path", "sha256"], "left")
    torn = s.join(j, "repository_id").where("split_group is not null").groupBy("split_group").agg(F.count_distinct("js").alias("k"))
    x = located.join(torn, "split_group", "left")
    return x.agg(F.count(F.lit(1)).alias("checked"), F.count_distinct("sample_id").alias("ids"), F.count_if(F.contains("target_text", F.lit("\n"))).alias("several_lines"), F.count_if(F.coalesce("k", F.lit(1)) > 1).alias("torn_groups"), F.count_if(F.col("cs").isNull()).alias("no_file"), F.count_if(F.col("cs").isNotNull() & ~F.col("js").eqNullSafe(F.col("cs"))).alias("other_split"), F.count_if(F.col("revision").isNull()).alias("no_revision"))


@query(f"""with t as (select file_id, len(regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*')) as names, regexp_extract_all(content, '[^A-Za-z_]+|[A-Za-z_][A-Za-z0-9_]*') as parts from {FILES} where language = 'go'),
p as (select file_id, unnest(parts) as part, generate_subscripts(parts, 1) as i from t), q as (select file_id, i, part, sum(length(part)) over (partition by file_id order by i) as e from p), k as (select file_id, part, e::bigint as e from q where regexp_matches(part, '^[A-Za-z_]')),
c as (select distinct f.file_id, s.sample_id, (length(f.content) - length(f.content) + s.line_start_utf16_offset)::bigint as at from samples s join (select file_id, repository_id, relative_path, sha256, content from {FILES} where language = 'go' and not regexp_matches(content, '[\\x{{10000}}-\\x{{10FFFF}}]')) f on f.repository_id = s.repository_id and f.relative_path = s.relative_path and f.sha256 = s.source_sha256)
select c.sample_id, (select arg_max(k.part, k.e) from k where k.file_id = c.file_id and k.e <= c.at) as last_name from c""".replace("(length(f.content) - length(f.content) + s.line_start_utf16_offset)", "s.line_start_utf16_offset"))
def j9_last_name_before(spark, d):
    """The last name that ends at or before the start of each Go sample's line: an interval lookup by binary search in the sorted
    token ends of its file. Files with characters beyond U+FFFF aren't compared, as offsets count UTF-16 units."""
    f = files(spark, d, "repository_id", "relative_path", "sha256", "language", "content").where("language = 'go'").where(~F.col("content").rlike("[\\x{10000}-\\x{10FFFF}]"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", F.col("source_sha256").alias("sha256"), F.col("line_start_utf16_offset").alias("at")).distinct()
    per = s.groupBy("repository_id", "relative_path", "sha256").agg(F.collect_list(F.struct("sample_id", "at")).alias("carets"))  # the carets of one file

    @F.pandas_udf("array<struct<sample_id:string,last_name:string>>")
    def looked_up(content: pd.Series, carets: pd.Series) -> pd.Series:
        import bisect
        import re

        out = []
        for text, cs in zip(content, carets, strict=True):
            names = [(m.end(), m.group()) for m in re.finditer("[A-Za-z_][A-Za-z0-9_]*", text)]
            ends = [e for e, _ in names]
            out.append([{"sample_id": c["sample_id"], "last_name": names[i - 1][1] if (i := bisect.bisect_right(ends, c["at"])) else None} for c in cs])
        return pd.Series(out)

    return f.join(per, ["repository_id", "relative_path", "sha256"]).select(F.inline(looked_up("content", "carets")))


@query("""with n as (select doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) as t, lower(regexp_extract(text, '([A-Za-z][A-Za-z]+)', 1)) || '|' || coalesce(source, '') as name, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{2,}')) as w from documents where text is not null),
same as (select a.doc_id as a, b.doc_id as b from n a join n b on a.t = b.t and length(a.t) >= 40 and a.doc_id < b.doc_id), named as (select a.doc_id as a, b.doc_id as b from n a join n b on a.name = b.name and a.doc_id < b.doc_id where len(a.w) > 0 and len(list_intersect(a.w, b.w)) >= 0.5 * len(list_distinct(list_concat(a.w, b.w)))),
e as (select a, b from same union select a, b from named), r as (with recursive reach(x, y) as (select a, b from e union select b, a from e union select reach.x, case when e.a = reach.y then e.b else e.a end from reach join e on e.a = reach.y or e.b = reach.y) select x, least(x, min(y)) as root from reach group by 1)
select x as doc_id, 'grp_' || substr(sha256(root::varchar), 1, 10) as grp from r""")
def g4_groups_of_both_rules(spark, d):
    """Groups of texts that are equal after normalisation (of at least 40 characters), or that have one name (first word and
    source) and share half of their words: the links of both rules, closed over."""
    docs = table(spark, d, "documents").where("text is not null")
    t = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    n = docs.select("doc_id", F.sha2(t, 256).alias("t"), F.length(t).alias("k"), F.concat(F.lower(F.regexp_extract("text", "([A-Za-z][A-Za-z]+)", 1)), F.lit("|"), F.coalesce("source", F.lit(""))).alias("name"), X.words(F.col("text")).alias("w"))
    equal = n.where("k >= 40").groupBy("t").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1")
    same = n.where("k >= 40").join(equal.select("t", "a"), "t").where("doc_id > a").select("a", F.col("doc_id").alias("b"))
    # words are the items of a prefix filter within each name, so no name's texts meet all pairs
    items = n.select("name", "doc_id", F.explode("w").alias("word")).select("doc_id", F.concat_ws("|", "name", "word").alias("item"))
    named = O.overlap_pairs(items, "doc_id", "item", 0.5).select("a", "b")
    c = O.components(same.union(named).distinct())
    return c.select(F.col("node").alias("doc_id"), F.concat(F.lit("grp_"), F.substring(F.sha2(F.col("root").cast("string"), 256), 1, 10)).alias("grp"))


@query("with a as (select file_id, max(parse_errors) as base from bindings where engine = 'adhoc' group by 1), b as (select file_id, max(parse_errors) as fix from bindings where engine <> 'adhoc' group by 1) select file_id, coalesce(b.fix, a.base) as value, b.fix is not null as fixed from a full join b using (file_id)")
def j11_fix_over_base(spark, d):
    """Records of a base run overridden by those of a later one: one aggregation, the later wins where it has a value."""
    b = table(spark, d, "bindings").where("engine is not null").groupBy("file_id").agg(F.max(F.when(F.col("engine") == "adhoc", F.col("parse_errors"))).alias("base"), F.max(F.when(F.col("engine") != "adhoc", F.col("parse_errors"))).alias("fix"))
    return b.select("file_id", F.coalesce("fix", "base").alias("value"), F.col("fix").isNotNull().alias("fixed"))


ORACLES["l13_little_endian"] = "with h as (select distinct repo_id, sha256('x' || chr(31) || repo_id) as h from jobs) select repo_id, ('0x' || substr(h, 15, 2) || substr(h, 13, 2) || substr(h, 11, 2) || substr(h, 9, 2) || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::ubigint::double / 18446744073709551616.0::double as u from h"
ORACLES["a22_water_fill"] = f"with s as (select repository_id, sum(bytes)::bigint as s from {FILES} group by 1), r as (select s, sum(s) over (order by s, repository_id rows between unbounded preceding and 1 preceding) as below, count(*) over () - row_number() over (order by s, repository_id) + 1 as above from s), c as (select s, ceil((400000 - coalesce(below, 0)) / above)::bigint as cap, coalesce(below, 0) + s * above as reach from r) select coalesce(arg_min(greatest(cap, 0), s) filter (reach >= 400000), (select max(s) from s))::bigint as cap from c"
ORACLES["d5_near_duplicates"] = f"""with j as (select repo_id, min(split) as split from jobs group by 1), s as (select repo_id, case when split = 'train' then 0 when split in ('validation', 'test') then 1 end as side from j),
f as (select file_id, side, regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*|[0-9]+|[^\\sA-Za-z0-9_]') as t from {FILES} join s on repo_id = repository_id where side is not null and content is not null),
g as (select distinct file_id, side, array_to_string(t[i:i+4], chr(31)) as k from (select file_id, side, t, unnest(range(1, len(t) - 3)) as i from f where len(t) >= 10)), n as (select file_id, count(*) as n from g group by 1),
p as (select a.file_id as e, b.file_id as t, count(*) as m from g a join g b on a.k = b.k and a.side = 1 and b.side = 0 group by all), q as (select e, t, m::double / (x.n + y.n - m) as sim from p join n x on x.file_id = e join n y on y.file_id = t where m >= 0.8 * (x.n + y.n - m))
select e as id, arg_max(t, (sim, -t)) as best_id, max(sim) as similarity from q group by 1"""
ORACLES["x13_compact_signatures"] = f"""with s as (select file_id, unnest(list_distinct(regexp_extract_all(content, '(?m)^[ \\t]+(?:public|private|internal|protected)[ \\t]+(?:static[ \\t]+|async[ \\t]+|override[ \\t]+)*([\\w<>,.?\\[\\] ]+ \\w+\\([^()\\n]*\\))', 1))) as s from {FILES} where language = 'csharp')
select file_id, regexp_extract(s, '(\\w+\\(.*)$', 1) || '->' || trim(s[:length(s) - length(regexp_extract(s, '(\\w+\\(.*)$', 1))]) as signature from s"""
