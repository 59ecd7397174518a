"""Queries that choose and rank: licence buckets, word rules, categories, priorities, shortlists, orders and flags of records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X
from tessel.operators import rules as R
from tessel.plans.files import files
from tessel.plans.registry import FILES, points_sql, query, units_sql
from tessel.session import table

# Licences by bucket.
PERMISSIVE = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Unlicense", "ISC", "MS-PL", "Zlib"]
RESTRICTED = ["GPL", "LGPL", "AGPL", "MPL", "EPL", "OSL", "EUPL", "MS-RL", "CC-BY-SA", "MulanPSL"]
# Tags and words that speak against a text, and words that take it back.
STRONG = ["ransomware", "keylogger", "stealer", "aimbot", "privesc", "shellcode", "reverse-shell", "cheat"]
BAD = [r"\bcheats?\b", r"\bkeylogger\b", r"\bransomware\b", r"\bkeygen\b", r"\bcrack(ed|er|s)?\b", r"\bshellcode\b", r"privilege-?escalation", r"captcha-?bypass", r"\bexfiltrat", r"\bspoofer\b", r"\bexecutor\b", r"\bgrabber\b"]
BENIGN = ["malware-analysis", "anti-malware", "malware-detection", "dependency-inject", "packet"]
NONCODE = r"curated list|awesome list|a collection of (awesome|resources|links)|slides? (deck|from)|lecture (notes|slides)"
EDUCATIONAL = r"tutorial|\bcourse\b|bootcamp|\blearn(ing)?\b|homework|assignment|\bexercise(s)?\b|getting-started|quickstart|workshop|for beginners"
# Categories, of which the first that matches counts.
CATEGORIES = [
    ("devtools", r"source-?generator|\banalyzer(s)?\b|decompil|\bmsbuild\b|language-server|\bcompiler\b"), ("game", r"\bunity\b|\bgodot\b|monogame|game-?engine|gamedev"), ("desktop-ui", r"\bwpf\b|winforms|\bavalonia\b|\bmaui\b|winui|\bxaml\b"),
    ("devtools", r"visual-studio|\bide\b|code-generator|code-generation"), ("web", r"aspnet|\bblazor\b|\bmvc\b|razor|web-?api|rest-api|graphql"), ("cloud", r"\bazure\b|\baws\b|\bgcp\b|serverless|kubernetes|\bk8s\b|\bdocker\b|microservice"),
    ("data", r"entity-framework|\borm\b|\bsql\b|postgres|\bmysql\b|sqlite|mongodb|\bredis\b|database"), ("ml", r"\bai\b|\bllm\b|\bml\b|machine-learning|deep-learning|neural"), ("security", r"\bsecurity\b|cryptograph|\boauth\b|\bjwt\b|authentication|vulnerab"),
    ("networking", r"\bhttp\b|\btcp\b|\budp\b|websocket|\bgrpc\b|proxy|\bsocket\b|\bprotocol\b"), ("desktop-tool", r"\bwindows\b|\btray\b|\btool(s)?\b|launcher|\bcli\b|command-line|\bterminal\b|automation"),
    ("testing", r"\btest(ing)?\b|assertion|\bmock\b|\bbenchmark\b|fuzz"), ("iot", r"\biot\b|embedded|\barduino\b|microcontroller"), ("library", r"\blibrary\b|\bsdk\b|\bapi\b|\bframework\b|\bwrapper\b|\bclient\b|\btoolkit\b"),
]
_JOBS = "(select repo_id, min(license) as license, max(size_kb) as size_kb, max(priority) as priority, max(samples) as samples, min(started) as started, max(attempts) as attempts, min(tag) as tag from jobs group by repo_id)"


def repos(spark, d):
    """One row per repository; which of several attempts a value comes from doesn't matter here."""
    least, most = ("license", "started", "tag"), ("size_kb", "priority", "samples", "attempts")
    return table(spark, d, "jobs").groupBy("repo_id").agg(*[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most])


def _list(xs):
    return ", ".join(f"'{x}'" for x in xs)


_BUCKET = f"case when license in ({_list(PERMISSIVE)}) then 'permissive' when " + " or ".join(f"starts_with(license, '{p}')" for p in RESTRICTED) + " then 'restricted' else 'unknown' end"


def license_bucket():
    return R.bucket(F.col("license"), {"permissive": PERMISSIVE}, {"restricted": RESTRICTED}, "unknown")


@query(f"select repo_id, {_BUCKET} as bucket from {_JOBS}")
def f12_license_bucket(spark, d):
    return repos(spark, d).select("repo_id", license_bucket().alias("bucket"))


@query(f"""with t as (select lower(text) as t from documents where text is not null), r as (select case when list_has_any(regexp_extract_all(t, '[a-z0-9-]{{2,}}'), [{_list(STRONG)}]) then 'strong_tag' when regexp_matches(t, '{'|'.join(BAD)}') and not regexp_matches(t, '{'|'.join(BENIGN)}') then 'word' end as reason from t)
select coalesce(reason, 'none') as reason, count(*) as n from r group by all""")
def f13_word_rules(spark, d):
    """Texts with a strong tag, or a bad word that no benign one takes back."""
    t = table(spark, d, "documents").where("text is not null").select(F.lower("text").alias("t"))
    tags = F.regexp_extract_all("t", F.lit("([a-z0-9-]{2,})"), 1)
    return t.groupBy(F.coalesce(R.tagged_or_said(tags, F.col("t"), STRONG, BAD, BENIGN, ("strong_tag", "word")), F.lit("none")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select doc_id, regexp_matches(text, '(?i){NONCODE}') as noncode, regexp_matches(text, '(?i){EDUCATIONAL}') as educational from documents where text is not null")
def f15_text_kinds(spark, d):
    t = table(spark, d, "documents").where("text is not null")
    return t.select("doc_id", F.col("text").rlike("(?i)" + NONCODE).alias("noncode"), F.col("text").rlike("(?i)" + EDUCATIONAL).alias("educational"))


# Sizes in KB below or above which a repository is flagged or refused, and the first day of activity.
TINY, TINY_REFUSED, LARGE, ASSETS, DUMP, ACTIVE = 500, 30, 1_000_000, 300_000, 8_000_000, "2024-02-01"


@query(f"""select repo_id, list_filter([case when size_kb < {TINY_REFUSED} and license is null then 'tiny_lowsignal' end, case when tag = 'game' and size_kb > {DUMP} then 'huge_asset_dump' end, case when started < timestamp '{ACTIVE}' then 'inactive' end, case when repo_id in ('forge.example/brightmere/ledgerkit') then 'manual_exclude' end], lambda x: x is not null) as reasons,
 list_filter([case when license is null then 'no_license' end, case when size_kb < {TINY} then 'tiny' end, case when size_kb > {LARGE} then 'large' end, case when tag = 'game' and size_kb > {ASSETS} then 'assets_heavy_risk' end], lambda x: x is not null) as flags from {_JOBS}""")
def f16_flags(spark, d):
    """Reasons and flags add up, unlike reasons of which the first wins."""
    size, game = F.col("size_kb"), F.col("tag") == "game"
    reasons = {"tiny_lowsignal": (size < TINY_REFUSED) & F.col("license").isNull(), "huge_asset_dump": game & (size > DUMP), "inactive": F.col("started") < F.expr(f"timestamp_ntz '{ACTIVE}'"), "manual_exclude": F.col("repo_id").isin("forge.example/brightmere/ledgerkit")}
    flags = {"no_license": F.col("license").isNull(), "tiny": size < TINY, "large": size > LARGE, "assets_heavy_risk": game & (size > ASSETS)}
    return repos(spark, d).select("repo_id", R.all_reasons(reasons).alias("reasons"), R.all_reasons(flags).alias("flags"))


_CATEGORY = "case " + " ".join(f"when regexp_matches(text, '(?i){rx}') then '{n}'" for n, rx in CATEGORIES) + " else 'other' end"


@query(f"select doc_id, {_CATEGORY} as category from documents where text is not null")
def f17_category(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", R.category(F.col("text"), CATEGORIES).alias("category"))


@query("select repo_id, reason from (select distinct repo_id, reason, status from jobs) where status = 'failed' and not starts_with(coalesce(reason, ''), 'manifest.') and coalesce(reason, '') <> 'low_space'")
def f24_hard_failures(spark, d):
    j, r = table(spark, d, "jobs").select("repo_id", "reason", "status").distinct(), F.coalesce("reason", F.lit(""))
    return j.where((F.col("status") == "failed") & ~r.startswith("manifest.") & (r != "low_space")).select("repo_id", "reason")


_SHORT = f"size_kb between 5 and 400 and started >= timestamp '2024-01-20' and {_BUCKET} = 'permissive'"


def shortlisted(spark, d):
    return repos(spark, d).where(F.col("size_kb").between(5, 400) & (F.col("started") >= F.expr("timestamp_ntz '2024-01-20'")) & (license_bucket() == "permissive"))


@query(f"select repo_id from {_JOBS} where {_SHORT}")
def f25_shortlist(spark, d):
    return shortlisted(spark, d).select("repo_id")


@query(f"with s as (select *, row_number() over (partition by coalesce(tag, '-') order by priority desc nulls last, repo_id) as r from {_JOBS} where {_SHORT}) select coalesce(tag, '-') as tag, repo_id from s where r = 1")
def w15_first_per_category(spark, d):
    s = shortlisted(spark, d).groupBy(F.coalesce("tag", F.lit("-")).alias("tag"))
    return s.agg(F.min_by("repo_id", F.struct(F.coalesce(-F.col("priority"), F.lit(1 << 30)), "repo_id")).alias("repo_id"))


@query(f"select repo_id, priority from {_JOBS} order by priority desc nulls last, repo_id limit 100")
def l11_selection_order(spark, d):
    """The first hundred by priority, then id: a top-k."""
    return repos(spark, d).select("repo_id", "priority").orderBy(F.desc_nulls_last("priority"), "repo_id").limit(100)


@query("select file_id, (row_number() over (partition by repository_id order by relative_path, file_id))::int as place from (select distinct file_id, repository_id, relative_path from corpus)")
def l1_ordinal_order(spark, d):
    """The place of each file among those of its repository, in the order of UTF-16 units."""
    f = table(spark, d, "corpus").select("file_id", "repository_id", "relative_path").distinct()
    return f.select("file_id", F.row_number().over(W.partitionBy("repository_id").orderBy(R.ordinal(F.col("relative_path")), "file_id")).alias("place"))


@query(f"""with j as (select *, least(1.0::double, log10(coalesce(samples, 0) + 1) / log10(100001)) as stars, date_diff('day', date '2025-01-01', started::date) as day from {_JOBS})
select repo_id, round_even((1000 * (0.45::double * stars + 0.3::double * greatest(0.0::double, least(1.0::double, (day + 365) / 730.0::double)) + 0.1::double * (case when priority is not null then 1.0::double else 0.0 end) + 0.15::double * ((case when license is not null then 0.5::double else 0.0 end) + least(0.5::double, 0.1::double * coalesce(attempts, 0))))), 0)::int as score from j where started is not null""")
def x11_priority(spark, d):
    """A weighted score of how much there is, how new it is, and what is known about it."""
    stars = F.least(F.lit(1.0), F.log10(F.coalesce("samples", F.lit(0)) + 1) / F.log10(F.lit(100001)))
    recent = R.within(R.days_since(F.col("started"), "2025-01-01"), -365, 365)
    known = F.when(F.col("priority").isNotNull(), 1.0).otherwise(0.0)
    quality = F.when(F.col("license").isNotNull(), 0.5).otherwise(0.0) + F.least(F.lit(0.5), F.lit(0.1) * F.coalesce("attempts", F.lit(0)))
    return repos(spark, d).where("started is not null").select("repo_id", R.score({0.45: stars, 0.3: recent, 0.1: known, 0.15: quality}).alias("score"))


@query("select distinct repo_id, date_diff('day', date '2025-01-01', started::date)::int as days from jobs where started is not null")
def x12_days(spark, d):
    return table(spark, d, "jobs").where("started is not null").select("repo_id", R.days_since(F.col("started"), "2025-01-01").alias("days")).distinct()


_FAMILY = r"^([A-Za-z0-9]+)[._-]"


@query(f"with p as (select distinct file_id, project, relative_path, regexp_replace(regexp_extract(project, '([^/]*)$', 1), '\\.[^.]*$', '') as stem from corpus) select file_id, case when project is null then '(no-project):' || relative_path else coalesce(nullif(regexp_extract(stem, '{_FAMILY}', 1), ''), project) end as family from p")
def x9_split_family(spark, d):
    """The group that is split as a whole: the family in a project's name, else the project, else the file itself."""
    p = table(spark, d, "corpus").select("file_id", "project", "relative_path").distinct()
    stem = F.regexp_replace(F.regexp_extract("project", "([^/]*)$", 1), r"\.[^.]*$", "")
    family = F.coalesce(F.nullif(F.regexp_extract(stem, _FAMILY, 1), F.lit("")), "project")
    return p.select("file_id", F.when(F.col("project").isNull(), F.concat(F.lit("(no-project):"), "relative_path")).otherwise(family).alias("family"))


_FOUND = """case when contains(license_text, 'Permission is hereby granted, free of charge') and contains(lower(license_text), 'the software is provided "as is"') then 'MIT' when contains(license_text, 'Apache License') and contains(license_text, 'Version 2.0') then 'Apache-2.0'
 when contains(lower(license_text), 'this is free and unencumbered software released into the public domain') then 'Unlicense' when contains(license_text, 'Redistribution and use in source and binary forms') and contains(lower(license_text), 'this software is provided by the copyright holders and contributors "as is"') then case when contains(lower(license_text), 'neither the name') then 'BSD-3-Clause' else 'BSD-2-Clause' end end"""
_SPDX = "case when not clash then case when stands then declared else found end end"


@query(f"""with i as (select repo_id, min(license_file) as file, min(license_text) as license_text from license_info group by 1), j as (select i.*, license as declared from i left join (select repo_id, min(license) as license from jobs group by 1) using (repo_id)),
k as (select *, case when file is not null then {_FOUND} end as found from j), m as (select *, coalesce(declared <> found, false) as clash, found is null and file is not null and coalesce(declared in ({_list(PERMISSIVE)}), false) as stands from k)
select repo_id, {_SPDX} as spdx, case when clash then 'declared_' || declared || '_conflicts_with_detected_' || found when stands then 'declared:' || declared || ';license_file_present:' || file || ';text_unrecognized' when file is null then 'no_license_file' when found is null then 'license_text_unrecognized' else 'license_file_text_match:' || file end as reason,
 coalesce({_SPDX} in ({_list(PERMISSIVE)}), false) as allowed from m""")
def f8_license_detection(spark, d):
    """Licence texts by their fixed phrases, against the declared licence and the allowlist, with reasons."""
    i = table(spark, d, "license_info").groupBy("repo_id").agg(F.min("license_file").alias("file"), F.min("license_text").alias("text"))
    j = table(spark, d, "jobs").groupBy("repo_id").agg(F.min("license").alias("declared"))
    r = R.reconciled_license(F.col("file"), F.col("text"), F.col("declared"), PERMISSIVE)
    return i.join(j, "repo_id", "left").select("repo_id", r.alias("r")).select("repo_id", "r.spdx", "r.reason", "r.allowed")


_LEFT, _RIGHT = 600, 150


@query(f"""with s as (select distinct sample_id, repository_id, relative_path, source_sha256, caret_utf16_offset as p, target_end_utf16_offset as q from samples),
f as (select repository_id, relative_path, sha256, min(content) as content from {FILES} group by all),
j as (select s.*, content, {points_sql('content', 'p')} as a, {points_sql('content', 'q')} as b, {points_sql('content', f'greatest(0, p - {_LEFT})')} as l, {points_sql('content', f'least({units_sql("content")}, q + {_RIGHT})')} as r from s join f on s.repository_id = f.repository_id and s.relative_path = f.relative_path and s.source_sha256 = f.sha256)
select sample_id, sha256(substr(content, l + 1, a - l)) as left_window, sha256(substr(content, b + 1, r - b)) as right_window, p > {_LEFT} as left_cut, {units_sql('content')} > q + {_RIGHT} as right_cut from j""")
def x7_context_windows(spark, d):
    """What stands before and after each target in its file, up to so many UTF-16 units; pairs of surrogates aren't split."""
    f = files(spark, d, "repository_id", "relative_path", "sha256", "content").groupBy("repository_id", "relative_path", F.col("sha256").alias("source_sha256")).agg(F.min("content").alias("content"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "source_sha256", F.col("caret_utf16_offset").alias("p"), F.col("target_end_utf16_offset").alias("q")).distinct()
    w = X.context_windows(F.col("content"), F.col("p"), F.col("q"), _LEFT, _RIGHT)
    j = s.join(f, ["repository_id", "relative_path", "source_sha256"]).select("sample_id", w.alias("w"))
    return j.select("sample_id", F.sha2("w.left", 256).alias("left_window"), F.sha2("w.right", 256).alias("right_window"), "w.left_cut", "w.right_cut")


@query(r"""with k as (select repository_id, relative_path, min(file_id) as file_id from corpus group by all), s as (select distinct sample_id, file_id, target_text, target_end_utf16_offset as e, line_end_utf16_offset as le from samples left join k using (repository_id, relative_path)),
b as (select file_id, max(parse_errors) as errors from bindings group by all)
select sample_id, list_filter([case when regexp_full_match(target_text, '[{}()\[\];, ]*') then 'trivial_target' end, case when regexp_matches(target_text, '^\s') then 'target_starts_with_whitespace' end, case when regexp_matches(target_text, '^[)\]}]') then 'target_starts_with_closer' end, case when e < le then 'trailing_whitespace' end,
 case when regexp_matches(regexp_replace(target_text, '"([^"\\]|\\.)*"', '', 'g'), '//|/\*') then 'target_has_comment' end, case when errors > 0 then 'file_has_syntax_errors' end, case when regexp_matches(target_text, '[^\x00-\x7F]') then 'non_ascii_target' end], lambda x: x is not null) as flags from s left join b using (file_id)""")
def x8_quality_flags(spark, d):
    """The seven quality flags of each sample; comments are looked for outside of string literals."""
    key = table(spark, d, "corpus").groupBy("repository_id", "relative_path").agg(F.min("file_id").alias("file_id"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "target_text", F.col("target_end_utf16_offset").alias("e"), F.col("line_end_utf16_offset").alias("le")).distinct()
    b = table(spark, d, "bindings").groupBy("file_id").agg(F.max("parse_errors").alias("errors"))
    j = s.join(key, ["repository_id", "relative_path"], "left").join(b, "file_id", "left")
    return j.select("sample_id", R.all_reasons(X.quality_flags(F.col("target_text"), F.col("e"), F.col("le"), F.col("errors"))).alias("flags"))


@query("select sample_id, list_sort(list_distinct(regexp_extract_all(right(left_context, 20000), '[A-Za-z_][A-Za-z0-9_]*'))) as names from (select distinct sample_id, left_context from samples)")
def x21_prefix_identifiers(spark, d):
    """The identifiers of the window before each caret, for ranking what was used there."""
    s = table(spark, d, "samples").select("sample_id", "left_context").distinct()
    return s.select("sample_id", F.sort_array(X.prefix_identifiers(F.col("left_context"))).alias("names"))


@query("with s as (select distinct sample_id, repository_id, relative_path, source_sha256 from samples), f as (select distinct repository_id, relative_path, sha256 from corpus), p as (select distinct repository_id, relative_path from corpus) select case when f.sha256 is not null then 'redo' when p.relative_path is not null then 'document_text_mismatch' else 'document_not_in_workspace' end as status, count(*) as n from s left join f on s.repository_id = f.repository_id and s.relative_path = f.relative_path and s.source_sha256 = f.sha256 left join p on s.repository_id = p.repository_id and s.relative_path = p.relative_path group by all")
def m14_redo_status(spark, d):
    """Whether the facts of each sample can be computed again from its file, with the reason why not."""
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "source_sha256").distinct()
    c = table(spark, d, "corpus")
    f = c.select("repository_id", "relative_path", F.col("sha256").alias("source_sha256"), F.lit(1).alias("same")).distinct()
    p = c.select("repository_id", "relative_path", F.lit(1).alias("there")).distinct()
    j = s.join(f, ["repository_id", "relative_path", "source_sha256"], "left").join(p, ["repository_id", "relative_path"], "left")
    status = F.when(F.col("same") == 1, "redo").when(F.col("there") == 1, "document_text_mismatch").otherwise("document_not_in_workspace")
    return j.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("with j as (select repo_id, arg_max(status, (coalesce(attempts, 0), started, coalesce(finished, timestamp '1970-01-01'), status)) as status from jobs where started is not null group by all) select repo_id, case when status = 'running' then 'pending' else status end as status, status = 'running' as recovered from j")
def k5_recovered_jobs(spark, d):
    """The state after a crash: what was running is pending again."""
    from tessel.plans.tables import w12_latest_record
    from tessel.streaming.state import recovered

    return recovered(w12_latest_record(spark, d), "status", ["running"]).select("repo_id", "status", "recovered")


@query("with f as (select distinct file_id, repository_id, language, content, is_test from corpus) select repository_id, count(*) as files, count(*) filter (is_test) as tests, count(distinct language) as languages, sum(length(content))::bigint as chars, count(*) filter (trim(content, ' ') = '') as empty from f group by all")
def v10_per_repository(spark, d):
    """One run over many repositories at once: what a loop over them would report, keyed by repository."""
    f = files(spark, d, "repository_id", "language", "content", "is_test")
    return f.groupBy("repository_id").agg(F.count(F.lit(1)).alias("files"), F.count_if("is_test").alias("tests"), F.count_distinct("language").alias("languages"), F.sum(F.length("content")).alias("chars"), F.count_if(F.trim("content") == "").alias("empty"))
