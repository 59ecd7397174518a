"""Queries over editor states, completions and record rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions import text as X
from tessel.operators import edits as E
from tessel.plans.files import files
from tessel.plans.registry import FILES, points_sql, query
from tessel.session import table


def samples(spark, d, *columns):
    return table(spark, d, "samples").select("sample_id", *columns).distinct()


_EDITOR = "left_context || right_context"


@query("select sample_id, left_context as strict, left_context || right_context as editor from (select distinct sample_id, left_context, target_text, right_context from samples)")
def x20_snapshots(spark, d):
    s = samples(spark, d, "left_context", "target_text", "right_context")
    whole = F.concat("left_context", "target_text", "right_context")
    a = F.length("left_context")
    b = a + F.length("target_text")
    return s.select("sample_id", E.snapshot(whole, a, b, "strict").alias("strict"), E.snapshot(whole, a, b, "editor").alias("editor"))


_P, _Q = points_sql("content", "a"), points_sql("content", "b")


@query(f"""with s as (select distinct sample_id, repository_id, relative_path, source_sha256, caret_utf16_offset as a, target_end_utf16_offset as b, target_text from samples),
f as (select repository_id, relative_path, sha256, min(content) as content, bool_or(has_bom) as has_bom from {FILES} group by all),
j as (select s.*, content, {_P} as p, {_Q} as q from s join f on s.repository_id = f.repository_id and s.relative_path = f.relative_path and s.source_sha256 = f.sha256),
k as (select sample_id, substr(content, 1, p) as l, substr(content, q + 1) as r, substr(content, p + 1, q - p) = target_text as good from j)
select sample_id, case when good then sha256(replace(l || r, chr(13) || chr(10), chr(10))) end as editor, case when good then strlen(l) - (length(l) - length(replace(l, chr(13) || chr(10), chr(10)))) end::int as caret from k""")
def x22_editor_texts(spark, d):
    """The digest of the text that an editor shows for each sample that meets its file (target removed, CRLF as LF), and the
    caret's byte in it; null where the text at the caret isn't the target."""
    f = files(spark, d, "repository_id", "relative_path", "sha256", "content", "has_bom").groupBy("repository_id", "relative_path", F.col("sha256").alias("source_sha256")).agg(F.min("content").alias("content"), F.bool_or("has_bom").alias("has_bom"))
    s = samples(spark, d, "repository_id", "relative_path", "source_sha256", "caret_utf16_offset", "target_end_utf16_offset", "target_text")
    j = s.join(f, ["repository_id", "relative_path", "source_sha256"])
    at = lambda c: X.byte_offset(F.col("content"), F.col(c), F.lit(False))
    e = E.editor_text(F.col("content"), at("caret_utf16_offset"), at("target_end_utf16_offset"), F.col("target_text"), F.lit(False))
    return j.withColumn("e", e).select("sample_id", F.sha2("e.text", 256).alias("editor"), F.col("e.caret").alias("caret"))


@query("select caret_kind, count(*) as n, avg((rtrim(left_context[-12:]) = rtrim(target_text))::int) as exact, avg((length(target_text) >= (case when left_context[-1:] = '.' then 5 else 7 end))::int) as shown from (select distinct sample_id, caret_kind, left_context, target_text from samples) group by all")
def a18_completion_metrics(spark, d):
    """Completion metrics on a stand-in model: the last characters as the completion, the target's length as confidence."""
    s = samples(spark, d, "caret_kind", "left_context", "target_text").withColumn("got", F.right("left_context", F.lit(12))).withColumn("conf", F.length("target_text") / 10).withColumn("dot", F.endswith("left_context", F.lit(".")))
    return E.completion_metrics(s, ["caret_kind"], "got", "target_text", "conf", dotted="dot").select("caret_kind", "n", "exact", "shown")


_RULES = "(select distinct sample_id, caret_kind, target_text, end_of_line, caret_line_zero_based as line, license from samples)"


@query(f"select sample_id, unnest(['enum:caret_kind', 'pattern:indent', 'minimum:line', 'required:license']) as rule, unnest([caret_kind in ('line_start', 'member_access', 'argument_list'), target_text not like ' %', line >= 2, license is not null]) as ok from {_RULES} qualify true".replace(" qualify true", ""))
def v6_schema_rules(spark, d):
    """Every rule of every sample, with whether it holds."""
    s = samples(spark, d, "caret_kind", "target_text", F.col("caret_line_zero_based").alias("line"), "license")
    checks = F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("ok")) for n, c in (("enum:caret_kind", F.col("caret_kind").isin("line_start", "member_access", "argument_list")), ("pattern:indent", ~F.startswith("target_text", F.lit(" "))), ("minimum:line", F.col("line") >= 2), ("required:license", F.col("license").isNotNull()))])
    return s.select("sample_id", F.inline(checks))


@query("select count(*) filter (not contains(target_text, chr(10)) and target_text <> '') as good_targets, count(distinct sample_id) as ids, count(*) filter (caret_utf16_offset < target_end_utf16_offset) as spans, count(*) as n from (select distinct sample_id, target_text, caret_utf16_offset, target_end_utf16_offset from samples)")
def a24_document_checks(spark, d):
    s = samples(spark, d, "target_text", "caret_utf16_offset", "target_end_utf16_offset")
    return s.agg(F.count_if(~F.contains("target_text", F.lit("\n")) & (F.col("target_text") != "")).alias("good_targets"), F.count_distinct("sample_id").alias("ids"), F.count_if(F.col("caret_utf16_offset") < F.col("target_end_utf16_offset")).alias("spans"), F.count(F.lit(1)).alias("n"))


@query("select b.file_id, case when c.file_id is null then 'no_file' when parse_errors < 0 then 'negative_errors' when c.repository_id <> b.repository_id or c.relative_path <> b.relative_path then 'other_file' when min_position < 0 or min_position > length(content) then 'position_outside' end as problem from (select distinct * from bindings) b left join (select file_id, min(repository_id) as repository_id, min(relative_path) as relative_path, min(content) as content from corpus group by 1) c using (file_id) where problem is not null or b.engine is null")
def v4_sidecar(spark, d):
    """Records beside files that don't fit them, with the first reason."""
    b = table(spark, d, "bindings").distinct()
    c = files(spark, d, "repository_id", "relative_path", "content").select("file_id", F.col("repository_id").alias("r"), F.col("relative_path").alias("p"), F.length("content").alias("n"))
    j = b.join(c, "file_id", "left")
    problem = X.first_reason([("no_file", F.col("r").isNull()), ("negative_errors", F.col("parse_errors") < 0), ("other_file", (F.col("r") != F.col("repository_id")) | (F.col("p") != F.col("relative_path"))), ("position_outside", (F.col("min_position") < 0) | (F.col("min_position") > F.col("n")))])
    return j.select("file_id", problem.alias("problem"), "engine").where("problem is not null or engine is null").drop("engine")


_AT = "substr(hex(encode(content)), 2 * (a - {}) + 1, 2 * strlen(target_text)) = hex(encode(target_text))"


@query(f"""with s as (select distinct sample_id, repository_id, relative_path, source_sha256, caret_byte_offset as a, target_text from samples), f as (select repository_id, relative_path, sha256, min(content) as content from {FILES} group by all)
select sample_id, case when content is null then 'no_file' when {_AT.format(0)} then 'ok' when a >= 3 and {_AT.format(3)} then 'repaired' else 'text_mismatch' end as status from s left join f on s.repository_id = f.repository_id and s.relative_path = f.relative_path and s.source_sha256 = f.sha256""")
def j17_byte_positions(spark, d):
    """Samples against the bytes of their file; offsets that counted a mark which the stored text hasn't are repaired by its three bytes."""
    f = files(spark, d, "repository_id", "relative_path", "sha256", "content").groupBy("repository_id", "relative_path", F.col("sha256").alias("source_sha256")).agg(F.encode(F.min("content"), "UTF-8").alias("raw"))
    j = samples(spark, d, "repository_id", "relative_path", "source_sha256", "caret_byte_offset", "target_text").join(f, ["repository_id", "relative_path", "source_sha256"], "left")
    target = F.encode("target_text", "UTF-8")
    at = lambda shift: F.substr("raw", (F.col("caret_byte_offset") - shift + 1).cast("int"), F.octet_length(target)) == target
    status = F.when(F.col("raw").isNull(), "no_file").when(at(0), "ok").when((F.col("caret_byte_offset") >= 3) & at(3), "repaired").otherwise("text_mismatch")
    return j.select("sample_id", status.alias("status"))


@query("select sample_id from (select distinct sample_id, semantic_status, sha256('preview' || sample_id) as h from samples) order by (semantic_status = 'complete')::int desc, h, sample_id limit 50".replace("(semantic_status = 'complete')::int", "coalesce((semantic_status = 'complete')::int, 0)"))
def s19_preview(spark, d):
    s = samples(spark, d, "semantic_status").withColumn("h", F.struct(F.sha2(F.concat(F.lit("preview"), "sample_id"), 256), F.col("sample_id")))
    return E.preview(s, F.col("h"), 50, F.coalesce(F.col("semantic_status") == "complete", F.lit(False))).select("sample_id")


@query("select count(*) filter (left(content, 1) = chr(65279)) as with_mark, count(*) filter (has_bom) as flagged from (select distinct file_id, content, has_bom from corpus)")
def j17_bom_repair(spark, d):
    """Files whose stored text still has its mark, whose offsets would be shifted, against the flag."""
    return files(spark, d, "content", "has_bom").agg(F.count_if(F.startswith("content", F.lit("﻿"))).alias("with_mark"), F.count_if("has_bom").alias("flagged"))


@query("select s.sample_id, t.sample_id is not null as redo from (select distinct sample_id from samples) s left join (select distinct sample_id from samples where left_context_truncated and right_context_truncated) t using (sample_id)")
def j19_redo_flags(spark, d):
    t = samples(spark, d, "left_context_truncated", "right_context_truncated").where("left_context_truncated and right_context_truncated").select("sample_id", F.lit(True).alias("t")).distinct()
    return samples(spark, d).join(t, "sample_id", "left").select("sample_id", F.coalesce("t", F.lit(False)).alias("redo"))


@query("select f.repository_id, f.file_id, r.n from (select distinct file_id, repository_id from corpus) f join (select repository_id, count(distinct file_id) as n from corpus group by all) r using (repository_id)")
def j14_profile_join(spark, d):
    c = table(spark, d, "corpus")
    n = c.groupBy("repository_id").agg(F.count_distinct("file_id").alias("n"))
    return c.select("file_id", "repository_id").distinct().join(n, "repository_id").select("repository_id", "file_id", "n")


@query("select repo_id, json_extract_string(stats, '$.outcome') as outcome, try_cast(json_extract_string(stats, '$.files') as int) as files from (select distinct repo_id, stats from jobs where stats is not null)")
def x18_json_fields(spark, d):
    j = table(spark, d, "jobs").where("stats is not null").select("repo_id", "stats").distinct()
    return j.select("repo_id", E.lenient_json(F.col("stats"), "outcome string, files int").alias("s")).select("repo_id", "s.outcome", "s.files")


@query("select repository_id, case repository_id when 'forge.example/brightmere/ledgerkit' then 'train' else case when {u} < 0.15 then 'eval' when {u} < 0.25 then 'test' else 'train' end end as split from (select distinct repository_id from corpus)".replace("{u}", __import__("tessel.plans.registry", fromlist=["u_sql"]).u_sql("'20261009'", "'split'", "'corpus'", "repository_id")))
def l6_group_split(spark, d):
    u = X.uniform(F.lit("20261009"), F.lit("split"), F.lit("corpus"), F.col("repository_id"))
    split = F.when(F.col("repository_id") == "forge.example/brightmere/ledgerkit", "train").when(u < 0.15, "eval").when(u < 0.25, "test").otherwise("train")
    return table(spark, d, "corpus").select("repository_id").distinct().select("repository_id", split.alias("split"))


_BLANKS = "regexp_extract(left_context, '[^\\s]([ \\t]+)$', 1)"


@query(f"select sample_id, '<|fim_prefix|>' || substr(left_context, 1, length(left_context) - length({_BLANKS})) || '<|fim_suffix|>' || right_context || '<|fim_middle|>' as prompt, {_BLANKS} || target_text as completion from (select distinct sample_id, left_context, target_text, right_context from samples)")
def r5_fim_prompts(spark, d):
    s = samples(spark, d, "left_context", "target_text", "right_context")
    return s.select("sample_id", E.fim_prompt(F.col("left_context"), F.col("target_text"), F.col("right_context")).alias("p")).select("sample_id", "p.prompt", "p.completion")
