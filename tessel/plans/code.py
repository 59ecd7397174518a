"""Queries that need a lexer, signatures or a tokenizer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessel.functions import tokens as T
from tessel.operators import carets as C
from tessel.operators import facts as K
from tessel.operators import near
from tessel.operators import prompts as P
from tessel.plans.files import files
from tessel.functions import text as X
from tessel.plans.registry import FILES, query
from tessel.session import cut, table


ENGINE = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  # a second vocabulary


def csharp(spark, d, *columns):
    return files(spark, d, "language", "sha256", "content", *columns).where("language = 'csharp'")


@query()
def d5_near_duplicates(spark, d):
    """Evaluation files and their best training match by MinHash."""
    side = F.when(F.col("split") == "train", 0).when(F.col("split").isin("validation", "test"), 1)
    repo = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.min("split").alias("split"))
    f = files(spark, d, "repository_id", "content").join(repo, "repository_id")
    return near.near_duplicates(f.select(F.col("file_id").alias("id"), side.alias("side"), F.col("content").alias("text")).where("side is not null"))


@query()
def u2_caret_candidates(spark, d):
    return C.explode_carets(csharp(spark, d)).groupBy("kind", "subkind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("target")).alias("chars"))


@query()
def u8_sampled_carets(spark, d):
    return C.sampled_carets(csharp(spark, d), "20261009").select("file_id", "offset", "kind")


@query()
def x19_brace_closure(spark, d):
    """For each C# sample, the braces that close what its left context leaves open."""
    s = table(spark, d, "samples").where("relative_path like '%.cs'").select("sample_id", "left_context").distinct()
    close = F.pandas_udf(lambda x: x.map(C.brace_closure), "string")
    return s.select("sample_id", close("left_context").alias("closure"))


@query()
def m3_locals_in_scope(spark, d):
    """Locals and parameters declared before each C# caret, and those that only the target names (must be none of them)."""
    s = table(spark, d, "samples").where("relative_path like '%.cs'").select("sample_id", "left_context", "target_text", "right_context").distinct()

    def facts(left, target, right):
        import pandas as pd

        rows = []
        for a, b, c in zip(left, target, right, strict=True):
            names = C.locals_before(a, len(a))
            rows.append((names, C.leakage(names, a + b + c, len(a), len(a) + len(b))))
        return pd.DataFrame(rows, columns=["locals", "leaks"])

    f = F.pandas_udf(facts, "locals array<string>, leaks array<string>")
    return s.select("sample_id", f("left_context", "target_text", "right_context").alias("f")).select("sample_id", F.size("f.locals").alias("locals"), F.size("f.leaks").alias("leaks"))


@query(f"with n as (select file_id, unnest(regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*')) as name from {FILES} where language = 'csharp'), c as (select file_id, name, count(*) as n from n group by all) select file_id, count(*) as names, max(n) as most from c group by all")
def m11_name_occurrences(spark, d):
    n = csharp(spark, d).select("file_id", F.explode(F.regexp_extract_all("content", F.lit("([A-Za-z_][A-Za-z0-9_]*)"), 1)).alias("name"))
    return n.groupBy("file_id", "name").agg(F.count(F.lit(1)).alias("n")).groupBy("file_id").agg(F.count(F.lit(1)).alias("names"), F.max("n").alias("most"))


@query()
def a16_tokenizer_evaluation(spark, d):
    """Characters and bytes per token and fit rates by language, with a public tokenizer."""
    f = files(spark, d, "language", "content").where("content is not null").select("language", F.length("content").alias("chars"), F.octet_length("content").alias("bytes"), T.token_count(F.col("content")).alias("n"))
    q = lambda p: F.expr(f"percentile_disc({p}) within group (order by n)")
    return f.groupBy(F.coalesce("language", F.lit("none")).alias("language")).agg((F.sum("chars") / F.sum("n")).alias("chars_per_token"), (F.sum("bytes") / F.sum("n")).alias("bytes_per_token"), F.avg("n").alias("mean"), q(0.5).alias("p50"), q(0.95).alias("p95"), F.avg((F.col("n") <= 1024).cast("double")).alias("fit_1024"), F.avg((F.col("n") <= 2048).cast("double")).alias("fit_2048"))


@query()
def r9_encoded_files(spark, d):
    """Framed files as token ids; every file must decode to itself."""
    f = files(spark, d, "relative_path", "content")
    frame = F.concat(F.lit("<|path|>"), "relative_path", F.lit("\n<|code|>\n"), "content")
    e = f.select("file_id", T.encoded(frame).alias("e"))
    return e.select("file_id", F.size("e.ids").alias("n"), F.col("e.round_trip").alias("round_trip"))


@query()
def a17_tokens_by_split(spark, d):
    f = table(spark, d, "corpus").select("file_id", "split", "content").dropDuplicates(["file_id"]).select("split", F.length("content").alias("chars"), T.token_count(F.col("content")).alias("n"))
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("tokens"), F.sum("chars").alias("chars"), (F.sum("chars") / F.sum("n")).alias("chars_per_token"))


@query()
def r4_token_budget(spark, d):
    """Left contexts cut to a budget of tokens from the right, on a line break where there is one."""
    s = table(spark, d, "samples").select("sample_id", "left_context").distinct()
    return s.select("sample_id", T.last_tokens(F.col("left_context"), 64).alias("context"))


@query()
def f18_excluded_carets(spark, d):
    """Why candidates of C# files are left out: the first reason of the chain, by kind."""
    c = C.explode_carets(csharp(spark, d), reasons=True)
    return c.groupBy("kind", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query()
def f19_line_strata(spark, d):
    """Lines of C# files that hold no code to complete, by class."""
    return C.line_strata(csharp(spark, d)).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))


@query()
def u4_line_subkinds(spark, d):
    c = C.explode_carets(csharp(spark, d)).where("kind = 'line_start'")
    return c.groupBy("subkind").agg(F.count(F.lit(1)).alias("n"))


@query()
def u5_log_templates(spark, d):
    return C.explode_carets(csharp(spark, d)).where("kind = 'log_message'").groupBy("subkind").agg(F.count(F.lit(1)).alias("n"))


@query()
def u6_tags(spark, d):
    """Tags of the sampled carets."""
    f = csharp(spark, d, "is_test")
    t = C.tagged(f, C.sampled_carets(f, "20261009"))
    return t.select("kind", F.explode("tags").alias("tag")).groupBy("kind", "tag").agg(F.count(F.lit(1)).alias("n"))


def known(spark, d):
    """(declarations, facts, prefix) of the C# files and their samples."""
    f = cut(csharp(spark, d, "repository_id", "relative_path"))
    s = table(spark, d, "samples").where("relative_path like '%.cs'").select("sample_id", "repository_id", "relative_path", F.col("source_sha256").alias("sha256"), "caret_utf16_offset", "left_context").distinct()
    at = s.join(f.groupBy("repository_id", "relative_path", "sha256").agg(F.min("file_id").alias("file_id"), F.min("content").alias("content")), ["repository_id", "relative_path", "sha256"])
    carets = at.select("sample_id", "file_id", F.length(X.utf16_slice(F.col("content"), F.lit(0), F.col("caret_utf16_offset"))).alias("caret"))
    return cut(K.declarations(f)), cut(K.caret_facts(f, carets)), s.select("sample_id", X.prefix_identifiers(F.col("left_context")).alias("names"))


@query()
def m4_receiver_members(spark, d):
    """Members that stand behind the dot of each caret, for types that the repository declares."""
    decls, facts, prefix = known(spark, d)
    r = K.receiver_types(facts, decls).drop("used").join(prefix.withColumnRenamed("names", "used"), "sample_id")
    m = K.members_of(r, decls, "receiver_type", 24)
    return m.select("sample_id", F.col("type").alias("receiver_type"), F.transform("members", K.fact_text).alias("members"))


@query()
def m5_invocations(spark, d):
    decls, facts, _ = known(spark, d)
    return K.invocations(facts, decls).select("sample_id", "callee", "argument", F.transform("candidates", lambda c: c["signature"]).alias("signatures"))


@query()
def m6_expected_types(spark, d):
    _, facts, _ = known(spark, d)
    return facts.where("expected is not null").select("sample_id", "expected", "source")


@query()
def m7_context_types(spark, d):
    """Up to six types that matter at each caret, with up to ten members."""
    decls, facts, prefix = known(spark, d)
    t = K.context_types(facts, decls, prefix)
    wanted = t.join(facts.select("sample_id", "repository_id"), "sample_id").join(prefix.withColumnRenamed("names", "used"), "sample_id").select("sample_id", "repository_id", "type", "used", F.lit(False).alias("is_static"))
    m = K.members_of(wanted, decls, "type", 10)
    return t.join(m, ["sample_id", "type"], "left").select("sample_id", "type", "source", "place", F.size(F.coalesce("members", F.array())).alias("members"))


@query()
def m8_ranked_locals(spark, d):
    """Locals in the order of use: those that the prefix names first, then by name."""
    _, facts, prefix = known(spark, d)
    f = facts.join(prefix, "sample_id")
    key = F.transform("locals", lambda x: F.struct((~F.array_contains("names", x["name"])).alias("unused"), F.encode(x["name"], "UTF-16BE").alias("o"), x["name"].alias("name")))
    return f.select("sample_id", F.transform(F.array_sort(key), lambda x: x["name"]).alias("locals"))


@query()
def m9_status(spark, d):
    decls, facts, _ = known(spark, d)
    s = K.statuses(facts, K.receiver_types(facts, decls), K.invocations(facts, decls))
    return s.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


@query()
def m13_project_edges(spark, d):
    """References between the project files of each repository."""
    return K.project_edges(table(spark, d, "corpus").where("relative_path like '%.csproj'").select("repository_id", F.col("relative_path").alias("path"), F.col("content").alias("text")))


def fact_map(spark, d):
    decls, facts, prefix = known(spark, d)
    r = K.receiver_types(facts, decls).drop("used").join(prefix.withColumnRenamed("names", "used"), "sample_id")
    m = K.members_of(r, decls, "receiver_type", 24).select("sample_id", F.col("type").alias("receiver_type"), F.transform("members", K.fact_text).alias("members"))
    c = K.invocations(facts, decls).select("sample_id", F.transform("candidates", lambda c: F.concat(X.compact_signature(c["signature"]), F.lit(" @"), c["argument_index"].cast("string"))).alias("calls"))
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(F.col(c)))
    local = F.transform("locals", lambda x: F.concat_ws(":", x["name"], x["type"]))
    lines = F.create_map(F.lit("RET"), one("return_type"), F.lit("EXPECT"), one("expected"), F.lit("LOCAL"), local, F.lit("RECV"), one("receiver_type"), F.lit("MEMBER"), F.col("members"), F.lit("CALL"), F.col("calls"))
    return facts.join(m, "sample_id", "left").join(c, "sample_id", "left").select("sample_id", lines.alias("lines"))


@query()
def r3_fact_lines(spark, d):
    """Facts as text, a row per line."""
    return fact_map(spark, d).select("sample_id", F.explode("lines").alias("key", "items")).where("size(items) > 0").select("sample_id", "key", F.array_join("items", " ").alias("text"))


@query()
def r4_facts_block(spark, d):
    """Facts within 96 tokens, by priority."""
    return fact_map(spark, d).select("sample_id", P.facts_block(F.col("lines"), 96).alias("block"))


@query()
def r6_caret_documents(spark, d):
    """Documents of the C# samples with and without what is known at the caret."""
    s = table(spark, d, "samples").where("relative_path like '%.cs'").select("sample_id", "relative_path", "left_context", "target_text", "right_context").distinct()
    f = s.join(r4_facts_block(spark, d), "sample_id", "left")
    doc = lambda facts: P.document(F.col("relative_path"), F.col("left_context"), F.col("target_text"), F.col("right_context"), None, facts)
    both = f.select("sample_id", F.explode(F.array(doc(None), doc(F.col("block")))).alias("x")).select("sample_id", "x.*").distinct()
    return both.select("sample_id", "variant", F.length("prompt").alias("prompt_chars"), F.length("completion").alias("completion_chars"))


@query()
def r7_healed_documents(spark, d):
    """How many tokens of each sample's prompt move to its completion, being blanks after code."""
    s = table(spark, d, "samples").select("sample_id", "left_context", "target_text").distinct()
    e = s.select("sample_id", T.encoded(F.col("left_context")).alias("p"), T.encoded(F.col("target_text")).alias("c"))
    e = e.select("sample_id", F.concat("p.ids", "c.ids").alias("ids"), F.size("p.ids").alias("at"))
    return e.withColumn("new", P.healed_ids(F.col("ids"), F.col("at"))).select("sample_id", (F.col("at") - F.col("new")).alias("moved"))


@query()
def r10_encoded_by(spark, d):
    """Files as ids of another vocabulary: any ranks file will do, its path being a parameter."""
    f = files(spark, d, "relative_path", "content")
    e = f.select("file_id", T.encoded(F.col("content"), ENGINE).alias("e"))
    return e.select("file_id", F.size("e.ids").alias("n"), F.array_max("e.ids").alias("largest"), F.col("e.round_trip").alias("round_trip"))


@query()
def x13_go_signatures(spark, d):
    """Signatures of Go functions and methods in their compact form."""
    rx = r"(?m)^func[ \t]+(?:\([^()]*\)[ \t]*)?(\w[^{\n]*?)[ \t]*\{[ \t]*$"
    s = files(spark, d, "language", "content").where("language = 'go'").select("file_id", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(rx), 1))).alias("s"))
    return s.select("file_id", X.compact_go_signature(F.col("s")).alias("signature"))
