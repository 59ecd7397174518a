"""Queries over files and their text: discovery, predicates, lines, identifiers, licences, dependency roots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X
from tessel.operators import core as O
from tessel.plans.registry import FILES, glob_sql, points_sql, query, u_sql, units_sql
from tessel.session import table

FILE_COLUMNS = ["file_id", "repository_id", "relative_path", "language", "sha256", "bytes", "content", "project", "is_test", "newline_style", "has_bom", "lines", "license"]


def files(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Files once each: rows that are delivered twice are equal, so the key alone tells them apart.

    Texts are spread over all shuffle partitions: what follows is work per character, which partitions that adaptive execution
    has joined by their few bytes would leave to one core.
    """
    wanted = list(dict.fromkeys(["file_id", *(columns or FILE_COLUMNS)]))
    f = table(spark, d, "corpus").select(*wanted)
    if "content" in wanted:
        f = f.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_id")
    return f.dropDuplicates(["file_id"])


# Licences that a repository may name and that aren't allowed here.
REFUSED = ["Proprietary", "GPL-3.0", "GPL-3.0-only", "GPLv3", "LGPL-2.1", "LGPL-2.1-only"]

_RULES = f"""case when {glob_sql('relative_path', O.EXCLUDE)} then 'excluded_path' when bytes > {O.MAX_BYTES} then 'too_large' when {glob_sql('relative_path', O.VENDORED)} then 'vendored_path'
 when {glob_sql('relative_path', O.GENERATED)} then 'generated_path' when contains(content, chr(0)) then 'binary_nul' when trim(content, ' ') = '' then 'empty'
 when regexp_matches(substr(content, 1, {O.MARKER_CHARS}), '(?i)<auto-?generated|This code was generated by a tool|\\[(System\\.CodeDom\\.Compiler\\.)?GeneratedCode(Attribute)?\\(') then 'generated_marker'
 when list_max(list_transform(regexp_split_to_array(content, '\\r\\n|\\n|\\r'), lambda x: length(x))) > {O.MAX_LINE} then 'long_lines' when license in ({', '.join(repr(x) for x in REFUSED)}) then 'license_not_allowed'
 when {' or '.join(f"regexp_matches(content, '{p}')" for p in O.SECRET_FILE)} then 'secret_detected' end"""
_DISCOVERY = f"""with f as (select *, {_RULES} as rule from {FILES}),
r as (select *, row_number() over (partition by repository_id, sha256, rule is null order by relative_path, file_id) as rn, first_value(relative_path) over (partition by repository_id, sha256, rule is null order by relative_path, file_id) as fp from f),
o as (select file_id, repository_id, relative_path, coalesce(rule, case when rn > 1 then 'exact_duplicate' end, 'accepted') as reason, case when rule is null and rn > 1 then fp end as duplicate_of from r)"""


def discovered(spark: SparkSession, d: str) -> DataFrame:
    return O.discovery(files(spark, d, "repository_id", "relative_path", "bytes", "sha256", "content", "license"), scope=["repository_id"], order=["relative_path", "file_id"], allowed=F.coalesce(~F.col("license").isin(REFUSED), F.lit(True)))


_SPLIT = f"case when {u_sql('$$20261009$$', '$$repo_split$$', 'repository_id')} < 0.1 then 'validation' when {u_sql('$$20261009$$', '$$repo_split$$', 'repository_id')} < 0.2 then 'test' else 'train' end".replace("$$", "'")


def repo_split(column: str = "repository_id"):
    return O.hash_split(F.col(column), "20261009", "repo_split", [("validation", 0.1), ("test", 0.1)], "train")


@query(_DISCOVERY + f" select {_SPLIT} as split, reason, count(*) as n from o group by all")
def f1_discovery_counts(spark, d):
    return discovered(spark, d).groupBy(repo_split().alias("split"), "reason").agg(F.count(F.lit(1)).alias("n"))


@query(_DISCOVERY + " select file_id, reason, duplicate_of from o")
def f1_discovery_files(spark, d):
    return discovered(spark, d).select("file_id", "reason", "duplicate_of")


@query(f"select file_id, {'coalesce(' + ', '.join(f'''case when {glob_sql('relative_path', [p])} then '{p}' end''' for p in [*O.GENERATED, *O.VENDORED]) + ')'} as pattern from (select distinct file_id, relative_path from corpus) where {glob_sql('relative_path', [*O.GENERATED, *O.VENDORED])}")
def f2_glob_first_match(spark, d):
    f = files(spark, d, "relative_path").withColumn("pattern", X.first_match(F.col("relative_path"), [*O.GENERATED, *O.VENDORED]))
    return f.where("pattern is not null").select("file_id", "pattern")


@query(f"select repository_id, count(*) filter (bytes > 4096) as large, count(*) as n from {FILES} group by all")
def f3_size_limit(spark, d):
    return files(spark, d, "repository_id", "bytes").groupBy("repository_id").agg(F.count_if(F.col("bytes") > 4096).alias("large"), F.count(F.lit(1)).alias("n"))


@query(f"select file_id, regexp_extract(substr(content, 1, {O.MARKER_CHARS}), '(?i)<auto-?generated|This code was generated by a tool') as marker from {FILES} where regexp_matches(substr(content, 1, {O.MARKER_CHARS}), '(?i)<auto-?generated|This code was generated by a tool')")
def f4_generated_marker(spark, d):
    rx = "(?i)<auto-?generated|This code was generated by a tool"
    f = files(spark, d, "content").withColumn("marker", F.regexp_extract(F.substring("content", 1, O.MARKER_CHARS), rx, 0))
    return f.where("marker <> ''").select("file_id", "marker")


@query(f"select file_id, list_max(list_transform(regexp_split_to_array(content, '\\r\\n|\\n|\\r'), lambda x: length(x)))::int as longest from {FILES} where content is not null and list_max(list_transform(regexp_split_to_array(content, '\\r\\n|\\n|\\r'), lambda x: length(x))) > 400")
def f5_long_lines(spark, d):
    longest = F.array_max(F.transform(F.split("content", r"\r\n|\n|\r", -1), lambda x: F.length(x)))
    return files(spark, d, "content").withColumn("longest", longest).where("longest > 400").select("file_id", "longest")


@query(f"select file_id, {'case ' + ' '.join(f'''when regexp_matches(content, '{p}') then {i}''' for i, p in enumerate(O.SECRET_FILE)) + ' end'}::int as pattern from {FILES} where {' or '.join(f'''regexp_matches(content, '{p}')''' for p in O.SECRET_FILE)}")
def f6_secret_pattern(spark, d):
    which = F.coalesce(*[F.when(F.col("content").rlike(p), F.lit(i)) for i, p in enumerate(O.SECRET_FILE)])
    return files(spark, d, "content").withColumn("pattern", which).where("pattern is not null").select("file_id", "pattern")


_NAMED = r'(?i)\b\w*(?:password|passwd|pwd|secret|apikey|api_key|accesstoken|access_token)\w*"?\s*[:=]\s*@?"([^"\s{}]{8,})"'


@query(f"""with l as (select file_id, unnest(string_split(content, chr(10))) as line from {FILES}), v as (select file_id, line, list_filter(regexp_extract_all(line, '{_NAMED}', 1), lambda v: not regexp_full_match(v, '[A-Z0-9_]+')) as v from l)
select file_id, count(*) as n from v where len(v) > 0 or regexp_matches(line, '{O.SECRET_PAIR.replace("'", "''")}') group by all""")
def f7_secret_lines(spark, d):
    """Lines with a literal under a credential's name, by the two patterns (the SQL, without lookahead, tests all literals of a line)."""
    line = files(spark, d, "content").select("file_id", F.explode(F.split("content", "\n", -1)).alias("line"))
    return line.where(F.col("line").rlike(O.SECRET_LINE) | F.col("line").rlike(O.SECRET_PAIR)).groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"select coalesce(language, 'none') as language, count(*) filter ({glob_sql('relative_path', O.TESTS)}) as tests, count(*) as n from {FILES} group by all")
def f9_test_files(spark, d):
    test = X.first_match(F.col("relative_path"), O.TESTS).isNotNull()
    return files(spark, d, "language", "relative_path").groupBy(F.coalesce("language", F.lit("none")).alias("language")).agg(F.count_if(test).alias("tests"), F.count(F.lit(1)).alias("n"))


_URL = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', {})"


@query(f"""with j as (select distinct url from jobs union all select 'http://forge.example/a/b' union all select 'https://u:p@forge.example/a/b.git' union all select 'https://forge.example/one' union all select 'https://other.example/a/b' union all select 'a b'),
p as (select url, lower({_URL.format(1)}) as scheme, {_URL.format(2)} as auth, trim({_URL.format(3)}, '/') as path from j),
q as (select *, lower(regexp_replace(auth, ':[0-9]*$', '')) as host, string_split(path, '/') as segs from p),
r as (select *, case when url is null or trim(url) = '' then 'empty_url' when regexp_matches(url, '[;|&$`\\n\\r "''\\\\]') then 'unsafe_characters' when scheme = '' then 'not_absolute_url' when scheme <> 'https' then 'scheme_not_allowed'
 when contains(auth, '@') then 'credentials_in_url' when host <> 'forge.example' then 'host_not_allowed' when len(segs) < 2 or list_contains(segs, '') or list_contains(segs, '.') or list_contains(segs, '..') then 'invalid_repository_path' end as reason from q)
select url, reason, case when reason is null then host || '/' || regexp_replace(path, '(?i)\\.git$', '') end as repository_id from r""")
def f10_url_normalize(spark, d):
    """Canonical ids of repository URLs, with the reason of those that have none."""
    extra = ["http://forge.example/a/b", "https://u:p@forge.example/a/b.git", "https://forge.example/one", "https://other.example/a/b", "a b"]
    urls = table(spark, d, "jobs").select("url").distinct().union(spark.createDataFrame([(u,) for u in extra], "url string"))
    return urls.select("url", normalized_url(F.col("url"), ["https"], ["forge.example"]).alias("n")).select("url", "n.reason", F.col("n.id").alias("repository_id"))


def normalized_url(url, schemes: list[str], hosts: list[str]):
    """struct<id, reason> of a repository URL: exactly one of the two is set."""
    rx = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"
    scheme, auth, path = F.lower(F.regexp_extract(url, rx, 1)), F.regexp_extract(url, rx, 2), F.regexp_replace(F.regexp_extract(url, rx, 3), "^/+|/+$", "")
    host, segs = F.lower(F.regexp_replace(auth, ":[0-9]*$", "")), F.split(path, "/", -1)
    reason = X.first_reason([
        ("empty_url", url.isNull() | (F.trim(url) == "")), ("unsafe_characters", url.rlike("[;|&$`\\n\\r \"'\\\\]")), ("not_absolute_url", scheme == ""), ("scheme_not_allowed", ~scheme.isin(schemes)),
        ("credentials_in_url", auth.contains("@")), ("host_not_allowed", ~host.isin(hosts)), ("invalid_repository_path", (F.size(segs) < 2) | F.exists(segs, lambda s: s.isin("", ".", ".."))),
    ])
    return F.struct(F.when(reason.isNull(), F.concat(host, F.lit("/"), F.regexp_replace(path, r"(?i)\.git$", ""))).alias("id"), reason.alias("reason"))


# Ends of names that sign-up pages make up.
_MADE_UP = r"(?i)^[a-z]{5,}\d{2,}-(blip|bit|hue|boop|dotcom|coder|source|ltd|dev|cyber|gen|user|tmp)$"


@query(f"""with o as (select distinct split_part(repo_id, '/', 2) as owner from jobs union select 'qwrtplkjhg1234' union select 'sunny12-dev' union select 'Bcdfg-hjklm99'), s as (select owner, regexp_replace(lower(owner), '[-_0-9]', '', 'g') as stem from o where owner <> '')
select owner, regexp_matches(owner, '{_MADE_UP}') or (length(stem) >= 10 and regexp_matches(owner, '[0-9]{{3,}}') and length(regexp_replace(stem, '[^aeiou]', '', 'g'))::double / length(stem) < 0.22) as gibberish from s""")
def f14_gibberish_owner(spark, d):
    """Owners with a made-up name, or a long stem of few vowels and three digits in a row."""
    more = spark.createDataFrame([("qwrtplkjhg1234",), ("sunny12-dev",), ("Bcdfg-hjklm99",)], "owner string")
    o = table(spark, d, "jobs").select(F.split_part("repo_id", F.lit("/"), F.lit(2)).alias("owner")).where("owner <> ''").union(more).distinct()
    stem = F.regexp_replace(F.lower("owner"), "[-_0-9]", "")
    few = F.length(F.regexp_replace(stem, "[^aeiou]", "")) / F.length(stem) < 0.22
    return o.select("owner", (F.col("owner").rlike(_MADE_UP) | ((F.length(stem) >= 10) & F.col("owner").rlike("[0-9]{3,}") & few)).alias("gibberish"))


@query(f"""with s as (select distinct sample_id, target_text, tags from samples), r as (select case when target_text = '' then 'empty_target' when length(target_text) > 120 then 'target_too_long' when list_contains(tags, 'string') then 'caret_inside_literal'
 when regexp_matches(target_text, '{O.SECRET_PAIR.replace("'", "''")}') then 'secret_detected' else 'kept' end as reason from s) select reason, count(*) as n from r group by all""")
def f18_sample_exclusions(spark, d):
    t = F.col("target_text")
    s = table(spark, d, "samples").select("sample_id", "target_text", "tags").distinct()
    reason = X.first_reason([("empty_target", t == ""), ("target_too_long", F.length(t) > 120), ("caret_inside_literal", F.array_contains("tags", "string")), ("secret_detected", t.rlike(O.SECRET_PAIR))])
    return s.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_LINE_CLASS = "case when trim(line, ' ' || chr(9) || chr(13)) = '' then 'blank' when regexp_matches(line, '^[ \\t]*///') then 'doc_comment' when regexp_matches(line, '^[ \\t]*//') then 'comment' when regexp_matches(line, '^[ \\t]*#') then 'preprocessor_directive' when length(line) > 200 then 'line_too_long' else 'code' end"


@query(f"with l as (select unnest(string_split(content, chr(10))) as line from {FILES} where language = 'csharp') select {_LINE_CLASS} as line_class, count(*) as n from l group by all")
def f19_line_classes(spark, d):
    line = files(spark, d, "language", "content").where("language = 'csharp'").select(F.explode(F.split("content", "\n", -1)).alias("line"))
    c = F.col("line")
    kind = X.first_reason([("blank", F.regexp_replace(c, r"^[ \t\r]+|[ \t\r]+$", "") == ""), ("doc_comment", c.rlike(r"^[ \t]*///")), ("comment", c.rlike(r"^[ \t]*//")), ("preprocessor_directive", c.rlike(r"^[ \t]*#")), ("line_too_long", F.length(c) > 200)])
    return line.groupBy(F.coalesce(kind, F.lit("code")).alias("line_class")).agg(F.count(F.lit(1)).alias("n"))


@query("select caret_kind, count(*) filter (regexp_full_match(target_text, '[{}()\\[\\];, ]*')) as trivial, count(*) as n from (select distinct sample_id, caret_kind, target_text from samples) group by all")
def f20_trivial_targets(spark, d):
    s = table(spark, d, "samples").select("sample_id", "caret_kind", "target_text").distinct()
    return s.groupBy("caret_kind").agg(F.count_if(F.col("target_text").rlike(r"^[{}()\[\];, ]*$")).alias("trivial"), F.count(F.lit(1)).alias("n"))


@query(f"select count(*) filter (contains(content, '<|code|>') or contains(content, '<|eol|>') or contains(content, '{{{{')) as skipped, count(*) as n from {FILES}")
def f21_special_tokens(spark, d):
    hit = F.exists(F.array(*[F.lit(x) for x in ("<|code|>", "<|eol|>", "{{")]), lambda x: F.contains(F.col("content"), x))
    return files(spark, d, "content").agg(F.count_if(hit).alias("skipped"), F.count(F.lit(1)).alias("n"))


@query("select sample_id, d as after_dot_partial, t as truncated from (select distinct sample_id, caret_kind = 'identifier_partial' and regexp_matches(left_context, '\\.[A-Za-z_][A-Za-z0-9_]*$') as d, left_context_truncated and right_context_truncated as t from samples) where d or t")
def f22_redo(spark, d):
    """Samples to be done again: a name partly typed after a dot, or a record that was cut off; both reasons count."""
    dotted = (F.col("caret_kind") == "identifier_partial") & F.col("left_context").rlike(r"\.[A-Za-z_][A-Za-z0-9_]*\z")
    s = table(spark, d, "samples").select("sample_id", dotted.alias("after_dot_partial"), (F.col("left_context_truncated") & F.col("right_context_truncated")).alias("truncated")).distinct()
    return s.where("after_dot_partial or truncated")


@query(f"with l as (select file_id, len(string_split(content, chr(10))) as n, list_max(list_transform(string_split(content, chr(10)), lambda x: length(x))) as m, length(content) as c from {FILES}) select file_id, n::int as lines, m::int as longest, c::int as chars from l")
def x5_line_stats(spark, d):
    parts = F.split("content", "\n", -1)
    return files(spark, d, "content").select("file_id", F.size(parts).alias("lines"), F.array_max(F.transform(parts, lambda x: F.length(x))).cast("int").alias("longest"), F.length("content").alias("chars"))


@query(f"""with k as (select file_id, list_sort(list_distinct(regexp_extract_all(content, '\\r\\n|[\\r\\n]'))) as k from {FILES})
select case when len(k) = 0 then 'none' when len(k) > 1 then 'mixed' when k[1] = chr(10) then 'lf' when k[1] = chr(13) then 'cr' else 'crlf' end as style, count(*) as n from k group by all""")
def a26_newline_style(spark, d):
    return files(spark, d, "content").groupBy(X.newline_style(F.col("content")).alias("style")).agg(F.count(F.lit(1)).alias("n"))


_SPACES = "\\t\\x0b\\f \\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}"


@query(f"with l as (select unnest(regexp_split_to_array(content, '\\r\\n|[\\r\\n\\x{{85}}\\x{{2028}}\\x{{2029}}]')) as line from {FILES}) select length(regexp_extract(line, '^[{_SPACES}]*'))::int as width, count(*) as n from l group by all")
def x6_indentation(spark, d):
    line = files(spark, d, "content").select(F.explode(X.lines(F.col("content"))).alias("line"))
    return line.groupBy(F.length(X.indentation(F.col("line"))).alias("width")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select file_id, substr(sha256(coalesce(repository_id, '') || chr(31) || coalesce(relative_path, '') || chr(31) || coalesce(project, '')), 1, 32) as id from {FILES}")
def x2_stable_id(spark, d):
    f = files(spark, d, "repository_id", "relative_path", "project")
    return f.select("file_id", X.stable_id(F.col("repository_id"), F.col("relative_path"), F.col("project")).alias("id"))


@query(f"select sum(length(content) + (length(regexp_replace(content, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))))::bigint as utf16, sum(strlen(content))::bigint as utf8, sum(length(content))::bigint as points from {FILES}")
def x3_lengths(spark, d):
    return files(spark, d, "content").agg(F.sum(X.utf16_len(F.col("content"))).alias("utf16"), F.sum(F.octet_length("content")).alias("utf8"), F.sum(F.length("content")).alias("points"))


@query(f"select lower(regexp_replace(regexp_replace(repo_id, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) as slug, count(*) as n from jobs group by all")
def x17_slug(spark, d):
    return table(spark, d, "jobs").groupBy(X.slug(F.col("repo_id")).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with i as (select file_id, unnest(list_distinct(regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*'))) as name from {FILES}) select name, count(*) as files from i group by all having count(*) >= 3")
def d7_identifiers(spark, d):
    i = files(spark, d, "content").select("file_id", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit("([A-Za-z_][A-Za-z0-9_]*)"), 1))).alias("name"))
    return i.groupBy("name").agg(F.count(F.lit(1)).alias("files")).where("files >= 3")


@query(f"with t as (select unnest(regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*|[0-9]+|[^\\sA-Za-z0-9_]')) as token from {FILES}) select token, count(*) as n from t group by all having count(*) >= 2")
def a21_token_counts(spark, d):
    t = files(spark, d, "content").select(F.explode(F.regexp_extract_all("content", F.lit(f"({X.TOKEN})"), 1)).alias("token"))
    return t.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


_USING = r"(?m)^[ \t]*(?:global[ \t]+)?using[ \t]+(?:static[ \t]+)?(?:[A-Za-z_]\w*[ \t]*=[ \t]*)?(?:global::)?([A-Za-z_][\w.]*)[ \t]*;"
_ROOT = "case when split_part(ns, '.', 1) = 'System' then null when split_part(ns, '.', 1) in ('Microsoft', 'Google', 'Amazon', 'Azure') then array_to_string(string_split(ns, '.')[1:2], '.') else split_part(ns, '.', 1) end"
_ROOTS = f"u as (select distinct file_id, repository_id, unnest(regexp_extract_all(content, '{_USING}', 1)) as ns from {FILES} where language = 'csharp'), r as (select distinct repository_id, file_id, {_ROOT} as root from u where {_ROOT} is not null)"


def file_roots(spark: SparkSession, d: str) -> DataFrame:
    """(repository_id, file_id, root) of the C# usings: the first name, two for the large vendors, none of the standard library."""
    u = files(spark, d, "repository_id", "language", "content").where("language = 'csharp'").select("repository_id", "file_id", F.explode(F.regexp_extract_all("content", F.lit(_USING), 1)).alias("ns"))
    head = F.split_part("ns", F.lit("."), F.lit(1))
    root = F.when(head == "System", F.lit(None)).when(head.isin("Microsoft", "Google", "Amazon", "Azure"), F.array_join(F.slice(F.split("ns", r"\."), 1, 2), ".")).otherwise(head)
    return u.select("repository_id", "file_id", root.alias("root")).where("root is not null").distinct()


@query(f"with {_ROOTS} select repository_id, root, count(*) as files from r group by all")
def a15_dependency_roots(spark, d):
    return file_roots(spark, d).groupBy("repository_id", "root").agg(F.count(F.lit(1)).alias("files"))


@query(f"with {_ROOTS}, n as (select repository_id, root, count(*) as files from r group by all), p as (select f.file_id, n.root, n.files - case when r.root is null then 0 else 1 end as others from (select distinct repository_id, file_id from r) f join n using (repository_id) left join r on r.file_id = f.file_id and r.root = n.root) select file_id, root, others from p where others >= 2")
def x16_profile_roots(spark, d):
    """For each file the roots used in at least two other files of its repository."""
    r = file_roots(spark, d)
    n = r.groupBy("repository_id", "root").agg(F.count(F.lit(1)).alias("files"))
    every = r.select("repository_id", "file_id").distinct().join(n, "repository_id")
    p = every.join(r.select("file_id", "root", F.lit(1).alias("own")), ["file_id", "root"], "left").withColumn("others", F.col("files") - F.coalesce("own", F.lit(0)))
    return p.where("others >= 2").select("file_id", "root", "others")


@query(f"select count(*) filter (sha256(content) = sha256) as same, count(*) filter (strlen(content) + (case when has_bom then 3 else 0 end) = bytes) as size_ok, count(*) filter (len(string_split(content, chr(10))) = lines) as lines_ok, count(*) as n from {FILES}")
def v2_reconstruction(spark, d):
    """How many files give back their digest, size and line count from what is stored."""
    f = files(spark, d, "content", "sha256", "bytes", "has_bom", "lines")
    return f.agg(
        F.count_if(F.sha2("content", 256) == F.col("sha256")).alias("same"), F.count_if(F.octet_length("content") + F.when(F.col("has_bom"), 3).otherwise(0) == F.col("bytes")).alias("size_ok"),
        F.count_if(F.size(F.split("content", "\n", -1)) == F.col("lines")).alias("lines_ok"), F.count(F.lit(1)).alias("n"),
    )


@query(f"""with marked as (select distinct repository_id, regexp_extract(relative_path, '^(.*)/[^/]*$', 1) as dir, project from {FILES} where project is not null and contains(relative_path, '/')),
m as (select repository_id || '/' || dir as dir, min(project) as project from marked group by all), p as (select file_id, repository_id || '/' || relative_path as path from {FILES}),
u as (select p.file_id, m.project, length(m.dir) as k from p join m on starts_with(p.path, m.dir || '/'))
select p.file_id, arg_max(u.project, u.k) as project from p left join u using (file_id) group by 1""")
def j20_nearest_project(spark, d):
    f = files(spark, d, "repository_id", "relative_path", "project")
    folder = F.regexp_extract("relative_path", "^(.*)/[^/]*$", 1)
    m = f.where("project is not null and relative_path like '%/%'").groupBy(F.concat_ws("/", "repository_id", folder).alias("dir")).agg(F.min("project").alias("project"))
    paths = f.select("file_id", F.concat_ws("/", "repository_id", "relative_path").alias("path"))
    return O.nearest_ancestor(paths, "path", m, "dir", "project").select("file_id", "project")


@query(f"""with l as (select unnest(string_split(content, chr(10))) as line from {FILES}), k as (select trim(line, ' ' || chr(9) || chr(13)) as t from l), b as (select t, count(*) as n from k where t <> '' group by t)
select count(*) as kept, (sum(n) - count(*))::bigint as dropped, round((sum(n) - count(*))::double / sum(n), 6) as fraction from b""")
def d2_boilerplate(spark, d):
    """Lines that a line before (by path, file and number) already had."""
    line = files(spark, d, "content").select(F.explode(F.split("content", "\n", -1)).alias("line"))
    t = line.select(F.regexp_replace("line", r"^[ \t\r]+|[ \t\r]+$", "").alias("t")).where("t <> ''")
    per = t.groupBy("t").agg(F.count(F.lit(1)).alias("n"))  # the first of each text stays, so counts suffice
    total = per.agg(F.count(F.lit(1)).alias("kept"), (F.sum("n") - F.count(F.lit(1))).alias("dropped"))
    return total.select("kept", "dropped", F.round(F.col("dropped") / (F.col("kept") + F.col("dropped")), 6).alias("fraction"))


@query("""with s as (select distinct sample_id, relative_path, caret_utf16_offset as off, regexp_extract(left_context, '([^\\r\\n]*)$', 1) as l, target_text from samples),
k as (select sample_id, relative_path, off, sha256(trim(l || target_text, ' ' || chr(9)) || chr(1) || (length(l) - (length(l || target_text) - length(ltrim(l || target_text, ' ' || chr(9)))))) as k from s),
r as (select *, row_number() over (partition by k order by relative_path, off, sample_id) as n from k) select count(*) filter (n = 1) as kept, count(*) filter (n > 1) as dropped from r""")
def d2_boilerplate_carets(spark, d):
    """Carets at the same place of the same line, blanks around it aside: all but the first (by path and offset) are boilerplate."""
    s = table(spark, d, "samples").select("sample_id", F.regexp_extract("left_context", r"([^\r\n]*)\z", 1).alias("l"), "target_text").distinct()
    line = F.concat("l", "target_text")
    column = F.length("l") - (F.length(line) - F.length(F.regexp_replace(line, r"^[ \t]+", "")))
    k = s.groupBy(F.sha2(F.concat(F.regexp_replace(line, r"^[ \t]+|[ \t]+$", ""), F.lit("\x01"), column.cast("string")), 256).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return k.agg(F.count(F.lit(1)).alias("kept"), (F.sum("n") - F.count(F.lit(1))).alias("dropped"))


@query(f"select sample_id, case when f.file_id is null then 'no_file' when substr(f.content, ({points_sql('f.content', 's.caret_utf16_offset')})::bigint + 1, length(s.target_text)) <> s.target_text then 'text_mismatch' else 'ok' end as status from (select distinct sample_id, repository_id, relative_path, source_sha256, caret_utf16_offset, target_text from samples) s left join (select repository_id, relative_path, sha256, min(file_id) as file_id, min(content) as content from {FILES} group by all) f on s.repository_id = f.repository_id and s.relative_path = f.relative_path and s.source_sha256 = f.sha256")
def j10_positions_with_reason(spark, d):
    """Samples against the text of their file, by UTF-16 units: no_file, text_mismatch or ok."""
    f = files(spark, d, "repository_id", "relative_path", "sha256", "content")
    f = f.groupBy("repository_id", "relative_path", F.col("sha256").alias("source_sha256")).agg(F.encode(F.min("content"), "UTF-16BE").alias("units"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "source_sha256", "caret_utf16_offset", "target_text").distinct()
    j = s.join(f, ["repository_id", "relative_path", "source_sha256"], "left")
    target = F.encode("target_text", "UTF-16BE")
    here = F.substr("units", (2 * F.col("caret_utf16_offset") + 1).cast("int"), F.octet_length(target))
    return j.select("sample_id", F.when(F.col("units").isNull(), "no_file").when(here != target, "text_mismatch").otherwise("ok").alias("status"))


@query(f"""select sample_id, '<|cs|><|path|>' || relative_path || chr(10) || '<|code|>' || chr(10) || case when length(left_context) <= 400 then left_context when position(chr(10) in substr(left_context, length(left_context) - 399)) > 0 and length(left_context) - 400 + position(chr(10) in substr(left_context, length(left_context) - 399)) < length(left_context)
 then substr(left_context, length(left_context) - 400 + position(chr(10) in substr(left_context, length(left_context) - 399)) + 1) else substr(left_context, length(left_context) - 399) end || '<|complete|>' as prompt, target_text || '<|eol|>' as completion from (select distinct sample_id, relative_path, left_context, target_text from samples)""")
def r1_prompts(spark, d):
    s = table(spark, d, "samples").select("sample_id", "relative_path", "left_context", "target_text").distinct()
    prompt = F.concat(F.lit("<|cs|><|path|>"), "relative_path", F.lit("\n<|code|>\n"), O.cut_left(F.col("left_context"), 400), F.lit("<|complete|>"))
    return s.select("sample_id", prompt.alias("prompt"), F.concat("target_text", F.lit("<|eol|>")).alias("completion"))


@query()
def r2_budgeted_block(spark, d):
    """Per file a block of facts (namespace, usings, names) within 200 characters, admitted by priority."""
    f = files(spark, d, "language", "content").where("language = 'csharp'")
    take = lambda rx: F.array_distinct(F.regexp_extract_all("content", F.lit(rx), 1))
    line = lambda o, p, k, items, sep: F.struct(F.lit(float(o)).alias("order"), F.lit(p).alias("priority"), F.lit(k).alias("key"), items.alias("items"), F.lit(sep).alias("sep"))
    facts = F.array(line(0, 2, "USE", take(_USING), " "), line(1, 0, "TYPE", take(r"\b(?:class|record|struct|interface)\s+(\w+)"), " "), line(2, 1, "CALL", take(r"\.(\w+)\("), "; "))
    return f.select("file_id", O.budgeted_lines(facts, 200, 24).alias("b")).select("file_id", "b.text", "b.dropped")


@query(f"with s as (select distinct sample_id, repository_id, caret_kind, target_text from samples), q as (select *, {u_sql(chr(39) + '7' + chr(39), chr(39) + 'caret' + chr(39), 'sample_id')} as u, case caret_kind when 'line_start' then 0.7 when 'identifier_partial' then 0.035 when 'member_access' then 0.8 when 'argument_list' then 0.5 when 'after_keyword' then 0.5 when 'after_operator' then 0.4 end * case when regexp_full_match(target_text, '[{{}}()\\[\\];, ]*') then 0.05 else 1.0 end as w from s) select sample_id from q where u < w")
def l3_weighted_sampling(spark, d):
    s = table(spark, d, "samples").select("sample_id", "caret_kind", "target_text").distinct()
    weights = {"line_start": 0.7, "identifier_partial": 0.035, "member_access": 0.8, "argument_list": 0.5, "after_keyword": 0.5, "after_operator": 0.4}
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("caret_kind")] * F.when(F.col("target_text").rlike(r"^[{}()\[\];, ]*$"), 0.05).otherwise(1.0)
    return s.where(X.uniform(F.lit("7"), F.lit("caret"), F.col("sample_id")) < w).select("sample_id")


@query(f"select repository_id, {_SPLIT} as split from (select distinct repository_id from corpus)")
def l7_repository_split(spark, d):
    return table(spark, d, "corpus").select("repository_id").distinct().select("repository_id", repo_split().alias("split"))


@query("select split, count(distinct r) as repositories, count(*) as n from (select distinct file_id, repository_id as r, case when split = 'eval' then 'validation' else split end as split from corpus) group by all")
def v3_split_names(spark, d):
    c = table(spark, d, "corpus").select("file_id", F.col("repository_id").alias("r"), F.when(F.col("split") == "eval", "validation").otherwise(F.col("split")).alias("split")).distinct()
    return c.groupBy("split").agg(F.count_distinct("r").alias("repositories"), F.count(F.lit(1)).alias("n"))


@query("with g as (select split_group, count(distinct split) as k from (select distinct file_id, lower(trim(split_group)) as split_group, split from file_contexts where split_group is not null) group by all) select count(*) filter (k > 1) as torn, count(*) as groups from g")
def v3_split_isolation(spark, d):
    c = table(spark, d, "file_contexts").where("split_group is not null").select(F.lower(F.trim("split_group")).alias("g"), "split").distinct()
    return c.groupBy("g").agg(F.count("split").alias("k")).agg(F.count_if(F.col("k") > 1).alias("torn"), F.count(F.lit(1)).alias("groups"))


@query(f"""select count(*) filter (not contains(target_text, chr(10))) as single_line, count(*) filter (caret_utf16_offset >= line_start_utf16_offset and target_end_utf16_offset <= line_end_utf16_offset) as inside_line, count(*) filter (target_end_utf16_offset - caret_utf16_offset = {units_sql('target_text')}) as span_ok,
 count(*) filter (target_end_byte_offset - caret_byte_offset = strlen(target_text)) as bytes_ok, count(*) filter ({units_sql('left_context')} = caret_utf16_offset - left_context_start_utf16_offset) as left_ok, count(*) filter ({units_sql('right_context')} = right_context_end_utf16_offset - target_end_utf16_offset) as right_ok,
 count(*) filter (left_context_truncated = (left_context_start_utf16_offset > 0)) as flag_ok, count(*) filter (caret_column_utf16_zero_based = caret_utf16_offset - line_start_utf16_offset) as column_ok, count(*) as n from (select distinct * from samples)""")
def v5_sample_checks(spark, d):
    """The counted invariants of samples; spans count UTF-16 units and bytes."""
    s = table(spark, d, "samples").select("sample_id", "target_text", "left_context", "right_context", "caret_utf16_offset", "target_end_utf16_offset", "line_start_utf16_offset", "line_end_utf16_offset", "caret_byte_offset", "target_end_byte_offset", "left_context_start_utf16_offset", "right_context_end_utf16_offset", "left_context_truncated", "caret_column_utf16_zero_based").dropDuplicates(["sample_id"])
    c, u = F.col, lambda x: X.utf16_len(F.col(x))
    checks = {
        "single_line": ~F.contains(c("target_text"), F.lit("\n")), "inside_line": (c("caret_utf16_offset") >= c("line_start_utf16_offset")) & (c("target_end_utf16_offset") <= c("line_end_utf16_offset")),
        "span_ok": c("target_end_utf16_offset") - c("caret_utf16_offset") == u("target_text"), "bytes_ok": c("target_end_byte_offset") - c("caret_byte_offset") == F.octet_length("target_text"),
        "left_ok": u("left_context") == c("caret_utf16_offset") - c("left_context_start_utf16_offset"), "right_ok": u("right_context") == c("right_context_end_utf16_offset") - c("target_end_utf16_offset"),
        "flag_ok": c("left_context_truncated") == (c("left_context_start_utf16_offset") > 0), "column_ok": c("caret_column_utf16_zero_based") == c("caret_utf16_offset") - c("line_start_utf16_offset"),
    }
    return s.agg(*[F.count_if(x).alias(n) for n, x in checks.items()], F.count(F.lit(1)).alias("n"))


@query("with s as (select distinct sample_id, repository_id from samples) select count(*) as n, count(distinct sample_id) as ids from s")
def v3_unique_ids(spark, d):
    return table(spark, d, "samples").select("sample_id", "repository_id").distinct().agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample_id").alias("ids"))
