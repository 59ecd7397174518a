"""The queries of the subpackage by name, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm import binpack, caps, components, license, mixing, origin, overlap, parse, pii, secrets, tokens
from tessel.llm.common import cut, table

Q = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return license.verdicts(table(spark, d, "corpus"), table(spark, d, "jobs"), table(spark, d, "license_info"), table(spark, d, "license_texts"))


def p1_inherited(spark: SparkSession, d: str) -> DataFrame:
    return license.inherited(table(spark, d, "corpus"), table(spark, d, "jobs"), table(spark, d, "license_info"), table(spark, d, "license_texts"))


def p2_method(spark: SparkSession, d: str) -> DataFrame:
    return origin.recurring(table(spark, d, "corpus"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return origin.origin(table(spark, d, "corpus"), table(spark, d, "path_patterns"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return parse.not_parsing(table(spark, d, "corpus"))


def p3_faults(spark: SparkSession, d: str) -> DataFrame:
    return parse.faults(table(spark, d, "corpus"))


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    return parse.rates(table(spark, d, "corpus"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    p = overlap.cross_split(table(spark, d, "corpus"), table(spark, d, "samples"), table(spark, d, "jobs"))
    return p.select("scope", F.least("train_id", "eval_id").alias("key_a"), F.greatest("train_id", "eval_id").alias("key_b")).distinct()


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping evaluation records and their pairs, per scope, split and repository."""
    return overlap.counts_per_split(table(spark, d, "corpus"), table(spark, d, "samples"), table(spark, d, "jobs"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.find(table(spark, d, "corpus"), table(spark, d, "samples"))
    return found.select("scope", "row_key", "line_no").distinct()


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    """(scope, row_key, text): the whole texts with their secrets replaced."""
    corpus, samples = table(spark, d, "corpus"), table(spark, d, "samples")
    found = cut(secrets.find(corpus, samples))
    part = lambda scope, rows, key, text: secrets.redact(rows, key, text, found.where(F.col("scope") == scope)).select(F.lit(scope).alias("scope"), "row_key", "text")
    return part("corpus", corpus, "file_id", "content").union(part("samples", samples, "sample_id", "left_context"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return components.tied_groups(table(spark, d, "jobs"), table(spark, d, "file_contexts"))


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    return components.assign_splits(table(spark, d, "jobs"), table(spark, d, "file_contexts"))


#: Samples kept per owner; and the nested caps of p7_nested: per repository, owner and host.
OWNER_CAP, NESTED = 80, [("repository_id", 40), ("owner", 80), ("host", 20_000)]


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    s = caps.samples_by_owner(table(spark, d, "samples"), table(spark, d, "jobs"))
    return caps.nested_caps(s, [("owner", OWNER_CAP)], caps.best_first(), ["sample_id"]).where("dropped_by is not null").select("sample_id")


def p7_nested(spark: SparkSession, d: str) -> DataFrame:
    s = caps.samples_by_owner(table(spark, d, "samples"), table(spark, d, "jobs"))
    return caps.nested_caps(s, NESTED, caps.best_first(), ["sample_id"]).select("sample_id", "dropped_by")


#: The part of all samples that an owner may have at most, for p7_shares.
OWNER_SHARE = 0.02


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Samples beyond a share of all samples per owner: the cap is a part of their number."""
    s = cut(caps.samples_by_owner(table(spark, d, "samples"), table(spark, d, "jobs")))
    cap = caps.cap_from_share(s.count(), OWNER_SHARE)
    return caps.nested_caps(s, [("owner", cap)], caps.best_first(), ["sample_id"]).where("dropped_by is not null").select("sample_id")


def measured(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """documents with their token counts, materialised, as the counts are needed more than once."""
    docs = table(spark, d, "documents")
    return cut(docs.select("doc_id", *columns, tokens.token_count(F.col("text")).alias("n_tokens")))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    packed = binpack.pack(measured(spark, d), "doc_id", F.col("n_tokens"))
    return packed.select(F.col("item").alias("doc_id"), "piece", F.col("start").alias("start_token"), F.col("size").alias("n_tokens"), "container")


def p8_waste(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return binpack.waste(binpack.pack(measured(spark, d), "doc_id", F.col("n_tokens")))


#: The size of the tempered mix, as a part of all distinct tokens of the sources with a target.
MIX_PART = 0.8


def _counted(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("text_key", F.sha2("text", 256))
    return cut(docs.select("doc_id", "source", "text_key", tokens.token_count(F.col("text")).alias("n_tokens")))


def p9_method(spark: SparkSession, d: str) -> DataFrame:
    """A mix of MIX_PART of all distinct tokens of the sources with a target: the exponent is bisected to the repeat limits."""
    return mixing.mix(_counted(spark, d), table(spark, d, "mix_targets"), MIX_PART)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The largest mix in which each source holds its target share exactly, within the repeats."""
    return mixing.mix(_counted(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached by both: mix is exact (p9_mix) or tempered (p9_method)."""
    targets, counted = table(spark, d, "mix_targets"), _counted(spark, d)
    each = lambda name, part: mixing.shares(cut(mixing.mix(counted, targets, part)), targets).select(F.lit(name).alias("mix"), "*")
    return each("exact", None).union(each("tempered", MIX_PART))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents")).select("doc_id", "kind", "start_pos")


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return pii.redact(docs, cut(pii.find(docs)))


QUERIES: dict[str, Q] = {q.__name__: q for q in (p1_found, p1_inherited, p2_method, p2_found, p3_found, p3_faults, p3_rates, p4_found, p4_counts, p5_found, p5_redacted, p6_found, p6_splits, p7_found, p7_nested, p7_shares, p8_containers, p8_waste, p9_method, p9_mix, p9_shares, p10_found, p10_redacted)}

_OWNER = r"nullif(regexp_extract(regexp_replace(lower(full_name), '\s+', '', 'g'), '^/*([^/]+)', 1), '')"

ORACLES: dict[str, str] = {
    "p6_found": rf"""
with recursive ties as (
  select repo_id as node, 'o:' || {_OWNER} as k from jobs where {_OWNER} is not null
  union select repo_id, 'l:' || lower(trim(repo_id)) from jobs
  union select repo_id, 'l:' || lower(trim(grp)) from jobs where grp is not null and lower(trim(grp)) not in ('', 'n/a', 'none', 'unknown', '-')
  union select repository_id, 'l:' || lower(trim(split_group)) from file_contexts where split_group is not null and lower(trim(split_group)) not in ('', 'n/a', 'none', 'unknown', '-')
), edges as (select distinct a.node as a, b.node as b from ties a join ties b on a.k = b.k and a.node <> b.node),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a)
select a as repo_id, least(a, min(b)) as root_repo_id from reach where a <> b group by a""",
    "p4_found": r"""
with j as (select repo_id, min(split) as split from jobs group by 1),
s as (select repo_id, case when split = 'train' then 0 when split in ('validation', 'test') then 1 end as side from j),
f as (select distinct file_id, side, regexp_extract_all(content, '[A-Za-z_][A-Za-z0-9_]*|[0-9]+|[^\sA-Za-z0-9_]') as t from corpus join s on repo_id = repository_id where side is not null and content is not null),
g as (select distinct file_id, side, array_to_string(t[i:i+4], chr(31)) as k from (select file_id, side, t, unnest(range(1, len(t) - 3)) as i from f where len(t) >= 10)),
n as (select file_id, count(*) as n from g group by 1),
p as (select a.file_id as a, b.file_id as b, count(*) as m from g a join g b on a.k = b.k and a.side = 0 and b.side = 1 group by all),
q as (select distinct sample_id, side, regexp_replace(lower(target_text), '[^a-z0-9]+', '', 'g') as t from samples join s on repo_id = repository_id where side is not null and length(target_text) >= 60)
select 'file' as scope, least(a::varchar, b::varchar) as key_a, greatest(a::varchar, b::varchar) as key_b from p join n x on x.file_id = a join n y on y.file_id = b where m >= 0.8 * (x.n + y.n - m)
union select 'sample', least(a.sample_id, b.sample_id), greatest(a.sample_id, b.sample_id) from q a join q b on a.side = 0 and b.side = 1 and abs(length(a.t) - length(b.t)) <= 3 and levenshtein(a.t, b.t) <= 3""",
    "p7_found": rf"""
with j as (select repo_id, min({_OWNER}) as owner, min(priority) as priority from jobs group by 1),
s as (select distinct sample_id, repository_id from samples)
select sample_id from (select sample_id, row_number() over (partition by owner order by priority desc nulls last, sample_id) as r
  from s join j on repo_id = repository_id where owner is not null) where r > {OWNER_CAP}""",
    "p7_shares": rf"""
with j as (select repo_id, min({_OWNER}) as owner, min(priority) as priority from jobs group by 1),
s as (select distinct sample_id, repository_id from samples), c as (select greatest(1, floor(count(*) * {OWNER_SHARE}))::bigint as cap from s)
select sample_id from (select sample_id, row_number() over (partition by owner order by priority desc nulls last, sample_id) as r
  from s join j on repo_id = repository_id where owner is not null), c where r > cap""",
    "p7_nested": rf"""
with j as (select repo_id, min({_OWNER}) as owner, min(priority) as priority from jobs group by 1),
s as (select distinct sample_id, repository_id, owner, priority, regexp_extract(repository_id, '^([^/]+)/', 1) as host from samples join j on repo_id = repository_id),
a as (select *, row_number() over (partition by repository_id order by priority desc nulls last, sample_id) as r1 from s),
b as (select *, row_number() over (partition by owner, r1 <= 40 order by priority desc nulls last, sample_id) as r2 from a),
c as (select *, (owner is null or r2 <= 80) as in2 from b),
e as (select *, row_number() over (partition by host, r1 <= 40 and in2 order by priority desc nulls last, sample_id) as r3 from c)
select sample_id, case when r1 > 40 then 'repository_id' when not in2 then 'owner' when r3 > 20000 then 'host' end as dropped_by from e""",
}
