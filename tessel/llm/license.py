"""The licence of each repository and of each file that states terms of its own.

Texts are normalised: copyright lines, punctuation and case go, doubled words are one, words are brought to the spelling
of the templates' vocabulary (which undoes slips of a letter), and only words of five letters or more stay. The hash of
a template's words is then joined with the hashes of all stretches of the same length; where more slips remain, runs of
five words decide, at 0.8 of the template's runs. Names and tags of licences are looked up under their usual spellings.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import jobs_once

# Usual names by identifier, in the form that name_key gives them.
ALIASES = {
    "MIT": "mit|expat|expat mit|mit expat|mit x 11|x 11",
    "Apache-2.0": "apache 2|asl 2|al 2|apache asl 2|apache|asl|apache asf 2",
    "BSD-2-Clause": "bsd 2 clause|2 clause bsd|simplified bsd|freebsd|bsd 2|bsd simplified",
    "BSD-3-Clause": "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd|bsd 3|bsd new|bsd modified|bsd revised",
    "ISC": "isc|isc l",
    "Zlib": "zlib|zlib libpng",
    "MS-PL": "ms pl|mspl|microsoft public|microsoft ms pl|microsoft pl",
    "Unlicense": "unlicense|unlicence|un",
    "MPL-2.0": "mpl 2|mozilla public 2|mozilla 2|mozilla mpl 2",
    "LGPL-2.1-only": "lgpl 2.1|gnu lgpl 2.1|gnu lesser gpl 2.1|lesser gpl 2.1|gnu lesser general public 2.1|lesser general public 2.1|gnu library general public 2.1",
    "GPL-3.0-only": "gpl 3|gnu gpl 3|gnu general public 3|general public 3",
}
# Words of names that say nothing about which licence it is.
IDLE = {"the", "license", "licence", "version", "v", "software", "only", "terms", "of", "under", "foundation"}


def name_key(name: str) -> str:
    words = []
    for w in re.findall(r"[a-z]+|\d+(?:\.\d+)*", name.lower()):
        if w[0].isdigit():
            w = re.sub(r"(?:\.0)+$", "", w)
        elif len(w) > 3 and w.endswith("v") and w != "rev":
            w = w[:-1]
        if w not in IDLE:
            words.append(w)
    return " ".join(words)


def names(templates: list[tuple[str, str, str]]) -> dict[str, str]:
    """name_key -> identifier, for the licences of the table and their usual names."""
    known = {spdx for spdx, _, _ in templates}
    out = {a: spdx for spdx, al in ALIASES.items() if spdx in known for a in al.split("|")}
    for spdx, title, _ in templates:
        out[name_key(title)] = out[name_key(spdx)] = spdx
    return {k: v for k, v in out.items() if k}


def look_up(text: str, known: dict[str, str]) -> str | None:
    """The licence that a text is the name of."""
    return known.get(name_key(text)) if text else None


THIRD_PARTY = re.compile(r"(?im)^\W*(?:third[- ]part(?:y|ies)|bundled (?:components|software|libraries)|(?:other|external) (?:components|software|libraries)|includes? (?:software|code) (?:from|by))\b[^\n]{0,60}$")
COPYRIGHT = re.compile(r"(?im)^\W*(?:copyright\s*(?:\(c\)|©|\d{4}|by\b)|\(c\)\s|©)[^\n]*$")


class Spelling:
    """Brings words to the spelling of a vocabulary: themselves, or the one word that is one edit away."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        self.vocabulary = {w for _, _, body in templates for w in self.words(body)}
        self.near: dict[str, str] = {}
        for w in sorted(self.vocabulary):
            for i in range(len(w)):
                self.near.setdefault(w[:i] + w[i + 1 :], w)
        self.memo: dict[str, str] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        out: list[str] = []
        for w in re.findall(r"[a-z]+", text.lower().replace("'", "").replace("licence", "license")):
            if not out or out[-1] != w:
                out.append(w)
        return out

    def fix(self, w: str) -> str:
        if w in self.vocabulary:
            return w
        if w not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            one = [w[:i] + w[i + 1 :] for i in range(len(w))]
            swapped = [w[:i] + w[i + 1] + w[i] + w[i + 2 :] for i in range(len(w) - 1)]
            hit = [x for x in [*one, *swapped] if x in self.vocabulary]
            self.memo[w] = self.near.get(w) or (hit[0] if hit else next((self.near[x] for x in one if x in self.near and len(self.near[x]) == len(w)), w))
        return self.memo[w]

    def skeleton(self, text: str) -> list[str]:
        """The words that count: of five letters or more, without a final s, in the vocabulary's spelling."""
        return [s for w in self.words(text) if len(s := self.fix(w).rstrip("s")) >= 5]


def digest(words: list[str]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def stretches(words: list[str], lengths: list[int]) -> set[int]:
    """Hashes of all stretches of the templates' lengths, and of all runs of five."""
    return {digest(words[i : i + n]) for n in [*lengths, 5] for i in range(len(words) - n + 1)}


def template_hashes(templates: list[tuple[str, str, str]], spelling: Spelling) -> list[tuple[str, int, bool, int]]:
    """(spdx, hash, whole, runs): the template's own hash, and those of its runs of five words."""
    rows = []
    for spdx, _, body in templates:
        s = spelling.skeleton(body)
        runs = {digest(s[i : i + 5]) for i in range(len(s) - 4)}
        rows.append((spdx, digest(s), True, len(runs)))
        rows += [(spdx, h, False, len(runs)) for h in sorted(runs)]
    return rows


COMMENTS = re.compile(r'"""(?P<doc>.*?)"""|\'\'\'.*?\'\'\'|@"(?:[^"]|"")*"|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`]*`|/\*(?P<block>.*?)(?:\*/|\Z)|(?P<line>(?://|#)[^\n]*(?:\n[ \t]*(?://|#)[^\n]*)*)', re.S)
HASH_LANGUAGES = ("py", "yml", "yaml", "sh", "rb", "toml")
# Parts of words without which no comment states terms; looked for in lower case before comments are cut out.
SIGNS = ("licen", "spdx", "rights", "terms", "propert", "propriet", "confidential", "evaluation", "subscription", "permission", "permitted", "copying", "copyright", "may not", "must not", "free to", "free for", "redistrib", "use is", "liability", "warrant", "whoever", "may be ", "anyone", "everyone")
TAG = re.compile(r"spdx-licen[sc]e-identifier\s*:\s*([\w.+-]+)", re.I)
NAMED = re.compile(r"(?:\blicen[sc]ed|\bdistributed|\breleased|\bavailable|\bprovided|\bcovered|\bfree to use|\bused|\bpublished|\bmade available|\bsubject|\bshared|\boffered)\s+(?:to\s+)?(?:under|by|to)\s+(?:the\s+terms\s+of\s+)?(?:the\s+)?([A-Za-z][^;\n]{1,70})|\blicen[sc]e\s*:\s*([^\n;]{1,70})", re.I)
HOLDER = re.compile(r"(?:copyright|\(c\)|©)[^.\n]*?\.\s+([^\n]{2,60}?)\.?\s*$", re.I | re.M)
OTHER = re.compile(
    r"\ball rights (?:are )?reserved\b|\bproperty of\b|\bproprietary\b|\bconfidential\b|\b(?:must|may|shall|can) not (?:be )?(?:leave|cop|distribut|redistribut|shar|us|disclos|modif|reproduc|publish)|\b(?:released|licensed|provided|free) for (?:evaluation|study|internal|research|personal|academic|non-?commercial|education)"
    r"|\buse (?:is|of this (?:file|code|source) is) (?:limited|restricted|permitted|granted|subject)|\bcop(?:ying|ies) (?:needs?|requires?)\b|\bnot for (?:trade|sale|commercial|redistribution|production)\b|\b(?:evaluation|internal use|internal purposes) only\b|\bonly for (?:evaluation|internal|study)|\bunder (?:a )?(?:separate|written|commercial) (?:agreement|licen[sc]e)"
    r"|\b(?:requires?|needs?) (?:a |prior |the )*(?:written|signed|paid|commercial) (?:permission|consent|letter|licen[sc]e|agreement)|\b(?:community|source|enterprise|partner) (?:terms|licen[sc]e) v?\d",
    re.I,
)
POINTER = re.compile(r"(?i)see (?:the )?licen[sc]e|licen[sc]e details|project's licen[sc]e")


def comment_blocks(text: str, ext: str) -> Iterator[str]:
    """Comments as plain text: consecutive line comments are one."""
    for m in COMMENTS.finditer(text):
        line, block, doc = m.group("line"), m.group("block"), m.group("doc")
        if line is not None:
            if line[0] == "#" and ext not in HASH_LANGUAGES:
                line = "\n".join(x for x in line.split("\n") if x.lstrip().startswith("//"))
            yield re.sub(r"(?m)^[ \t]*(?://+!?|#+)[ \t]?", "", line)
        elif block is not None:
            yield re.sub(r"(?m)^[ \t]*\*+[ \t]?", "", block)
        elif doc is not None and ext == "py":
            yield doc


def stated(block: str, known: dict[str, str]) -> str | None:
    """What a comment states by tag, name or reservation: an identifier, UNKNOWN, or nothing."""
    if m := TAG.search(block):
        return look_up(m.group(1), known) or "UNKNOWN"
    for m in NAMED.finditer(block):
        name = m.group(1) or m.group(2)
        name = re.split(r"\s+only\b|\.\s|\.$|\s+See\b|,\s+see\b|\s+\(", name.strip(), maxsplit=1)[0].strip(" .*-")
        hit = look_up(name, known)
        if hit:
            return hit
        words = name.split()
        for n in range(len(words) - 1, 0, -1):
            if (hit := look_up(" ".join(words[:n]), known)) and re.match(r"(?i)licen[sc]e|only|v?\d", words[n - 1]):
                return hit
        if re.search(r"(?i)\blicen[sc]e\b|\bterms\b|\bagreement\b|\bEULA\b|public|commons", name) and not POINTER.search(name) and not re.match(r"(?i)(?:same )?(?:licen[sc]e|terms)\b", name):
            return "UNKNOWN"
        if m.group(2) is not None and not POINTER.search(name):
            return "UNKNOWN"
    for m in HOLDER.finditer(block):
        if hit := look_up(m.group(1), known):
            return hit
    return "UNKNOWN" if OTHER.search(block) else None


def repositories(jobs: DataFrame, license_info: DataFrame, license_texts: DataFrame) -> DataFrame:
    """(repo_id, verdict) for every repo_id of jobs or license_info; see ``files`` for the parts."""
    templates, spelling, hashes, known = _prepared(license_texts)
    lengths = sorted({len(spelling.skeleton(b)) for _, _, b in templates})

    own_terms = _own_terms(spelling, lengths)

    @F.pandas_udf("string")
    def named(license: pd.Series) -> pd.Series:
        return pd.Series([look_up(x, known) if x else None for x in license], dtype=object)

    texts = license_info.where("repo_id is not null").select(F.col("repo_id").alias("key"), F.explode(own_terms("license_text")).alias("hash"))
    worded = _matched(texts, hashes)
    j = jobs_once(jobs.select("repo_id", "license", "attempts", "started", "finished")).select(F.col("repo_id").alias("key"), named("license").alias("spdx")).where("spdx is not null")
    both = worded.union(j).groupBy("key").agg(F.collect_set("spdx").alias("s"))
    everyone = jobs.select("repo_id").union(license_info.select("repo_id")).where("repo_id is not null").distinct()
    verdict = F.when(F.col("s").isNull(), "UNKNOWN").when(F.size("s") == 1, F.col("s")[0]).otherwise("CONFLICT")
    return everyone.join(both.withColumnRenamed("key", "repo_id"), "repo_id", "left").select("repo_id", verdict.alias("verdict"))


def _own_terms(spelling: Spelling, lengths: list[int]):
    @F.pandas_udf("array<bigint>")
    def own_terms(text: pd.Series) -> pd.Series:
        """The hashes of a licence file's own wording, without copyright lines and notices of third parties."""
        out = []
        for t in text:
            t = COPYRIGHT.sub("", re.split(THIRD_PARTY, t, maxsplit=1)[0]) if t else ""
            out.append(sorted(stretches(spelling.skeleton(t), lengths)))
        return pd.Series(out, dtype=object)

    return own_terms


def _prepared(license_texts: DataFrame):
    templates = [(r[0], r[1] or "", r[2] or "") for r in license_texts.where("spdx is not null").select("spdx", "title", "body").orderBy("spdx").collect()]
    spelling = Spelling(templates)
    rows = template_hashes(templates, spelling)
    hashes = license_texts.sparkSession.createDataFrame(rows or [], "spdx string, hash bigint, whole boolean, runs int")
    return templates, spelling, F.broadcast(hashes), names(templates)


def _matched(pairs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(key, spdx): keys with the whole hash of a template, else with 0.8 of its runs of five (the best such template)."""
    hit = pairs.distinct().join(hashes, "hash").groupBy("key", "spdx").agg(F.max("whole").alias("whole"), (F.count(F.when(~F.col("whole"), 1)) / F.max("runs")).alias("share"), F.max("runs").alias("runs"))
    good = hit.where("whole or share >= 0.8")
    # of templates that contain one another the longest that holds wholly stands
    return good.groupBy("key").agg(F.max(F.struct("whole", F.round("share", 6).alias("share"), "runs", "spdx")).alias("b")).select("key", "b.spdx")


def files(corpus: DataFrame, license_texts: DataFrame) -> DataFrame:
    """(file_id, repository_id, stated): files with a comment that states terms, and the licence or UNKNOWN.

    A licence tag or name comes before wording, wording before other terms. Null contents state nothing.
    """
    templates, spelling, hashes, known = _prepared(license_texts)
    lengths = sorted({len(spelling.skeleton(b)) for _, _, b in templates})
    # a comment with 0.8 of a template's runs of five words has so many letters at least
    shortest = min((5 * int(0.8 * (n - 4) + 4) for n in lengths), default=0)
    schema = pa.schema([("file_id", pa.int64()), ("repository_id", pa.string()), ("said", pa.string()), ("hashes", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict[str, list] = defaultdict(list)
            for i, repo, path, text in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                low = text.lower()
                if not any(s in low for s in SIGNS):
                    continue
                said, found = None, set()
                for block in comment_blocks(text, (path or "").rpartition(".")[2].lower()):
                    low = block.lower()
                    if not any(s in low for s in SIGNS):
                        continue
                    one = stated(block, known)
                    said = one if one and (said in (None, "UNKNOWN")) else said
                    if len(block) >= shortest:
                        found |= stretches(spelling.skeleton(COPYRIGHT.sub("", block)), lengths)
                if said or found:
                    for k, v in (("file_id", i), ("repository_id", repo), ("said", said), ("hashes", sorted(found))):
                        rows[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    raw = corpus.where("file_id is not null and content is not null").select("file_id", "repository_id", "relative_path", "content")
    seen = raw.mapInArrow(read, "file_id bigint, repository_id string, said string, hashes array<bigint>")
    # files, their statements and the hashes of their comments as rows of one kind: the scan is read once
    facts = seen.select("file_id", "repository_id", "said", F.explode_outer("hashes").alias("hash"))
    joined = facts.join(hashes, "hash", "left").where("said is not null or spdx is not null")
    per = joined.groupBy("file_id", "repository_id", "spdx").agg(F.max("said").alias("said"), F.max("whole").alias("whole"), F.count_distinct(F.when(~F.col("whole"), F.col("hash"))).alias("n"), F.max("runs").alias("runs"))
    good = F.when(F.col("whole") | (F.col("n") >= 0.8 * F.col("runs")), F.struct("whole", (F.col("n") / F.col("runs")).alias("share"), "runs", "spdx"))
    one = per.groupBy("file_id", "repository_id").agg(F.max("said").alias("said"), F.max(good)["spdx"].alias("worded"))
    by = F.when(F.col("said").isNotNull() & (F.col("said") != "UNKNOWN"), F.col("said")).otherwise(F.coalesce("worded", "said"))
    return one.select("file_id", "repository_id", by.alias("stated")).where("stated is not null").distinct()


def verdicts(corpus: DataFrame, jobs: DataFrame, license_info: DataFrame, license_texts: DataFrame) -> DataFrame:
    """(scope, subject, verdict): repositories, and files that state terms, with conflicts and unknowns marked."""
    repos = repositories(jobs, license_info, license_texts)
    f = files(corpus, license_texts).join(repos.withColumnRenamed("repo_id", "repository_id"), "repository_id", "left")
    against = ~F.col("verdict").isin("CONFLICT", "UNKNOWN") & (F.col("verdict") != F.col("stated")) & (F.col("stated") != "UNKNOWN")
    own = F.when(F.coalesce(against, F.lit(False)), "CONFLICT").otherwise(F.col("stated"))
    return repos.select(F.lit("repository").alias("scope"), F.col("repo_id").alias("subject"), "verdict").union(f.select(F.lit("file"), F.col("file_id").cast("string"), own)).distinct()


#: Names of licence files: plain text, so nothing that code is kept in.
LICENSE_FILE = r"^(?:un)?(?:licen[sc]e|copying|notice)s?(?:[-_.](?:md|txt|rst|text|mit|apache|bsd|gpl|lgpl|mpl))*$"


def license_files(corpus: DataFrame, license_texts: DataFrame) -> DataFrame:
    """(repository_id, dir, dir_stated) of directories with licence files: the licence whose wording they carry as their own
    terms, CONFLICT where two files carry different ones, UNKNOWN where none is of the templates. Blank files state nothing."""
    templates, spelling, hashes, _ = _prepared(license_texts)
    lengths = sorted({len(spelling.skeleton(b)) for _, _, b in templates})
    named = F.lower(F.regexp_extract("relative_path", r"([^/]*)$", 1)).rlike(LICENSE_FILE)
    f = corpus.where(named & F.col("file_id").isNotNull() & (F.trim("content") != "")).select(F.col("file_id").alias("key"), "repository_id", F.regexp_extract("relative_path", r"^(.*?)/?[^/]*$", 1).alias("dir"), "content")
    worded = _matched(f.select("key", F.explode(_own_terms(spelling, lengths)("content")).alias("hash")), hashes)
    per = f.select("key", "repository_id", "dir").distinct().join(worded, "key", "left").groupBy("repository_id", "dir").agg(F.collect_set("spdx").alias("s"))
    return per.select("repository_id", "dir", F.when(F.size("s") == 0, "UNKNOWN").when(F.size("s") == 1, F.col("s")[0]).otherwise("CONFLICT").alias("dir_stated"))


def inherited(corpus: DataFrame, jobs: DataFrame, license_info: DataFrame, license_texts: DataFrame) -> DataFrame:
    """(file_id, verdict, from): the licence of every file: its own statement, else that of the licence files of the nearest
    directory upwards that has any, else the repository's; misses are UNKNOWN. The files of a repository without an entry
    are UNKNOWN too; null paths are taken as in the root."""
    own = files(corpus, license_texts)
    place = corpus.where("file_id is not null").select("file_id", "repository_id", F.coalesce("relative_path", F.lit("")).alias("path")).distinct()
    dirs = license_files(corpus, license_texts)
    up = F.transform(F.sequence(F.lit(0), F.size(F.split("path", "/")) - 1), lambda n: F.array_join(F.slice(F.split("path", "/"), 1, n), "/"))
    nearest = place.select("file_id", "repository_id", F.explode(F.array_distinct(up)).alias("dir")).join(dirs, ["repository_id", "dir"]).groupBy("file_id").agg(F.max_by("dir_stated", F.length("dir")).alias("dir_stated"))
    repos = repositories(jobs, license_info, license_texts).withColumnRenamed("repo_id", "repository_id")
    all_ = place.select("file_id", "repository_id").distinct().join(own.select("file_id", "stated"), "file_id", "left").join(nearest, "file_id", "left").join(repos, "repository_id", "left")
    origin = F.when(F.col("stated").isNotNull(), "file").when(F.col("dir_stated").isNotNull(), "directory").otherwise("repository")
    return all_.select("file_id", F.coalesce("stated", "dir_stated", "verdict", F.lit("UNKNOWN")).alias("verdict"), origin.alias("from"))
