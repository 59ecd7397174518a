"""Generated, minified, vendored and data files among source files.

``recurring`` is winnowing: fingerprints of normalised token streams that recur across unrelated owners. ``origin`` reads
what single files say and how they are built: configured path patterns, origin notes in the comments before the code, and
the shape of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import cut, owner
from tessel.llm.overlap import TOKEN, Digests, run_digests, token_digests
from tessel.llm.parse import extension

#: Extensions of code; tables and settings in other files are no data in disguise.
CODE = ("cs", "go", "js", "mjs", "jsx", "ts", "tsx", "py", "java", "c", "h", "cc", "cpp", "rs", "rb", "php")

# Notes of tools and of copied sources, as they stand in comments before the code.
GENERATED_NOTE = re.compile(
    r"<auto-?generated|@generated\b|\bcode generated\b.*\bdo not edit\b|\bauto-?generated\b(?=\W*(?:by|from|with|using|on|file|code|source|content|-|\.|$))|\bAUTOGENERATED\b"
    r"|\b(?:file|code|class|module|source)\b.{0,40}\b(?:was|is|has been|were)\b.{0,20}\b(?:generated|produced|emitted|created) (?:by|from|with)\b|\bemitted by\b|\bmachine[- ](?:output|generated|made|written)\b"
    r"|\bregenerate (?:with|using|by)\b|\bgenerated (?:by|from) (?:the )?[\w.-]+ v?\d|\b(?:changes|edits)\b.{0,40}\b(?:are|will be) (?:lost|overwritten)\b|\bdo not edit\b.{0,40}\bgenerat",
    re.I,
)
VENDORED_NOTE = re.compile(
    r"\bvendored (?:from|copy|at|in)\b|^\W*upstream:|\b(?:bundled|verbatim|unmodified|unchanged) copy\b|\bcopied (?:verbatim |unchanged |unmodified )?from\b|\bimported third[- ]party\b|\bthird[- ]party (?:source|code)\b.*\d"
    r"|\btaken from (?:package|project|library|the) [\w.@/-]+ v?\d|\bnot our code\b|\breport bugs upstream\b|\bupstream (?:lives|is|source|version|commit)\b|\bkeep in sync with upstream\b",
    re.I | re.M,
)
NO_CASE = re.compile(r"\b(?:wrapped|replaced|removed|not bundled|never reused|goes to|belongs)\b", re.I)
LEADING = re.compile(r"(?:\s+|//[^\n]*|/\*.*?(?:\*/|\Z)|#(?!\s*(?:if|elif|else|endif|define|region|endregion|nullable|include)\b)[^\n]*|#(?:nullable|pragma|region)[^\n]*|<!--.*?-->|\"\"\".*?\"\"\"(?=\s))*", re.S)
STRINGS = re.compile(r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`]*`')
LITERALS = re.compile(r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`]*`|\b(?:0x[0-9A-Fa-f_]+|\d[\d_]*(?:\.\d+)?)\w?\b')


STATEMENT = re.compile(r"\b(?:if|for|foreach|while|return|switch|def|func|function|try|await|throw|raise)\b")
COUNTER = re.compile(r"[A-Za-z_](\d+)(?![\d.])(?=\W)")


def glob_regex(pattern: str) -> str:
    """A path glob as a regular expression: **/ any folders, * within a segment, ? one character; case matters not."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        elif pattern[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif pattern[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(pattern[i]), i + 1
    return f"(?i)^{out}$"


def by_path(path: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The kind of the first configured pattern (by kind, then pattern) that the path matches, else null."""
    kind = F.lit(None).cast("string")
    for k, p in sorted(patterns, reverse=True):
        kind = F.when(path.rlike(glob_regex(p)), k).otherwise(kind)
    return kind


def head(text: str) -> str:
    """The comments before the code."""
    return LEADING.match(text.lstrip("﻿")).group()


def is_table(text: str) -> bool:
    """Whether the file is a delimited table: rows of the same number of fields, and no line that ends as code does."""
    lines = [x for x in text.splitlines() if x.strip()]
    if len(lines) >= 3:
        for sep in (",", "\t", ";", "|"):
            n = [x.count(sep) for x in lines]
            if n[0] >= 2 and sum(k == n[0] for k in n) >= 0.95 * len(n) and not any(x.rstrip().endswith(("{", "}", ";", ")", ":")) for x in lines[:50] if sep != ";"):
                return True
    return False


def is_data(text: str) -> bool:
    """Whether literals make up the file: arrays and maps of literals without statements."""
    body = re.sub(r"(?m)^\s*(?://|#).*$", "", text)
    size = len(re.sub(r"\s", "", body))
    if size < 200:
        return False
    literal = sum(len(m) for m in LITERALS.findall(body))
    return literal >= 0.6 * size and not STATEMENT.search(STRINGS.sub("", body))


def is_listed(text: str) -> bool:
    """Whether most lines are of one form and count up by one, as tools list members and descriptors."""
    lines = [x for x in text.splitlines() if x.strip()]
    counts = [int(m.group(1)) if (m := COUNTER.search(x)) else None for x in lines]
    steps = sum(a is not None and b is not None and b == a + 1 for a, b in zip(counts, counts[1:], strict=False))
    return steps >= 4 and steps >= 0.6 * (len(lines) - 1)


def is_minified(text: str) -> bool:
    """Whether white space outside of literals is squeezed out: dense long lines."""
    bare = STRINGS.sub('""', text)
    lines = bare.splitlines() or [""]
    blanks = sum(map(bare.count, " \t\n\r"))
    return max(map(len, lines)) > 200 and blanks < 0.07 * len(bare) and len(bare) > 300


def kind_of(ext: str, text: str) -> str | None:
    top = "\n".join(x for x in head(text).splitlines() if not NO_CASE.search(x))
    if top and VENDORED_NOTE.search(top):
        return "vendored"
    if top and GENERATED_NOTE.search(top):
        return "generated"
    if ext in ("js", "mjs", "jsx", "ts") and is_minified(text):
        return "minified"
    if is_table(text):
        return "data"
    if is_listed(text):
        return "generated"
    return "data" if is_data(text) else None


def origin(corpus: DataFrame, path_patterns: DataFrame) -> DataFrame:
    """(file_id, kind) of files nobody wrote by hand for their repository: one kind per file, configured paths first.

    kind is generated, minified, vendored or data. A null content is judged by its path alone; a null path by its text
    as C#. Files of non-code extensions are judged by path and notes. Repeated rows give one row. The patterns are a small
    configuration table, read by the driver.
    """
    patterns = [(r[0], r[1]) for r in path_patterns.where("kind is not null and pattern is not null").select("kind", "pattern").distinct().collect()]
    named = corpus.where("file_id is not null").select("file_id", by_path(F.coalesce("relative_path", F.lit("")), patterns).alias("kind"), extension(F.coalesce("relative_path", F.lit("x.cs"))).alias("ext"), "content")

    @F.pandas_udf("string")
    def judged(ext: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([kind_of(e, t) if t and e in CODE else None for e, t in zip(ext, text, strict=True)], dtype=object)

    rest = F.when(F.col("kind").isNull(), F.col("content"))
    return named.select("file_id", F.coalesce("kind", judged("ext", rest)).alias("kind")).where("kind is not null").groupBy("file_id").agg(F.min("kind").alias("kind"))


#: Winnowing: tokens per gram, and grams per window, of which the least hash is kept.
GRAM, WINDOW = 12, 24


def winnow(toks: np.ndarray) -> np.ndarray:
    """The distinct fingerprints of a sequence of token digests: digests of grams, the least of each window."""
    h = run_digests(toks, GRAM)
    if len(h) > WINDOW:
        h = np.lib.stride_tricks.sliding_window_view(h, WINDOW).min(axis=1)
    return np.unique(h).view(np.int64)


COMMENT = re.compile(r"//[^\n]*|/\*.*?\*/|(?m:^\s*#[^\n]*)", re.S)


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, owner, text) -> (file_id, owner, prints): comments and layout are left out, numbers are all one."""
    digests = Digests()
    schema = pa.schema([("file_id", pa.int64()), ("owner", pa.string()), ("prints", pa.list_(pa.int64()))])
    for b in batches:
        ids, owners, texts = (b.column(k).to_pylist() for k in range(3))
        prints = []
        for t in texts:
            tokens = TOKEN.findall(COMMENT.sub(" ", t))
            prints.append(winnow(token_digests(["0" if x[0].isdigit() else x for x in tokens], digests)))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(owners, pa.string()), pa.array(prints, schema.field(2).type)], schema=schema)


def recurring(corpus: DataFrame, owners_needed: int = 3, part: float = 0.5) -> DataFrame:
    """(file_id, prints, recurring, share): files whose fingerprints recur in files of ``owners_needed`` or more unrelated
    owners, for at least ``part`` of them.

    The owner is the second segment of repository_id, so forks and siblings of one owner count once. Counts of owners per
    fingerprint are aggregated and materialised before they are joined back, one row per fingerprint, so a fingerprint in a
    third of all files is a skewed side that adaptive execution splits. Null contents and files below 12 tokens have no fingerprints.
    """
    files = corpus.where("file_id is not null and content is not null").select("file_id", owner(F.regexp_replace("repository_id", "^[^/]*/", "")).alias("owner"), "content")
    each = files.mapInArrow(fingerprints, "file_id bigint, owner string, prints array<bigint>").select("file_id", "owner", F.explode("prints").alias("print"))
    owners = cut(each.select("print", "owner").distinct().groupBy("print").count().where(F.col("count") >= owners_needed).select("print", F.lit(1).alias("known")))
    per = each.join(owners, "print", "left").groupBy("file_id").agg(F.count_distinct("print").alias("prints"), F.count_distinct(F.when(F.col("known") == 1, F.col("print"))).alias("recurring"))
    return per.withColumn("share", F.col("recurring") / F.col("prints")).where(F.col("share") >= part)
