"""Credentials in source code and configuration.

Literals that stand where a credential is assigned, passed, sent or noted, that have the form of a known key, or that are
the body of a private key are segmented into dictionary words by Viterbi; what stays unexplained decides. The dictionary
holds the words of the corpus itself, counted once per distinct content and without the literals under test; it stays a
distributed table, and the distinct segments of the literals meet its words in an equi-join on their first four letters.
Placeholders, references, names, public keys, digests, GUIDs and revision hashes are excluded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.llm.common import cut

#: The dictionary: words of at least four letters in at least so many distinct contents, and in one of so many.
WORD_FILES, ONE_IN = 3, 2_500
#: Unexplained characters that make a value a secret.
RESIDUE = 6

# Parts of names that hold credentials, and of names that hold something about them.
KEY = re.compile(r"pass(?:word|wd|phrase|code)?(?![a-z])|(?:password|passwd)|pwd|secret|token|credential|api[_-]?key|access[_-]?key|(?:billing|maps|private|signing|encryption|service|account|storage|master|license|auth|client|shared|session)[_-]?key|(?<![a-z])key(?![a-z])|(?<=[a-z])Key(?:Id)?(?![a-z])|[a-z]key(?=\d*$|_)|(?<![a-z])auth(?:orization|token)?(?![a-z])|bearer|(?<![a-z])(?:dsn|pat|jwt)(?![a-z])", re.I)
ABOUT = re.compile(r"(?:file|path|name|header|hash|digest|sha\d*|checksum|commit|revision|fingerprint|integrity|etag|public|url|uri|endpoint|prefix|suffix|label|length|count|ttl|expiry|type|field|column|regex|pattern|param)s?(?:[_\d-]*)$|^(?:hash|sha\d*|commit|revision|public|digest|integrity|checksum)(?![a-z])|ed25519_pub|(?:^|[_-])(?:hash|digest|sha|commit|revision|public)(?:[_-]|$)", re.I)
PLACEHOLDER = re.compile(r"^[<\[{$%@#]|\$\{|\{\{|\}\}|<[^>]*>|x{4,}|\*{3,}|\.{3}|(?:change[-_ ]?me|your[-_ ]|example|insert|placeholder|dummy|redacted|replace|todo|secret[-_]?here|not[-_ ]?set|undefined|null|none)|^(?:vault|env|secret|arn|file|ref|kms|ssm|keyvault)[:(/]|^https?://[^:@]*$|^(.)\1*$", re.I)
GUID = re.compile(r"\{?[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}\}?", re.I)
DIGEST = re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-:=]", re.I)
KNOWN = r"AKIA[0-9A-Z]{6,16}|gh[pousr]_[A-Za-z0-9]{8,}|glpat-[\w-]{8,}|xox[abprs]-[\w-]{8,}|AIza[\w-]{6,}|[sr]k_(?:live|test)_[A-Za-z0-9]{6,}|eyJ[\w-]{10,}\.eyJ[\w-]*(?:\.[\w-]*)?|eyJ[\w-]{16,}"
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----(?:\\r|\\n|\s|[\"'+,\\])*(?=[A-Za-z0-9+/=]{16})(?:[A-Za-z0-9+/=:, \r\n\"'+\\.-](?!----END))*(?:.?-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----)?")
JOINED = r"(?:[\"'`][ \t]*(?:\+|\\|\.)?[ \t]*\\?\r?\n[ \t]*(?:\+[ \t]*)?[\"'`]([^\"'`\n]*))?"
ASSIGNED = re.compile(r"(?<![\w.-])([A-Za-z_][\w.-]*+)[\"'`]?\]?\s*(?::=|=>|[=:])\s*[@$frbu]{0,2}([\"'`])([^\"'`\n]{6,}|[^\"'`\n]{3,}(?=[\"'`][ \t]*[+\\]))" + JOINED)
BARE = re.compile(r"^[ \t-]*([A-Za-z_][\w.-]*)[ \t]*[:=][ \t]+([^\s\"'#&*!|>{\[][^\s#]{6,})[ \t]*(?:#.*)?\r?$", re.M)
PART = re.compile(r"(?<![\w])([A-Za-z_]*(?:password|passwd|pwd|secret|token|key|signature|sig))=([^\s;\"'`&,)]{6,})", re.I)
URL = re.compile(r"\b[a-z][a-z0-9+.-]*://([^\s:/@\"'`]*):([^\s\"'`/@]{4,}(?:@[^\s\"'`/@]+)*)@(?=[\w.-]+)", re.I)
HEADER = re.compile(r"\b(bearer|basic)[ \t]+([A-Za-z0-9+/_=.!?#$*~-]{8,})", re.I)
NOTED = re.compile(r"(?<![A-Za-z_])(?=[A-Za-z_])([A-Za-z_]*(?:password|passwd|passphrase|secret|token|key|keyid|credential|pwd))(?:[ \t]+(?:is|was|=))?[ \t:]+[\"'`]?(?=([^\s\"'`,;)]{8,}))", re.I)
CALLED = re.compile(r"(?:credentials?|log_?in|auth(?:enticate|orize)?|sign_?in|connect|logon|set_?password)\w*\(\s*(?:[\w.]+\s*,\s*)?[@$]?([\"'])[^\"'\n]*\1\s*,\s*[@$]?([\"'])([^\"'\n]{6,})\2", re.I)
BY_FORM = re.compile(rf"(?<![\w/+-])({KNOWN})")
# Without one of these, in lower case, a text can't hold a credential.
SIGNS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login", "://", "private", "akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "glpat-", "xox", "aiza", "sk_live", "sk_test", "rk_live", "rk_test", "eyj", "dsn", "basic", "sig", "connect", "log_in", "logon", "pat", "jwt")


def words_of(text: str) -> set[str]:
    return {w.lower() for w in re.findall(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}(?![a-z])", text) if len(w) > 3}


def own_words(text: str, config: bool) -> set[str]:
    """The words of a text outside the literals that are under test as credentials: these must not explain themselves."""
    at, parts = 0, []
    spans = [m.span() for m in PEM.finditer(text)] if "PRIVATE KEY" in text else []
    for _, start, end, more in candidates(text, config):
        spans += [(start, end), more] if more else [(start, end)]
    for a, z in sorted(spans):
        parts.append(text[at:a])
        at = max(at, z)
    return words_of(" ".join([*parts, text[at:]]))


def content_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, config, content) -> (hash, words): once per content within the task."""
    schema = pa.schema([("hash", pa.int64()), ("words", pa.string())])
    seen: set[int] = set()
    for b in batches:
        rows = []
        for h, c, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if h not in seen:
                seen.add(h)
                rows.append((h, " ".join(sorted(own_words(t, c)))))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, words), all rows of a hash in one task -> (word, files), each content counted once and added up within the
    task, given out when many. The number of contents comes as the word ''."""
    schema = pa.schema([("word", pa.string()), ("files", pa.int64())])
    total: Counter = Counter()
    seen: set[int] = set()
    for b in batches:
        for h, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if h not in seen:
                seen.add(h)
                total.update(w.split())
                total[""] += 1
        if len(total) > 400_000:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], schema=schema)
            total.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], schema=schema)


def is_config() -> Column:
    return F.lower(F.coalesce("relative_path", F.lit(""))).rlike(r"\.(ya?ml|toml|ini|env|cfg|conf|properties)$").alias("config")


def dictionary(corpus: DataFrame, files: int = WORD_FILES, one_in: int = ONE_IN) -> DataFrame:
    """(word): the words of the corpus that are in ``files`` distinct contents or more, and in one of ``one_in`` of them."""
    each = corpus.where("content is not null").select(F.xxhash64("content").alias("hash"), is_config(), "content").mapInArrow(content_words, "hash bigint, words string")
    counts = cut(each.repartition("hash").mapInArrow(count_words, "word string, files bigint").groupBy("word").agg(F.sum("files").alias("files")))
    contents = counts.where("word = ''").agg(F.coalesce(F.max("files"), F.lit(0)).alias("contents"))
    return counts.where((F.col("word") != "") & (F.col("files") >= files)).crossJoin(F.broadcast(contents)).where(F.col("files") >= F.ceil(F.col("contents") / one_in)).select("word")  # one row on the right


def viterbi(n: int, words: Iterable[tuple[int, int]]) -> int:
    """The characters of a segment of n that the best segmentation leaves over; words: the (start, end) of all dictionary
    words in it. A word costs half a character, so that few long words beat many short ones."""
    ending: dict[int, list[int]] = {}
    for a, b in words:
        ending.setdefault(b, []).append(a)
    best = [0.0] * (n + 1)
    left = [0] * (n + 1)
    for i in range(1, n + 1):
        best[i], left[i] = best[i - 1] + 1, left[i - 1] + 1
        for a in sorted(ending.get(i, ()), reverse=True):
            if best[a] + 0.5 < best[i]:
                best[i], left[i] = best[a] + 0.5, left[a]
    return left[n]


def segments(value: str) -> list[str]:
    """The parts of a value that are segmented; short numbers explain themselves."""
    return [x for x in re.split(r"[^A-Za-z0-9]+", value) if x and not (x.isdigit() and len(x) <= 6)]


def shape(value: str, key: str) -> str | None:
    """What a value that stands under a credential's name is to be judged as: known (form of a key), hex, text, or nothing."""
    v = value.strip()
    if key == "private key":
        return "known"
    if len(v) < 8 or PLACEHOLDER.search(v) or GUID.fullmatch(v) or DIGEST.match(v) or "-----BEGIN" in v:
        return None
    if re.fullmatch(rf"(?:{KNOWN})", v) and not re.search(r"(.)\1{5,}", v):
        return "known"
    if " " in v or "/" in v and re.match(r"\.{0,2}/|[A-Za-z]:\\|~/", v) or re.fullmatch(r"[A-Za-z_]\w*(?:[.:][A-Za-z_]\w*)+|[A-Z]+(?:_[A-Z]+)+|[\w.]+\(.*\)?;?", v):
        return None
    if re.fullmatch(r"[0-9a-fA-F]{16,}", v):
        return "hex" if len(set(v)) > 4 and not ABOUT.search(key) else None
    if re.fullmatch("[A-Za-z_]+", v) and KEY.search(v):  # the name of a credential
        return None
    return None if re.fullmatch(r"[A-Z][a-z]*(?:-[A-Z][a-z]*)+", v) or re.fullmatch(r"\d+", v) else "text"


def is_secret(value: str, kind: str, left: Sequence[int]) -> bool:
    """Whether so many unexplained characters of its segments make a value a live-looking secret."""
    v, xs = value.strip(), segments(value)
    if kind != "text":
        return sum(left) >= RESIDUE
    rest = plain = 0
    for x, r in zip(xs, left, strict=True):
        if r and re.fullmatch("[a-z]{4,}", x):  # one unknown word is a word
            plain += 1
            rest += r if plain > 1 else 0
        else:
            rest += r
    if plain > 1:
        rest += max(map(len, xs))
    mixed = len(re.findall(r"[0-9A-Z]", v)) > 0 or plain > 2
    return mixed and rest + len(re.findall(r"[^A-Za-z0-9\s_-]", v)) >= RESIDUE


def hot_lines(text: str) -> list[tuple[int, int, int]]:
    """(start, end, end of the next line) of the lines that bear a sign of a credential, in order."""
    low = text.lower()
    if len(low) != len(text):  # a few letters change their length; then every line is looked at
        low = text
        starts = {m.start() for m in re.finditer("(?m)^", text)}
    else:
        starts = set()
        for sign in SIGNS:
            at = low.find(sign)
            while at >= 0:
                starts.add(low.rfind("\n", 0, at) + 1)
                end = low.find("\n", at)
                at = low.find(sign, end) if end >= 0 else -1
    out = []
    for a in sorted(starts):
        end = text.find("\n", a)
        end = len(text) if end < 0 else end
        after = text.find("\n", end + 1)
        out.append((a, end, len(text) if after < 0 else after))
    return out


def candidates(text: str, config: bool) -> Iterator[tuple[str, int, int, tuple[int, int] | None]]:
    """(key, start, end, span of the rest on the next line) of the literals that stand where a credential does;
    ``config``: bare values after a colon count too."""
    for a, end, after in hot_lines(text):
        line = text[a:end]
        quoted = '"' in line or "'" in line or "`" in line
        url, note = "://" in line, re.search(r"//|#|/\*|^\s*\*|--", line)
        if not (quoted or url or note or config):
            continue
        if quoted:
            piece = text[a:after]
            for m in ASSIGNED.finditer(piece):
                if a + m.start() >= end:
                    break
                key, value = m.group(1), m.group(3)
                if KEY.search(key) and not ABOUT.search(key) and not URL.search(value) and not re.match(r"(?i)bearer |basic ", value) and not PART.search(value):
                    yield key, a + m.start(3), a + m.end(3), (a + m.start(4), a + m.end(4)) if m.group(4) else None
            if "(" in line:
                for m in CALLED.finditer(line):
                    yield "password", a + m.start(3), a + m.end(3), None
        if config:
            for m in BARE.finditer(line):
                if KEY.search(m.group(1)) and not ABOUT.search(m.group(1)) and not URL.search(m.group(2)):
                    yield m.group(1), a + m.start(2), a + m.end(2), None
        if url:
            for m in URL.finditer(line):
                yield "password", a + m.start(2), a + m.end(2), None
        if "=" in line:
            for m in PART.finditer(line):
                yield m.group(1), a + m.start(2), a + m.end(2), None
        for m in HEADER.finditer(line):
            yield "bearer", a + m.start(2), a + m.end(2), None
        for m in BY_FORM.finditer(line):
            if not re.search(r"(?i)x{4,}|(.)\1{5,}", m.group(1)):
                yield "token", a + m.start(1), a + m.end(1), None
        if note:
            for m in NOTED.finditer(line, note.start()):
                yield m.group(1), a + m.start(2), a + m.end(2), None


def asked(text: str, config: bool) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, value, shape) of the literals of a text that segmentation decides about."""
    for m in PEM.finditer(text) if "PRIVATE KEY" in text else ():
        yield m.start(), m.end(), re.sub(r"-----(?:BEGIN|END)[^-]*-----", " ", m.group()), "known"
    for key, start, end, more in candidates(text, config):
        value = text[start:end] + (text[more[0] : more[1]] if more else "")
        if kind := shape(value, key):
            yield start, end, value, kind


def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, config, text) -> (row_key, line_no, start, end, value, shape, segments) in Arrow batches."""
    schema = pa.schema([("row_key", pa.string()), ("line_no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("shape", pa.string()), ("segments", pa.list_(pa.string()))])
    for b in batches:
        rows = [(k, t.count("\n", 0, a) + 1, a, z, v, s, segments(v)) for k, c, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) for a, z, v, s in dict.fromkeys(asked(t, c))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 7, schema, strict=True)], schema=schema)


def left_over(distinct: DataFrame, words: DataFrame) -> DataFrame:
    """(segment, rest): for distinct segments, the characters that dictionary words don't explain.

    Each position of a segment looks for the words that start with its four letters, in an equi-join; the words found
    are checked and collected per segment, at most as many as the segment has places for them.
    """

    @F.pandas_udf("int")
    def rest(n: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([viterbi(k, [(x["a"], x["b"]) for x in f] if f is not None else []) for k, f in zip(n, found, strict=True)])

    s = distinct.withColumn("low", F.lower("segment"))
    at = F.explode(F.sequence(F.lit(0), F.length("low") - 4))
    grams = s.where("length(low) >= 4").select("segment", "low", at.alias("a")).withColumn("gram", F.expr("substring(low, a + 1, 4)")).where(F.col("gram").rlike("^[a-z]{4}$"))
    d = cut(words.select("word", F.substring("word", 1, 4).alias("gram")))
    hits = grams.join(d, "gram").where("substring(low, a + 1, length(word)) = word").groupBy("segment").agg(F.collect_list(F.struct("a", (F.col("a") + F.length("word")).alias("b"))).alias("found"))
    return s.join(hits, "segment", "left").select("segment", rest(F.length("segment"), "found").alias("rest"))


def find(corpus: DataFrame, samples: DataFrame) -> DataFrame:
    """(scope, row_key, line_no, start, end): the places of secrets in files and in left contexts of samples.

    Positions are 0-based code points; the line is that on which the value starts. Null texts and keys give none;
    repeated rows give each place once; of places within one another the outer stays. A value cut off by a context's end
    counts if what stands there is enough.
    """
    config = is_config()
    out = "row_key string, line_no int, start int, end int, value string, shape string, segments array<string>"
    a = corpus.where("file_id is not null and content is not null").select(F.col("file_id").cast("string"), config, "content").mapInArrow(look, out)
    b = samples.where("sample_id is not null and left_context is not null").select("sample_id", config, "left_context").mapInArrow(look, out)
    c = cut(a.select(F.lit("corpus").alias("scope"), "*").union(b.select(F.lit("samples").alias("scope"), "*")).distinct())
    words = dictionary(corpus)
    # literals repeat: each distinct one is judged once
    values = cut(c.select("value", "shape", "segments").distinct())
    rests = cut(left_over(values.select(F.explode("segments").alias("segment")).distinct(), words))

    @F.pandas_udf("boolean")
    def secret(value: pd.Series, kind: pd.Series, left: pd.Series) -> pd.Series:
        return pd.Series([is_secret(v, k, [x["rest"] for x in r] if r is not None else []) for v, k, r in zip(value, kind, left, strict=True)])

    each = values.select("value", "shape", F.posexplode("segments").alias("i", "segment")).join(rests, "segment")
    per = each.groupBy("value", "shape").agg(F.array_sort(F.collect_list(F.struct("i", "rest"))).alias("left"))
    bad = cut(per.where(secret("value", "shape", "left")).select("value", "shape"))
    w = W.partitionBy("scope", "row_key").orderBy("start", F.desc("end")).rowsBetween(W.unboundedPreceding, -1)
    places = c.join(bad, ["value", "shape"], "left_semi").select("scope", "row_key", "line_no", "start", "end").distinct()
    return places.withColumn("before", F.max("end").over(w)).where("before is null or start >= before").drop("before")


def redact(rows: DataFrame, key: str, text: str, found: DataFrame, mark: str = "REDACTED") -> DataFrame:
    """(key, text) with each secret replaced by ``mark``; quotes, line breaks and code around it are unchanged.

    A secret over several lines keeps its line breaks, so that line numbers hold. Rows that repeat a key are equal; one stays.
    """
    per = found.groupBy(F.col("row_key").alias("k__")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("p"))

    @F.pandas_udf("string")
    def replaced(t: pd.Series, p: pd.Series) -> pd.Series:
        out = []
        for s, spans in zip(t, p, strict=True):
            parts, at = [], 0
            for x in spans if s is not None and spans is not None else ():
                if x["start"] >= at:
                    parts += [s[at : x["start"]], mark, "\n" * s.count("\n", x["start"], x["end"])]
                    at = x["end"]
            out.append(s if s is None else "".join([*parts, s[at:]]))
        return pd.Series(out, dtype=object)

    r = rows.select(F.col(key).cast("string").alias("k__"), F.col(text).alias("t__")).dropDuplicates(["k__"])
    return r.join(per, "k__", "left").select(F.col("k__").alias("row_key"), replaced("t__", "p").alias("text"))
