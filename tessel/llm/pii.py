"""Personal information in free text: bootstrapped contextual extraction over a pattern-instance graph.

Each text is scanned once for candidate spans with the patterns they stand in: the word before them, and for mailboxes and
postal addresses also their own lexical form (how the @ is spelled, the word for the street). Seed entities (names beside
a mailbox that spells them, numbers in international or otherwise unmistakable form, plain mailboxes, addresses with a word
that means nothing else) support the patterns they occur in; patterns of which enough instances are supported are trusted
and support all their instances, which support further patterns, until a round adds nothing. Spark does the scoring: one
row per pattern and instance, aggregated by either. Names are read off with the given names and surnames found so, all
other kinds by their trusted patterns.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.llm.common import cut

#: A word that starts with no lower-case Latin letter.
WORD = r"[^\W\d_a-zß-öø-ÿ][^\W\d_]*(?:['’][^\W\d_]+)?"
# Particles inside surnames.
PARTICLE = r"(?:(?:von|van|de|del|di|da|du|la|le|der|den|dos|zu|VON|VAN|DE|DEL|DI|DA|DU|LA|LE|DER|DEN|DOS|ZU|Von|Van|De|Der) )"
NAME = re.compile(rf"(?<![\w@.+/＠-])(?=({PARTICLE}{{0,2}}{WORD}(?:-{WORD})?)(,? )({PARTICLE}{{0,2}}{WORD}(?:-{WORD})?)(?![\w@＠/+]|\.\w|-\w))")
LOCAL, LABEL, TLD = r"[^\W_](?:[\w.+'-]*\w)?", r"[^\W_](?:[\w-]*[^\W_])?", r"[^\W\d_]{2,}"
DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|punto|point|punkt|\.)\s?[\])}]\s?|&#46;)"
MAIL = re.compile(
    rf"(?<![\w.+/＠@-])(?:{LOCAL}(?:\s?[@＠]\s?|&#64;|&commat;|%40|\s?[\[({{<]\s?(?:at|AT|At|arroba|@)\s?[\])}}>]\s?)(?:{LABEL}{DOT})+{TLD}"
    rf"|{LOCAL}\s(?:at|AT|arroba)\s(?:{LABEL}\s(?:dot|DOT|punto|point|punkt)\s)+{TLD})(?![\w@])"
)
MAIL_SIGN = re.compile(r"[@＠]|&#64;|&commat;|%40|[\[({<]\s?(?:at|AT|At|arroba)\b|\s(?:dot|DOT|punto|point|punkt)\s")
PHONE = re.compile(r"(?<![\w.:/#-])(?:\+|\(\+?|)\d[\d ()./-]{5,}\d(?: ?(?:ext\.?|x|Durchwahl|poste) ?\d{1,5})?(?![\w-])")
NUMBER_ID = re.compile(r"(?<![\w.:/#-])(?:[A-Z]{1,2} ?\d[\dA-Z -]{5,}[\dA-Z]|\d{2}[A-Z]{2}\d{5}|\d{7,8}-?[A-Z]|\d{1,2}\.\d{3}\.\d{3}-?[A-Z]|[XYZ]-\d{7}-?[A-Z]|\d(?:[ -]?\d){7,14}|\d{3}-\d{2}-\d{4})(?![\w-]|\.\d)")
#: Lines with a digit, as every postal address has one.
DIGIT_LINE = re.compile(r"[^\n\d]*\d[^\n]*")
DATE = re.compile(r"\d{4}-\d\d-\d\d\b|\d\d?\.\d\d?\.\d{4}\b|^\d+(?:\.\d+){3}$")
# Words (or their starts) that label identity numbers in the languages of the texts.
ID_LABEL = re.compile(r"passp|pasap|reisepass|ausweis|steuer|^tax|^nif\b|^nie\b|^dni\b|^nir\b|^ssn\b|social|insurance|versicher|fiscal|identit|identidad|cédula")
STREET = r"(?:Street|St\.?|Road|Rd\.?|Avenue|Ave\.?|Lane|Ln\.?|Drive|Dr\.?|Court|Ct\.?|Close|Square|Terrace|Place|Boulevard|Blvd\.?|Way|Crescent|Row|Parade|Gardens|Grove|Hill|Mews|Walk)"
ADDRESS = re.compile(
    rf"(?<![\w.:-])\d{{1,4}}[A-Za-z]?(?:[-/]\d{{1,4}}[a-z]?)?,? (?:(?!{STREET}\b)[A-Z][\w'’-]+ ){{1,3}}{STREET}(?!\w)"
    r"|(?<![\w.:-])\d{1,4}(?:[A-Za-z]| ?bis| ?ter)?,? (?:rue|avenue|boulevard|bd|place|chemin|allée|allee|impasse|quai|cours|route|square|passage|Rue|Avenue|Boulevard|Place|Chemin|Allée|Impasse|Quai|Cours|Route)(?: (?:de la|de l'|du|des|de|d'|la|le|les|aux?))? ?[A-ZÀ-Ý][\w'’-]+"
    r"|(?<![\w-])(?:[A-ZÄÖÜ][\wäöüß-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer|steig|stieg|pfad|chaussee)|(?:Am|An der|Auf dem|Im|In der|Zum|Zur|Unter den) [A-ZÄÖÜ][\wäöüß-]+|[A-ZÄÖÜ][\wäöüß-]+(?: |-)(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ring|Damm|Ufer)) \d{1,4} ?[a-z]?\b"
    r"|(?<!\w)(?:[Cc]alle|C/|[Aa]venida|Avda\.|[Pp]laza|[Pp]aseo|[Rr]onda|[Cc]amino|[Tt]ravesía|[Cc]arrera|[Gg]lorieta)(?: (?:de la|de los|de las|del|de|la|el|los|las))? ?[A-ZÁÉÍÓÚÑ][\w'’-]+(?: [A-ZÁÉÍÓÚÑ][\w'’-]+)*,? (?:n\.?º ?|núm\. ?)?\d{1,4}"
)
# Words for streets that also mean something else, so that their addresses are no seeds.
UNSURE = set("way row hill close place walk grove court drive square lane parade gardens mews terrace crescent cours route passage place impasse quai camino carrera plaza ronda ring ufer pfad steig stieg damm allee weg am im".split())
#: A round that adds nothing ends the bootstrap; this many at most.
ROUNDS = 12
#: The part of a pattern's instances that must be supported for it to be trusted: of names, and of the other kinds (whose
#: instances are seldom repeated, so that most of a good pattern's are only supported by the pattern itself).
TRUST, TRUST_OTHERS = 0.6, 0.1


def fold(s: str) -> str:
    """Lower-case ASCII letters of a word, German umlauts spelled out."""
    s = s.lower().translate({0xE4: "ae", 0xF6: "oe", 0xFC: "ue", 0xDF: "ss"})
    return re.sub("[^a-z]", "", unicodedata.normalize("NFKD", s))


def context(left: str) -> str:
    """The last word before a span, with digits as 0 and capitalised words (which may be names) as X."""
    line = left[-80:].rsplit("\n", 1)[-1].rstrip(" ")
    m = re.search(r"(\S+)$", line)
    if not m:
        return "^"
    w = re.split(r"(?<=[=(<\"'>])", m.group(1))
    w = [x for x in w if x][-1]
    if w[0].isupper() and w[-1] in ",;" and len(w) > 2:
        return "X" + w[-1]
    return re.sub(r"\d", "0", w.lower())[-40:]


def is_word(w: str) -> bool:
    return all(p and p[0].isupper() and (p[1:].islower() or p.isupper() or not p[1:].isalpha()) for p in re.split(r"[-'’]", w.split(" ")[-1])) and len(w) > 1


CANDIDATE = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("comma", pa.bool_()), ("left", pa.string()), ("form", pa.string()), ("seed", pa.bool_())])


class Spans:
    """Spans that don't overlap one another, sorted, so that each question takes logarithmic time."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def overlap(self, a: int, b: int) -> bool:
        i = bisect.bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        i = bisect.bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def street_word(value: str) -> str:
    """The word of an address that says it is one."""
    words = re.findall(r"[^\W\d_]+\.?|C/", value)
    for w in words if re.match(r"(?i)calle|c/|avenida|avda|plaza|paseo|ronda|camino|travesía|carrera|glorieta|am |an der|auf dem|im |in der|zum |zur |unter den", value) or value[0].isdigit() and re.match(r"[^A-Za-z]*(?:bis|ter)?,? ?(?:[a-zé]|Rue|Avenue|Boulevard|Place|Chemin|Allée|Impasse|Quai|Cours|Route)", value) else reversed(words):
        if len(w) > 1 and w not in ("bis", "ter"):
            m = re.search(r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer|steig|stieg|pfad|chaussee)$", w.lower())
            return m.group() if m else w.lower()
    return ""


def candidates_of(doc_id: int, text: str) -> Iterator[tuple]:
    taken = Spans()
    mails: list[tuple[int, int, str]] = []
    for m in MAIL.finditer(text) if MAIL_SIGN.search(text) else ():
        local = re.split(r"[\s@＠\[({<&%]", m.group(), maxsplit=1)[0]
        taken.add(*m.span())
        if (local.lower() in ("git", "hg", "svn") and text[m.end() : m.end() + 1] in (":", "/")) or text.endswith("://", 0, m.start()) or text[m.end() : m.end() + 1] == ":" and re.match(r":[\w./-]+\.git", text[m.end() : m.end() + 300]):
            continue
        mails.append((m.start(), m.end(), fold(local)))
        form = re.sub(r"[\w.+'-]+", "w", m.group().replace(" at ", " (at) ").replace(" dot ", " (dot) "))
        yield doc_id, "email", m.start(), m.end(), m.group(), "", False, context(text[max(0, m.start() - 120) : m.start()]), form, form == "w@w"
    for line in DIGIT_LINE.finditer(text):
        for m in ADDRESS.finditer(text, *line.span()):
            if not taken.overlap(*m.span()):
                taken.add(*m.span())
                form = street_word(m.group())
                yield doc_id, "address", m.start(), m.end(), m.group(), "", False, context(text[max(0, m.start() - 120) : m.start()]), form, form.rstrip(".") not in UNSURE
    for kind, rx in (("id_number", NUMBER_ID), ("phone", PHONE)):
        for m in rx.finditer(text):
            s, e, v = m.start(), m.end(), m.group()
            digits = sum(c.isdigit() for c in v)
            if not (6 if kind == "id_number" and not v.isdigit() else 7) <= digits <= 20 or DATE.search(v) or taken.overlap(s, e):
                continue
            while v.count(")") > v.count("(") and v[-1] == ")":
                v, e = v[:-1], e - 1
            left = context(text[max(0, s - 120) : s])
            if kind == "id_number":
                seed = bool(re.fullmatch(r"\d{3}-\d{2}-\d{4}|[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D]|\d{8}[A-Z]|[XYZ]\d{7}[A-Z]|\d{2}[A-Z]{2}\d{5}", v) or ID_LABEL.search(left))
            else:
                seed = bool(re.match(r"\+\d|\(\+\d|00[1-9]\d? ?[\d(-]|\(\d{3}\) \d{3}-\d{4}$|1-\d{3}-\d{3}-\d{4}$", v)) and digits >= 9
            yield doc_id, kind, s, e, v, "", False, left, "", seed
    at = [x for x, _, _ in mails]
    for m in NAME.finditer(text):
        a, sep, b = m.groups()
        s, e = m.start(1), m.end(3)
        if not (is_word(a) and is_word(b)) or taken.overlap(s, e):
            continue
        near = [f for x, _, f in mails[bisect.bisect_left(at, s - 60) : bisect.bisect_right(at, e + 12)] if 0 <= x - e <= 12 or 0 <= s - x <= 60]
        fa, fb = fold(a.split(" ")[-1]), fold(b.split(" ")[-1])
        seed = len(fa) > 2 and len(fb) > 3 and any(fa in f and (fb in f or f[0] == fa[0]) or (fb in f and fa[0] in f) for f in near)
        yield doc_id, "name", s, e, a, b, "," in sep, context(text[max(0, s - 120) : s]), "", seed


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [r for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for r in candidates_of(i, t)]
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in CANDIDATE]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, CANDIDATE, strict=True)], schema=CANDIDATE)


KINDS = ("address", "email", "id_number", "phone")


def trusted_patterns(cands: DataFrame) -> DataFrame:
    """(kind, pattern) that hold enough supported instances, from seeds on, round by round until nothing is added.

    The graph has one row per kind, pattern and instance. Kinds compete for a context: it goes to the one with more
    supported instances there, then to the one with the greater part of them.
    """
    each = F.explode(F.array_distinct(F.array(F.concat(F.lit("c:"), "left"), F.concat(F.lit("f:"), "kind", F.lit(":"), "form"))))
    graph = cut(cands.where("kind <> 'name'").select("kind", each.alias("pattern"), F.xxhash64("a").alias("a"), "seed").groupBy("kind", "pattern", "a").agg(F.max("seed").alias("seed")).where(~F.col("pattern").rlike("^f:[^:]*:$")))
    supported, had = graph.where("seed").select("kind", "a").distinct(), -1

    def trusted(marked: DataFrame) -> DataFrame:
        per = marked.groupBy("pattern").agg(*[x for k in KINDS for x in (F.count_if(F.col("kind") == k).alias(f"n_{k}"), F.count_if((F.col("kind") == k) & (F.col("ok") == 1)).alias(f"hits_{k}"))])
        best = F.array_max(F.array(*[F.struct(F.col(f"hits_{k}").alias("hits"), (F.col(f"hits_{k}") / F.nullif(F.col(f"n_{k}"), F.lit(0))).alias("share"), F.lit(k).alias("kind")) for k in KINDS]))
        return per.select("pattern", best.alias("b")).where(f"b.hits >= 2 and b.share >= {TRUST_OTHERS}").select("b.kind", "pattern")

    mark = lambda: graph.join(supported.withColumn("ok", F.lit(1)), ["kind", "a"], "left")
    for _ in range(ROUNDS):
        marked = mark()
        held = marked.join(trusted(marked).withColumn("in", F.lit(1)), ["kind", "pattern"], "left").where("in = 1 or ok = 1")
        supported = cut(held.select("kind", "a").distinct())
        n = supported.count()
        if n == had:
            break
        had = n
    return cut(trusted(mark()))


def trusted_places(cands: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end, rank) of candidates that are seeds or stand in a trusted pattern."""
    known = trusted_patterns(cands).withColumn("trusted", F.lit(1))
    c = cands.where("kind <> 'name'").select("doc_id", "kind", "start", "end", "seed", F.concat(F.lit("c:"), "left").alias("left"), F.concat(F.lit("f:"), "kind", F.lit(":"), "form").alias("form"))
    by_left = c.join(known.select("kind", F.col("pattern").alias("left"), F.col("trusted").alias("t1")), ["kind", "left"], "left")
    by_form = by_left.join(known.select("kind", F.col("pattern").alias("form"), F.col("trusted").alias("t2")), ["kind", "form"], "left")
    rank = F.coalesce(F.col("t1"), F.lit(0)) * 2 + F.col("seed").cast("int") + F.when(F.col("kind").isin("email", "address"), 9).otherwise(0)
    return by_form.where("seed or t1 = 1 or t2 = 1").select("doc_id", "kind", "start", "end", rank.alias("rank"))


def lexicons(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(given names, surnames) in lower case, each with the number of partners that supports it."""
    pairs = names.withColumn("a", F.lower("a")).withColumn("b", F.lower("b")).where("not comma").select("a", "b", "left", "seed")
    per = cut(pairs.groupBy("left", "a", "b").agg(F.max("seed").alias("seed")))
    given = cut(per.where("seed").groupBy("a").agg(F.count_distinct("b").alias("n")).where("n >= 2").select("a"))
    had = -1
    for _ in range(ROUNDS):
        marked = per.join(given.withColumn("known", F.lit(1)), "a", "left")
        contexts = marked.groupBy("left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("hits"))
        trusted = contexts.where(f"hits >= 3 and hits >= {TRUST} * n").select("left")
        inside = marked.join(trusted.withColumn("in_trusted", F.lit(1)), "left", "left")
        # a given name goes before several surnames, in trusted contexts for the most part or beyond doubt
        votes = inside.groupBy("a").agg(F.count_distinct(F.when(F.col("in_trusted") == 1, F.col("b"))).alias("n"), F.count("in_trusted").alias("good"), F.count(F.lit(1)).alias("all"), F.max("seed").alias("seed"))
        given = cut(votes.where("n >= 2 and good >= 0.3 * all or seed and n >= 1 and good >= 0.3 * all").select("a"))
        n = given.count()
        if n == had:
            break
        had = n
    surname = per.join(given, "a", "left_semi").groupBy("b").agg(F.count_distinct("a").alias("n"), F.count_distinct("left").alias("m"))
    return given.withColumnRenamed("a", "word"), surname.select(F.col("b").alias("word"), "n")


def found_names(names: DataFrame) -> DataFrame:
    """(doc_id, start, end) of candidates read as given name and surname, in either order."""
    given, surname = lexicons(names)
    n = names.withColumn("la", F.lower("a")).withColumn("lb", F.lower("b"))
    g1 = given.select(F.col("word").alias("la"), F.lit(1).alias("a_given"))
    g2 = given.select(F.col("word").alias("lb"), F.lit(1).alias("b_given"))
    core = lambda c: F.regexp_extract(c, r"([^ -]+)(?:-[^ ]*)?$", 1)
    known = cut(surname.select(core(F.col("word")).alias("core")).distinct())
    c1, c2 = known.select(F.col("core").alias("core_a"), F.lit(1).alias("a_core")), known.select(F.col("core").alias("core_b"), F.lit(1).alias("b_core"))
    n = n.withColumn("core_a", core(F.col("la"))).withColumn("core_b", core(F.col("lb")))
    n = n.join(g1, "la", "left").join(g2, "lb", "left").join(c1, "core_a", "left").join(c2, "core_b", "left")
    forward = F.expr("not comma and a_given = 1 and b_given is null")
    backward = F.expr("b_given = 1 and a_core = 1 and a_given is null")
    both = F.expr("a_given = 1 and b_given = 1 and (b_core = 1 and not comma or a_core = 1 and comma)")
    score = F.when(forward & F.col("b_core").isNotNull(), 3).when(backward, 2).when(both, 1)
    return n.withColumn("score", score).where("score is not null").select("doc_id", "start", "end", "score")


def find(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text) -> (doc_id, kind, start_pos, end_pos); positions in code points, spans of a text don't overlap.

    Null and empty texts have no places; a doc_id that repeats with the same text gives its places once.
    """
    cands = cut(docs.where("text is not null and doc_id is not null").select("doc_id", "text").mapInArrow(scan, "doc_id bigint, kind string, start int, end int, a string, b string, comma boolean, left string, form string, seed boolean"))
    names = found_names(cands.where("kind = 'name'")).select("doc_id", F.lit("name").alias("kind"), "start", "end", F.col("score").alias("rank"))
    spans = trusted_places(cands).union(names)
    # spans that overlap one another, directly or through others, form a run; only within a run is anything to be decided
    w = W.partitionBy("doc_id").orderBy("start", "end", "kind")
    opens = F.coalesce(F.col("start") >= F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    runs = spans.distinct().withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(w))
    # of overlapping spans the better supported stays, then the longer, then the first
    order = F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("r"), (F.col("start") - F.col("end")).alias("len"), "start", "end", "kind")))
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])), acc).otherwise(F.concat(acc, F.array(x)))
    empty = F.array().cast("array<struct<r:int,len:int,start:int,end:int,kind:string>>")
    per = runs.groupBy("doc_id", "run").agg(order.alias("all")).select("doc_id", F.aggregate("all", empty, keep).alias("kept"))
    return per.select("doc_id", F.inline("kept")).select("doc_id", "kind", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


def redact(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, text) with each place replaced by a typed placeholder such as [EMAIL]; other text is unchanged."""
    per = places.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos", "kind"))).alias("p"))

    @F.pandas_udf("string")
    def replaced(text: pd.Series, p: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, p, strict=True):
            parts, at = [], 0
            for x in spans if t is not None and spans is not None else ():
                parts += [t[at : x["start_pos"]], f"[{x['kind'].upper()}]"]
                at = x["end_pos"]
            out.append(t if t is None else "".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    return docs.select("doc_id", "text").join(per, "doc_id", "left").select("doc_id", replaced("text", "p").alias("text"))
