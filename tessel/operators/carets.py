"""Caret positions in C# files by a lexer (no compiler): candidates by kind, one per offset, sampled and capped.

Kinds that need a parser are told apart by neighbouring tokens, so sub-kinds are approximate; ``analysis_engine`` is lexer.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.functions import text as X

# Keywords after which a caret is of interest, control words, logging methods, query methods.
AFTER = "return await new throw yield is as case when in var else nameof typeof".split()
CONTROL = "if while foreach for switch catch using lock when do".split()
LOG = "Log LogTrace LogDebug LogInformation LogWarning LogError LogCritical".split()
LINQ = "Where Select SelectMany OrderBy OrderByDescending ThenBy ThenByDescending GroupBy Join GroupJoin Any All First FirstOrDefault Single SingleOrDefault Last LastOrDefault Count LongCount Sum Min Max MinBy MaxBy Average ToList ToArray ToDictionary ToHashSet ToLookup Skip Take SkipWhile TakeWhile Distinct DistinctBy Aggregate Zip Concat Union Except Intersect Contains Include ThenInclude AsNoTracking ToListAsync ToArrayAsync FirstOrDefaultAsync SingleOrDefaultAsync AnyAsync CountAsync SumAsync ToDictionaryAsync AsQueryable AsEnumerable OfType Cast Chunk Append Prepend Reverse DefaultIfEmpty SequenceEqual ElementAt".split()
OPERATORS = ["??", "??=", "+=", "-=", "==", "!=", "&&", "||", "<=", ">=", "+"]
WEIGHTS = {"line_start": 0.7, "identifier_partial": 0.035, "member_access": 0.8, "argument_list": 0.5, "after_keyword": 0.5, "after_operator": 0.4, "control_flow": 0.6, "lambda_body": 0.5, "linq": 0.6, "log_message": 1.0, "token_boundary": 0.02}

TOKEN = re.compile(
    r'(?P<comment>//[^\n]*|/\*.*?(?:\*/|\Z))|(?P<directive>^[ \t]*\#[^\n]*)|(?P<string>\$*"""+(?!").*?(?<!")"""+|(?:\$@|@\$|@)"(?:[^"]|"")*"|\$?"(?:[^"\\\n]|\\.)*"?|\'(?:[^\'\\\n]|\\[^\n][0-9A-Fa-f]{0,8})\')'
    r"|(?P<name>@?[^\W\d]\w*)|(?P<number>\d[\w.]*)|(?P<op>\?\?=|=>|\?\?|->|\+\+|--|&&|\|\||[-+*/%^|&=!<>]=|\?\.|::|[^\s\w])",
    re.S | re.M,
)


def lex(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, token, start, end) of a file's tokens; positions in code points."""
    return [(m.lastgroup, m.group(), m.start(), m.end()) for m in TOKEN.finditer(text)]


def candidates(text: str, lexed: list[tuple[str, str, int, int]] | None = None) -> Iterator[tuple[int, str, str, int]]:
    """(offset, kind, subkind, priority); several may share an offset. lexed: the text's tokens, where they are at hand."""
    tokens = [t for t in (lex(text) if lexed is None else lexed) if t[0] not in ("comment", "directive")]
    firsts = {t[2]: i for i, t in enumerate(tokens)}
    for m in re.finditer(r"(?m)^[ \t]*(?=[^\s/#])", text):
        if m.end() in firsts:
            yield m.end(), "line_start", line_subkind(tokens, firsts[m.end()]), 50
    for i, (kind, t, s, e) in enumerate(tokens):
        nxt = tokens[i + 1] if i + 1 < len(tokens) else (None, "", len(text), len(text))
        prev = tokens[i - 1] if i else (None, "", 0, 0)
        yield e, "token_boundary", kind, 1
        if kind == "string":
            if log := log_context(tokens, i):
                q = t.index('"') + 1 if '"' in t else 1
                yield s, "log_message", f"{log}:template_start", 95
                yield s + q, "log_message", f"{log}:template_body", 95
        elif kind == "name":
            if t in AFTER:
                if nxt[2] > e or t in ("nameof", "typeof"):
                    yield nxt[2], "after_keyword", t, 60
            elif len(t) >= 2:
                for k in range(1, len(t)):
                    if k <= 3 or (t[k].isupper() and t[k - 1].islower()):
                        yield s + k, "identifier_partial", "prefix" if k <= 3 else "hump", 10
        elif t in (".", "?."):
            yield e, "member_access", "dot" if t == "." else "conditional_dot", 80
        elif t == "->":
            yield e, "member_access", "pointer", 60
        elif t == "(":
            if prev[1] in CONTROL:
                yield e, "control_flow", prev[1], 75
            elif prev[0] == "name" or prev[1] == ">":
                yield e, "linq" if prev[1] in LINQ else "argument_list", "open_paren", 70
        elif t == "[" and (prev[0] == "name" or prev[1] == "]"):
            yield e, "argument_list", "open_bracket", 65
        elif t == ",":
            yield nxt[2], "argument_list", "after_comma", 70
        elif t == "=":
            yield nxt[2], "after_operator", "assignment", 60
        elif t == "=>":
            yield nxt[2], "lambda_body", "arrow", 65
        elif t in OPERATORS:
            yield nxt[2], "after_operator", t, 45


def uniform(seed: str, salt: str, sha: str, offset: int) -> float:
    """X.uniform of the four, in Python."""
    return (int(hashlib.sha256(f"{seed}\x1f{salt}\x1f{sha}\x1f{offset}".encode()).hexdigest()[:16], 16) >> 11) / 9007199254740992.0


def in_blocks(rows: Iterable[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``most``: the carets of a whole batch of files are never held at once."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block, strict=True), schema, strict=True)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block, strict=True), schema, strict=True)], schema=schema)


SECRET = re.compile(r'(?i)\b\w*(?:password|passwd|pwd|secret|apikey|api_key|accesstoken|access_token)\w*"?\s*[:=]\s*@?"(?-i:(?![A-Z0-9_]+"))[^"\s{}]{8,}"|\b(?:password|pwd)=[^;"\'\s]{6,};')


def explode_carets(files: DataFrame, reasons: bool = False, drawn: Callable[[str, int, str], bool] | None = None) -> DataFrame:
    """files: (file_id, content) -> (file_id, offset, line, column, kind, subkind, target, reason): one row per offset, the kind of
    highest priority, of equals the first found. Only carets without a reason to leave them out come, unless ``reasons``.
    drawn: of files with sha256, which comes out too, only carets for whose digest, offset and kind it holds."""
    fields = [("file_id", pa.int64()), ("offset", pa.int32()), ("line", pa.int32()), ("column", pa.int32()), ("kind", pa.string()), ("subkind", pa.string()), ("target", pa.string()), ("reason", pa.string())]
    schema = pa.schema(fields + [("sha256", pa.string())] * (drawn is not None))

    def carets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for i, text, *sha in zip(*((x.as_py() for x in b.column(k)) for k in range(b.num_columns)), strict=True):
                best: dict[int, tuple[int, str, str]] = {}
                tokens = lex(text)
                for offset, kind, sub, priority in candidates(text, tokens):
                    if offset not in best or priority > best[offset][0]:
                        best[offset] = (priority, kind, sub)
                starts = [t[2] for t in tokens]
                any_secret = SECRET.search(text) is not None
                line, start, end, whole, secret = -1, 0, -1, 0, False
                for offset in sorted(best if drawn is None else (o for o, x in best.items() if drawn(sha[0], o, x[1]))):
                    while end < offset and (line < 0 or end < len(text)):  # on to the line of the caret
                        line, start = line + 1, end + 1
                        end = text.find("\n", start)
                        end = len(text) if end < 0 else end
                        whole = start + len(text[start:end].rstrip(" \t\r"))
                        secret = any_secret and SECRET.search(text, start, end) is not None
                    target = text[offset:whole]
                    why = exclusion(text, tokens, starts, offset, max(offset, whole), end, best[offset][1], secret)
                    if reasons or why is None:
                        yield i, offset, line, offset - start, *best[offset][1:], target, why, *sha

    out = "file_id bigint, offset int, line int, column int, kind string, subkind string, target string, reason string"
    wanted, out = (["file_id", "content"], out) if drawn is None else (["file_id", "content", "sha256"], f"{out}, sha256 string")
    return files.where("file_id is not null and content is not null").select(*wanted).mapInArrow(lambda batches: in_blocks(carets(batches), schema), out)


def line_strata(files: DataFrame) -> DataFrame:
    """files: (file_id, content) -> (file_id, line, stratum) of lines that hold no code to complete: blank, comment, doc_comment,
    inactive_preprocessor_code, preprocessor_directive, inside a literal, or too long (beyond 2,000 characters)."""
    schema = pa.schema([("file_id", pa.int64()), ("line", pa.int32()), ("stratum", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens, inactive, at = lex(text), inactive_parts(text), 0
                starts = [t[2] for t in tokens]
                for n, line in enumerate(re.split(r"\r\n|[\r\n\u0085\u2028\u2029]", text)):
                    bare = line.strip(" \t\x0b\x0c\u00a0\u3000")
                    what = line_stratum(tokens, starts, at + line.index(bare[0]), inactive) if bare else "blank"
                    what = what or ("line_too_long" if len(line) > 2000 else None)
                    if what:
                        rows.append((i, n, what))
                    at += len(line)
                    at += 2 if text[at : at + 2] == "\r\n" else 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 3, schema, strict=True)], schema=schema)

    return files.where("file_id is not null and content is not null").select("file_id", "content").mapInArrow(run, "file_id bigint, line int, stratum string")


def sampled_carets(files: DataFrame, seed: str, per_line: int = 2, per_file: int = 300, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Carets of files with a digest (file_id, sha256, content): kept by hash and weight of kind (trivial targets at a
    twentieth), then the best per line and per file by hash over weight. Carets are drawn where they are found: what isn't
    kept is neither judged nor shuffled."""

    def drawn(sha: str, offset: int, kind: str) -> bool:  # the weight that counts is below, and never above this one
        return uniform(seed, "caret", sha or "", offset) < weights.get(kind, 0.0)

    c = explode_carets(files, drawn=drawn).drop("reason")
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("kind")] * F.when(F.col("target").rlike(r"^[{}()\[\];, ]*$"), 0.05).otherwise(1.0)
    u = X.uniform(F.lit(seed), F.lit("caret"), F.col("sha256"), F.col("offset"))
    kept = c.withColumn("w", w).withColumn("u", u).where("u < w").withColumn("score", F.col("u") / F.col("w"))
    line = kept.withColumn("r", F.row_number().over(W.partitionBy("file_id", "line").orderBy("score", "offset"))).where(F.col("r") <= per_line)
    return line.withColumn("r", F.row_number().over(W.partitionBy("file_id").orderBy("score", "offset"))).where(F.col("r") <= per_file).drop("r", "w", "u", "score")


def tagged(files: DataFrame, carets: DataFrame) -> DataFrame:
    """(file_id, offset, kind, subkind, tags) of kept carets; files: (file_id, content, is_test). Member accesses, arguments and
    lambdas within a query become linq, their kind going into the subkind. A file is lexed once for all its carets."""
    schema = pa.schema([("file_id", pa.int64()), ("offset", pa.int32()), ("kind", pa.string()), ("subkind", pa.string()), ("tags", pa.list_(pa.string()))])

    def tags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for i, text, test, cs in zip(*((x.as_py() for x in b.column(k)) for k in range(4)), strict=True):
                tokens = [t for t in lex(text) if t[0] not in ("comment", "directive")]
                starts = [t[2] for t in tokens]
                for c in cs:
                    tags = tags_at(tokens, bisect.bisect_left(starts, c["offset"]), bool(test))
                    kind, sub = c["kind"], c["subkind"]
                    if "linq" in tags and kind in ("member_access", "argument_list", "lambda_body"):
                        kind, sub = "linq", f"{kind}:{sub}" if sub else kind
                    yield i, c["offset"], kind, sub, tags

    per = carets.groupBy("file_id").agg(F.collect_list(F.struct("offset", "kind", "subkind")).alias("carets"))
    return files.where("content is not null").join(per, "file_id").select("file_id", "content", "is_test", "carets").mapInArrow(lambda batches: in_blocks(tags_of(batches), schema), "file_id bigint, offset int, kind string, subkind string, tags array<string>")


def brace_closure(text: str) -> str:
    """A line break and a closing brace for each brace left open; a closing one without a partner is passed over."""
    depth = 0
    for kind, t, _, _ in lex(text):
        if kind == "op" and t in "{}":
            depth = depth + 1 if t == "{" else max(0, depth - 1)
    return "\n" + "}" * depth if depth else ""


DECLARED = re.compile(r"\b(?:(?:var|int|long|string|bool|double|decimal|float|char|byte|object|Guid|DateTime|[A-Z]\w*(?:<[^<>;()]*>)?(?:\[\])?\??)\s+)([a-z_]\w*)\s*(?==[^=>]|;|,|\)|\bin\b)")


def locals_before(text: str, caret: int) -> list[str]:
    """Names declared as locals or parameters before a caret, in order; strings and comments don't declare."""
    bare = TOKEN.sub(lambda m: " " * len(m.group()) if m.lastgroup in ("comment", "string", "directive") else m.group(), text[:caret])
    return list(dict.fromkeys(m.group(1) for m in DECLARED.finditer(bare)))


def leakage(names: list[str], text: str, caret: int, end: int) -> list[str]:
    """Names that occur in a file only within the hidden span."""
    out = text[:caret] + " " + text[end:]
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", text[caret:end]) and not re.search(rf"\b{re.escape(n)}\b", out)]


# Words that open statements of a kind at the start of a line.
STARTS = {"return": "return", **dict.fromkeys("if switch for foreach while do".split(), "control_flow"), **dict.fromkeys("try throw catch finally".split(), "exception"), "namespace": "namespace", **dict.fromkeys("class struct interface record enum delegate".split(), "type_declaration")}
MODIFIER = frozenset("public private protected internal static readonly const abstract virtual override sealed async partial extern new unsafe volatile required".split())


def line_subkind(tokens: list[tuple[str, str, int, int]], i: int) -> str:
    """What starts with the i-th token, the first of its line: a statement or member by its first words, brace, or continuation."""
    text = tokens[i][1]
    before = tokens[i - 1][1] if i else ";"
    if text in ("{", "}"):
        return "brace"
    if before not in (";", "{", "}", "]", ")", ":") or (before == ")" and text in (".", "?.", "&&", "||", "=>", "??", "+", ",", ")", ";")):
        return "continuation"
    if text == "[":
        return "attribute"
    j = i
    while j < len(tokens) and tokens[j][1] in MODIFIER:
        j += 1
    if j >= len(tokens):
        return "other"
    word = tokens[j][1]
    if word == "using":
        return "using_directive" if j + 1 < len(tokens) and tokens[j + 1][1] not in ("(", "var") else "other"
    if word in STARTS:
        return STARTS[word]
    depth, names, seen = 0, 0, ""
    for k in range(j, min(len(tokens), j + 60)):
        t = tokens[k][1]
        if depth == 0 and t in (";", "{", "=>", "=", "+=", "-="):
            seen = t
            break
        if depth == 0 and t == "(":
            seen = "(" if not seen else seen
            names = k - j
            break
        depth += t in ("[", "<")
        depth -= t in ("]", ">")
    declares = j > i
    if seen == "(":
        spelled = [x[1] for x in tokens[j : j + names]]
        typed = len(spelled) >= 2 and "." not in spelled[-2:] and spelled[0] not in ("await", "new")
        return "method_declaration" if declares or typed else "invocation"
    if declares:
        return "field_or_property"
    pair = j + 1 < len(tokens) and tokens[j][0] == "name" and (tokens[j + 1][0] == "name" or tokens[j + 1][1] in ("<", "?") or (tokens[j + 1][1] == "[" and j + 2 < len(tokens) and tokens[j + 2][1] == "]"))
    if pair and seen in ("=", ";"):
        return "local_declaration"
    if pair and seen in ("{", "=>"):
        return "field_or_property"
    return "assignment" if seen in ("=", "+=", "-=") else "expression"


def log_context(tokens: list[tuple[str, str, int, int]], i: int) -> str | None:
    """ilogger, ilogger_interpolated or logger_message_attribute where the i-th token, a string, is a log template: the first
    string among the arguments of a logging call, or the Message of a LoggerMessage attribute."""
    if tokens[i][0] != "string":
        return None
    if i > 2 and tokens[i - 1][1] == "=" and tokens[i - 2][1] == "Message":
        d = 0
        for k in range(i - 3, max(-1, i - 60), -1):
            d += tokens[k][1] == ")"
            if tokens[k][1] == "(":
                if d == 0:
                    return "logger_message_attribute" if tokens[k - 1][1] in ("LoggerMessage", "LoggerMessageAttribute") else None
                d -= 1
        return None
    d = 0
    for k in range(i - 1, max(-1, i - 200), -1):
        t = tokens[k][1]
        if d == 0 and tokens[k][0] == "string" and tokens[k - 1][1] in ("(", ","):
            return None
        d += t in (")", "]", "}")
        if t in ("(", "[", "{"):
            if d == 0:
                if t == "(" and k and tokens[k - 1][1] in LOG and tokens[i - 1][1] in ("(", ","):
                    return "ilogger_interpolated" if tokens[i][1].startswith(("$", "@$")) else "ilogger"
                return None
            d -= 1
    return None


def tags_at(tokens: list[tuple[str, str, int, int]], n: int, is_test: bool = False) -> list[str]:
    """The tags of a place before the n-th token, from the brackets that hold it and the words of its statement."""
    tags = {"test_code"} if is_test else set()
    d = 0
    for k in range(n - 1, -1, -1):
        kind, t = tokens[k][0], tokens[k][1]
        before = tokens[k - 1][1] if k else ""
        if kind == "op" and t in (")", "]", "}"):
            d += 1
        elif kind == "op" and t in ("(", "[", "{"):
            if d:
                d -= 1
                continue
            if t == "(":
                dotted = k > 1 and tokens[k - 2][1] in (".", "?.")
                if before in LINQ and dotted:
                    tags.add("linq")
                if before in LOG and dotted:
                    tags.add("log_call")
                if before == "catch":
                    tags.add("exception")
            elif t == "[":
                if before in (";", "{", "}", "]", ""):
                    tags.add("attribute")
                elif before in ("=", "(", ",", "return", "=>", ":"):
                    tags.add("collection_expression")
            else:
                words = [x[1] for x in tokens[max(0, k - 12) : k]]
                if before == "switch":
                    tags.add("switch_expression")
                elif "new" in words and not {";", "{"} & set(words[len(words) - 1 - words[::-1].index("new") :]):
                    tags.add("initializer")
                elif before in ("try", "finally"):
                    tags.add("exception")
                elif "record" in words and ";" not in words[words.index("record") :]:
                    tags.add("record")
                elif before == ")" and not ({"if", "for", "foreach", "while", "using", "lock", "switch", "catch", "=>"} & set(words)):
                    break  # the body of a member
        elif d == 0:
            if t == ";":
                # the statement ends here; what holds it goes on outwards
                d_out = 0
                while k >= 0 and not (tokens[k][0] == "op" and tokens[k][1] in ("(", "[", "{") and d_out == 0):
                    d_out += tokens[k][1] in (")", "]", "}") and tokens[k][0] == "op"
                    d_out -= tokens[k][1] in ("(", "[", "{") and tokens[k][0] == "op"
                    k -= 1
                if k >= 0:
                    tags |= set(tags_at(tokens, k + 1)) - {"await", "pattern", "using_directive"}
                break
            if t == "=>":
                tags.add("lambda")
            elif t == "await":
                tags.add("await")
            elif t == "throw":
                tags.add("exception")
            elif t in ("is", "case"):
                tags.add("pattern")
            elif t == "using" and (k == 0 or before in (";", "}")):
                tags.add("using_directive")
            elif t == "from" and k + 2 < len(tokens) and tokens[min(k + 2, len(tokens) - 1)][1] == "in":
                tags.add("linq")
    return sorted(tags)


def exclusion(text: str, tokens: list[tuple[str, str, int, int]], starts: list[int], offset: int, end: int, line_end: int, kind: str, secret: bool, least: int = 1, most: int = 200) -> str | None:
    """Why a caret is left out: the first reason of the chain. tokens: all of the file, comments included; starts: theirs;
    secret: whether the line holds one."""
    if end - offset < least:
        return "empty_target"
    if end - offset > most:
        return "target_too_long"
    i = bisect.bisect_right(starts, offset) - 1
    if i >= 0:
        what, t, s, e = tokens[i]
        if kind != "log_message" and s < offset < e:
            if what == "string":
                return "in_interpolated_string" if t.startswith(("$", "@$")) else "caret_inside_literal"
            if what in ("comment", "directive"):
                return "caret_inside_trivia"
    for k in range(max(0, i), len(tokens)):
        what, t, s, e = tokens[k]
        if s >= end:
            break
        if what == "string" and e > line_end and e > offset:
            return "raw_multiline_string" if '"""' in t[:8] else "multiline_string"
    return "secret_detected" if secret else None


def line_stratum(tokens: list[tuple[str, str, int, int]], starts: list[int], first: int, inactive: list[tuple[int, int]]) -> str | None:
    """The class of a line whose first character that isn't blank is at ``first``, where it holds no code: comment, doc_comment,
    preprocessor_directive, inactive_preprocessor_code, or inside a literal that began before."""
    if any(a <= first < b for a, b in inactive):
        return "inactive_preprocessor_code"
    i = bisect.bisect_right(starts, first) - 1
    if i < 0:
        return None
    what, t, s, e = tokens[i]
    if not s <= first < e:
        return None
    if what == "comment":
        return "doc_comment" if t.startswith(("///", "/**")) else "comment"
    if what == "directive":
        return "preprocessor_directive"
    if what == "string" and s < first:
        return "inside_raw_string" if '"""' in t[:8] and not t.startswith("$") else "inside_interpolated_string" if t.startswith(("$", "@$")) else "inside_multiline_string"
    return None


def inactive_parts(text: str) -> list[tuple[int, int]]:
    """The parts of a file that conditions on symbols which aren't defined leave out."""
    out, stack = [], []
    for m in re.finditer(r"(?m)^[ \t]*#[ \t]*(if|elif|else|endif)\b[ \t]*([^\r\n]*)", text):
        word, cond = m.group(1), m.group(2).split("//")[0].strip()
        on = cond in ("true",) or cond.startswith("!") and re.fullmatch(r"!\s*\w+", cond) is not None and cond != "!true"
        if word == "if":
            stack.append([on, on, m.end()])
        elif stack:
            live, taken, since = stack[-1]
            if not live:
                out.append((since, m.start()))
            if word == "endif":
                stack.pop()
            else:
                now = not taken and (word == "else" or on)
                stack[-1] = [now, taken or now, m.end()]
    return out
