"""Facts about carets in C# files, by a lexer and a table of the types and members that a repository declares.

There is no compiler: what is declared is read off the tokens, types are matched by name within their repository, and
types from elsewhere are unknown. ``analysis_engine`` is lexer. A file is lexed once for all its carets.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.operators.carets import lex

ENGINE = "lexer"
# Words of declarations.
TYPES = ("class", "struct", "interface", "record", "enum")
MODIFIERS = frozenset("public private protected internal static readonly const abstract virtual override sealed async partial extern new unsafe volatile required ref out in params this event file scoped".split())
NOT_A_TYPE = frozenset("return throw await new case else in is as when yield goto using namespace var get set init add remove where if while for foreach switch lock catch do try finally default typeof nameof sizeof checked unchecked".split())
Token = tuple[str, str, int, int]


class Scanner:
    """Follows the braces of a file: feed tokens one by one; ``types`` and ``member`` say what encloses the place reached,
    ``found`` collects the declarations (owner, kind, name, type, signature, params, static, position)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple | str | None]] = []
        self.pending: list[Token] = []
        self.depth = 0
        self.found: list[tuple] = []
        self.bases: list[tuple[str, str]] = []

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else "file"

    def enclosing_type(self) -> str | None:
        return next((str(x[1]) for x in reversed(self.stack) if x[0] == "type"), None)

    def member(self) -> tuple | None:
        """(name, type, params, is_async) of the innermost member around the place."""
        return next((x[1] for x in reversed(self.stack) if x[0] == "member"), None)

    def feed(self, t: Token) -> None:
        text = t[1]
        if text in "([" and t[0] == "op":
            self.depth += 1
        elif text in ")]" and t[0] == "op":
            self.depth = max(0, self.depth - 1)
        if t[0] == "op" and text == "{":
            self.stack.append(self.opened())
            self.pending, self.depth = [], 0
        elif t[0] == "op" and text == "}":
            if self.stack:
                kind, what = self.stack.pop()
                if kind == "enum":
                    self.values(str(what))
            self.pending, self.depth = [], 0
        elif t[0] == "op" and text == ";" and self.depth == 0:
            if self.top() == "type" or self.top() in ("file", "namespace"):
                self.declared()
            self.pending = []
        else:
            self.pending.append(t)

    def values(self, owner: str) -> None:
        """Members of an enum: the names at its commas."""
        expect = True
        for k, text, start, _ in self.pending:
            if expect and k == "name":
                self.found.append((owner, "enum_value", text, owner, None, [], True, start))
                expect = False
            elif text == ",":
                expect = True

    def type_head(self) -> tuple[str, str, int] | None:
        p = [x for x in self.pending if x[0] in ("name", "op")]
        for i, (_, text, _, _) in enumerate(p):
            if text in TYPES and i + 1 < len(p):
                if text == "record" and p[i + 1][1] in ("struct", "class"):
                    i += 1
                if i + 1 < len(p) and p[i + 1][0] == "name" and not (i and p[i - 1][1] in (":", ",")):
                    return text, p[i + 1][1], p[i + 1][2]
        return None

    def opened(self) -> tuple[str, tuple | str | None]:
        words = {x[1] for x in self.pending[:12]}
        if "namespace" in words:
            return "namespace", None
        if self.top() in ("file", "namespace", "type") and (head := self.type_head()):
            kind, name, start = head
            self.type_found(kind, name, start)
            return ("enum" if kind == "enum" else "type"), name
        if self.top() == "type" and not assigned(self.pending):
            m = self.parsed()
            if m:
                self.found.append((self.enclosing_type(), *m[0], m[1]))
                return "member", (m[0][1], m[0][2], m[0][4], any(x[1] == "async" for x in self.pending))
        return "block", None

    def type_found(self, kind: str, name: str, start: int) -> None:
        self.found.append((self.enclosing_type(), "type", name, kind, None, [], False, start))
        texts = [x[1] for x in self.pending]
        if "(" in texts and kind in ("record", "class", "struct"):
            i = texts.index("(")
            for n, ty in params_of(self.pending[i:]):
                self.found.append((name, "property" if kind == "record" else "parameter", n, ty, None, [], False, start))
        if ":" in texts:
            rest = self.pending[texts.index(":") + 1 :]
            for part in split_top(rest):
                if part and part[0][1] == "where":
                    break
                if part and part[0][0] == "name":
                    self.bases.append((name, part[-1][1] if len(part) > 1 and part[-2][1] == "." else part[0][1]))

    def parsed(self) -> tuple[tuple, int] | None:
        """A member from what stands before its body: (kind, name, type, signature, params, static), position."""
        p = strip_attributes(self.pending)
        static = any(x[1] in ("static", "const") for x in p)
        p = [x for x in p if x[1] not in MODIFIERS]
        texts = [x[1] for x in p]
        if "where" in texts:
            p, texts = p[: texts.index("where")], texts[: texts.index("where")]
        if "operator" in texts or not p:
            return None
        if "(" in texts:
            i = texts.index("(")
            j = i - 1
            if j >= 0 and texts[j] == ">":  # generic parameters of the method
                d = 0
                while j >= 0:
                    d += texts[j] == ">"
                    d -= texts[j] == "<"
                    j -= 1
                    if d == 0:
                        break
            if j < 0 or p[j][0] != "name":
                return None
            name, ty, params = texts[j], spelled(p[:j]), params_of(p[i:])
            kind = "constructor" if not ty and name == self.enclosing_type() else "method"
            if kind == "method" and not ty:
                return None
            sig = f"{name}({', '.join(f'{t} {n}' for n, t in params)})"
            return (kind, name, ty or name, sig if kind == "constructor" else f"{ty} {sig}", params, static), p[j][2]
        if texts[-1] == "]" and "this" in [x[1] for x in self.pending]:
            return None
        if len(p) >= 2 and p[-1][0] == "name" and texts[-1] not in NOT_A_TYPE and p[0][1] not in NOT_A_TYPE:
            return ("property", texts[-1], spelled(p[:-1]), None, [], static), p[-1][2]
        return None

    def declared(self) -> None:
        """A declaration that ends with ;: a type without a body, a field, a member with an expression body or without a body."""
        texts = [x[1] for x in self.pending]
        if self.top() != "enum" and (head := self.type_head()) and "=" not in texts:
            self.type_found(head[0], head[1], head[2])
            return
        if self.top() != "type":
            return
        whole, event = self.pending, "event" in texts
        cut = next((i for i, x in enumerate(texts) if x in ("=", "=>")), len(texts))
        arrow = cut < len(texts) and texts[cut] == "=>"
        self.pending = whole[:cut]
        m = self.parsed()
        self.pending = whole
        if m:
            kind, name, ty, sig, params, static = m[0]
            if kind == "property" and not arrow:
                kind = "event" if event else "const" if "const" in texts else "field"
            self.found.append((self.enclosing_type(), kind, name, ty, sig, params, static, m[1]))


def strip_attributes(p: Sequence[Token]) -> list[Token]:
    i = 0
    while i < len(p) and p[i][1] == "[":
        d = 0
        while i < len(p):
            d += p[i][1] == "["
            d -= p[i][1] == "]"
            i += 1
            if d == 0:
                break
    return list(p[i:])


def assigned(p: Sequence[Token]) -> bool:
    """Whether an = or => stands outside of brackets."""
    d = 0
    for x in p:
        d += x[1] in ("(", "[")
        d -= x[1] in (")", "]")
        if d == 0 and x[1] in ("=", "=>"):
            return True
    return False


def spelled(p: Sequence[Token]) -> str:
    """Tokens of a type as text: no blanks, but one after a comma."""
    return "".join(x[1] + (" " if x[1] == "," else "") for x in p)


def split_top(p: Sequence[Token]) -> list[list[Token]]:
    out, d = [[]], 0
    for x in p:
        d += x[1] in ("(", "[", "<", "{")
        d -= x[1] in (")", "]", ">", "}")
        if x[1] == "," and d <= 0:
            out.append([])
        elif not out[-1] and x[1] == "where" or (out[-1] and x[1] == "where"):
            out.append([x])
        else:
            out[-1].append(x)
    return out


def params_of(p: Sequence[Token]) -> list[tuple[str, str]]:
    """(name, type) of a parameter list that starts at its bracket."""
    d, inner = 0, []
    for x in p:
        d += x[1] == "("
        d -= x[1] == ")"
        if d == 0:
            break
        inner.append(x)
    out = []
    for part in split_top(inner[1:]):
        part = [x for x in strip_attributes(part) if x[1] not in MODIFIERS]
        texts = [x[1] for x in part]
        if "=" in texts:
            part = part[: texts.index("=")]
        if len(part) >= 2 and part[-1][0] == "name":
            out.append((part[-1][1], spelled(part[:-1])))
    return out


LITERAL = ((re.compile(r"^\$*@?\$?\""), "string"), (re.compile(r"^'"), "char"), (re.compile(r"^\d+$"), "int"), (re.compile(r"^\d[\d.]*[mM]$"), "decimal"), (re.compile(r"^\d*\.\d+[dD]?$"), "double"), (re.compile(r"^(?:true|false)$"), "bool"))


def local_types(tokens: Sequence[Token]) -> dict[str, str | None]:
    """Locals that the tokens declare, with their types; of ``var`` the type of a literal or of new T(...), else unknown."""
    out: dict[str, str | None] = {}
    for i, (kind, text, _, _) in enumerate(tokens):
        after = tokens[i + 1][1] if i + 1 < len(tokens) else ""
        before = tokens[i - 1] if i else ("", "", 0, 0)
        if kind != "name" or after not in ("=", ";", "in", ")", ",") or text in NOT_A_TYPE:
            continue
        if before[1] == "var":
            ty = None
            if after == "=" and i + 2 < len(tokens):
                v = tokens[i + 2]
                if v[1] == "new" and i + 3 < len(tokens) and tokens[i + 3][0] == "name":
                    ty = tokens[i + 3][1]
                else:
                    ty = next((n for rx, n in LITERAL if rx.match(v[1])), None)
            out[text] = ty
        elif before[0] == "name" and before[1] not in NOT_A_TYPE and before[1] not in MODIFIERS and after in ("=", ";", "in", ")", ","):
            out[text] = before[1]
        elif before[1] in (">", "]", "?") and after in ("=", ";", "in"):
            j, d = i - 1, 0
            while j >= 0:
                d += tokens[j][1] in (">", "]")
                d -= tokens[j][1] in ("<", "[")
                if d == 0 and tokens[j][0] == "name":
                    break
                if tokens[j][1] in (";", "{", "}", "(", "="):
                    j = -1
                    break
                j -= 1
            if j >= 0 and tokens[j][1] not in NOT_A_TYPE:
                out[text] = spelled(tokens[j:i])
    return out


def unwrapped(ty: str | None, is_async: bool) -> str | None:
    """The type that a return takes: of an async method what its task holds; none of void."""
    if ty and is_async and (m := re.fullmatch(r"(?:Value)?Task<(.*)>", ty)):
        return m.group(1)
    return None if ty in (None, "void") or is_async and ty in ("Task", "ValueTask") else ty


def facts_at(tokens: Sequence[Token], n: int, caret: int, scanner: Scanner) -> dict:
    """What is known at a caret that the first n tokens lie before; the scanner has been fed with them."""
    seen = tokens[:n]
    member, owner = scanner.member(), scanner.enclosing_type()
    typed = bool(seen) and seen[-1][0] == "name" and seen[-1][3] >= caret > seen[-1][2]
    before = seen[:-1] if typed else seen
    last = before[-1][1] if before else ""
    params = dict(member[2]) if member else {}
    start = next((i for i in range(len(before) - 1, -1, -1) if scanner_start(before, i, member)), len(before))
    names = {**params, **local_types(before[start:])}
    out = {"enclosing_type": owner, "member": member[0] if member else None, "return_type": member[1] if member else None, "receiver": None, "receiver_kind": None, "callee": None, "argument": None, "expected": None, "source": None, "locals": [(k, v) for k, v in names.items()]}
    if last in (".", "?.") and len(before) > 1:
        r = before[-2]
        chained = len(before) > 2 and before[-3][1] in (".", "?.")
        if r[0] == "name" and not chained:
            out["receiver"] = r[1]
            out["receiver_kind"] = "this" if r[1] in ("this", "base") else "local" if r[1] in names else "name"
        elif r[0] == "string":
            out["receiver"], out["receiver_kind"] = "string", "type"
        else:
            out["receiver_kind"] = "expression"
            out["receiver"] = r[1]
    d, commas = 0, 0
    for i in range(len(before) - 1, -1, -1):
        x = before[i][1]
        if before[i][0] != "op":
            continue
        if x in (")", "]", "}"):
            d += 1
        elif x in ("(", "[", "{"):
            if d == 0:
                if x == "(" and i and before[i - 1][0] == "name" and last in ("(", ","):
                    name = before[i - 1][1]
                    if name in ("if", "while") and last == "(":
                        out["expected"], out["source"] = "bool", "condition"
                    elif name not in NOT_A_TYPE:
                        made = i > 1 and before[i - 2][1] == "new"
                        out["callee"], out["argument"] = ("new " if made else "") + name, commas
                break
            d -= 1
        elif x == "," and d == 0:
            commas += 1
        elif x == ";" and d == 0:
            break
    if last == "return" and member and not re.match(r"I(?:Async)?Enumer(?:able|ator)\b", member[1] or ""):
        out["expected"] = unwrapped(member[1], member[3])
        out["source"] = "return" if out["expected"] else None
    elif last == "=" and len(before) > 1 and before[-2][0] == "name":
        name = before[-2][1]
        declared = len(before) > 2 and (before[-3][0] == "name" and before[-3][1] not in NOT_A_TYPE or before[-3][1] in (">", "]", "?"))
        ty = local_types([*before, ("op", ";", 0, 0)]).get(name) if declared else names.get(name)
        out["expected"], out["source"] = (ty, "initializer" if declared else "assignment") if ty else (None, None)
    elif last == "=>" and scanner.top() == "type":
        keep = scanner.pending
        scanner.pending = [x for x in keep if x[2] < before[-1][2]]
        m = scanner.parsed()
        is_async = any(x[1] == "async" for x in scanner.pending)
        scanner.pending = keep
        if m:
            out["expected"] = unwrapped(m[0][2], is_async)
            out["source"] = "expression_body" if out["expected"] else None
    return out


def scanner_start(before: Sequence[Token], i: int, member: tuple | None) -> bool:
    """Whether the token is the name of the member around the caret, from where its locals are looked for."""
    return member is not None and before[i][1] == member[0] and i + 1 < len(before) and before[i + 1][1] in ("(", "{", "<")


DECLS = "repository_id string, file_id bigint, owner string, kind string, name string, type string, signature string, params array<struct<name:string,type:string>>, is_static boolean, position int"
FACTS = "sample_id string, repository_id string, enclosing_type string, member string, return_type string, receiver string, receiver_kind string, callee string, argument int, expected string, source string, locals array<struct<name:string,type:string>>"
_PAIRS = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))


def declarations(files: DataFrame) -> DataFrame:
    """files: (repository_id, file_id, content) of C# -> DECLS: what each file declares; bases come as kind base (type is the base)."""
    schema = pa.schema([("repository_id", pa.string()), ("file_id", pa.int64()), ("owner", pa.string()), ("kind", pa.string()), ("name", pa.string()), ("type", pa.string()), ("signature", pa.string()), ("params", _PAIRS), ("is_static", pa.bool_()), ("position", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for repo, i, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                s = Scanner()
                for t in lex(text):
                    if t[0] not in ("comment", "directive"):
                        s.feed(t)
                rows += [(repo, i, o, k, n, ty, sig, [{"name": a, "type": c} for a, c in ps], st, pos) for o, k, n, ty, sig, ps, st, pos in s.found]
                rows += [(repo, i, n, "base", base, base, None, [], False, 0) for n, base in s.bases]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 10, schema, strict=True)], schema=schema)

    return files.where("file_id is not null and content is not null").select("repository_id", "file_id", "content").mapInArrow(run, DECLS)


def caret_facts(files: DataFrame, samples: DataFrame) -> DataFrame:
    """files: (file_id, repository_id, content); samples: (sample_id, file_id, caret in code points) -> FACTS.

    The carets of a file are collected (as many as it has) and its tokens scanned once. A file that can't be scanned gives
    rows without facts, so that one bad file doesn't stop the run.
    """
    names = ["sample_id", "repository_id", "enclosing_type", "member", "return_type", "receiver", "receiver_kind", "callee", "argument", "expected", "source", "locals"]
    kinds = [pa.string()] * 8 + [pa.int32(), pa.string(), pa.string(), _PAIRS]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for repo, text, carets in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                try:
                    tokens = [t for t in lex(text) if t[0] not in ("comment", "directive")]
                    starts, s, fed = [t[2] for t in tokens], Scanner(), 0
                    for c in sorted(carets, key=lambda c: (c["caret"], c["sample_id"])):
                        n = bisect.bisect_left(starts, c["caret"])
                        while fed < n:
                            s.feed(tokens[fed])
                            fed += 1
                        f = facts_at(tokens, n, c["caret"], s)
                        rows.append((c["sample_id"], repo, *[f[k] for k in names[2:-1]], [{"name": a, "type": t} for a, t in f["locals"]]))
                except Exception as e:  # noqa: BLE001 - the reason is the record
                    done = {r[0] for r in rows}
                    rows += [(c["sample_id"], repo, *[None] * 8, f"failed:{type(e).__name__}", []) for c in carets if c["sample_id"] not in done]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(names), schema, strict=True)], schema=schema)

    per = samples.groupBy("file_id").agg(F.collect_list(F.struct("sample_id", "caret")).alias("carets"))
    return files.where("content is not null").join(per, "file_id").select("repository_id", "content", "carets").mapInArrow(run, FACTS)


#: The order of kinds among members.
KIND_ORDER = ["property", "field", "method", "event", "const", "constructor", "enum_value", "type"]


def member_order(used: Column, inherited: Column, kind: Column, name: Column) -> Column:
    """The sort key of members: used in the prefix first, own before inherited, by kind, by name in UTF-16 order."""
    return F.struct((~used).alias("unused"), inherited.alias("inherited"), F.array_position(F.array(*map(F.lit, KIND_ORDER)), kind).alias("kind"), F.encode(name, "UTF-16BE").alias("name"))


def simple(ty: Column) -> Column:
    """The bare name of a type: without arguments, arrays and nullability."""
    return F.regexp_extract(F.regexp_replace(ty, r"^.*\.(?=\w+)", ""), r"^(\w+)", 1)


def receiver_types(facts: DataFrame, decls: DataFrame) -> DataFrame:
    """(sample_id, repository_id, receiver_type, is_static) of carets behind a dot: the type of a local or parameter, of a member
    of the enclosing type, the enclosing type for this, or a type of the repository named itself."""
    f = facts.where("receiver is not null and receiver_kind <> 'expression'")
    own = F.element_at(F.filter("locals", lambda x: x["name"] == F.col("receiver")), 1)["type"]
    direct = F.when(F.col("receiver_kind") == "this", F.col("enclosing_type")).when(F.col("receiver_kind") == "type", F.col("receiver")).when(F.col("receiver_kind") == "local", own)
    members = decls.where("kind in ('field', 'property', 'const', 'parameter')").groupBy("repository_id", F.col("owner").alias("enclosing_type"), F.col("name").alias("receiver")).agg(F.min("type").alias("member_type"))
    types = decls.where("kind = 'type'").select("repository_id", F.col("name").alias("receiver"), F.lit(True).alias("is_type")).distinct()
    j = f.join(members, ["repository_id", "enclosing_type", "receiver"], "left").join(types, ["repository_id", "receiver"], "left")
    static = direct.isNull() & F.col("member_type").isNull() & F.col("is_type").isNotNull()
    ty = F.coalesce(direct, "member_type", F.when(F.col("is_type"), F.col("receiver")))
    return j.select("sample_id", "repository_id", simple(ty).alias("receiver_type"), static.alias("is_static"), F.col("locals.name").alias("used"))


def members_of(wanted: DataFrame, decls: DataFrame, type_column: str, most: int) -> DataFrame:
    """(sample_id, type, members): the members of a type and of its declared bases, overloads grouped, ranked and cut to ``most``.

    wanted: (sample_id, repository_id, type_column, used array<string>, is_static). Constructors and private parts can't be told
    apart by a lexer, so all members but constructors count.
    """
    bases = decls.where("kind = 'base'").select("repository_id", F.col("owner").alias("t"), F.col("type").alias("base")).distinct()
    own = wanted.select("sample_id", "repository_id", "used", "is_static", F.col(type_column).alias("type"), F.col(type_column).alias("holder"), F.lit(False).alias("inherited"))
    up = own.join(bases, (own["repository_id"] == bases["repository_id"]) & (own["type"] == bases["t"])).select("sample_id", own["repository_id"], "used", "is_static", "type", F.col("base").alias("holder"), F.lit(True).alias("inherited"))
    d = decls.where("kind not in ('type', 'base', 'constructor', 'parameter')").groupBy("repository_id", F.col("owner").alias("holder"), "kind", "name").agg(F.count(F.lit(1)).alias("overloads"), F.min("type").alias("member_type"), F.min("signature").alias("signature"), F.bool_or("is_static").alias("static"))
    j = own.union(up).join(d, ["repository_id", "holder"]).where("static = is_static or kind = 'enum_value' and is_static")
    order = member_order(F.array_contains("used", F.col("name")), F.col("inherited"), F.col("kind"), F.col("name"))
    fact = F.struct(order.alias("order"), "kind", "name", F.col("member_type").alias("type"), "signature", "overloads")
    # the members of one type: at most as many as its source declares
    return j.groupBy("sample_id", "type").agg(F.slice(F.array_sort(F.collect_list(fact)), 1, most).alias("m")).select("sample_id", "type", F.transform("m", lambda x: x.dropFields("order")).alias("members"))


def invocations(facts: DataFrame, decls: DataFrame, most: int = 10) -> DataFrame:
    """(sample_id, callee, argument, candidates): methods and constructors of the repository with the callee's name that take
    an argument at the place, by signature, with the parameter there."""
    f = facts.where("callee is not null").select("sample_id", "repository_id", "callee", "argument", F.regexp_replace("callee", "^new ", "").alias("name"), F.when(F.col("callee").startswith("new "), "constructor").otherwise("method").alias("kind"))
    d = decls.where("kind in ('method', 'constructor')").select("repository_id", "kind", "name", "signature", "params").distinct()
    j = f.join(d, ["repository_id", "name", "kind"]).where("argument = 0 or argument < size(params)")
    at = F.get("params", F.col("argument"))
    c = F.struct("signature", F.col("argument").alias("argument_index"), at["name"].alias("parameter_name"), at["type"].alias("parameter_type"))
    return j.groupBy("sample_id", "callee", "argument").agg(F.slice(F.array_sort(F.collect_set(c)), 1, most).alias("candidates"))


def context_types(facts: DataFrame, decls: DataFrame, prefix: DataFrame, most: int = 6) -> DataFrame:
    """(sample_id, type, source, place): types of the repository that matter at a caret: of locals and parameters, bases of the
    enclosing type, capitalised names of the prefix; the better source first, then names used in the prefix, then by name.

    prefix: (sample_id, names array<string>). The enclosing type itself isn't listed.
    """
    types = decls.where("kind = 'type'").select("repository_id", "name").distinct()
    f = facts.select("sample_id", "repository_id", "enclosing_type", "locals").join(prefix, "sample_id", "left")
    inner = F.flatten(F.transform("locals", lambda x: F.regexp_extract_all(x["type"], F.lit(r"([A-Za-z_]\w*)"), 1)))
    a = f.select("sample_id", "repository_id", "enclosing_type", "names", F.explode(inner).alias("name"), F.lit(0).alias("source"))
    b = f.select("sample_id", "repository_id", "enclosing_type", "names", F.explode(F.filter("names", lambda x: x.rlike("^[A-Z].+"))).alias("name"), F.lit(2).alias("source"))
    bases = decls.where("kind = 'base'").select("repository_id", F.col("owner").alias("enclosing_type"), F.col("type").alias("name")).distinct()
    c = f.select("sample_id", "repository_id", "enclosing_type", "names").join(bases, ["repository_id", "enclosing_type"]).select("sample_id", "repository_id", "enclosing_type", "names", "name", F.lit(3).alias("source"))
    seeds = a.union(b).union(c).where("name is not null and not (name <=> enclosing_type)").join(types, ["repository_id", "name"])
    best = seeds.groupBy("sample_id", "name").agg(F.min("source").alias("source"), F.bool_or(F.coalesce(F.array_contains("names", F.col("name")), F.lit(False))).alias("used"))
    w = W.partitionBy("sample_id").orderBy("source", F.desc("used"), F.encode("name", "UTF-16BE"))
    source = F.element_at(F.array(*map(F.lit, ("local", "member", "prefix", "base"))), F.col("source") + 1)
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("sample_id", F.col("name").alias("type"), source.alias("source"), "place")


def statuses(facts: DataFrame, receivers: DataFrame, calls: DataFrame) -> DataFrame:
    """(sample_id, status, reason): failed; partially_resolved without an enclosing symbol, with an unknown receiver or without
    candidates for a call; else resolved."""
    j = facts.join(receivers.select("sample_id", "receiver_type"), "sample_id", "left").join(calls.select("sample_id", F.lit(1).alias("called")), "sample_id", "left")
    reason = (
        F.when(F.col("source").startswith("failed:"), F.col("source"))
        .when(F.col("enclosing_type").isNull(), "no_enclosing_symbol")
        .when(F.col("receiver").isNotNull() & (F.coalesce("receiver_type", F.lit("")) == ""), "unknown_receiver")
        .when(F.col("callee").isNotNull() & F.col("called").isNull(), "no_invocation_candidates")
    )
    return j.select("sample_id", F.when(reason.startswith("failed:"), "failed").when(reason.isNotNull(), "partially_resolved").otherwise("resolved").alias("status"), reason.alias("reason"))


def fact_text(f: Column) -> Column:
    """A member as text: its signature with the number of further overloads, a bare name of types, else name:type."""
    more = F.when(f["overloads"] > 1, F.concat(F.lit(" (+"), (f["overloads"] - 1).cast("string"), F.lit(")"))).otherwise("")
    called = F.coalesce(f["signature"], F.when(f["kind"] == "constructor", "new()").otherwise(f["name"]))
    return F.when(f["kind"].isin("method", "constructor"), F.concat(called, more)).when(f["kind"].isin("type", "namespace"), f["name"]).otherwise(F.concat(f["name"], F.lit(":"), F.coalesce(f["type"], F.lit("?"))))


def project_edges(projects: DataFrame) -> DataFrame:
    """projects: (repository_id, path, text) of project files -> (repository_id, project, target): their references to other
    projects of the same repository, relative paths resolved, each once and none to itself."""
    inc = F.regexp_extract_all("text", F.lit(r"<ProjectReference\b[^>]*\bInclude\s*=\s*\"([^\"]+)\""), 1)
    p = projects.select("repository_id", F.col("path").alias("project"), F.explode(inc).alias("inc")).withColumn("inc", F.replace("inc", F.lit("\\"), F.lit("/")))
    parts = F.split(F.concat(F.regexp_extract("project", r"^(.*/)?[^/]*$", 1), "inc"), "/")
    step = lambda acc, x: F.when(x.isin("", "."), acc).when((x == "..") & (F.size(acc) > 0), F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.concat(acc, F.array(x)))
    target = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    known = projects.select("repository_id", F.col("path").alias("target")).distinct()
    return p.select("repository_id", "project", target.alias("target")).where("project <> target").distinct().join(known, ["repository_id", "target"], "left_semi").select("repository_id", "project", "target")
