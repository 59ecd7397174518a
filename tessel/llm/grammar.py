"""Which token classes may follow one another in each language, and productions over the levels of a file.

The classes are those of the lexers. ``FOLLOW`` lists for each class what may come next; ^ is the start of the file and
$ its end. A pair that isn't listed occurs in no valid file. What pairs can't see is left to nesting and to the
productions: conditions over a level, which is what a pair of brackets holds, with each inner pair reduced to one symbol.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPERAND = "iqns(["

# Followers by class, for each language.
CSHARP = {
    "L": "iq{,;?",
    "S": "({",
    "^": "Lkiq([{;uj$xy",
    "i": "iq.()[]{}<>,;:?abpotydrhXuD",
    "q": "iq.()[]{}<>,;:?abpotydrhXuDsnkx",
    "n": ")]},;:?bpot.drh<>qDyX",
    "s": ")]},;:?bpot.[qdrhX<>",
    "k": "Likq({[<:;u?,dxX",
    "u": OPERAND + "{;upxykq):,jr<>hdtD]",
    "j": ";:(iqju),]?}o",
    "w": "{kiuqjy;(dx",
    "v": "({q",
    "a": OPERAND + "{uxpykdhjD",
    "b": OPERAND + "uxpydhjk{",
    "r": OPERAND + "uxpydhj",
    "h": OPERAND + "uxpydj",
    "d": OPERAND + "uxpydj),>kh",
    "p": OPERAND + "uxpydhj",
    "x": OPERAND + "xpyudj=" + ".);,]}:?ab",
    "X": ".),;[(]}:?abpotydrh<>DqX",
    "y": "iq();],}.bpo:?rdh<>[tu",
    "t": OPERAND + "{uxpykdjhD",
    ".": "iq[k",
    ",": OPERAND + "],>}{uxpykdjDhr<",
    ";": "ikqu([{};jvnysdxw$)<",
    ":": OPERAND + "{kujxpydhDr<>;",
    "?": OPERAND + "),>;{}].uxpy?djbartok",
    "(": OPERAND + "){uxpykdj;Dhr<>",
    ")": "iq;{}),.[(?:abpotydrhX<>ukjnsxDw]",
    "[": OPERAND + "]{,uxpykdjDhr<>",
    "]": "iq;{}),.[(]?:abpotydrhX<>kuD$j",
    "{": OPERAND + "};{xpydhDukjr<",
    "}": "ikqujwv;}),.[(]{?:abptxyd$oXhrD>",
    "<": "iq(>,[?npsuxydkDj<h",
    ">": "iqns()[]{},.;:?>pbotyxudXDjkrah",
    "D": "iq(n[])h,}:s;",
    "o": OPERAND + "{uxpbdrh<>ykj",
}
GO = {
    "^": "k;",
    "k": "i({FsrxAnpd[;MTC)",
    "i": "i.()[]{},;:abpydrh<>DTMCFAs",
    "n": ")]},;:bpdrh<>{",
    "s": ")]},;:bpdrh<>{[.(",
    "u": OPERAND + "xpdAMCFTh;",
    "w": "{k",
    "r": OPERAND + "MdFATxph",
    "j": OPERAND + ";{dpxFAMTC:}uh",
    "T": "{",
    "M": "[",
    "C": "i[MdTFAC(",
    "F": "(i",
    "A": OPERAND + "CFTMdAxph",
    "D": "i[dFTMC){](,:A",
    "a": OPERAND + "dpxhFAMTCr",
    "b": OPERAND + "dpxhFAM",
    "r>": "",
    "h": OPERAND + "dpxhFA",
    "d": OPERAND + "dpxhFAMTC)",
    "p": OPERAND + "dpxhFA",
    "x": OPERAND + "xAMTFCdph",
    "y": ";{)}",
    ".": "i(",
    ",": OPERAND + "])}{dpxhFAMTCDk",
    ";": "ikuj;})$s(FAd[{xTMC",
    ":": OPERAND + "]kju;}{dpxhFAMTC:",
    "(": OPERAND + ")dpxhFAMTCkD{;",
    ")": ";i()[]{},.:bpadrh<>ysTMCFADC",
    "[": OPERAND + "]:dMTxpFACDh",
    "]": "i.()[]{},;:abpdrh<>yTMCFDAs",
    "{": OPERAND + "};{kujFAdxpMTCh",
    "}": ";)]},.([{:bpdrhwsa$i",
    "<": OPERAND + "dpxhAF",
    ">": OPERAND + "dpxhAF",
}
JAVASCRIPT = {
    "L": "iq{E",
    "E": "iq({[sun",
    "^": "kmujxyp$nD{;" + OPERAND,
    "i": ".()[]{},;:?abpotydrh<>q$",
    "q": ".()[]{},;:?abpotydrh<>q$isnkuxD",
    "n": ")]},;:?bpodrh<>.$",
    "s": ")]},;:?bpodrh<>.[q$(aW",
    "W": "({",
    "k": "i({[qsd.xpknuv:;,",
    "u": OPERAND + "{;upxykdq)].h:,}",
    "w": "{kiujq(y;xs[nd",
    "v": "({iqu",
    "j": ";}i:({[kusnqxp,jym",
    "m": "kj{dqu",
    "o": OPERAND + "{uxpkyh",
    "a": OPERAND + "{uxpyk",
    "b": OPERAND + "{uxpyk",
    "r": OPERAND + "{uxpyk",
    "h": OPERAND + "{uxpyk",
    "d": OPERAND + "{uxpyk",
    "p": OPERAND + "{uxpyk",
    "x": OPERAND + "{uxpyk",
    "y": "iq()],;}:?bpo.drh<>[$u",
    "t": OPERAND + "{uxpkyd",
    "D": OPERAND + "{ukxpy",
    ".": "iqkuwvjmo[(",
    ",": OPERAND + "])}{uxpyk,Ddjm",
    ";": OPERAND + "{}kujm;$xywpdD)v",
    ":": OPERAND + "{uxpykj};D",
    "?": OPERAND + "{uxpyk.D",
    "(": OPERAND + "){uxpyk;D",
    ")": ";{}),.[(]?:abpotydrh<>iqkujxwsv$n",
    "[": OPERAND + "]{uxpyk,D",
    "]": ";{}),.[(]?:abpoydrh<>q$tku",
    "{": OPERAND + "}{;ukjxypDdmwv",
    "}": OPERAND + "{}),.;:?bpodrhaukjmwvxyt$]<>",
    "<": OPERAND + "{uxpyk",
    ">": OPERAND + "{uxpyk",
}
PYTHON = {
    "C": "iq",
    "^": "ikKlYusfNjHg([{nxpqhO$d",
    "i": ".()[],:abpodDrh<>NkKlwftHg;",
    "q": ".()[],:abpodDrh<>NklwftHg;ins{xu",
    "n": ")],}:bpodDrh<>Nklwf;gH",
    "s": ")],}:bpodDrh<>Nklwf;gs.[H",
    "k": "i([d.q",
    "K": OPERAND + "{hpxudq:",
    "l": OPERAND + "{hpxudq",
    "Y": ":",
    "u": OPERAND + "{hpxuN:f)],;d",
    "h": OPERAND + "{hpxuo",
    "w": OPERAND + ":{hpxu",
    "v": OPERAND + "{hpxu:d",
    "j": "N;",
    "f": "i.([qnsu{p",
    "g": "KlC",
    "o": OPERAND + "{hpxud",
    "p": OPERAND + "{pxu",
    "x": OPERAND + "{pxu",
    "b": OPERAND + "{pxu",
    "r": OPERAND + "{pxu",
    "<": OPERAND + "{pxu",
    ">": OPERAND + "{pxu",
    "H": OPERAND + "{pxu",
    "d": OPERAND + "{pxu,)N:",
    "D": OPERAND + "{pxu,):",
    "a": OPERAND + "{hpxudg",
    "t": OPERAND + "{",
    ".": "iqk.",
    ",": OPERAND + ")]}{hpxudDNao:;",
    ";": "ikunNjfsqh([{px",
    ":": OPERAND + "])N{hpxudjk,aYK}l:",
    "(": OPERAND + "){hpxud",
    ")": ")],}.([:bpodDrh<>NklwftaH;g",
    "[": OPERAND + "]{hpxud:",
    "]": ")],}.([:bpodDrh<>NklwftaH;g",
    "{": OPERAND + "}{hpxud",
    "}": ")],}.([:bpodDrh<>Nklwfa;g",
    "N": OPERAND + "kKlYufNjHg{xpIOwv$hd",
    "I": OPERAND + "kKlYufjHg{xphd",
    "O": OPERAND + "kKlYufjHg{xphwvO$d",
}
JSON = {"^": "{[sn", "s": ":,}]$", "n": ",}]$", "{": "s}", "}": ",}]$", "[": "{[sn]", "]": ",}]$", ",": "{[sn", ":": "{[sn"}

#: An unmatched lone follower set of Go: <= and >= share a class with nothing else there.
GO["r"] = "".join(dict.fromkeys(GO["r"] + GO.pop("r>") + OPERAND + "dpxhFAM"))

for _rows in (CSHARP, JAVASCRIPT):  # class comes where other such words come
    for _a in [a for a, bs in _rows.items() if "k" in bs]:
        _rows[_a] += "L"
for _a in [a for a, bs in JAVASCRIPT.items() if "k" in bs]:  # with: a statement, or after the name of a module
    JAVASCRIPT[_a] += "W"
for _a in CSHARP:  # switch: a statement, or after an operand
    if "k" in CSHARP[_a] or _a in "iqns)]}>yX":
        CSHARP[_a] += "S"
for _a in "iq>":
    JAVASCRIPT[_a] += "E"
for _a in "^NIO":
    PYTHON[_a] += "C"

FOLLOW: dict[str, dict[str, str]] = {"csharp": CSHARP, "go": GO, "javascript": JAVASCRIPT, "python": PYTHON, "json": JSON}


def permissible() -> list[tuple[str, str]]:
    """(language, pair) rows of all that may follow one another."""
    return sorted({(lang, a + b) for lang, rows in FOLLOW.items() for a, bs in rows.items() for b in bs})


#: Classes that only productions tell apart, as pairs know them.
PLAIN = str.maketrans("1234567", "kkwujkk")


def pairs(cs: str) -> set[str]:
    cs = cs.translate(PLAIN)
    return {a + b for a, b in zip("^" + cs, cs + "$", strict=True)}


#: Brackets of all languages; Python's indentation opens (I) and closes (O) too. $ closes the file.
OPEN, CLOSE = "([{I", ")]}O"

# Symbols of reduced brackets: () \x01, [] \x02, {} \x03, {} that ends as an expression does \x04 (C# only), Python's block Z.
B = r"[\x03\x04]"
#: By language: what no brace level and no file of it has. C#: a statement without ; at the end of the body, after return, break
#: or continue, in the block of a statement or method, and before another name; an if without a statement; a class without a name; a declaration
#: word alone; three names in a row; an initializer that goes on. Go: headers of if and for, two names at the start.
BODY = {
    "csharp": rf"4[^;]*$|5(?!;)|(?:[26k]\x01|[13w]|v\x01?)\x04|(?:^|[;\x03])\x02*k[kqi<>.,?\x02]*i\x01\x04|;(?:.*[^;\x03\x04])$|2\x01[w;](?=w)|2\x01w|(?<![:,])L{B}|(?:^|[;\x03\x04])k;|iii|a{B}[iqnk]",
    "go": r"[26][^\x03]*$|2[^;\x03F]*;[^;\x03F]*;|6[^;\x03F]*;[^;\x03F]*\x03",
    "javascript": r"(?:^|[;\x03])i(?:\.i)*\x01i|2\x01w|(?:^|[;\x03])q?7d?\x01",
}
CALLS = r"(?:^|[;\x03])i(?:\.i)*\x01i"
#: A try with its handlers, and what is left of one without.
TRY = {"csharp": rf"1{B}(?:(?:v\x01?(?:q\x01)?{B})+(?:3{B})?|3{B})", "javascript": r"(?<!\.)1\x03(?:v\x01?\x03(?:3\x03)?|3\x03)"}
#: JavaScript: what stands in no body of a class or object, where methods may be named catch; and handlers without try.
STATEMENT = r"(?:^|[;\x03])(?:[k67][iq\x02\x03]|i(?:\.[a-z0-9])*\x01;|i(?:\.[a-z0-9])+a|u[iqns])"
#: Python lines: a compound statement without a colon, an assignment as its condition, a call as the target of an assignment.
PY_LINE = r"(?:^|[NZ])(?:g?[KlC]|[wvY])[^N:]*N|(?:^|[NZ])g?[lKv][^N:u]*a|(?:^|[NZ])[iq.\x01\x02]*[iq\x01\x02]\x01a"
#: Python arguments: a plain one after one by keyword, or a parameter without a default after one with; a call as keyword.
PY_KEYWORD = r"[iq](?::[^,a]*)?a[^,]*,[^,ad:D][^,a]*(?:,|$)"
PY_PARAMETER, PY_ARGUMENT = rf"^(?:[^d]*,)?{PY_KEYWORD}", rf"(?:^|,){PY_KEYWORD}|(?:^|,)[iq.\x01\x02]*[iq]\x01a"
JSON_VALUE = r"[sn\x02\x03]"


def placeholder(kind: Column, run: Column, before: Column, language: Column) -> Column:
    """The symbol of a closed bracket: its kind, and whether what it ends with is a statement (run: the tokens before it
    since the bracket ``before``)."""
    whole = F.endswith(run, F.lit(";")) | ((run == "") & before.isin("{", "}")) | (language != "csharp")
    return F.when(kind == ")", "\x01").when(kind == "]", "\x02").when(kind == "O", "Z").when(kind == "}", F.when(whole, "\x03").otherwise("\x04")).otherwise("")


def row_fault(language: Column, run: Column, bracket: Column, before: Column, run_before: Column, before_that: Column) -> Column:
    """Productions that a bracket and its neighbours decide: Python's blocks stand after : at a line's end, and only there;
    braces that open twice where no block can stand."""
    ends = F.endswith(run, F.lit(":N"))
    block = (bracket == "I") != ends
    twice = (bracket == "{") & (run == "") & (before == "{")
    at = F.coalesce(run_before, F.lit(""))
    never = F.when(language == "csharp", at.rlike("(?:^|;)u$")).when(language == "javascript", at.rlike(r"(?:L[iq]?(?:E.*)?|[abpxu,])$") | ((at == "") & (before_that == "(")))
    return F.when(language == "python", block | run.rlike(":N(?!$)")).when(twice, never).otherwise(F.lit(False))


def unbalanced_else(s: Column) -> Column:
    """Whether a level has more else than if before it; levels without an else cost nothing."""
    marks = F.regexp_extract_all(s, F.lit(r"((?<!\.)2(?!:)|(?:^|(?<=[;\x03\x04]))w(?![:\x01,=]))"), 1)
    low = F.aggregate(marks, F.struct(F.lit(0).alias("n"), F.lit(0).alias("low")), lambda a, x: F.struct((a["n"] + F.when(x == "2", 1).otherwise(-1)).alias("n"), F.least(a["low"], a["n"] + F.when(x == "2", 1).otherwise(-1)).alias("low")))
    return F.when(F.contains(s, F.lit("w")), low["low"] < 0).otherwise(F.lit(False))


def level_fault(language: Column, level: Column, opener: Column, head: Column, s: Column) -> Column:
    """Whether a level breaks a production. head: the last two classes before the bracket that opens it."""
    body = (opener == "{") | (level == 0)
    tried = lambda lang: F.regexp_replace(s, TRY[lang], "\x03;" if lang == "javascript" else "\x03")
    has = lambda *xs: F.lit(False) if not xs else F.contains(s, F.lit(xs[0])) | has(*xs[1:])
    header = (opener == "(") & F.when(F.endswith(head, F.lit("6")), ~s.rlike("^[^;]*;[^;]*;[^;]*$")).otherwise(has(";"))
    cs_try = F.when(has("1", "v", "3"), tried("csharp").rlike(rf"[v3]|1{B}")).otherwise(F.lit(False))
    csharp = F.when(body, s.rlike(BODY["csharp"]) | unbalanced_else(s) | cs_try | (has(";") & s.rlike(CALLS))).otherwise(header)
    js_rest = tried("javascript")
    js_try = F.when(has("1", "v", "3"), js_rest.rlike(r"(?<!\.)(?:3\x03|v\x03|1\x03)") | (js_rest.rlike(r"\x03v\x01\x03") & js_rest.rlike(STATEMENT))).otherwise(F.lit(False))
    js_for = (opener == "(") & F.when(F.endswith(head, F.lit("6")), ~s.rlike("^[^;]*;[^;]*;[^;]*$|^[^;]*[oq][^;]*$")).otherwise(has(";"))
    javascript = F.when(body, s.rlike(BODY["javascript"]) | unbalanced_else(s) | js_try).otherwise(js_for)
    top = (level == 0) & (~s.rlike("^;*ki;") | s.rlike("(?:^|;)[^;kF]"))
    go = F.when(body, s.rlike(BODY["go"]) | unbalanced_else(s) | top | ((opener == "{") & ~F.endswith(head, F.lit("T")) & s.rlike("(?:^|;)ii"))).otherwise(F.lit(False))
    blocks = F.regexp_replace(F.regexp_replace(s, ":NZ", ":Z"), ":(?!Z)[^NZ]*N", ":Z")
    lines = s.rlike(PY_LINE) | F.when(F.contains(s, F.lit("v")) | F.contains(s, F.lit("w")) | F.contains(s, F.lit("Y")), blocks.rlike("Y:Z(?![vw])|(?:^|N)[vw]")).otherwise(F.lit(False))
    python = F.when((level == 0) | (opener == "I"), lines).when(opener == "(", ~has("u", "l") & F.when(head == "Ci", s.rlike(PY_PARAMETER)).otherwise(s.rlike(PY_ARGUMENT))).otherwise(F.lit(False))
    member = rf"s:{JSON_VALUE}"
    json = F.when(level == 0, ~s.rlike(f"^{JSON_VALUE}$")).when(opener == "{", ~s.rlike(f"^(?:{member}(?:,{member})*)?$")).otherwise(~s.rlike(f"^(?:{JSON_VALUE}(?:,{JSON_VALUE})*)?$"))
    return F.when(language == "csharp", csharp).when(language == "go", go).when(language == "javascript", javascript).when(language == "python", python).otherwise(json)
