"""Lexers that turn a source file into a string of token classes, one character per token.

Lexing is two passes at C speed: one regular expression splits the text into tokens, and one dictionary maps each
token to its class; only tokens seen for the first time run Python code. Classes (the same in all languages):

i name   q word that is also a name   n number   s string or character   k word that starts a declaration or statement
o word used as a binary operator   u word used as a prefix operator   w v j m f g l r A C E F K L M S T W Y words with followers of their own
p + -   d * &   h ^   b other binary operator   r <= >=   a assignment   x prefix ! ~   X postfix !   y ++ --   t arrow   D .. ... /
< > . , ; : ? ( ) [ ] { } themselves   N end of a line that counts   I O deeper and shallower indentation   e malformed token
1 try   2 if   3 finally   4 return   5 break, continue   6 for   7 function: known to the productions of C#, Go and JavaScript; to pairs they are k, k, w, u, j, k, k
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Words of each language by class.
CSHARP = {
    "L": "class",
    "S": "switch",
    "k": "abstract const delegate do enum event explicit extern fixed foreach implicit interface internal lock namespace override private protected public readonly sealed static struct unsafe using virtual volatile while",
    "o": "as is operator",
    "u": "await new throw out ref in params case",
    "w": "else",
    "1": "try",
    "2": "if",
    "3": "finally",
    "4": "return",
    "5": "break continue",
    "6": "for",
    "v": "catch",
    "q": "add alias and ascending async by descending equals field file from get global group init into join let managed nameof not notnull on or orderby partial record remove required scoped select set unmanaged var when where with yield",
    "j": "goto default",
    "i": "base bool byte char checked decimal double false float int long null object sbyte short sizeof stackalloc string this true typeof uint ulong unchecked ushort void",
}
GO = {
    "k": "const func go import interface map package select struct switch type var defer chan",
    "u": "case goto",
    "w": "else",
    "2": "if",
    "6": "for",
    "r": "range",
    "j": "break continue fallthrough default return",
}
JS = {
    "L": "class",
    "k": "const do enum import switch var while",
    "6": "for",
    "7": "function",
    "W": "with",
    "o": "instanceof in",
    "u": "await new throw return typeof void delete case yield",
    "q": "as async from get let of set static",
    "w": "else",
    "1": "try",
    "2": "if",
    "3": "finally",
    "v": "catch",
    "E": "extends",
    "j": "break continue debugger default",
    "m": "export",
    "i": "false null super this true",
}
PYTHON = {
    "k": "del global import nonlocal",
    "C": "class def",
    "K": "while with",
    "l": "if for",
    "Y": "try",
    "q": "case match type",
    "o": "and or is in",
    "u": "assert await raise return yield lambda",
    "h": "not",
    "w": "else finally",
    "v": "except elif",
    "j": "break continue pass",
    "f": "from as",
    "g": "async",
    "i": "False None True",
}
OPERATORS = {"p": "+ -", "b": "/ % | || && == != ?? === !== << >> >>> &^", "d": "* & **", "h": "^", "r": "<= >=", "a": "= += -= *= /= %= ^= |= &= ??= := <<= >>= >>>= **= &&= ||= &^=", "x": "! ~", "y": "++ --", "t": "=> ->"}


class Classes(dict):
    """Token -> class, filled as tokens are met and emptied when large."""

    def __init__(self, words: dict[str, str], other: Callable[[str], str]):
        self.fixed = {w: c for c, ws in words.items() for w in ws.split()} | {o: c for c, ops in OPERATORS.items() for o in ops.split()} | {c: c for c in "<>.,;:?()[]{}"}
        self.other = other
        super().__init__(self.fixed)

    def __missing__(self, token: str) -> str:
        c = self.other(token)
        if len(token) < 40:
            if len(self) > 300_000:
                self.clear()
                self.update(self.fixed)
            self[token] = c
        return c


#: Lines of conflict markers: a token of their own, tried only where a text has one, as it slows the lexer down.
CONFLICT = r"^(?:<{7}|>{7}|\|{7})(?=[ \t\r\n]|$)[^\n]*|^={7}(?=\r?$)"


class Lexer:
    """Splits a text into tokens."""

    def __init__(self, pattern: str, flags: int):
        self.plain, self.marked = re.compile(pattern, flags), re.compile(f"{CONFLICT}|{pattern}", flags)

    def findall(self, text: str) -> list[str]:
        return (self.marked if "<<<<<<<" in text or ">>>>>>>" in text or "=======" in text else self.plain).findall(text)


def name_or_number(t: str) -> str:
    c = t[0]
    if len(t) > 6 and c in "<>|=":
        return "e"
    if c.isalpha() or c in "_$@":
        return "i"
    if c.isdigit() or (c == "." and len(t) > 1):
        return "n"
    return "e"


# --- C#

CS_HOLE = r"(?:[^{}\"\n]|\"(?:[^\"\\\n]|\\.)*\"|\{[^{}\n]*\})*"
CS_TOKEN = Lexer(
    rf'@?[^\W\d]\w*|[.,;()\[\]{{}}](?<![.][.])(?![.\d])|//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/|/\*|\$*"""+(?!").*?(?<!")"""+|(?:\$@|@\$)"(?:[^"{{]|""|\{{\{{|\{{{CS_HOLE}\}})*"|@"(?:[^"]|"")*"|\$"(?:[^"\\\n{{]|\\.|\{{\{{|\{{{CS_HOLE}\}})*"|"(?:[^"\\\n]|\\.)*"(?:u8)?|\'(?:[^\'\\\n]|\\[^\n][0-9A-Fa-f]{{0,8}})\'|(?<=[\w)\]>])!(?!=)|(?:0[xX][\da-fA-F_]+|0[bB][01_]+|\d[\d_]*(?:\.\d[\d_]*)?(?:[eE][+-]?\d+)?|\.\d[\d_]*(?:[eE][+-]?\d+)?)[fFdDmMuUlL]{{0,2}}\b|\?\?=|<<=|\?\?|=>|->|\+\+|--|&&|\|\||==|!=|<=|[-+*/%^|&]=|>=(?!>)|::|\.\.|\?\.(?!\d)|[-+*/%^|&=!~<>.,;:?()\[\]{{}}]|\S',
    re.S | re.M,
)


def cs_other(t: str) -> str:
    c = t[0]
    if c in "\"'":
        return "s" if len(t) > 1 else "e"
    if t.startswith(("//", "/*")):
        return "e" if t == "/*" else ""
    if c in "$@" and '"' in t:
        return "s"
    return {"?.": ".", "::": ".", "..": "D"}.get(t) or name_or_number(t)


CS_CLASSES = Classes(CSHARP, cs_other)
DIRECTIVE = re.compile(r"^[ \t]*#[ \t]*(\w*)[ \t]*([^\r\n]*)", re.M)


def condition(text: str) -> bool:
    """A directive's condition with no symbols defined."""
    t = re.sub(r"//.*", "", text)
    t = re.sub(r"\b(?!true\b|false\b)[A-Za-z_]\w*", "false", t).replace("&&", " and ").replace("||", " or ")
    t = re.sub(r"!(?!=)", " not ", t).replace("true", "True").replace("false", "False")
    if not re.fullmatch(r"[\sa-zTF()=!]*", t):
        return False
    try:
        return bool(eval(t, {"__builtins__": {}}))  # noqa: S307 - only the constants, operators and brackets matched above
    except Exception:
        return False


def preprocessed(text: str) -> tuple[str, bool]:
    """C# without its directive lines and the parts they disable; and whether the directives match."""
    if "#" not in text:
        return text, True
    out, at, stack, good, regions = [], 0, [], True, 0
    live = lambda: all(s[0] for s in stack)
    spans = [(m.start(), m.end(), m.group(1), m.group(2)) for m in DIRECTIVE.finditer(text)]
    if not any(w in ("if", "elif", "else", "endif", "region", "endregion") or w for _, _, w, _ in spans):
        return text, True
    known = {"if", "elif", "else", "endif", "region", "endregion", "pragma", "nullable", "define", "undef", "line", "error", "warning", "r", "load"}
    for a, b, word, rest in spans:
        if word not in known:
            continue
        if live():
            out.append(text[at:a])
        if word == "if":
            on = condition(rest)
            stack.append([on, on])
        elif word in ("elif", "else", "endif"):
            if not stack:
                good = False
            elif word == "endif":
                stack.pop()
            else:
                on = not stack[-1][1] and (word == "else" or condition(rest))
                stack[-1] = [on, stack[-1][1] or on]
        elif word == "region":
            regions += live()
        elif word == "endregion":
            regions -= live()
        at = b
    if live():
        out.append(text[at:])
    return "".join(out), good and not stack and regions == 0


def csharp(text: str) -> str:
    text, good = preprocessed(text)
    return "".join(map(CS_CLASSES.__getitem__, CS_TOKEN.findall(text))) + ("" if good else "e")


# --- Go

GO_TOKEN = Lexer(
    rf"[^\W\d]\w*|[,;()\[\]{{}}]|\n|//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/|/\*|\"(?:[^\"\\\n]|\\.)*\"|`[^`]*`|'(?:[^'\\\n]|\\[^\n][0-9A-Fa-f]{{0,8}})'|[^\W\d]\w*|(?:0[xX][\da-fA-F_]+|0[bB][01_]+|0[oO][0-7_]+|\d[\d_]*(?:\.[\d_]*)?(?:[eE][+-]?\d+)?|\.\d[\d_]*(?:[eE][+-]?\d+)?)i?(?!\w)|<-|&\^=|<<=|>>=|&\^|<<|>>|\+\+|--|&&|\|\||==|!=|<=|>=|:=|\.\.\.|[-+*/%^|&]=|[-+*/%^|&=!~<>.,;:()\[\]{{}}]|\S",
    re.M,
)


def go_other(t: str) -> str:
    c = t[0]
    if t == "\n":
        return "N"
    if c in "\"'`":
        return "s" if len(t) > 1 else "e"
    if t.startswith("//"):
        return ""
    if t.startswith("/*"):
        return "e" if t == "/*" else ("N" if "\n" in t else "")
    return {"<-": "A", "...": "D"}.get(t) or name_or_number(t)


GO_CLASSES = Classes(GO, go_other)
GO_CLASSES.fixed["interface"] = GO_CLASSES["interface"] = "T"
GO_CLASSES.fixed["struct"] = GO_CLASSES["struct"] = "T"
GO_CLASSES.fixed["map"] = GO_CLASSES["map"] = "M"
GO_CLASSES.fixed["chan"] = GO_CLASSES["chan"] = "C"
GO_CLASSES.fixed["func"] = GO_CLASSES["func"] = "F"
GO_STOP = re.compile(r"(?<=[insjy)\]}])N")


def go(text: str) -> str:
    """Newlines after a token that may end a statement become ; and all others go."""
    cs = "".join(map(GO_CLASSES.__getitem__, GO_TOKEN.findall(text + "\n")))
    return re.sub("N+", "", GO_STOP.sub(";", re.sub("N+", "N", cs)))


# --- JavaScript

JS_TEMPLATE = r"`(?:[^`\\$]|\\.|\$(?!\{)|\$\{(?:[^{}`]|\{[^{}]*\}|`[^`]*`)*\})*`"
JS_REGEX = r"/(?![*/])(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*"
JS_TOKEN = Lexer(
    rf"(?:[^\W\d]|[$#](?=[\w$]))[\w$]*|[,;()\[\]{{}}]|\n|//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/|/\*|\"(?:[^\"\\\n]|\\(?:\r\n|[\s\S]))*\"|'(?:[^'\\\n]|\\(?:\r\n|[\s\S]))*'|{JS_TEMPLATE}|(?:(?<=[(,=:\[!&|?{{}};\n+>])|(?<=return))[ \t]*{JS_REGEX}|(?:[^\W\d]|[$#](?=[\w$]))[\w$]*|(?:0[xX][\da-fA-F_]+|0[bB][01_]+|0[oO][0-7_]+|\d[\d_]*(?:\.[\d_]*)?(?:[eE][+-]?\d+)?|\.\d[\d_]*(?:[eE][+-]?\d+)?)n?(?![\w$])|>>>=|\.\.\.|===|!==|\*\*=|<<=|>>=|>>>|&&=|\|\|=|\?\?=|=>|\*\*|<<|>>|\+\+|--|&&|\|\||\?\?|\?\.(?!\d)|==|!=|<=|>=|[-+*/%^|&]=|[-+*/%^|&=!~<>.,;:?()\[\]{{}}]|\S",
    re.M,
)


def js_other(t: str) -> str:
    c = t[0]
    if t == "\n":
        return "N"
    if c in "\"'`":
        return "s" if len(t) > 1 else "e"
    if t.startswith("//"):
        return ""
    if t.startswith("/*"):
        return "e" if t == "/*" else ("N" if "\n" in t else "")
    if len(t) > 2 and t.lstrip()[0] == "/":
        return "s"
    if c in "$#" and len(t) > 1:
        return "i"
    return {"?.": ".", "...": "D"}.get(t) or name_or_number(t)


JS_CLASSES = Classes(JS, js_other)
JS_BREAK = re.compile(r"(?<=[insjy)\]}])N+(?=[^-+*/.,;:?=)\]})(\[abptoD<>&|N])")


def javascript(text: str) -> str:
    """A newline between two tokens that can't go on from one another ends the statement (;), all others go."""
    cs = "".join(map(JS_CLASSES.__getitem__, JS_TOKEN.findall(text)))
    return JS_BREAK.sub(";", cs).replace("N", "")


# --- Python

PY_STRING = r"(?:[rRbBuUfF]{0,2})(?:\"\"\"(?:[^\"\\]|\\[\s\S]|\"(?!\"\"))*\"\"\"|'''(?:[^'\\]|\\[\s\S]|'(?!''))*'''|\"(?:[^\"\\\n]|\\[\s\S])*\"|'(?:[^'\\\n]|\\[\s\S])*')"
PY_TOKEN = Lexer(
    rf"\#[^\n]*|\\\r?\n[ \t]*|\n[ \t]*|{PY_STRING}|[^\W\d]\w*|(?:0[xX][\da-fA-F_]+|0[bB][01_]+|0[oO][0-7_]+|0[0_]*(?![\d.])|(?:[1-9][\d_]*|0(?=\.)|0+(?=[eEjJ.]))(?:\.[\d_]*)?(?:[eE][+-]?\d+)?|\.\d[\d_]*(?:[eE][+-]?\d+)?)[jJ]?(?!\w)|\*\*=|//=|<<=|>>=|\.\.\.|->|:=|\*\*|//|<<|>>|==|!=|<=|>=|[-+*/%^|&@]=|[-+*/%^|&@=~<>.,;:()\[\]{{}}]|\S",
    re.M,
)


def py_other(t: str) -> str:
    c = t[0]
    if c == "#" or c == "\\":
        return "" if c == "#" or len(t) > 1 else "e"
    if t[-1] in "\"'":
        return "s" if len(t) > 1 else "e"
    return {"...": "i", ":=": "o", "/": "D", "//": "b", "@": "H", "//=": "a", "@=": "a"}.get(t) or name_or_number(t)


PY_CLASSES = Classes(PYTHON, py_other)
PY_CLASSES.fixed["/"] = PY_CLASSES["/"] = "D"


def python(text: str) -> str:
    """Logical lines end with N; I and O stand for a deeper and a shallower indentation; a dedent that fits no block is e."""
    text = text.lstrip("﻿")
    out: list[str] = []
    depth, stack, start, indent = 0, [0], True, ""
    for t in ["\n" + re.match(r"[ \t]*", text).group(), *PY_TOKEN.findall(text), "\n"]:
        if t[0] == "\n":
            if depth == 0:
                if not start:
                    out.append("N")
                    start = True
                indent = t[1:]
            continue
        c = PY_CLASSES[t]
        if not c:
            continue
        if start:
            start = False
            w = len(indent.expandtabs(8))
            if w > stack[-1]:
                stack.append(w)
                out.append("I")
            else:
                while w < stack[-1]:
                    stack.pop()
                    out.append("O")
                if w != stack[-1]:
                    out.append("e")
        if c in "([{":
            depth += 1
        elif c in ")]}":
            depth = max(0, depth - 1)
        out.append(c)
    if depth and out and out[-1] != "N":
        out.append("N")
    out.append("O" * (len(stack) - 1))
    return "".join(out)


# --- JSON

JSON_TOKEN = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.])|(?:true|false|null)(?!\w)|[{}\[\],:]|[^ \t\r\n]', re.A)


def json_class(t: str) -> str:
    c = t[0]
    if c == '"' and len(t) > 1:
        return "s"
    if t in ("true", "false", "null") or ((c.isdigit() or c == "-") and t[-1].isdigit()):
        return "n"
    return c if c in "{}[],:" and len(t) == 1 else "e"


def json(text: str) -> str:
    return "".join(map(json_class, JSON_TOKEN.findall(text)))


LANGUAGES: dict[str, tuple[str, Callable[[str], str]]] = {"cs": ("csharp", csharp), "go": ("go", go), "js": ("javascript", javascript), "py": ("python", python), "json": ("json", json)}
