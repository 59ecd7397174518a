"""Column functions over text: hashes, offsets in UTF-16 units and bytes, lines, paths, names and tokens."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Line breaks, inline white space, word tokens and names.
LINE_BREAK = r"\r\n|[\r\n\u0085  ]"
INLINE_SPACE = r"[\t\x0b\f    -   　]*"
TOKEN = r"[A-Za-z_][A-Za-z0-9_]*|[0-9]+|[^\sA-Za-z0-9_]"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"


def joined(*parts: Column) -> Column:
    """Parts as text with a unit separator between them; a null counts as empty, as concat_ws would drop it."""
    return F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def stable_id(*parts: Column) -> Column:
    return F.substring(F.sha2(joined(*parts), 256), 1, 32)


def uniform(*parts: Column) -> Column:
    """A double in [0, 1): the top 53 bits of the first 8 bytes, big-endian, of the parts' SHA-256."""
    top = F.conv(F.substring(F.sha2(joined(*parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.floor(top / F.lit(2048)).cast("bigint") / F.lit(9007199254740992.0)


def uniform_le(*parts: Column) -> Column:
    """The little-endian kin of ``uniform``: the first 8 bytes as a little-endian integer over 2**64."""
    h = F.sha2(joined(*parts), 256)
    turned = F.concat(*[F.substring(h, 2 * i + 1, 2) for i in range(7, -1, -1)])
    return F.conv(turned, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def utf16_len(c: Column) -> Column:
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def utf16_slice(c: Column, start: Column, n: Column) -> Column:
    """n UTF-16 units from a 0-based start; a cut surrogate pair becomes the replacement character."""
    raw = F.encode(c, "UTF-16BE")
    return F.decode(F.substring(raw, (2 * start + 1).cast("int"), (2 * n).cast("int")), "UTF-16BE")


def byte_offset(c: Column, utf16_offset: Column, has_bom: Column) -> Column:
    return F.octet_length(utf16_slice(c, F.lit(0), utf16_offset)) + F.when(has_bom, 3).otherwise(0)


def lines(c: Column) -> Column:
    """The lines of a text without their breaks; a last line always exists, even if empty."""
    return F.split(c, LINE_BREAK, -1)


def indentation(line: Column) -> Column:
    return F.regexp_extract(line, f"^({INLINE_SPACE})", 1)


def newline_style(c: Column) -> Column:
    """none, lf, crlf, cr, another single kind's name, or mixed."""
    kinds = F.array_distinct(F.regexp_extract_all(c, F.lit(f"({LINE_BREAK})"), 1))
    one = F.when(kinds[0] == "\n", "lf").when(kinds[0] == "\r\n", "crlf").when(kinds[0] == "\r", "cr").otherwise("unicode")
    return F.when(c.isNull(), F.lit(None)).when(F.size(kinds) == 0, "none").when(F.size(kinds) == 1, one).otherwise("mixed")


def glob_regex(pattern: str) -> str:
    """An anchored, case-insensitive regular expression for a path glob: **/ any folders, ** anything, * and ? within a segment."""
    out, i = [], 0
    special = set(".^$+{}[]()|\\")
    while i < len(pattern):
        c = pattern[i]
        if pattern[i : i + 3] == "**/":
            out.append("(?:.*/)?")
            i += 3
        elif pattern[i : i + 2] == "**":
            out.append(".*")
            i += 2
        else:
            out.append({"*": "[^/]*", "?": "[^/]"}.get(c, "\\" + c if c in special else c))
            i += 1
    return "(?i)^" + "".join(out) + "$"


def first_match(path: Column, patterns: Sequence[str]) -> Column:
    """The first of the globs that the path matches, else null."""
    return F.coalesce(*[F.when(path.rlike(glob_regex(p)), F.lit(p)) for p in patterns]) if patterns else F.lit(None).cast("string")


def first_reason(rules: Iterable[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does (a null condition doesn't hold)."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules])


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def words(c: Column) -> Column:
    """The distinct words of at least two letters or digits, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]{2,})"), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; null if both are empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def identifier_prefixes(name: Column, most: int = 3) -> Column:
    """Offsets inside a name at which a typed prefix may end: 1..most, and before each capital after a lower-case letter."""
    k = F.sequence(F.lit(1), F.length(name) - 1)
    hump = lambda i: F.substring(name, i + 1, 1).rlike("[A-Z]") & F.substring(name, i, 1).rlike("[a-z]")
    return F.when(F.length(name) >= 2, F.filter(k, lambda i: (i <= most) | hump(i))).otherwise(F.array().cast("array<int>"))


def compact_signature(sig: Column) -> Column:
    """'Ret Name(args)' as 'Name(args)->Ret', with generic arguments kept whole; other text passes through.

    The split is at the last space before the bracket that lies outside of angle brackets. The type's spaces inside
    angle brackets are masked, innermost first (four levels), so that a plain pattern finds it.
    """
    head = F.regexp_extract(sig, r"^([^(]*)\(", 1)
    mask = head
    for _ in range(4):
        mask = F.regexp_replace(mask, r"<([^<> ]*) ([^<>]*)>", "<$1\u0001$2>")
        mask = F.regexp_replace(mask, r"<([^<> ]*) ([^<>]*)>", "<$1\u0001$2>")
        mask = F.regexp_replace(mask, r"<([^<> ]*)>", "\u0002$1\u0003")
    cut = F.length(F.regexp_extract(mask, r"^(.*) ", 1))
    whole = (F.instr(sig, "(") > 0) & mask.contains(" ")
    return F.when(whole, F.concat(F.substr(sig, cut + 2), F.lit("->"), F.substr(sig, F.lit(1), cut))).otherwise(sig)


#: Name, type parameters and parameters of a Go function with their brackets balanced, then its results.
GO_SIGNATURE = r"([^(\[]*(\[(?:[^\[\]]|(?2))*\])?\s*(\((?:[^()]|(?3))*\)))\s*(.*?)\s*"


def compact_go_signature(sig: Column) -> Column:
    """'Name[T any](p T) (R, error)' as 'Name[T any](p T)->(R, error)'; without results, or without whole brackets, unchanged.

    Brackets nest to any depth, which takes a recursive pattern: an Arrow batch, not a column expression.
    """
    def run(s: pd.Series) -> pd.Series:
        import regex

        rx = regex.compile(GO_SIGNATURE, regex.S)
        return pd.Series([None if x is None else f"{m[1]}->{m[4]}" if (m := rx.fullmatch(x)) and m[4] else x for x in s], dtype=object)

    return F.pandas_udf(run, "string")(sig)


def context_windows(content: Column, caret: Column, end: Column, before: int, after: int) -> Column:
    """struct<left, right, left_cut, right_cut>: up to so many UTF-16 units before a caret and after a target's end. A window
    that would start or end within a surrogate pair leaves the pair out."""
    raw = F.encode(content, "UTF-16BE")
    n = (F.octet_length(raw) / 2).cast("int")
    unit = lambda i: F.conv(F.hex(F.substring(raw, (2 * i + 1).cast("int"), F.lit(2))), 16, 10).cast("int")
    a = F.greatest(F.lit(0), caret - before)
    a = F.when((a > 0) & unit(a).between(0xDC00, 0xDFFF), a + 1).otherwise(a)
    b = F.least(n, end + after)
    b = F.when((b < n) & (b > end) & unit(b - 1).between(0xD800, 0xDBFF), b - 1).otherwise(b)
    part = lambda x, y: F.decode(F.substring(raw, (2 * x + 1).cast("int"), (2 * (y - x)).cast("int")), "UTF-16BE")
    return F.struct(part(a, caret).alias("left"), part(end, b).alias("right"), (a > 0).alias("left_cut"), (b < n).alias("right_cut"))


def quality_flags(target: Column, end: Column, line_end: Column, syntax_errors: Column) -> dict[str, Column]:
    """The conditions of a sample's quality flags, by name; comments are looked for outside of string literals."""
    bare = F.regexp_replace(target, r'"(?:[^"\\]|\\.)*"', "")
    return {
        "trivial_target": target.rlike(r"^[{}()\[\];, ]*$"), "target_starts_with_whitespace": target.rlike(r"^\s"), "target_starts_with_closer": target.rlike(r"^[)\]}]"), "trailing_whitespace": end < line_end,
        "target_has_comment": bare.rlike(r"//|/\*"), "file_has_syntax_errors": syntax_errors > 0, "non_ascii_target": target.rlike(r"[^\x00-\x7F]"),
    }


def prefix_identifiers(left: Column, window: int = 20_000) -> Column:
    """The distinct identifiers in the last characters before a caret."""
    return F.array_distinct(F.regexp_extract_all(F.right(left, F.lit(window)), F.lit(f"({IDENTIFIER})"), 1))
