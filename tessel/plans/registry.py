"""The registry of named queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


#: SQL of the helpers that many queries share: distinct files, a uniform hash, a split.
FILES = "(select distinct file_id, repository_id, relative_path, language, sha256, bytes, content, project, is_test, newline_style, has_bom, lines, license from corpus)"
SAMPLES = "(select distinct * from samples)"


def u_sql(*parts: str) -> str:
    text = " || chr(31) || ".join(f"coalesce(({p})::varchar, '')" for p in parts)
    return f"((('0x' || substr(sha256({text}), 1, 16))::ubigint >> 11)::double / 9007199254740992.0)"


def glob_sql(column: str, patterns: list[str]) -> str:
    from tessel.functions.text import glob_regex

    return "(" + " or ".join(f"regexp_matches({column}, '{glob_regex(p)}')" for p in patterns) + ")"


def points_sql(text: str, units: str) -> str:
    """The code points that so many UTF-16 units of a text take: units less the characters beyond U+FFFF among them. Each
    step corrects the one before; four settle for texts with few such characters in a row."""
    e = units
    for _ in range(4):
        e = f"({units} - length(regexp_replace(substr({text}, 1, ({e})::bigint), '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
    return e


def units_sql(text: str) -> str:
    """The length of a text in UTF-16 units."""
    return f"(length({text}) + length(regexp_replace({text}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
