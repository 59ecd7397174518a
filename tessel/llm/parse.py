"""Source files that do not parse: token pairs against permissible pairs, then nesting and productions by windows.

A file's tokens become rows: one for each bracket, with the classes of the tokens since the bracket before it (plain lists,
whose classes no production asks about, are one token already). Windows over the rows of a file give the depth of each,
windows over the rows of one depth the pair of brackets that holds it; the rows of each pair, inner pairs reduced to one
symbol, are one level, which must satisfy the productions of its language. All of it is linear in the number of tokens,
however deep they nest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessel.llm import grammar, lexers


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


#: Lists without brackets in them and without anything that a production asks about are one token: no row of their own.
_NO = r"()\[\]{}"
PLAIN_LISTS = {
    "python": [(re.compile(rf"\([^{_NO}IOa]*\)"), "\x01"), (re.compile(rf"\[[^{_NO}IO]*\]"), "\x02"), (re.compile(rf"\{{[^{_NO}IO]*\}}"), "\x03")],
    "json": [(re.compile(r"\[(?:[sn\x02\x03](?:,[sn\x02\x03])*)?\]"), "\x02"), (re.compile(r"\{(?:s:[sn\x02\x03](?:,s:[sn\x02\x03])*)?\}"), "\x03")],
    "": [(re.compile(rf"(?<!6)\([^{_NO};]*\)"), "\x01"), (re.compile(rf"\[[^{_NO};]*\]"), "\x02")],
}
#: A line break after each bracket; Python's indentation is one, there and only there.
CUT, PYTHON_CUT = (str.maketrans({c: c + "\n" for c in cs}) for cs in ("()[]{}", "()[]{}IO"))


def lex(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, ext, content) -> (file_id, language, pairs, pieces): the file's distinct pairs of adjacent token classes, and
    its classes with a line break after each bracket and $ at the end."""
    schema = pa.schema([("file_id", pa.int64()), ("language", pa.string()), ("pairs", pa.list_(pa.string())), ("pieces", pa.string())])
    for b in batches:
        rows: list[tuple] = []
        for i, ext, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            language, run = lexers.LANGUAGES[ext]
            cs = run(text if ext == "json" else text.lstrip("\ufeff")).replace("$", "e")
            pairs = sorted(grammar.pairs(cs))
            for rx, symbol in 2 * PLAIN_LISTS.get(language, PLAIN_LISTS[""]):
                cs = rx.sub(symbol, cs)
            rows.append((i, language, pairs, cs.translate(PYTHON_CUT if ext == "py" else CUT) + "$"))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema)


def lexed(corpus: DataFrame) -> DataFrame:
    """Lexed files of a known extension; other extensions and null contents give no row."""
    schema = "file_id bigint, language string, pairs array<string>, pieces string"
    files = corpus.select("file_id", extension(F.col("relative_path")).alias("ext"), "content").where(F.col("ext").isin(*lexers.LANGUAGES) & F.col("content").isNotNull() & F.col("file_id").isNotNull())
    return files.mapInArrow(lex, schema).withColumn("pieces", F.split("pieces", "\n"))


def faults(corpus: DataFrame) -> DataFrame:
    """(file_id, language, fault, detail) of every file that doesn't parse; a file may have several faults.

    pair: two tokens that can't be neighbours. nesting: a bracket without a partner of its kind. production: a statement,
    block or list that isn't whole; detail is the level. Rows that repeat a file are told apart by its position in the
    scan, so a file may come twice. Files are lexed in one pass; the permissible pairs are a fixed table, broadcast for the
    anti-join, which leaves the brackets' rows (they have no pair) and the few pairs that are none.
    """
    spark = corpus.sparkSession
    x = lexed(corpus).withColumn("copy", F.monotonically_increasing_id())
    none = F.lit(None).cast("string")
    rows = F.concat(F.transform("pairs", lambda p: F.struct(F.lit(-1).alias("pos"), p.alias("pair"), none.alias("piece"))), F.transform("pieces", lambda p, i: F.struct(i.alias("pos"), none.alias("pair"), p.alias("piece"))))
    allowed = spark.createDataFrame(grammar.permissible(), "language string, pair string")
    t = x.select("file_id", "copy", "language", F.inline(rows)).join(F.broadcast(allowed), ["language", "pair"], "left_anti")
    bracket = F.right("piece", F.lit(1))
    t = t.withColumn("bracket", bracket).withColumn("run", F.expr("substring(piece, 1, length(piece) - 1)")).drop("piece")
    # depth before each bracket, and its neighbours, in the order of the file
    key = ["file_id", "copy", "language"]
    w = W.partitionBy("file_id", "copy").orderBy("pos")
    turn = F.when(F.col("bracket").isin(*grammar.OPEN), 1).when(F.col("bracket").isin(*grammar.CLOSE), -1).otherwise(0)
    lag = lambda c, n: F.lag(c, n).over(w)
    t = t.withColumn("level", F.coalesce(F.sum(turn).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumns({"b1": lag("bracket", 1), "b2": lag("bracket", 2), "r1": lag("run", 1)})
    opened = F.col("b1").isin(*grammar.OPEN)
    symbol = F.when(opened | F.col("b1").isNull(), "").otherwise(grammar.placeholder(F.col("b1"), F.col("r1"), F.coalesce("b2", F.lit("")), F.col("language")))
    wrong = F.coalesce(grammar.row_fault(F.col("language"), F.col("run"), F.col("bracket"), F.col("b1"), F.col("r1"), F.col("b2")), F.lit(False))
    # the pair of brackets of each row: closed ones before it at its depth are counted
    v = W.partitionBy("file_id", "copy", "level").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("block", F.coalesce(F.sum(F.col("bracket").isin(*grammar.CLOSE).cast("int")).over(v), F.lit(0)))
    part = F.struct("pos", F.concat(symbol, "run").alias("s"), F.when(opened, F.col("b1")).alias("opener"), F.when(opened, F.right("r1", F.lit(2))).alias("head"), "bracket", wrong.alias("wrong"))
    # pairs that are none stay rows of the same windows, each a group of its own: taken off apart, they would be lexed again
    parts = F.array_sort(F.collect_list(part))
    levels = t.groupBy(*key, "pair", "level", "block").agg(parts.alias("p"), F.array_join(F.transform(parts, lambda y: y["s"]), "").alias("s"))
    level = levels.select(*key, "pair", "level", "s", F.col("p")[0]["opener"].alias("opener"), F.coalesce(F.col("p")[0]["head"], F.lit("")).alias("head"), F.element_at("p", -1)["bracket"].alias("closer"), F.exists("p", lambda y: y["wrong"]).alias("wrong"))
    matched = F.concat(F.coalesce("opener", F.lit("")), "closer").isin("()", "[]", "{}", "IO", "$")
    broken = F.col("wrong") | grammar.level_fault(F.col("language"), F.col("level"), F.coalesce("opener", F.lit("")), F.col("head"), F.col("s"))
    fault = F.when(F.col("pair").isNotNull(), "pair").when(~matched, "nesting").when(broken, "production")
    where = F.concat(F.coalesce("opener", F.lit("")), "closer", F.lit(" at depth "), F.col("level").cast("string"))
    return level.select("file_id", "language", fault.alias("fault"), F.coalesce("pair", where).alias("detail")).where("fault is not null").distinct()


def not_parsing(corpus: DataFrame) -> DataFrame:
    """(file_id): the files with any fault."""
    return faults(corpus).select("file_id").distinct()


def rates(corpus: DataFrame) -> DataFrame:
    """(repository_id, language, files, failing, rate) over distinct files of a checked language."""
    files = corpus.select("file_id", "repository_id", extension(F.col("relative_path")).alias("ext")).where(F.col("ext").isin(*lexers.LANGUAGES)).distinct()
    names = F.create_map(*[F.lit(x) for e, (n, _) in lexers.LANGUAGES.items() for x in (e, n)])
    f = files.join(not_parsing(corpus).withColumn("bad", F.lit(1)), "file_id", "left").withColumn("language", names[F.col("ext")])
    out = f.groupBy("repository_id", "language").agg(F.count(F.lit(1)).alias("files"), F.count("bad").alias("failing"))
    return out.withColumn("rate", F.col("failing") / F.col("files"))
