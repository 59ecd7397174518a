"""Readers and writers: folders, JSON lines, manifests, Parquet packs and packed token shards."""

from __future__ import annotations

import json
import os
import re
import shutil
import struct
import time
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.window import Window as W

from tessel.functions import text as X


def below(root: str, path: Column) -> Column:
    """A file's path relative to a folder, whatever the scheme before it."""
    base = re.escape(re.sub(r"^[a-z]+:/*", "", root).strip("/"))
    return F.regexp_replace(path, rf"^(?:[a-z]+:)?/*{base}/", "")


def scan_folder(spark: SparkSession, root: str, include: Sequence[str] = ("**/*",)) -> DataFrame:
    """(path, size, content) of the files below a folder that an include glob matches, without .git.

    A folder of mounted disks is listed by a source of its own, which follows no links; other file systems have none and
    are read as they are. Content is only read of paths that match.
    """
    if not re.match(r"^(?!file:)[a-z][a-z0-9]+:", root):
        spark.dataSource.register(ListedFolder)
        return spark.read.format("listed_folder").option("path", re.sub("^file:/*", "/", root)).option("include", "\n".join(include)).option("content", "true").load()
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return f.select(below(root, F.col("path")).alias("path"), F.col("length").alias("size"), "content").where(X.first_match(F.col("path"), list(include)).isNotNull() & ~F.col("path").rlike(r"(^|/)\.git/"))


def decoded(content: Column) -> Column:
    """struct<text, has_bom, sha256, reason> of bytes: strict UTF-8 with or without a mark; else the reason why not."""
    bom = F.substring(content, 1, 3) == F.unhex(F.lit("EFBBBF"))
    body = F.when(bom, F.expr(f"substring({content._jc.toString()}, 4)")).otherwise(content)
    utf16 = F.substring(content, 1, 2).isin(bytearray(b"\xff\xfe"), bytearray(b"\xfe\xff"))
    reason = X.first_reason([("utf16_encoding", utf16), ("invalid_utf8", ~F.is_valid_utf8(body.cast("string"))), ("binary_nul", F.contains(body.cast("string"), F.lit("\0")))])
    return F.struct(F.when(reason.isNull(), body.cast("string")).alias("text"), bom.alias("has_bom"), F.sha2(content, 256).alias("sha256"), reason.alias("reason"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON lines (also gzip) under a fixed schema; a line that doesn't fit is kept in _corrupt_record."""
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*s, T.StructField("_corrupt_record", T.StringType())])).option("mode", "PERMISSIVE").json(path)


def write_jsonl(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Writes JSON lines with nulls spelled out; the commit protocol makes the folder appear whole or not at all. Returns
    (file, records, sha256) of what was written."""
    df.write.option("ignoreNullFields", "false").mode("errorifexists").json(path, compression=compression)
    files = df.sparkSession.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"))
    lines = df.sparkSession.read.text(path).groupBy(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file")).agg(F.count(F.lit(1)).alias("records"))
    return files.join(lines, "file", "left").select("file", F.coalesce("records", F.lit(0)).alias("records"), "sha256")


def write_whole(df: DataFrame, path: str, overwrite: bool = False, form: str = "parquet") -> None:
    """Writes a dataset beside its place and moves it there when it is whole. What is there already is refused, or with
    ``overwrite`` replaced; a failed write leaves it as it was."""
    from tessel.streaming.state import path_of

    spark, beside = df.sparkSession, f"{path.rstrip('/')}.partial"
    fs, target = path_of(spark, path)
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    df.write.format(form).mode("overwrite").save(beside)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(path_of(spark, beside)[1], target):
        raise OSError(f"{beside} could not be moved to {path}")


def write_parquet_pack(df: DataFrame, path: str, split: str = "split", rows_per_file: int = 50_000, parts: int | None = None, keys: Sequence[str] = ()) -> None:
    """Parquet with zstd, a folder per split and further keys (a tag, a batch), files of bounded length.

    Rows of a folder are spread over ``parts`` tasks by hash (the session's number of shuffle partitions if not given), so
    a split that most rows belong to is written by many.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folders = [split, *keys]
    df.repartition(*[F.col(k) for k in folders], F.pmod(F.xxhash64(*df.columns), F.lit(n))).write.partitionBy(*folders).option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").mode("errorifexists").parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, line_no) of a text file's lines, numbered from 0 in file order.

    Lines are numbered within the blocks that tasks read; the lines of the blocks before are added up over one row per
    block. So a log of any length is read by many tasks.
    """
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    n = t.withColumn("n", F.row_number().over(W.partitionBy("file", "at").orderBy("id")) - 1)
    blocks = t.groupBy("file", "at").agg(F.count(F.lit(1)).alias("k"))
    before = blocks.select("file", "at", F.coalesce(F.sum("k").over(W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return n.join(before, ["file", "at"]).select("value", (F.col("before") + F.col("n")).cast("bigint").alias("line_no"))


def salvage_jsonl(lines: DataFrame) -> DataFrame:
    """The whole lines before the first torn one: (value, line_no)."""
    bad = F.when((F.trim("value") != "") & F.expr("try_parse_json(value) is null"), F.col("line_no"))
    first = lines.agg(F.min(bad).alias("first_bad"))
    return lines.crossJoin(F.broadcast(first)).where((F.trim("value") != "") & (F.col("first_bad").isNull() | (F.col("line_no") < F.col("first_bad")))).drop("first_bad")  # one row on the right


def read_manifest(lines: DataFrame, kind: str, url_reason: Column | None = None) -> DataFrame:
    """(line_no, value, url, revision, priority, error) of manifest lines in txt, csv or jsonl form. error: empty is no row;
    invalid_json, invalid_priority, invalid_revision, csv_missing_url_column, duplicate_repository (whatever the case, first stays)."""
    x = lines.withColumn("value", F.trim("value")).where("value <> '' and not startswith(value, '#')")
    if kind == "txt":
        p = F.split("value", r"\s+")
        r = x.select("line_no", "value", p[0].alias("url"), F.get(p, 1).alias("revision"), F.lit(None).cast("string").alias("priority"), F.lit(None).cast("string").alias("error"))
    elif kind == "csv":
        head = F.split(F.first("value").over(W.orderBy("line_no")), ",")
        at = lambda name: F.get(F.split("value", ","), (F.array_position(F.transform("head", F.trim), name) - 1).cast("int"))
        y = x.withColumn("head", head).withColumn("n", F.row_number().over(W.orderBy("line_no"))).where("n > 1")  # a manifest is a small file
        r = y.select("line_no", "value", at("url").alias("url"), at("revision").alias("revision"), at("priority").alias("priority"), F.when(~F.array_contains(F.transform("head", F.trim), "url"), "csv_missing_url_column").alias("error"))
    else:
        j = F.from_json("value", "url string, revision string, priority string", {"mode": "PERMISSIVE"})
        r = x.withColumn("j", j).select("line_no", "value", "j.url", "j.revision", "j.priority", F.when(F.col("j.url").isNull(), "invalid_json").alias("error"))
    bad_priority = F.col("priority").isNotNull() & (F.trim("priority") != "") & F.expr("try_cast(priority as int)").isNull()
    bad_revision = F.col("revision").isNotNull() & (F.col("revision") != "") & ~F.col("revision").rlike(r"^[\p{L}\p{Nd}._/-]+$")
    r = r.withColumn("error", F.coalesce("error", F.when(bad_priority, "invalid_priority"), F.when(bad_revision, "invalid_revision")))
    seen = F.row_number().over(W.partitionBy(F.lower("url"), F.col("error").isNull()).orderBy("line_no"))
    return r.withColumn("error", F.coalesce("error", F.when(seen > 1, "duplicate_repository")))


class ListedFolder(DataSource):
    """A source that lists a folder without following links, one partition per top-level entry; rows (path, size), with the
    option ``content`` also the bytes. ``include``: globs, one a line, of the paths wanted."""

    @classmethod
    def name(cls) -> str:
        return "listed_folder"

    def schema(self) -> str:
        return "path string, size bigint" + (", content binary" if self.options.get("content") == "true" else "")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        root, with_content = self.options["path"], self.options.get("content") == "true"
        wanted = [re.compile(X.glob_regex(g)) for g in self.options.get("include", "").split("\n") if g]

        class Part(InputPartition):
            def __init__(self, entry: str):
                self.entry = entry

        class Reader(DataSourceReader):
            def partitions(self) -> list[InputPartition]:
                return [Part(e) for e in sorted(os.listdir(root)) if e != ".git"] or [Part("")]

            def rows(self, full: str) -> Iterator[tuple]:
                path = os.path.relpath(full, root).replace(os.sep, "/")
                if not wanted or any(rx.search(path) for rx in wanted):
                    if with_content:
                        with open(full, "rb") as f:
                            data = f.read()
                        yield path, len(data), data
                    else:
                        yield path, os.path.getsize(full)

            def read(self, part: Part) -> Iterator[tuple]:
                top = os.path.join(root, part.entry)
                if not part.entry or os.path.islink(top):
                    return
                if os.path.isfile(top):
                    yield from self.rows(top)
                    return
                for folder, inner, names in os.walk(top, followlinks=False):
                    inner[:] = sorted(d for d in inner if d != ".git" and not os.path.islink(os.path.join(folder, d)))
                    for n in sorted(names):
                        full = os.path.join(folder, n)
                        if not os.path.islink(full):
                            yield from self.rows(full)

        return Reader()


class PackedShards(DataSource):
    """A sink of packed token shards: per task tokens.u16 (or .u32), offsets.u64 and names.txt, with a third column also
    loss_start.u32; moved into place on commit, removed on abort.

    Rows are (name string, ids array<int>[, loss_start int]). The option ``width`` is 16 or 32 bits; an id that doesn't fit
    fails the task. Rows are written as they come, so a shard needs no memory. The folder must be one that all executors
    and the driver mount. The commit writes meta.json with the shards' counts.
    """

    @classmethod
    def name(cls) -> str:
        return "packed_shards"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        out, width, loss = self.options["path"], int(self.options.get("width", "16")), len(schema.fields) > 2
        letter = {16: "H", 32: "I"}[width]

        class Done(WriterCommitMessage):
            def __init__(self, shard: str, part: str, rows: int, tokens: int):
                self.shard, self.part, self.rows, self.tokens = shard, part, rows, tokens

        class Writer(DataSourceWriter):
            def write(self, rows: Iterator) -> Done:
                from pyspark import TaskContext

                ctx = TaskContext.get()
                shard, n, at = f"shard-{ctx.partitionId():05}", 0, 0
                part = os.path.join(out, f".{shard}.{ctx.taskAttemptId()}")
                os.makedirs(part, exist_ok=True)
                at_path = lambda name: open(os.path.join(part, name), "wb")
                with at_path(f"tokens.u{width}") as tokens, at_path("offsets.u64") as offsets, at_path("names.txt") as names, at_path("loss_start.u32") as starts:
                    offsets.write(struct.pack("<Q", 0))
                    for row in rows:
                        ids = row[1]
                        tokens.write(struct.pack(f"<{len(ids)}{letter}", *ids))
                        n, at = n + 1, at + len(ids)
                        offsets.write(struct.pack("<Q", at))
                        names.write(row[0].encode() + b"\n")
                        if loss:
                            starts.write(struct.pack("<I", row[2]))
                if not loss:
                    os.remove(os.path.join(part, "loss_start.u32"))
                return Done(shard, part, n, at)

            def commit(self, messages: list) -> None:
                meta = []
                for m in messages:
                    os.rename(m.part, os.path.join(out, m.shard))
                    meta.append({"shard": m.shard, "rows": m.rows, "tokens": m.tokens, "width": width})
                with open(os.path.join(out, "meta.json.partial"), "w") as f:
                    json.dump(sorted(meta, key=lambda m: m["shard"]), f)
                os.rename(os.path.join(out, "meta.json.partial"), os.path.join(out, "meta.json"))

            def abort(self, messages: list) -> None:
                for m in messages:
                    if m is not None:
                        shutil.rmtree(m.part, ignore_errors=True)

        return Writer()


def read_packed(path: str) -> list[tuple]:
    """The rows of packed shards, for checks: (name, ids), with the start of the loss where it was written."""
    out = []
    for m in json.load(open(os.path.join(path, "meta.json"))):
        d, width = os.path.join(path, m["shard"]), m["width"]
        numbers = lambda name, letter, size: list(struct.unpack(f"<{os.path.getsize(os.path.join(d, name)) // size}{letter}", open(os.path.join(d, name), "rb").read()))  # noqa: B023, E731
        offsets, ids = numbers("offsets.u64", "Q", 8), numbers(f"tokens.u{width}", {16: "H", 32: "I"}[width], width // 8)
        names = open(os.path.join(d, "names.txt"), encoding="utf-8").read().split("\n")[:-1]
        starts = numbers("loss_start.u32", "I", 4) if os.path.exists(os.path.join(d, "loss_start.u32")) else None
        for i, (n, a, b) in enumerate(zip(names, offsets, offsets[1:], strict=False)):
            out.append((n, ids[a:b]) if starts is None else (n, ids[a:b], starts[i]))
    return out


class RunLog:
    """A structured log of a run: one JSON object per line (ts, level, stage, event, data), readable with read_jsonl."""

    def __init__(self, path: str):
        self.path = path

    def write(self, level: str, stage: str, event: str, **data) -> None:
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps({"ts": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "level": level, "stage": stage, "event": event, "data": json.dumps(data)}) + "\n")


def checksums(spark: SparkSession, path: str, manifest: dict[str, str]) -> DataFrame:
    """(file, problem) of files whose digest isn't the manifest's, are missing, not named in it, or are left unfinished
    (*.partial). Files go by their path below the folder, so equal names in two folders are two files."""
    have = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(below(path, F.col("path")).alias("file"), F.sha2("content", 256).alias("have"))
    want = spark.createDataFrame(sorted(manifest.items()), "file string, want string")
    j = have.join(want, "file", "full")
    problem = X.first_reason([("partial_file", F.col("file").endswith(".partial")), ("missing", F.col("have").isNull()), ("unlisted", F.col("want").isNull()), ("checksum", F.col("have") != F.col("want"))])
    return j.select("file", problem.alias("problem")).where("problem is not null")
