"""Readers and writers, each as a round trip on a small folder."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tessel.sources import files as S


def test_scan_and_decode(spark, tmp_path):
    for name, data in {"a/x.cs": b"\xef\xbb\xbfhi", "a/y.cs": b"\xff\xfeh\x00", "b/z.cs": b"\xc3\x28", ".git/q.cs": b"no", "b/n.txt": b"no", "c.cs": b"a\x00b"}.items():
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {r.path: r.d for r in S.scan_folder(spark, str(tmp_path), ["**/*.cs"]).select("path", S.decoded(F.col("content")).alias("d")).collect()}
    assert {k: (v["text"], v["has_bom"], v["reason"]) for k, v in got.items()} == {"a/x.cs": ("hi", True, None), "a/y.cs": (None, False, "utf16_encoding"), "b/z.cs": (None, False, "invalid_utf8"), "c.cs": (None, False, "binary_nul")}
    os.symlink(tmp_path / "a", tmp_path / "link")
    assert "link/x.cs" not in {r.path for r in S.scan_folder(spark, "file://" + str(tmp_path)).collect()}
    spark.dataSource.register(S.ListedFolder)
    assert sorted(r.path for r in spark.read.format("listed_folder").option("path", str(tmp_path)).load().collect()) == ["a/x.cs", "a/y.cs", "b/n.txt", "b/z.cs", "c.cs"]


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string").coalesce(1)
    info = S.write_jsonl(df, str(tmp_path / "o"), "gzip").where("records > 0").first()
    assert info.records == 2 and len(info.sha256) == 64
    assert sorted((r.n, r.s, r._corrupt_record) for r in S.read_jsonl(spark, str(tmp_path / "o"), "n int, s string").collect()) == [(1, "a", None), (2, None, None)]
    assert S.checksums(spark, str(tmp_path / "o"), {info.file: info.sha256}).where(f"file = '{info.file}'").count() == 0
    assert S.checksums(spark, str(tmp_path / "o"), {"gone": "x"}).where("file = 'gone'").first().problem == "missing"


def test_salvage_and_manifest(spark, tmp_path):
    lines = spark.createDataFrame([('{"a":1}', 0), ("", 1), ('{"a":2}', 2), ('{"a"', 3), ('{"a":4}', 4)], "value string, line_no bigint")
    assert [r.line_no for r in S.salvage_jsonl(lines).orderBy("line_no").collect()] == [0, 2]
    m = spark.createDataFrame([("url,revision,priority", 0), ("https://h/a/b,main,3", 1), ("https://h/A/B,,", 2), ("https://h/c/d,x;y,1", 3), ("https://h/e/f,v1,high", 4)], "value string, line_no bigint")
    assert {r.line_no: r.error for r in S.read_manifest(m, "csv").collect()} == {1: None, 2: "duplicate_repository", 3: "invalid_revision", 4: "invalid_priority"}
    j = spark.createDataFrame([('{"url":"https://h/a/b"}', 0), ("{", 1), ("# note", 2)], "value string, line_no bigint")
    assert {r.line_no: r.error for r in S.read_manifest(j, "jsonl").collect()} == {0: None, 1: "invalid_json"}
    t = spark.createDataFrame([("https://h/a/b v1", 0)], "value string, line_no bigint")
    assert [(r.url, r.revision) for r in S.read_manifest(t, "txt").collect()] == [("https://h/a/b", "v1")]
    (tmp_path / "l.txt").write_text("a\r\nb\n")
    assert [(r.value, r.line_no) for r in S.read_lines(spark, str(tmp_path / "l.txt")).collect()] == [("a", 0), ("b", 1)]


def test_packs(spark, tmp_path):
    rows = [(f"n{i}", [i, 65535, 3][: i % 4]) for i in range(20)]
    spark.dataSource.register(S.PackedShards)
    spark.createDataFrame(rows, "name string, ids array<int>").repartition(3).write.format("packed_shards").option("path", str(tmp_path / "p")).mode("append").save()
    assert sorted(S.read_packed(str(tmp_path / "p"))) == rows_sorted(rows)
    S.write_parquet_pack(spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "n int, split string"), str(tmp_path / "q"), rows_per_file=2)
    assert spark.read.parquet(str(tmp_path / "q")).where("split = 'a'").count() == 5


def test_packs_of_other_widths(spark, tmp_path):
    rows = [(f"n{i}", [70_000 + i, 3], i % 3) for i in range(9)]
    spark.dataSource.register(S.PackedShards)
    df = spark.createDataFrame(rows, "name string, ids array<int>, loss_start int").repartition(2)
    df.write.format("packed_shards").option("path", str(tmp_path / "p")).option("width", "32").mode("append").save()
    assert sorted(S.read_packed(str(tmp_path / "p"))) == sorted(rows)
    with pytest.raises(Exception):  # an id beyond 16 bits
        df.write.format("packed_shards").option("path", str(tmp_path / "q")).mode("append").save()
    assert not os.path.exists(tmp_path / "q" / "meta.json")


def test_whole_writes(spark, tmp_path):
    path = str(tmp_path / "d")
    S.write_whole(spark.range(3).toDF("n"), path)
    with pytest.raises(FileExistsError):
        S.write_whole(spark.range(4).toDF("n"), path)
    S.write_whole(spark.range(5).toDF("n"), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["d"]
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("n"))
    with pytest.raises(Exception):
        S.write_whole(bad, path, overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_lines_over_blocks_and_checksums_by_path(spark, tmp_path):
    (tmp_path / "big.log").write_text("".join(f"line {i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = S.read_lines(spark, str(tmp_path / "big.log")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 5000 and all(r.value == f"line {r.line_no}" for r in got)
    for d, text in (("a", "one"), ("b", "two")):
        os.makedirs(tmp_path / "c" / d)
        (tmp_path / "c" / d / "f.bin").write_text(text)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert S.checksums(spark, str(tmp_path / "c"), {"a/f.bin": digest("one"), "b/f.bin": digest("two")}).count() == 0
    assert {tuple(r) for r in S.checksums(spark, str(tmp_path / "c"), {"a/f.bin": digest("two"), "gone": "x"}).collect()} == {("a/f.bin", "checksum"), ("b/f.bin", "unlisted"), ("gone", "missing")}


def rows_sorted(rows):
    return sorted((n, list(i)) for n, i in rows)


def test_run_log(spark, tmp_path):
    log = S.RunLog(str(tmp_path / "run.jsonl"))
    log.write("info", "scan", "done", files=3)
    r = S.read_jsonl(spark, str(tmp_path / "run.jsonl"), "ts string, level string, stage string, event string, data string").first()
    assert (r.level, r.stage, r.event, r.data) == ("info", "scan", "done", '{"files": 3}')
