"""Queries over all rows of their tables, those their SQL leaves out included."""

import re

from tessel.plans import catalog
from tessel.session import table

SF = "/root/testdata/sf0.001"


def test_positions_in_files_beyond_the_first_plane(spark, tmp_path):
    text = "a = '\U0001f600'; b = 2\n"
    file = (1, "r", "a.py", "python", "h", len(text.encode()), text, None, False, "lf", False, 2, None)
    spark.createDataFrame([file], "file_id bigint, repository_id string, relative_path string, language string, sha256 string, bytes long, content string, project string, is_test boolean, newline_style string, has_bom boolean, lines int, license string").write.parquet(str(tmp_path / "corpus.parquet"))
    at = len(text[: text.index("b")].encode("utf-16-le")) // 2
    samples = [("same", "h", at, "b = 2"), ("moved", "h", at - 1, "b = 2"), ("half", "h", 6, "';"), ("pair", "h", 5, "\U0001f600'"), ("none", "g", at, "b = 2")]
    spark.createDataFrame([(s, "r", "a.py", h, o, t) for s, h, o, t in samples], "sample_id string, repository_id string, relative_path string, source_sha256 string, caret_utf16_offset int, target_text string").write.parquet(str(tmp_path / "samples.parquet"))
    got = {r.sample_id: r.status for r in catalog.QUERIES["j10_positions_with_reason"](spark, str(tmp_path)).collect()}
    assert got == {"same": "ok", "moved": "text_mismatch", "half": "text_mismatch", "pair": "ok", "none": "no_file"}


def test_every_row_takes_part(spark):
    run = lambda name: catalog.QUERIES[name](spark, SF)
    ids = {r.file_id for r in table(spark, SF, "corpus").select("file_id").distinct().collect()}
    assert {r.file_id for r in run("r9_encoded_files").collect()} == ids
    contents = [r.content for r in table(spark, SF, "corpus").select("file_id", "content").distinct().collect() if r.content is not None]
    assert {r.token: r.n for r in run("a21_token_counts").collect()}["class"] == sum(len(re.findall(r"(?<![A-Za-z0-9_])class(?![A-Za-z0-9_])", t)) for t in contents)
