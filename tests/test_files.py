"""File jobs on generated files."""

import os

import pytest
from pyspark.sql import functions as F

from flowlark.operators import points
from flowlark.operators.routing import REL
from flowlark.sources import files, pages

LINES = ["# measured", *[f"{i};{i * i}" for i in range(6)]]


@pytest.fixture
def line_file(tmp_path):
    path = tmp_path / "test.csv"
    path.write_text("\n".join(LINES) + "\n")
    return path


def test_line_splits(spark, line_file):
    out = files.file_splits(spark, str(line_file), skip=1, header=True, per_split=2)
    got = [r["content"].split("\n") for r in out.orderBy("split").collect()]
    assert got == [[LINES[1], *LINES[2:4]], [LINES[1], *LINES[4:6]], [LINES[1], LINES[6]]]
    plain = files.file_splits(spark, str(line_file), skip=2, per_split=3).orderBy("split")
    assert [r["content"].split("\n") for r in plain.collect()] == [LINES[2:5], LINES[5:]]
    assert files.file_splits(spark, str(line_file), skip=7, header=True).count() == 0


def test_text_splits_agree_with_files(spark, line_file):
    df = spark.createDataFrame([("\n".join(LINES) + "\n",), ("one",), (None,)], "t string")
    inside = files.text_splits(df, "t", skip=1, header=True, per_split=2)
    out = files.file_splits(spark, str(line_file), skip=1, header=True, per_split=2)
    assert sorted(r["content"] for r in inside.collect()) == sorted(r["content"] for r in out.collect())


def test_lines_of_files_larger_than_a_block(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 1700), ("c", 0)):
        (tmp_path / name).write_text("".join(f"{name}{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = files.numbered_lines(spark, str(tmp_path))
        got = lines.select(F.substring_index("file", "/", -1).alias("f"), "line", "value").collect()
        splits = files.file_splits(spark, str(tmp_path), header=True, per_split=1000)
        sizes = sorted((r["file"][-1], r["split"], r["content"].count("\n")) for r in splits.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 6700
    assert all(r["value"] == f"{r['f']}{r['line']}" for r in got)
    assert sizes == [*[("a", i, 1000) for i in range(4)], ("a", 4, 999), ("b", 0, 1000), ("b", 1, 699)]


@pytest.mark.parametrize("size", ["700", "4096", "1000000"])
def test_splits_across_blocks(spark, tmp_path, size):
    """Splits that a border between blocks parts, files shorter than the skipped lines, empty lines."""
    want = {}
    for name, n in (("a", 977), ("b", 2), ("c", 31), ("d", 0)):
        lines = [f"{name}{i}" * (i % 5) for i in range(n)]
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
        body = lines[3:]
        for at in range(0, len(body), 10):
            want[name, at // 10] = "\n".join([lines[2], *body[at : at + 10]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        out = files.file_splits(spark, str(tmp_path), skip=2, header=True, per_split=10)
        assert {(r["file"][-1], r["split"]): r["content"] for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_status_of_paths(spark, line_file, tmp_path):
    asked = spark.createDataFrame([(str(line_file),), (str(tmp_path / "no"),), ("odd://x",)], "p string")
    got = {os.path.basename(r["p"]): r[REL] for r in files.file_status(asked, "p").collect()}
    assert got == {"test.csv": "success", "no": "not.found", "x": "failure"}


def test_listing(spark, line_file):
    row = files.file_listing(spark, str(line_file.parent), "*.csv").first()
    assert (row["filename"], row["size"]) == ("test.csv", line_file.stat().st_size)
    assert row["key"].endswith("/test.csv") and row["lastModified"] is not None


HTML = """<!doctype html><html><head><title>T & x</title></head><body class='a b'>
<ul><li>one<li>two<br></ul><p id=main data-x>text <a href="/go?a=1&b=2">Go on</a><p style="display: none"
 id=gone>hid<script>if (a<b) {}</script></div></body></html>"""


def test_page_text_is_well_formed():
    import xml.etree.ElementTree as ET

    for html in (HTML, "", "plain", "<p>a<b>c", "<a b='1' b='2' \x01=3>x\x02</a>", "<html><body>x</body></html> y"):
        ET.fromstring(pages.to_xhtml(html))
    assert pages.to_xhtml(None) is None


@pytest.mark.parametrize(
    "kind, selector, found",
    [
        ("id", "main", True), ("id", "gone", False), ("css", "ul > li", True), ("css", "body.b p#main", True),
        ("css", ".c", False), ("css", "a[href]", True), ("link text", "Go on", True), ("link text", "Stop", False),
        ("xpath", "//li[2]", True), ("xpath", "//title", False), ("css", "ul > p", False),
    ],
)
def test_page_selectors(spark, kind, selector, found):
    df = spark.createDataFrame([(1, HTML), (2, None)], "page_id long, html string")
    got = {r["page_id"]: r[REL] for r in pages.page_snapshots(df, kind, selector).collect()}
    assert got == {1: "success" if found else "failure", 2: "failure"}


def test_page_links(spark):
    df = spark.createDataFrame([(1, HTML)], "page_id long, html string")
    links = pages.page_links(pages.page_snapshots(df, "css", "a"), "page_id")
    assert [tuple(r) for r in links.collect()] == [(1, "/go?a=1&b=2")]


def test_points_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "1"), (2, "x")], "id long, v string")
    out = points.to_points(df, F.lit("m"), F.lit("a=b"), {"v": F.col("v")}, ts=F.lit(1), precision="SECONDS")
    points.write_points(out, str(tmp_path / "p"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "p")).collect()] == ["m,a=b v=1.0 1000000000"]


def test_bulk_files(spark, tmp_path):
    from flowlark.operators import bulk

    df = spark.range(25).select(F.concat(F.lit("a\nb"), F.col("id").cast("string")).alias("lines")).coalesce(1)
    bulk.write_bulk(df, str(tmp_path / "b"), batch_size=10)
    bodies = [p.read_text().count("\n") for p in (tmp_path / "b").glob("part-*")]
    assert sorted(bodies) == [10, 20, 20]
