"""The docx reader with pushed filters, and the file writer's commit and abort."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from folioframe.sources import datasources
from folioframe.sources import docx_builder as b
from folioframe.sources.docx import parts, scan


def tree(folder):
    return sorted(p.relative_to(folder).as_posix() for p in folder.rglob("*") if p.is_file())


@pytest.fixture
def files(spark, tmp_path):
    datasources.register(spark)
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    for i in range(6):
        name = folder / ("deep" if i % 2 else "") / f"d{i}.docx"
        name.write_bytes(b.document([b.paragraph(f"text {i}", "Heading 1", image="r1"), b.table([["a", "b"]])], f"T{i}", media={"i.png": b"\x89PNG" + bytes(3000)}, rels=[("r1", "media/i.png", False)]))
    (folder / "broken.docx").write_bytes(b"no archive")
    (folder / "other.txt").write_bytes(b"x")
    return folder


def test_docx_source_reads_what_the_scan_reads(spark, files):
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(files)).where(F.col("path").endswith(".docx")).withColumn("path", F.replace("path", F.lit("file:"), F.lit("")))
    key = lambda r: str(r.asDict(recursive=True))
    assert sorted(map(key, spark.read.format("docx").load(str(files)).collect())) == sorted(map(key, scan(binary).collect()))
    assert spark.read.format("docx").load(f"{files}/d*.docx").where("part = 'document'").count() == 3


def test_files_are_dealt_by_bytes_and_filters_are_pushed(spark, files):
    size = (files / "d0.docx").stat().st_size
    source = spark.read.format("docx").option("partitionBytes", 2 * size)
    assert source.load(str(files)).rdd.getNumPartitions() == 4, "six files and a small one"
    one = source.load(str(files)).where((F.col("path") == str(files / "d0.docx")) & F.col("part").isin("rel", "property"))
    assert one.rdd.getNumPartitions() == 1 and sorted((r.part, r.name) for r in one.collect()) == [("property", "title"), ("rel", "r1")]
    assert source.load(str(files)).where("part = 'rel' AND name = 'r1'").count() == 6, "other filters are Spark's"
    assert source.load(str(files)).where("part = 'nothing'").count() == 0


def test_media_are_not_unpacked_for_relationships(files, monkeypatch):
    opened = []
    read = zipfile.ZipFile.read
    monkeypatch.setattr(zipfile.ZipFile, "read", lambda self, name, *a: opened.append(name) or read(self, name, *a))
    with open(files / "d0.docx", "rb") as f:
        assert [r["value"] for r in parts(f, ("rel",))] == ["media/i.png"]
    assert not any("media" in name for name in opened) and "word/styles.xml" not in opened


def test_files_are_written(spark, tmp_path):
    datasources.register(spark)
    rows = spark.range(20).select(F.concat(F.lit("a/"), F.col("id") % 3, F.lit("/f"), "id", F.lit(".bin")).alias("path"), F.col("id").cast("string").cast("binary").alias("content"))
    out = tmp_path / "out"
    for _ in range(2):  # a second job replaces the same files
        rows.repartition(4).write.format("filetree").mode("append").save(str(out))
        assert tree(out) == sorted(f"a/{i % 3}/f{i}.bin" for i in range(20)) and (out / "a/2/f17.bin").read_bytes() == b"17"
    assert not (out / datasources.ATTEMPTS).exists()


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    datasources.register(spark)
    out = tmp_path / "out"
    (out / "kept").mkdir(parents=True)
    (out / "kept" / "old.bin").write_bytes(b"old")
    content = F.when(F.col("id") == 37, F.raise_error(F.lit("stop"))).otherwise(F.lit("x")).cast("binary")
    rows = spark.range(40).select(F.concat(F.lit("kept/f"), "id").alias("path"), content.alias("content")).repartition(4)
    with pytest.raises(Exception, match="stop"):
        rows.write.format("filetree").mode("append").save(str(out))
    assert tree(out) == ["kept/old.bin"] and not (out / datasources.ATTEMPTS).exists()


def test_attempts_that_don_t_count_are_removed(tmp_path):
    """A task that is lost after it wrote, and one whose attempt was repeated."""
    writer = datasources.FileTreeWriter(str(tmp_path), wait=0.0)
    row = {"path": "x/a.bin", "content": b"lost"}
    lost = writer.write(iter([row, {"path": "x/b.bin", "content": b"lost"}]))
    again = writer.write(iter([{**row, "content": b"kept"}]))
    assert lost.folder != again.folder
    writer.commit([again, None])
    assert tree(tmp_path) == ["x/a.bin"] and (tmp_path / "x/a.bin").read_bytes() == b"kept"
    other = datasources.FileTreeWriter(str(tmp_path), wait=0.0)
    mine, theirs = other.write(iter([row])), writer.write(iter([row]))
    other.abort([mine])
    assert (tmp_path / datasources.ATTEMPTS / writer.job).exists(), "another job's attempts stay"
    writer.abort([theirs])
    assert tree(tmp_path) == ["x/a.bin"] and not (tmp_path / datasources.ATTEMPTS).exists()


def test_paths_that_are_refused(spark, tmp_path):
    datasources.register(spark)
    write = lambda rows: spark.createDataFrame(rows, "path string, content binary").repartition(2).write.format("filetree").mode("append").save(str(tmp_path / "out"))
    for path in ("../x", "a/../../x", f"{datasources.ATTEMPTS}/x"):
        with pytest.raises(Exception, match="path leaves the folder"):
            write([(path, b"")])
    with pytest.raises(Exception, match="have the path"):
        write([("same", b"1"), ("same", b"2")] * 20)
    assert not os.path.exists(tmp_path / "x") and (not (tmp_path / "out").exists() or tree(tmp_path / "out") == [])


def test_refused_writes_are_tried_again():
    calls = []

    def action(fails):
        calls.append(1)
        if len(calls) <= fails:
            raise PermissionError

    datasources.retried(lambda: action(2), wait=0.0)
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(PermissionError):
        datasources.retried(lambda: action(9), wait=0.0)
    assert len(calls) == 3
