"""Scalar functions, each over one small table."""

from pyspark.sql import functions as F

from folioframe.functions import text as fn


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_clean_text(spark):
    rows = [("a\x01b \t c d",), ("a  b\n",), (None,), ("",)]
    assert values(spark, rows, fn.clean_text(F.col("x"))) == ["ab c d", "a b", "", ""]


def test_inline_tokens(spark):
    rows = [("a **b** *c* ***d*** H{sub:2}O x{sup:2}",), ("plain",), ("",)]
    got = values(spark, rows, fn.inline_tokens(F.col("x")))
    assert [tuple(t) for t in got[0]] == [("a ", None), ("b", "bold"), (" ", None), ("c", "italic"), (" ", None), ("d", "bold"), (" H", None), ("2", "subscript"), ("O x", None), ("2", "superscript")]
    assert [tuple(t) for t in got[1]] == [("plain", None)]
    assert [tuple(t) for t in got[2]] == [("", None)]


def test_merge_markers(spark):
    assert values(spark, [("**a****b**",), ("**a***b*",), (None,)], fn.merge_markers(F.col("x"))) == ["**ab**", "**a*b*", None]


def test_run_markers(spark):
    rows = [([("H", None, None, None), ("2", True, None, "subscript"), ("b", True, True, None), ("i", None, True, None), ("", True, None, None)],)]
    got = values(spark, rows, fn.run_markers(F.col("x")), "x array<struct<text:string,bold:boolean,italic:boolean,vertical:string>>")
    assert got == ["H{sub:2}**b***i*".replace("***", "*")]


def test_references(spark):
    got = values(spark, [("see Figure 1 and Tab. 2-3; tables 4,5",)], fn.references(F.col("x")))
    assert [tuple(r) for r in got[0]] == [("Figure", "1"), ("Tab.", "2-3"), ("tables", "4,5")]


def test_person_name(spark):
    got = values(spark, [("Ada B Lovelace",), ("Plato",)], fn.person_name(F.col("x")))
    assert [tuple(r) for r in got] == [("Ada B", "Lovelace"), (None, "Plato")]


def test_figure_filename(spark):
    rows = [("Ch0001s0100fg01.jpg",), ("Ch0001fg02.png",), ("x.png",), ("Ch0001fg100.png",)]
    assert [tuple(r) for r in values(spark, rows, fn.figure_filename(F.col("x")))] == [("Ch0001", "01"), ("Ch0001", "02"), ("", "0"), ("Ch0001", "100")]


def test_human_size(spark):
    rows = [(1023,), (1280,), (1048576,), (1152,)]
    assert values(spark, rows, fn.human_size(F.col("x")), "x long") == ["1023 B", "1.2 KB", "1.0 MB", "1.1 KB"]


def test_paths(spark):
    rows = [("/a/b.tar.GZ",), (".hidden",), ("x",)]
    df = spark.createDataFrame(rows, "x string").select(fn.stem(F.col("x")), fn.extension(F.col("x")), fn.content_type(fn.extension(F.col("x"))))
    assert [tuple(r) for r in df.collect()] == [("b.tar", "gz", "application/octet-stream"), (".hidden", "", "application/octet-stream"), ("x", "", "application/octet-stream")]
    assert values(spark, [("/x/book_rittdoc.zip",)], fn.package_name(F.col("x"))) == ["book"]
    assert values(spark, [("image/x-emf",)], fn.image_format(F.col("x"))) == ["X-EMF"]
    assert values(spark, [("{urn:a}tag",), ("tag",)], fn.local_name(F.col("x"))) == ["tag", "tag"]


def test_styles(spark):
    rows = [("Normal", None), ("Title", None), ("Subtitle", None), ("Heading 3", None), ("Heading 1 Char", None), ("Heading", None), ("List Bullet", None), ("List Number", None), ("Normal", "1"), ("Normal", "2"), ("List Bullet", "2"), ("Normal", "x")]
    df = spark.createDataFrame(rows, "s string, n string").select(fn.heading_level(F.col("s")), fn.list_kind(F.col("s"), F.col("n")))
    assert [tuple(r) for r in df.collect()] == [(0, None), (1, None), (2, None), (3, None), (1, None), (0, None), (0, "bullet"), (0, "number"), (0, "bullet"), (0, "number"), (0, "bullet"), (0, "bullet")]
