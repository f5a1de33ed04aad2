"""Word files through extraction, assembly, validation, rendering and packages."""

import csv
import io
import struct
import zipfile
from xml.etree import ElementTree

import pytest

from folioframe.operators.rendering import render_html, subtree_text
from folioframe.operators.validation import findings, validity, verifications
from folioframe.plans.config import Config
from folioframe.plans.convert import convert
from folioframe.sources import docx_builder as b
from folioframe.sources.docx import Docx, image_size
from folioframe.sources.packages import package_xml, replaced_member, saved_images, write_files
from folioframe.sources.xml import indented, parse, walk_xml


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", w, h) + bytes(20)


@pytest.fixture(scope="module")
def conversion(spark):
    body = [
        b.paragraph("Intro", "Heading1Custom"), b.paragraph("see Figure 1 and Table 1, Figure 9"), b.paragraph("Deep", "Heading 3"), b.paragraph("pic", image="rId1"), b.paragraph("", legacy_image="rId1"),
        b.paragraph("one", num_id=1), b.paragraph("two", num_id=1), b.paragraph("three", num_id=2), b.table([["h1", "h2"], ["a<b", "c"], ["short"]]), b.paragraph("  "), b.paragraph("Second", "Title"), b.paragraph("loud", bold=True),
    ]
    body[0] = body[0].replace("Heading1Custom", "Heading 1")
    media = {"image1.png": png(100, 40), "tiny.png": png(10, 10), "vector.emf": b"??"}
    rels = [("rId1", "media/image1.png", False), ("rId2", "media/tiny.png", False), ("rId3", "http://x/y.png", True), ("rId4", "other/vector.emf", False)]
    rows = [("file:/x/book.docx", b.document(body, "My <Book>", "Ada B Lovelace", media, rels)), ("file:/x/bad.docx", b"not a zip"), ("file:/x/empty.docx", b.document([]))]
    return convert(Docx(spark.createDataFrame(rows, "path string, content binary")), Config(year="2020"))


def book(table):
    return [r for r in table.collect() if r.doc_id.endswith("book.docx")]


def test_elements(conversion):
    rows = sorted(book(conversion.elements), key=lambda r: r.pos)
    assert [(r.kind, r.level, r.list_type) for r in rows] == [
        ("paragraph", 1, None), ("paragraph", 0, None), ("paragraph", 3, None), ("image", 0, None), ("paragraph", 0, None), ("image", 0, None), ("paragraph", 0, "bullet"), ("paragraph", 0, "bullet"), ("paragraph", 0, "number"), ("table", 0, None),
        ("paragraph", 1, None), ("paragraph", 0, None),
    ]
    assert rows[-1].text == "**loud**" and rows[-1].is_bold and rows[9].num_cols == 2
    (bad,) = conversion.errors.collect()
    assert bad.doc_id.endswith("bad.docx")


def test_xml(conversion):
    (row,) = book(conversion.xml)
    root = ElementTree.fromstring(row.xml.partition("\n")[2].partition("RittDocBook.dtd\">\n")[2])
    assert [e.get("id") for e in root.iter() if e.get("id")] == ["b001", "ch0001", "ch0001s0001", "ch0001s0002", "ch0001s0002fg01", "ch0001s0002fg02", "ch0001s0002tb01", "ch0002"]
    para = root.find("chapter/para")
    assert [(e.tag, e.get("linkend"), e.text, e.tail) for e in para] == [("link", "ch0001s0002fg01", "Figure 1", " and "), ("link", "ch0001s0002tb01", "Table 1", ", Figure 9")]
    sect2 = root.find("chapter/sect1/sect2")
    assert root.find("chapter/sect1/title").text == "Section" and sect2.find("title").text == "Deep"
    assert [(x.tag, len(x)) for x in sect2 if x.tag.endswith("list")] == [("itemizedlist", 2), ("orderedlist", 1)]
    assert [len(r) for r in sect2.iter("row")] == [2, 2, 1] and [e.text for e in sect2.iter("entry")][2] == "a<b"
    toc = root.find("toc")
    assert [e.get("linkend") for e in toc.iter("tocentry")] == ["ch0001", "ch0001s0001", "ch0001s0002", "ch0002"] and toc.find("tocchap/toclevel1/toclevel2") is not None
    assert root.find("bookinfo/title").text == "My <Book>" and root.find("bookinfo/authorgroup/author/personname/firstname").text == "Ada B" and root.find("bookinfo/pubdate").text == "2020"
    assert root.findall("chapter")[1].find("para/emphasis").get("role") == "bold"


def test_results_and_packages(conversion, spark, tmp_path):
    (r,) = book(conversion.results)
    assert (r.n_text, r.n_images, r.n_tables, r.n_chapters, r.n_error, r.is_valid) == (9, 2, 1, 2, 0, True)
    (p,) = book(conversion.packages)
    with zipfile.ZipFile(io.BytesIO(p.package)) as z:
        assert z.namelist() == p.files == ["Book.xml", "multimedia/Ch0001s0002fg01.png", "multimedia/Ch0001s0002fg02.png", "metadata.csv", "book_metadata.csv"]
        manifest = list(csv.DictReader(io.StringIO(z.read("metadata.csv").decode())))
        fields = dict(csv.reader(io.StringIO(z.read("book_metadata.csv").decode())))
    assert (manifest[0]["Chapter"], manifest[0]["Figure Number"], manifest[0]["Width"], manifest[0]["Format"], manifest[0]["Original Filename"]) == ("Ch0001", "01", "100", "PNG", "img_0001.png")
    assert fields["Images"] == "2" and fields["Authors"] == "Ada B Lovelace"
    assert p.total_size == len(p.package) and p.media_count == 2
    files = conversion.packages.selectExpr("doc_id AS path", "package AS content")
    assert {x.member for x in package_xml(files).collect()} == {"Book.xml"}
    swapped = replaced_member(conversion.packages, spark.createDataFrame([(p.doc_id, "<x/>")], "doc_id string, xml string")).where(f"doc_id = '{p.doc_id}'").first()
    with zipfile.ZipFile(io.BytesIO(swapped.package)) as z:
        assert z.read("Book.xml") == b"<x/>" and len(z.namelist()) == 5
    rows = saved_images(conversion.images.selectExpr("'book' AS doc_id", "filename", "data"))
    assert sorted(x.n_bytes for x in write_files(rows, str(tmp_path)).collect()) == [len(png(1, 1))] * 2
    assert (tmp_path / "book_multimedia" / "Ch0001s0002fg02.png").exists()


def test_empty_document(conversion):
    (row,) = [r for r in conversion.xml.collect() if r.doc_id.endswith("empty.docx")]
    assert "<chapter" not in row.xml and "<title>empty</title>" in row.xml


def test_html(conversion):
    (row,) = [r for r in render_html(conversion.nodes).collect() if r.doc_id.endswith("book.docx")]
    assert '<h1 class="book-title">My &lt;Book&gt;</h1>' in row.html and "<th>h1</th>" in row.html and "<td>a&lt;b</td>" in row.html
    assert '<img src="/api/media/Ch0001s0002fg01.png" alt="Figure" style="max-width: 100%; width: 100%;">' in row.html and "<p><strong>loud</strong></p>" in row.html
    assert '<p>see <a href="#ch0001s0002fg01">Figure 1</a> and <a href="#ch0001s0002tb01">Table 1</a>, Figure 9</p>' in row.html
    ElementTree.fromstring(row.html.replace("100%;\">", "100%;\"/>"))


def test_image_sizes():
    assert image_size(png(3, 4)) == (3, 4)
    assert image_size(b"GIF89a" + struct.pack("<HH", 5, 6)) == (5, 6)
    assert image_size(b"BM" + bytes(16) + struct.pack("<ii", 7, -8)) == (7, 8)
    assert image_size(b"\xff\xd8\xff\xc0\x00\x11\x08" + struct.pack(">HH", 9, 10) + bytes(10)) == (10, 9)
    assert image_size(b"?") == (None, None)


def test_parse_mixed_content():
    nodes, error = parse("<a>x<b k='v'>y<c/>z</b>t<!-- c --></a>")
    assert error is None
    assert [(n["tag"], n["parent_id"], n["ord"], n["text"], n["tail"], n["subtree_end"], n["path"]) for n in nodes] == [("a", None, 0, "x", None, 2, []), ("b", 0, 0, "y", "t", 2, ["a"]), ("c", 1, 0, None, "z", 2, ["a", "b"])]


def test_indented(spark):
    rows = spark.createDataFrame([("a", "<a><b>x</b><c>y <d/></c></a>"), ("b", "<a>"), ("c", None)], "doc_id string, xml string")
    got = {r.doc_id: r for r in indented(rows).collect()}
    assert got["a"].pretty == "<a>\n  <b>x</b>\n  <c>y <d /></c>\n</a>" and [got[k].well_formed for k in "abc"] == [True, False, False]


RULES = {
    "XML Parse Error": "<book id='b001'><title>t</title>",
    "Excluded Element": "<book id='b001'><title>t</title><note/></book>",
    "Missing Title": "<book id='b001'><title>t</title><chapter id='ch0001'/></book>",
    "Missing Attribute": "<book><title>t</title></book>",
    "Duplicate ID": "<book id='b001'><title>t</title><chapter id='ch0001'><title>t</title></chapter><chapter id='ch0001'><title>t</title></chapter></book>",
    "Invalid ID Format": "<book id='b1'><title>t</title></book>",
    "Invalid Figure Structure": "<book id='b001'><title>t</title><figure id='ch0001s0001fg01'><title>t</title><mediaobject/></figure></book>",
    "Invalid Table Structure": "<book id='b001'><title>t</title><table id='ch0001s0001tb01'><title>t</title></table></book>",
    "Invalid Attribute Value": "<book id='b001'><title>t</title><table id='ch0001s0001tb01'><title>t</title><tgroup cols='0'><tbody/></tgroup></table></book>",
    "Invalid Table Format": "<book id='b001'><title>t</title><table id='ch0001s0001tb01'><title>t</title><tgroup cols='1'><tbody><tr/></tbody></tgroup></table></book>",
    "Invalid Section Hierarchy": "<book id='b001'><title>t</title><sect2 id='ch0001s0001'><title>t</title></sect2></book>",
}


def test_rules(spark):
    head = '<!DOCTYPE book PUBLIC "RIS Dev" "x">'
    valid = "<book id='b001'><bookinfo><title>t</title></bookinfo><figure id='ch0001s0001fg01'><title>t</title><mediaobject><imageobject><imagedata fileref='multimedia/a.png' width='1' scalefit='1'/></imageobject></mediaobject></figure></book>"
    cases = {**{k: head + v for k, v in RULES.items()}, "": head + valid, "Missing DOCTYPE": valid, "Invalid DOCTYPE": "<!DOCTYPE book>" + valid, "file": '<!DOCTYPE book SYSTEM "RittDocBook.dtd">' + valid}
    docs = spark.createDataFrame(list(cases.items()), "doc_id string, xml string")
    nodes = walk_xml(docs)
    got = {}
    for r in findings(nodes, docs).collect():
        got.setdefault(r.doc_id, []).append(r.error_type)
    assert got == {k: [k] for k in cases if k and k != "file"}, "a DOCTYPE that names the file alone is valid"
    empty = findings(walk_xml(spark.createDataFrame([("d", head + "<book id='b001'><title>t</title><table id='ch0001s0001tb01'><title>t</title><tgroup cols=''><tbody/></tgroup></table></book>")], "doc_id string, xml string"))).collect()
    assert [(r.check_ord, r.error_type) for r in empty] == [(8, "Invalid Attribute Value")], "an empty number of columns is a wrong one, not a missing one"
    twice = head + "<book id='b001'><title>t</title><table id='ch0001s0001tb01'><title>t</title><tgroup><thead/></tgroup></table><imagedata fileref='x'/><imagedata/></book>"
    rows = sorted((r.node_id, r.check_ord, r.severity) for r in findings(walk_xml(spark.createDataFrame([("d", twice)], "doc_id string, xml string"))).collect())
    assert rows == [(2, 8, "Error"), (2, 10, "Warning"), (4, 3, "Error"), (6, 13, "Warning"), (6, 13, "Warning"), (7, 3, "Error"), (7, 12, "Error")]
    assert {r.doc_id: r.is_valid for r in validity(findings(nodes, docs), docs).collect()}["Invalid ID Format"] is True
    assert verifications(nodes).where("doc_id = ''").count() == 1
    assert [r.content for r in subtree_text(nodes.where("doc_id = 'Invalid ID Format'"), ["title"]).collect()] == ["t"]


def test_workbooks(spark):
    from folioframe.sources.workbooks import reports, summary_rows

    docs = spark.createDataFrame([("a", "<book><title>t</title><note/><imagedata fileref='multimedia/x.png' width='1' scalefit='1'/></book>"), ("b", '<!DOCTYPE book PUBLIC "RIS Dev" "x"><book id=\'b001\'><title>t</title></book>')], "doc_id string, xml string")
    nodes = walk_xml(docs)
    found = findings(nodes, docs)
    summary = [(r.name, r.n) for r in summary_rows(found, docs).where("doc_id = 'a'").orderBy("ord").collect()]
    assert summary == [("Error", 2), ("Warning", 1), ("Info", 0), ("Total", 3), ("Missing Attribute", 1), ("Excluded Element", 1), ("Missing DOCTYPE", 1)]
    books = {r.doc_id: r.xlsx for r in reports(found, verifications(nodes), docs).collect()}
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(books["a"])) as z:
        sheets = [[[c.findtext(".//m:t", namespaces=ns) for c in r] for r in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iter(f"{{{ns['m']}}}row")] for i in (1, 2, 3)]
    assert [r[1] for r in sheets[0]] == ["Severity", "Error", "Error", "Warning"] and sheets[0][1][0] == "1" and ["Validation Status: FAILED"] in sheets[1] and len(sheets[2]) == 2


def test_command_line(spark, tmp_path):
    from folioframe.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.docx").write_bytes(b.document([b.paragraph("A", "Heading 1"), b.paragraph("text", image="r1")], "T", media={"i.png": png(90, 90)}, rels=[("r1", "media/i.png", False)]))
    assert main(["convert", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--quiet"]) == 0
    assert sorted(p.relative_to(tmp_path / "out").as_posix() for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["one.xml", "one_multimedia/Ch0001s0000fg01.png", "one_package.zip", "one_validation_report.xlsx"]
    assert main(["validate", str(tmp_path / "out" / "one_package.zip"), "--quiet"]) == 0


def test_media_folders(spark):
    """The first folder that exists counts, and documents that share one are not multiplied by its files."""
    from pyspark.sql import functions as F

    from folioframe.sources.packages import listed, media_folder, media_lookup

    docs = spark.createDataFrame([(str(i), f"/in/b{i}_docbook42.xml") for i in range(200)] + [("up", "/up/x.xml"), ("bare", "y.xml"), ("none", "/none/z.xml"), ("null", None)], "doc_id string, path string")
    names = [f"/in/multimedia/{k}.png" for k in range(500)] + ["/in/MultiMedia/no.png", "/in/b7_multimedia/a.png", "/in/b8_MultiMedia/no.png", "/up/x_MultiMedia/b.png", "/up/x_MultiMedia/a.png", "/up/MultiMedia/no.png", "multimedia/c.png", "/none/z/multimedia/no.png", "/none/_multimedia/no.png", "none.png"]
    files = spark.createDataFrame([(n, b"x") for n in names], "path string, content binary")
    folders = listed(files).groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.min("name").alias("first_name"))
    found = media_folder(docs, folders)
    want = {str(i): ("/in/multimedia", 500, "0.png") for i in range(200)} | {"7": ("/in/b7_multimedia", 1, "a.png"), "up": ("/up/x_MultiMedia", 2, "a.png"), "bare": ("multimedia", 1, "c.png")}
    assert {r.doc_id: (r.folder, r.files, r.first_name) for r in found.collect()} == want and found.count() == len(want)
    few = docs.where("doc_id IN ('7', '8', 'up')")
    assert sorted((r.doc_id, r.path) for r in media_lookup(few, files).collect()) == sorted([("7", "/in/b7_multimedia/a.png"), ("up", "/up/x_MultiMedia/a.png"), ("up", "/up/x_MultiMedia/b.png"), *(("8", f"/in/multimedia/{k}.png") for k in range(500))])
