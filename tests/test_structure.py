"""Trees: summaries, structural joins, subtree text, the recovering reader, document type rules."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.operators.conformance import refused
from folioframe.operators.structure import structural_join, subtree_text, summarised, text_blocks
from folioframe.operators.validation import findings
from folioframe.sources.dtd import Definition, automaton, rules
from folioframe.sources.xml import parse, recovered, recovery_log, walk_xml

TAGS = ["a", "b", "table", "tr", "title"]


def tree(rng, depth=0):
    tag = rng.choice(TAGS)
    inner = "".join(rng.choice(["", "x", "é<", "  "]).replace("<", "&lt;") + tree(rng, depth + 1) for _ in range(rng.choice([0, 1, 2, 3]) if depth < 4 else 0))
    return f"<{tag} k='{rng.randrange(9)}'>{rng.choice(['', 'text '])}{inner}{rng.choice(['', 't'])}</{tag}>"


@pytest.fixture(scope="module")
def trees():
    rng = random.Random(11)
    return [(f"d{i}", f"<a>{tree(rng)}\n{tree(rng)}</a>") for i in range(25)]


@pytest.fixture(scope="module")
def nodes(spark, trees):
    return walk_xml(spark.createDataFrame(trees, "doc_id string, xml string"))


def inside(rows):
    return {(a["node_id"], b["node_id"]) for a in rows for b in rows if a["node_id"] < b["node_id"] <= a["subtree_end"]}


def test_summaries_tell_what_stands_inside(trees):
    for _, xml in trees:
        rows, _ = parse(xml)
        pairs = inside(rows)
        for n in rows:
            children = [c for c in rows if c["parent_id"] == n["node_id"]]
            first = {c["tag"]: c for c in reversed(children)}
            assert set(n["kids"]) == set(first) and set(n["descendants"]) == {rows[b]["tag"] for a, b in pairs if a == n["node_id"]}
            assert [c["nth"] for c in children] == [sum(d["tag"] == c["tag"] for d in children[: i + 1]) for i, c in enumerate(children)]
            ways = {t for t in first} | {f"{t}/{w}" for t, c in first.items() for w in c["below"] if w.count("/") < 2}
            assert set(n["below"]) == ways and len(n["below"]) == len(ways)


def test_structural_join(spark, trees, nodes):
    want = sorted((d, a, b) for d, xml in trees for rows in [parse(xml)[0]] for a, b in inside(rows) if rows[a]["tag"] == "a" and rows[b]["tag"] != "b")
    got = structural_join(nodes.where("tag = 'a'"), nodes.where("tag <> 'b'"))
    assert sorted(map(tuple, got.collect())) == want
    once = structural_join(nodes.where("tag = 'a'"), nodes.where("tag <> 'b'"), outermost=True).collect()
    assert sorted((r.doc_id, r.ancestor) for r in once) == sorted({(d, a) for d, a, _ in want})
    assert structural_join(nodes.limit(0), nodes).count() == 0


def test_structural_join_is_linear(spark):
    """One node with 200,000 inside: each is met once."""
    n = 200_000
    inner = spark.range(1, n).select(F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("node_id"))
    top = spark.createDataFrame([("d", 0, n - 1)], "doc_id string, node_id int, subtree_end int")
    assert structural_join(top, inner).count() == n - 1
    assert structural_join(top, inner, outermost=True).count() == 1


def test_summaries_of_other_node_tables(spark, nodes):
    own = ["nth", "parent_line", "kids", "descendants", "below"]
    out = summarised(nodes.drop(*own)).select("doc_id", "node_id", *own)
    key = lambda r: (r.doc_id, r.node_id, r.nth, r.parent_line, set(r.kids), set(r.descendants), set(r.below))
    assert sorted(map(key, out.collect()), key=lambda x: x[:2]) == sorted(map(key, nodes.select("doc_id", "node_id", *own).collect()), key=lambda x: x[:2])


@pytest.mark.parametrize("block", [3, 7, 1 << 16])
def test_subtree_text(spark, trees, nodes, block):
    def text(rows, n, top=True):
        return (n["text"] or "") + "".join(text(rows, c, False) for c in rows if c["parent_id"] == n["node_id"]) + ("" if top else n["tail"] or "")

    want = sorted((d, n["node_id"], n["tag"], text(rows, n)) for d, xml in trees for rows in [parse(xml)[0]] for n in rows if n["tag"] in ("a", "table"))
    assert sorted(map(tuple, subtree_text(nodes, ["a", "table"], block).collect())) == want
    assert text_blocks(nodes, block).where(F.length("content") > block).count() == 0


# ---- recovery


def test_recovery_agrees_on_well_formed_texts(trees):
    for xml in [x for _, x in trees] + ["<?xml version='1.0'?><!DOCTYPE a [<!ELEMENT a ANY>]><!-- <b> --><x:a xmlns:x='u' x:k='1&#65;\n&lt;'>&amp;<![CDATA[<&]]>\r\n<b/></x:a>"]:
        nodes, error, log = recovered(xml)
        assert (error, log) == (None, []) and parse(xml, recover=True) == parse(xml)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<a>", "</a>", "<b k='1'>", "</b>", "<c/>", "x", " ", "<", "&", "&lt;", "<!--", "-->", "<![CDATA[", "]]>", "<?p", "?>", "<!D", "[", ">", "'", '"', "<a k=", "=", "/", "\n", "</", "<b k='x"]), max_size=25))
def test_recovery_reads_anything(parts):
    xml = "".join(parts)
    nodes, error, log = recovered(xml)
    columns = nodes.finish()
    size = len(columns["tag"])
    assert (error is None) == (size > 0) and not nodes.stack
    for n in range(size):
        assert n <= columns["subtree_end"][n] < size and columns["start_char"][n] <= columns["end_char"][n]
        if n:
            p = columns["parent_id"][n]
            assert p < n <= columns["subtree_end"][p] and columns["path"][n] == (*columns["path"][p], columns["tag"][p])
    strict, problem = parse(xml)
    if problem is None:
        assert parse(xml, recover=True)[0] == strict


def test_recovery_of_a_broken_book(spark):
    docs = spark.createDataFrame([("d", "<book id='b001'><title>t</title>\n<chapter id='ch0001'><title>c</chapter>\n<note></book"), ("none", "text"), ("null", None)], "doc_id string, xml string")
    assert [tuple(r)[1:] for r in recovery_log(docs).where("doc_id = 'd'").orderBy("seq").collect()] == [(0, 2, "end tag is missing", "title", "closed"), (1, 3, "tag does not end", "book", "ended there"), (2, 3, "end tag is missing", "note", "closed")]
    found = sorted((r.doc_id, r.check_ord, r.error_type) for r in findings(walk_xml(docs, recover=True)).collect())
    assert found == [("d", 1, "Excluded Element"), ("none", 0, "XML Parse Error"), ("null", 0, "XML Parse Error")]


# ---- document types


def accepts(model, word):
    steps, ends = automaton(model)
    state = 0
    for tag in word:
        state = steps.get(f"{state} {tag}", -1)
    return state in ends


@pytest.mark.parametrize(("model", "good", "bad"), [
    ("(a,b?,(c|d)+)", ["ac", "abd", "abcdcd"], ["", "a", "ab", "bc", "acb"]),
    ("(a*,b)", ["b", "aab"], ["a", "", "bb"]),
    ("((a|b),(a|b))*", ["", "ab", "abba"], ["a", "aba"]),
    ("(a,(b,c)*,b)", ["ab", "abcb"], ["a", "abc", "abb"]),  # needs two positions of b at a time
    ("((a,b)|(a,c))", ["ab", "ac"], ["a", "bc", "abc"]),
])
def test_automata(model, good, bad):
    assert all(accepts(model, w) for w in good) and not any(accepts(model, w) for w in bad)


def test_automata_against_languages():
    """Random models against the sets of their words of up to four names."""
    import itertools

    rng = random.Random(3)

    def joined(one, two):
        return {x + y for x in one for y in two if len(x + y) <= 4}

    def repeated(words, sign):
        out = {""} if sign in ("?", "*") else set()
        if sign in ("", "?"):
            return out | words
        last = words
        while last - out:
            out |= last
            last = joined(last, words)
        return out

    def model(depth=0):
        sign = rng.choice(["", "", "?", "*", "+"])
        if depth > 2 or (depth and rng.random() < 0.3):
            name = rng.choice("abc")
            return name + sign, repeated({name}, sign)
        between, parts = rng.choice(",|"), [model(depth + 1) for _ in range(rng.choice([1, 2, 3]))]
        words = parts[0][1]
        for _, more in parts[1:]:
            words = joined(words, more) if between == "," else words | more
        return f"({between.join(text for text, _ in parts)}){sign}", repeated(words, sign)

    for _ in range(150):
        m, words = model()
        assert {w for n in range(5) for w in map("".join, itertools.product("abc", repeat=n)) if accepts(m, w)} == words, m


DTD = """<!-- a small book --><!ENTITY % inline "emphasis|link"><!ENTITY % sections "(sect+|para+)"><!ENTITY % extra SYSTEM "extra.mod"> %extra;
<!ENTITY % draft "IGNORE"><![%draft;[<!ELEMENT book ANY>]]><![INCLUDE[<!ELEMENT book (title, info?, chapter+)>]]>
<!ELEMENT (chapter|sect) (title, %sections;)> <!ELEMENT title (#PCDATA | %inline;)*> <!ELEMENT para (#PCDATA|%inline;|br)*>
<!ELEMENT emphasis (#PCDATA)> <!ELEMENT link (#PCDATA)> <!ELEMENT br EMPTY>
<!ATTLIST chapter id ID #REQUIRED status (draft|final) "draft"> <!ATTLIST link to CDATA #REQUIRED>"""


def test_conformance(spark):
    definition = Definition(DTD, {"extra.mod": "<!ELEMENT info ANY><!ENTITY % inline 'link'>"})
    assert definition.elements["title"].allowed == ["emphasis", "link"], "the first declaration of an entity counts"
    texts = {
        "good": "<book><title>t <emphasis>e</emphasis></title><info><x/></info>\n<chapter id='1' status='final'><title/><para>p<br/></para></chapter></book>",
        "order": "<book><chapter id='1'><title/><para/></chapter><title/></book>",
        "ends": "<book><title/></book>",
        "mixed": "<book><title><br/></title><chapter id='1'><title/><sect><title/><para/>loose</sect></chapter></book>",
        "attributes": "<book><title/><chapter status='no'><title/><para><link/><br>x</br></para></chapter></book>",
        "two": "<book><title/><chapter id='1'><title/><sect><title/><para/></sect><para/></chapter></book>",
    }
    nodes = walk_xml(spark.createDataFrame(list(texts.items()), "doc_id string, xml string"))
    got = sorted((r.doc_id, r.tag, r.problem, r.subject, r.at) for r in refused(nodes, rules(spark, definition)).collect())
    assert got == [
        ("attributes", "br", "text not allowed", None, None), ("attributes", "chapter", "attribute is missing", "id", None), ("attributes", "chapter", "attribute value not allowed", "status", None), ("attributes", "link", "attribute is missing", "to", None),
        ("ends", "book", "content is incomplete", None, None), ("good", "x", "element not declared", None, None), ("mixed", "sect", "text not allowed", None, None), ("mixed", "title", "child not allowed", "br", 0),
        ("order", "book", "child not allowed", "chapter", 0), ("two", "chapter", "child not allowed", "para", 2),
    ]


def test_definitions_that_hold_themselves():
    with pytest.raises(ValueError, match="holds itself"):
        Definition("<!ENTITY % a '%b;'><!ENTITY % b '%a;'><!ELEMENT x (%a;)>")


# ---- assembly in blocks


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_pieces_are_joined_in_order(spark, block):
    from folioframe.operators.assembly import joined

    rows = [(d, i, k, f"{d}{i}.{k} ") for d in "ab" for i in range(20) for k in range(2)]
    random.Random(1).shuffle(rows)
    got = {r.doc_id: r.xml for r in joined(spark.createDataFrame(rows, "doc_id string, at int, turn int, xml string"), ["at", "turn"], block=block).collect()}
    assert got == {d: "".join(f"{d}{i}.{k} " for i in range(20) for k in range(2)) for d in "ab"}


def test_a_large_book_is_spread(spark):
    """One document of 40,000 elements: numbered in slices, its references resolved, its text joined in blocks."""
    from xml.etree import ElementTree

    from folioframe.operators.assembly import assemble
    from folioframe.operators.numbering import SLICE, numbered

    n = 40_000
    level = F.when(F.col("id") % 400 == 0, 1).when(F.col("id") % 40 == 0, 2).otherwise(0)
    text = F.when(F.col("id") % 100 == 7, F.concat(F.lit("see Figure "), (F.col("id") / 100).cast("int") + 1)).otherwise(F.concat(F.lit("t"), "id"))
    rows = spark.range(n).select(
        F.lit("d").alias("doc_id"), F.col("id").cast("int").alias("pos"), F.when(F.col("id") % 100 == 50, "image").otherwise("paragraph").alias("kind"), text.alias("text"), level.alias("level"), F.lit(None).cast("string").alias("list_type"),
        F.lit("x.png").alias("media_name"), F.lit(None).cast("string").alias("caption"), F.lit(None).cast("array<array<string>>").alias("rows"), F.lit(1).alias("header_rows"),
    )
    sizes = [r["count"] for r in numbered(rows).groupBy(F.floor(F.col("pos") / SLICE)).count().collect()]
    assert sum(sizes) == n and len(sizes) == 5
    docs = spark.createDataFrame([("d", "Big", ["A B"], {})], "doc_id string, title string, authors array<string>, metadata map<string,string>")
    (book,) = assemble(rows, docs, "2024").collect()
    root = ElementTree.fromstring(book.xml.split("?>", 1)[1].split("]>")[-1].split('.dtd">', 1)[1])
    figures = root.findall(".//figure")
    assert len(root.findall("chapter")) == 100 and len(root.findall(".//sect1")) == 900 and len(figures) == 400
    links = [e.get("linkend") for e in root.iter("link")]
    assert len(links) == 400 and set(links) == {f.get("id") for f in figures}


# ---- equal texts, and readers that give what a plan reads


def test_other_node_tables_get_children_loose_text_and_earlier_identifiers(spark, nodes):
    texts = [("x", "<a id='1'> <b id='1'/>t<c id='1'>\n</c><b id='2'/><b id='1'/></a>"), ("y", "<a>t<b/> </a>")]
    more = nodes.unionByName(walk_xml(spark.createDataFrame(texts, "doc_id string, xml string")))
    own = ["id_before", "children", "loose"]
    read = {(r.doc_id, r.node_id): (r.id_before, r.children, r.loose) for r in more.collect()}
    assert {(r.doc_id, r.node_id): (r.id_before, r.children, r.loose) for r in summarised(more.drop(*own, "nth", "parent_line", "kids", "descendants", "below")).select("doc_id", "node_id", *own).collect()} == read
    assert [read["x", n] for n in range(5)] == [([], ["b", "c", "b", "b"], True), (["a"], [], False), (["a", "b"], [], False), ([], [], False), (["a", "b", "c"], [], False)]


def test_the_reader_gives_what_is_asked(spark):
    docs = spark.createDataFrame([(i, "<a><b><c id='1'/></b></a>" if i % 3 else "<a", i % 2) for i in range(12)], "doc_id int, xml string, odd int").coalesce(1)
    rows = walk_xml(docs, columns=["doc_id", "tag", "path", "error"], tags=["c"], carried=["odd"], together=True)
    assert rows.columns == ["doc_id", "tag", "path", "error", "odd"]
    got = [(int(d), r.tag, r.path, r.error is None, r.odd) for r in rows.collect() for d in r.doc_id]
    want = [row for i in range(12) for row in ([(i, "a", [], True, i % 2), (i, "c", ["a", "b"], True, i % 2)] if i % 3 else [(i, None, None, False, i % 2)])]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rows.count() < len(want), "equal texts are given once"


def test_arrays_of_documents_are_bounded(spark):
    """400 equal texts of 10,001 nodes: no batch holds them all, and every document gets every node."""
    from folioframe.sources.xml import CELLS

    n = 10_000
    docs = spark.range(400).select(F.col("id").cast("string").alias("doc_id"), F.lit("<a>" + "<b/>" * n + "</a>").alias("xml")).coalesce(1)
    met = walk_xml(docs, columns=["doc_id", "tag"], together=True).agg(F.max(F.size("doc_id")).alias("most"), F.sum(F.size("doc_id")).alias("cells"), F.count("*").alias("rows")).first()
    assert met.most <= CELLS // n + 1 and met.cells == 400 * (n + 1) and met.rows == 2 * (n + 1)


def test_well_formed_texts_need_no_mending(spark):
    """What an own document type declares stays unresolved where a text is read to be mended, as before."""
    texts = [("plain", "<a k=' x'> </a>"), ("typed", "<!DOCTYPE a [<!ENTITY e 'long'><!ATTLIST a k CDATA 'v'>]><a>&e;</a>"), ("broken", "<a k=1>&e;")]
    rows = {r.doc_id: (r.attrs, r.text) for r in walk_xml(spark.createDataFrame(texts, "doc_id string, xml string"), recover=True).collect()}
    assert rows == {"plain": ({"k": " x"}, " "), "typed": ({}, "&e;"), "broken": ({"k": "1"}, "&e;")}


def test_content_models_are_checked_in_one_pass(spark):
    """The texts are read once, and neither nodes nor children are shuffled."""
    from folioframe.operators.conformance import texts_refused

    docs = spark.createDataFrame([(str(i), f"<book><title>{i % 2}</title>{'x' * (i % 3)}<chapter id='1'><title/><para/></chapter></book>") for i in range(30)], "doc_id string, xml string")
    kinds = rules(spark, Definition(DTD))
    plain, once = refused(walk_xml(docs), kinds), texts_refused(docs, kinds)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, plain.collect())) and once.where("problem = 'text not allowed'").count() == 20
    plan = texts_refused(docs, kinds)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_findings_need_one_pass(spark):
    """The texts are read once and nothing is shuffled; a broken text, a repeated identifier and equal texts count as in the plan with a join."""
    from folioframe.operators.validation import text_findings

    head = '<!DOCTYPE book PUBLIC "RIS Dev" "x">'
    texts = ["<book", "<book id='b001'><title>t</title><chapter id='ch0001'/><sect1 id='ch0001'/><title id='ch0001'/></book>", head + "<book><note/></book>", '<!DOCTYPE book SYSTEM "y"><title/>', None]
    docs = spark.createDataFrame([(f"{i}.{k}", x) for i, x in enumerate(texts) for k in range(3)], "doc_id string, xml string")
    for recover in (False, True):
        nodes = walk_xml(docs, recover=recover)
        plain, once = findings(nodes, docs), text_findings(docs, recover=recover)
        assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect())) and once.where("check_ord = 4").count() == 3
        for frame in (findings(nodes), text_findings(docs, recover=recover)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


ONE_PASS = ["recovered_findings", "rule_findings", "rule_order", "rule_severities", "rule_types", "rule_validity"]


@pytest.mark.parametrize("name", ONE_PASS)
def test_queries_about_rules_read_texts_once(spark, name):
    from conftest import SMALL

    from folioframe.queries import QUERIES

    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
