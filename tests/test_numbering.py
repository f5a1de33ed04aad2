"""Window forms against a sequential state machine on random documents."""

import random

from folioframe.operators import numbering

SCHEMA = "doc_id string, pos int, kind string, text string, level int, list_type string"


def machine(rows):
    """Chapter, section, list and per-chapter number of each element, one after the other."""
    chapter = section = lists = depth = 0
    open_list = None
    counts = {}
    for kind, level, listed in rows:
        heading = kind == "paragraph" and level > 0
        if heading and level == 1:
            chapter, section, depth, counts = chapter + 1, 0, 0, {}
        elif chapter == 0:
            chapter = 1
        if heading and level > 1:
            want = min(level, 4) - 1
            section += max(1, want - depth)
            depth = want
        if heading or kind != "paragraph" or listed is None:
            open_list = None
            item = None
        else:
            if open_list != listed:
                lists += 1
            open_list, item = listed, lists
        number = None
        if kind != "paragraph":
            counts[kind] = number = counts.get(kind, 0) + 1
        yield chapter, section, depth, item, number


def random_document(rng):
    out = []
    for _ in range(rng.randint(1, 25)):
        kind = rng.choice(["paragraph"] * 5 + ["image", "table"])
        out.append((kind, rng.choice([0, 0, 0, 1, 2, 3, 4, 5]) if kind == "paragraph" else 0, rng.choice([None, None, "bullet", "number"])))
    return out


def test_random_documents(spark):
    rng = random.Random(7)
    docs = {f"d{i}": random_document(rng) for i in range(120)}
    rows = [(d, p, k, "t", lv, ls) for d, x in docs.items() for p, (k, lv, ls) in enumerate(x)]
    got = {(r.doc_id, r.pos): (r.chapter_no, r.section_no, r.depth, r.list_id, r.kind_no) for r in numbering.numbered(spark.createDataFrame(rows, SCHEMA)).collect()}
    for d, x in docs.items():
        for p, want in enumerate(machine(x)):
            assert got[d, p] == want, (d, p, x)


def test_ids_keep_all_digits(spark):
    rows = [("d", 0, "paragraph", "t", 1, None)] + [("d", i, "image", None, 0, None) for i in range(1, 102)]
    ids = [r.elem_id for r in numbering.numbered(spark.createDataFrame(rows, SCHEMA)).orderBy("pos").collect()]
    assert ids[0] == "ch0001" and ids[1] == "ch0001s0000fg01" and ids[101] == "ch0001s0000fg101"


def test_outline_drops_what_comes_before(spark):
    rows = [("d", 0, "paragraph", "lost", 2, None), ("d", 1, "paragraph", "One", 1, None), ("d", 2, "paragraph", "a", 2, None), ("d", 3, "paragraph", "body", 0, None), ("d", 4, "paragraph", "b", 3, None)]
    (r,) = numbering.outline(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (r.title, [tuple(s) for s in r.sections]) == ("One", [("a", 2), ("b", 3)])


def test_empty(spark):
    assert numbering.numbered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_slices_number_like_whole_documents(spark):
    """Documents cut over many slices, in one case unevenly, give the numbers of the state machine."""
    rng = random.Random(9)
    docs = {f"d{i}": [e for _ in range(6) for e in random_document(rng)] for i in range(12)} | {"none": [("paragraph", 0, "bullet")] * 40, "deep": [("paragraph", 4, None)] * 9 + [("image", 0, None)] * 9}
    rows = [(d, p, k, "t", lv, ls, p // 8 if d != "d3" else [0, 0, 1, 5, 5, 6, 9][min(6, p // 9)]) for d, x in docs.items() for p, (k, lv, ls) in enumerate(x)]
    frame = spark.createDataFrame(rows, SCHEMA + ", slice long")
    got = {(r.doc_id, r.pos): r for r in numbering.numbered(frame, place="place").collect()}
    for d, x in docs.items():
        images = tables = 0
        before = None
        for p, want in enumerate(machine(x)):
            r = got[d, p]
            assert (r.chapter_no, r.section_no, r.depth, r.list_id, r.kind_no) == want and r.place == p
            images, tables = images + (x[p][0] == "image"), tables + (x[p][0] == "table")
            assert r.global_no == {"image": images, "table": tables}.get(x[p][0])
            last = p + 1 == len(x) or got[d, p + 1].own_list != r.own_list
            assert r.list_start == int(r.own_list is not None and r.own_list != before) and r.list_end == (r.own_list is not None and last)
            before = r.own_list


def test_null_documents_are_one_document(spark):
    rows = [(None, i, "paragraph", "t", 1, None) for i in range(3)]
    assert sorted(r.chapter_no for r in numbering.numbered(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 2, 3]
