"""Chapter, section, list, figure and table numbers of ordered elements, as a segmented prefix scan.

Elements: doc_id, pos, kind (paragraph, image or table), text, level (0: body),
list_type (bullet, number or null), and more columns, which pass through.

A document is cut into slices. Windows number each slice's elements by
themselves; an aggregation sums up a slice in one row (its counters, the depth
and the list that it ends with, its first heading); windows over these rows
carry on what the slices before have counted; and a join adds it to the
elements. So a document of any length spreads over as many tasks as it has
slices, and only the slices' sums of a document, a row for some thousands of
elements, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import padded

#: Elements of a slice, where the elements don't bring slices of their own.
SLICE = 8192


def _within_slices(elements: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Elements with running values inside their slice; what depends on earlier slices is left open."""
    by = Window.partitionBy("doc_id", "slice").orderBy(*order)
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    heading = (F.col("kind") == "paragraph") & (F.col("level") > 0)
    rows = elements.withColumn("is_heading", heading).withColumn("own_level", F.when(heading, F.col("level")).otherwise(0)).withColumn("own_list", F.when((F.col("kind") == "paragraph") & ~heading, F.col("list_type")))
    own_depth = F.when(F.col("own_level") > 0, F.least(F.col("own_level"), F.lit(4)) - 1)
    chapter = F.col("own_level") == 1
    rows = rows.withColumns({"own_depth": own_depth, "s_n": F.row_number().over(by).cast("long"), "s_list_before": F.lag("own_list").over(by), "s_list_after": F.lead("own_list").over(by)})
    rows = rows.withColumns({
        "s_chapters": F.sum(chapter.cast("long")).over(so_far), "s_depth": F.last("own_depth", ignorenulls=True).over(so_far), "s_depth_before": F.last("own_depth", ignorenulls=True).over(before),
        "s_images": F.sum((F.col("kind") == "image").cast("long")).over(so_far), "s_tables": F.sum((F.col("kind") == "table").cast("long")).over(so_far),
        "s_start": (F.col("own_list").isNotNull() & (F.col("s_n") > 1) & ~F.col("own_list").eqNullSafe(F.col("s_list_before"))).cast("long"),
    })
    # the first heading of a slice opens as many sections as the depth before it asks for, which is not known yet
    rows = rows.withColumn("s_new", F.when((F.col("own_level") > 1) & F.col("s_depth_before").isNotNull(), F.greatest(F.col("own_depth") - F.col("s_depth_before"), F.lit(1))).otherwise(0).cast("long"))
    rows = rows.withColumns({"s_sections": F.sum("s_new").over(so_far), "s_lists": F.sum("s_start").over(so_far)})
    return rows.withColumns({f"s_{c}_base": F.max(F.when(chapter, F.col(f"s_{c}"))).over(so_far) for c in ("sections", "images", "tables")})


def _carried(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(doc_id, slice, c_...): what a slice's elements take over from the slices before."""
    place = F.struct(*order)
    at_heading = F.when(F.col("is_heading"), place)
    last = [F.max(f"s_{c}").alias(f"t_{c}") for c in ("n", "chapters", "sections", "images", "tables", "lists", "sections_base", "images_base", "tables_base")]
    sums = rows.groupBy("doc_id", "slice").agg(*last, F.min_by("own_level", place).alias("first_level"), F.min_by("own_level", at_heading).alias("first_heading"), F.max_by("own_depth", at_heading).alias("last_depth"), F.min_by("own_list", place).alias("first_list"), F.max_by("own_list", place).alias("last_list"))
    by = Window.partitionBy("doc_id").orderBy("slice")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    latest = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(0))
    out = sums.withColumns({"c_n": total("t_n"), "c_chapters": total("t_chapters") + (F.first("first_level").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)) != 1).cast("long"), "c_depth": latest("last_depth"), "c_list_before": F.lag("last_list").over(by), "c_list_after": F.lead("first_list").over(by), "c_images": total("t_images"), "c_tables": total("t_tables")})
    first_new = F.when(F.col("first_heading") > 1, F.greatest(F.least(F.col("first_heading"), F.lit(4)) - 1 - F.col("c_depth"), F.lit(1))).otherwise(0).cast("long")
    first_start = (F.col("first_list").isNotNull() & ~F.col("first_list").eqNullSafe(F.col("c_list_before"))).cast("long")
    out = out.withColumns({"c_new": first_new, "c_start": first_start})
    out = out.withColumns({"c_sections": total(F.col("t_sections") + F.col("c_new")), "c_lists": total(F.col("t_lists") + F.col("c_start")) + F.col("c_start")})
    # counts at the start of the chapter that is open when the slice begins
    bases = {"c_sections_base": F.col("c_sections") + F.col("c_new") + F.col("t_sections_base"), "c_images_base": F.col("c_images") + F.col("t_images_base"), "c_tables_base": F.col("c_tables") + F.col("t_tables_base")}
    out = out.withColumns(bases).withColumns({c: latest(c) for c in bases})
    return out.select(F.col("doc_id").alias("c_doc_id"), F.col("slice").alias("c_slice"), F.col("t_n").alias("c_size"), *(c for c in out.columns if c.startswith("c_")))


def numbered(elements: DataFrame, order: tuple[str, ...] = ("pos",), place: str | None = None) -> DataFrame:
    """Adds chapter_no, section_no, new_sections, depth, list_id, in_list, kind_no, global_no and elem_id.

    A document that doesn't begin with a level-1 heading gets an implicit
    chapter; skipped levels get implicit sections, which take numbers. depth is
    that of the deepest open section, section_no its number (0: the chapter).

    order: the columns that order a document's elements. A column slice, if
    there is one, cuts documents: it may not fall along that order, and each of
    its values is numbered by one task; otherwise positions are cut every SLICE.
    place: a column to add, the number of the element in its document from 0.
    """
    names = [c for c in elements.columns if c != "slice"]
    cut = elements if "slice" in elements.columns else elements.withColumn("slice", F.floor(F.col(order[0]) / SLICE))
    rows = _within_slices(cut, order)
    carried = _carried(rows, order)
    rows = rows.join(carried, rows["doc_id"].eqNullSafe(carried["c_doc_id"]) & rows["slice"].eqNullSafe(carried["c_slice"]))
    col = F.col
    known = col("s_depth_before").isNotNull()
    before = F.when(col("s_n") == 1, col("c_list_before")).otherwise(col("s_list_before"))
    after = F.when(col("s_n") == col("c_size"), col("c_list_after")).otherwise(col("s_list_after"))
    listed = col("own_list").isNotNull()
    since = lambda c, more: F.when(col(f"s_{c}_base").isNotNull(), col(f"s_{c}") - col(f"s_{c}_base")).otherwise(col(f"c_{c}") - col(f"c_{c}_base") + col(f"s_{c}") + more)
    opened = F.when(col("s_depth").isNotNull(), col("c_new")).otherwise(0)  # from the slice's first heading on
    by_kind = lambda image, table: F.when(col("kind") == "image", image).when(col("kind") == "table", table)
    out = rows.select(
        *names, "is_heading", "own_level", "own_list", (col("c_chapters") + col("s_chapters")).alias("chapter_no"), F.coalesce("s_depth_before", "c_depth").alias("depth_before"), F.coalesce("s_depth", "c_depth").alias("depth"),
        F.when(col("own_level") > 1, F.when(known, col("s_new")).otherwise(col("c_new"))).otherwise(0).cast("long").alias("new_sections"), since("sections", opened).alias("section_no"),
        (listed & ~col("own_list").eqNullSafe(before)).cast("long").alias("list_start"), (listed & ~col("own_list").eqNullSafe(after)).alias("list_end"), F.when(listed, col("c_lists") + col("s_lists")).alias("list_id"),
        by_kind(since("images", 0), since("tables", 0)).alias("kind_no"), by_kind(col("c_images") + col("s_images"), col("c_tables") + col("s_tables")).alias("global_no"),
        *([(col("c_n") + col("s_n") - 1).alias(place)] if place else []),
    )
    return out.withColumn("elem_id", element_id())


def chapter_code():
    return padded("ch", F.col("chapter_no"), 4)


def section_code():
    return F.concat(chapter_code(), padded("s", F.col("section_no"), 4))


def element_id():
    """Id of chapters, sections, figures and tables; null for other elements."""
    return (
        F.when(F.col("own_level") == 1, chapter_code()).when(F.col("own_level") > 1, section_code())
        .when(F.col("kind") == "image", F.concat(section_code(), padded("fg", F.col("kind_no"), 2))).when(F.col("kind") == "table", F.concat(section_code(), padded("tb", F.col("kind_no"), 2)))
    )


def sections(rows: DataFrame, title="text") -> DataFrame:
    """Chapters and sections of numbered elements, implicit ones too: doc_id, pos, chapter_no, section_no, depth, title, implicit."""
    implicit = F.when(F.col("new_sections") > 1, F.sequence(F.lit(1), F.col("new_sections") - 1)).otherwise(F.array().cast("array<bigint>"))
    head = rows.where("is_heading")
    one = F.struct(
        F.col("section_no").alias("section_no"), F.col("depth").cast("int").alias("depth"), F.col(title).alias("title"), F.lit(False).alias("implicit"),
    )
    more = F.transform(
        implicit,
        lambda i: F.struct(
            (F.col("section_no") - F.col("new_sections") + i).alias("section_no"), (F.col("depth") - F.col("new_sections") + i).cast("int").alias("depth"),
            F.when(F.col("depth") - F.col("new_sections") + i == 1, "Section").otherwise("Subsection").alias("title"), F.lit(True).alias("implicit"),
        ),
    )
    return head.select("doc_id", "pos", "chapter_no", F.explode(F.concat(more, F.array(one))).alias("s")).select("doc_id", "pos", "chapter_no", "s.*")


def outline(elements: DataFrame) -> DataFrame:
    """Chapters with their headings of level 2 and more: doc_id, chapter_no, title, level, sections; earlier ones are dropped."""
    so_far = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = elements.where((F.col("kind") == "paragraph") & (F.col("level") > 0)).withColumn("chapter_no", F.sum((F.col("level") == 1).cast("long")).over(so_far)).where("chapter_no > 0")
    below = F.transform(F.array_sort(F.collect_list(F.when(F.col("level") > 1, F.struct("pos", "text", "level")))), lambda x: F.struct(x["text"].alias("title"), x["level"].alias("level")))
    return heads.groupBy("doc_id", "chapter_no").agg(F.max(F.when(F.col("level") == 1, F.col("text"))).alias("title"), F.lit(1).alias("level"), below.alias("sections"))


def list_groups(rows: DataFrame) -> DataFrame:
    """Lists of numbered elements: doc_id, list_id, list_type, first_pos, n_items."""
    return rows.where("list_id IS NOT NULL").groupBy("doc_id", "list_id").agg(F.first("own_list").alias("list_type"), F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_items"))
