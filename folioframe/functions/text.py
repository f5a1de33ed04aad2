"""Scalar functions over columns: cleaning, markers, references, names and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults of missing book fields.
BOOK_DEFAULTS = {"isbn": "0000000000000", "title": "Untitled Document", "author": "Unknown Author", "publisher": "Unknown Publisher", "edition": "1st Edition", "holder": "Copyright Holder"}
# Content types by file extension.
CONTENT_TYPES = {
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "tiff": "image/tiff", "tif": "image/tiff", "emf": "image/x-emf", "wmf": "image/x-wmf",
}
# Suffixes that tools add to a package's name.
PACKAGE_SUFFIXES = ["_rittdoc", "_docbook42"]
# Fixed value: inline markers, in order of precedence.
INLINE = r"\{sub:.+?\}|\{sup:.+?\}|\*\*\*.+?\*\*\*|\*\*.+?\*\*|\*.+?\*"
# Fixed value: a reference in text, its kind and its number or numbers.
REFERENCE = r"(?i)\b(Figures?|Figs?\.?|Tables?|Tabs?\.?)\s+(\d+(?:\s*[-–&,]\s*\d+)*)"


def clean_text(c: Column) -> Column:
    """Without control characters, white space of any kind as single spaces, trimmed; null becomes empty."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def merge_markers(c: Column) -> Column:
    """Joins neighbouring runs: four stars go, and two stars before a single-starred word."""
    return F.regexp_replace(F.replace(c, F.lit("****"), F.lit("")), r"\*\*(?=\*[^*])", "")


def run_markers(runs: Column) -> Column:
    """Text of runs (text, bold, italic, vertical) with markers: subscript, superscript, bold, italic, the first that holds."""

    def marked(r):
        t = r["text"]
        return (
            F.when(t.isNull() | (t == ""), "").when(r["vertical"] == "subscript", F.concat(F.lit("{sub:"), t, F.lit("}"))).when(r["vertical"] == "superscript", F.concat(F.lit("{sup:"), t, F.lit("}")))
            .when(r["bold"], F.concat(F.lit("**"), t, F.lit("**"))).when(r["italic"], F.concat(F.lit("*"), t, F.lit("*"))).otherwise(t)
        )

    return merge_markers(F.array_join(F.transform(runs, marked), ""))


def inline_tokens(c: Column) -> Column:
    """Array of (text, fmt): fmt is subscript, superscript, bold, italic or null; triple stars are bold."""
    found = F.regexp_extract_all(c, F.lit(f"({INLINE})"), F.lit(1))
    gaps = F.split(c, INLINE, -1)

    def token(t):
        fmt = F.when(t.startswith("{sub:"), "subscript").when(t.startswith("{sup:"), "superscript").when(t.startswith("**"), "bold").otherwise("italic")
        body = F.when(t.startswith("{"), F.regexp_extract(t, r"(?s)^\{su[bp]:(.+)\}$", 1)).otherwise(F.regexp_extract(t, r"(?s)^(\*\*\*|\*\*|\*)(.+?)\1$", 2))
        return F.struct(body.alias("text"), fmt.alias("fmt"))

    plain = F.transform(gaps, lambda g: F.struct(g.alias("text"), F.lit(None).cast("string").alias("fmt")))
    marked = F.transform(found, token)
    woven = F.flatten(F.transform(F.arrays_zip(plain.alias("p"), marked.alias("m")), lambda z: F.array(z["p"], z["m"])))
    kept = F.filter(woven, lambda t: t.isNotNull() & (t["text"] != ""))
    # only an empty text has no token that is not empty
    return F.when(c == "", F.array(F.struct(c.alias("text"), F.lit(None).cast("string").alias("fmt")))).otherwise(kept)


def references(c: Column) -> Column:
    """Array of (ref_type, ref_nums) of the references in a text."""
    kinds, numbers = (F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(g)) for g in (1, 2))
    return F.arrays_zip(kinds.alias("ref_type"), numbers.alias("ref_nums"))


def reference_kind(c: Column) -> Column:
    return F.when(F.lower(c).startswith("fig"), "figure").when(F.lower(c).startswith("tab"), "table")


def reference_number(c: Column) -> Column:
    return F.try_to_number(F.regexp_extract(c, r"(\d+)", 1), F.lit("999999999999999999")).cast("long")


def person_name(c: Column) -> Column:
    """(firstname, surname): the last word is the surname; one word has no first name."""
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    n = F.size(words)
    return F.struct(F.when(n >= 2, F.array_join(F.slice(words, 1, F.greatest(n - 1, F.lit(1))), " ")).alias("firstname"), F.when(n >= 2, F.element_at(words, -1)).otherwise(c).alias("surname"))


def padded(prefix: str, c: Column, width: int) -> Column:
    """prefix and a number with leading zeros; longer numbers keep all digits."""
    return F.format_string(f"{prefix}%0{width}d", c.cast("long"))


def figure_filename(c: Column) -> Column:
    """(chapter, number) of a file name that begins by the figure convention; all digits of the number; ('', '0') otherwise."""
    pattern = r"^(Ch\d{4})(?:s\d{4})?fg(\d{2,})"
    hit = c.rlike(pattern)
    return F.struct(F.when(hit, F.regexp_extract(c, pattern, 1)).otherwise("").alias("chapter"), F.when(hit, F.regexp_extract(c, pattern, 2)).otherwise("0").alias("number"))


def human_size(c: Column) -> Column:
    """Bytes as B, KB or MB, one decimal, halves to even."""

    def scaled(unit: int, name: str):
        return F.format_string(f"%.1f {name}", F.bround(c / F.lit(float(unit)), 1))

    return F.when(c < 1024, F.format_string("%d B", c.cast("long"))).when(c < 1024 * 1024, scaled(1024, "KB")).otherwise(scaled(1024 * 1024, "MB"))


def basename(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def stem(c: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(basename(c), r"(?<=.)\.[^.]*$", "")


def extension(c: Column) -> Column:
    """The last suffix, lower case, without its dot; empty if there is none."""
    return F.lower(F.regexp_extract(basename(c), r".\.([^.]*)$", 1))


def content_type(ext: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in CONTENT_TYPES.items() for x in pair))
    return F.coalesce(F.try_element_at(known, ext), F.lit("application/octet-stream"))


def image_format(c: Column) -> Column:
    return F.upper(F.regexp_extract(c, r"([^/]*)$", 1))


def local_name(c: Column) -> Column:
    return F.regexp_extract(c, r"([^}]*)$", 1)


def package_name(c: Column) -> Column:
    """A package's document name: the stem without the suffixes that tools add."""
    out = stem(c)
    for suffix in PACKAGE_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    return out


def filled(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def escaped(c: Column) -> Column:
    """For XML and HTML text and attributes."""
    out = F.coalesce(c, F.lit(""))
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def heading_level(style: Column) -> Column:
    """Level by style: Heading N, Title, Subtitle; 0 for body text."""
    rest = F.trim(F.replace(style, F.lit("Heading"), F.lit("")))
    number = F.when(rest.rlike(r"^[+-]?[0-9]+$"), F.expr("1")).isNotNull()
    parsed = F.try_to_number(rest, F.lit("999999999")).cast("int")
    digit = F.when(style.contains("1"), 1).when(style.contains("2"), 2).when(style.contains("3"), 3).otherwise(0)
    return F.when(style.startswith("Heading"), F.when(number, parsed).otherwise(digit)).when(style == "Title", 1).when(style == "Subtitle", 2).otherwise(0)


def list_kind(style: Column, number_id: Column) -> Column:
    """bullet, number or null by numbering and style; the style's own word wins, bullet first; numbering that is no number is a bullet."""
    numbered = F.coalesce(number_id.try_cast("int") % 2 == 0, F.lit(False)) | style.contains("List Number") | style.contains("Numbered")
    base = F.when(number_id.isNotNull(), F.when(numbered, "number").otherwise("bullet"))
    return F.when(style.contains("List Bullet") | style.contains("Bullet"), "bullet").when(style.contains("List Number") | style.contains("Numbered"), "number").otherwise(base)


def alignment(code: Column) -> Column:
    return F.when(code == "center", "center").when(code.isin("right", "end"), "right").when(code.isin("both", "justify"), "justify").otherwise("left")
