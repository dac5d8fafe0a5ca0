"""Text helpers as Spark columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def strip(c: Column | str) -> Column:
    """Trim white space of every kind, no-break spaces included."""
    return F.regexp_replace(col(c), rf"^[{P.SPACE}]+|[{P.SPACE}]+$", "")


def squeeze(c: Column | str) -> Column:
    """Runs of white space made one space, ends trimmed."""
    return F.btrim(F.regexp_replace(col(c), rf"[{P.SPACE}]+", " "))


def normalize_text(c: Column | str) -> Column:
    """Spaces of all kinds made one, line separators made line feeds, invisible marks dropped; line feeds stay."""
    c = F.translate(col(c), " \t  ﻿​", "  \n\n")
    return strip(F.regexp_replace(c, rf"[{P.SPACE_IN_LINE}]+", " "))


def normalize_line(c: Column | str) -> Column:
    """One line: NUL and white space runs made one space."""
    return squeeze(F.translate(col(c), "\x00", " "))


def canonical_dash(c: Column | str) -> Column:
    return F.regexp_replace(col(c), P.DASH, "–")


def letters(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), r"\P{L}+", ""))


def capitals(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), r"\P{Lu}+", ""))


def caps_ratio(c: Column | str) -> Column:
    """Share of capitals among the letters; null without letters."""
    return capitals(c) / F.nullif(letters(c), F.lit(0))


def is_caps_heading(c: Column | str) -> Column:
    """At least four letters, more than 0.82 of them capitals, and no figure, table or paragraph."""
    c = col(c)
    element = c.rlike(P.FIGURE) | c.rlike(P.TABLE) | c.rlike(P.BODY_PARAGRAPH) | c.rlike(P.APPENDIX_PARAGRAPH) | c.rlike(P.ANNEX_PARAGRAPH)
    return (F.length(c) >= 4) & (letters(c) >= 4) & F.coalesce(caps_ratio(c) > 0.82, F.lit(False)) & ~element


#: Kinds of a line, in the order in which they are tried.
LINE_KINDS = (
    ("table", P.TABLE),
    ("requirement", P.REQUIREMENT),
    ("figure", P.FIGURE),
    ("body_paragraph", P.BODY_PARAGRAPH),
    ("appendix_paragraph", P.APPENDIX_PARAGRAPH),
    ("annex_paragraph", P.ANNEX_PARAGRAPH),
    ("reference", P.REFERENCE),
    ("major_heading", P.MAJOR_HEADING),
    ("annex_heading", P.ANNEX_HEADING),
    ("appendix_heading", P.APPENDIX_HEADING),
    ("references_heading", P.REFERENCES_HEADING),
    ("glossary_heading", P.GLOSSARY_HEADING),
    ("contents_heading", P.CONTENTS_HEADING),
    ("back_matter_heading", P.BACK_MATTER_HEADING),
    ("footnote", P.FOOTNOTE),
    ("page_number", P.PAGE_NUMBER),
    ("contents_entry", P.CONTENTS_ENTRY),
)


def line_kind(c: Column | str) -> Column:
    """The kind of a line taken by itself."""
    c = col(c)
    out = F.when(c == "", "blank")
    for kind, pattern in LINE_KINDS:
        out = out.when(c.rlike(pattern), kind)
    return out.when(is_caps_heading(c), "caps_heading").otherwise("text")


def slug(c: Column | str) -> Column:
    """ASCII letters and figures in lower case, joined by hyphens; ``none`` if there are none."""
    return F.coalesce(F.nullif(F.lower(F.btrim(F.regexp_replace(col(c), "[^A-Za-z0-9]+", "-"), F.lit("-"))), F.lit("")), F.lit("none"))


def path_component(c: Column | str, fallback: str) -> Column:
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(strip(c), "[^A-Za-z0-9._-]+", "-"), F.lit("-._")), F.lit("")), F.lit(fallback))


def compact_id(c: Column | str) -> Column:
    """Document ids of more than 48 characters cut to 48, without hyphens at the end."""
    c = col(c)
    return F.when(F.length(c) <= 48, c).otherwise(F.regexp_replace(F.substring(c, 1, 48), "-+$", ""))


def page_label(start: Column | str, end: Column | str) -> Column:
    start, end = col(start), col(end)
    return F.when(start == end, start.cast("string")).otherwise(F.concat(start.cast("string"), F.lit("-"), end.cast("string")))


def record_label(kind: Column | str, element_id: Column | str) -> Column:
    """``type id``, or the type alone."""
    return F.concat_ws(" ", col(kind), F.nullif(col(element_id), F.lit("")))


def preview(c: Column | str, limit: int = 220) -> Column:
    c = normalize_line(c)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit - 3), F.lit("...")))


def remove_controls(c: Column | str) -> Column:
    """Control characters made spaces, spaces squeezed and trimmed around line feeds."""
    c = F.regexp_replace(col(c), P.WIDE_CONTROL, " ")
    c = F.regexp_replace(c, "[ \t]{2,}", " ")
    return strip(F.regexp_replace(c, " *\n *", "\n"))


def sanitize(c: Column | str) -> Column:
    """Fit for a report: controls and private glyphs made spaces, broken characters a question mark."""
    c = F.regexp_replace(F.regexp_replace(col(c), P.WIDE_CONTROL, " "), P.PRIVATE_USE, " ")
    return strip(F.regexp_replace(F.translate(c, "�", "?"), "[ \t]{2,}", " "))


def title_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit("[a-z0-9]+"), F.lit(0))


def token_overlap(a: Column | str, b: Column | str) -> Column:
    """Shared distinct words over those of the longer title; 0 if either has none."""
    x, y = F.array_distinct(title_tokens(a)), F.array_distinct(title_tokens(b))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def has_odd_symbols(c: Column | str) -> Column:
    """At least two controls, or many non-ASCII signs that are neither letters nor white space."""
    c = col(c)
    odd = F.length(F.regexp_replace(c, rf"[\x00-\x7f\p{{L}}{P.SPACE}]+", ""))
    controls = F.length(F.regexp_replace(c, r"[^\x00-\x08\x0b-\x1f\x7f-\x{9f}]+", ""))
    return (controls >= 2) | (odd >= F.greatest(F.lit(5), F.floor(F.length(c) / 20)))


def looks_like_garbage(c: Column | str, alpha: float = 0.25, punctuation: float = 0.42) -> Column:
    """Hardly a letter among many signs, or odd symbols among some."""
    c = strip(c)
    visible = F.length(F.regexp_replace(c, rf"[{P.SPACE}]+", ""))
    marks = F.length(F.regexp_replace(c, rf"[\p{{L}}\p{{N}}{P.SPACE}]+", ""))
    share = marks / F.nullif(visible, F.lit(0))
    return (F.length(c) >= 24) & F.coalesce(((letters(c) / F.nullif(visible, F.lit(0)) < alpha) & (share > punctuation)) | (has_odd_symbols(c) & (share > 0.18)), F.lit(False))


def ends_with_continuation(c: Column | str) -> Column:
    """The last word is one that a heading cannot end with."""
    return F.regexp_extract(F.upper(col(c)), "([A-Z]+)[^A-Z]*$", 1).isin(*P.CONTINUATION_WORDS)
