"""Pages to lines: normalising, page numbers, furniture, joining of wrapped lines.

Null or empty line arrays give no lines. Everything but the joining of
wrapped lines, which is a fold over a page, is plain Spark.
"""

from __future__ import annotations

import re

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.session import ship_package


def current_pages(pages: DataFrame) -> DataFrame:
    """The latest extraction of each page (late rows included)."""
    cols = [c for c in pages.columns if c not in ("source_file", "pdf_page", "extracted_at")]
    latest = pages.where("source_file is not null and pdf_page is not null").groupBy("source_file", "pdf_page")
    return latest.agg(F.max_by(F.struct(*cols, "extracted_at"), F.col("extracted_at")).alias("r")).select("source_file", "pdf_page", "r.*")


def clean_lines(lines: Column) -> Column:
    return F.filter(F.transform(lines, X.normalize_text), lambda x: x != "")


def page_numbers_cut(pages: DataFrame) -> DataFrame:
    """Printed page numbers taken off the last, then the first line of pages of more than three lines, unless contents pages.

    Columns of the input stay; ``lines`` is cut and ``found_page`` holds the number.
    """
    l = F.col("_l")
    is_number = lambda x: F.coalesce(x.rlike(P.PAGE_NUMBER), F.lit(False))
    contents = F.exists(F.slice(l, 1, 3), lambda x: x.rlike(P.CONTENTS_HEADING))
    p = pages.withColumn("_l", clean_lines(F.col("lines")))
    last = F.when((F.size(l) > 3) & ~contents & is_number(F.try_element_at(l, F.lit(-1))), F.try_element_at(l, F.lit(-1)))
    p = p.withColumn("_n1", last).withColumn("_l", F.when(F.col("_n1").isNotNull(), F.slice(l, F.lit(1), F.size(l) - 1)).otherwise(l))
    first = F.when((F.size(l) > 3) & ~contents & is_number(F.try_element_at(l, F.lit(1))), F.try_element_at(l, F.lit(1)))
    p = p.withColumn("_n2", first).withColumn("_l", F.when(F.col("_n2").isNotNull(), F.slice(l, F.lit(2), F.size(l))).otherwise(l))
    return p.withColumn("found_page", F.coalesce("_n1", "_n2")).withColumn("lines", l).drop("_l", "_n1", "_n2")


def page_lines(pages: DataFrame) -> DataFrame:
    """source_file, pdf_page, line_no (from 0), line, normalised and without blank lines."""
    return pages.select("source_file", "pdf_page", F.posexplode(clean_lines(F.col("lines"))).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def with_furniture(lines: DataFrame) -> DataFrame:
    """Lines with a flag for page furniture: a page number beside a section name, or both on one line."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("source_file", "pdf_page").orderBy("line_no")
    number = lambda c: F.coalesce(c.rlike(P.PAGE_NUMBER), F.lit(False))
    named = lambda c: F.coalesce(c.rlike(P.SECTION_NAME), F.lit(False))
    l, before, after = F.col("line"), F.lag("line").over(w), F.lead("line").over(w)
    flag = l.rlike(P.NUMBER_AND_NAME) | (number(l) & named(after)) | (named(l) & number(before)) | (l.rlike(P.SERIES_NUMBER) & F.coalesce(after.rlike(P.BACK_MATTER_HEADING), F.lit(False)))
    return lines.withColumn("furniture", flag)


# --- joining of wrapped lines (kernel) ----------------------------------

_any = lambda *patterns: regex.compile("|".join(p if not p.startswith("(?i)") else f"(?i:{p[4:]})" for p in patterns))
_NUMBERED = (P.BODY_PARAGRAPH, P.APPENDIX_PARAGRAPH, P.ANNEX_PARAGRAPH, P.FIGURE, P.TABLE)
_NOT_CAPS = _any(*_NUMBERED)
_STARTS = _any(
    *_NUMBERED, P.MAJOR_HEADING, P.FOOTNOTE, P.REQUIREMENT, P.REFERENCE, P.ANNEX_HEADING, P.APPENDIX_HEADING, P.REFERENCES_HEADING, P.GLOSSARY_HEADING, P.RELATED_HEADING, P.CONTENTS_HEADING, P.BACK_MATTER_HEADING
)
_TABLE_LINE = regex.compile(P.TABLE)


class _Run:
    """Lines that were one before they were wrapped, with what is asked of their whole kept up to date."""

    def __init__(self, line: str):
        self.parts, self.first, self.size, self.letters, self.capitals = [], line, -1, 0, 0
        self.alone = line in P.KNOWN_HEADINGS or bool(_TABLE_LINE.match(line))
        self.add(line)

    def add(self, line: str) -> None:
        hyphen = bool(self.parts) and bool(re.search("[a-z][-‑]$", self.parts[-1])) and "a" <= line[0] <= "z"
        if hyphen:
            self.parts[-1] = self.parts[-1][:-1]
        self.parts.append(line if hyphen or not self.parts else " " + line)
        self.size += len(line) + (-1 if hyphen else 1)
        self.letters += sum(map(str.isalpha, line))
        self.capitals += sum(map(str.isupper, filter(str.isalpha, line)))

    @property
    def caps(self) -> bool:
        return self.size >= 4 and self.letters >= 4 and self.capitals > 0.82 * self.letters and not _NOT_CAPS.match(self.first)

    def goes_on(self, line: str) -> bool:
        """Whether a line that begins no element continues the run."""
        new_sentence = self.parts[-1][-1] in ".:;?!" and line[0].isupper()
        return self.letters > 0 and any(map(str.isalpha, line)) and not (new_sentence or self.alone or self.caps)


def caps_heading(line: str) -> bool:
    """Kernel twin of ``functions.text.is_caps_heading``."""
    return bool(line) and _Run(line).caps


def begins_element(line: str) -> bool:
    return bool(_STARTS.match(line)) or line in P.KNOWN_HEADINGS or caps_heading(line)


def unwrap(lines: list[str]) -> list[str]:
    """Lines with those joined that were wrapped; a hyphen between lower-case letters goes."""
    runs: list[_Run] = []
    for line in filter(None, lines):
        if runs and not begins_element(line) and runs[-1].goes_on(line):
            runs[-1].add(line)
        else:
            runs.append(_Run(line))
    return ["".join(r.parts) for r in runs]


def unwrapped(pages: DataFrame) -> DataFrame:
    """Pages with normalised and joined lines (Arrow UDF per page)."""
    ship_package(pages.sparkSession)
    udf = F.pandas_udf(lambda s: pd.Series([None if x is None else unwrap(list(x)) for x in s]), T.ArrayType(T.StringType()))
    return pages.withColumn("lines", udf(clean_lines(F.col("lines"))))
