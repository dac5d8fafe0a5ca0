"""Status of records: the rule of the segmenter and the rule of the audit, as columns.

The two rules differ on purpose (see ``rule_conflicts``). Null types or
regions match no rule of their own: the segmenter's rule gives
Informational, the audit's has no opinion (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X


def in_section_one(element_id: Column, section_path: Column) -> Column:
    """By the segmenter's reading: id 1.x or 1nn, or a first path part that begins with ``1.``."""
    i = F.coalesce(element_id, F.lit(""))
    head = F.coalesce(F.try_element_at(section_path, F.lit(1)), F.lit(""))
    return i.startswith("1.") | i.rlike(rf"^1{P.D}{{2}}(?:\.{P.D}+)?$") | head.startswith("1.")


def classify(kind: Column, region: Column, element_id: Column, section_path: Column) -> Column:
    """Normative, Informative or Informational."""
    substantive = kind.isin(*P.SUBSTANTIVE_TYPES)
    return (
        F.when(kind == "footnote", "Informative")
        .when((region == "Body") & in_section_one(element_id, section_path), "Informational")
        .when(region.isin("Body", "Appendix") & substantive, "Normative")
        .when((region == "Annex") & substantive, "Informative")
        .otherwise("Informational")
    )


def reason(kind: Column, region: Column, element_id: Column, section_path: Column) -> Column:
    """Why ``classify`` gives its status."""
    substantive = kind.isin(*P.SUBSTANTIVE_TYPES)
    return (
        F.when(kind == "footnote", "footnotes inform about the text they belong to")
        .when((region == "Body") & in_section_one(element_id, section_path), "section 1 introduces the publication and should not contain requirements")
        .when((region == "Body") & substantive, "the body from section 2 on holds the primary technical content")
        .when((region == "Appendix") & substantive, "an appendix has the same status as the main text")
        .when((region == "Annex") & substantive, "an annex is not integral to the publication")
        .when(region.isin("Body", "Appendix", "Annex"), "headings and references only lead through the text")
        .when(region.isin(*P.APPARATUS_REGIONS), "front matter, references, glossary and back matter only inform")
        .otherwise("no rule of its own for this type and region")
    )


def section_one_label(section: Column, label: Column) -> Column:
    """By the audit's reading: the section begins with 1, or the label is 1 or 1.x."""
    s, l = X.strip(section), X.strip(label)
    return s.rlike(rf"^1(?:\.|[{P.SPACE}])") | l.rlike(rf"^1(?:\.{P.D}+)*$") | l.rlike(rf"^1\.{P.D}+")


def expected(kind: Column, region: Column, section: Column, label: Column, layout_text: Column) -> Column:
    """The status the audit expects; null where it has no opinion."""
    return (
        F.when(layout_text, "Informational")
        .when(kind == "heading", "Informational")
        .when(kind == "footnote", "Informative")
        .when(region.isin(*P.APPARATUS_REGIONS), "Informational")
        .when(region == "Annex", "Informative")
        .when(region == "Appendix", "Normative")
        .when((region == "Body") & section_one_label(section, label), "Informational")
        .when((region == "Body") & kind.isin("paragraph", "text_block", "table", "figure"), "Normative")
    )


def unambiguous(kind: Column, region: Column, section: Column, label: Column, layout_text: Column) -> Column:
    """Whether the place alone settles the expected status; where it does not, a person has to look."""
    body = (region == "Body") & (section_one_label(section, label) | kind.isin("paragraph", "text_block", "table", "figure"))
    return F.coalesce(layout_text, F.lit(False)) | F.coalesce(kind == "heading", F.lit(False)) | F.coalesce(region.isin(*P.APPARATUS_REGIONS, "Annex", "Appendix"), F.lit(False)) | F.coalesce(body, F.lit(False))


def rule_conflicts(records: DataFrame) -> DataFrame:
    """Number of records for each pair of statuses the two rules give, where they differ."""
    r = records.select(
        "element_type", "source_region",
        classify(F.col("element_type"), F.col("source_region"), F.col("element_id"), F.col("section_path")).alias("segmenter_status"),
        F.coalesce(expected(F.col("element_type"), F.col("source_region"), F.array_join("section_path", " > "), F.coalesce("element_id", F.lit("")), F.lit(False)), F.lit("none")).alias("audit_status"),
    )
    return r.where("segmenter_status <> audit_status").groupBy("element_type", "source_region", "segmenter_status", "audit_status").agg(F.count("*").alias("n"))
