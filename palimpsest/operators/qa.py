"""Quality checks: records in, findings out. Every check is a filter, a window or a join.

Rows repeated in a table are checked as they stand. Null texts count as
blank; null regions and statuses count as invalid. Sample rows of findings
about a document are its first by ``seq``, then by ``record_id``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import sequence
from palimpsest.operators.status import classify

COLLISION_THRESHOLD, SHORT_TEXT, TOP_EXAMPLES = 3, 90, 20
COLUMNS = ("check", "severity", "doc_id", "record_id", "element_type", "element_id", "page", "section", "reason", "suggested_fix")


def finding(rows: DataFrame, check: str, severity: Column | str, reason: Column | str, fix: str) -> DataFrame:
    """Records as rows of findings."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select(
        F.lit(check).alias("check"), lit(severity).alias("severity"), F.col("document_id").alias("doc_id"), "record_id", "element_type", "element_id",
        X.page_label("page_start_pdf", "page_end_pdf").alias("page"), F.array_join("section_path", " > ").alias("section"), lit(reason).alias("reason"), F.lit(fix).alias("suggested_fix"),
    )


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _first_of_document(records: DataFrame) -> DataFrame:
    """One row per document, its first; a partial aggregate, no window over a document."""
    s = F.struct("element_type", "element_id", "page_start_pdf", "page_end_pdf", "section_path", "record_id")
    return records.groupBy("document_id").agg(F.min_by(s, F.struct(F.coalesce("seq", F.lit(2**62)), F.coalesce("record_id", F.lit("")))).alias("s")).select("document_id", "s.*")


def schema_validation(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Invalid statuses and regions, documents that no manifest row has, blank texts."""
    known = manifest.select("document_id").where("document_id is not null").distinct()
    bad = lambda c, values: F.col(c).isNull() | ~F.col(c).isin(*values)
    return union([
        finding(records.where(bad("text_status", P.STATUSES)), "schema_validation", "critical", "invalid status", "fix the classification"),
        finding(records.where(bad("source_region", P.REGIONS)), "schema_validation", "critical", "invalid region", "fix the detection of regions"),
        finding(records.join(known, "document_id", "left_anti"), "schema_validation", "critical", "document without manifest row", "make records and manifest in one run"),
        finding(records.where(X.strip(F.coalesce("text", F.lit(""))) == ""), "schema_validation", "medium", "blank text", "look into the extraction"),
    ])


def requirement_boundary(records: DataFrame, least_records: int = 30) -> DataFrame:
    """Requirement markers inside prose; requirements documents without a requirement."""
    at = F.regexp_instr("text", F.lit(P.REQUIREMENT_MARKER))
    inside = records.where(F.col("element_type").isin("paragraph", "text_block") & (at > 0))
    per_doc = records.groupBy("document_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("element_type") == "requirement").alias("n_req"), F.min_by("document_type", F.struct(F.coalesce("seq", F.lit(2**62)), F.coalesce("record_id", F.lit("")))).alias("kind")
    )
    none = per_doc.where((F.lower("kind").contains("requirements")) & (F.col("n") >= least_records) & (F.col("n_req") == 0)).select("document_id")
    return union([
        finding(inside, "requirement_boundary", F.when(at > 1, "high").otherwise("medium"), "requirement marker inside other text", "split at the marker"),
        finding(_first_of_document(records).join(none, "document_id", "left_semi"), "requirement_boundary", "high", "requirements document without requirements", "look into the detection of requirements"),
    ])


def footnote_contamination(records: DataFrame) -> DataFrame:
    """Footnote bodies inside other text; documents with such text and no footnote at all."""
    hit = records.where(F.col("element_type").isin("paragraph", "requirement", "text_block") & F.col("text").rlike(P.FOOTNOTE_BODY))
    docs = hit.select("document_id").distinct().join(records.where("element_type = 'footnote'").select("document_id").distinct(), "document_id", "left_anti")
    return union([
        finding(hit, "footnote_contamination", F.when(F.col("text_status") == "Normative", "high").otherwise("medium"), "footnote body inside other text", "split the footnote off"),
        finding(_first_of_document(records).join(docs, "document_id", "left_semi"), "footnote_contamination", "medium", "document without footnotes", "look into the detection of footnotes"),
    ])


def page_furniture(records: DataFrame) -> DataFrame:
    hit = records.where(F.col("element_type").isin("paragraph", "requirement", "text_block") & F.col("text").rlike(P.PAGE_FURNITURE))
    return finding(hit, "header_footer_leakage", "high", "page furniture inside text", "strip page furniture first")


def heading_splits(records: DataFrame) -> DataFrame:
    """Two headings in a row of which the first ends with a continuation word; path parts that end so."""
    keep = ["document_id", "record_id", "seq", "element_type", "element_id", "page_start_pdf", "page_end_pdf", "section_path", "text"]
    nxt = sequence.following(records.select(*keep), ["document_id"], "seq", "record_id", ["element_type", "page_start_pdf"])
    split = nxt.where((F.col("element_type") == "heading") & (F.col("_n_element_type") == "heading") & (F.col("_n_page_start_pdf") == F.col("page_start_pdf")) & X.ends_with_continuation("text"))
    part = records.where(F.exists("section_path", X.ends_with_continuation))
    return union([
        finding(split, "heading_split", "medium", "wrapped heading", "merge the two headings"),
        finding(part, "heading_split", "medium", "section path ends with a continuation word", "rebuild the sections"),
    ])


def contents_pollution(records: DataFrame) -> DataFrame:
    return union([
        finding(records.where((F.col("source_region") == "Body") & F.col("text").rlike(P.DOT_LEADER)), "toc_pollution", "high", "dot leaders in the body", "keep contents out of the body"),
        finding(records.where(F.exists("section_path", lambda x: x.rlike(P.DOT_LEADER) | x.rlike(P.CONTENTS_PATH))), "toc_pollution", "medium", "contents text in a section path", "keep contents out of sections"),
    ])


def table_paragraph_collisions(records: DataFrame, threshold: int = COLLISION_THRESHOLD, short: int = SHORT_TEXT) -> DataFrame:
    """Ids repeated by short paragraphs; tables whose pages hold many short paragraphs.

    The first short rows of a group come from a partial top-k aggregate; the
    range join runs on (document, page), tables spread over their pages, so
    a document with many records is split by page.
    """
    par = records.where("element_type = 'paragraph'")
    is_short = F.length("text") <= short
    key = ["document_id", "element_id"]
    grouped = par.where("element_id is not null and element_id <> ''")
    groups = grouped.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(is_short).alias("n_short"))
    hot = groups.where((F.col("n") > threshold) & (F.col("n_short") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2)))).select(*key)
    rn = F.row_number().over(Window.partitionBy(*key).orderBy("seq", "record_id"))
    first = grouped.where(is_short).join(hot, key, "left_semi").withColumn("_rn", rn).where(F.col("_rn") <= threshold)
    per_page = par.where(is_short).groupBy("document_id", F.col("page_start_pdf").alias("page")).agg(F.count("*").alias("n"))
    tables = records.where("element_type = 'table' and page_start_pdf <= page_end_pdf")
    pages = tables.select("document_id", "record_id", "seq", F.explode(F.sequence("page_start_pdf", "page_end_pdf")).alias("page"))
    many = pages.join(per_page, ["document_id", "page"]).groupBy("document_id", "record_id", "seq").agg(F.sum("n").alias("n")).where(F.col("n") > threshold)
    return union([
        finding(first, "table_paragraph_collision", "medium", "repeated short paragraph", "detect tables before paragraphs"),
        finding(tables.join(many.select("document_id", "record_id", "seq"), ["document_id", "record_id", "seq"], "left_semi"), "table_paragraph_collision", "medium", "many short paragraphs on a table's pages", "review the table"),
    ])


def status_consistency(records: DataFrame) -> DataFrame:
    rule = classify(F.col("element_type"), F.col("source_region"), F.col("element_id"), F.col("section_path"))
    return finding(records.where(~F.col("text_status").eqNullSafe(rule)), "status_region_consistency", "critical", F.concat(F.lit("rule gives "), rule), "classify again")


def text_quality(records: DataFrame) -> DataFrame:
    checks = ((P.CONTROL, "low", "control character"), (P.DAMAGE, "high", "encoding damage"), (P.HYPHEN_LEFT, "low", "hyphenation left"), (P.PAGE_ID_JOIN, "medium", "page number joined to an id"))
    # one pass over the records, one row per check that fires
    fired = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.struct(F.lit(s).alias("severity"), F.lit(r).alias("reason"))) for p, s, r in checks]))
    hit = records.withColumn("_f", F.explode(fired))
    return finding(hit, "text_quality", F.col("_f.severity"), F.col("_f.reason"), "repair against the source")


def manifest_consistency(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest documents without records, documents without manifest row, counts that differ (last run wins)."""
    ok = manifest.where("status = 'ok' and document_id is not null")
    last = ok.groupBy("document_id").agg(F.max_by("record_count", F.struct("run_id", "record_count")).alias("expected"))
    counts = records.where("document_id is not null").groupBy("document_id").agg(F.count_distinct("record_id").alias("n"))
    both = last.join(counts, "document_id", "full")
    state = F.when(F.col("n").isNull(), "manifest document has no records").when(F.col("expected").isNull(), "document is absent from the manifest").when(F.col("n") != F.col("expected"), "record count differs")
    return both.withColumn("reason", state).where("reason is not null").select(
        F.lit("manifest_consistency").alias("check"), F.lit("critical").alias("severity"), F.col("document_id").alias("doc_id"), F.lit("").alias("record_id"), F.lit("").alias("element_type"),
        F.lit(None).cast("string").alias("element_id"), F.lit("").alias("page"), F.lit("").alias("section"), "reason", F.lit("make records and manifest in one run").alias("suggested_fix"),
    )


def record_id_collisions(records: DataFrame) -> DataFrame:
    """Every row of an id that occurs more than once."""
    twice = records.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").select("record_id")
    return finding(records.join(twice, "record_id", "left_semi"), "record_id_collision_or_ambiguity", "critical", "record id is repeated", "add a stable id")


def parse_failures(manifest: DataFrame) -> DataFrame:
    return manifest.where("status <> 'ok' or status is null").select(
        F.lit("parse_failure").alias("check"), F.lit("critical").alias("severity"), F.coalesce("document_id", F.lit("")).alias("doc_id"), F.lit("").alias("record_id"), F.lit("").alias("element_type"),
        F.lit(None).cast("string").alias("element_id"), F.lit("").alias("page"), F.lit("").alias("section"), F.concat_ws(": ", "source_pdf", "error").alias("reason"), F.lit("look into the file").alias("suggested_fix"),
    )


def run_checks(records: DataFrame, manifest: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """All findings. ``raw`` are the rows before those of repeated ids were dropped, where they were."""
    return union([
        schema_validation(records, manifest), requirement_boundary(records), footnote_contamination(records), page_furniture(records), heading_splits(records), contents_pollution(records),
        table_paragraph_collisions(records), status_consistency(records), text_quality(records), manifest_consistency(records, manifest), record_id_collisions(records if raw is None else raw), parse_failures(manifest),
    ])


def summarize(findings: DataFrame) -> DataFrame:
    """Counts by check, by severity, by document and in all, in one aggregate (dimension, value, n)."""
    f = findings.select("check", "severity", F.coalesce(F.nullif("doc_id", F.lit("")), F.lit("<series>")).alias("doc_id"))
    dims = ["check", "severity", "doc_id"]
    g = f.groupingSets([*[[c] for c in dims], []], *dims).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    dim = F.when(F.col("g") == 3, "check").when(F.col("g") == 5, "severity").when(F.col("g") == 6, "document").otherwise("total")
    return g.select(dim.alias("dimension"), F.coalesce("check", "severity", "doc_id", F.lit("all")).alias("value"), "n")


def severity_rank(c: Column) -> Column:
    return F.when(c == "critical", 0).when(c == "high", 1).when(c == "medium", 2).when(c == "low", 3).otherwise(9)


def top_examples(findings: DataFrame, n: int = TOP_EXAMPLES) -> DataFrame:
    """The first findings by severity, document, page (as text) and record: a top-k report."""
    return findings.withColumn("rank", severity_rank(F.col("severity"))).orderBy("rank", "doc_id", "page", "record_id", "check", "reason").limit(n).drop("rank")
