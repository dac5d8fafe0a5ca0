"""Queries of the core operators over whole tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import audit, export, lines, metadata, qa, report, segment, sequence, titles
from palimpsest.operators import status as S
from palimpsest.session import checkpoint, table
from palimpsest.sources import blocks

Query = Callable[[SparkSession, str], DataFrame]

#: What the test tables' invented publisher prints.
BOARD = metadata.Publisher(
    series=("Meridian Protection Series", "Meridian Safeguarding Series", "Northmark Transport Series"),
    number=r"(?:MPG|MSG|NTR)-[0-9]+(?:-REV[0-9]+)?",
    categories=(("Protection Guide", "MPG-|MERIDIAN PROTECTION"), ("Safeguarding Notes", "MSG-|MERIDIAN SAFEGUARDING"), ("Transport Rules", "NTR-|NORTHMARK TRANSPORT")),
    domains=(("radiation_protection", "MPG-|MERIDIAN PROTECTION"), ("facility_security", "MSG-|MERIDIAN SAFEGUARDING"), ("material_transport", "NTR-|NORTHMARK TRANSPORT")),
)


def _records(spark, d):
    return export.current(table(spark, d, "records"))


def _pages(spark, d):
    return lines.current_pages(table(spark, d, "page_texts"))


def _knowledge(spark, d):
    return audit.current(table(spark, d, "knowledge"))


# --- lines --------------------------------------------------------------


def page_line_kinds(spark, d):
    return lines.page_lines(_pages(spark, d)).groupBy(X.line_kind("line").alias("kind")).agg(F.count("*").alias("n"))


def printed_page_numbers(spark, d):
    return lines.page_numbers_cut(_pages(spark, d)).select("source_file", "pdf_page", "found_page", F.size("lines").cast("long").alias("n_lines"))


def furniture_lines(spark, d):
    return lines.with_furniture(lines.page_lines(_pages(spark, d))).where("furniture").select("source_file", "pdf_page", "line_no", "line")


def unwrapped_lines(spark, d):
    return lines.unwrapped(_pages(spark, d)).select("source_file", "pdf_page", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("text"))


def segmented_records(spark, d):
    return segment.records(table(spark, d, "page_texts"), table(spark, d, "docs")).select("record_id", "document_id", "seq", "element_type", "element_id", "source_region", "text_status", "status_reason", "section_path", "page_start_pdf", "page_end_pdf", "text")


def segmented_counts(spark, d):
    return segment.records(table(spark, d, "page_texts"), table(spark, d, "docs")).groupBy("element_type", "source_region", "text_status").agg(F.count("*").alias("n"))


def inferred_metadata(spark, d):
    return metadata.infer(table(spark, d, "page_texts"), BOARD)


# --- records ------------------------------------------------------------


def record_status_counts(spark, d):
    return _records(spark, d).groupBy("element_type", "text_status").agg(F.count("*").alias("n"))


def record_dimension_counts(spark, d):
    r = _records(spark, d)
    dims = ["element_type", "text_status", "source_region"]
    g = r.groupingSets([[c] for c in dims], *dims).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    return g.select(F.when(F.col("g") == 3, "type").when(F.col("g") == 5, "status").otherwise("region").alias("dimension"), F.coalesce(*dims).alias("value"), "n")


def status_rule_conflicts(spark, d):
    return S.rule_conflicts(_records(spark, d))


def rule_statuses(spark, d):
    return _records(spark, d).select("record_id", S.classify(F.col("element_type"), F.col("source_region"), F.col("element_id"), F.col("section_path")).alias("rule_status"))


def rule_reasons(spark, d):
    return _records(spark, d).groupBy(S.reason(F.col("element_type"), F.col("source_region"), F.col("element_id"), F.col("section_path")).alias("reason")).agg(F.count("*").alias("n"))


def section_paths(spark, d):
    return _records(spark, d).select("record_id", export.section().alias("section"), F.coalesce(F.size("section_path"), F.lit(0)).cast("long").alias("depth"))


def record_numbers(spark, d):
    r = sequence.numbered(_records(spark, d).select("document_id", "record_id", "seq", "element_type", "element_id", "page_start_pdf"), ["document_id"], "seq", "record_id", "number")
    key = F.coalesce("element_id", F.concat("element_type", F.lit("-"), F.lpad(F.col("number").cast("string"), 5, "0")))
    return r.select("record_id", "number", F.concat_ws(":", "document_id", "element_type", key, F.concat(F.lit("p"), F.col("page_start_pdf").cast("string")), F.concat(F.lit("r"), F.lpad(F.col("number").cast("string"), 5, "0"))).alias("made_id"))


def region_carry_forward(spark, d):
    """The last region seen before each record that is not the body's, per document."""
    r = _records(spark, d).select("document_id", "record_id", "seq", "source_region")
    other = sequence.carried(r, ["document_id"], "seq", "record_id", F.when(F.col("source_region") != "Body", F.col("source_region")), "other")
    return other.select("record_id", F.coalesce("other", F.lit("none")).alias("last_other_region"))


def heading_caps(spark, d):
    r = _records(spark, d).where("element_type = 'heading'")
    return r.select("record_id", F.round(F.coalesce(X.caps_ratio("text"), F.lit(0.0)), 6).alias("caps_ratio"), X.is_caps_heading("text").alias("caps_heading"))


# --- quality ------------------------------------------------------------


def _found(check):
    def run(spark, d):
        return check(spark, d).select("check", "severity", "doc_id", "record_id", "page", "section", "reason")

    return run


qa_schema = _found(lambda s, d: qa.schema_validation(_records(s, d), table(s, d, "manifest")))
qa_requirements = _found(lambda s, d: qa.requirement_boundary(_records(s, d)))
qa_footnotes = _found(lambda s, d: qa.footnote_contamination(_records(s, d)))
qa_furniture = _found(lambda s, d: qa.page_furniture(_records(s, d)))
qa_headings = _found(lambda s, d: qa.heading_splits(_records(s, d)))
qa_contents = _found(lambda s, d: qa.contents_pollution(_records(s, d)))
qa_collisions = _found(lambda s, d: qa.table_paragraph_collisions(_records(s, d)))
qa_status = _found(lambda s, d: qa.status_consistency(_records(s, d)))
qa_text = _found(lambda s, d: qa.text_quality(_records(s, d)))
qa_manifest = _found(lambda s, d: qa.manifest_consistency(_records(s, d), table(s, d, "manifest")))
qa_record_ids = _found(lambda s, d: qa.record_id_collisions(table(s, d, "records")))
qa_failures = _found(lambda s, d: qa.parse_failures(table(s, d, "manifest")))


def qa_summary(spark, d):
    return qa.summarize(qa.run_checks(_records(spark, d), table(spark, d, "manifest")))


#: What the checks read of a record.
_CHECKED = ("record_id", "document_id", "document_type", "seq", "element_type", "element_id", "source_region", "text_status", "section_path", "page_start_pdf", "page_end_pdf", "text", "extracted_at")


def qa_top(spark, d):
    raw = table(spark, d, "records").select(*_CHECKED)
    latest = checkpoint(export.current(raw))  # read by every check
    findings = qa.run_checks(latest, table(spark, d, "manifest"), raw)  # the latest rows have every record id once
    return qa.top_examples(findings).select("severity", "doc_id", "page", "record_id", "reason")


# --- exports ------------------------------------------------------------


def chunk_texts(spark, d):
    return export.chunk_records(_records(spark, d)).select("record_id", "gpt_chunk_text")


def csv_preview(spark, d):
    return export.csv_preview(_records(spark, d))


def markdown_blocks(spark, d):
    return _records(spark, d).select("record_id", export.markdown_block().alias("block"), F.octet_length(export.markdown_block()).cast("long").alias("n_bytes"))


def document_headers(spark, d):
    return _records(spark, d).select("document_id", export.document_header(True).alias("header")).distinct()


def part_packing(spark, d):
    return export.part_numbers(_records(spark, d), 300_000)


def part_packing_spread(spark, d):
    return export.part_numbers(_records(spark, d), 300_000, streams=32)


def block_roundtrip(spark, d):
    """Blocks written to parts by a few records each, read back."""
    r = _records(spark, d).where("text is not null").select(F.concat(F.lit("part_"), F.lpad(F.floor(F.col("seq") / 50).cast("string"), 5, "0"), F.lit("_"), F.col("document_id")).alias("part_file"), "seq", "record_id", export.markdown_block().alias("b"))
    parts = r.groupBy("part_file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "record_id", "b"))), lambda x: x["b"]), "").alias("value"))
    return blocks.parse_blocks(parts)


def manifest_rows(spark, d):
    return export.manifest_rows(_records(spark, d), table(spark, d, "docs"))


def manifest_latest(spark, d):
    return blocks.latest_manifest(table(spark, d, "manifest")).select("document_id", "run_id", "source_pdf", "record_count")


def type_counts(spark, d):
    return export.type_counts(_records(spark, d)).select("document_id", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


def document_changes(spark, d):
    return export.document_changes(_knowledge(spark, d)).where("new_document").select("part_file", "doc", "original_record_index")


def document_ids(spark, d):
    t = table(spark, d, "docs")
    return t.select("document_id", metadata.document_id(F.col("series_number"), F.col("title")).alias("made_id"), X.compact_id("document_id").alias("compact"), X.slug("title").alias("slug"), X.path_component("series_number", "document").alias("folder"))


# --- audit --------------------------------------------------------------


def _cand(fn):
    def run(spark, d):
        return fn(_knowledge(spark, d)).select("stable_internal_id", "error_label", "severity", "confidence", "auto_fixed")

    return run


audit_controls = _cand(audit.control_or_garbage)
audit_symbols = _cand(audit.symbol_errors)
audit_tables = _cand(audit.table_contamination)
audit_figures = _cand(audit.figure_leakage)
audit_headings = _cand(audit.heading_fragmentation)
audit_statuses = _cand(lambda k: audit.status_mismatch(k))
audit_labels = _cand(audit.label_collisions)


def stable_ids(spark, d):
    return audit.stable_ids(_knowledge(spark, d))


def _titles(spark, d):
    return audit.title_repairs(table(spark, d, "manifest"), table(spark, d, "docs"))


def audit_candidates(spark, d):
    return audit.detect(table(spark, d, "knowledge"), _titles(spark, d)).select("stable_internal_id", "error_label", "severity", "confidence", "auto_fixed")


def audit_clean(spark, d):
    return audit.clean_records(table(spark, d, "knowledge"))


def audit_corrections(spark, d):
    return audit.corrections(table(spark, d, "knowledge"), _titles(spark, d))


def audit_summary(spark, d):
    return audit.summary(table(spark, d, "knowledge"), _titles(spark, d))


def audit_top(spark, d):
    return audit.ranked(audit.detect(table(spark, d, "knowledge"), _titles(spark, d))).select("stable_internal_id", "severity", "confidence", "doc")


def audit_concentration(spark, d):
    return audit.concentration(table(spark, d, "knowledge"), titles=_titles(spark, d))


def control_repair(spark, d):
    return _knowledge(spark, d).where(F.col("text").rlike(P.WIDE_CONTROL)).select("stable_internal_id", X.remove_controls("text").alias("text"))


def report_texts(spark, d):
    return _knowledge(spark, d).select("stable_internal_id", X.sanitize("text").alias("sanitized"), X.preview("text").alias("preview"))


def garbage_texts(spark, d):
    return _knowledge(spark, d).where(X.looks_like_garbage("text")).select("stable_internal_id", X.has_odd_symbols("text").alias("odd_symbols"))


def title_overlap(spark, d):
    m = blocks.latest_manifest(table(spark, d, "manifest")).select("document_id", "document_title")
    t = table(spark, d, "docs").select("document_id", "title")
    return m.join(t, "document_id").where("document_title is not null and title is not null").select("document_id", F.round(X.token_overlap("document_title", "title"), 6).alias("overlap"))


def title_mismatches(spark, d):
    return audit.title_mismatches(table(spark, d, "manifest"), table(spark, d, "docs"))


def category_slugs(spark, d):
    return table(spark, d, "docs").where("document_category is not null").groupBy(titles.category_slug(F.col("document_category")).alias("slug")).agg(F.count("*").alias("n"))


def file_titles(spark, d):
    return table(spark, d, "docs").select("document_id", titles.from_file_name(F.col("source_file"), [r"mb[0-9]+"]).alias("file_title"))


def manifest_texts(spark, d):
    failed = table(spark, d, "manifest").where("status <> 'ok'").select("source_pdf", "error")
    return report.manifest_json(table(spark, d, "docs"), _records(spark, d), failed)


_NAMES = (
    page_line_kinds, printed_page_numbers, furniture_lines, unwrapped_lines, segmented_records, segmented_counts, inferred_metadata, record_status_counts, record_dimension_counts,
    status_rule_conflicts, rule_statuses, rule_reasons, section_paths, record_numbers, region_carry_forward, heading_caps, qa_summary, qa_top, chunk_texts, csv_preview, markdown_blocks, document_headers,
    part_packing, part_packing_spread, block_roundtrip, manifest_rows, manifest_latest, type_counts, document_changes, document_ids, stable_ids, audit_candidates, audit_clean, audit_corrections, audit_summary,
    audit_top, audit_concentration, category_slugs, file_titles, manifest_texts, control_repair, report_texts, garbage_texts, title_overlap, title_mismatches,
)


def queries() -> dict[str, Query]:
    out = {f.__name__: f for f in _NAMES}
    out |= {
        "qa_schema": qa_schema, "qa_requirements": qa_requirements, "qa_footnotes": qa_footnotes, "qa_furniture": qa_furniture, "qa_headings": qa_headings, "qa_contents": qa_contents,
        "qa_collisions": qa_collisions, "qa_status": qa_status, "qa_text": qa_text, "qa_manifest": qa_manifest, "qa_record_ids": qa_record_ids, "qa_failures": qa_failures,
        "audit_controls": audit_controls, "audit_symbols": audit_symbols, "audit_tables": audit_tables, "audit_figures": audit_figures, "audit_headings": audit_headings,
        "audit_statuses": audit_statuses, "audit_labels": audit_labels,
    }
    return out


def oracle_sql() -> dict[str, str]:
    from palimpsest.plans.oracle import sql

    return sql()
