"""Reports and heads of files, written on the driver from bounded aggregates."""

from __future__ import annotations

import csv
import hashlib
import json
import uuid
from collections.abc import Iterable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest import __version__
from palimpsest.operators import export, qa
from palimpsest.operators.audit import ranked

LEGEND = """## Status and region

- Normative: requirements and guidance of body and appendices.
- Informative: annexes and footnotes.
- Informational: introductions, headings, references, front and back matter.
"""
#: Which label a repair rule belongs to.
RULE_LABELS = {
    "metadata_title_from_source_pdf": "metadata_title_mismatch",
    "remove_non_semantic_control_characters": "control_or_garbage_chars",
    "mark_figure_layout_text_informational": "figure_or_diagram_text_leakage",
    "status_from_region_section_rule": "section_status_mismatch",
    "add_stable_internal_id": "record_id_collision_or_ambiguity",
}


def label_of(rule: str) -> str:
    return RULE_LABELS.get(rule, rule)


def snapshot(values: dict[str, str]) -> str:
    """Changed fields as JSON with sorted keys; empty for none."""
    return json.dumps(values, ensure_ascii=False, sort_keys=True) if values else ""


def write_json(path: str | Path, value: Any) -> None:
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def write_json_lines(path: str | Path, rows: Iterable[dict]) -> None:
    with Path(path).open("w", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")


def write_csv_rows(path: str | Path, rows: Iterable[dict], fields: Iterable[str]) -> None:
    with Path(path).open("w", encoding="utf-8", newline="") as f:
        w = csv.DictWriter(f, fieldnames=list(fields), extrasaction="ignore")
        w.writeheader()
        w.writerows(rows)


def _counts(df: DataFrame, c: str) -> dict[str, int]:
    """Counts by a column of few values."""
    return {str(r[0]): r[1] for r in df.groupBy(c).agg(F.count("*").alias("n")).orderBy(c).collect()}


def _table(title: str, counts: dict[str, int]) -> list[str]:
    return [f"## {title}", "", *(f"- {k}: {v}" for k, v in counts.items()), ""]


def findings_report(findings: DataFrame, title: str = "QA report", top: int = qa.TOP_EXAMPLES) -> str:
    """Markdown: counts by check and severity, and the first findings."""
    rows = qa.top_examples(findings, top).collect()
    out = [f"# {title}", "", f"Findings: {findings.count()}", "", *_table("By severity", _counts(findings, "severity")), *_table("By check", _counts(findings, "check")), "## Examples", ""]
    return "\n".join(out + [f"- {r['severity']} {r['check']}: {r['doc_id']} {r['record_id']} p. {r['page']} - {r['reason']}" for r in rows]) + "\n"


def findings_json(findings: DataFrame, path: str | Path, metadata: dict | None = None, top: int = qa.TOP_EXAMPLES) -> None:
    """Summary and first findings as JSON; all findings are written as a table by the caller."""
    by = {d: {r["value"]: r["n"] for r in qa.summarize(findings).where(F.col("dimension") == d).orderBy("value").toLocalIterator()} for d in ("check", "severity", "document")}
    write_json(path, {"metadata": metadata or {}, "summary": {"total_findings": findings.count()} | {f"by_{k}": v for k, v in by.items()}, "examples": [r.asDict() for r in qa.top_examples(findings, top).collect()]})


def records_report(records: DataFrame, findings: DataFrame, most_low: int = 50) -> str:
    """Markdown: total, counts by type, status and region, types without records, records of low confidence, first findings."""
    from palimpsest.functions.patterns import ELEMENT_TYPES

    types = _counts(records, "element_type")
    low = records.where("confidence = 'low'").orderBy("document_id", "seq", "record_id").limit(most_low).select("record_id", "page_start_pdf").collect()
    out = ["# QA report", "", f"Total structural records: {records.count()}", "", *_table("Types", types), *_table("Statuses", _counts(records, "text_status")), *_table("Regions", _counts(records, "source_region"))]
    out += ["## Types without records", "", *(f"- {t}" for t in ELEMENT_TYPES if t not in types), "", "## Low confidence", "", *(f"- {r[0]} (p. {r[1]})" for r in low), ""]
    return "\n".join(out) + "\n" + findings_report(findings, "Findings")


def audit_report(summary: dict[str, int], candidates: DataFrame, most: int = 20) -> str:
    out = ["# Audit", "", *(f"- {k}: {v}" for k, v in sorted(summary.items())), "", "## First candidates", ""]
    return "\n".join(out + [f"- {r['severity']} {r['error_label']} ({r['confidence']:.2f}): {r['doc']} {r['record']} - {r['evidence'][:200]}" for r in ranked(candidates, most).collect()]) + "\n"


def run_info(docs: DataFrame, records: DataFrame, series: dict | None = None) -> dict:
    """Id of a run, version and checksum of its documents."""
    series = series or {}
    return {"run_id": str(uuid.uuid4()), "parser_version": __version__, "series_id": series.get("series_id", ""), "series_name": series.get("series_name", ""), "document_manifest_checksum": export.document_manifest_checksum(docs, records)}


def manifest_json(docs: DataFrame, records: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """One JSON text per document with nested counts, and one per failed file."""
    m = export.manifest_rows(records, docs).join(export.type_counts(records), "document_id", "left")
    ok = m.select(F.to_json(F.struct(F.lit("ok").alias("status"), *m.columns)).alias("value"))
    if failures is None:
        return ok
    return ok.unionByName(failures.select(F.to_json(F.struct(F.lit("failed").alias("status"), "source_pdf", "error")).alias("value")))


def preamble(title: str, number: int, total: int, documents: Iterable[str], info: dict | None = None) -> str:
    """Head of a part: its number, its documents, the legend."""
    lines = [f"# {title}", "", f"Part {number} of {total}", ""] + [f"- {k}: {v}" for k, v in (info or {}).items()]
    return "\n".join([*lines, "", "## Documents in this part", "", *documents, "", LEGEND, "## Structural records", ""])


def document_summary(document_id: str, number: str, kind: str, title: str, n_records: int) -> str:
    return f"- {document_id} | {number} | {kind} | {title} | records: {n_records}"


def parts_readme(names: Iterable[str], max_bytes: int) -> str:
    return "\n".join(["# Knowledge parts", "", f"Most bytes of a part: {max_bytes:,}", "", *(f"- {n}" for n in names)]) + "\n"


def document_markdown(records: DataFrame, document_id: str) -> str:
    """One publication as Markdown; its records are streamed to the driver in order."""
    d = records.where(F.col("document_id") == document_id)
    head = d.select("document_title", "document_family", "series_name", "series_number", "document_category", "document_type", "document_domain").first()
    if head is None:
        return ""
    names = ("Title", "Family", "Series", "Number", "Category", "Type", "Domain")
    meta = "\n".join(f"- {n}: {v or ''}" for n, v in zip(names, head))
    blocks = (r[0] for r in d.orderBy("seq", "record_id").select(export.markdown_block()).toLocalIterator())
    return f"# {head[0]}\n\n## Document metadata\n\n- Document ID: {document_id}\n{meta}\n\n{LEGEND}\n## Structural records\n" + "".join(blocks)
