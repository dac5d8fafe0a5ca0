"""Audit of exported records: candidates, repairs, labels, summary.

Every detector is a DataFrame of candidates; repairs are derived columns, so
that raw rows stay as they are. ``layout_text`` and ``layout_ambiguous`` are
derived as well. Null fields count as empty.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import sequence
from palimpsest.operators import status as S
from palimpsest.operators.qa import severity_rank
from palimpsest.session import ship_package

FIELDS = ("doc", "record", "status", "region", "pdf", "section", "text")
FIGURE_WINDOW, TITLE_SIMILARITY, TITLE_OVERLAP, AUTO_TITLE, AGREEING_TITLE = 4, 0.45, 0.25, 0.78, 0.75
CANDIDATE = ("doc", "record", "pdf", "section", "error_label", "severity", "confidence", "evidence", "suggested_action", "part_file", "original_record_index", "stable_internal_id", "auto_fixed")


def current(knowledge: DataFrame) -> DataFrame:
    """One row per stable id: repeated rows are equal, one of them stays."""
    return knowledge.dropDuplicates(["stable_internal_id"])


def candidate(rows: DataFrame, label: str, severity: Column | str, confidence: Column | float, evidence: Column, action: Column | str, auto: Column | bool) -> DataFrame:
    if label not in P.ERROR_LABELS:
        raise ValueError(f"unknown label {label}")
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select(
        "doc", "record", "pdf", "section", F.lit(label).alias("error_label"), lit(severity).alias("severity"), lit(confidence).cast("double").alias("confidence"), evidence.alias("evidence"),
        lit(action).alias("suggested_action"), "part_file", "original_record_index", "stable_internal_id", lit(auto).alias("auto_fixed"),
    )


def stable_ids(knowledge: DataFrame) -> DataFrame:
    """original_record_index and stable id: slugs of doc, type and label, page, hash of the section, number in load order.

    Numbered within (doc, type, label, section, page), so that a document's
    records spread over many groups.
    """
    kind = F.coalesce(F.split_part("record", F.lit(" "), F.lit(1)), F.lit(""))
    label = F.when(F.col("record").contains(" "), F.expr("substring(record, instr(record, ' ') + 1)")).otherwise("")
    k = knowledge.select(
        "original_record_index", "doc", kind.alias("kind"), label.alias("label"), F.substring(F.sha1(F.coalesce("section", F.lit(""))), 1, 8).alias("section_hash"),
        F.regexp_extract(X.strip("pdf"), rf"^({P.D}+)", 1).alias("page"),
    )
    n = F.row_number().over(Window.partitionBy("doc", "kind", "label", "section_hash", "page").orderBy("original_record_index"))
    ident = F.concat_ws("__", X.slug("doc"), X.slug("kind"), X.slug(F.coalesce(F.nullif("label", F.lit("")), F.lit("none"))), F.concat(F.lit("p"), F.coalesce(F.nullif("page", F.lit("")), F.lit("unknown"))), F.col("section_hash"), F.lpad(n.cast("string"), 4, "0"))
    return k.select("original_record_index", ident.alias("stable_id"))


def control_fields(c: Column | None = None) -> Column:
    """Names of the fields that hold control characters."""
    return F.array_compact(F.array(*[F.when(F.col(f).rlike(P.WIDE_CONTROL), F.lit(f)) for f in FIELDS]))


def control_or_garbage(k: DataFrame) -> DataFrame:
    """Control characters (repaired) and unreadable text (for review): up to two candidates a row, in one pass."""
    names = control_fields()
    labels = F.array_compact(F.array(
        F.when(F.col("text").contains("�"), F.lit("replacement character")), F.when(F.col("text").rlike(P.PRIVATE_USE), F.lit("private-use glyph")), F.when(X.looks_like_garbage("text"), F.lit("unreadable text")),
    ))
    a = candidate(k.where(F.size(names) > 0), "control_or_garbage_chars", "low", 0.96, F.concat(F.lit("controls in "), F.array_join(names, ", ")), "remove control characters", True)
    b = candidate(k.where(F.size(labels) > 0), "control_or_garbage_chars", "medium", 0.72, F.array_join(labels, "; "), "review unreadable text", False)
    return a.unionByName(b)


def symbol_errors(k: DataFrame) -> DataFrame:
    """A pound sign before a figure, as scanners make of other signs."""
    return candidate(k.where(F.col("text").rlike(P.POUND_NUMBER)), "likely_ocr_symbol_error", "high", 0.74, F.concat(F.lit("suspicious symbol: "), X.preview("text")), "compare with the source", False)


def table_reasons() -> Column:
    t = F.col("text")
    return F.array_compact(F.array(
        F.when(t.rlike(P.TABLE_CONTAMINATION), F.lit("following heading or prose")), F.when(F.regexp_count(t, F.lit(r"\(cont\.\)")) > 1, F.lit("continued tables in one record")),
        F.when(t.rlike(P.NEXT_SECTION), F.lit("next section inside the table")), F.when(t.rlike(P.NOTE_THEN_PROSE), F.lit("note followed by prose")),
    ))


def table_contamination(k: DataFrame) -> DataFrame:
    hit = k.where((F.col("record_type") == "table") & (F.size(table_reasons()) > 0))
    return candidate(hit, "table_flattened_or_contaminated", "medium", 0.80, F.array_join(table_reasons(), "; "), "mark as ambiguous layout", False)


def is_figure_label() -> Column:
    t = X.normalize_line("text")
    return t.isin(*P.FIGURE_LABELS) | t.rlike(P.FIGURE_LABEL)


def with_figure_distance(k: DataFrame) -> DataFrame:
    """As-of lookup: rows since the last figure of the same document and page, in load order."""
    w = Window.partitionBy("doc", "pdf").orderBy("original_record_index").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("record_type") == "figure", F.col("original_record_index")), ignorenulls=True).over(w)
    return k.withColumn("figure_distance", F.col("original_record_index") - last)


def figure_leakage(k: DataFrame, window: int = FIGURE_WINDOW) -> DataFrame:
    hit = with_figure_distance(k).where((F.col("record_type") != "figure") & is_figure_label() & (F.col("figure_distance") <= window))
    return candidate(hit, "figure_or_diagram_text_leakage", "medium", 0.82, F.concat(F.lit("label after a figure: "), F.col("text")), "mark as layout text", True)


def heading_fragment(c: str) -> Column:
    v = X.normalize_line(c)
    return (F.length(v) >= 4) & F.coalesce(X.caps_ratio(v) >= 0.80, F.lit(False)) & ~v.endswith(".")


def heading_fragmentation(k: DataFrame) -> DataFrame:
    """Two headings in a row that read as one."""
    n = sequence.following(k, ["doc"], "original_record_index", "stable_internal_id", ["record_type", "pdf", "region", "text", "section"])
    a, b = X.strip("text"), X.strip("_n_text")
    same = (F.col("record_type") == "heading") & (F.col("_n_record_type") == "heading") & (F.col("pdf") == F.col("_n_pdf")) & (F.col("region") == F.col("_n_region"))
    ok = (a != "") & (b != "") & ~F.upper(a).isin(*P.STANDALONE_HEADINGS) & ~F.upper(b).isin(*P.STANDALONE_HEADINGS) & (F.length(a) + F.length(b) + 1 <= 160)
    sections = ~F.coalesce((F.col("section") != "") & (F.col("section") == F.col("_n_section")), F.lit(False))
    hit = n.where(same & ok & heading_fragment("text") & heading_fragment("_n_text") & sections)
    return candidate(hit, "heading_fragmentation", "medium", 0.70, F.concat(F.col("text"), F.lit(" + "), F.col("_n_text")), "review the headings", False)


def expected_status(layout: Column | None = None) -> Column:
    return S.expected(F.col("record_type"), F.col("region"), F.col("section"), F.col("official_record_label"), F.lit(False) if layout is None else layout)


def sure_status() -> Column:
    return S.unambiguous(F.col("record_type"), F.col("region"), F.col("section"), F.col("official_record_label"), F.col("layout_text"))


def status_mismatch(k: DataFrame) -> DataFrame:
    """Status against the audit's rule, with layout text already Informational: set where the place settles it, else for review."""
    layout = F.coalesce(F.col("layout_text"), F.lit(False))
    want = expected_status(layout)
    hit = k.withColumn("_want", want).where(F.col("_want").isNotNull() & (F.col("_want") != F.col("status")))
    sure = sure_status()
    action = F.when(sure, "set the status by the rule").otherwise("review the status against the source")
    return candidate(hit, "section_status_mismatch", F.when(sure, "medium").otherwise("high"), F.when(sure, 0.93).otherwise(0.68), F.concat(F.col("status"), F.lit(" -> "), F.col("_want")), action, sure)


def label_collisions(k: DataFrame) -> DataFrame:
    """The first row of each (doc, record) that occurs more than once."""
    g = k.groupBy("doc", "record").agg(F.count("*").alias("_n"), F.min("original_record_index").alias("original_record_index")).where("_n > 1")
    hit = k.join(g, ["doc", "record", "original_record_index"])
    return candidate(hit, "record_id_collision_or_ambiguity", "low", 0.95, F.concat(F.col("_n").cast("string"), F.lit(" records share the label")), "use the stable id", True)


def detect(knowledge: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """All candidates; the status rule sees the rows after the layout repair. ``titles`` are those of ``title_repairs``."""
    k = current(knowledge)
    parts = [control_or_garbage(k), symbol_errors(k), table_contamination(k), figure_leakage(k), heading_fragmentation(k), status_mismatch(repaired(k)), label_collisions(k)]
    if titles is not None:
        parts.append(title_candidates(titles))
    return reduce(DataFrame.unionByName, parts)


def repaired(k: DataFrame) -> DataFrame:
    """Rows with control characters removed and labels of figures marked as layout text."""
    marked = with_figure_distance(k)
    layout = (F.col("record_type") != "figure") & is_figure_label() & F.coalesce(F.col("figure_distance") <= FIGURE_WINDOW, F.lit(False))
    marked = marked.withColumn("layout_text", layout | F.coalesce("layout_text", F.lit(False))).withColumn("layout_ambiguous", ((F.col("record_type") == "table") & (F.size(table_reasons()) > 0)) | F.coalesce("layout_ambiguous", F.lit(False)))
    clean = {f: F.when(F.col(f).rlike(P.WIDE_CONTROL), X.remove_controls(f)).otherwise(F.col(f)) for f in FIELDS}
    clean["status"] = F.when(F.col("layout_text"), "Informational").otherwise(clean["status"])
    return marked.withColumns(clean).drop("figure_distance")


def clean_records(knowledge: DataFrame) -> DataFrame:
    """Repaired rows with their status set by the rule where it is sure, and the labels of their candidates, distinct and in order."""
    k = repaired(current(knowledge))
    want = expected_status(F.col("layout_text"))
    labels = detect(knowledge).groupBy("stable_internal_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("auto_fixed"), F.col("error_label")))).alias("auto"), F.sort_array(F.collect_set(F.when(~F.col("auto_fixed"), F.col("error_label")))).alias("manual")
    )
    none = F.array().cast("array<string>")
    return (
        k.withColumn("status", F.coalesce(F.when(sure_status(), want), F.col("status")))
        .drop("manual_review_labels", "auto_fixed_labels")
        .join(labels, "stable_internal_id", "left")
        .withColumn("manual_review_labels", F.coalesce("manual", none))
        .withColumn("auto_fixed_labels", F.coalesce("auto", none))
        .drop("auto", "manual")
    )


def corrections(knowledge: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Log of repairs: one row per repaired field, label made unique or title, with its text before and after."""
    k = current(knowledge)
    pairs = [F.when(F.col(f).rlike(P.WIDE_CONTROL), F.struct(F.lit(f).alias("field"), F.col(f).alias("before_text"), X.remove_controls(f).alias("after_text"))) for f in FIELDS]
    fixed = k.withColumn("_p", F.explode(F.array_compact(F.array(*pairs)))).where("_p.before_text <> _p.after_text")
    a = fixed.select("doc", "record", "original_record_index", F.lit("remove_non_semantic_control_characters").alias("rule_name"), F.lit(0.96).alias("confidence"), "_p.field", "_p.before_text", "_p.after_text")
    r = repaired(k).withColumn("_want", expected_status(F.col("layout_text")))
    b = r.where(F.col("_want").isNotNull() & (F.col("_want") != F.col("status")) & sure_status()).select("doc", "record", "original_record_index", F.lit("status_from_region_section_rule").alias("rule_name"), F.lit(0.93).alias("confidence"), F.lit("status").alias("field"), F.col("status").alias("before_text"), F.col("_want").alias("after_text"))
    c = figure_leakage(k).select("doc", "record", "original_record_index", F.lit("mark_figure_layout_text_informational").alias("rule_name"), F.lit(0.82).alias("confidence"), F.lit("layout_text").alias("field"), F.lit("false").alias("before_text"), F.lit("true").alias("after_text"))
    d = label_collisions(k).select("doc", "record", "original_record_index", F.lit("add_stable_internal_id").alias("rule_name"), "confidence", F.lit("stable_internal_id").alias("field"), F.col("record").alias("before_text"), F.col("stable_internal_id").alias("after_text"))
    parts = [a, b, c, d]
    if titles is not None:
        parts.append(title_corrections(titles))
    return reduce(DataFrame.unionByName, parts)


def summary(knowledge: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(metric, n): row counts, candidates by label and severity, rows for review, layout marks."""
    c = detect(knowledge, titles)
    parts = [
        knowledge.agg(F.count("*").alias("n")).select(F.lit("raw_record_count").alias("metric"), "n"),
        current(knowledge).agg(F.count("*").alias("n")).select(F.lit("clean_record_count").alias("metric"), "n"),
        c.groupBy("error_label").agg(F.count("*").alias("n")).select(F.concat(F.lit("label:"), F.col("error_label")).alias("metric"), "n"),
        c.groupBy("severity").agg(F.count("*").alias("n")).select(F.concat(F.lit("severity:"), F.col("severity")).alias("metric"), "n"),
        c.agg(F.count_if(~F.col("auto_fixed")).alias("n")).select(F.lit("manual_review_count").alias("metric"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


def ranked(candidates: DataFrame, n: int = 20) -> DataFrame:
    """The first candidates by severity, confidence, document and index as text: a top-k report."""
    keys = [severity_rank(F.col("severity")), F.desc("confidence"), F.col("doc"), F.coalesce(F.nullif(F.col("original_record_index"), F.lit(0)).cast("string"), F.lit("")), F.col("error_label")]
    return candidates.orderBy(*keys).limit(n)


def concentration(knowledge: DataFrame, n: int = 20, titles: DataFrame | None = None) -> DataFrame:
    """Documents with most candidates per record: a top-k report."""
    k = current(knowledge).groupBy("doc").agg(F.count("*").alias("n_records"))
    c = detect(knowledge, titles).groupBy("doc").agg(F.count("*").alias("n_candidates"))
    return k.join(c, "doc").withColumn("rate", F.col("n_candidates") / F.col("n_records")).orderBy(F.desc("rate"), F.desc("n_candidates"), "doc").limit(n)


# --- titles -------------------------------------------------------------


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def title_similarity(a: Column, b: Column) -> Column:
    """Ratio of matching blocks of the titles' words (Arrow UDF; Spark has no such function)."""
    return F.pandas_udf(_ratio, T.DoubleType())(F.array_join(X.title_tokens(a), " "), F.array_join(X.title_tokens(b), " "))


def title_mismatches(manifest: DataFrame, docs: DataFrame) -> DataFrame:
    """Manifest titles that differ from the publication's: document_id, both titles, similarity, overlap, severity."""
    ship_package(manifest.sparkSession)
    last = manifest.where("status = 'ok' and document_id is not null").groupBy("document_id").agg(F.max_by("document_title", "run_id").alias("document_title"))
    d = docs.where("title is not null and title <> ''").select("document_id", "title")
    j = last.join(d, "document_id").withColumn("similarity", title_similarity(F.col("document_title"), F.col("title"))).withColumn("overlap", X.token_overlap("document_title", "title"))
    bad = F.col("document_title").isNull() | F.col("document_title").rlike(P.WIDE_CONTROL) | (F.col("similarity") < TITLE_SIMILARITY) | (F.col("overlap") < TITLE_OVERLAP)
    return j.where(bad).withColumn("severity", F.when(F.col("similarity") < 0.25, "critical").otherwise("high"))


def title_repairs(manifest: DataFrame, docs: DataFrame) -> DataFrame:
    """Title mismatches with the confidence of the publication's title: higher where title page and file name agree on it."""
    from palimpsest.operators.titles import from_file_name

    bad = title_mismatches(manifest, docs)
    if "source_file" not in docs.columns:
        return bad.withColumn("confidence", F.lit(0.86))
    of_page = F.coalesce(F.try_element_at("metadata_source", F.lit("title")) != "filename", F.lit(True)) if "metadata_source" in docs.columns else F.lit(True)
    names = docs.select("document_id", from_file_name(F.col("source_file"), ()).alias("_file"), of_page.alias("_of_page"))
    agree = F.col("_of_page") & (title_similarity(F.col("title"), F.col("_file")) >= AGREEING_TITLE)
    return bad.join(names, "document_id").withColumn("confidence", F.when(agree, 0.95).otherwise(0.86)).drop("_file", "_of_page")


def _of_metadata(titles: DataFrame) -> DataFrame:
    """Titles as rows of their documents, which have no record."""
    none = F.lit("")
    return titles.withColumns({"doc": F.col("document_id"), "record": F.lit("<document_metadata>"), "pdf": none, "section": none, "part_file": none, "original_record_index": F.lit(None).cast("long"), "stable_internal_id": none, "before_text": F.coalesce("document_title", none)})


def title_candidates(titles: DataFrame) -> DataFrame:
    auto = F.col("confidence") >= AUTO_TITLE
    action = F.when(auto, "set the title of the publication").otherwise("review the title against the source")
    evidence = F.concat(F.col("before_text"), F.lit(" -> "), F.col("title"), F.lit("; similarity "), F.format_number("similarity", 2))
    return candidate(_of_metadata(titles), "metadata_title_mismatch", F.col("severity"), F.col("confidence"), evidence, action, auto)


def title_corrections(titles: DataFrame) -> DataFrame:
    t = _of_metadata(titles).where(F.col("confidence") >= AUTO_TITLE)
    return t.select("doc", "record", "original_record_index", F.lit("metadata_title_from_source_pdf").alias("rule_name"), "confidence", F.lit("document_title").alias("field"), "before_text", F.col("title").alias("after_text"))
