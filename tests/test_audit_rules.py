"""Status review, stable-id corrections and titles in the audit."""

from pyspark.sql import functions as F

from palimpsest.operators import audit
from tests.test_core import MANIFEST, kn, knowledge


def test_status_of_a_body_footnote_goes_to_review(spark):
    # a footnote labelled 1 counts as section one, as any record so labelled does
    k = knowledge(spark, kn(1, kind="footnote", label="7"), kn(2, kind="footnote", label="2", section="1. X"), kn(3, kind="footnote", label="3", region="Annex"), kn(4, label="2.4", status="Informative"))
    got = {r["stable_internal_id"]: (r["severity"], r["confidence"], r["auto_fixed"]) for r in audit.status_mismatch(k).collect()}
    assert got == {"s1": ("high", 0.68, False), "s2": ("medium", 0.93, True), "s3": ("medium", 0.93, True), "s4": ("medium", 0.93, True)}
    clean = {r["stable_internal_id"]: r for r in audit.clean_records(k).collect()}
    assert clean["s1"]["status"] == "Normative" and clean["s1"]["manual_review_labels"] == ["section_status_mismatch"] and clean["s1"]["auto_fixed_labels"] == []
    assert [clean[i]["status"] for i in ("s2", "s3", "s4")] == ["Informative", "Informative", "Normative"]
    rule = F.col("rule_name") == "status_from_region_section_rule"
    assert {r["original_record_index"] for r in audit.corrections(k).where(rule).collect()} == {2, 3, 4}


def test_repeated_labels_are_logged(spark):
    k = knowledge(spark, kn(1), kn(2), kn(3, label="2.2"))
    got = [tuple(r) for r in audit.corrections(k).select("rule_name", "original_record_index", "confidence", "before_text", "after_text").collect()]
    assert got == [("add_stable_internal_id", 1, 0.95, "paragraph 2.1", "s1")]


def test_titles_are_candidates_and_corrections(spark):
    m = spark.createDataFrame([("D", "ok", "1", 1, "a", None, "Qzxvb Wkrpt Lmnjh"), ("E", "ok", "1", 1, "a", None, "Use of the hot cell"), ("G", "ok", "1", 1, "a", None, None)], MANIFEST)
    d = spark.createDataFrame(
        [("D", "Use of the storage vault", "in/Use_of_the_storage_vault.pdf", {"title": "cover"}), ("E", "Use of the Hot Cell", "e.pdf", {"title": "cover"}), ("G", "Peer review", "Peer review.pdf", {"title": "filename"})],
        "document_id string, title string, source_file string, metadata_source map<string, string>",
    )
    titles = audit.title_repairs(m, d)
    k = knowledge(spark, kn(1, doc="D"))
    label = F.col("error_label") == "metadata_title_mismatch"
    got = {r["doc"]: (r["record"], r["confidence"], r["auto_fixed"], r["original_record_index"]) for r in audit.detect(k, titles).where(label).collect()}
    assert got == {"D": ("<document_metadata>", 0.95, True, None), "G": ("<document_metadata>", 0.86, True, None)}
    done = {r["doc"]: (r["rule_name"], r["before_text"], r["after_text"]) for r in audit.corrections(k, titles).collect()}
    assert done == {"D": ("metadata_title_from_source_pdf", "Qzxvb Wkrpt Lmnjh", "Use of the storage vault"), "G": ("metadata_title_from_source_pdf", "", "Peer review")}
    assert {r["metric"]: r["n"] for r in audit.summary(k, titles).collect()}["label:metadata_title_mismatch"] == 2
