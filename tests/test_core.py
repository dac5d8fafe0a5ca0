import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import audit, export, lines, metadata, qa
from palimpsest.operators import status as S
from palimpsest.sources import blocks, config, pages

REC = (
    "record_id string, document_id string, document_title string, document_family string, document_category string, document_type string, document_domain string, series_name string, series_number string, "
    "element_type string, element_id string, source_region string, text_status string, section_path array<string>, page_start_pdf int, page_end_pdf int, page_start_printed string, page_end_printed string, "
    "text string, title string, caption string, confidence string, seq long, extracted_at timestamp"
)


def rec(seq, **k):
    d = dict(record_id=f"r{seq}", document_id="D-1", document_title="Title", document_type="safety_requirements", element_type="paragraph", source_region="Body", text_status="Normative", section_path=["2. X"], page_start_pdf=1, page_end_pdf=1, text="Some text.", confidence="high", seq=seq) | k
    return tuple(d.get(f.split()[0]) for f in REC.split(", "))


def records(spark, *rows):
    return spark.createDataFrame(list(rows), REC)


MANIFEST = "document_id string, status string, run_id string, record_count long, source_pdf string, error string, document_title string"


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [("a\xa0\tb  c﻿​", "a b c"), (" x y ", "x\ny"), ("\x85z\x1c", "z"), ("", ""), (None, None)])
def test_normalize(spark, text, want):
    assert value(spark, X.normalize_text(F.lit(text).cast("string"))) == want


def test_patterns_read_alike(spark):
    import duckdb

    samples = ["1.1. Text", "101. x", "A.6. y", "III–21. z", "FIG. III–1. Cap", "TABLE 2. T", "[3] Ref", "7 The note here", "Requirement 4A: do", "REQUIREMENT 5: x", "12", "١٢", "1. INTRO", "Annex IV", "appendix", "REFERENCES ", "GLOSSARY ", "CONTENTS", "Ordering locally", "a . . . 4", "x....", "T\xa0\xa35", "U\xa33", "Note: a for each package", "Note: b —For each package", "x\x85y", "caf\xe9 12 The", "86 Appendix VI", "abc- def", "123A.4", "", "�", "12.3. ABCDEFGHIJ"]
    names = [n for n in dir(P) if n.isupper() and isinstance(getattr(P, n), str) and n not in ("SPACE", "SPACE_IN_LINE")]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    con = duckdb.connect()
    for n in names:
        p = getattr(P, n)
        spark_hits = [r[0] for r in df.select(F.col("s").rlike(p)).collect()]
        sql_hits = [con.execute("select regexp_matches(?, ?)", [s, p]).fetchone()[0] for s in samples]
        assert spark_hits == sql_hits, (n, [s for s, a, b in zip(samples, spark_hits, sql_hits) if a != b])


def test_text_helpers(spark):
    v = lambda e: value(spark, e)
    assert v(X.slug(F.lit("A b--C!"))) == "a-b-c" and v(X.slug(F.lit("!!"))) == "none"
    assert v(X.path_component(F.lit(" NSS 17-T (Rev. 1) "), "d")) == "NSS-17-T-Rev.-1" and v(X.path_component(F.lit("??"), "d")) == "d"
    assert v(X.page_label(F.lit(1), F.lit(3))) == "1-3" and v(X.preview(F.lit("x" * 300))) == "x" * 217 + "..."
    assert v(X.remove_controls(F.lit("a\x00\x07b \n c\x9f"))) == "a b\nc" and v(X.sanitize(F.lit("a�"))) == "a?"
    assert v(X.compact_id(F.lit("A" * 47 + "-B"))) == "A" * 47 and v(X.canonical_dash(F.lit("I-1‑1"))) == "I–1–1"
    assert v(X.token_overlap(F.lit("The big plan"), F.lit("plan, the"))) == pytest.approx(2 / 3) and v(X.token_overlap(F.lit("!"), F.lit("a"))) == 0
    assert v(X.looks_like_garbage(F.lit("|#%&*+=<>[]{}~^ |#%&*+=<>[]{}~^"))) and not v(X.looks_like_garbage(F.lit("Plain text of a usual length.")))
    assert v(X.ends_with_continuation(F.lit("Duties of the"))) and not v(X.ends_with_continuation(F.lit("Duties")))
    assert v(X.is_caps_heading(F.lit("ALL CAPS"))) and not v(X.is_caps_heading(F.lit("TABLE 1. ABC"))) and not v(X.is_caps_heading(F.lit("AB")))


def test_status_rules(spark):
    rows = [("footnote", "Body", "1", [], "Informative"), ("paragraph", "Body", "1.2", [], "Informational"), ("paragraph", "Body", "101", [], "Informational"), ("paragraph", "Body", "2.1", ["1. INTRODUCTION"], "Informational"), ("requirement", "Body", "3", ["2. X"], "Normative"), ("heading", "Body", None, ["2. X"], "Informational"), ("table", "Annex", None, None, "Informative"), ("figure", "Appendix", None, None, "Normative"), ("paragraph", "References", None, None, "Informational"), (None, None, None, None, "Informational")]
    df = spark.createDataFrame(rows, "k string, r string, i string, p array<string>, w string")
    assert df.where(~S.classify(F.col("k"), F.col("r"), F.col("i"), F.col("p")).eqNullSafe(F.col("w"))).count() == 0
    rows = [("paragraph", "Body", "2. X", "1", False, "Informational"), ("requirement", "Body", "2. X", "5", False, None), ("paragraph", "Body", "2. X", "101", False, "Normative"), ("heading", "Appendix", "", "", False, "Informational"), ("reference", "Appendix", "", "", False, "Normative"), ("table", "Body", "2. X", "", True, "Informational")]
    df = spark.createDataFrame(rows, "k string, r string, s string, l string, y boolean, w string")
    assert df.where(~S.expected(F.col("k"), F.col("r"), F.col("s"), F.col("l"), F.col("y")).eqNullSafe(F.col("w"))).count() == 0


def test_quality_checks_fire(spark):
    manifest = spark.createDataFrame([("D-1", "ok", "1", 99, "a.pdf", None, "T"), ("D-9", "ok", "1", 1, "b.pdf", None, "T"), (None, "failed", "1", None, "c.pdf", "boom", None)], MANIFEST)
    rows = [rec(i, element_id="3.1", text="short cell") for i in range(5)] + [
        rec(5, text="x Requirement 4: do"), rec(6, text="Requirement 4: do"), rec(7, text="see 3 The note", text_status="Normative"), rec(8, text="86 Appendix VI is here"), rec(9, element_type="heading", text="DUTIES OF THE"),
        rec(10, element_type="heading", text="BODY"), rec(11, section_path=["THE DUTIES OF"]), rec(12, text="Scope . . . . 3"), rec(13, section_path=["Scope (1–3) 4"]), rec(14, element_type="table", text="cells", page_end_pdf=2), rec(15, text_status="Odd"),
        rec(16, source_region=None), rec(17, text="  "), rec(18, text=None), rec(19, text="bad \x07 text"), rec(20, text="hyphen- ated"), rec(21, text="123A.4 x"), rec(22, text="�"), rec(23, document_id="D-2"), rec(23, document_id="D-2"),
    ] + [rec(i) for i in range(30, 50)]
    r = records(spark, *rows)
    found = {}
    for f in qa.run_checks(r, manifest).collect():
        found.setdefault((f["check"], f["severity"]), set()).add(f["record_id"] or f["doc_id"])
    assert found["requirement_boundary", "high"] >= {"r5"} and found["requirement_boundary", "medium"] == {"r6"} and "r0" in found["requirement_boundary", "high"]
    assert "r7" in found["footnote_contamination", "high"] and "r0" in found["footnote_contamination", "medium"]
    assert found["header_footer_leakage", "high"] == {"r8"} and found["heading_split", "medium"] == {"r9", "r11"}
    assert found["toc_pollution", "high"] == {"r12"} and found["toc_pollution", "medium"] == {"r13"}
    assert found["table_paragraph_collision", "medium"] == {"r0", "r1", "r2", "r14"}
    assert {"r15", "r16", "r23"} <= found["schema_validation", "critical"] and found["schema_validation", "medium"] == {"r17", "r18"}
    assert found["text_quality", "low"] == {"r19", "r20"} and found["text_quality", "high"] == {"r22"} and found["text_quality", "medium"] == {"r21"}
    assert found["manifest_consistency", "critical"] == {"D-1", "D-2", "D-9"} and found["record_id_collision_or_ambiguity", "critical"] == {"r23"} and ("parse_failure", "critical") in found
    assert "r15" in found["status_region_consistency", "critical"]
    total = {r["dimension"]: r["n"] for r in qa.summarize(qa.run_checks(r, manifest)).where("dimension = 'total'").collect()}
    assert total["total"] == qa.run_checks(r, manifest).count()
    assert qa.run_checks(r.limit(0), manifest.limit(0)).count() == 0


KN = "part_file string, doc string, record string, status string, region string, pdf string, section string, text string, original_record_index long, stable_internal_id string, official_record_label string, record_type string, layout_ambiguous boolean, layout_text boolean, manual_review_labels array<string>, auto_fixed_labels array<string>"


def kn(i, kind="paragraph", label="2.1", text="Some text here.", status="Normative", region="Body", pdf="4", section="2. X", doc="D"):
    return ("p", doc, f"{kind} {label}".strip(), status, region, pdf, section, text, i, f"s{i}", label, kind, False, False, [], [])


def knowledge(spark, *rows):
    return spark.createDataFrame(list(rows), KN)


def test_audit_detects_and_repairs(spark):
    k = knowledge(
        spark, kn(1), kn(2, label="2.1"), kn(3, text="a\x07b"), kn(4, text="� is here"), kn(5, text="TI \xa35 is"), kn(6, kind="table", label="T", text="cells MARKINGS follow"), kn(7, kind="figure", label="FIG. 1"), kn(8, label="", kind="text_block", text="12"),
        kn(9, kind="text_block", label="", text="15 mm"), kn(20, kind="text_block", label="", text="16 mm"), kn(21, kind="heading", label="", text="DUTIES OF", status="Informational", section="a"), kn(22, kind="heading", label="", text="THE BODY", status="Informational", section="b"), kn(23, region="Annex"),
    )
    c = {(r["stable_internal_id"], r["error_label"]) for r in audit.detect(k).collect()}
    for want in [("s3", "control_or_garbage_chars"), ("s4", "control_or_garbage_chars"), ("s5", "likely_ocr_symbol_error"), ("s6", "table_flattened_or_contaminated"), ("s8", "figure_or_diagram_text_leakage"), ("s9", "figure_or_diagram_text_leakage"), ("s21", "heading_fragmentation"), ("s23", "section_status_mismatch"), ("s1", "record_id_collision_or_ambiguity")]:
        assert want in c, want
    assert ("s20", "figure_or_diagram_text_leakage") not in c
    clean = {r["stable_internal_id"]: r for r in audit.clean_records(k).collect()}
    assert len(clean) == 13 and clean["s3"]["text"] == "a b" and clean["s8"]["status"] == "Informational" and clean["s23"]["status"] == "Informative"
    assert clean["s23"]["auto_fixed_labels"] == ["section_status_mismatch"] and clean["s21"]["manual_review_labels"] == ["heading_fragmentation"] and clean["s6"]["layout_ambiguous"]
    assert not audit.clean_records(k).where(F.col("text").rlike(P.WIDE_CONTROL)).count()
    rules = {(r["original_record_index"], r["rule_name"]) for r in audit.corrections(k).collect()}
    assert (3, "remove_non_semantic_control_characters") in rules and (23, "status_from_region_section_rule") in rules
    ids = [r["stable_id"] for r in audit.stable_ids(k).collect()]
    assert len(set(ids)) == 13 and re.fullmatch(r"d__paragraph__2-1__p4__[0-9a-f]{8}__0001", sorted(ids)[sorted(ids).index([x for x in ids if "__paragraph__2-1" in x and x.endswith("0001")][0])])
    assert audit.detect(k.limit(0)).count() == 0 and audit.clean_records(k.limit(0)).count() == 0


def test_titles(spark):
    m = spark.createDataFrame([("D", "ok", "1", 1, "a", None, "Qzxvb Wkrpt Lmnjh"), ("E", "ok", "1", 1, "a", None, "Use of the hot cell")], MANIFEST)
    d = spark.createDataFrame([("D", "Use of the storage vault"), ("E", "Use of the Hot Cell"), ("F", None)], "document_id string, title string")
    assert [(r["document_id"], r["severity"]) for r in audit.title_mismatches(m, d).collect()] in ([("D", "critical")], [("D", "high")])
    assert metadata.title_case_text("O'NEIL (REV. 1) AND THE STATE'S") == "O'Neil (Rev. 1) And The State's"


def _pack(sizes, limit):
    """Brute force: (document, size, head, continued head) to part numbers."""
    part, used, out, doc, filled = 1, 0, [], None, False
    for d, n, head, again in sizes:
        if d != doc:
            if filled and used + head > limit:
                part, used = part + 1, 0
            used, doc, filled = used + head, d, True
        if used + n > limit:
            part, used = part + 1, again
        used += n
        out.append(part)
    return out


def test_parts(spark):
    rows = [rec(i, document_id=f"D-{i // 7}", text="word " * ((i * 37) % 200), record_id=f"r{i:03d}") for i in range(60)]
    r = records(spark, *rows)
    got = export.part_numbers(r, 101_500).orderBy("document_id", "seq").collect()
    sizes = r.select("document_id", F.octet_length(export.markdown_block()), F.octet_length(export.document_header()), F.octet_length(export.document_header(True))).orderBy("document_id", "seq").collect()
    assert [g["part"] for g in got] == _pack([tuple(s) for s in sizes], 1500) and got[-1]["part"] > 5
    per = {}
    for g in got:
        per[g["part"]] = per.get(g["part"], 0) + g["n_bytes"]
    assert all(n <= 1500 or sum(g["part"] == p for g in got) == 1 for p, n in per.items())


def test_parts_in_streams(spark):
    r = records(spark, *[rec(i, document_id=f"D-{i // 7}", text="word " * ((i * 37) % 200), record_id=f"r{i:03d}") for i in range(80)])
    got = export.part_numbers(r, 101_500, streams=4).collect()
    assert len(got) == 80 and {g["part"] for g in got} >= {1, max(g["part"] for g in got)}
    per = {}
    for g in got:
        per.setdefault(g["part"], []).append(g["n_bytes"])
    assert all(sum(n) <= 1500 or len(n) == 1 for n in per.values())
    whole = export.part_numbers(r, 101_500).agg(F.max("part")).first()[0]
    assert max(per) <= whole + 4 * 2
    assert export.part_numbers(r.limit(0), 101_500, streams=4).count() == 0


def test_blocks_roundtrip(spark, tmp_path):
    rows = [rec(1, text="One\n\ntwo", element_id="2.1"), rec(2, element_type="table", title="T", text="a | b"), rec(3, element_type="figure", caption="Cap", text="FIG. 1", section_path=["A", "B"], page_end_pdf=3)]
    text = "# T\n\n## Structural records\n" + "".join(r[0] for r in records(spark, *rows).orderBy("seq").select(export.markdown_block()).collect()) + "\n---\nnot a block\n\ntext\n"
    (tmp_path / "part_1.md").write_text(text + "\n\n# Document: X\n", encoding="utf-8")
    (tmp_path / "part_2.md").write_text("no records", encoding="utf-8")
    got = blocks.read_parts(spark, str(tmp_path)).orderBy("original_record_index").collect()
    assert [(g["record"], g["pdf"], g["section"], g["text"], g["original_record_index"]) for g in got] == [("paragraph 2.1", "1", "2. X", "One\n\ntwo", 1), ("table", "1", "2. X", "Table title: T\na | b", 2), ("figure", "1-3", "A > B", "Caption: Cap\nFIG. 1", 3)]


def test_write_series_and_audit(spark, tmp_path):
    from palimpsest.app import run_audit, series

    src = spark.createDataFrame([("a.txt", "s", 1, "1", "", ["Vellmar, 2001", "USE OF THE LARGE HOT CELL", "1. INTRODUCTION", "1.1. Some text of it.", "1.2. More text of it."]), ("b.txt", "s", 1, "1", "", ["1. INTRODUCTION", "1.1. Other text."])], pages.PAGES).withColumn("extracted_at", F.current_timestamp())
    src.write.parquet(str(tmp_path / "pages"))
    done = series(spark, str(tmp_path / "pages"), str(tmp_path / "out"), max_bytes=102_000)
    assert done["records"] == 6
    assert spark.read.json(str(tmp_path / "out/records")).count() == 6
    parts = tmp_path / "named"
    parts.mkdir()
    for i, f in enumerate(sorted((tmp_path / "out/parts").rglob("*.txt"))):
        (parts / f"part_{i}.md").write_text("## Structural records\n" + f.read_text(encoding="utf-8"), encoding="utf-8")
    assert run_audit(spark, str(parts), str(tmp_path / "audit"))["raw_record_count"] == 6


def test_metadata(spark):
    p = spark.createDataFrame([("MPG-12_x.pdf", 1, None, ["Meridian Protection Series", "MPG-12-REV1", "USE OF THE LARGE HOT CELL", "IN REMOTE AREAS OF IT", "Vellmar, 2004", "MB/PUB/77", "ISBN 000-1-2 (pdf)"], 1), ("plain_name.pdf", 1, None, ["text only"], 1), ("e.pdf", 1, None, None, 1)], "source_file string, pdf_page int, printed_page string, lines array<string>, extracted_at int")
    from palimpsest.plans.registry import BOARD

    got = {r["source_file"]: r for r in metadata.infer(p, BOARD).collect()}
    a = got["MPG-12_x.pdf"]
    assert (a["title"], a["series_number"], a["series_name"], a["publication_year"], a["sti_pub_number"], a["isbn_pdf"], a["document_id"]) == ("Use Of The Large Hot Cell In Remote Areas Of It", "MPG-12-REV1", "Meridian Protection Series", 2004, "MB/PUB/77", "000-1-2", "MPG-12-REV1")
    assert got["plain_name.pdf"]["title"] == "Plain Name" and got["plain_name.pdf"]["document_id"] == "PLAIN-NAME"
    c = spark.createDataFrame([("plain_name.pdf", "Given", "X-1")], "source_file string, title string, series_number string")
    b = {r["source_file"]: r for r in metadata.infer(p, BOARD, c).collect()}["plain_name.pdf"]
    assert (b["title"], b["title_source"], b["document_id"]) == ("Given", "config", "X-1")


def test_config(tmp_path):
    a, b = {"x": {"y": 1, "z": [1]}, "k": 1}, {"x": {"y": 2}}
    assert config.merge(a, None, b) == {"x": {"y": 2, "z": [1]}, "k": 1} and a["x"]["y"] == 1
    s = {"series": {"series_name": "S", "default_document_type": "guide"}, "document_defaults": {"publisher": "P"}, "documents": {"a": {"title": "by stem"}, "a.pdf": {"document": {"title": "by name"}}}}
    (tmp_path / "a.yaml").write_text("document:\n  language: en\n")
    c = config.for_document("a.pdf", s, tmp_path)
    assert c["document"] == {"series_name": "S", "document_family": "S", "publisher": "P", "title": "by name", "language": "en"} and c["fallbacks"]["document_type"] == "guide"
    assert config.for_document("b.pdf", {"documents": [{"stem": "b", "title": "L"}]})["document"]["title"] == "L"


def test_page_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\fthree", encoding="utf-8")
    got = pages.from_text_files(spark, str(tmp_path)).orderBy("pdf_page").collect()
    assert [(r["source_file"], r["pdf_page"], r["lines"]) for r in got] == [("a.txt", 1, ["one", "two"]), ("a.txt", 2, ["three"])]
    (tmp_path / "x.PDF").write_bytes(b"good")
    (tmp_path / "y.pdf").write_bytes(b"bad")

    def extractor(content):
        if content == b"bad":
            raise ValueError("broken")
        return [["line"]]

    good, failed = pages.extract(spark, str(tmp_path), extractor, "*.[pP][dD][fF]")
    assert [r["source_file"] for r in good.collect()] == ["x.PDF"] and [r["error"] for r in failed.collect()] == ["ValueError: broken"]
    assert pages.discover(spark, str(tmp_path), "*.[pP][dD][fF]").count() == 2


def test_page_numbers_and_furniture(spark):
    p = spark.createDataFrame([("a", 1, ["x", "y", "z", "7"]), ("a", 2, ["8", "x", "y", "z"]), ("a", 3, ["CONTENTS", "x", "y", "9"]), ("a", 4, ["x", "7"]), ("a", 5, ["86", "Appendix VI", "x"]), ("a", 6, None)], "source_file string, pdf_page int, lines array<string>")
    got = {r["pdf_page"]: (r["found_page"], r["lines"]) for r in lines.page_numbers_cut(p).collect()}
    assert got[1] == ("7", ["x", "y", "z"]) and got[2] == ("8", ["x", "y", "z"]) and got[3][0] is None and got[4][0] is None and got[6] == (None, None)
    f = lines.with_furniture(lines.page_lines(p)).where("furniture").collect()
    assert {(r["pdf_page"], r["line"]) for r in f} == {(5, "86"), (5, "Appendix VI")}


def test_stream(spark, tmp_path):
    from palimpsest.streaming.ingest import segment_stream

    src = str(tmp_path / "in")
    docs = spark.createDataFrame([("a.pdf", "D-1", "T", "f", "c", "t", "d", "s", "n")], "source_file string, document_id string, title string, document_family string, document_category string, document_type string, document_domain string, series_name string, series_number string")
    page = spark.createDataFrame([("a.pdf", "x", 1, "1", "", ["1. INTRODUCTION", "1.1. Text."])], pages.PAGES).withColumn("extracted_at", F.expr("timestamp_ntz '2023-01-01 00:00:00'"))
    page.write.parquet(src)
    for _ in range(2):  # the second start finds nothing new
        segment_stream(spark, src, docs, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_nothing_imports_the_llm_package():
    root = Path(__file__).resolve().parent.parent / "palimpsest"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "palimpsest.llm" not in p.read_text(), p


def test_title_helpers(spark):
    from palimpsest.operators import titles as T

    df = spark.createDataFrame([("in/NSS 17-T (Rev. 1) computer_security guide.pdf", "No. 17-T Technical Guidance big plan Jointly sponsored by X")], "f string, n string")
    r = df.select(T.from_file_name(F.col("f"), [r"NSS\s+\d+(?:-[A-Z])?(?:\s*\(Rev\.?\s*\d+\))?"]).alias("a"), T.from_file_name(F.lit("x/plain.pdf"), []).alias("b"), T.from_series_number(F.lit("No. 5: Technical Guidance big plan Jointly sponsored by X"), ["Technical Guidance"]).alias("c")).first()
    assert r["a"] == "Computer Security Guide" and r["b"] == "Plain" and "Jointly" not in r["c"]
    page = lambda lines, categories, stop=(): spark.createDataFrame([(lines,)], "l array<string>").select(T.from_title_page(F.col("l"), categories, stop)).first()[0]
    assert page(["x", "Technical Guidance", "COMPUTER  SECURITY", "FOR LARGE FACILITIES", "VIENNA, 2001"], ["technical guidance"], ["^vienna"]) == "Computer Security For Large Facilities"
    assert page(["no category"], ["guide"]) == "" and page([], []) == "" and page(None, ["guide"]) == ""
    assert page(["Guide", "SHORT", "", "Guide", "A LONG ENOUGH TITLE OF A GUIDE", "x"], ["guide"]) == "Short A Long Enough Title Of A Guide"
    assert page(["Guide", "no", "Guide", "A LONG ENOUGH TITLE OF A GUIDE", "x", "GUIDE"], ["guide"]) == "A Long Enough Title Of A Guide"
    d = spark.createDataFrame([("Use of hot cells", "Use of Hot Cells", ""), ("", "", "Series title here"), ("A file title", "Quite another page", ""), (None, None, None)], "f string, p string, s string")
    assert [x["best_title"] for x in T.choose(d, "f", "p", "s").collect()] == ["Use of Hot Cells", "Series title here", "A file title", ""]
    c = spark.range(1).select(T.category(F.lit("SSG-4"), F.lit("a"), F.array(F.lit("x")), [("Specific Guide", r"\bSSG\b"), ("Guide", r"\bGuide\b")]).alias("a"), T.category(F.lit(""), F.lit(""), F.array(F.lit("• Guides.")), [("Guide", r"\bGuide\b")], {"Guides": "Guide"}).alias("b"), T.category_slug(F.lit("Big Guide"), {"X": "y"}).alias("c"), T.series_name(F.lit("x Beta Series, Alpha Series"), ["Alpha Series", "Beta Series"]).alias("d")).first()
    assert tuple(c) == ("Specific Guide", "Guide", "big_guide", "Beta Series")


def test_reports(spark, tmp_path):
    from palimpsest.operators import report

    r = records(spark, *[rec(i, confidence="low" if i < 3 else "high", text="123A.4 x" if i == 1 else "Text.") for i in range(5)])
    docs = spark.createDataFrame([("D-1", "T", "a.pdf", "s", "c", "t", "sn", "nr", 2000)], "document_id string, title string, source_file string, source_sha256 string, document_category string, document_type string, series_name string, series_number string, publication_year int")
    f = qa.text_quality(r)
    text = report.records_report(r, f)
    assert blocks.record_count_of_report(text) == 5 and "- paragraph: 5" in text and "- table" in text and "page number joined" in text
    report.findings_json(f, tmp_path / "f.json")
    assert '"total_findings": 1' in (tmp_path / "f.json").read_text()
    assert report.run_info(docs, r)["document_manifest_checksum"] == report.run_info(docs, r)["document_manifest_checksum"]
    failed = spark.createDataFrame([("x.pdf", "boom")], "source_pdf string, error string")
    assert {'"ok"' in v["value"] for v in report.manifest_json(docs, r, failed).collect()} == {True, False}
    (tmp_path / "part_1.md").write_text(report.document_markdown(r, "D-1"), encoding="utf-8")
    assert blocks.read_parts(spark, str(tmp_path)).count() == 5
    k = knowledge(spark, kn(1, text="� x"))
    assert "control_or_garbage_chars" in report.audit_report({"a": 1}, audit.detect(k))
    assert report.snapshot({"b": "1", "a": "2"}) == '{"a": "2", "b": "1"}' and report.label_of("x") == "x"
    report.write_csv_rows(tmp_path / "c.csv", [{"a": 1, "z": 2}], ["a"])
    report.write_json_lines(tmp_path / "l.jsonl", [{"a": "é"}])
    assert "Part 1 of 2" in report.preamble("S", 1, 2, [report.document_summary("D", "n", "t", "T", 3)]) and "part_1" in report.parts_readme(["part_1"], 10)


def test_number_from_the_file_name(spark):
    pages = spark.createDataFrame([("in/SSG-4 (Rev. 1) plans.pdf", 1, None, ["no number here"], "2024-01-01"), ("in/x.pdf", 1, None, ["SSG-64"], "2024-01-01")], "source_file string, pdf_page int, printed_page string, lines array<string>, extracted_at string")
    got = {r["source_file"]: r["series_number"] for r in metadata.infer(pages).collect()}
    assert got == {"in/SSG-4 (Rev. 1) plans.pdf": "SSG-4 (Rev. 1)", "in/x.pdf": "SSG-64"}


def test_only_a_local_session_may_use_its_own_folder(spark):
    from types import SimpleNamespace

    import pytest

    from palimpsest import session

    with pytest.raises(ValueError):
        session._temporary(SimpleNamespace(sparkContext=SimpleNamespace(master="yarn")), "x")
