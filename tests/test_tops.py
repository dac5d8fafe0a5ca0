"""The top-20 reports rank all candidates and findings, not those of one detector or check."""

from pathlib import Path

import pytest

from palimpsest.plans import registry
from tests.test_core import MANIFEST, kn, knowledge, rec, records

DATA = Path("/root/testdata/sf0.001")
RANK = "CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END"


def _tables():
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def test_audit_top_ranks_all_detectors(spark, tmp_path):
    k = knowledge(spark, kn(1, text="TI \xa35 is"), kn(2, label="2.2", region="Annex"), kn(3, label="2.3", text="a\x07b"), kn(4, label="2.4", text="� is here"))
    k.write.parquet(str(tmp_path / "knowledge.parquet"))
    spark.createDataFrame([], MANIFEST).write.parquet(str(tmp_path / "manifest.parquet"))
    spark.createDataFrame([], "document_id string, title string").write.parquet(str(tmp_path / "docs.parquet"))
    got = [(r["stable_internal_id"], r["severity"], r["confidence"]) for r in registry.audit_top(spark, str(tmp_path)).collect()]
    assert got == [("s1", "high", 0.74), ("s2", "medium", 0.93), ("s4", "medium", 0.72), ("s3", "low", 0.96)]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_audit_top_is_the_head_of_the_candidates_sql(spark):
    out = _tables().execute(
        f"WITH c AS ({registry.oracle_sql()['audit_candidates']}), k AS (SELECT DISTINCT stable_internal_id, doc, original_record_index AS i FROM knowledge) "
        f"SELECT stable_internal_id, severity, confidence, doc FROM c JOIN k USING (stable_internal_id) ORDER BY {RANK}, confidence DESC, doc, coalesce(CAST(nullif(i, 0) AS VARCHAR), ''), error_label LIMIT 20"
    ).fetchall()
    assert [tuple(r) for r in registry.audit_top(spark, str(DATA)).collect()] == out


def test_qa_top_ranks_all_checks(spark, tmp_path):
    m = [("D-1", "ok", "1", 4, "a.pdf", None, "T"), (None, "failed", "1", None, "c.pdf", "boom", None)]
    spark.createDataFrame(m, MANIFEST).write.parquet(str(tmp_path / "manifest.parquet"))
    r = records(spark, rec(1, text="bad \x07 text"), rec(2, text="�"), rec(3), rec(3), rec(4, text_status="Informative"))
    r.write.parquet(str(tmp_path / "records.parquet"))
    got = [(x["severity"], x["record_id"], x["reason"]) for x in registry.qa_top(spark, str(tmp_path)).collect()]
    twice = ("critical", "r3", "record id is repeated")
    assert got == [("critical", "", "c.pdf: boom"), twice, twice, ("critical", "r4", "rule gives Normative"), ("high", "r2", "encoding damage"), ("low", "r1", "control character")]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_qa_top_is_the_head_of_the_checks_sql(spark):
    sql = registry.oracle_sql()
    every = " UNION ALL ".join(f"SELECT * FROM ({s})" for k, s in sql.items() if k.startswith("qa_") and k not in ("qa_top", "qa_summary"))
    out = _tables().execute(
        f'WITH every AS ({every}) SELECT severity, doc_id, page, record_id, reason FROM every ORDER BY {RANK}, doc_id NULLS FIRST, page NULLS FIRST, record_id NULLS FIRST, "check", reason LIMIT 20'
    ).fetchall()
    assert [tuple(r) for r in registry.qa_top(spark, str(DATA)).collect()] == out
