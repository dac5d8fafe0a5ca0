"""The queries of the eight problems, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import cutoff, encoding, glyphs, leakage, packing, scans, sitelines, textkind
from palimpsest.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _p1_found(spark, d):
    return encoding.found(table(spark, d, "records"), table(spark, d, "knowledge"))


def _p1_restored(spark, d):
    return encoding.restored(table(spark, d, "records"), table(spark, d, "knowledge"))


def _p2_found(spark, d):
    records = table(spark, d, "records")
    # the nine tenths loaded first are counted, the last tenth is merged as a delta
    at = records.agg(F.percentile_approx(F.unix_micros(F.col("extracted_at").cast("timestamp")), 0.9)).first()[0]
    return sitelines.found_lines(records, boundary=None if at is None else F.unix_micros(F.col("extracted_at").cast("timestamp")) < at)


def _p2_clean(spark, d):
    return sitelines.strip_lines(table(spark, d, "records"), _p2_found(spark, d))


def _p3_found(spark, d):
    return scans.found(table(spark, d, "page_texts"), table(spark, d, "records"), table(spark, d, "docs"))


def _p3_repaired(spark, d):
    return scans.repaired(table(spark, d, "page_texts"), table(spark, d, "records"), table(spark, d, "docs"))


def _p4_found(spark, d):
    return glyphs.look_alike_pairs(table(spark, d, "records"))


def _p4_classes(spark, d):
    return glyphs.look_alike_classes(table(spark, d, "records"))


def _p4_normalized(spark, d):
    return glyphs.normalize_records(table(spark, d, "records"))


def _p5_found(spark, d):
    return textkind.found(table(spark, d, "knowledge"))


def _p5_statistics(spark, d):
    return textkind.quality_table(table(spark, d, "knowledge"))


def _p6_containers(spark, d):
    return packing.pack(table(spark, d, "documents"))


def _p6_summary(spark, d):
    return packing.packing_summary(_p6_containers(spark, d))


def _p7_found(spark, d):
    return leakage.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _p7_report(spark, d):
    return leakage.leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _p8_found(spark, d):
    return cutoff.found(table(spark, d, "documents"))


def _p8_by_source(spark, d):
    return cutoff.truncation_by_source(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": _p1_found,
        "p1_restored": _p1_restored,
        "p2_found": _p2_found,
        "p2_clean": _p2_clean,
        "p3_found": _p3_found,
        "p3_repaired": _p3_repaired,
        "p4_found": _p4_found,
        "p4_classes": _p4_classes,
        "p4_normalized": _p4_normalized,
        "p5_found": _p5_found,
        "p5_statistics": _p5_statistics,
        "p6_containers": _p6_containers,
        "p6_summary": _p6_summary,
        "p7_found": _p7_found,
        "p7_report": _p7_report,
        "p8_found": _p8_found,
        "p8_by_source": _p8_by_source,
    }


_LINES = """
r AS (SELECT DISTINCT record_id, document_id, series_name, element_type, text FROM records WHERE text IS NOT NULL),
l AS (SELECT record_id, document_id, series_name, element_type, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS line_no FROM r),
k AS (SELECT *, lower(regexp_replace(line, '[^\\p{L}]+', '', 'g')) AS key FROM l),
n AS (SELECT series_name, key, count(DISTINCT document_id) AS n FROM k WHERE length(key) >= 12 GROUP BY ALL),
s AS (SELECT series_name, count(DISTINCT document_id) AS docs FROM records GROUP BY ALL),
often AS (SELECT n.series_name, key FROM n JOIN s USING (series_name) WHERE n >= 3 AND n >= 0.25 * docs),
found AS (SELECT DISTINCT record_id, line_no FROM k JOIN often USING (series_name, key)
          WHERE element_type IS NULL OR element_type <> 'heading')
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"WITH {_LINES} SELECT record_id, CAST(line_no AS BIGINT) AS line_no FROM found",
        "p2_clean": f"""WITH {_LINES},
c AS (SELECT record_id, count(*) AS n_removed FROM found GROUP BY ALL),
kept AS (SELECT l.record_id, string_agg(line, chr(10) ORDER BY l.line_no) AS text FROM l
         WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.record_id = l.record_id AND f.line_no = l.line_no) GROUP BY ALL)
SELECT r.record_id, r.document_id, coalesce(kept.text, '') AS text, CAST(n_removed AS BIGINT) AS n_removed
FROM r JOIN c USING (record_id) LEFT JOIN kept USING (record_id)""",
        "p7_found": """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS a FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS a FROM eval_items WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, array_to_string(a[p:p + 11], ' ') AS g FROM (SELECT item_id, a, unnest(range(1, len(a) - 10)) AS p FROM i)),
dw AS (SELECT doc_id, array_to_string(a[p:p + 11], ' ') AS g FROM (SELECT doc_id, a, unnest(range(1, len(a) - 10)) AS p FROM w))
SELECT DISTINCT item_id, doc_id FROM iw JOIN dw USING (g)""",
    }
