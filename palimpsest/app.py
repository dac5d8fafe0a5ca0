"""Command line: ``python -m palimpsest.app series|audit ...`` over page tables and exported parts."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from palimpsest.operators import audit, export, metadata, qa, segment
from palimpsest.session import checkpoint
from palimpsest.sources import blocks, config, pages


def series(spark: SparkSession, source: str, out: str, *, series_config: str | None = None, config_dir: str | None = None, limit: int | None = None, max_bytes: int = export.PART_BYTES) -> dict:
    """Page table (Parquet) or folder of text files to records, checks and exports."""
    p = pages.from_parquet(spark, source) if not source.endswith(".txt") else pages.from_text_files(spark, source)
    if limit:
        p = p.join(p.select("source_file").distinct().orderBy("source_file").limit(limit), "source_file", "left_semi")
    cfg = config.load(series_config)
    names = [r[0] for r in p.select("source_file").distinct().orderBy("source_file").toLocalIterator()] if cfg or config_dir else []
    docs = metadata.infer(p, config=config.as_table(spark, names, cfg, config_dir) if names else None)
    for c in ("document_family", "document_type"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.coalesce(F.nullif("series_name", F.lit("")), F.lit("")) if c == "document_family" else _slug("document_category"))
    records = checkpoint(segment.records(p, docs))
    export.write_series(records, docs, out, max_bytes)
    manifest = export.manifest_rows(records, docs).withColumn("status", F.lit("ok")).withColumn("run_id", F.lit("run")).withColumn("source_pdf", F.lit("")).withColumn("error", F.lit(None).cast("string"))
    findings = qa.run_checks(records, manifest)
    findings.write.mode("overwrite").json(f"{out}/qa")
    return {"records": records.count(), "findings": spark.read.json(f"{out}/qa").count()}


def _slug(c: str):
    return F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), "[^a-z0-9]+", "_")


def run_audit(spark: SparkSession, parts: str, out: str) -> dict:
    """Exported parts to candidates, corrections and clean records."""
    k = blocks.read_parts(spark, parts)
    ids = audit.stable_ids(k)
    k = k.join(ids, "original_record_index").withColumnRenamed("stable_id", "stable_internal_id")
    k = k.withColumn("record_type", F.split_part("record", F.lit(" "), F.lit(1))).withColumn("official_record_label", F.expr("case when instr(record, ' ') > 0 then substring(record, instr(record, ' ') + 1) else '' end"))
    for c in ("layout_ambiguous", "layout_text"):
        k = k.withColumn(c, F.lit(False))
    for c in ("manual_review_labels", "auto_fixed_labels"):
        k = k.withColumn(c, F.array().cast("array<string>"))
    k = checkpoint(k)
    audit.detect(k).write.mode("overwrite").json(f"{out}/candidates")
    audit.corrections(k).write.mode("overwrite").json(f"{out}/corrections")
    audit.clean_records(k).write.mode("overwrite").json(f"{out}/records")
    return {r["metric"]: r["n"] for r in audit.summary(k).collect()}  # a few dozen rows


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(description=__doc__)
    sub = a.add_subparsers(dest="command", required=True)
    s = sub.add_parser("series")
    s.add_argument("source")
    s.add_argument("--out", required=True)
    s.add_argument("--series-config")
    s.add_argument("--config-dir")
    s.add_argument("--limit", type=int)
    s.add_argument("--max-bytes", type=int, default=export.PART_BYTES)
    u = sub.add_parser("audit")
    u.add_argument("parts")
    u.add_argument("--out", required=True)
    x = a.parse_args(argv)
    spark = SparkSession.builder.appName("palimpsest").getOrCreate()
    if x.command == "series":
        done = series(spark, x.source, x.out, series_config=x.series_config, config_dir=x.config_dir, limit=x.limit, max_bytes=x.max_bytes)
    else:
        done = run_audit(spark, x.parts, x.out)
    print(json.dumps(done, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
