"""Exported Markdown parts, read back into records; and manifests from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEYS = ("doc", "record", "status", "region", "pdf", "section")


def parse_blocks(parts: DataFrame) -> DataFrame:
    """Records from (part_file, value): what follows the heading of the records, split at the block lines.

    A block counts if its head is ``key: value`` lines with all six keys;
    text after a generated document header is cut. The index is global, in
    order of file and place; it is made by offsets per file, so no window
    spans all rows.
    """
    body = F.expr("case when instr(value, '## Structural records') > 0 then substring(value, instr(value, '## Structural records') + 21) else value end")
    b = parts.select("part_file", F.posexplode(F.split(body, r"\n---\n")).alias("pos", "block"))
    # all boundaries that end a line are made line feeds
    lines = F.split(F.regexp_replace(F.btrim(F.col("block"), F.lit("\n")), r"\r\n|[\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]", "\n"), "\n")
    blank = F.coalesce(F.array_position(F.transform(lines, lambda x: F.btrim(x) == ""), True), F.lit(0))
    n_head = F.when(blank > 0, blank - 1).otherwise(F.size(lines))
    head = F.slice(lines, F.lit(1), n_head.cast("int"))
    b = b.withColumn("_head", head).withColumn("_text", F.when(blank > 0, F.array_join(F.slice(lines, (blank + 1).cast("int"), F.greatest(F.size(lines), F.lit(1))), "\n")).otherwise(""))
    pattern = r"^(?:doc|record|status|region|pdf|section):\s*(.*)$"
    ok = (F.size("_head") > 0) & ~F.exists("_head", lambda x: ~x.rlike(pattern))
    value = {k: F.try_element_at(F.filter("_head", lambda x: x.startswith(f"{k}:")), F.lit(-1)) for k in KEYS}
    for v in value.values():
        ok = ok & v.isNotNull()
    cut = F.regexp_replace(F.try_element_at(F.split("_text", r"\n{2,}# Document:\s+", 2), F.lit(1)), r"\s+$", "")
    out = b.where(ok).select("part_file", "pos", *[F.regexp_replace(v, rf"^{k}:\s*", "").alias(k) for k, v in value.items()], cut.alias("text"))
    per_file = out.groupBy("part_file").agg(F.count("*").alias("n"))
    offset = per_file.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # one row per file
    number = F.row_number().over(Window.partitionBy("part_file").orderBy("pos"))
    return out.withColumn("_n", number).join(offset, "part_file").withColumn("original_record_index", (F.col("offset") + F.col("_n")).cast("long")).drop("_n", "offset", "pos")


def read_parts(spark: SparkSession, path: str, pattern: str = "part_*.md") -> DataFrame:
    files = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return parse_blocks(files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("part_file"), "value"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The last successful run of each document."""
    cols = [c for c in manifest.columns if c != "document_id"]
    g = manifest.where("status = 'ok' and document_id is not null").groupBy("document_id")
    return g.agg(F.max_by(F.struct(*cols), F.struct("run_id", "source_pdf")).alias("r")).select("document_id", "r.*")


def record_count_of_report(text: str) -> int | None:
    """The record count named in a quality report."""
    import re

    m = re.search(r"Total structural records:\s*(\d+)", text)
    return int(m.group(1)) if m else None
