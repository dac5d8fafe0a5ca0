"""Exports: labelled chunks, previews, Markdown blocks, size-bounded parts, manifests.

Null texts export as empty; null section paths as empty paths.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palimpsest.functions import text as X
from palimpsest.session import checkpoint, ship_package

#: Size of a part, what is set aside for its head, least body (bytes).
PART_BYTES, HEAD_BYTES, LEAST_BODY = 4_500_000, 100_000, 1_000


def current(records: DataFrame) -> DataFrame:
    """The latest row of each record id (partial aggregate, no window)."""
    cols = [c for c in records.columns if c not in ("record_id", "extracted_at")]
    latest = records.groupBy("record_id").agg(F.max_by(F.struct(*cols), F.coalesce(F.col("extracted_at").cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))).alias("r"))
    return latest.select("record_id", "r.*")


def section() -> Column:
    return F.coalesce(F.array_join("section_path", " > "), F.lit(""))


def content_text() -> Column:
    """The text, after its caption and its table title where it does not hold them."""
    t = F.coalesce("text", F.lit(""))
    caption = F.when((F.col("caption") != "") & ~t.contains(F.col("caption")), F.concat(F.lit("Caption: "), F.col("caption")))
    title = F.when((F.col("element_type") == "table") & (F.col("title") != "") & ~t.contains(F.col("title")), F.concat(F.lit("Table title: "), F.col("title")))
    return F.concat_ws("\n", caption, title, t)


def chunk_records(records: DataFrame) -> DataFrame:
    """Records with a chunk text headed by document, label, status, region and pages."""
    head = F.format_string("[doc: %s | record: %s | status: %s | region: %s | pdf: %s]", X.compact_id("document_id"), X.record_label("element_type", "element_id"), "text_status", "source_region", X.page_label("page_start_pdf", "page_end_pdf"))
    keep = (
        "record_id document_id document_title document_family document_category document_type document_domain series_name series_number element_type element_id "
        "source_region text_status section_path page_start_pdf page_end_pdf page_start_printed page_end_printed"
    ).split()
    return records.select(*keep, F.concat(head, F.lit("\nSection: "), section(), F.lit("\n\n"), content_text()).alias("gpt_chunk_text"))


def csv_preview(records: DataFrame) -> DataFrame:
    e = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return records.select(
        "record_id", "document_id", "document_type", "document_category", "element_type", e("element_id"), "source_region", "text_status", "page_start_pdf", "page_end_pdf", e("page_start_printed"), e("page_end_printed"),
        section().alias("section_path"), e("title"), e("caption"), "confidence", F.translate(F.substring(F.coalesce("text", F.lit("")), 1, 400), "\n", " ").alias("text_preview"),
    )


def markdown_block() -> Column:
    """The block of a record: six header lines, a blank line, the text; read back by ``sources.blocks``."""
    return F.format_string(
        "\n---\ndoc: %s\nrecord: %s\nstatus: %s\nregion: %s\npdf: %s\nsection: %s\n\n%s\n",
        X.compact_id("document_id"), X.record_label("element_type", "element_id"), "text_status", "source_region", X.page_label("page_start_pdf", "page_end_pdf"), section(), content_text(),
    )


def document_header(continued: bool = False) -> Column:
    return F.format_string(
        "\n\n# Document: %s" + (" (continued)" if continued else "") + " - %s\n\n- Full ID: %s\n- Category: %s\n- Type: %s\n- Series: %s %s\n",
        X.compact_id("document_id"), "document_title", "document_id", "document_category", "document_type", "series_name", "series_number",
    )


def part_numbers(records: DataFrame, max_bytes: int = PART_BYTES, streams: int = 1) -> DataFrame:
    """document_id, record_id, seq, n_bytes, part: records packed greedily in order into parts of bounded size.

    A part closes before the record that would overfill it, and the next one
    opens with the document's continued header; an oversize record has a part
    of its own (after one that may hold only a header). Packing is a fold, so
    only (order, sizes) pass through it, streamed: 20 bytes a record. One
    stream keeps the order of the whole series. With more, documents are
    spread over that many streams by the hash of their id; each stream packs
    its own parts, in parallel, and at most one part a stream is short.
    """
    ship_package(records.sparkSession)
    limit = max(LEAST_BODY, max_bytes - HEAD_BYTES)
    order = ["stream", "document_id", "seq", "record_id"]
    rows = records.select(
        F.pmod(F.xxhash64("document_id"), F.lit(streams)).alias("stream"), "document_id", "record_id", "seq", F.octet_length(markdown_block()).cast("long").alias("n_bytes"),
        F.octet_length(document_header()).cast("long").alias("head"), F.octet_length(document_header(True)).cast("long").alias("again"),
    )
    rows = rows.orderBy(*order).coalesce(1) if streams == 1 else rows.repartition(streams, "stream").sortWithinPartitions(*order)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, part, used, doc = None, 1, 0, None
        for pdf in batches:
            numbers = []
            for k, d, n, head, again in zip(pdf["stream"], pdf["document_id"], pdf["n_bytes"], pdf["head"], pdf["again"]):
                if k != stream:
                    stream, part, used, doc = k, 1, 0, None
                if d != doc:
                    if used and used + head > limit:
                        part, used = part + 1, 0
                    doc, used = d, used + head
                if used + n > limit:
                    part, used = part + 1, again
                used += n
                numbers.append(part)
            yield pdf[["stream", "document_id", "record_id", "seq", "n_bytes"]].assign(part=numbers)

    packed = rows.mapInPandas(fold, "stream long, document_id string, record_id string, seq long, n_bytes long, part long")
    if streams == 1:
        return packed.drop("stream")
    packed = checkpoint(packed)
    ends = packed.groupBy("stream").agg(F.max("part").alias("parts"))  # one row per stream
    before = F.coalesce(F.sum("parts").over(Window.orderBy("stream").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return packed.join(F.broadcast(ends.select("stream", before.alias("before"))), "stream").withColumn("part", F.col("part") + F.col("before")).drop("stream", "before")


def manifest_rows(records: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per document: counts by type, in one aggregate."""
    n = lambda t, name: F.count_if(F.col("element_type") == t).alias(name)
    counts = records.groupBy("document_id").agg(F.count("*").alias("record_count"), n("paragraph", "paragraphs"), n("figure", "figures"), n("table", "tables"), n("footnote", "footnotes"), n("reference", "references_count"))
    d = docs.select("document_id", "title", "document_category", "document_type", "series_name", "series_number", "publication_year")
    zero = {c: 0 for c in ("record_count", "paragraphs", "figures", "tables", "footnotes", "references_count")}
    return d.join(counts, "document_id", "left").fillna(zero)


def type_counts(records: DataFrame) -> DataFrame:
    """document_id and a map of element type to count."""
    per = records.where("element_type is not null").groupBy("document_id", "element_type").agg(F.count("*").alias("n"))
    return per.groupBy("document_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("element_type", "n")))).alias("counts"))


def document_manifest_checksum(docs: DataFrame, records: DataFrame) -> str:
    """SHA-256 of the sorted list of documents, as JSON (driver; a few fields a document)."""
    import hashlib

    n = records.groupBy("document_id").agg(F.count("*").alias("record_count"))
    rows = docs.join(n, "document_id", "left").select("document_id", "source_file", "source_sha256", F.coalesce("record_count", F.lit(0)).alias("record_count")).orderBy("document_id")
    listed = [{"document_id": r[0], "record_count": r[3], "source_pdf": r[1], "source_sha256": r[2]} for r in rows.toLocalIterator()]
    return hashlib.sha256(json.dumps(listed, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


def document_changes(knowledge: DataFrame) -> DataFrame:
    """Rows of a part with a flag where another document begins (a header goes there)."""
    w = Window.partitionBy("part_file").orderBy("original_record_index")
    return knowledge.withColumn("new_document", ~F.col("doc").eqNullSafe(F.lag("doc").over(w)) | F.lag("original_record_index").over(w).isNull())


def write_series(records: DataFrame, docs: DataFrame, out: str, max_bytes: int = PART_BYTES) -> None:
    """JSON lines, CSV preview, Markdown parts, manifest and chunk records under ``out``."""
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/records")
    chunk_records(records).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/chunks")
    csv_preview(records).write.mode("overwrite").option("header", True).csv(f"{out}/preview")
    manifest_rows(records, docs).write.mode("overwrite").option("header", True).csv(f"{out}/manifest")
    parts = part_numbers(records, max_bytes).select("record_id", "seq", "part")
    first = F.row_number().over(Window.partitionBy("part", "document_id").orderBy("seq", "record_id")) == 1
    started = F.row_number().over(Window.partitionBy("document_id").orderBy("seq", "record_id")) == 1
    lines = records.join(parts, ["record_id", "seq"]).withColumn("_a", first).withColumn("_b", started)
    block = F.concat(F.when(F.col("_b"), document_header()).when(F.col("_a"), document_header(True)).otherwise(""), markdown_block())
    lines.select("part", "document_id", "seq", "record_id", block.alias("value")).repartitionByRange("part").sortWithinPartitions("part", "document_id", "seq", "record_id").select("part", "value").write.mode("overwrite").partitionBy("part").text(f"{out}/parts")
