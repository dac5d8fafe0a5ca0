"""Lines repeated across one source's documents (problem 2).

Every line is reduced to its letters in lower case. A count table holds, for
each (source, line), the number of distinct documents that contain it. New
partitions are merged as deltas: only their own lines are counted and added,
and the lines that cross the threshold in either direction are written down.
The lines to be removed are those that have crossed upwards and not back; only
documents that hold a newly crossed line are rebuilt.

Defined results: null text has no lines; null sources and null documents are
left out of the counts; repeated rows count once; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import ensure_checkpoint_dir

#: A line with fewer letters is never boilerplate.
MIN_LETTERS = 12
#: Least number of documents, and least share of the source's documents.
MIN_DOCS = 3
MIN_SHARE = 0.25


def line_letters(line: Column) -> Column:
    """The letters of a line in lower case, without anything else."""
    return F.lower(F.regexp_replace(line, r"[^\p{L}]+", ""))


def source_lines(
    rows: DataFrame,
    *,
    source: str = "series_name",
    document: str = "document_id",
    row: str = "record_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per line that has enough letters: source, document, row, line_no, key."""
    extra = [F.col(c) for c in keep or []]
    lines = rows.select(
        F.col(source).alias("source"), F.col(document).alias("document"), F.col(row).alias("row"), *extra,
        F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"),
    )
    letters = lines.withColumn("letters", line_letters(F.col("line"))).where(F.length("letters") >= MIN_LETTERS)
    # 96 bits of hash stand for the line from here on, so that no text is shuffled
    return letters.select(
        "source", "document", "row", *(keep or []), F.col("line_no").cast("long").alias("line_no"),
        F.xxhash64("letters").alias("key"), F.crc32(F.encode("letters", "utf-8")).alias("key2"),
    )


def document_counts(rows: DataFrame, *, source: str = "series_name", document: str = "document_id") -> DataFrame:
    """Number of distinct documents of each source (two-step, so that no source is one task)."""
    return (
        rows.select(F.col(source).alias("source"), F.col(document).alias("document"))
        .where("source is not null and document is not null")
        .distinct()
        .groupBy("source")
        .agg(F.count("*").alias("n_docs"))
    )


def line_pairs(lines: DataFrame) -> DataFrame:
    """The distinct (source, line, document) triples of a partition: its delta."""
    return lines.where("source is not null and document is not null").select("source", "key", "key2", "document").distinct()


def frequent_lines(counts: DataFrame, n_docs: DataFrame) -> DataFrame:
    """Lines at or above the threshold.

    A source whose documents hold L distinct lines on average has at most
    L / MIN_SHARE such lines, whatever its number of documents.
    """
    return (
        counts.where(F.col("n") >= MIN_DOCS)
        .join(n_docs, "source")  # one row per source: broadcast by its size where it is small
        .where(F.col("n") >= F.col("n_docs") * F.lit(MIN_SHARE))
        .select("source", "key", "key2", "n", "n_docs")
    )


def crossings(before: DataFrame, after: DataFrame) -> DataFrame:
    """Lines that became frequent or ceased to be: source, key, key2, frequent."""
    k = ["source", "key", "key2"]
    up = after.select(*k).join(before.select(*k), k, "left_anti").withColumn("frequent", F.lit(True))
    down = before.select(*k).join(after.select(*k), k, "left_anti").withColumn("frequent", F.lit(False))
    return up.unionByName(down)


def lines_of(records: DataFrame, often: DataFrame) -> DataFrame:
    """(record_id, line_no) of the given lines (source, key, key2) in non-heading records."""
    lines = source_lines(records.where("element_type is null or element_type <> 'heading'"))
    return lines.join(often, ["source", "key", "key2"]).select(F.col("row").alias("record_id"), "line_no").distinct()


def found_lines(records: DataFrame, *, boundary: Column | None = None, path: str | None = None) -> DataFrame:
    """(record_id, line_no) of boilerplate lines of non-heading records.

    The rows for which ``boundary`` holds (all, where there is none) are
    counted first, the others are merged as a delta. ``path`` is the folder
    of the counts; without one a new folder is made beside the checkpoints.
    """
    store = LineCountStore(records.sparkSession, path or f"{ensure_checkpoint_dir(records.sparkSession).rstrip('/')}/line-counts-{uuid.uuid4().hex}")
    first = F.lit(True) if boundary is None else F.coalesce(boundary, F.lit(True))
    store.add(records.where(first))
    if boundary is not None:
        store.add(records.where(~first))
    return lines_of(records, store.lines())


def strip_lines(records: DataFrame, found: DataFrame) -> DataFrame:
    """Records that held boilerplate, with each text rebuilt without those lines.

    Only rows named in ``found`` are rebuilt; every other text is as it was.
    """
    cut = found.groupBy("record_id").agg(F.sort_array(F.collect_set("line_no")).alias("cut"))
    hit = records.dropDuplicates(["record_id"]).join(cut, "record_id")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("cut"), i.cast("long")))
    return hit.select("record_id", "document_id", F.array_join(kept, "\n").alias("text"), F.size("cut").cast("long").alias("n_removed"))


class LineCountStore:
    """A persistent line-count table in a shared folder, one sub-folder per version.

    A version counts once its mark is written, so what a lost run left is
    written over; a store opened on a folder goes on from its last version.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.version = 0
        while self._marked(self.version + 1):
            self.version += 1

    def _fs(self, at: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _marked(self, version: int) -> bool:
        fs, p = self._fs(f"{self.path}/v{version}/_done")
        return fs.exists(p)

    def _read(self, name: str, schema: str, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/v{v}/{name}" for v in versions])

    def _last(self) -> list[int]:
        return [self.version] if self.version else []

    def _all(self) -> list[int]:
        return list(range(1, self.version + 1))

    def counts(self) -> DataFrame:
        return self._read("counts", "source string, key long, key2 long, n long", self._last())

    def documents(self) -> DataFrame:
        return self._read("documents", "source string, n_docs long", self._last())

    def pairs(self) -> DataFrame:
        """The distinct (source, line, document) of all partitions; each version adds its new ones."""
        return self._read("pairs", "source string, key long, key2 long, document string", self._all())

    def known_documents(self) -> DataFrame:
        return self._read("docs", "source string, document string", self._all())

    def crossed(self, version: int | None = None) -> DataFrame:
        """Lines that crossed the threshold with a version (the last one): source, key, key2, frequent."""
        return self._read("crossed", "source string, key long, key2 long, frequent boolean", [version or self.version] if self.version else [])

    def lines(self) -> DataFrame:
        """Lines above the threshold, from what has crossed so far: source, key, key2."""
        return self._read("frequent", "source string, key long, key2 long", self._last())

    def add(self, rows: DataFrame) -> DataFrame:
        """Merge a partition; returns the lines that crossed the threshold.

        Of what was counted before, only the triples of the partition's own
        documents and the sums are needed; no earlier text is read.
        """
        at = f"{self.path}/v{self.version + 1}"
        held = rows.select(F.col("series_name").alias("source"), F.col("document_id").alias("document")).where("source is not null and document is not null").distinct()
        fresh_docs = held.join(self.known_documents(), ["source", "document"], "left_anti") if self.version else held
        fresh_docs.write.mode("overwrite").parquet(f"{at}/docs")
        new_docs = self.spark.read.parquet(f"{at}/docs").groupBy("source").agg(F.count("*").alias("n_docs"))
        self.documents().unionByName(new_docs).groupBy("source").agg(F.sum("n_docs").alias("n_docs")).write.mode("overwrite").parquet(f"{at}/documents")

        delta = line_pairs(source_lines(rows))
        fresh = delta.join(self.pairs(), ["source", "key", "key2", "document"], "left_anti") if self.version else delta
        fresh.write.mode("overwrite").parquet(f"{at}/pairs")
        added = self.spark.read.parquet(f"{at}/pairs").groupBy("source", "key", "key2").agg(F.count("*").alias("n"))
        merged = self.counts().unionByName(added).groupBy("source", "key", "key2").agg(F.sum("n").alias("n")) if self.version else added
        merged.write.mode("overwrite").parquet(f"{at}/counts")

        key = ["source", "key", "key2"]
        after = frequent_lines(self.spark.read.parquet(f"{at}/counts"), self.spark.read.parquet(f"{at}/documents")).select(*key)
        crossings(self.lines(), after).write.mode("overwrite").parquet(f"{at}/crossed")
        crossed = self.spark.read.parquet(f"{at}/crossed")
        kept = self.lines().join(crossed.where("not frequent"), key, "left_anti")
        kept.unionByName(crossed.where("frequent").select(*key)).coalesce(1).write.mode("overwrite").parquet(f"{at}/frequent")
        fs, p = self._fs(f"{at}/_done")
        fs.create(p, True).close()
        self.version += 1
        return self.crossed()

    def documents_to_rebuild(self, crossed: DataFrame) -> DataFrame:
        """(source, document) of every document that holds a line that crossed."""
        return self.pairs().join(crossed.select("source", "key", "key2"), ["source", "key", "key2"], "left_semi").select("source", "document").distinct()
