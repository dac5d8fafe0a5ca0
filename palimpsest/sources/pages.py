"""Page tables: from Parquet, text and JSON files, and from binary files through an extractor."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "source_file string, source_sha256 string, pdf_page int, printed_page string, text string, lines array<string>"


def from_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def from_text_files(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """Text files as publications; form feeds part their pages."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).text(path, wholetext=True)
    named = files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"), F.sha2(F.encode("value", "utf-8"), 256).alias("source_sha256"), F.posexplode(F.split("value", "\f")).alias("p", "text"))
    return named.select("source_file", "source_sha256", (F.col("p") + 1).cast("int").alias("pdf_page"), F.lit(None).cast("string").alias("printed_page"), "text", F.split("text", r"\r\n|[\n\r]").alias("lines"))


def from_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).json(path)


def discover(spark: SparkSession, path: str, pattern: str = "*.pdf", recursive: bool = False) -> DataFrame:
    """path, length and SHA-256 of the files, sorted by path; the suffix in either case."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path)
    return files.where(F.lower("path").endswith(".pdf") | ~F.lit(pattern.lower().endswith(".pdf"))).select("path", "length", F.sha2("content", 256).alias("sha256")).orderBy("path")


def extract(spark: SparkSession, path: str, extractor: Callable[[bytes], list[list[str]]], pattern: str = "*.pdf", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pages of binary files through ``extractor`` (content to lines of pages), and the files it failed on."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, content in zip(pdf["path"], pdf["content"]):
                try:
                    pages = extractor(bytes(content))
                    out += [(name, i, list(lines), None) for i, lines in enumerate(pages, 1)] or [(name, 0, [], "no pages")]
                except Exception as e:  # a bad file must not end the job
                    out.append((name, 0, [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "pdf_page", "lines", "error"])

    raw = files.select("path", "content").mapInPandas(run, "path string, pdf_page int, lines array<string>, error string")
    name = F.element_at(F.split("path", "/"), -1)
    good = raw.where("error is null").select(name.alias("source_file"), F.lit(None).cast("string").alias("source_sha256"), "pdf_page", F.lit(None).cast("string").alias("printed_page"), F.array_join("lines", "\n").alias("text"), "lines")
    return good, raw.where("error is not null").select(name.alias("source_pdf"), "error")
