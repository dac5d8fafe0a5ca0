"""Filling containers of fixed capacity (problem 6), by large-item matching.

Sizes are whole numbers up to the capacity, so the plan is made over the
table of sizes (how many items have each size), which never has more rows
than the capacity, however many documents there are. Items above a third of
the capacity are matched first, at most two to a container, each with the
largest that still fits; smaller items then go, largest first, to the
container with the least room that holds them (best fit). The plan is a list
of container patterns with multiplicities. Items are numbered within their
size and take the pattern slots of their number; the numbering is done per
(size, bucket) with offsets, so no size is one task.

Defined results: null texts are left out; an empty text has 0 tokens and
goes to container -1 (it takes no room); a text above the capacity is cut
into full containers and a rest; repeated rows of a doc_id count once; ties
go to the lower doc_id within a bucket.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from palimpsest.session import checkpoint, ship_package

CAPACITY = 2048
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokenisation pattern of the byte-level tokenizer (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Numbering buckets per size.
BUCKETS = 64

_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a rank file, loaded once per Python worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def token_counts(documents: DataFrame, tokenizer_path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """doc_id and number of tokens of each text."""
    ship_package(documents.sparkSession)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer(tokenizer_path).encode_ordinary
        for s in batches:
            yield pd.Series([len(encode(x)) for x in s], dtype="int64")

    udf = F.pandas_udf(count, T.LongType())
    return documents.where("doc_id is not null and text is not null").select("doc_id", udf("text").alias("n_tokens"))


def pieces(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, size: items above the capacity cut into full pieces and a rest."""
    n = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / capacity)).cast("int")
    return sizes.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - F.col("piece") * capacity).alias("size")
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Container patterns (sizes, largest first) with the number of containers of each."""
    left = {s: n for s, n in histogram.items() if n > 0 and 0 < s <= capacity}
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # room -> patterns
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        room = capacity - sum(pattern)
        if room not in bins:
            bins[room] = []
            insort(rooms, room)
        bins[room].append((pattern, n))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        n = left[a]
        k = bisect_left(large, capacity - a + 1) - 1  # the largest that fits beside it
        if k < 0:
            put((a,), n)
            m, b = n, None
        else:
            b = large[k]
            m = n // 2 if b == a else min(n, left[b])
            if m == 0:  # one is left over, and the next smaller may fit
                k -= 1
                if k < 0:
                    put((a,), 1)
                    m, b = 1, None
                else:
                    b, m = large[k], 1
            if b is not None:
                put((a, b), m)
        for s in (a,) if b is None else (a, b):
            left[s] -= m
        large = [s for s in large if left[s] > 0] if min(left[a], left[b] if b is not None else 1) <= 0 else large

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            k = bisect_left(rooms, s)
            if k == len(rooms):
                each = capacity // s
                if n >= each:
                    put((s,) * each, n // each)
                if n % each:
                    put((s,) * (n % each), 1)
                n = 0
                continue
            room = rooms[k]
            pattern, have = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(k)
            each = min(room // s, n)
            used = min(have, n // each)
            put(pattern + (s,) * each, used)
            if have > used:
                if room not in bins:
                    bins[room] = []
                    insort(rooms, room)
                bins[room].append((pattern, have - used))
            n -= used * each
    out: dict[tuple[int, ...], int] = {}
    for group in bins.values():
        for pattern, n in group:
            out[pattern] = out.get(pattern, 0) + n
    return sorted(out.items(), reverse=True)


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first number, end number, slots per container, first container) of each pattern and size."""
    taken: dict[int, int] = {}
    rows, base = [], 0
    for pattern, n in patterns:
        for s in sorted(set(pattern)):
            k = pattern.count(s)
            a = taken.get(s, 0)
            rows.append((s, a, a + k * n, k, base))
            taken[s] = a + k * n
        base += n
    return rows


def pack(documents: DataFrame, *, capacity: int = CAPACITY, tokenizer_path: str = DEFAULT_TOKENIZER, sizes: DataFrame | None = None) -> DataFrame:
    """doc_id, piece, n_tokens, container_id of every document (and piece of an oversized one).

    ``sizes`` may give (doc_id, n_tokens) where they are known already.
    """
    spark = documents.sparkSession if sizes is None else sizes.sparkSession
    counted = token_counts(documents, tokenizer_path) if sizes is None else sizes
    # tokenised once: three small columns are written, then read for the table of sizes and for the numbering
    items = checkpoint(pieces(counted.groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens")), capacity).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int")))
    # at most capacity x BUCKETS rows, whatever the number of documents
    counts = items.where("size > 0").groupBy("size", "bucket").agg(F.count("*").alias("n")).collect()
    by_size: dict[int, list[tuple[int, int]]] = {}
    for r in counts:
        by_size.setdefault(r["size"], []).append((r["bucket"], r["n"]))
    offsets, histogram = [], {}
    for s, of in by_size.items():
        at = 0
        for b, n in sorted(of):
            offsets.append((s, b, at))
            at += n
        histogram[s] = at
    slots = slot_table(plan(histogram, capacity))
    off = spark.createDataFrame(offsets, "size long, bucket int, offset long")
    table = spark.createDataFrame(slots, "size long, first long, end long, slots int, base long")
    ranked = (
        items.where("size > 0")
        .withColumn("rn", F.row_number().over(Window.partitionBy("size", "bucket").orderBy("doc_id", "piece")) - 1)
        .join(F.broadcast(off), ["size", "bucket"])  # capacity x BUCKETS rows at most
        .withColumn("number", F.col("rn") + F.col("offset"))
    )
    placed = ranked.join(F.broadcast(table), "size").where("number >= first and number < end")  # the plan's rows: bounded by the capacity, not by the documents
    full = placed.select("doc_id", "piece", F.col("size").alias("n_tokens"), (F.col("base") + F.floor((F.col("number") - F.col("first")) / F.col("slots"))).cast("long").alias("container_id"))
    empty = items.where("size <= 0").select("doc_id", "piece", F.col("size").alias("n_tokens"), F.lit(-1).cast("long").alias("container_id"))
    return full.unionByName(empty)


def packing_summary(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Number of containers, tokens, unused room and its share."""
    used = packed.where("container_id >= 0")
    return used.agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens")).select(
        "n_containers", "n_tokens", (F.col("n_containers") * capacity - F.col("n_tokens")).alias("unused"),
        (1 - F.col("n_tokens") / (F.col("n_containers") * capacity)).alias("unused_share"),
    )
