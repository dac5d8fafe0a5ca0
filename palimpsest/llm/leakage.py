"""Evaluation texts leaking into training text (problem 7), by greedy string tiling.

The evaluation items are a fixed set; their words and the Karp-Rabin hashes
of their word windows travel to the executors as one table whose size is
that of the items, not of the corpus. A document's words are looked up among
the items' words; only stretches of shared words that are long enough to
hold a tile are hashed. For each (item, document) that shares a window, the
longest non-overlapping matches are marked, longest first, so that passages
in another order are found as well; their tokens over the item's tokens are
its coverage.

Defined results: null or empty texts share nothing; repeated rows of a
document or item give one row; items shorter than the least match cannot be
found; ties between equally long matches go to the first position.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import checkpoint, ship_package

#: Least number of consecutive words that count as a leaked passage.
MIN_MATCH = 12
#: Least length of a tile, and so of the windows that are looked up; least share of an item under tiles that counts as leaked.
MIN_TILE, MIN_COVERAGE = 8, 0.6
#: Evaluation items are read to the driver; more characters than this are refused.
MAX_ITEM_CHARS = 50_000_000

WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Running Karp-Rabin hash of every window of n ids, modulo 2**64.

    The sum of x[j] * base**j runs along; a window is the difference of two
    sums, shifted back to its own place by a power of the base's inverse.
    """
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(x) - 1, _BASE, np.uint64))), dtype=np.uint64)
    down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(x) - n, _INVERSE, np.uint64))), dtype=np.uint64)
    run = np.concatenate(([np.uint64(0)], np.cumsum(x * up, dtype=np.uint64)))
    h = (run[n:] - run[:-n]) * down
    return h ^ (h >> np.uint64(31))


def runs(known: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of true values of at least the given length."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


class ItemIndex:
    """Vocabulary and window hashes of the evaluation items."""

    def __init__(self, items: list[tuple[int, str]], min_tile: int = MIN_TILE):
        self.n = min_tile
        self.vocabulary: dict[str, int] = {}
        self.items: dict[int, np.ndarray] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            if ids:
                self.items[item] = np.array(ids, np.int64)
        hashes, owner, at = [], [], []
        for item, ids in self.items.items():
            h = window_hashes(ids, min_tile)
            hashes.append(h)
            owner.append(np.full(len(h), item, np.int64))
            at.append(np.arange(len(h)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int64))[order]
        self.at = (np.concatenate(at) if at else np.zeros(0, np.int64))[order]

    def seeds(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Shared windows of a document's word ids (-1: no item's word): item -> (item position, document position)."""
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for a, b in runs(ids >= 0, self.n):
            h = window_hashes(ids[a:b], self.n)
            left = np.searchsorted(self.hashes, h, "left")
            right = np.searchsorted(self.hashes, h, "right")
            for k in np.flatnonzero(right > left).tolist():
                for j in range(left[k], right[k]):
                    item, p, q = int(self.owner[j]), int(self.at[j]), a + k
                    if np.array_equal(self.items[item][p : p + self.n], ids[q : q + self.n]):  # a hash is no proof
                        out[item].append((p, q))
        return out


def tiles(item: np.ndarray, doc: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item position, document position, length), longest first, none overlapping."""
    matches = []
    done: set[tuple[int, int]] = set()
    for p, q in sorted(seeds):
        if (p, q) in done:
            continue
        k = 0
        while p + k < len(item) and q + k < len(doc) and item[p + k] == doc[q + k]:
            done.add((p + k, q + k))
            k += 1
        matches.append((k, p, q))
    in_item, in_doc, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    pending = sorted(matches, key=lambda m: (-m[0], m[1], m[2]))
    while pending:
        k, p, q = pending.pop(0)
        used = in_item[p : p + k] | in_doc[q : q + k]
        if not used.any():
            in_item[p : p + k] = in_doc[q : q + k] = True
            out.append((p, q, k))
            continue
        left = [(b - a, p + a, q + a) for a, b in runs(~used, least)]  # what remains unmarked of it
        if left:
            pending = sorted(pending + left, key=lambda m: (-m[0], m[1], m[2]))
    return out


LEAKED = "item_id long, doc_id long, n_tiles long, longest long, matched_words long, item_words long, coverage double"


def leaked(documents: DataFrame, items: DataFrame, *, min_tile: int = MIN_TILE) -> DataFrame:
    """One row per (item, document) that shares a tile, with tiles and coverage of the item."""
    spark = documents.sparkSession
    ship_package(spark)
    given = items.select("item_id", "text").where("text is not null and item_id is not null").distinct()
    if (given.agg(F.sum(F.length("text"))).first()[0] or 0) > MAX_ITEM_CHARS:
        raise ValueError("the evaluation items are too large to be sent to every executor; pass them in parts")
    rows = [(r[0], r[1]) for r in given.toLocalIterator()]
    index = spark.sparkContext.broadcast(ItemIndex(sorted(rows), min_tile))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = index.value
        get = ix.vocabulary.get
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                if not text:
                    continue
                ids = np.array([get(w, -1) for w in WORD.findall(text.lower())], np.int64)
                for item, seeds in ix.seeds(ids).items() if len(ids) >= ix.n else ():
                    t = tiles(ix.items[item], ids, seeds, ix.n)
                    n, total = sum(k for _, _, k in t), len(ix.items[item])
                    out.append((item, doc, len(t), max(k for _, _, k in t), n, total, n / total))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LEAKED.split(", ")])

    return documents.select("doc_id", "text").where("text is not null and doc_id is not null").mapInPandas(find, LEAKED)


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id): the document holds at least 12 consecutive words of the item, so its longest tile has as many."""
    return leaked(documents, items).where(f"longest >= {MIN_MATCH}").select("item_id", "doc_id").distinct()


def leak_report(documents: DataFrame, items: DataFrame, *, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Per leaked item: number of documents, of those found by coverage alone, and of sources; best coverage, longest passage.

    A document counts if it holds a passage of ``MIN_MATCH`` words, or if
    tiles in whatever order cover ``min_coverage`` of the item.
    """
    each = leaked(documents, items).where((F.col("longest") >= MIN_MATCH) | (F.col("coverage") >= min_coverage))
    hits = each.groupBy("item_id", "doc_id").agg(F.max("coverage").alias("coverage"), F.max("longest").alias("longest"))
    hits = checkpoint(hits)  # few rows; the corpus is then read again for their sources only
    src = documents.select("doc_id", "source").join(hits.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return (
        hits.join(src, "doc_id")
        .groupBy("item_id")
        .agg(F.count("*").alias("n_docs"), F.count_if(F.col("longest") < MIN_MATCH).alias("n_by_coverage"), F.countDistinct("source").alias("n_sources"), F.max("coverage").alias("coverage"), F.max("longest").alias("longest"))
    )
