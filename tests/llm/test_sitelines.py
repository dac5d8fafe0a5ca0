import re
from collections import defaultdict
from datetime import datetime

from pyspark.sql import functions as F

from palimpsest.llm import sitelines as S

SCHEMA = "record_id string, document_id string, series_name string, element_type string, text string, extracted_at timestamp, source string, line string"


def make(spark, rows):
    return spark.createDataFrame([(*r, datetime(2023, 1, 1 + i % 9), "clash", "clash") for i, r in enumerate(rows)], SCHEMA)


def brute(rows):
    key = lambda line: "".join(c for c in line.lower() if c.isalpha())
    seen, docs = defaultdict(set), defaultdict(set)
    for rid, doc, series, kind, text in rows:
        if series is not None and doc is not None:
            docs[series].add(doc)
            for line in (text or "").split("\n"):
                seen[series, key(line)].add(doc)
    out = set()
    for rid, doc, series, kind, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            n = len(seen.get((series, key(line)), ()))
            if text is not None and kind != "heading" and len(key(line)) >= 12 and n >= 3 and n >= 0.25 * len(docs[series]):
                out.add((rid, i))
    return out


ROWS = [(f"r{i}", f"d{i % 8}", "A" if i % 8 < 5 else "B", "heading" if i % 7 == 0 else "paragraph", t) for i, t in enumerate([
    "Share this guide now\nbody one", "SHARE  this guide, now!\n\nbody two", "share this guide now 7\nbody", "All rights reserved\nshare this", "Only once in here\nx", None, "", "All rights reserved.", "all RIGHTS reserved", "short", "Share this guide now", "Share this guide now",
    "1. INTRODUCTION", "INTRODUCTION", "introduction", "INTRODUCTION\nAll rights reserved",
])]


def test_brute_force_and_any_split(spark):
    want = brute(ROWS)
    assert want
    df = make(spark, ROWS)
    for boundary in (None, F.col("extracted_at") < F.lit("2023-01-05").cast("timestamp"), F.lit(False)):
        assert {tuple(r) for r in S.found_lines(df.unionByName(df), boundary=boundary).collect()} == want


def test_edges(spark):
    assert S.found_lines(make(spark, [])).count() == 0
    df = make(spark, [("r1", None, None, None, "x" * 20), ("r2", "d", None, "paragraph", "x" * 20), (None, "d", "A", "paragraph", "x" * 20)])
    assert S.found_lines(df).count() == 0
    many = [(f"r{i}", f"d{i}", "A", None, "A line of boilerplate\n" * 2000) for i in range(4)]
    assert S.found_lines(make(spark, many)).count() == 8000


def test_strip(spark):
    df = make(spark, ROWS)
    got = {r["record_id"]: r["text"] for r in S.strip_lines(df, S.found_lines(df)).collect()}
    assert got["r1"] == "\nbody two" and re.search("body", got["r2"]) and "r6" not in got


def test_store_merges_deltas(spark, tmp_path):
    store = S.LineCountStore(spark, str(tmp_path))
    first, second = make(spark, ROWS[:8]), make(spark, ROWS[8:] + ROWS[:2])
    store.add(first)
    crossed = store.add(second)
    once = S.LineCountStore(spark, str(tmp_path / "all"))
    once.add(make(spark, ROWS))
    assert {tuple(r) for r in store.counts().collect()} == {tuple(r) for r in once.counts().collect()}
    assert {tuple(r) for r in S.frequent_lines(store.counts(), store.documents()).collect()} == {tuple(r) for r in S.frequent_lines(once.counts(), once.documents()).collect()}
    touched = store.documents_to_rebuild(crossed)
    assert 0 < touched.count() < 9


def test_store_goes_on_where_it_stopped(spark, tmp_path):
    store = S.LineCountStore(spark, str(tmp_path))
    store.add(make(spark, ROWS[:5]))
    (tmp_path / "v2").mkdir()  # what a lost run left
    again = S.LineCountStore(spark, str(tmp_path))
    assert again.version == 1
    again.add(make(spark, ROWS[5:]))
    again.add(make(spark, ROWS[:3]))  # nothing new: nothing crosses
    assert S.LineCountStore(spark, str(tmp_path)).version == 3 and again.crossed().count() == 0
    key = ["source", "key", "key2"]
    want = {tuple(r) for r in S.frequent_lines(again.counts(), again.documents()).select(*key).collect()}
    assert {tuple(r) for r in again.lines().collect()} == want and want


def test_lines_fall_back_below_the_threshold(spark, tmp_path):
    line = "A line of boilerplate"
    base = [(f"r{i}", f"d{i}", "A", None, line if i < 3 else "Other words of its own %s" % ("x" * i)) for i in range(6)]
    more = [(f"s{i}", f"e{i}", "A", None, "Yet more words of its own") for i in range(1)] + [(f"t{i}", f"f{i}", "A", None, "words " * 3 + "y" * i) for i in range(20)]
    store = S.LineCountStore(spark, str(tmp_path))
    assert [r["frequent"] for r in store.add(make(spark, base)).collect()] == [True]
    assert [r["frequent"] for r in store.add(make(spark, more)).collect()] == [False] or store.lines().count() == 0
