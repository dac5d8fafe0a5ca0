from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import packing as K

SCHEMA = "doc_id long, text string, size long, bucket int, piece int"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), max_size=25))
def test_plan_is_exact_and_tight(histogram):
    plan = K.plan(histogram, 60)
    back, n = {}, 0
    for pattern, m in plan:
        assert sum(pattern) <= 60 and m > 0
        n += m
        for s in pattern:
            back[s] = back.get(s, 0) + m
    assert back == histogram
    rooms = []  # first fit decreasing, item by item
    for s in sorted((s for s, k in histogram.items() for _ in range(k)), reverse=True):
        i = next((i for i, r in enumerate(rooms) if r >= s), None)
        if i is None:
            rooms.append(60 - s)
        else:
            rooms[i] -= s
    assert n <= 1.05 * len(rooms) + 1
    slots = K.slot_table(plan)
    for s, k in histogram.items():
        spans = sorted((a, b) for z, a, b, _, _ in slots if z == s)
        assert spans[0][0] == 0 and spans[-1][1] == k and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_pack_whole(spark):
    rows = [(i, ("word " * (i % 700)).strip() or "", 1, 1, 1) for i in range(400)] + [(1000, "oversized text " * 3000, 1, 1, 1), (1001, None, 1, 1, 1), (None, "x", 1, 1, 1)]
    df = spark.createDataFrame(rows + rows[:5], SCHEMA)
    got = K.pack(df).collect()
    counts = {r["doc_id"]: r["n_tokens"] for r in K.token_counts(df).collect()}
    sums, per = {}, {}
    for r in got:
        per[r["doc_id"]] = per.get(r["doc_id"], 0) + r["n_tokens"]
        if r["container_id"] >= 0:
            sums[r["container_id"]] = sums.get(r["container_id"], 0) + r["n_tokens"]
        if counts[r["doc_id"]] <= K.CAPACITY:
            assert r["piece"] == 0
    assert per == counts and max(sums.values()) <= K.CAPACITY and len({(r["doc_id"], r["piece"]) for r in got}) == len(got)
    assert len(sums) <= 1.03 * sum(sums.values()) / K.CAPACITY + 1
    s = K.packing_summary(K.pack(df)).first()
    assert s["n_containers"] == len(sums) and s["n_tokens"] == sum(sums.values())


def test_hot_size_and_empty(spark):
    df = spark.createDataFrame([(i, "one two three", 1, 1, 1) for i in range(3000)], SCHEMA)
    got = K.pack(df, capacity=10).collect()
    assert len(got) == 3000 and len({r["container_id"] for r in got}) == 1000
    assert K.pack(spark.createDataFrame([], SCHEMA)).count() == 0
