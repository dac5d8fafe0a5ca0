import random

from pyspark.sql import functions as F

from palimpsest.operators import sequence as Q


def test_buckets_give_what_plain_windows_give(spark):
    random.seed(2)
    rows = [(g, random.choice([None, *range(90)]), f"t{i:03d}", random.choice([None, "a", "b"])) for i in range(300) for g in [random.choice(["x", "x", "x", "y", None])]]
    df = spark.createDataFrame(rows, "g string, o long, t string, v string")
    by = {}
    for r in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    number, nxt, last = {}, {}, {}
    for g, rs in by.items():
        seen = None
        for i, r in enumerate(rs):
            number[r[2]] = i + 1
            nxt[r[2]] = rs[i + 1][2] if i + 1 < len(rs) else None
            seen = r[3] if r[3] is not None else seen
            last[r[2]] = seen
    for size in (1, 7, 1000):
        assert {r["t"]: r["n"] for r in Q.numbered(df, ["g"], "o", "t", "n", size).collect()} == number
        assert {r["t"]: r["_n_t"] for r in Q.following(df, ["g"], "o", "t", ["t", "v"], size=size).collect()} == nxt
        assert {r["t"]: r["l"] for r in Q.carried(df, ["g"], "o", "t", F.col("v"), "l", size).collect()} == last
    assert Q.numbered(df.limit(0), ["g"], "o", "t", "n").count() == 0
