import random

from palimpsest.llm import leakage as L

DOC = "doc_id long, text string, source string, item_id long, coverage double"
ITEM = "item_id long, text string, subset string"


def brute(docs, items):
    out = set()
    for i, t in items:
        w = L.words(t)
        grams = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        for d, x in docs:
            v = L.words(x)
            if grams & {tuple(v[k : k + 12]) for k in range(len(v) - 11)}:
                out.add((i, d))
    return out


def make(spark, docs, items):
    return spark.createDataFrame([(d, t, "s", 1, 0.5) for d, t in docs], DOC), spark.createDataFrame([(i, t, "q") for i, t in items], ITEM)


def test_brute_force(spark):
    random.seed(7)
    vocab = [f"w{i}" for i in range(60)] + ["m³", "Énergie", "don’t", "a_b"]
    items = [(i, " ".join(random.choices(vocab, k=random.randint(5, 60)))) for i in range(20)]
    docs = []
    for d in range(120):
        t = random.choices(vocab, k=random.randint(0, 80))
        if d % 2:
            w = random.choice(items)[1].split()
            a = random.randrange(max(1, len(w) - 8))
            t[len(t) // 2 : len(t) // 2] = [x.upper() + random.choice(["", ",", "\n"]) for x in w[a : a + random.randint(8, 16)]]
        docs.append((d, " ".join(t)))
    want = brute(docs, items)
    assert want
    dd, ii = make(spark, docs + docs[:9] + [(500, None), (501, ""), (None, items[0][1])], items + [(90, None), (91, "")])
    assert {tuple(r) for r in L.found(dd, ii).collect()} == want


def test_tiles_cover_reordered_passages():
    import numpy as np

    item = np.arange(40)
    doc = np.concatenate([np.arange(20, 40), [-1, -1], np.arange(0, 20), np.arange(5, 18)])
    ix = L.ItemIndex([(1, " ".join(f"w{i}" for i in range(40)))])
    seeds = ix.seeds(doc)[1]
    t = L.tiles(item, doc, seeds, 12)
    assert sorted(t) == [(0, 22, 20), (20, 0, 20)]


def test_coverage_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(24))
    dd, ii = make(spark, [(1, text), (2, " ".join(text.split()[:12]))], [(7, text)])
    got = {r["doc_id"]: r["coverage"] for r in L.leaked(dd, ii).collect()}
    assert got == {1: 1.0, 2: 0.5}
    assert L.leak_report(dd, ii, min_coverage=0.6).first()["n_docs"] == 2
    dd, ii = make(spark, [], [])
    assert L.found(dd, ii).count() == 0 and L.leak_report(dd, ii).count() == 0
    dd, ii = make(spark, [(1, "filler " * 200000 + text)], [(7, text), (7, text)])
    assert L.found(dd, ii).count() == 1


def test_windows_equal_direct_hashes():
    import numpy as np

    ids = np.random.default_rng(3).integers(-1, 40, 3000)
    for n in (1, 8, 12, 2999, 3000, 3001):
        h = L.window_hashes(ids, n)
        same = {}
        for i in range(len(h)):
            same.setdefault(tuple(ids[i : i + n]) if n < 100 else i, set()).add(int(h[i]))
        assert len(h) == max(0, 3001 - n) and all(len(x) == 1 for x in same.values()) and len(set(h.tolist())) == len(same)


def test_reordered_passages_count_by_coverage(spark):
    words = [f"w{i}" for i in range(40)]
    mixed = [w for a in (30, 20, 10, 0) for w in words[a : a + 10]]
    few = words[:10] + ["x"] * 30
    dd, ii = make(spark, [(1, " ".join(mixed)), (2, " ".join(few))], [(7, " ".join(words))])
    assert L.found(dd, ii).count() == 0
    r = L.leak_report(dd, ii).collect()
    assert [(x["item_id"], x["n_docs"], x["n_by_coverage"], x["coverage"]) for x in r] == [(7, 1, 1, 1.0)]
    assert L.leak_report(dd, ii, min_coverage=0.2).first()["n_docs"] == 2


def test_too_large_items_are_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(L, "MAX_ITEM_CHARS", 10)
    with pytest.raises(ValueError):
        L.leaked(*make(spark, [(1, "a")], [(1, "some words of an item")]))
