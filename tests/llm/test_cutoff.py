import random

from palimpsest.llm import cutoff as C

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cut boolean, log_odds double"
NOUNS = "storage canister,glove box,exposure scenario,relief line,access barrier,peer review,inspection plan,hot cell,event report,supply contract".split(",")
VERBS = "verify,review,inspect,record,compare,withdraw,describe".split(",")


def sentence():
    p = random.choice
    return p([f"Where the {p(NOUNS)} has been reviewed, the {p(NOUNS)} should {p(VERBS)} the {p(NOUNS)}.", f"The {p(NOUNS)} and the {p(NOUNS)} are compared before the start of the {p(NOUNS)}.", f"If the {p(NOUNS)} exceeds 12 kg, the holder may {p(VERBS)} the {p(NOUNS)}."])


def texts(n):
    random.seed(11)
    whole, cut = [], []
    for i in range(n):
        body = "\n".join(" ".join(sentence() for _ in range(3)) for _ in range(3))
        ends = [body, body + "\n" + "\n".join(f"• {random.choice(NOUNS)}" for _ in range(4)), body + "\nRecords office, Vellmar", body + "\nKeywords: " + ", ".join(random.sample(NOUNS, 3)), body + f"\nAnnex V: use of the {random.choice(NOUNS)}", f"Title of the {random.choice(NOUNS)}\n" + body]
        whole.append(ends[i % len(ends)])
        at = random.randint(len(body) // 2, len(body) - 3)
        piece = body[:at].rstrip()
        if C.closed(piece) or piece.endswith("\n"):
            piece = piece[:-4]
        cut.append(piece + ["", "", "…", "...", " [...]", "�"][i % 6])
    return whole, cut


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", f"s{d % 3}" if d is not None else None, len(t or ""), False, 0.0) for d, t in rows], SCHEMA)


def test_held_out_accuracy(spark):
    whole, cut = texts(400)
    rows = list(enumerate(whole)) + [(1000 + i, t) for i, t in enumerate(cut[:60])]
    df = make(spark, rows)
    got = {r["doc_id"] for r in C.found(df.unionByName(df.limit(20))).collect()}
    hit, wrong = sum(d >= 1000 for d in got), sum(d < 1000 for d in got)
    assert hit >= 57 and wrong <= 3, (hit, wrong, [dict(rows)[d][-60:] for d in got if d < 1000][:5])
    by = {r["source"]: r for r in C.truncation_by_source(df).collect()}
    assert sum(r["n_cut"] for r in by.values()) == len(got) and sum(r["n_texts"] for r in by.values()) == len(rows)


def test_edges(spark):
    assert C.found(make(spark, [])).count() == 0
    df = make(spark, [(1, None), (2, ""), (3, "  \n "), (None, "cut off in the mid"), (4, "Complete sentence.")])
    assert C.found(df).count() == 0
    assert C.truncation_by_source(df).count() == 3  # the source of a row without doc_id is left out


def test_language():
    assert [C.language(x) for x in (None, "EN", "ger", "fr-FR", "und", " es ")] == ["und", "en", "de", "fr", "und", "es"]


def grams(lines):
    """Brute force: every window of a line read backwards."""
    from collections import Counter

    n = Counter()
    for text, marks in lines:
        x = [*C.classes(text).tolist(), *marks]
        for i in range(len(x) - C.ORDER + 1):
            n[sum(c << C.BITS * j for j, c in enumerate(x[i : i + C.ORDER]))] += 1
    return n


def test_counts_equal_brute_force_in_any_blocks(spark, monkeypatch):
    whole, cut = texts(12)
    df = make(spark, list(enumerate(whole + cut)))
    lines = [C.pieces(t)[:2] for t in whole + cut]
    want = {(C.GOES_ON, g): n for g, n in grams((x[:-1], []) for a, _ in lines for x in a).items()} | {(C.ENDS, g): n for g, n in grams((x, [C.AFTER_END] * (C.ORDER - 1)) for _, b in lines for x in b).items()}
    for block in (C.BLOCK_CHARS, 300):
        monkeypatch.setattr(C, "BLOCK_CHARS", block)
        got = C.read_texts(df.selectExpr("doc_id", "lang", "text", "0L AS text_key"), 0).where("gram is not null").groupBy("kind", "gram").agg({"n": "sum"})
        assert {(r["kind"], r["gram"]): r["sum(n)"] for r in got.collect()} == want


def test_probabilities_sum_to_one():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(4, 9, 400)
    keys, n = np.unique(C._grams(x), return_counts=True)
    m = C.Backward(keys, n)
    following = int(keys[7]) >> C.BITS << C.BITS
    p = np.exp(m.log_p(np.array([following | c for c in range(1 << C.BITS)]), np.zeros(1 << C.BITS, int), np.zeros(1 << C.BITS)))
    assert abs(p[4:9].sum() - 1) < 0.02 and (p > 0).all()


def test_ngrams_decide(spark, monkeypatch):
    """Without counts every open end scores 0."""
    import numpy as np

    whole, cut = texts(200)
    df = make(spark, list(enumerate(whole)) + [(1000 + i, t) for i, t in enumerate(cut[:30])])
    assert C.found(df).count() >= 27
    nothing = (np.zeros(0, np.int64), np.zeros(0))
    monkeypatch.setattr(C, "_kept", lambda grams: {k: nothing for k in (C.GOES_ON, C.ENDS, C.VALUE)})
    assert {round(r["log_odds"], 9) for r in C.scored(df).collect()} == {0.0}


def test_whole():
    assert [C.whole(x) for x in ("a b", "a b …", "a b [...] ", "a (…)", "a ��", "", " ", "x]", "…")] == [("a b", False), ("a b", True), ("a b", True), ("a", True), ("a", True), ("", False), ("", False), ("x]", False), ("", True)]


def test_last_lines_that_stand_nowhere_else(spark):
    """A closing line of its own kind is no cut, though its words run on elsewhere."""
    whole, cut = texts(300)
    rows = [(i, t.split("\n")[0] + " The end of the peer review is near.\nEnd of the peer review") for i, t in enumerate(whole[:120])] + [(500 + i, t) for i, t in enumerate(whole)] + [(1000 + i, t) for i, t in enumerate(cut[:60])]
    got = {r["doc_id"] for r in C.found(make(spark, rows)).collect()}
    assert sum(d >= 1000 for d in got) >= 57 and not [d for d in got if d < 500]


def test_threshold():
    import numpy as np

    assert C.best_threshold(np.array([5.0, 6.0, 9.0] * 50), np.array([-8.0, 2.0, 2.5] * 50)) == 2.5
    assert C.best_threshold(np.array([5.0, 6.0, 9.0] * 50), np.array([-8.0, -7.0] * 50)) == 0.0


def test_thresholds_use_all_lines_of_all_texts(spark, monkeypatch):
    """Every running line and every open line within a text counts, those of a text that is met again once."""
    whole, cut = texts(60)
    lines = [C.pieces(t)[:2] for t in whole + cut]
    seen, best = [], C.best_threshold
    monkeypatch.setattr(C, "best_threshold", lambda *x: seen.append([sum(n) for n in x[2:]] or [len(s) for s in x]) or best(*x))
    rows = list(enumerate(whole + cut))
    for df in (make(spark, rows), make(spark, rows + [(1000 + d, t) for d, t in rows[:20]] + rows[:10])):
        seen.clear()
        C.scored(df)
        assert seen[0] == [sum(len(a) for a, _ in lines), sum(len(b) for _, b in lines)]


def test_repeats_equal_brute_force():
    import numpy as np

    g, line = C.line_grams([C.FIRST + x for x in ("list of annexes", "annexes annexes annexes", "Annex V: list", "aaaaaaaaaa", "list of annexes")], C.ENDS)
    met, at = np.unique(g, return_inverse=True)
    for k, got in enumerate(C._repeats(*C._first_highest(met), at, line)):
        key = list(zip(line.tolist(), (g & ((1 << C.BITS * k) - 1)).tolist()))
        assert got.tolist() == [key.count(x) for x in key]


def test_blocks_and_memory_change_no_score(monkeypatch):
    import numpy as np

    lines = [C.pieces(t)[:2] for t in texts(30)[0]]
    running, ending = [x for a, _ in lines for x in a], [x for _, b in lines for x in b]
    g = [np.unique(x, return_counts=True) for x in C._counted(running, ending)]
    counts = {C.GOES_ON: g[0], C.ENDS: g[1]}
    cut = [x[: 2 + i % (len(x) - 2)] for i, x in enumerate(running)]

    def odds():
        m = C.CutModel(counts, (np.zeros(0, np.int64), np.zeros(0)), False)
        return np.concatenate([m.log_odds(x, k, 1.0 + np.arange(len(x)) % 2) for k, x in ((C.GOES_ON, cut[:9]), (C.ENDS, ending), (C.GOES_ON, cut))])

    want = odds()
    for name, value in (("AT_ONCE", 1), ("AT_ONCE", 1 << 20), ("REMEMBERED", 1), ("SHORT", 1), ("SHORT", C.ORDER - 1)):
        with monkeypatch.context() as m:
            m.setattr(C, name, value)
            assert np.allclose(odds(), want, rtol=0, atol=1e-9), name
