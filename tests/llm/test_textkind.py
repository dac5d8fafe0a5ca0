import random

from palimpsest.llm import textkind as K

PROSE = "Where the {a} has been reviewed, the {b} should verify the {a} before the start of the {b}."
NOUNS = "storage canister,glove box,exposure scenario,relief line,access barrier,peer review,inspection plan,hot cell,event report,supply contract".split(",")
SCHEMA = "stable_internal_id string, record_type string, text string, pattern string, p_prose double"


def corpus(n=60):
    random.seed(5)
    pick = lambda: random.choice(NOUNS)
    num = lambda: random.choice(["n.a.", "12.5", "307", "< 0.01", "81.20", "yes"])
    made = []
    for i in range(n):
        made += [
            ("prose", " ".join(PROSE.format(a=pick(), b=pick()) for _ in range(1 + i % 3))),
            ("prose", "Values of 4.8 kg, 12 kPa and 33 m were\nrecorded for the storage canister in 1995, 2006\nand 2018, against 6.4 % of the inventory."),
            ("list", "\n".join(f"{'•' if i % 2 else '*'} passive {pick()}" for _ in range(4 + i % 3))),
            ("list", "; ".join(f"Annual {pick()}" for _ in range(5))),
            ("table", "Level | Siren | Tray\n" + "\n".join(f"Seismic {pick()} | {num()} | {num()}" for _ in range(5))),
            ("table", "Level   Siren\n" + "\n".join(f"Passive {pick()}   {num()}   {num()}" for _ in range(4))),
            ("junk", "".join(random.choice("abcXYZ0189+/") for _ in range(180)) + "="),
            ("junk", "\n".join(f"Local {pick()} . . . . . . . .  {random.randint(1, 200)}" for _ in range(4))),
            ("junk", " ".join(random.choice("■ □ ◊ ~ ;; l1 ▪ █".split()) for _ in range(40))),
            ("junk", " ".join(" ".join(w.upper()) for w in pick().split() for _ in range(3))),
        ]
    return made


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0.5) for r in rows], SCHEMA)


def test_kinds(spark):
    made = corpus()
    df = make(spark, [(f"k{i}", "paragraph", t) for i, (_, t) in enumerate(made)])
    got = {r["stable_internal_id"]: r["text_kind"] for r in K.found(df.unionByName(df)).collect()}
    want = {f"k{i}": k for i, (k, _) in enumerate(made) if k != "prose"}
    wrong = [(k, want.get(k), got.get(k)) for k in want.keys() | got.keys() if want.get(k) != got.get(k)]
    assert len(wrong) <= 0.02 * len(made), wrong[:10]


def test_edges(spark):
    assert K.found(make(spark, [])).count() == 0
    rows = [("a", "paragraph", None), ("b", "paragraph", ""), (None, "paragraph", "x"), ("c", "heading", "■ ■"), ("d", "paragraph", " ".join(PROSE.format(a=a, b=b) for a in NOUNS for b in NOUNS) * 30)]
    rows += [(f"p{i}", "paragraph", PROSE.format(a="hot cell", b="relief line")) for i in range(30)]
    got = {r["stable_internal_id"]: r["text_kind"] for r in K.found(make(spark, rows)).collect()}
    assert got == {"b": "junk"}


def test_statistics(spark):
    r = K.statistics(make(spark, [("a", "paragraph", "The cat is here.\nTwo cats sat")])).first()
    assert (r["s_words"], r["s_lines"], r["s_line_end"], r["s_common"]) == (7.0, 2.0, 0.5, 2 / 7)
    assert abs(r["s_word_length"] - sum(map(len, "The cat is here Two cats sat".split())) / 7) < 1e-9


def test_numbered_entries_are_no_figures(spark):
    text = "\n".join(f"{i}. Passive {n}" for i, n in enumerate(NOUNS[:6], 1))
    r = K.statistics(make(spark, [("a", "paragraph", text)])).first()
    assert (r["s_figures"], r["s_figure_cells"], r["s_bulleted"]) == (0.0, 0.0, 1.0)


def test_accuracies_are_learned(spark):
    """A function that votes at random is outvoted, though nothing but agreement tells."""
    random.seed(2)
    lfs = K.labelling_functions()
    names = [k for _, k, _ in lfs]
    first_list = names.index("list")
    counts = {}
    for _ in range(4000):
        kind = random.choices(K.KINDS, (6, 1, 1, 1))[0]
        v = "".join("1" if (random.random() < 0.5 if j == first_list else random.random() < (0.8 if k == kind else 0.01)) else "0" for j, k in enumerate(names))
        counts.setdefault(v, []).append(kind)
    post = K.learn([(v, len(k)) for v, k in sorted(counts.items())])
    right = sum(K.KINDS[int(post[v].argmax())] == kind for v, ks in counts.items() for kind in ks)
    by_votes = sum(K.KINDS[max(range(4), key=lambda i: sum(c == "1" and k == K.KINDS[i] for c, k in zip(v, names)))] == kind for v, ks in counts.items() for kind in ks)
    assert right > 0.97 * 4000 and right > by_votes
