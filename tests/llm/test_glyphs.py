import itertools
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm import glyphs as G

SCHEMA = "record_id string, document_id string, element_type string, element_id string, text string, odd boolean, field string, a string"


def make(spark, rows):
    return spark.createDataFrame([(*r, True, "clash", "clash") for r in rows], SCHEMA)


def test_readings():
    same = [("Ｓｔörfall", "Störfall"), ("Störfall", "Störfall"), ("ﬁeld oﬃce", "field office"), ("the\xa0casк".replace("к", "k"), "the cask"), ("rеvіеw", "review"), ("co\xadn​trol", "control"), ("site‑specific", "site-specific"), ("2﻿.7", "2.7"), ("Ⅰn", "In"), ("e​́", "é"), ("10 Ω", "10 Ω"), ("２０１１", "2011")]
    for a, b in same:
        assert G.reading(a) == G.reading(b), (a, b, G.reading(a), G.reading(b))
    for a, b in [("m³", "m3"), ("café", "cafe"), ("OF", "of"), ("note", "not e"), ("–", "-"), ("rn", "m")]:
        assert G.reading(a) != G.reading(b)


def test_consistent_keeps_foreign_words():
    assert G.consistent("“Оценка дозовой нагрузки” rеvіеw\nα ± β") == "“Оценка дозовой нагрузки” review\nα ± β"
    assert G.consistent("a\n\nb") == "a\n\nb" and G.consistent("") == "" and G.consistent(None) is None


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_idempotent_and_total(s):
    r = G.reading(s)
    assert G.reading(r) == r
    c = G.consistent(s)
    assert G.consistent(c) == c and G.reading(c) == r


def test_table_has_no_conflicts():
    t = G.compiled()[0]
    assert all("".join(t.get(c, c) for c in b) == b for b in t.values())
    assert all(len(a) == 1 and unicodedata.normalize("NFC", a) is not None for a in t)


ROWS = [
    ("r1", "d1", "paragraph", "2.7", "The review of the cask"), ("r2", "d1", "paragraph", "２.7", "Thе review of the cask"), ("r3", "d1", "paragraph", "2.7​", "The\xa0review of the cask"), ("r4", "d1", "table", "2.7﻿", "THE REVIEW OF THE CASK"),
    ("r5", "d2", "paragraph", "2.7", "The review of the cask"), ("r6", "d1", "paragraph", "2.7", "The review of the cask"), ("r7", "d1", None, None, None), ("r8", None, "paragraph", "１", "１"), ("r9", "d1", "paragraph", "", ""), ("r10", "d1", "paragraph", "I–1", "m³"), ("r11", "d1", "paragraph", "І–1", "m3"),
]


def brute(rows):
    out = set()
    for a, b in itertools.permutations(rows, 2):
        if a[0] < b[0] and a[1] == b[1] and a[1] is not None:
            if a[4] is not None and b[4] is not None and a[4] != b[4] and G.reading(a[4]) == G.reading(b[4]):
                out.add(("text", a[0], b[0]))
            if a[3] is not None and b[3] is not None and a[2] == b[2] and a[2] is not None and a[3] != b[3] and G.reading(a[3]) == G.reading(b[3]):
                out.add(("element_id", a[0], b[0]))
    return out


def test_pairs(spark):
    df = make(spark, ROWS)
    want = brute(ROWS)
    assert ("text", "r1", "r2") in want and ("element_id", "r10", "r11") in want
    assert {tuple(r) for r in G.look_alike_pairs(df.unionByName(df)).collect()} == want
    assert G.look_alike_pairs(make(spark, [])).count() == 0


def test_hot_document_and_long_text(spark):
    rows = [(f"r{i:04d}", "d", "paragraph", str(i), "same text") for i in range(2000)] + [("x", "d", "paragraph", "x", "ѕame text"), ("y", "d", "paragraph", "y", "long " * 50000 + "ѕ"), ("z", "d", "paragraph", "z", "long " * 50000 + "s")]
    assert G.look_alike_pairs(make(spark, rows)).count() == 2001


def test_normalize(spark):
    got = {r["record_id"]: r for r in G.normalize_records(make(spark, ROWS)).collect()}
    assert got["r2"]["text"] == ROWS[0][4] and got["r2"]["element_id"] == "2.7" and "r1" not in got and "r10" not in got


def test_letters_of_other_alphabets():
    assert G.reading("𝐀𝑏𝟏 ꓐꓳꓫ Ꭺɡɑօ") == "Ab1 BOX Agao"
    assert G.reading("α ι κ ρ") == "α ι κ ρ"  # these differ in print


def test_classes_hold_the_pairs(spark):
    columns = "record_id string, document_id string, element_type string, element_id string, text string"
    rows = [(f"r{i}", "d", "paragraph", None, t) for i, t in enumerate(["valve A", "valve A", "vаlve A", "valve\u00a0A", "valve B", None, ""])] + [("s1", "e", "paragraph", None, "vаlve A")]
    df = spark.createDataFrame(rows, columns)
    got = {r["record_id"]: (r["n_forms"], r["n_records"], r["n_links"]) for r in G.look_alike_classes(df.unionByName(df)).collect()}
    pairs = [tuple(r)[1:] for r in G.look_alike_pairs(df).collect()]
    assert got == {"r0": (3, 4, 2), "r1": (3, 4, 2), "r2": (3, 4, 3), "r3": (3, 4, 3)}
    assert {r: sum(r in p for p in pairs) for r in got} == {r: n for r, (_, _, n) in got.items()}
