import random

from palimpsest.llm import scans as S

REC = "record_id string, document_id string, element_type string, source_region string, text string, document_title string, series_name string, series_number string, noise string, word string"
PAGE = "source_file string, pdf_page int, printed_page string, lines array<string>, n long"
DOC = "source_file string, title string, series_name string, series_number string"
BASE = "the independent review of the storage canister is reported to the licence holder before the start of the campaign, and the site-specific inspection plan is kept on file. " * 3


def rec(i, text, region="Body", kind="paragraph"):
    return (f"r{i}", "D-1", kind, region, text, "Use of the hot cell in remote areas", "Board Series", "D-1", "clash", "clash")


def tables(spark, recs, pages=(), docs=(("f.pdf", "Use of the hot cell in remote areas", "Board Series", "D-1"),)):
    return spark.createDataFrame([(*p, 1) for p in pages], PAGE), spark.createDataFrame(list(recs), REC), spark.createDataFrame(list(docs), DOC)


def test_trie_is_complete():
    random.seed(3)
    words = {w: 10 for w in "review canister plan inspection site holder before start report file modern modem".split()}
    trie = S.Trie(words)

    def reach(word, limit):
        """Every misreading of a word within the limit: each letter is read right or, at a cost, wrong."""
        if not word:
            return {"": 0}
        out = {word[0] + x: c for x, c in reach(word[1:], limit).items()}
        for right, wrong in S.MISREADINGS if limit else ():
            if word.startswith(right):
                for x, c in reach(word[len(right) :], limit - 1).items():
                    out[wrong + x] = min(c + 1, out.get(wrong + x, 99))
        return out

    for w in words:
        for bad, cost in reach(w, 2).items():
            got = trie.misreadings(bad)
            assert got.get(w, 99) <= cost, (w, bad, cost, got)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_levenshtein_automaton_equals_brute_force():
    random.seed(5)
    words = {"".join(random.choices("abc", k=random.randint(1, 7))): 10 for _ in range(300)}
    trie = S.Trie(words)
    for _ in range(150):
        w = "".join(random.choices("abcd", k=random.randint(0, 8)))
        for k in (1, 2):
            assert trie.within(w, k) == {x: distance(w, x) for x in words if distance(w, x) <= k}


def test_shards_change_nothing(spark, monkeypatch):
    words = [(w, 40) for w in "review canister plan inspection site holder before start report file modern modem".split()]
    asked = spark.createDataFrame([("inspcction", 1), ("canistor", 1), ("revview", 1), ("nothing", 1)], "word string, n long")
    vocabulary = spark.createDataFrame(words, "word string, n long")
    one = {tuple(r) for r in S.candidates(asked, vocabulary).collect()}
    monkeypatch.setattr(S, "SHARD_WORDS", 3)
    monkeypatch.setattr(S, "QUERY_WORDS", 1)
    assert {tuple(r) for r in S.candidates(asked, vocabulary).collect()} == one
    assert {(r[0], r[1]) for r in one} == {("inspcction", "inspection"), ("canistor", "canister"), ("revview", "review")}


def test_words_that_are_not_sent_are_asked_for(spark, monkeypatch):
    recs = [rec(i, BASE) for i in range(12)] + [rec(20, BASE + "The storage canis-\nter is reported."), rec(21, BASE + "The inspcction plan is kept."), rec(24, BASE + "The site-\nspecific plan, short- and long-term.")]
    whole = {tuple(r) for r in S.found(*tables(spark, recs)).collect()}
    monkeypatch.setattr(S, "SENT_WORDS", 4)
    assert {tuple(r) for r in S.found(*tables(spark, recs)).collect()} == whole == {("records", "r20", "hyphen"), ("records", "r21", "ocr")}


def test_misreadings_outside_the_list(spark):
    """With the production parameters; beside the right neighbours only."""
    recs = [rec(i, BASE) for i in range(12)]
    recs += [rec(20, BASE + "The site-specific inspoction plan is kept."), rec(21, BASE + "The storage camister is reported."), rec(22, BASE + "The site-specific insprctivn plan is kept."), rec(23, BASE + "The licence hqlder is reported.")]
    recs += [rec(30, BASE + "The planned filer of the plan is kept."), rec(31, BASE + "The storage canisters is reported.")]  # other words, beside others; one more letter, beside the same
    got = {tuple(r) for r in S.found(*tables(spark, recs)).collect()}
    assert {("records", f"r{i}", "ocr") for i in (20, 21, 22)} <= got and not {("records", "r30", "ocr"), ("records", "r31", "ocr")} & got
    fixed = {r["row_key"]: r["text"] for r in S.repaired(*tables(spark, recs)).collect()}
    assert fixed["r20"].endswith("The site-specific inspection plan is kept.") and fixed["r22"].endswith("The site-specific inspection plan is kept.")


def test_letters_beyond_ascii(spark):
    recs = [rec(i, BASE + "The sûreté of the site is kept on file.") for i in range(12)] + [rec(20, BASE + "The sûrcté of the site is kept on file."), rec(21, BASE + "The surete of the site is kept on file.")]
    assert {tuple(r) for r in S.found(*tables(spark, recs)).collect()} == {("records", "r20", "ocr")}


def test_context_picks_the_candidate(spark):
    base = "the horse rider of the site and the house keeper of the site are kept. " * 3
    recs = [rec(i, base) for i in range(12)] + [rec(20, base + "and the hoxse rider of the site."), rec(21, base + "and the hoxse keeper of the site.")]
    fixed = {r["row_key"]: r["text"][-35:] for r in S.repaired(*tables(spark, recs)).collect()}
    assert "the horse rider" in fixed["r20"] and "the house keeper" in fixed["r21"]


def test_found_kinds(spark):
    recs = [rec(i, BASE) for i in range(12)] + [
        rec(20, BASE + "The storage canis-\nter is reported."), rec(21, BASE + "The inspcction plan is kept."), rec(22, "The review of the D-1 Use of the hot cell in remote areas 7 storage canister is reported to the holder of the licence."),
        rec(23, "The review of the\n14\nstorage canister is reported to the licence holder."), rec(24, BASE + "The site-\nspecific plan, short- and long-term."), rec(25, "© Board\nUse of the hot cell in remote areas\nshare this", "FrontMatter", "text_block"),
        rec(26, "A11\n97\n→\n15 mm"), rec(27, None), rec(28, ""), rec(29, "3. USE OF THE HOT CELL IN REMOTE AREAS", kind="heading"),
    ]
    body = ["the independent review of the storage canister is reported to", "the licence holder before the start of the cam-"]
    pages = [
        ("f.pdf", 2, "2", ["D-1", *body, "Page 2"]), ("f.pdf", 3, None, ["USE OF THE HOT CELL IN REMOTE AREAS", "paign, and the inspection plan is kept on file.", "97"]),
        ("g.pdf", 1, None, ["the plan", "4"]), ("g.pdf", 2, None, []), ("g.pdf", 3, None, None), ("f.pdf", 2, "2", ["D-1", *body, "Page 2"]),
    ]
    got = {tuple(r) for r in S.found(*tables(spark, recs, pages)).collect()}
    assert got == {
        ("records", "r20", "hyphen"), ("records", "r21", "ocr"), ("records", "r22", "header"), ("records", "r23", "page_number"),
        ("page_texts", "f.pdf#2", "header"), ("page_texts", "f.pdf#2", "page_number"), ("page_texts", "f.pdf#2", "hyphen"), ("page_texts", "f.pdf#3", "header"),
    }


def test_repair(spark):
    recs = [rec(i, BASE) for i in range(12)] + [rec(20, BASE + "The storage canis-\nter of the\n14\nInspcction plan is kept.")]
    p, r, d = tables(spark, recs)
    got = S.repaired(p, r, d).collect()
    assert len(got) == 1 and got[0]["text"].endswith("The storage canister of the Inspection plan is kept.") and got[0]["noises"] == ["hyphen", "ocr", "page_number"]


def test_empty_tables(spark):
    assert S.found(*tables(spark, [], docs=[])).count() == 0
    assert S.repaired(*tables(spark, [], docs=[])).count() == 0


def test_long_text(spark):
    recs = [rec(1, BASE * 400 + "The inspcction plan is kept on file."), *[rec(i, BASE) for i in range(2, 9)]]
    assert [tuple(r) for r in S.found(*tables(spark, recs)).collect()] == [("records", "r1", "ocr")]


def test_reflow():
    assert S.reflow(["1.1. One line that", "goes on here.", "1.2. Two."]) == "1.1. One line that goes on here.\n1.2. Two."
