import pytest

from palimpsest.llm import encoding as E

CLEAN = [
    "The Comité de sûreté de Beauvère – a body without powers – has met the Säteilyryhmä Hämälä.",
    "The notice “Граница площадки” was posted by the Dílna Říčany-Větrov at ± 2 °C and 40 m³.",
    "The sign “NÃO ABRIR” at the Laboratório Âmbar of the Órgano Técnico de Peñalara del Río.",
    "The Górnośląska Pracownia Źródło and the Agência São Virelo costs £3; a fee of €40 (Veritrâme™).",
    "[1] BUREAU D’ÉTUDES CHÂTEAU-LIÈVRE, LABORATÓRIO ÂMBAR, DÍLNA ŘÍČANY-VĚTROV, Château-Âpre of the Ângelo works.",
]


def rows(spark, texts, table="records"):
    key = "record_id" if table == "records" else "stable_internal_id"
    return spark.createDataFrame([(f"k{i}", t, "x", 1) for i, t in enumerate(texts)], f"{key} string, text string, word string, n long")


def damage(t, written, read, start=0):
    out = []
    for b in t[start:].encode(written, "replace" if written != "utf-8" else "strict"):
        try:
            out.append(bytes([b]).decode(read))
        except UnicodeDecodeError:
            out.append(chr(b))
    return t[:start] + "".join(out)


PAIRS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("utf-8", "cp1251")]


def test_pairs_are_found_and_undone(spark):
    texts = CLEAN * 12
    expected, all_texts = {}, list(texts)
    for written, read in PAIRS:
        for t in CLEAN:
            for start in (0, len(t) // 2):
                bad = damage(t, written, read, start)
                if bad != t:
                    expected[f"k{len(all_texts)}"] = t
                    all_texts.append(bad)
    got = {r["row_key"]: r for r in E.restored(rows(spark, all_texts), rows(spark, [], "knowledge")).collect()}
    assert set(got) == set(expected)
    right = sum(got[k]["text"] == t for k, t in expected.items())
    assert right >= 0.9 * len(expected), [(got[k]["text"], t) for k, t in expected.items() if got[k]["text"] != t][:5]


def test_twice_and_single_byte(spark):
    twice = damage(damage(CLEAN[0], "utf-8", "cp1252"), "utf-8", "cp1252")
    c1 = CLEAN[0].replace("–", "\x96")
    lost = CLEAN[0].replace("é", "�")
    asked = CLEAN[3].replace("ś", "?").replace("ą", "?").replace("ó", "?")
    all_texts = CLEAN * 12 + [twice, c1, lost, asked]
    got = {r["row_key"]: r for r in E.restored(rows(spark, all_texts), rows(spark, [], "knowledge")).collect()}
    assert set(got) == {"k60", "k61", "k62", "k63"}
    assert got["k60"]["text"] == CLEAN[0] and got["k61"]["text"] == CLEAN[0]
    assert not got["k62"]["whole"]


def test_look_alikes_and_junk_are_clean(spark):
    texts = CLEAN * 6 + ["Тhe rеvіеw оf thе саsk", "■ □  ◊ ~ ;; l1 ? █", "Ñаnduberа and Τhе", "What? Yes."]
    assert E.found(rows(spark, texts), rows(spark, texts, "knowledge")).count() == 0


def test_nulls_empty_and_repeats(spark):
    bad = damage(CLEAN[0], "utf-8", "cp1252")
    df = rows(spark, CLEAN * 3 + [None, "", bad]).unionByName(rows(spark, CLEAN * 3 + [None, "", bad]))
    assert E.found(df, rows(spark, [], "knowledge")).collect() == [("records", "k17")]
    assert E.found(rows(spark, []), rows(spark, [], "knowledge")).count() == 0
    long = "plain text " * 20000 + bad
    assert E.found(rows(spark, [*CLEAN * 3, long]), rows(spark, [], "knowledge")).count() == 1


@pytest.mark.parametrize("written,read", PAIRS)
def test_suspects_cover_every_pair(written, read):
    for c in "é–’ЖΩ³":
        assert E.SUSPECT.search(damage(c, written, read))
