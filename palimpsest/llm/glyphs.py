"""Visually identical text made of different characters (problem 4).

A table of characters and clusters is compiled once from rules and short
lists of look-alikes, checked for conflicts, and applied in one pass by a
longest-match transducer: clusters of a letter and its combining marks, runs
of spaces and single mapped characters.

Two forms come out. ``reading`` maps everything, so that equal readings mean
"looks the same". ``consistent`` is fit for storing: it maps look-alike
letters only in words that are not wholly of a foreign alphabet.

Defined results: null stays null, an empty text stays empty, text of any
length is mapped whole, and mapping a mapped text changes nothing.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.session import ship_package

# Letters that look like Latin letters, and the letters they look like.
CYRILLIC_LIKE = ("аеорсухіѕјԁһӏԛԝАВЕКМНОРСТУХІЅЈԌԚԜЗ", "aeopcyxisjdhlqwABEKMHOPCTYXISJGQW3")
GREEK_LIKE = ("οϲνυΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ", "ocvuABEZHIKMNOPTYXC")
LISU_LIKE = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
OTHER_LIKE = ("ɡɑօսᎪᎬᎳᎷᎻᏀᏃᏆᏞᏢᏦᏒᎢ", "gaouAEWMHGZTLPKRT")
# Signs that look like another sign.
SIGN_LIKE = {"‐": "-", "‑": "-", "ʼ": "’", ";": ";", "·": "·", "…": "...", "ı": "i", "ӓ": "ä", "Ӓ": "Ä", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï", "ӧ": "ö", "Ӧ": "Ö", "µ": "μ"}
#: Kinds of compatibility characters that print like their plain form (raised and lowered figures don't).
PLAIN_KINDS = ("<wide>", "<narrow>", "<noBreak>", "<compat>")


def _table() -> dict[str, str]:
    t: dict[str, str] = {}

    def put(a: str, b: str) -> None:
        if a != b and t.setdefault(a, b) != b:
            raise ValueError(f"two targets for {a!r}: {t[a]!r}, {b!r}")

    for source, target in (CYRILLIC_LIKE, GREEK_LIKE, LISU_LIKE, OTHER_LIKE):
        if len(source) != len(target):
            raise ValueError("lists of unequal length")
        for a, b in zip(source, target):
            put(a, b)
    for a, b in SIGN_LIKE.items():
        put(a, b)
    for code in (*range(0xA0, 0x250), *range(0x2000, 0x2200), *range(0x3000, 0x3040), *range(0xFB00, 0xFB50), *range(0xFF00, 0xFFEF)):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Cf",) or c == "͏":
            put(c, "")
        elif kind == "Zs":
            put(c, " ")
        elif c in t:
            continue
        elif (d := unicodedata.decomposition(c)).startswith(PLAIN_KINDS) and (0x2160 <= code < 0x2180 or code >= 0x3000 or 0x132 <= code <= 0x1F3):
            put(c, unicodedata.normalize("NFKC", c))
        elif d and not d.startswith("<") and len(unicodedata.normalize("NFC", c)) == 1:
            put(c, unicodedata.normalize("NFC", c))  # singletons: Ohm, Kelvin and Angstrom signs
    # the styled alphabets of mathematics are the plain letters to a reader
    for code in range(0x1D400, 0x1D800):
        if unicodedata.decomposition(chr(code)).startswith("<font>"):
            put(chr(code), unicodedata.normalize("NFKC", chr(code)))
    put("﻿", "")
    put("᠎", "")
    # a target must not itself be mapped
    for a in list(t):
        b = t[a]
        while (again := "".join(t.get(x, x) for x in b)) != b:
            b = again
        t[a] = b
    return t


@lru_cache(1)
def compiled() -> tuple[dict[str, str], re.Pattern]:
    t = _table()
    marks = "̀-ͯ"
    single = "".join(re.escape(x) for x in t if x <= "\uffff")  # a class with letters beyond is searched one by one
    gone = "".join(re.escape(a) for a, b in t.items() if b == "")
    # longest match first: a letter with its marks (invisible signs between are skipped), a run of white space, one mapped character
    return t, re.compile(f"[^\\s{marks}{gone}](?:[{gone}]*[{marks}])+|[\\s{''.join(re.escape(a) for a, b in t.items() if b == ' ')}](?:[\\s{''.join(re.escape(a) for a, b in t.items() if b == ' ')}]|[{gone}])*|[{single}{marks}]|[\U0001d400-\U0001d7ff]")


_BREAK = re.compile(r"[^\S\n]*\n\s*")


def _emit(t: dict[str, str]):
    cache: dict[str, str] = {}

    def one(m: re.Match) -> str:
        s = m.group()
        out = cache.get(s)
        if out is None:
            if s[0].isspace() or t.get(s[0]) == " ":
                out = " "
            else:
                base = "".join(t.get(x, x) for x in s)
                out = "".join(t.get(x, x) for x in unicodedata.normalize("NFC", base))
            if len(cache) < 20000:
                cache[s] = out
        return out

    return one


@lru_cache(1)
def _one():
    return _emit(compiled()[0])


def reading(text: str | None) -> str | None:
    """What the reader's eye sees: equal for texts that look the same."""
    if text is None:
        return None
    return compiled()[1].sub(_one(), text).strip()


_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ­​-‍⁠﻿]*[^\W\d_]+)*[̀-ͯ]*")
_FOREIGN = re.compile("[Ͱ-ϿЀ-ԯ]")


def consistent(text: str | None) -> str | None:
    """One form for storing; words of a foreign alphabet keep their letters.

    A word keeps its Cyrillic or Greek letters if it has such a letter that
    looks like no Latin one and no Latin letter at all. Line breaks are kept.
    """
    if text is None:
        return None
    t, pattern = compiled()
    one = _one()
    shield: dict[str, str] = {}

    def word(m: re.Match) -> str:
        s = m.group()
        if not _FOREIGN.search(s) or re.search("[A-Za-zÀ-ɏＡ-ｚ]", s) or all(x in t for x in s if _FOREIGN.match(x)):
            return s
        clean = unicodedata.normalize("NFC", "".join("" if t.get(x) == "" else x for x in s))
        key = chr(0xF0000 + len(shield))
        shield[key] = clean
        return key

    lines = []
    for line in text.split("\n"):
        shield.clear()
        line = pattern.sub(one, _WORD.sub(word, line))
        for k, v in shield.items():
            line = line.replace(k, v)
        lines.append(line)
    return "\n".join(lines)


def _mapped(function):
    """An Arrow UDF over one string column (made on the driver, when it is used)."""

    def over(s: pd.Series) -> pd.Series:
        return s.map(function, na_action="ignore").astype(object).where(s.notna(), None)

    return F.pandas_udf(over, T.StringType())


ASCII = r"^[\x00-\x7f]*$"


@lru_cache(1)
def mapped_class() -> str:
    """Java pattern of the characters that the table or the joining of marks may change, ASCII tested first."""
    codes = sorted({ord(c) for c in compiled()[0]} | set(range(0x300, 0x370)) | {0x85, 0x1680, 0x2028, 0x2029})
    spans: list[list[int]] = []
    for c in codes:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    inside = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)
    return f"[[^\\x00-\\x7f]&&[{inside}]]"


def readings(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """keys, the hash of the value and of its reading, and whether they differ.

    Values without a character that could change never leave the JVM; their
    reading is the value with runs of white space made one space.
    """
    ship_package(df.sparkSession)
    rows = df.select(*keys, F.col(value).alias("v")).where("v is not null")

    def hashed(d: DataFrame) -> DataFrame:
        return d.select(*keys, F.xxhash64("v").alias("vh"), F.xxhash64("r").alias("rh"), F.crc32(F.encode("r", "utf-8")).alias("rh2"), (F.col("v") != F.col("r")).alias("odd"))

    plain = hashed(rows.where(~F.col("v").rlike(mapped_class())).withColumn("r", F.btrim(F.regexp_replace("v", r"[\s\x1c-\x1f]+", " "))))
    other = hashed(rows.where(F.col("v").rlike(mapped_class())).withColumn("r", _mapped(reading)("v")))
    return plain.unionByName(other)


def _keyed(records: DataFrame) -> tuple[DataFrame, list[str]]:
    """Readings of both fields, and the columns of the key under which equal readings meet."""
    text = readings(records, "text", ["document_id", "record_id"]).withColumn("field", F.lit("text")).withColumn("kind", F.lit(""))
    ids = (
        readings(records.where("element_type is not null"), "element_id", ["document_id", "record_id", "element_type"])
        .withColumn("field", F.lit("element_id"))
        .withColumnRenamed("element_type", "kind")
    )
    return text.unionByName(ids).where("document_id is not null and record_id is not null"), ["document_id", "field", "kind", "rh", "rh2"]


def look_alike_classes(records: DataFrame) -> DataFrame:
    """field, document_id, record_id, class_id, n_forms, n_records, n_links: one row per record that reads like another one of its document but differs.

    A class is all records of one reading; of its records, those of other
    forms are a record's links, so no pairs are made.
    """
    every, key = _keyed(records)
    forms = every.select(*key, "record_id", "vh").distinct().groupBy(*key, "vh").agg(F.count("*").alias("n"))
    classes = forms.groupBy(*key).agg(F.count("*").alias("n_forms"), F.sum("n").alias("n_records")).where("n_forms > 1")
    rows = every.select(*key, "record_id", "vh").distinct().join(classes, key).join(forms, [*key, "vh"])
    return rows.select("field", "document_id", "record_id", F.hex(F.xxhash64("kind", "rh", "rh2")).alias("class_id"), "n_forms", "n_records", (F.col("n_records") - F.col("n")).alias("n_links"))


def look_alike_pairs(records: DataFrame) -> DataFrame:
    """(field, record_id_a, record_id_b): records of a document that read the same but differ.

    A pair has at least one value that is not its own reading, so only those
    values probe the table; the join key holds the reading, so no group of a
    document or of plain copies is ever paired with itself.
    """
    both, key = _keyed(records)
    odd = both.where("odd").select(*key, F.col("record_id").alias("a"), F.col("vh").alias("vh_a")).distinct()
    every = both.select(*key, F.col("record_id").alias("b"), F.col("vh").alias("vh_b"))
    pairs = odd.join(every, key).where("vh_a <> vh_b and a <> b")
    return pairs.select("field", F.least("a", "b").alias("record_id_a"), F.greatest("a", "b").alias("record_id_b")).distinct()


def normalize_records(records: DataFrame) -> DataFrame:
    """record_id with both fields in their consistent form, for rows where one changes."""
    ship_package(records.sparkSession)

    def fixed(c: str):
        return F.when(F.col(c).rlike(ASCII), F.col(c)).otherwise(_mapped(consistent)(F.when(~F.col(c).rlike(ASCII), F.col(c))))

    rows = records.select("record_id", "text", "element_id").where(~F.coalesce(F.col("text"), F.lit("")).rlike(ASCII) | ~F.coalesce(F.col("element_id"), F.lit("")).rlike(ASCII))
    out = rows.select("record_id", fixed("text").alias("text"), fixed("element_id").alias("element_id"), F.col("text").alias("_t"), F.col("element_id").alias("_e"))
    return out.where(~(F.col("text").eqNullSafe(F.col("_t")) & F.col("element_id").eqNullSafe(F.col("_e")))).select("record_id", "text", "element_id")
