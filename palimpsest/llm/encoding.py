"""Garbled text from a wrong character encoding (problem 1), by a hidden Markov model.

The model has one clean state and one state per encoding pair (written in A,
read as B). In a pair's state the text advances by one original character at
a time: the few stored characters that are its bytes read wrongly. A state
emits an original character with the probability that a character trigram
model gives it; the model is trained on the words of all rows. Staying in a
state costs nothing, changing it costs ``SWITCH``. ASCII characters mean the
same in every state, so only words with other characters need the model;
their scores between all pairs of states are kept per distinct word. The best
path labels the characters, and each labelled span gets its state's inverse
transform; a character of which bytes were lost comes out as U+FFFD.

Defined results: null texts and texts without non-ASCII characters are
clean; rows repeated under one key give one row; a text that is damaged only
from some point on keeps its beginning.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import glyphs
from palimpsest.session import ship_package

#: Encoding pairs: state, written in, read as, how often (fixed values).
PAIRS = (
    ("utf8-cp1252", "utf-8", "cp1252", 1),
    ("utf8-latin1", "utf-8", "latin-1", 1),
    ("utf8-cp437", "utf-8", "cp437", 1),
    ("utf8-macroman", "utf-8", "mac_roman", 1),
    ("utf8-cp1251", "utf-8", "cp1251", 1),
    ("utf8-cp1250", "utf-8", "cp1250", 1),
    ("utf8-cp1252-twice", "utf-8", "cp1252", 2),
    ("utf8-latin1-twice", "utf-8", "latin-1", 2),
    ("cp1252-cp1251", "cp1252", "cp1251", 1),
    ("cp1251-cp1252", "cp1251", "cp1252", 1),
    ("cp1252-latin1", "cp1252", "latin-1", 1),
    ("cp1252-macroman", "cp1252", "mac_roman", 1),
    ("cp1252-cp437", "cp1252", "cp437", 1),
)
CLEAN, N_STATES = 0, len(PAIRS) + 1
#: Log cost of a change of state, of a look-alike letter, of a character with lost bytes, of a character no state explains.
SWITCH, LIKE, LOST, ODD = -7.0, -3.0, -5.0, -25.0
#: Log cost, in clean text, of a Cyrillic letter that looks like no Latin one within a Latin word.
MIXED = -12.0
#: Size of the hashed tables of character pairs and triples.
TABLE_BITS = 18
_NEVER = -1e9

#: Words are cut at ASCII white space only: a no-break space may be the last byte of a character.
WORD = re.compile("[^ \t\n\x0b\f\r]*[^\x00-\x7f \t\n\x0b\f\r][^ \t\n\x0b\f\r]*")
JAVA_WORD = r"[^ \t\n\x0B\f\r]*[^\x00-\x7f][^ \t\n\x0B\f\r]*"
HAS_OTHER = r"[^\x00-\x7f]"
BROKEN = re.compile("[\x80-\x9f�]")
QUERY = re.compile(r"[^\W\d_]\?[^\W\d_]|\?{3}")
LATIN, CYRILLIC = re.compile("[A-Za-zÀ-ɏ]"), re.compile("[Ѐ-ӿ]")


def _bytes_of(codec: str) -> dict[str, int]:
    """Character -> byte of a single-byte code page; bytes without a character stand as C1 controls."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out[c] = b
    return out


_BYTES = {c: _bytes_of(c) for c in {p[2] for p in PAIRS}}


def _char_of(byte: int, codec: str) -> str:
    try:
        return bytes([byte]).decode(codec)
    except UnicodeDecodeError:
        return chr(byte)


def _utf8_unit(codes: list[int], i: int) -> tuple[int, str] | None:
    """(length, character) of the UTF-8 character at i of a list of bytes (-1: none); lost if it is cut short."""
    b = codes[i]
    n = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
    if not n:
        return None
    k = 1
    while k < n and i + k < len(codes) and 0x80 <= codes[i + k] <= 0xBF:
        k += 1
    if k == n:
        try:
            return n, bytes(codes[i : i + n]).decode("utf-8")
        except UnicodeDecodeError:
            return None
    return k, "�"


def _units(word: str, pair: tuple[str, str, str, int]) -> list[tuple[int, str] | None]:
    """For each position: how many characters an original character takes there, and which it is."""
    _, written, read, times = pair
    to_byte = _BYTES[read]
    if written != "utf-8":
        # a character that the first encoding does not have was left as it was
        return [(1, _char_of(to_byte[c], written)) if c in to_byte else (1, c) for c in word]
    codes = [to_byte.get(c, -1) for c in word]
    first = [_utf8_unit(codes, i) if codes[i] >= 0 else ((1, c) if c < "\x80" else None) for i, c in enumerate(word)]
    if times == 1:
        return first
    out: list[tuple[int, str] | None] = []
    for i in range(len(word)):
        at, chars, ends = i, [], []
        while at < len(word) and len(chars) < 4 and first[at] is not None and first[at][1] >= "\x80":
            chars.append(first[at][1])
            at += first[at][0]
            ends.append(at - i)
        unit = _utf8_unit([to_byte.get(c, -1) for c in chars], 0) if chars else None
        out.append((ends[unit[0] - 1], unit[1]) if unit else (1, word[i]) if word[i] < "\x80" else None)
    return out


def _suspect_pattern() -> re.Pattern:
    """Words this does not match have no reading in any pair's state other than their own."""
    parts = ["[\x80-\x9f�]", r"[^\W\d_]\?[^\W\d_]|\?{3}"]
    for _, written, read, _ in PAIRS:
        if written == "utf-8":
            of = {b: c for c, b in _BYTES[read].items()}
            lead = "".join(re.escape(of[b]) for b in range(0xC2, 0xF5))
            more = "".join(re.escape(of[b]) for b in range(0x80, 0xC0))
            parts.append(f"[{lead}][{more}]")
    parts.append("[A-Za-zÀ-ɏ][^Ѐ-ӿ]*[Ѐ-ӿ]|[Ѐ-ӿ][^A-Za-zÀ-ɏ]*[A-Za-zÀ-ɏ]|(?<![Ѐ-ӿ])[Ѐ-ӿ]{1,2}(?![Ѐ-ӿ])")  # cp1251 letters in a Latin word
    parts.append("[À-ÿ]{3}")  # Western letters in a row: cp1251 read as cp1252
    parts.append("[A-Za-z][‚ƒ„…†‡ˆ‰‹Œ‘’“”•–—˜™š›œŸ¡¢¤¥¦§¨©ª«¬®¯°±²³´¶·¸¹º»¼½¾¿√≈∆∞∂∑∏π∫Ω≠≤≥ﬁﬂ◊⁄α-ω╔-╬─-╣░-▓█▄▌▐▀ΓΘΦ⌐₧⌠⌡∙ⁿ■][A-Za-z]")  # a sign within a word
    return re.compile("|".join(parts))


SUSPECT = _suspect_pattern()


def _bucket(s: str) -> int:
    h = 2166136261
    for c in s:
        h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 15)) & ((1 << TABLE_BITS) - 1)


class Trigrams:
    """Hashed counts of single characters, pairs and triples, with back-off."""

    def __init__(self, counts: np.ndarray, total: int):
        self.counts, self.total, self.memo = counts, max(1, total), {}

    def score(self, a: str, b: str, c: str) -> float:
        key = a + b + c
        out = self.memo.get(key)
        if out is None:
            n = self.counts
            abc, ab = n[_bucket("3" + key)], n[_bucket("2" + a + b)]
            if abc > 0 and ab > 0:
                out = log(min(1.0, abc / ab))
            else:
                bc, b1 = n[_bucket("2" + b + c)], n[_bucket("1" + b)]
                if bc > 0 and b1 > 0:
                    out = log(0.2 * min(1.0, bc / b1))
                else:
                    out = log(0.04 * (n[_bucket("1" + c)] + 0.1) / self.total)
            if len(self.memo) < 300_000:
                self.memo[key] = out
        return out

    def word(self, w: str) -> float:
        w = "^^" + w + "$"
        return sum(self.score(w[i - 2], w[i - 1], w[i]) for i in range(2, len(w)))


def training_form(word: str) -> str | None:
    """The word as the clean model sees it, or None where some pair explains it."""
    if BROKEN.search(word) or QUERY.search(word):
        return None
    plain = word if not CYRILLIC.search(word) or not LATIN.search(word) else glyphs.reading(word)
    if LATIN.search(plain) and CYRILLIC.search(plain):
        return None
    if SUSPECT.search(word):
        for pair in PAIRS:
            if pair[1] == "utf-8":
                if any(u is not None and u[1] >= "\x80" and u[1] != "�" for u in _units(word, pair)):
                    return None
    return plain


def ngram_counts(words: DataFrame) -> DataFrame:
    """(bucket, n): hashed n-gram counts of (word, n) rows; at most 2**TABLE_BITS rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(1 << TABLE_BITS, np.int64)
        memo: dict[str, int] = {}

        def add(s: str, n: int) -> None:
            b = memo.get(s)
            if b is None:
                b = memo[s] = _bucket(s)
            table[b] += n

        for pdf in batches:
            for w, n in zip(pdf["word"], pdf["n"]):
                f = training_form(w)
                if f is None:
                    continue
                f = "^^" + f + "$"
                for i in range(2, len(f)):
                    add("3" + f[i - 2 : i + 1], n)
                    add("2" + f[i - 2 : i], n)
                    add("1" + f[i - 1], n)
        used = np.flatnonzero(table)
        yield pd.DataFrame({"bucket": used, "n": table[used]})

    return words.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


class Labeller:
    """The hidden Markov model with its per-word scores."""

    def __init__(self, counts: np.ndarray, total: int):
        self.lm = Trigrams(counts, total)
        self.words: dict[str, tuple] = {}
        self.paths: dict[str, dict] = {}
        self.like = glyphs.compiled()[0]

    def _paths(self, word: str, keep: bool):
        """Best score from each state to each state, with the decoded words if asked for."""
        n, units, active = len(word), {}, [CLEAN]
        neutral = np.zeros(N_STATES, bool)
        for s, pair in enumerate(PAIRS, 1):
            u = _units(word, pair)
            if any(x is not None and x[1] != word[i : i + x[0]] for i, x in enumerate(u)):
                units[s] = u
                active.append(s)
            else:
                neutral[s] = all(x is not None for x in u)
        mixed = bool(LATIN.search(word))
        out = np.full((N_STATES, N_STATES), _NEVER)
        differs = np.zeros((N_STATES, N_STATES), bool)
        decoded: dict[tuple[int, int], tuple] = {}
        for start in active:
            # cell: state -> (score, last two characters, path)
            cells: list[dict[int, tuple]] = [{} for _ in range(n + 1)]
            cells[0] = {s: (0.0 if s == start else SWITCH, "^", "^", (), False) for s in active}
            for i in range(n):
                if not cells[i]:
                    continue
                best = max(cells[i].items(), key=lambda x: x[1][0])
                for s in active:
                    here = cells[i].get(s)
                    if best[0] != s and (here is None or best[1][0] + SWITCH > here[0]):
                        here = (best[1][0] + SWITCH, *best[1][1:])
                    if here is None:
                        continue
                    score, a, b, path, changed = here
                    c = word[i]
                    if s == CLEAN:
                        options = [(1, c, ODD if "\x80" <= c <= "\x9f" else MIXED if mixed and "Ѐ" <= c <= "ӿ" and c not in self.like else 0.0)]
                        if (m := self.like.get(c)) is not None:
                            options.append((1, m, LIKE))
                    else:
                        u = units[s][i]
                        options = [(1, c, LOST)] if c == "�" else [(1, c, ODD)] if u is None else [(u[0], u[1], LOST if u[1] == "�" else 0.0)]
                    for k, o, cost in options:
                        x, y, total = a, b, score + cost
                        for ch in o:
                            if ch == " ":
                                x, y = "^", "^"
                            else:
                                total += self.lm.score(x, y, ch) if ch != "�" else -4.0
                                x, y = y, ch
                        old = cells[i + k].get(s)
                        if old is None or total > old[0]:
                            cells[i + k][s] = (total, x, y, (path, s, i, k, o) if keep else (), changed or (s != CLEAN and o != word[i : i + k]))
            for s, (score, a, b, path, changed) in cells[n].items():
                score += self.lm.score(a, b, "$")
                out[start, s] = score
                differs[start, s] = changed
                if keep:
                    decoded[start, s] = path
        for s in range(1, N_STATES):
            if s not in units:
                # the word reads the same in this state, or cannot stand in it
                out[s, s] = out[CLEAN, CLEAN] + (0.0 if neutral[s] else ODD)
                if keep:
                    decoded[s, s] = decoded.get((CLEAN, CLEAN))
                for t in range(N_STATES):
                    if t != s:
                        for i, j in ((s, t), (t, s)):
                            via = out[CLEAN, t] if i == s else out[t, CLEAN] if t in active else _NEVER
                            if via + SWITCH > out[i, j]:
                                out[i, j] = via + SWITCH
                                differs[i, j] = differs[CLEAN, t] if i == s else differs[t, CLEAN]
                                if keep:
                                    decoded[i, j] = decoded.get((CLEAN, t) if i == s else (t, CLEAN))
        out -= out[CLEAN, CLEAN]
        return out, differs, decoded

    def word(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Scores from state to state, and whether a character changes on the way."""
        got = self.words.get(word)
        if got is None:
            if SUSPECT.search(word):
                got = self._paths(word, keep=False)[:2]
            else:
                m = np.full((N_STATES, N_STATES), SWITCH)
                for s, pair in enumerate(PAIRS, 1):
                    u = _units(word, pair)
                    m[s, s] = 0.0 if all(x is not None for x in u) and all(x[1] == word[i : i + x[0]] for i, x in enumerate(u)) else ODD
                m[CLEAN, CLEAN] = 0.0
                got = m, np.zeros((N_STATES, N_STATES), bool)
            if len(self.words) < 200_000:
                self.words[word] = got
        return got

    def decoded(self, word: str) -> dict[tuple[int, int], tuple]:
        """The best path through a word from state to state, kept per word."""
        got = self.paths.get(word)
        if got is None:
            got = self._paths(word, keep=True)[2]
            if len(self.paths) < 50_000:
                self.paths[word] = got
        return got

    def labels(self, text: str) -> list[tuple[int, int]] | None:
        """State before and after each non-ASCII word on the best path; None if all is clean."""
        words = WORD.findall(text)
        if not any(SUSPECT.search(w) for w in words):
            return None
        v = np.full(N_STATES, SWITCH)
        v[CLEAN] = 0.0
        back = []
        for w in words:
            m = v[:, None] + self.word(w)[0]
            k = m.argmax(0)
            back.append(k)
            v = m[k, np.arange(N_STATES)]
        s = int(v.argmax())
        path = []
        for k in reversed(back):
            path.append((int(k[s]), s))
            s = int(k[s])
        path.reverse()
        return path

    def damaged(self, text: str) -> bool:
        if "�" in text or QUERY.search(text) and not _JUNK.search(text):
            return True
        path = self.labels(text)
        # a path counts if it leaves the clean state between words and changes a character
        return path is not None and any((a or b) and self.word(w)[1][a, b] for w, (a, b) in zip(WORD.findall(text), path))

    def restore(self, text: str) -> tuple[str, list[str]]:
        """The text with each labelled span transformed back, and the states found."""
        path = self.labels(text)
        if path is None or not any(a or b for a, b in path):
            return text, ["lost"] if "�" in text else []
        out, at, names = [], 0, []
        for m, (a, b) in zip(WORD.finditer(text), path):
            out.append(text[at : m.start()])
            at = m.end()
            if a == b == CLEAN:
                out.append(m.group())
                continue
            steps, chars = self.decoded(m.group()).get((a, b)), []
            while steps:
                steps, s, i, k, o = steps
                chars.append(o if s != CLEAN else m.group()[i : i + k])
                if s != CLEAN and o != m.group()[i : i + k] and PAIRS[s - 1][0] not in names:
                    names.append(PAIRS[s - 1][0])
            out.append("".join(reversed(chars)) if chars else m.group())
        restored = "".join(out) + text[at:]
        return restored, names + (["lost"] if "�" in restored else [])


_JUNK = re.compile("[■□◊▪█\ue000-\uf8ff]")


def other_words(texts: DataFrame) -> DataFrame:
    """(word, n): the words with non-ASCII characters of a text column, with their counts."""
    return (
        texts.where(F.col("text").rlike(HAS_OTHER))
        .select(F.explode(F.regexp_extract_all("text", F.lit(JAVA_WORD), F.lit(0))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def train(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The hashed n-gram table of all rows' words."""
    ship_package(texts.sparkSession)
    rows = ngram_counts(other_words(texts)).toPandas()
    table = np.zeros(1 << TABLE_BITS, np.float64)
    table[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return table, int(table.sum() // 3)


def keyed_texts(records: DataFrame, knowledge: DataFrame) -> DataFrame:
    a = records.select(F.lit("records").alias("src_table"), F.col("record_id").alias("row_key"), "text")
    b = knowledge.select(F.lit("knowledge").alias("src_table"), F.col("stable_internal_id").alias("row_key"), "text")
    return a.unionByName(b).where("text is not null and row_key is not null")


def _label(texts: DataFrame, restore: bool) -> DataFrame:
    spark = texts.sparkSession
    model = spark.sparkContext.broadcast(train(texts))  # a table of fixed size
    holder: list[Labeller] = []
    maybe = texts.where(F.col("text").rlike(HAS_OTHER) | F.col("text").rlike(r"\p{L}\?\p{L}|\?\?\?"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not holder:
            holder.append(Labeller(*model.value))
        lab = holder[0]
        for pdf in batches:
            bad = pdf[[lab.damaged(t) for t in pdf["text"]]]
            if not len(bad):
                continue
            if not restore:
                yield bad[["src_table", "row_key"]]
            else:
                done = [lab.restore(t) for t in bad["text"]]
                yield bad[["src_table", "row_key"]].assign(text=[d[0] for d in done], states=[d[1] for d in done], whole=["�" not in d[0] for d in done])

    schema = "src_table string, row_key string" + (", text string, states array<string>, whole boolean" if restore else "")
    return maybe.mapInPandas(run, schema).dropDuplicates(["src_table", "row_key"])


def found(records: DataFrame, knowledge: DataFrame) -> DataFrame:
    """(src_table, row_key) of every row with characters from a wrong decoding."""
    return _label(keyed_texts(records, knowledge), restore=False)


def restored(records: DataFrame, knowledge: DataFrame) -> DataFrame:
    """The affected rows with their text as far as it can be restored, the states found and whether all was."""
    return _label(keyed_texts(records, knowledge), restore=True)
