"""Noise in text from scanned pages (problem 3): broken words, misread characters, running headers, page numbers.

1. All words of both tables are counted, and all pairs of neighbouring words.
2. The vocabulary is every word met often enough. It is cut into shards, each
   a trie; every word to be explained is searched in every shard, so that
   retrieval is complete whatever the size of the vocabulary. Two automata run
   over a trie: one whose edits are the listed misreadings of scanners, and a
   Levenshtein automaton for ordinary edits (one, from ten letters on two).
3. Rows are read once more: headers and page numbers are told by the
   publication's title, series and number and by the page's number. Words not
   known are asked for together with their neighbours, by key, so neither rows
   nor words pass through the driver.
4. The candidates of a word are ranked by their cost and by how often they
   stand beside its neighbours. A listed misreading counts as it is; a
   candidate reached by ordinary edits counts only if it is met beside both
   neighbours elsewhere.
5. A word broken at a line is joined if the joined word is known and the
   compound is not.

Defined results: null texts, lines and titles have no noise; an empty table
gives no rows; rows repeated under one key give each kind of noise once;
words of three characters or fewer are never taken for misread; words in
Greek or Cyrillic letters, wholly or in part, are none of this problem; an
ordinary edit never changes a letter outside ASCII (that is damage of another
kind), an accent alone, a hyphen, or the last letter (which may be an
inflection); a word met ``LEAST_COUNT`` times is a
word, unless it is a listed misreading of one eight times as common.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import checkpoint, ship_package

# What a scanner makes of a letter (right, wrong).
MISREADINGS = (
    ("e", "c"), ("n", "ri"), ("i", "!"), ("i", "1"), ("a", "@"), ("t", "f"), ("o", "0"), ("s", "5"), ("l", "1"), ("d", "cl"), ("g", "9"), ("u", "ii"),
    ("m", "rn"), ("h", "b"), ("ti", "h"), ("w", "vv"), ("b", "6"), ("z", "2"),
)
#: Most listed misreadings in one word; most ordinary edits, by the letters of the word.
MISREADS = 2
SHORT_EDITS, LONG_EDITS, LONG = 1, 2, 10
#: Least length of a word that may be meant; least count of a word that may be meant; least ratio of the two counts.
LEAST_LENGTH, LEAST_COUNT, LEAST_RATIO = 4, 5, 8
#: A pair of neighbours met less often is no evidence.
LEAST_PAIR = 3
#: Words of one trie, and words searched in it by one task (bound memory, change no result).
SHARD_WORDS, QUERY_WORDS = 150_000, 20_000
#: The most frequent words travel to every task so that fewer words are asked for; all others are asked for by key.
SENT_WORDS = 150_000
#: The commonest words, beside which a word must stand to be looked up.
COMMON_WORDS = 5_000
# What may follow a hyphen left hanging on purpose.
HANGING = frozenset("and or to nor und oder bis et ou y o e".split())
# The commonest English words, by which running prose is told.
PROSE_WORDS = frozenset("the of and is are was were be been to in for with by a an on at that this has have should can may must as not from or its it".split())
PROSE_SHARE = 0.12
TOKEN = re.compile(r"[\w!@]+(?:[-‑][\w!@]+)*")
MAYBE_MISREAD = re.compile("[a-z0-9!@ß-ɏ]+(?:-[a-z0-9!@ß-ɏ]+)*")
INVISIBLE = frozenset("\xad\u034f\u200b\u200c\u200d\u2060\ufeff")
BREAK = re.compile(r"(?<![\w!@])([\w!@]+)([-‐‑¬\xad])(?:[^\S\n]*\n\s*|[^\S\n]+)([\w!@]+)")
BREAK_SIGN = re.compile(r"[\w!@][-‐‑¬\xad]\s")
END_BREAK = re.compile(r"([\w!@]+)([-‐‑¬\xad])\s*$")
FIRST_WORD = re.compile(r"^\W*?([\w!@]+)")
NUMBER_LINE = re.compile(r"^\s*(?:[\[(–—-]\s*|p(?:age|\.)?\s*|P(?:age|\.)\s*)?(\d{1,4})\s*[\])–—-]?\s*$")
NUMBER_ON_LINE = re.compile(r"^\s*(?:(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?\s+)?(.*?)(?:\s+(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?)?\s*$")
ANY_NUMBER = re.compile(r"^\s*\W{0,2}(?:p\.?|[Pp]age|P\.)?\s*\d{1,4}\W{0,2}\s*$|[–—-] \d{1,4} [–—-]|Page \d|p\. \d|\[\d{1,4}\]\n", re.M)
INLINE_NUMBER = re.compile(r"(?:(?<=[^\W\d_])|(?<=[,;¬\xad‐-]))\s+(?:[–—-] \d{1,4} [–—-]|Page \d{1,4}|p\. \d{1,4}|\[\d{1,4}\](?=\n))\s+(?=[a-zà-ÿ])")
_WORDLIKE = re.compile(r"[^\W\d_]{2,}")


# --- vocabulary ---------------------------------------------------------


def _plain(token: str) -> str:
    return token.replace("‑", "-").rstrip("!")


def word_hash(word: str) -> int:
    """64 bits, signed; 0 stands for no word."""
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1
    return h - (1 << 64) if h >> 63 else h


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, pair, n): all words with their counts (pair 0), and under the empty word the pairs of neighbours by hash.

    Pairs met less than ``LEAST_PAIR`` times are left out.
    """
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        class Ids(dict):
            def __missing__(self, w: str) -> int:
                self[w] = n = len(self)
                return n

        ids, totals, pairs, size = Ids(), np.zeros(0, np.int64), [], 0

        def out() -> pd.DataFrame:
            words: Counter = Counter()
            for w, i in ids.items():
                words[_plain(w)] += int(totals[i])
            hashes = np.fromiter(map(word_hash, map(_plain, ids)), np.int64, len(ids))
            both, n = _merged(pairs)
            m, k = len(words), len(both)
            return pd.DataFrame(
                {
                    "word": [*words, *[""] * k],
                    "a": np.concatenate([np.zeros(m, np.int64), hashes[both >> 32]]),
                    "b": np.concatenate([np.zeros(m, np.int64), hashes[both & 0xFFFFFFFF]]),
                    "n": np.concatenate([np.fromiter(words.values(), np.int64, m), n]),
                }
            )

        for pdf in batches:
            for part in (pdf["text"][i : i + 500] for i in range(0, len(pdf), 500)):
                x = np.fromiter(map(ids.__getitem__, TOKEN.findall("\n".join(part).lower())), np.int64)
                if len(totals) < len(ids):
                    totals = np.concatenate([totals, np.zeros(len(ids) - len(totals), np.int64)])
                totals += np.bincount(x, minlength=len(ids))
                pairs.append(np.unique((x[:-1] << 32) | x[1:], return_counts=True))
                size += len(pairs[-1][0])
                if size > 4_000_000:
                    pairs = [_merged(pairs)]
                    size = len(pairs[0][0])
                if size > 3_000_000 or len(ids) > 3_000_000:
                    yield out()
                    ids, totals, pairs, size = Ids(), np.zeros(0, np.int64), [], 0
        if ids:
            yield out()

    got = texts.mapInPandas(count, "word string, a long, b long, n long")
    pair = F.when(F.col("word") == "", F.xxhash64("a", "b")).otherwise(F.lit(0).cast("long"))
    return got.withColumn("pair", pair).groupBy("word", "pair").agg(F.sum("n").alias("n")).where(f"word <> '' or pair <> 0 and n >= {LEAST_PAIR}")


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their summed counts."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


class Node:
    """A place in the trie: what follows, the word that ends here, and how many letters may follow."""

    __slots__ = ("next", "word", "least", "most")

    def __init__(self):
        self.next: dict[str, Node] = {}
        self.word: str | None = None
        self.least, self.most = 1 << 30, 0


class Trie:
    """A shard of the vocabulary, searched by automata."""

    def __init__(self, words: dict[str, int]):
        self.words = words
        self.root = Node()
        for w in words:
            node, left = self.root, len(w)
            for c in w:
                node.least, node.most = min(node.least, left), max(node.most, left)
                if c not in node.next:
                    node.next[c] = Node()
                node = node.next[c]
                left -= 1
            node.least, node.word = 0, w
        self.by_wrong: dict[str, list[tuple[str, str]]] = {}
        for right, wrong in MISREADINGS:
            self.by_wrong.setdefault(wrong[0], []).append((right, wrong))

    def misreadings(self, word: str, most: int = MISREADS) -> dict[str, int]:
        """Every word of the trie of which ``word`` is a listed misreading, with the number of misread places.

        The states are pairs of a place in the word and a node; each is kept
        with the fewest misread places.
        """
        found: dict[str, int] = {}
        best: dict[tuple[int, int], int] = {}
        stack = [(0, self.root, 0)]
        while stack:
            i, node, cost = stack.pop()
            key = (i, id(node))
            if best.get(key, most + 1) <= cost:
                continue
            best[key] = cost
            if i == len(word):
                if node.word is not None and cost < found.get(node.word, most + 1):
                    found[node.word] = cost
                continue
            if (n := node.next.get(word[i])) is not None:
                stack.append((i + 1, n, cost))
            if cost < most:
                for right, wrong in self.by_wrong.get(word[i], ()):
                    if word.startswith(wrong, i):
                        n = node
                        for x in right:
                            n = n.next.get(x)
                            if n is None:
                                break
                        else:
                            stack.append((i + len(wrong), n, cost + 1))
        return found

    def within(self, word: str, k: int) -> dict[str, int]:
        """Every word of the trie at most k insertions, deletions or substitutions away, with its distance.

        The Levenshtein automaton of the word is run bit-parallel: one integer
        per number of edits holds the places reached. A branch is left when no
        place is reached or the words below it are too short or too long.
        """
        m = len(word)
        mask: dict[str, int] = {}
        for i, c in enumerate(word):
            mask[c] = mask.get(c, 0) | 1 << i
        end, full = 1 << m, (1 << m + 1) - 1
        start = [1]
        for _ in range(k):
            start.append(start[-1] | start[-1] << 1 & full)
        found: dict[str, int] = {}
        stack = [(self.root, start, 0)]
        while stack:
            node, states, depth = stack.pop()
            if node.word is not None:
                for e, r in enumerate(states):
                    if r & end:
                        found[node.word] = e
                        break
            for c, n in node.next.items():
                if depth + 1 + n.least > m + k or depth + 1 + n.most < m - k:
                    continue
                b = mask.get(c, 0)
                below = states[0]
                new = (below & b) << 1
                out = [new]
                alive = new
                for r in states[1:]:
                    new = ((r & b) << 1 | below | below << 1 | new << 1) & full
                    out.append(new)
                    alive |= new
                    below = r
                if alive:
                    stack.append((n, out, depth + 1))
        return found


def edits_allowed(word: str) -> int:
    return LONG_EDITS if len(word) >= LONG else SHORT_EDITS


def _bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def ordinary(word: str, meant: str) -> bool:
    """Whether the edits between the two words are such as a scanner makes."""
    odd = lambda w: [c for c in w if c > "\x7f"]
    return word[-1] == meant[-1] and odd(word) == odd(meant) and word.count("-") == meant.count("-") and _bare(word) != _bare(meant)


CANDIDATES = "word string, meant string, cost int, listed boolean, h long, n_meant long"


def _search(trie: Trie, words: list[str], counts: list[int], edits: bool) -> pd.DataFrame:
    out = []
    for w, n in zip(words, counts):
        got = {x: (k, True) for x, k in trie.misreadings(w).items()}
        if edits and len(w) >= LEAST_LENGTH and not any(c.isdigit() for c in w):
            for x, k in trie.within(w, edits_allowed(w)).items():
                if x not in got and ordinary(w, x):
                    got[x] = (k, False)
        out += [(w, x, k, listed, word_hash(x), trie.words[x]) for x, (k, listed) in got.items() if x != w and len(x) >= LEAST_LENGTH and trie.words[x] >= LEAST_RATIO * n]
    return pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATES.split(", ")])


def candidates(words: DataFrame, vocabulary: DataFrame, *, edits: bool = True) -> DataFrame:
    """One row for each word of (word, n) and each word of the vocabulary (word, n) that it may be a misreading of.

    Words and vocabulary are dealt into parts and shards; every part meets
    every shard, so no task holds more than one shard and one part.
    """
    ship_package(words.sparkSession)
    looked = words.where((F.length("word") >= LEAST_LENGTH - 1) & F.col("word").rlike("^" + MAYBE_MISREAD.pattern + "$") & F.col("word").rlike("[a-zß-ɏ]"))
    n_words, n_vocabulary = looked.count(), vocabulary.count()
    parts = max(1, words.sparkSession.sparkContext.defaultParallelism, -(-n_words // QUERY_WORDS))
    shards = max(1, -(-n_vocabulary // SHARD_WORDS))
    asked = looked.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(parts)).cast("long").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    known = vocabulary.select(F.col("word").alias("meant"), F.col("n").alias("n_meant"), F.pmod(F.xxhash64("word"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))

    def search(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or known.empty:
            return pd.DataFrame([], columns=[c.split()[0] for c in CANDIDATES.split(", ")])
        return _search(Trie(dict(zip(known["meant"], known["n_meant"].tolist()))), asked["word"].tolist(), asked["n"].tolist(), edits)

    # searching takes time, not room: partitions by number, which are not coalesced by their size
    n = min(parts * shards, 10_000)
    asked, known = (x.repartition(n, "part", "shard") for x in (asked, known))
    return asked.groupBy("part", "shard").cogroup(known.groupBy("part", "shard")).applyInPandas(search, CANDIDATES)


# --- rows ---------------------------------------------------------------


class Words:
    """The known words that are sent: all that are met more than some number of times."""

    def __init__(self, counts: dict[str, int], longest: int = 1 << 30):
        self.counts, self.longest = counts, longest
        self.heads = {w.split("-", 1)[0] for w in counts if "-" in w}
        self.common = frozenset(sorted(counts, key=lambda w: (-counts[w], w))[:COMMON_WORDS])

    def broken(self, a: str, sign: str, b: str | None) -> str:
        """'yes', 'no', or 'ask' if neither the joined word nor the compound is among the words sent."""
        a, b = a.lower(), b.lower() if b else None
        if b is None:
            # nothing follows: the beginning of a known compound is not taken for a broken word
            return "no" if a in self.heads or not a.isalpha() or (a in self.counts and sign in "-‑") else "ask"
        joined, compound = self.counts.get(a + b, 0), self.counts.get(f"{a}-{b}", 0)
        if joined > compound:
            return "yes"
        if compound or b in HANGING or a.isdigit():
            return "no"
        return "ask"


def _same(text: str) -> str:
    return " ".join(text.split()).casefold()


def header_forms(title: str | None, series: str | None, number: str | None) -> set[str]:
    forms = {_same(x) for x in (title, series, number) if x and x.strip()}
    if number and title and number.strip() and title.strip():
        forms |= {_same(f"{number} {title}"), _same(f"{title} {number}")}
    return forms


def is_header(line: str, forms: set[str]) -> bool:
    if not forms:
        return False
    s = _same(line)
    if s in forms:
        return True
    m = NUMBER_ON_LINE.match(line)
    return bool(m) and _same(m.group(1)) in forms


def furniture(lines: list[str], page: int | None, printed: str | None, forms: set[str]) -> tuple[set[int], set[int]]:
    """Places of header lines and of page number lines of a page."""
    n = len(lines)
    edge = [i for i in range(n) if i < 3 or i >= n - 3]
    headers = {i for i in edge if is_header(lines[i], forms)}
    own = {str(page)} if page is not None else set()
    if printed:
        own.add(printed.strip())
    numbers = set()
    for i in edge:
        m = NUMBER_LINE.match(lines[i])
        if m and (m.group(1) in own or lines[i].strip() in own) and i not in headers:
            if i in (0, n - 1) or {i - 1, i + 1} & headers:
                numbers.add(i)
    # only furniture may lie outside of a header
    top, bottom = 0, n - 1
    while top in headers | numbers:
        top += 1
    while bottom in headers | numbers and bottom > top:
        bottom -= 1
    keep = {i for i in headers | numbers if i < top or i > bottom}
    return headers & keep, numbers & keep


def is_prose(text: str) -> bool:
    words = _WORDLIKE.findall(text.lower())
    return bool(words) and sum(w in PROSE_WORDS for w in words) / len(words) >= PROSE_SHARE


def record_header(text: str, title: str | None, series: str | None, number: str | None, region: str | None) -> list[tuple[int, int]]:
    """Spans of running headers inside a record's prose."""
    parts, upper = [], text.upper()
    if not any(x and x.strip() and x.strip().upper() in upper for x in (title, series, number)):
        return []
    for x in (title, series):
        if x and x.strip():
            parts += [re.escape(x.strip()), re.escape(x.strip().upper())]
    if number and number.strip():
        num = re.escape(number.strip())
        both = [rf"{num}\s+{p}" for p in parts] + [rf"{p}\s+{num}" for p in parts]
        parts = both + parts + [num]
    if not parts:
        return []
    out = []
    for m in re.finditer(rf"(?<![\w-])(?:{'|'.join(parts)})(?![\w-])", text):
        before, after = text[: m.start()].rstrip(), text[m.end() :].lstrip()
        before = re.sub(r"(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?$", "", before).rstrip()
        after = re.sub(r"^(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?(?=\s)", "", after).lstrip()
        if not before:
            continue
        if region == "FrontMatter":  # there the title stands on a line of its own by right
            a, b = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
            alone = not text[a : m.start()].strip() and not text[m.end() : b if b >= 0 else len(text)].strip()
            if alone or not re.search(r"[^\W\d_][,;]?$", before) or not re.match(r"[a-zà-ÿ]", after):
                continue
        out.append(m.span())
    return out


def record_numbers(text: str) -> list[tuple[int, int]]:
    """Spans of page numbers inside a record's running prose."""
    if not ANY_NUMBER.search(text) or not is_prose(text):
        return []
    out = [m.span() for m in INLINE_NUMBER.finditer(text)]
    lines, at = text.split("\n"), 0
    for i, line in enumerate(lines):
        if 0 < i < len(lines) - 1 and NUMBER_LINE.match(line):
            before, after = lines[i - 1].strip(), lines[i + 1].strip()
            if _WORDLIKE.search(before) and _WORDLIKE.search(after) and (is_prose(before + " " + after) or len(before.split()) + len(after.split()) < 6) and re.search(r"[^\W_][.,;:”’)¬\xad‐-]*$", before) and not re.match(r"^\S*\d$", before):
                out.append((at, at + len(line)))
        at += len(line) + 1
    return out


#: word: what is asked for (empty: the noise is certain); other: the compound, or the sign of a word at the end; before, after: the neighbours.
NOISE = "src_table string, row_key string, noise string, word string, other string, before string, after string"
END = "\t"


def _unknown(text: str, words: Words, skip: set[str]) -> list[tuple[str, str, str]]:
    """(word, before, after) of the words of a text that are not among those sent and might be misread, each beside common words.

    Words next to an invisible sign come without neighbours: they may be half a word.
    """
    known, low = words.counts, text.lower()
    odd = {t: p for t in set(TOKEN.findall(low)).difference(known) if len(t) <= words.longest + 2 * MISREADS and (p := _lookup_form(t)) and p not in known and p not in skip}
    if not odd:
        return []
    tokens = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(low)]
    out = {}
    for i, (t, start, end) in enumerate(tokens):
        if t in odd:
            near = [x for x, _, _ in tokens[max(0, i - 3) : i] + tokens[i + 1 : i + 4]]
            if near and 2 * sum(x in words.common for x in near) >= len(near):
                before, after = _plain(tokens[i - 1][0]) if i else "", _plain(tokens[i + 1][0]) if i + 1 < len(tokens) else ""
                if low[start - 1 : start] in INVISIBLE or low[end : end + 1] in INVISIBLE:
                    before = after = ""
                out[odd[t], before, after] = None
    return list(out)


@lru_cache(100_000)
def _lookup_form(token: str) -> str:
    """The form under which an unknown word is looked up; empty if it cannot be a misread word."""
    t = _plain(token)
    return t if len(t) >= LEAST_LENGTH - 1 and not t.isdigit() and MAYBE_MISREAD.fullmatch(t) else ""


def _body_noise(text: str, words: Words, last: str | None) -> list[tuple[str, str, str, str, str]]:
    """(noise, word, other, before, after) of a text; ``last`` is the word that follows its end, None where an end says nothing."""
    joined, pieces, whole, certain = {}, set(), set(), False
    for m in BREAK.finditer(text) if BREAK_SIGN.search(text) else ():
        a, sign, b = m.groups()
        got = words.broken(a, sign, b)
        pieces |= {a.lower(), b.lower()}
        if got == "yes":
            certain = True
        elif got == "ask":
            joined[(a + b).lower()] = f"{a}-{b}".lower()
        if got != "yes" and b.lower() not in HANGING:
            whole.add(f"{a}-{b}".lower())
    m = END_BREAK.search(text, max(0, len(text) - 100)) if last is not None else None
    if m:
        got = words.broken(m.group(1), m.group(2), last or None)
        pieces.add(m.group(1).lower())
        if got == "yes":
            certain = True
        elif got == "ask" and last:
            joined[(m.group(1) + last).lower()] = f"{m.group(1)}-{last}".lower()
        elif got == "ask":
            joined[m.group(1).lower()] = END + m.group(2)
    # halves of compounds may be misread on their own
    halves = {p for w in whole for p in w.split("-") if len(p) >= LEAST_LENGTH}
    alone = {w for w in whole | halves if w not in words.counts and MAYBE_MISREAD.fullmatch(w)} | {w for w, o in joined.items() if not o.startswith(END)}
    out = [("hyphen", "", "", "", "")] * certain + [("hyphen", w, o, "", "") for w, o in joined.items()]
    return out + [("ocr", w, "", "", "") for w in alone] + [("ocr", w, "", a, b) for w, a, b in _unknown(text, words, pieces)]


def page_noise(pages: DataFrame, words) -> DataFrame:
    """src_table, row_key, noise, word of pages; a word is to be looked up among the corrections."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = words.value
        for pdf in batches:
            out = []
            for source, page, printed, lines, title, series, number, head in zip(*[pdf[c] for c in ("source_file", "pdf_page", "printed_page", "lines", "title", "series_name", "series_number", "next_head")]):
                if lines is None or not len(lines):
                    continue
                lines = [x or "" for x in lines]
                key = f"{source}#{int(page)}"
                forms = header_forms(title, series, number)
                headers, numbers = furniture(lines, int(page), printed, forms)
                if headers:
                    out.append((key, "header", "", "", "", ""))
                if numbers:
                    out.append((key, "page_number", "", "", "", ""))
                body = "\n".join(x for i, x in enumerate(lines) if i not in headers and i not in numbers)
                follow = ""
                if head is not None and len(head):
                    head = [x or "" for x in head]
                    h, n = furniture([*head, "", "", "", ""], int(page) + 1, None, forms)
                    rest = [x for i, x in enumerate(head) if i not in h and i not in n and x.strip()]
                    if rest and (m := FIRST_WORD.match(rest[0])):
                        follow = m.group(1)
                out += [(key, *x) for x in _body_noise(body, w, follow)]
            yield pd.DataFrame([("page_texts", *x) for x in out], columns=[c.split()[0] for c in NOISE.split(", ")])

    return pages.mapInPandas(run, NOISE)


def record_noise(records: DataFrame, words) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = words.value
        for pdf in batches:
            out = []
            for key, kind, region, text, title, series, number in zip(*[pdf[c] for c in ("record_id", "element_type", "source_region", "text", "document_title", "series_name", "series_number")]):
                if not text:
                    continue
                if kind != "heading":
                    if record_header(text, title, series, number, region):
                        out.append((key, "header", "", "", "", ""))
                    if record_numbers(text):
                        out.append((key, "page_number", "", "", "", ""))
                out += [(key, *x) for x in _body_noise(text, w, None)]
            yield pd.DataFrame([("records", *x) for x in out], columns=[c.split()[0] for c in NOISE.split(", ")])

    return records.mapInPandas(run, NOISE)


def with_publication(page_texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Pages with title, series and number of their publication and the head of the page that follows."""
    p = page_texts.where("source_file is not null and pdf_page is not null and lines is not null").select("source_file", "pdf_page", "printed_page", "lines")
    d = docs.where("source_file is not null").select("source_file", "title", "series_name", "series_number").dropDuplicates(["source_file"])
    # the head of the next page matters only where a page ends with a sign of a break
    ends = F.array_join(F.slice("lines", F.greatest(F.size("lines") - 2, F.lit(1)), 3), "\n").rlike(r"[\w!@][-‐‑¬\xad]\s*(\n|$)")
    heads = p.select("source_file", (F.col("pdf_page") - 1).alias("pdf_page"), F.slice("lines", 1, 3).alias("next_head")).dropDuplicates(["source_file", "pdf_page"])
    broken = p.where(ends).join(heads, ["source_file", "pdf_page"], "left")
    whole = p.where(~ends | ends.isNull()).withColumn("next_head", F.lit(None).cast("array<string>"))
    return whole.unionByName(broken).join(d, "source_file", "left")


LETTERS_ONLY = r"^\p{L}+(-\p{L}+)*$"


class Model:
    """What the passes over the rows need: counts of words and pairs, the vocabulary, and the words that are sent."""

    def __init__(self, page_texts: DataFrame, records: DataFrame):
        spark = records.sparkSession
        texts = page_texts.select(F.array_join("lines", "\n").alias("text")).unionByName(records.select("text")).where("text is not null")
        counts = checkpoint(word_counts(texts))
        self.words, self.pairs = counts.where("word <> ''").select("word", "n"), counts.where("word = ''").select("pair", "n")
        often = self.words.where((F.col("n") >= LEAST_COUNT) & F.col("word").rlike(LETTERS_ONLY))
        misread = candidates(often, often, edits=False).select("word").distinct()
        self.vocabulary = checkpoint(often.join(misread, "word", "left_anti"))
        top = self.vocabulary.orderBy(F.desc("n"), "word").limit(SENT_WORDS + 1).toPandas()
        if len(top) > SENT_WORDS:  # all words above a count, so that what is not sent is less common than what is
            top = top[top["n"] > top["n"].iloc[-1]]
        longest = self.vocabulary.agg(F.max(F.length("word"))).first()[0] or 0
        self.sent = Words(dict(zip(top["word"].tolist(), top["n"].tolist())), longest)
        self.broadcast = spark.sparkContext.broadcast(self.sent)

    def resolved(self, rows: DataFrame) -> DataFrame:
        """The rows asked for that are noise: src_table, row_key, noise, word, before, after, meant (the word to put, null where nothing is to be put)."""
        asked = rows.where("word <> ''")
        forms = asked.select("word").unionByName(asked.where("other <> ''").select(F.col("other").alias("word"))).distinct()
        forms = forms.join(self.vocabulary.withColumnRenamed("n", "known"), "word", "left")
        unknown = asked.select("word").distinct().join(self.vocabulary, "word", "left_anti").join(self.words, "word", "left").select("word", F.coalesce("n", F.lit(1)).cast("long").alias("n"))
        found = checkpoint(candidates(unknown, self.vocabulary))

        # broken words: the joined word is known more often than the compound, or is a listed misreading of a known word
        broken = asked.where("noise = 'hyphen'")
        by_word = forms.select("word", F.coalesce("known", F.lit(0)).alias("known"))
        compared = broken.where(~F.col("other").startswith(END)).join(by_word, "word").join(by_word.select(F.col("word").alias("other"), F.col("known").alias("as_compound")), "other")
        listed = found.where("listed").select("word").distinct()
        joined = compared.where("known > as_compound").unionByName(compared.where("known = 0 and as_compound = 0").join(listed, "word", "left_semi"))
        # at the end of a text a word is broken unless it is known, or begins a compound
        heads = self.vocabulary.where(F.col("word").contains("-")).select(F.substring_index("word", "-", 1).alias("word")).distinct()
        ends = broken.where(F.col("other").startswith(END)).join(heads, "word", "left_anti").join(self.vocabulary.select("word", F.lit(True).alias("is_word")), "word", "left")
        ends = ends.where(F.col("is_word").isNull() | ~F.substring("other", 2, 1).isin("-", "‑"))
        keys = ["src_table", "row_key", "noise", "word", "before", "after"]
        hyphens = joined.select(*keys).unionByName(ends.select(*keys)).withColumn("meant", F.lit(None).cast("string"))

        # misread words: the candidate of least cost that stands best beside the neighbours
        contexts = asked.where("noise = 'ocr'").select("word", "before", "after").distinct()
        options = contexts.join(found, "word")
        ranked = self.ranked(options)
        misread = asked.where("noise = 'ocr'").join(ranked, ["word", "before", "after"]).select(*keys, "meant")
        return hyphens.unionByName(misread)

    def ranked(self, options: DataFrame) -> DataFrame:
        """word, before, after, meant: the best candidate of each word in its place, where one is good enough."""
        place = ["word", "before", "after"]
        left = F.when(F.col("before") != "", F.xxhash64("hb", "h"))
        right = F.when(F.col("after") != "", F.xxhash64("h", "ha"))
        hashed = options.withColumn("hb", _hashes()("before")).withColumn("ha", _hashes()("after")).withColumn("left", left).withColumn("right", right)
        needed = hashed.select(F.explode(F.array("left", "right")).alias("pair")).where("pair is not null").distinct()
        met = self.pairs.join(needed, "pair")
        with_counts = hashed.join(met.select(F.col("pair").alias("left"), F.col("n").alias("n_left")), "left", "left").join(met.select(F.col("pair").alias("right"), F.col("n").alias("n_right")), "right", "left")
        halves = (F.col("meant") == F.concat("before", "word")) | (F.col("meant") == F.concat("word", "after"))
        fit = with_counts.where(F.col("listed") | F.col("n_left").isNotNull() & F.col("n_right").isNotNull() & ~halves)
        beside = F.log1p(F.coalesce("n_left", F.lit(0))) + F.log1p(F.coalesce("n_right", F.lit(0)))
        best = F.max_by("meant", F.struct(F.col("listed"), -F.col("cost"), beside, F.col("n_meant"), F.col("meant")))
        return fit.groupBy(*place).agg(best.alias("meant"))


def _hashes():
    """An Arrow UDF: the hash of each word, 0 for none."""

    def over(s: pd.Series) -> pd.Series:
        return s.map(lambda w: word_hash(w) if w else 0).astype("int64")

    return F.pandas_udf(over, "long")


def noise(page_texts: DataFrame, records: DataFrame, docs: DataFrame) -> tuple[DataFrame, Model]:
    model = Model(page_texts, records)
    pages = page_noise(with_publication(page_texts, docs), model.broadcast)
    rows = records.where("record_id is not null and text is not null").select("record_id", "element_type", "source_region", "text", "document_title", "series_name", "series_number")
    return checkpoint(pages.unionByName(record_noise(rows, model.broadcast))), model


def found(page_texts: DataFrame, records: DataFrame, docs: DataFrame) -> DataFrame:
    """(src_table, row_key, noise) of every row with scan noise."""
    rows, model = noise(page_texts, records, docs)
    keys = ["src_table", "row_key", "noise"]
    return rows.where("word = ''").select(*keys).unionByName(model.resolved(rows).select(*keys)).distinct()


# --- repair -------------------------------------------------------------

_NEW_PARAGRAPH = re.compile(r"^(?:\d+(?:\.\d+)*\.\s|[A-Z]{1,3}[.–]\d+\.?\s|Requirement \d+:|(?:TABLE|FIG\.|Annex|Appendix)\b|[•▪◦*–]\s|\(?[a-z0-9]{1,3}[.)]\s|\[\d+\])")


def reflow(lines: list[str]) -> str:
    """Lines as paragraphs: a line goes on in the next unless that begins a new element or this ends short after a sentence."""
    lines = [" ".join(x.split()) for x in lines if x.strip()]
    width = max((len(x) for x in lines), default=0)
    out: list[str] = []
    fresh = True
    for x in lines:
        if fresh or _NEW_PARAGRAPH.match(x) or out[-1].isupper() != x.isupper():
            out.append(x)
        else:
            out[-1] += " " + x
        fresh = bool(re.search(r"[.!?:;][”\"’)]*$", x)) and len(x) < 0.8 * width
    return "\n".join(out)


class Repair:
    """Joins broken words, corrects misread ones and drops furniture, with what was found for one row."""

    def __init__(self, words: Words):
        self.words = words

    def text(self, text: str, fixes: list[dict]) -> str:
        """``fixes``: word, before, after and meant of the row; without meant the word is one to be joined."""
        joins = {f["word"] for f in fixes if f["meant"] is None}
        exact = {(f["word"], f["before"], f["after"]): f["meant"] for f in fixes if f["meant"] is not None}

        def join(m: re.Match) -> str:
            a, sign, b = m.groups()
            got = self.words.broken(a, sign, b)
            if got == "yes" or (a + b).lower() in joins:
                return a + b
            return f"{a}-{b}" if b.lower() not in HANGING and "\n" in m.group() else m.group()

        by_word = {w: m for (w, _, _), m in exact.items()}  # where joining or dropping has changed the neighbours
        text = BREAK.sub(join, text)
        out, at = [], 0
        tokens = [(m.start(), m.end(), m.group()) for m in TOKEN.finditer(text)]
        for i, (a, b, t) in enumerate(tokens):
            w = _plain(t.lower())
            sides = (_plain(tokens[i - 1][2].lower()) if i else "", _plain(tokens[i + 1][2].lower()) if i + 1 < len(tokens) else "")
            good = exact.get((w, *sides)) or by_word.get(w)
            if good and w not in self.words.counts:
                upper = [c for c in t if c.isalpha()]
                if upper and all(c.isupper() for c in upper) and len(upper) > 1:
                    good = good.upper()
                elif t[0].isupper():
                    good = good[0].upper() + good[1:]
                out += [text[at:a], good]
                at = b
        return "".join(out) + text[at:]


def repaired(page_texts: DataFrame, records: DataFrame, docs: DataFrame) -> DataFrame:
    """src_table, row_key, noises, text: the rows with noise as continuous paragraphs.

    A key that is repeated with other texts comes out once for each text.
    """
    rows, model = noise(page_texts, records, docs)
    columns = ["src_table", "row_key", "noise", "word", "before", "after", "meant"]
    every = rows.where("word = ''").withColumn("meant", F.lit(None).cast("string")).select(*columns).unionByName(model.resolved(rows).select(*columns))
    # per row: its kinds of noise, and its own words to join or to put right
    per_row = every.groupBy("src_table", "row_key").agg(
        F.array_sort(F.collect_set("noise")).alias("noises"), F.collect_set(F.when(F.col("word") != "", F.struct("word", "before", "after", "meant"))).alias("fixes")
    )
    shared = model.broadcast

    def run_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rep = Repair(shared.value)
        for pdf in batches:
            out = []
            for key, noises, fixes, page, printed, lines, title, series, number in zip(*[pdf[c] for c in ("row_key", "noises", "fixes", "pdf_page", "printed_page", "lines", "title", "series_name", "series_number")]):
                lines = [x or "" for x in lines]
                h, n = furniture(lines, int(page), printed, header_forms(title, series, number))
                body = rep.text("\n".join(x for i, x in enumerate(lines) if i not in h and i not in n), list(fixes))
                out.append(("page_texts", key, list(noises), reflow(body.split("\n"))))
            if out:
                yield pd.DataFrame(out, columns=["src_table", "row_key", "noises", "text"])

    def run_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rep = Repair(shared.value)
        for pdf in batches:
            out = []
            for key, noises, fixes, region, text, title, series, number in zip(*[pdf[c] for c in ("row_key", "noises", "fixes", "source_region", "text", "document_title", "series_name", "series_number")]):
                for spans in (lambda t: record_header(t, title, series, number, region), record_numbers):
                    for a, b in reversed(spans(text)):
                        left = re.sub(r"\s*(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?\s*$", "", text[:a]) if spans is not record_numbers else text[:a]
                        right = re.sub(r"^\s*(?:p\.|[Pp]age|[–—-])?\s*\d{1,4}\s*[–—-]?(?=\s)", "", text[b:]) if spans is not record_numbers else text[b:]
                        text = left.rstrip() + ("\n" if "\n" in text[max(0, a - 1) : a] else " ") + right.lstrip()
                out.append(("records", key, list(noises), reflow(rep.text(text, list(fixes)).split("\n"))))
            if out:
                yield pd.DataFrame(out, columns=["src_table", "row_key", "noises", "text"])

    schema = "src_table string, row_key string, noises array<string>, text string"
    pages = with_publication(page_texts, docs).withColumn("row_key", F.concat("source_file", F.lit("#"), "pdf_page")).join(per_row.where("src_table = 'page_texts'").drop("src_table"), "row_key").mapInPandas(run_pages, schema)
    recs = (
        records.where("record_id is not null and text is not null")
        .select(F.col("record_id").alias("row_key"), "source_region", "text", "document_title", "series_name", "series_number")
        .dropDuplicates(["row_key", "text"])
        .join(per_row.where("src_table = 'records'").drop("src_table"), "row_key")
        .mapInPandas(run_records, schema)
    )
    return pages.unionByName(recs).dropDuplicates(["src_table", "row_key", "text"])
