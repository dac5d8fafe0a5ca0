"""Text cut off by field limits (problem 8), by a backward character n-gram model.

Two models read lines backwards, character by character, each character given
the five that follow it. One is trained on the running lines, those closed by
a sign, from any place before their end on: what stands before a place where
the text goes on. The other is trained on lines that end openly on purpose,
from their end on: those within texts (headings, entries, rows), and the last
lines of texts, of which each counts by the probability that it is no cut;
that is learned in rounds of expectation and maximization. The final context
of a value is its last line, from the last sentence begun in it on, and the
value is scored by

    log P(last line | the text goes on after it) - log P(last line | it ends there)

which exceeds the threshold of its language and column if the value was cut.
Thresholds are learned: all lines of running text, each cut somewhere, and all
open lines within texts are scored with their own counts taken out, and of all
thresholds that part them as well as the best does, within its standard error
or ``TOLERANCE``, the one nearest 0 is taken. A sign of omission or a broken
character at the end is taken off before.

Counts and thresholds are over all texts; none is left out. Counts are exact. An n-gram is kept by both models if it
makes up more than one in ``MOST_GRAMS`` of all, so no more than that are.

Defined results: null and blank texts are not cut; texts that end with a
closing sign are not cut; a last line of any length is scored whole; repeated
rows of a doc_id give one row; a null or unreadable language is ``und``;
languages with fewer than ``LEAST_LINES`` lines of either kind use the
threshold of all languages together.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import checkpoint, ship_package

#: Characters of an n-gram, bits of a character class.
ORDER, BITS = 6, 10
#: Most n-grams that a model holds; absolute discount; probability of a character of which nothing is known.
MOST_GRAMS, DISCOUNT, UNSEEN = 1 << 20, 0.7, 1 / 300
#: Least number of lines of each kind for a threshold of a language's own.
LEAST_LINES = 30
#: Most texts met again that are broadcast (16 bytes each); more are joined by key, with the same result.
FEW_COPIES = 1 << 16
#: Rounds of expectation and maximization; share of errors by which thresholds may differ and count as equally good.
ROUNDS, TOLERANCE = 2, 0.005
#: Step between thresholds, and the largest one.
STEP, FARTHEST = 0.25, 50.0
#: Texts are worked on in blocks of about this many characters (bounds memory, changes no result).
BLOCK_CHARS = 1_000_000
#: N-grams whose own counts are taken out at once (so many stay in the processor's cache; changes no result).
AT_ONCE = 1 << 14
#: Most n-grams whose counts a task remembers (144 bytes each; changes no result).
REMEMBERED = 1 << 17
#: Orders for which own counts are taken out place by place; for higher ones only where a context comes again in its line (changes no result).
SHORT = 3

CLOSING, BEHIND = frozenset(".!?。！？…:"), "\"”»’')]"
SENTENCE_END = re.compile("[.!?](?<=[a-zß-ɏ]{2}[.!?])[\"”»’')\\]]*\\s+(?=\\S)")
OMISSION = re.compile(r"\s*(?:\[\s*(?:\.\.\.|…)\s*\]|\(\s*(?:\.\.\.|…)\s*\)|\.\.\.|…|�+)\s*$")
_OMITTING = frozenset(".…�])")
GOES_ON, ENDS, VALUE = 0, 1, 2
#: Signs put into lines, and their classes.
FIRST, LATER = "\2", "\3"
OUTSIDE, AFTER_END, BEGINS, BEGINS_LATER = 0, 1, 2, 3


def language(lang: str | None) -> str:
    """Two-letter form of a language code; ``und`` where there is none."""
    code = (lang or "").strip().lower()[:2]
    return {"ge": "de", "sp": "es", "un": "und"}.get(code, code) if re.fullmatch("[a-z]{2}", code) else "und"


def _classes() -> np.ndarray:
    """The class of every character (signs above included): its own for Latin, Greek, Cyrillic and punctuation, that of its block of 512 for others; figures are alike."""
    code = np.arange(0x110000)
    out = 896 + np.minimum(code >> 9, 127)
    at = 0
    for first, last in ((0x0, 0x17F), (0x370, 0x3FF), (0x400, 0x4FF), (0x2000, 0x206F)):
        out[first : last + 1] = at + np.arange(last + 1 - first)
        at += last + 1 - first
    out[ord("0") : ord("9") + 1] = out[ord("0")]
    return out.astype(np.int64)


_CLASS = _classes()


def classes(text: str) -> np.ndarray:
    return _CLASS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _grams(x: np.ndarray) -> np.ndarray:
    """For every place, the n-gram that begins there, put together from pairs: the character to be told in the lowest bits, the last one in the highest."""
    n = max(0, len(x) - ORDER + 1)
    two = x[:-1] | x[1:] << BITS
    out = two[:n].copy()
    for j in range(2, ORDER, 2):
        out |= two[j : j + n] << BITS * j
    return out


def closed(line: str) -> bool:
    """Whether a line (without space at its end) ends with a closing sign, quotation marks and brackets behind it aside."""
    return line.rstrip(BEHIND)[-1:] in CLOSING and line != ""


def whole(text: str) -> tuple[str, bool]:
    """The text without a sign of omission at its end, and whether there was one."""
    text = text.rstrip()
    if text[-1:] not in _OMITTING:
        return text, False
    tail = text[-40:] if text[-1] != "�" else text.rstrip("�") + "�"
    m = OMISSION.search(tail)
    if not m:
        return text, False
    return text[: len(text) - len(tail) + m.start()].rstrip() if tail == text[-40:] else tail[:-1].rstrip(), True


def sentences(line: str) -> list[str]:
    """The sentences of a line, each after a sign that tells whether the line begins with it."""
    out, at = [], 0
    for m in SENTENCE_END.finditer(line):
        out.append((FIRST if not out else LATER) + line[at : m.end()].rstrip())
        at = m.end()
    out.append((FIRST if not out else LATER) + line[at:])
    return out


def pieces(text: str) -> tuple[list[str], list[str], str | None]:
    """Running sentences, open ends within the text, and the open end of the text (None if it is closed or blank), with their signs."""
    running, ending, last = [], [], None
    body, omitted = whole(text)
    lines = body.split("\n")
    for i, line in enumerate(lines):
        line = line.rstrip()
        if not line:
            continue
        parts = sentences(line)
        if i == len(lines) - 1 and (omitted or not closed(line)):
            last = parts.pop()
        elif not closed(line):
            ending.append(parts.pop())
        running += parts
    return running, ending, last


def line_grams(lines: Sequence[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of lines, and the place in the list of the line of each."""
    end = ("\0" if kind == GOES_ON else "\1") * (ORDER - 1)
    x = classes("".join(x + end for x in lines))
    n = max(0, len(x) - ORDER + 1)
    told = np.flatnonzero(x[:n] > AFTER_END)
    return _grams(x)[told], np.cumsum(x[told] <= BEGINS_LATER) - 1


def _ended(grams: np.ndarray) -> np.ndarray:
    """N-grams that reach over the end of a line that goes on, as those of one that ends."""
    out = grams.copy()
    for j in range(1, ORDER):
        out |= np.where((grams >> BITS * j) == OUTSIDE, AFTER_END << BITS * j, 0)
    return out


def _counted(running: list[str], ending: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams to be counted of running lines before their ends, and of open lines from their ends on."""
    x = classes("".join(x[:-1] + "\0" for x in running))
    g, outside = _grams(x), x == OUTSIDE
    inside = ~np.logical_or.reduce([outside[j : j + len(g)] for j in range(ORDER)])
    return g[inside], line_grams(ending, ENDS)[0]


READ = "kind int, gram long, n double, doc_id long, lang string, omitted boolean, line string, text_key long"
_NAMES = [c.split()[0] for c in READ.split(", ")]


def read_texts(texts: DataFrame, with_last: bool) -> DataFrame:
    """One reading of (doc_id, lang, text, text_key): partial counts of n-grams and, if asked for, last lines."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def counts(parts: list[tuple[np.ndarray, np.ndarray]], kind: int) -> pd.DataFrame:
            keys, n = _merged(parts)
            return pd.DataFrame({"kind": np.full(len(keys), kind, np.int32), "gram": keys, "n": n}).assign(doc_id=None, lang=None, omitted=None, line=None, text_key=None)

        totals: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        running, ending, lines, size = [], [], [], 0
        for pdf in batches:
            for doc, lang, t, key in zip(*[pdf[c].tolist() for c in ("doc_id", "lang", "text", "text_key")]):
                t = t.translate(_MARKS) if _CONTROL.search(t) else t
                a, b, last = pieces(t)
                running += a
                ending += b
                if with_last and last is not None:
                    lines.append((VALUE, doc, language(lang if isinstance(lang, str) else None), whole(t)[1], last, key))
                size += len(t)
                if size > BLOCK_CHARS:
                    for kind, g in enumerate(_counted(running, ending)):
                        totals[kind].append(np.unique(g, return_counts=True))
                        if sum(len(k) for k, _ in totals[kind]) > 2 * MOST_GRAMS:
                            totals[kind] = [_merged(totals[kind])]
                        if len(totals[kind][0][0]) > MOST_GRAMS:  # partial counts: bounds memory
                            yield counts(totals[kind], kind)
                            totals[kind] = []
                    running, ending, size = [], [], 0
            if lines:
                yield pd.DataFrame([(k, None, None, *rest) for k, *rest in lines], columns=_NAMES)
                lines = []
        for kind, g in enumerate(_counted(running, ending)):
            yield counts([*totals[kind], np.unique(g, return_counts=True)], kind)

    return texts.mapInPandas(read, READ)


_CONTROL = re.compile("[\x00-\x03]")
_MARKS = dict.fromkeys(range(4), " ")


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys))


class Backward:
    """Interpolated probabilities of characters given those that follow, from counts of n-grams."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.orders = []
        for k in range(1, ORDER + 1 if len(grams) else 1):
            keys, n_keys = _merged([(grams & ((1 << BITS * k) - 1), n)])
            context, at = np.unique(keys >> BITS, return_inverse=True)
            self.orders.append((keys, n_keys, context, np.bincount(at, n_keys, len(context)), np.bincount(at, minlength=len(context)).astype(float)))
        self.known = np.zeros(1, np.int64), self._look_up(np.zeros(1, np.int64))

    def log_p(self, grams: np.ndarray, line: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log P of the lowest character of each n-gram; what its line added to the counts, ``own`` times, is taken out."""
        return self.log_p_of(*np.unique(grams, return_inverse=True), line, own)

    def _look_up(self, met: np.ndarray) -> np.ndarray:
        """By order: how often each n-gram was met, how often its context, and before how many characters."""
        out = np.zeros((len(self.orders), 3, len(met)))
        for k, (keys, n_keys, context, n_context, distinct) in enumerate(self.orders, 1):
            g = met & ((1 << BITS * k) - 1)
            i = np.minimum(np.searchsorted(context, g >> BITS), len(context) - 1)
            j = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            out[k - 1] = np.where(keys[j] == g, n_keys[j], 0), np.where(context[i] == g >> BITS, n_context[i], 0), distinct[i]
        return out

    def _found(self, met: np.ndarray) -> np.ndarray:
        """The same; what was looked up before is remembered, for ``REMEMBERED`` n-grams or those of one block."""
        known, of_known = self.known
        i = np.searchsorted(known[:-1], met)
        new = np.flatnonzero(known[i] != met)
        if len(known) + len(new) > REMEMBERED:
            self.known = met, self._look_up(met)
            return self.known[1]
        of_new = self._look_up(met[new])
        if len(new) <= len(met) // 32:
            out = np.take(of_known, i, 2)
            out[:, :, new] = of_new
            return out
        known = np.append(known, met[new])
        order = np.argsort(known)
        self.known = known[order], np.take(np.append(of_known, of_new, 2), order, 2)
        return np.take(self.known[1], np.searchsorted(self.known[0], met), 2)

    def log_p_of(self, met: np.ndarray, at: np.ndarray, line: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The same for the n-grams ``met[at]``; each is looked up once."""
        found = self._found(met) if len(met) else np.zeros((0, 3, 0))
        if not own.any():
            p = np.full(len(met), UNSEEN)
            for c, n, d in found:
                p = _interpolated(p, c, n, d)
            return np.log(np.maximum(p, 1e-30))[at]
        # where the context of SHORT characters stands once in its line, so do all longer ones: p = plus + factor * (p by shorter ones), the same for all such places
        plus, factor = np.zeros(len(met)), np.ones(len(met))
        for c, n, d in found[SHORT:]:
            c, n, d = _without(c, n, d, 1.0, 1.0)
            a, b = _interpolated(0.0, c, n, d), _interpolated(1.0, c, n, d)
            plus, factor = a + (b - a) * plus, (b - a) * factor
        out, beginnings = np.empty(len(at)), _first_highest(met)
        ends = [*np.flatnonzero(np.diff(line)) + 1, len(at)]  # of lines
        first = 0
        while first < len(at):
            last = ends[max(bisect_right(ends, first + AT_ONCE) - 1, bisect_right(ends, first))]
            a, times = at[first:last], own[first:last]
            repeats = _repeats(*beginnings, a, line[first:last])
            closes = np.append(np.flatnonzero(np.diff(line[first:last])), last - first - 1)
            contexts = [repeats[0]]
            for x in repeats[1:ORDER]:  # what follows a character is an n-gram of the next place; only the end of the line follows the last one
                contexts.append(np.append(x[1:], 1))
                contexts[-1][closes] = 1
            p = np.full(len(a), UNSEEN)
            for k, of in enumerate(found[:SHORT]):
                p = _interpolated(p, *_without(*(x[a] for x in of), times * repeats[k + 1], times * contexts[k]))
            again = np.flatnonzero((contexts[SHORT] > 1) | (times != 1))
            p_again, times, of_again = p[again], times[again], a[again]
            for k, of in enumerate(found[SHORT:], SHORT):
                p_again = _interpolated(p_again, *_without(*(x[of_again] for x in of), times * repeats[k + 1][again], times * contexts[k][again]))
            p = plus[a] + factor[a] * p
            p[again] = p_again
            out[first:last] = np.log(np.maximum(p, 1e-30))
            first = last
        return out


def _without(c: np.ndarray, n: np.ndarray, d: np.ndarray, mine: np.ndarray | float, mine_context: np.ndarray | float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of n-grams, of their contexts, and of the characters before these, with those of a line itself taken out."""
    mine = np.minimum(mine, c)
    c = c - mine
    return c, np.maximum(n - np.maximum(mine_context, mine), 0), d - ((mine > 0) & (c < 1e-6))


def _interpolated(p: np.ndarray | float, c: np.ndarray, n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Probabilities by n-grams met c times, their contexts n times before d characters, from those by n-grams one shorter."""
    d = DISCOUNT * d
    better = (np.maximum(c - DISCOUNT, 0) + d * p) / np.maximum(n, 1e-9)
    return np.where(n > np.maximum(np.maximum(c, d) - 1e-9, 0.5), better, p)


def _first_highest(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams with the first character in the highest bits, so that equal beginnings stand together when they are sorted, and the rank of each."""
    out, rank = np.zeros_like(grams), np.empty(len(grams), np.int64)
    for j in range(ORDER):
        out |= ((grams >> BITS * j) & ((1 << BITS) - 1)) << BITS * (ORDER - 1 - j)
    rank[np.argsort(out)] = np.arange(len(grams))
    return out, rank


def _repeats(first: np.ndarray, rank: np.ndarray, at: np.ndarray, line: np.ndarray) -> list[np.ndarray]:
    """How often the first k characters, for k from 0 to ``ORDER``, of the n-gram ``at`` each place stand in its line."""
    order = np.argsort(line * len(rank) + rank[at])
    first, line = first[at[order]], line[order]
    differs = np.where(line[1:] != line[:-1], 1 << BITS * ORDER, first[1:] ^ first[:-1])
    differs = np.append(1 << BITS * ORDER, differs)
    n = np.diff(np.flatnonzero(differs >= 1 << BITS * ORDER), append=len(at))  # lines stay in their order
    out = [np.repeat(n, n)]
    for k in range(1, ORDER + 1):
        n = np.diff(np.flatnonzero(differs >= 1 << BITS * (ORDER - k)), append=len(order))
        out.append(np.ones(len(at), np.int64))
        n = np.repeat(n, n)
        out[k][order] = n
        again = np.flatnonzero(n > 1)  # what stands there once does so with more characters
        order, differs = order[again], differs[again]
    return out


Counts = dict[int, tuple[np.ndarray, np.ndarray]]


class CutModel:
    """Scores lines; without a round of learning yet, last lines stand beside the open lines in a model of their own."""

    def __init__(self, counts: Counts, values: tuple[np.ndarray, np.ndarray], mixed: bool):
        self.goes_on = Backward(*counts[GOES_ON])
        self.ends = [Backward(*counts[ENDS]), Backward(*values)] if mixed else [Backward(*_merged([counts[ENDS], values]))]

    def log_odds(self, lines: Sequence[str], kind: int, own: np.ndarray | float = 1.0) -> np.ndarray:
        """log P(line | goes on) - log P(line | ends) of each line; ``own``: how often the line was counted, as one of its kind."""
        if not lines:
            return np.zeros(0)
        g, line = line_grams(lines, GOES_ON)
        # the other model reads the same n-grams, but for those that reach over the end
        over = np.flatnonzero(g >> BITS * (ORDER - 1) == OUTSIDE)
        met, at = np.unique(np.append(g, _ended(g[over])), return_inverse=True)
        at_ends = at[: len(g)].copy()
        at_ends[over] = at[len(g) :]
        own, nothing = np.broadcast_to(own, len(lines))[line], np.zeros(len(g))

        def log_p(model: Backward, at: np.ndarray, of: int) -> np.ndarray:
            return np.bincount(line, model.log_p_of(met, at, line, own if kind == of else nothing), len(lines))

        goes_on = log_p(self.goes_on, at[: len(g)], GOES_ON)
        if len(self.ends) == 1:
            return goes_on - log_p(self.ends[0], at_ends, ENDS if kind == ENDS else VALUE)
        inner, last = (log_p(m, at_ends, k) for m, k in zip(self.ends, (ENDS, VALUE)))
        return goes_on - np.logaddexp(inner, last) + np.log(2)


def last_line(text: str) -> str | None:
    """The open end of a text, from its last sentence on."""
    last = pieces(text)[2]
    return last if last is None else last[1:]


def _spread(x: int) -> int:
    return ((x * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> 32


def best_threshold(goes_on: np.ndarray, ends: np.ndarray, n_goes_on: np.ndarray | None = None, n_ends: np.ndarray | None = None) -> float:
    """The threshold nearest 0 among those whose share of lines on the wrong side is within one standard error, or ``TOLERANCE``, of the least; ``n_``: lines of each score (1)."""
    n_goes_on, n_ends = (np.ones(len(x)) if n is None else n for x, n in ((goes_on, n_goes_on), (ends, n_ends)))
    steps = np.arange(-FARTHEST, FARTHEST + STEP, STEP)
    missed, wrong = (np.array([n[side(t)].sum() for t in steps]) for n, side in ((n_goes_on, lambda t: goes_on <= t), (n_ends, lambda t: ends > t)))
    a, b = (missed + 1) / (n_goes_on.sum() + 2), (wrong + 1) / (n_ends.sum() + 2)
    i = (a + b).argmin()
    error = max(TOLERANCE, np.sqrt(a[i] * (1 - a[i]) / n_goes_on.sum() + b[i] * (1 - b[i]) / n_ends.sum()))
    good = steps[a + b <= a[i] + b[i] + error]
    return float(good[np.abs(good).argmin()])


def score_counts(texts: DataFrame, model: Broadcast) -> DataFrame:
    """lang, kind, b, n: of (lang, text, text_key, copies), how many running lines, each cut somewhere, and open lines within texts score about b; the lines of a text that is met again count once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: Counter = Counter()  # at most languages x 2 x steps
        lines: tuple[list, list] = [], []  # of GOES_ON and ENDS

        def count() -> None:
            for kind, of in enumerate(lines):
                if of:
                    x, lang, copies = zip(*of)
                    odds = model.value.log_odds(x, kind, np.array(copies, float))
                    b = np.clip(np.round(odds / STEP) * STEP, -FARTHEST, FARTHEST)
                    for key in zip(lang, b.tolist(), copies):
                        totals[kind, *key] += 1
                    of.clear()

        size = 0
        for pdf in batches:
            for lang, t, key, copies in zip(*[pdf[c].tolist() for c in ("lang", "text", "text_key", "copies")]):
                t = t.translate(_MARKS) if _CONTROL.search(t) else t
                running, ending, _ = pieces(t)
                code = language(lang if isinstance(lang, str) else None)
                for i, x in enumerate(running):
                    if len(x) > 2:
                        lines[GOES_ON].append((x[: 2 + _spread(key + i) % (len(x) - 2)].rstrip(), code, copies))
                lines[ENDS].extend((x, code, copies) for x in ending)
                size += len(t)
                if size > BLOCK_CHARS:
                    count()
                    size = 0
        count()
        yield pd.DataFrame([(lang, kind, b, n / copies) for (kind, lang, b, copies), n in totals.items()], columns=["lang", "kind", "b", "n"])

    return texts.mapInPandas(run, "lang string, kind int, b double, n double")


def thresholds(counts: DataFrame) -> dict[str, float]:
    """Threshold by language, and of all languages under the empty word, from the numbers of lines of both kinds by score."""
    table = counts.groupBy("lang", "kind", "b").agg(F.round(F.sum("n"), 6).alias("n")).toPandas()  # at most languages x 2 x steps rows
    out = {}
    for lang, of in [("", table), *table.groupby("lang")]:
        (goes_on, n_goes_on), (ends, n_ends) = ((x["b"].to_numpy(float), x["n"].to_numpy(float)) for k in (GOES_ON, ENDS) for x in [of[of["kind"] == k]])
        if lang == "" or min(n_goes_on.sum(), n_ends.sum()) >= LEAST_LINES:
            out[lang] = best_threshold(goes_on, ends, n_goes_on, n_ends) if len(goes_on) and len(ends) else 0.0
    return out


def _kept(grams: DataFrame) -> Counts:
    """The n-grams of each kind that make up more than one in ``MOST_GRAMS``, so at most so many of each kind."""
    total = {r["kind"]: r["n"] for r in grams.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*[F.lit(float(x)) if i % 2 else F.lit(x) for kv in total.items() for i, x in enumerate((kv[0], kv[1] / MOST_GRAMS))])[F.col("kind")] if total else F.lit(0.0)
    rows = grams.where(F.col("n") > least).toPandas()
    return {k: (of["gram"].to_numpy(np.int64), of["n"].to_numpy(float)) for k in (GOES_ON, ENDS, VALUE) for of in [rows[rows["kind"] == k]]}


def _weight(log_odds: np.ndarray) -> np.ndarray:
    """Probability that a last line is no cut."""
    return 1 / (1 + np.exp(np.clip(log_odds, -50, 50)))


def scored(documents: DataFrame, *, column: str = "text") -> DataFrame:
    """doc_id, lang, log_odds, threshold, omitted, cut of every text that does not end with a closing sign."""
    spark = documents.sparkSession
    ship_package(spark)
    rows = documents.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang", F.col(column).alias("text"), F.xxhash64(column).alias("text_key"))
    read = checkpoint(read_texts(rows, True))
    owners = read.where("gram is null").select("doc_id", "lang", "omitted", "text_key")
    # a text met again counts once, or its odd words would speak for it
    lines = read.where("gram is null").groupBy("text_key").agg(F.min("line").alias("line")).withColumn("log_odds", F.lit(0.0))
    counts = _kept(read.where("gram is not null").groupBy("kind", "gram").agg(F.sum("n").alias("n")))

    def weighed(of: DataFrame, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the last lines, each by its probability to be no cut (in the first round, by 1)."""

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                g, line = line_grams(pdf["line"].tolist(), VALUE)
                keys, n = _merged([(g, np.ones(len(g)) if first else _weight(pdf["log_odds"].to_numpy())[line])])
                yield pd.DataFrame({"kind": np.full(len(keys), VALUE, np.int32), "gram": keys, "n": n})

        got = of.select("line", "log_odds").mapInPandas(count, "kind int, gram long, n double")
        return _kept(got.groupBy("kind", "gram").agg(F.sum("n").alias("n")))[VALUE]

    def score(of: DataFrame, first: bool) -> tuple[DataFrame, Broadcast]:
        model = spark.sparkContext.broadcast(CutModel(counts, weighed(of, first), first))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                own = 1.0 if first else _weight(pdf["log_odds"].to_numpy())
                yield pdf.assign(log_odds=model.value.log_odds(pdf["line"].tolist(), VALUE, own))

        return checkpoint(of.mapInPandas(run, "text_key long, line string, log_odds double")), model

    lines, model = score(lines, True)
    for _ in range(ROUNDS):
        lines, model = score(lines, False)
    copies = checkpoint(rows.groupBy("text_key").agg(F.count("*").alias("copies")).where("copies > 1"))
    few = copies.count() <= FEW_COPIES  # then the texts need no shuffle
    learned = thresholds(score_counts(rows.join(F.broadcast(copies) if few else copies, "text_key", "left").fillna(1, ["copies"]), model))
    limit = F.coalesce(F.create_map(*[F.lit(x) for kv in learned.items() for x in kv])[F.col("lang")], F.lit(learned[""]))
    values = owners.join(lines.select("text_key", "log_odds"), "text_key").withColumn("threshold", limit)
    return values.withColumn("cut", F.col("log_odds") > F.col("threshold")).select("doc_id", "lang", "log_odds", "threshold", "omitted", "cut")


def found(documents: DataFrame) -> DataFrame:
    """(doc_id) of the texts that were cut off."""
    return scored(documents).where("cut").select("doc_id").distinct()


def truncation_by_source(documents: DataFrame) -> DataFrame:
    """Per source: number of texts, of cut texts, their share, and the most common length of a cut text."""
    cut = found(documents).withColumn("cut", F.lit(1))
    base = documents.where("doc_id is not null").select("doc_id", "source", "n_chars").dropDuplicates(["doc_id"]).join(cut, "doc_id", "left")
    per_length = base.groupBy("source", "n_chars").agg(F.count("*").alias("n"), F.count("cut").alias("c"))
    return per_length.groupBy("source").agg(
        F.sum("n").alias("n_texts"), F.sum("c").alias("n_cut"), (F.sum("c") / F.sum("n")).alias("cut_share"),
        F.max_by("n_chars", F.struct("c", "n_chars")).alias("usual_cut_length"),
    )
