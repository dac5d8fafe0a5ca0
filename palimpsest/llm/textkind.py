"""Text statistics and the kind of a text (problem 5), by labelling functions and EM.

The statistics are plain Spark expressions. Thresholds on them are noisy
labelling functions: each votes for prose, list, table or junk, or abstains.
Rows are counted by their pattern of votes; on this table, whose size depends
on the number of functions and not on the rows, expectation-maximization
learns two figures of each function, how often it votes for texts of its kind
and how often for others, from nothing but the agreements: it begins with all
functions alike, and no prior or bound holds the figures. Every pattern then
has a posterior over the kinds.

Defined results: null text gives null statistics and no kind; empty or blank
text has 0 words, shares of 0 and is junk; repeated rows count once in
results by id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import checkpoint

KINDS = ("prose", "list", "table", "junk")

# Common words of running text (English, French, German, Spanish).
COMMON_WORDS = (
    "the of and is are was were be been to in for with by a an on at that this has have had should must may can as not from or its it which where "
    "le la les de des du et est sont dans pour par sur une un aux der die das und ist sind den dem von mit zu im für el los las que en con para por se"
).split()

# Vowels of Latin and Cyrillic letters.
VOWELS = "".join(c + c.upper() for c in "aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿąęěůаеиоуыэюяё")


# What stands in the cells of figures; what a list puts before its entries.
CELL = r"<?\s?[0-9]+(?:\.[0-9]+)?|yes|no|n\.a\.|–"
ENTRY_SIGN = r"(?:[•▪◦‣*–—-]|\(?(?:[0-9]{1,3}|[a-zA-Z]|[ivx]+)[.)])\s+"


def statistics(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with one column per statistic added (all prefixed ``s_``)."""
    t = F.col(text)
    count = lambda p: F.regexp_count(t, F.lit(p)).cast("double")
    # what is not a letter is short, so classes are counted there: what is left when runs of all others are taken out
    only = lambda others: F.length(F.regexp_replace("_rest", others, "")).cast("double")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"\S"))
    space = "[\\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    n_lines = F.size(F.col("_lines")).cast("double")

    def share(pattern: str) -> Column:
        return ratio(F.size(F.filter(F.col("_lines"), lambda x: x.rlike(pattern))).cast("double"), n_lines)

    words = F.regexp_extract_all(F.lower(t), F.lit(r"\p{L}[\p{L}\p{M}'’-]*"), F.lit(0))
    tokens = F.col("_tokens")
    out = (
        rows.withColumn("_lines", lines)
        .withColumn("_words", words)
        .withColumn("_rest", F.regexp_replace(t, r"\p{L}+", ""))
        .withColumn("_tokens", F.filter(F.split(t, space), lambda x: x != ""))
    )
    n_tokens, n_words = F.size(tokens).cast("double"), F.size("_words").cast("double")
    letters = (F.length(t) - F.length("_rest")).cast("double")
    visible = letters + only(space)
    return out.withColumns(
        {
            "s_chars": F.length(t).cast("double"),
            "s_lines": n_lines,
            "s_words": n_words,
            "s_word_length": ratio(F.length(F.array_join("_words", "")).cast("double"), n_words),
            "s_symbols": ratio(only(r"[\p{L}\p{M}\p{N}\s\p{Z}.,;:!?'’“”\"()\-–]+"), visible),
            "s_letters": ratio(letters, visible),
            "s_vowels": ratio((F.length(t) - F.length(F.translate(t, VOWELS, ""))).cast("double"), letters),
            "s_figures": ratio(F.size(F.filter(tokens, lambda x: x.rlike(r"^[(<≤≥±~]*[0-9](?:[0-9.,:%–-]*[0-9%])?$|^n\.a\.$"))).cast("double"), n_tokens),
            "s_common": ratio(F.size(F.filter("_words", lambda x: x.isin(COMMON_WORDS))).cast("double"), n_words),
            "s_distinct": ratio(F.size(F.array_distinct("_words")).cast("double"), n_words),
            "s_single": ratio(F.size(F.filter(tokens, lambda x: F.length(x) == 1)).cast("double"), n_tokens),
            "s_longest": F.coalesce(F.array_max(F.transform(tokens, lambda x: F.length(x))), F.lit(0)).cast("double"),
            "s_line_end": share(r"[.!?][\"”»’')\]]*\s*$"),
            "s_bulleted": share(rf"^\s*{ENTRY_SIGN}\S"),
            "s_cells": share(r"\t|\||\S\s{3}|,(?=\S)"),
            "s_figure_cells": share(rf"(?:^|[\s|,])(?:{CELL})[\s|,]+(?:{CELL})\s*$"),
            "s_leaders": share(r"(?:\.\s?){4,}"),
            "s_short_lines": share(r"^\s*\S+(?:\s+\S+){0,1}\s*$|^\s*[xy] = [0-9]+.*$|^\s*[↑↓→←\s]+$"),
            "s_entries": F.greatest(n_lines, count(";")),
            "s_sentences": count(r"[\p{L}\p{N})”%][.!?][\"”»’')\]]*(?:\s|$)"),
        }
    ).drop("_lines", "_words", "_tokens", "_rest")


STATISTICS = (
    "s_chars s_lines s_words s_word_length s_symbols s_letters s_vowels s_figures s_common s_distinct s_single s_longest s_line_end s_bulleted "
    "s_cells s_figure_cells s_leaders s_short_lines s_entries s_sentences"
).split()


def labelling_functions() -> list[tuple[str, str, Column]]:
    """(name, kind voted for, condition on the statistics)."""
    c = F.col
    # long texts repeat words too, so few words in all are asked for
    repeated = (c("s_distinct") <= 0.25) & (c("s_distinct") * c("s_words") < 20)
    wordy = (c("s_words") >= 3) & (c("s_single") < 0.5) & (c("s_longest") < 40) & (c("s_vowels") > 0.2) & (c("s_symbols") < 0.2)
    return [
        ("common words", "prose", (c("s_common") >= 0.2) & ~repeated & (c("s_words") >= 4) & (c("s_single") < 0.5) & (c("s_short_lines") < 0.6)),
        ("some common words in sentences", "prose", (c("s_common") >= 0.1) & (c("s_sentences") >= 1) & ~repeated & (c("s_single") < 0.5) & (c("s_figure_cells") < 0.5) & (c("s_short_lines") <= 0.5)),
        ("ends as a sentence", "prose", (c("s_sentences") >= 1) & (c("s_line_end") > 0) & (c("s_words") >= 5) & (c("s_letters") > 0.6) & (c("s_leaders") == 0) & (c("s_figure_cells") < 0.5)),
        ("long lines of words", "prose", (c("s_words") / F.greatest(c("s_lines"), F.lit(1.0)) >= 5) & (c("s_figures") < 0.25) & (c("s_single") < 0.3) & (c("s_common") >= 0.1)),
        ("figures in most lines", "table", (c("s_common") < 0.15) & (c("s_lines") >= 2) & (c("s_figure_cells") >= 0.5) & (c("s_short_lines") < 0.5)),
        ("cells in most lines", "table", (c("s_common") < 0.15) & (c("s_lines") >= 2) & (c("s_cells") >= 0.7) & (c("s_figures") + c("s_figure_cells") > 0.1) & (c("s_leaders") < 0.3)),
        ("many figures beside words", "table", (c("s_common") < 0.15) & (c("s_lines") >= 2) & (c("s_figures") >= 0.2) & (c("s_words") >= 6) & (c("s_short_lines") < 0.5) & (c("s_leaders") < 0.3)),
        ("lines with bullets", "list", (c("s_lines") >= 2) & (c("s_bulleted") >= 0.7) & wordy),
        ("short entries", "list", (c("s_entries") >= 2) & wordy & (c("s_common") < 0.08) & (c("s_figures") < 0.15) & (c("s_sentences") == 0) & ~repeated & (c("s_short_lines") < 0.5)),
        ("no sentence at all", "list", wordy & (c("s_sentences") == 0) & (c("s_common") < 0.1) & (c("s_figures") < 0.34) & ~repeated & (c("s_figure_cells") < 0.3) & (c("s_short_lines") < 0.5) & (c("s_leaders") < 0.3)),
        ("dot leaders", "junk", c("s_leaders") >= 0.4),
        ("single letters", "junk", (c("s_single") >= 0.5) & (c("s_chars") > 0)),
        ("symbols", "junk", (c("s_symbols") >= 0.25) | (c("s_letters") < 0.35) & (c("s_figures") < 0.3)),
        ("endless word", "junk", c("s_longest") >= 40),
        ("repetition", "junk", (c("s_words") >= 8) & repeated),
        ("hardly a vowel", "junk", (c("s_vowels") < 0.2) & (c("s_words") >= 2)),
        ("labels of a drawing", "junk", (c("s_lines") >= 3) & (c("s_short_lines") >= 0.6) & (c("s_sentences") == 0) & (c("s_bulleted") < 0.5) & ((c("s_figures") > 0.05) | (c("s_symbols") > 0.1))),
        ("hardly a word", "junk", (c("s_words") <= 1) & (c("s_common") == 0)),
    ]


def votes(stats: DataFrame) -> DataFrame:
    """The rows with their pattern of votes (a string of 0 and 1, one place per function)."""
    return stats.withColumn("pattern", F.concat(*[F.when(cond, "1").otherwise("0") for _, _, cond in labelling_functions()]))


def learn(patterns: list[tuple[str, int]], rounds: int = 500) -> dict[str, np.ndarray]:
    """Posterior over the kinds of each pattern, by EM over the counts of the patterns.

    Of each function two figures are learned: how often it votes where a text
    is of its kind, and how often where it is not. The beginning is the
    agreement itself: a text's first posterior is its share of the votes.
    Votes that were never seen, or always, count half a text more or less.
    """
    lfs = labelling_functions()
    x = np.array([[int(v) for v in p] for p, _ in patterns], float)
    n = np.array([c for _, c in patterns], float)
    own = np.array([KINDS.index(k) for _, k, _ in lfs])
    is_own = np.arange(len(KINDS))[:, None] == own
    votes = x @ is_own.T + 1 / len(KINDS)
    post = votes / votes.sum(1, keepdims=True)
    for _ in range(rounds):
        w = post * n[:, None]
        share = (w.sum(0) + 0.5) / (w.sum() + 0.5 * len(KINDS))
        voted, all_ = w.T @ x, w.sum(0)[:, None]
        hit = ((voted * is_own).sum(0) + 0.5) / ((all_ * is_own).sum(0) + 1)
        miss = ((voted * ~is_own).sum(0) + 0.5) / ((all_ * ~is_own).sum(0) + 1)
        p = np.where(is_own, hit, miss)
        like = x @ np.log(p).T + (1 - x) @ np.log(1 - p).T + np.log(share)
        new = np.exp(like - like.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return {pattern: post[i] for i, (pattern, _) in enumerate(patterns)}


def classified(rows: DataFrame, keep: list[str], *, text: str = "text") -> DataFrame:
    """The columns to keep (texts may be left out) with text_kind and the posterior of each kind.

    The statistics are computed once; the kept columns and the votes are
    written to the shared folder, counted there and read again.
    """
    voted = checkpoint(votes(statistics(rows.where(F.col(text).isNotNull()), text)).select(*keep, "pattern"))
    # rows of this table: patterns of votes, at most 2 ** (number of functions), in practice a few hundred
    table = [(r["pattern"], r["n"]) for r in voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()]
    post = learn(table) if table else {}
    spark = rows.sparkSession
    schema = "pattern string, text_kind string, " + ", ".join(f"p_{k} double" for k in KINDS)
    lookup = spark.createDataFrame([(p, KINDS[int(v.argmax())], *map(float, v)) for p, v in post.items()], schema)
    return voted.join(F.broadcast(lookup), "pattern").drop("pattern")


#: Types of knowledge rows whose kind is asked for.
RUNNING_TYPES = ("paragraph", "requirement", "text_block")


def found(knowledge: DataFrame) -> DataFrame:
    """(stable_internal_id, text_kind) of running records whose text is no prose."""
    rows = knowledge.where(F.col("record_type").isin(*RUNNING_TYPES) & F.col("stable_internal_id").isNotNull()).select("stable_internal_id", "text")
    return classified(rows, ["stable_internal_id"]).where("text_kind <> 'prose'").select("stable_internal_id", "text_kind").distinct()


def quality_table(knowledge: DataFrame) -> DataFrame:
    """Statistics and posteriors of every knowledge row."""
    keep = ["stable_internal_id", "record_type", *STATISTICS]
    return classified(knowledge.select("stable_internal_id", "record_type", "text"), keep).dropDuplicates(["stable_internal_id"])
