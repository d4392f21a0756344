"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import let, words_of

#: Rows on which a rule's cost and selectivity are estimated. They decide the order of the rules, never a verdict.
SAMPLE_ROWS = 400
#: Times that the sample is repeated in a timed run, and runs of which the fastest counts.
REPEATS, TRIALS = 4, 2

SYMBOLS = r"[^#*$%&|<>]"


def n_symbols(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x)))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text, first occurrences included.

    Windows are compared by a 64-bit hash of their words. A text whose windows are all distinct costs one pass; else
    the positions are sorted by hash, and each word is counted in the last repeated window that begins before it.
    """

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.when(F.size(w) >= 3, let(F.transform(starts, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])), covered)).otherwise(0)

    def covered(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), places))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"])))
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])), total)

    def total(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.when(k < F.size(p) - 1, F.least(F.lit(3), F.get(p, k + 1) - x)).otherwise(3)), F.lit(0), lambda a, x: a + x)

    return of(words).cast("long")


def base_measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; null has none of anything."""
    t = F.coalesce(text, F.lit(""))
    return let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            n_symbols(t).alias("n_symbols"),
            n_dup_lines(t).alias("n_dup_lines"),
            n_repeat_words(w).alias("n_repeat_words"),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """A rule rejects a document where ``rejects`` is true; null is no rejection."""

    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on measures that ``base_measures`` has put beside the text, and a few on the text itself.

    Bounds are loose on purpose: they are to meet junk only. Words of 1 to 30 characters on average, at most a symbol
    in two words, at most 60 % repeated lines, a tenth of the characters letters at least, and no run of 200
    characters without a blank that repeats one character.
    """
    c, t = F.col, F.coalesce(F.col(text), F.lit(""))
    lines = F.length(t) - F.length(F.translate(t, "\n", "")) + 1
    return [
        Rule("mean_word", (c("word_chars") < c("n_words")) | (c("word_chars") > 30 * c("n_words"))),
        Rule("symbols", 2 * c("n_symbols") > c("n_words")),
        Rule("dup_lines", 10 * c("n_dup_lines") > 6 * lines),
        Rule("letters", 10 * F.length(F.regexp_replace(t, r"\P{L}+", "")) < c("word_chars")),
        Rule("one_character", t.rlike(r"([^\s])\1{199}")),
    ]


def order_by_rejection_per_cost(df: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by (rejected rows) / (seconds) on a sample, best first; a rule that rejects nothing goes by its cost.

    The sample is a bounded number of rows of the first partitions, whose measures are kept. A rule's seconds are the
    least of ``TRIALS`` runs over ``REPEATS`` times the sample, less those of a run without a rule, so that scheduling
    does not count. Only the order depends on it.
    """
    sample = df.limit(rows).persist()

    def run(condition: Column) -> tuple[float, int, int]:
        many = sample.join(F.broadcast(df.sparkSession.range(REPEATS)))  # a stated number of rows
        times = []
        for _ in range(TRIALS):
            began = time.perf_counter()
            n, rejected = many.agg(F.count(F.lit(1)), F.count_if(F.coalesce(condition, F.lit(False)))).first()
            times.append(time.perf_counter() - began)
        return min(times), n, rejected

    try:
        sample.count()
        idle = run(F.lit(False))[0]
        rated = []
        for rule in rules:
            seconds, n, rejected = run(rule.rejects)
            cost = max(seconds - idle, 1e-4)
            rated.append((-(rejected + 1) / (n + 2) / cost, cost, rule))
        return [rule for _, _, rule in sorted(rated, key=lambda x: x[:2])]
    finally:
        sample.unpersist()


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated then."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(out)
    return out


def quality(docs: DataFrame, rules: list[Rule] | None = None, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """Per document the base measures, base_failed, kept and the rule that rejected it (null if kept or base_failed).

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` % repeated words. The cascade
    sees only what the base keeps. One narrow pass over id and text; null texts are empty, texts of any length are
    measured whole, every input row is a row of the result, repeated rows and equal ids included, extra columns are
    ignored, and an empty table gives an empty result. Verdicts do not depend on the order of the rules; of several
    rules that reject a document, ``rejected_by`` names the first of that order.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    m = F.col("_m")
    measured = rows.select("doc_id", "text", base_measures(F.col("text")).alias("_m")).select("doc_id", "text", *[m[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    rules = default_rules() if rules is None else rules
    first = cascade(order_by_rejection_per_cost(measured, rules))
    out = measured.withColumn("base_failed", failed).withColumn("rejected_by", F.when(~F.col("base_failed"), first))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("text")
