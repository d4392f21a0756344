"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import bounded_batches, materialize
from clinicweave.llm.tokens import groups

#: Labelled rows that are used to learn, at most: the bound of the training sample.
MAX_TRAINING_ROWS = 12_000
#: Terms of the lexicon at most; the first STRONG_TERMS of them make a density of their own.
MAX_TERMS, STRONG_TERMS = 400, 60
PREFIXES = (4, 5, 6, 7)
#: Least z-score of a term's log odds between toxic and clean documents.
LEAST_Z = 2.5
#: A term is at least so many times as frequent in toxic documents.
LEAST_LIFT = 10.0
#: And it stands in this share of them, and in two at least.
LEAST_SHARE = 0.015
#: Score from which a document is called toxic.
THRESHOLD = 0.7

# Words that address the reader, in the languages of the corpus.
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "usted", "ustedes", "vosotros")
# Characters that stand for letters in disguised words.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

FEATURES = ("strong_density", "strong_log", "weak_density", "weak_log", "disguised_hits", "disguised_rate", "near_second_person", "second_person", "capitals", "shouted", "exclamations", "questions", "punctuation", "word_length", "log_words")

_WORD = re.compile(r"[^\W\d_]+")
#: Starts at the beginning of a run of letters and gives nothing back, so that it is linear in any text.
_DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!|*._-]++[^\W\d_]++)++")
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


class Lexicon(dict):
    """Word -> 2 for a strong term, 1 for a weak one, 0 else; a bounded memo over sets of words and prefixes."""

    def __init__(self, strong: list[str], weak: list[str]):
        super().__init__()
        self.terms = {t: 1 for t in weak} | {t: 2 for t in strong}

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        hit = max(self.terms.get(word, 0), *(self.terms.get(word[:k] + "*", 0) for k in PREFIXES if len(word) > k), 0)
        self[word] = hit
        return hit


def text_features(text: str, lexicon: Lexicon, second: frozenset[str] = frozenset(SECOND_PERSON)) -> list[float]:
    """The dense features of a whole text, in the order of ``FEATURES``."""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    hits = list(map(lexicon.__getitem__, words))
    strong, weak = hits.count(2), hits.count(1)
    persons = sum(map(second.__contains__, words))
    near = 0
    if strong and persons:
        at = np.flatnonzero(np.array(hits) == 2)
        near = sum(1 for i in at.tolist() if not second.isdisjoint(words[max(0, i - 4) : i + 5]))
    disguised = _DISGUISED.findall(text)
    bare = (re.sub(r"[*._-]+", "", w.lower().translate(LOOKALIKES)) for w in disguised)
    disguised_hits = sum(lexicon[w] == 2 for w in bare)
    raw = text.encode("utf-8", "replace")
    chars = max(1, len(raw))
    letters = max(1, chars - len(raw.translate(None, _LETTERS)))
    return [
        strong / n, math.log1p(strong), weak / n, math.log1p(weak), float(disguised_hits), len(disguised) / n, near / n, persons / n,
        (chars - len(raw.translate(None, _CAPITALS))) / letters, len(_SHOUTED.findall(text)) / n,
        raw.count(b"!") / chars, raw.count(b"?") / chars, (chars - len(raw.translate(None, _PUNCTUATION))) / chars, letters / n, math.log1p(len(words)),
    ]


def with_features(rows: DataFrame, strong: list[str], weak: list[str]) -> DataFrame:
    """``features`` (array of doubles) in place of ``text``; the other columns pass. A narrow Arrow map."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(strong, weak)
        for batch in batches:
            at = 0
            for group in groups(batch.column("text")):
                values = np.array([text_features(t, lexicon) for t in group], np.float64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32)), pa.array(values.ravel()))
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists], [*kept, "features"])
                at += len(group)

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", features array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: 1 is held out, 0 teaches the lexicon, 2 the trees and the calibration."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(fold, toxic, text) of at most about ``most`` labelled rows outside the held-out fold, chosen by a hash of the id.

    An id with both labels counts as toxic.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, most / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # about ``most`` rows
    return materialize(rows.select(fold(F.col("doc_id")).alias("fold"), "toxic", "text"), "toxicity-training")


def _beginnings(words: Column, k: int) -> Column:
    """Distinct first ``k`` letters of longer words, with a star."""
    longer = F.filter(words, lambda x: F.length(x) > k)
    return F.array_distinct(F.transform(longer, lambda x: F.concat(F.substring(x, 1, k), F.lit("*"))))


def learn_lexicon(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Words and beginnings of words (written with a star) that mark toxic documents, strong and weak.

    Document frequencies by label, copies of a text counted once; a term needs a z-score of its log odds and a lift, and
    terms rank by the toxic documents that hold them. At most ``MAX_TERMS`` terms reach the driver.
    """
    texts = rows.dropDuplicates(["text"])
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    beginnings = [_beginnings(F.col("w"), k) for k in PREFIXES]
    terms = texts.select("toxic", words.alias("w")).select("toxic", F.explode(F.concat("w", *beginnings)).alias("term"))
    found = terms.groupBy("term").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).filter(F.col("pos") >= max(2.0, LEAST_SHARE * n1))
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(pos / (n1 - F.col("pos") + 0.5)) - F.log(neg / (n0 - F.col("neg") + 0.5))
    z = odds / F.sqrt(1 / pos + 1 / neg)
    lift = pos / (n1 + 1) >= LEAST_LIFT * neg / (n0 + 1)
    best = found.withColumn("z", z).filter((F.col("z") >= LEAST_Z) & lift).orderBy(F.desc("pos"), F.desc("z"), "term").limit(MAX_TERMS).collect()
    ranked = [r["term"] for r in best]
    return ranked[:STRONG_TERMS], ranked[STRONG_TERMS:]


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, strong, weak, trees, calibration):
        self.strong, self.weak, self.trees, self.calibration = strong, weak, trees, calibration

    def score(self, rows: DataFrame) -> DataFrame:
        """``score`` in place of ``text``."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        kept = [c for c in rows.columns if c != "text"]
        x = with_features(rows, self.strong, self.weak).withColumn("features", array_to_vector("features"))
        margin = vector_to_array("probability")[1]
        x = self.trees.transform(x).select(*kept, margin.alias("margin"))
        x = self.calibration.transform(x)
        return x.select(*kept, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> Model | None:
    """Learn from the labelled rows outside the held-out fold; None where they hold one class only.

    The lexicon comes from fold 0 and everything else from fold 2, so that the trees see densities of a lexicon that
    was not fitted to their rows; the trees learn from two thirds of fold 2 and the calibration from the rest.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    rows = training_rows(docs, labels, most)
    part = F.pmod(F.xxhash64("text"), F.lit(3))
    strong, weak = learn_lexicon(rows.filter("fold = 0"))
    table = with_features(rows.filter("fold = 2").select("toxic", (part == 0).alias("last"), "text"), strong, weak)
    table = materialize(table.coalesce(6), "toxicity-features")
    seen = {(r["last"], r["toxic"]) for r in table.select("last", "toxic").distinct().collect()}
    if len({t for _, t in seen}) < 2:
        return None
    split = len(seen) == 4
    learn = table.filter("not last") if split else table
    check = table.filter("last") if split else table
    vectors = lambda df: df.select(F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features"))
    trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, minInstancesPerNode=3, seed=7, maxBins=32).fit(vectors(learn).coalesce(2))
    margins = trees.transform(vectors(check)).select("label", vector_to_array("probability")[1].alias("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margins.coalesce(2))
    return Model(strong, weak, trees, calibration)


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Per document: doc_id, held_out (its fold is 1), score in [0, 1], predicted (1 if score >= threshold).

    Only the text enters a score; null texts are empty and are scored too; a text of any length is scored whole, in
    time linear in it. Every input row is a row of the result, repeated rows and equal ids included; a null id is not
    held out; extra columns are ignored; an empty table gives an empty result. Without both classes among the labels, every score is their share of toxic ones, or 0.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    model = fit(docs, labels, most)
    if model is None:
        share = labels.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 1)).agg(F.avg("toxic").cast("double")).first()[0] or 0.0
        scored = rows.select("doc_id", F.lit(float(share)).alias("score"))
    else:
        scored = model.score(rows)
    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not called toxic, with all their columns."""
    threshold = options.pop("threshold", THRESHOLD)
    model = fit(docs, labels, **options)
    if model is None:
        return docs
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = bounded_batches(docs).toDF(*names)
    body = names[docs.columns.index("text")]
    scored = model.score(renamed.withColumn("text", F.coalesce(body, F.lit(""))))
    return scored.filter(F.col("score") < threshold).select(*names).toDF(*docs.columns)
