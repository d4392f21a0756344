"""Verdicts on URLs: rules by host and path, else naive Bayes over the words that host and path are made of."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import materialize, sized_batches

#: Words that the models know: so many at most, the most frequent ones that occur ``LEAST_COUNT`` times or more. The bound
#: makes the model one that every worker can hold; other words are one token, ``UNKNOWN``.
MAX_WORDS, LEAST_COUNT = 100_000, 3
#: Longest word that a name is split into, in characters.
LONGEST_WORD = 24
#: Rules that are matched by lookups in a table that every worker holds.
MAX_RULES = 1_000_000
#: A host is judged by its words alone at this posterior probability of the class ``block``.
THRESHOLD = 0.5
#: Tokens that stand for all numbers and for all words that the model does not know.
NUMBER, UNKNOWN = "#", "?"

# Words of trades that a crawl for training data leaves out. A host with one of them is a training example
# of the class to block, any other host one of the class to allow.
SEEDS = frozenset(
    "casino casinos poker roulette slots jackpot lottery bet bets betting gamble gambling bingo "
    "pills pill pharmacy viagra cialis xanax tramadol steroids weightloss "
    "adult porn porno xxx sex sexy nude nudes escort escorts webcam hentai milf erotic "
    "ads adserver adservice banner banners popup popups clicks tracker trackers "
    "spam spammer malware phishing warez keygen cracks torrent torrents backlinks linkfarm doorway "
    "payday loans forex replica counterfeit".split()
)
#: Times that a seed word counts at least, so that names are split at it, in words of the whole table.
SEED_SHARE = 1e-6

_TOKEN = re.compile(r"[^\W\d_]+|\d+")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path begins with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules of lines like ``block example.com/de/``; a later rule for the same place replaces an earlier one."""
    rules = {}
    for line in lines:
        verdict, place = line.split(None, 1)
        if verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {line}")
        host, slash, path = place.strip().partition("/")
        rules[place.strip()] = Rule(host, slash + path, verdict)
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return list(rules.values())


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands between the host and the next ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Rules:
    """The longest rule that fits, by a lookup for each suffix of a host that begins behind a dot."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.path), r.path)):
            self.by_host.setdefault(r.host, []).append(r)

    def fitting(self, host: str, path: str) -> Rule | None:
        best, at = None, 0
        while host:
            for r in self.by_host.get(host[at:], ()):
                if path.startswith(r.path):
                    if best is None or len(r.text) > len(best.text):
                        best = r
                    break
            at = host.find(".", at) + 1
            if not at:
                break
        return best


class Words:
    """A unigram model that splits names written together, by Viterbi over the ends of words.

    A known word of count c costs ``-log(c / total)``. Characters that no known word covers form unknown words, which
    cost ``log(total)`` each and ``log(10)`` a character besides, so that a name of rare make stays one word.
    """

    def __init__(self, counts: dict[str, int]):
        total = float(sum(counts.values()) or 1)
        floor = max(total * SEED_SHARE, 1.0)
        known = dict.fromkeys(SEEDS, floor) | {w: max(c, floor) if w in SEEDS else float(c) for w, c in counts.items()}
        total += floor * len(SEEDS)
        self.costs = {w: math.log(total / c) for w, c in known.items() if len(w) <= LONGEST_WORD}
        self.per_word, self.per_character = math.log(total), math.log(10)
        self.longest = max(map(len, self.costs))

    def split(self, name: str) -> list[str]:
        """The cheapest words that make up ``name``, ties to the later, longer last word; unknown stretches as they are."""
        n = len(name)
        # best[i][0]: cost of the first i characters with a known word at the end, [1]: with an unknown one.
        cost = [[0.0, math.inf]] + [[math.inf, math.inf] for _ in range(n)]
        came = [[(0, 0), (0, 0)] for _ in range(n + 1)]
        for i in range(1, n + 1):
            for size in range(1, min(self.longest, i) + 1):
                if (word := self.costs.get(name[i - size : i])) is not None:
                    for kind in (0, 1):
                        if (c := cost[i - size][kind] + word) <= cost[i][0]:
                            cost[i][0], came[i][0] = c, (i - size, kind)
            opened, carried = cost[i - 1][0] + self.per_word + self.per_character, cost[i - 1][1] + self.per_character
            cost[i][1] = min(opened, carried)
            came[i][1] = (i - 1, 0) if opened < carried else (i - 1, 1)
        out, at, kind = [], n, int(n > 0 and cost[n][1] < cost[n][0])
        while at:
            start, before = came[at][kind]
            if kind:  # an unknown word goes on to where it was opened
                while before:
                    start, before = came[start][1]
            out.append(name[start:at])
            at, kind = start, before
        return out[::-1]

    def tokens(self, text: str) -> list[str]:
        """Known words, ``NUMBER`` and ``UNKNOWN`` of a host or path, in order; other characters separate."""
        out = []
        for run in _TOKEN.findall(text.lower()):
            if run[0].isdigit():
                out.append(NUMBER)
            else:
                out += [w if w in self.costs else UNKNOWN for w in self.split(run)]
        return out


def count_words(texts: DataFrame, column: str, *, max_words: int = MAX_WORDS, least: int = LEAST_COUNT) -> dict[str, int]:
    """Words of letters outside of tags, lower-cased, with their counts over all rows: the most frequent ones.

    Counts are a partial aggregate, written once. They fall into classes, eight for each doubling of the count, and the
    model takes whole classes, the most frequent first, as long as ``max_words`` holds them: which words it knows
    depends on no order of rows, and the driver gets the classes' sizes and the words that are taken, whatever the
    number of tasks.
    """
    plain = F.regexp_replace(F.coalesce(column, F.lit("")), r"(?s)<[^>]*>", " ")
    words = texts.select(F.explode(F.split(F.lower(plain), r"\P{L}+")).alias("w")).filter(F.length("w").between(1, LONGEST_WORD))
    counts = materialize(words.groupBy("w").count().filter(F.col("count") >= least).withColumn("class", F.floor(F.log2("count") * 8).cast("int")), "words")
    lowest, total = 1 << 30, 0
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("class")).collect():
        total += r["n"]
        if total > max_words:
            break
        lowest = r["class"]
    return {r["w"]: r["count"] for r in counts.filter(F.col("class") >= lowest).collect()}


def _distinct_tokens(words: Words, texts: pa.Array) -> tuple[np.ndarray, list[list[str]]]:
    """Place of each row's text among the different ones, and the tokens of these: a text is split once a batch."""
    coded = texts.dictionary_encode()
    return np.asarray(coded.indices), [words.tokens(t) for t in coded.dictionary.to_pylist()]


def count_tokens(places: DataFrame, words: Words) -> tuple[dict[str, list[int]], list[int]]:
    """Tokens of all (host, path) by class, and rows by class: (allow, block).

    Every row is a training example whose class its host's words give. A task emits one row a token that the model
    knows, and the driver gets the vocabulary's rows.
    """
    shared = places.sparkSession.sparkContext.broadcast(words)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tokens, rows = (Counter(), Counter()), [0, 0]
        for batch in batches:
            (hosts, host_tokens), (paths, path_tokens) = (_distinct_tokens(known, batch.column(c)) for c in ("host", "path"))
            seeded = np.array([not SEEDS.isdisjoint(t) for t in host_tokens], bool)
            for at, split in ((hosts, host_tokens), (paths, path_tokens)):
                for kind in (0, 1):
                    for i, n in enumerate(np.bincount(at[seeded[hosts] == bool(kind)], minlength=len(split)).tolist()):
                        if n:
                            for t in split[i]:
                                tokens[kind][t] += n
            rows[1] += int(seeded[hosts].sum())
            rows[0] += int((~seeded[hosts]).sum())
        names = [None, *sorted(tokens[0].keys() | tokens[1].keys())]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([rows[k], *[tokens[k][t] for t in names[1:]]], pa.int64()) for k in (0, 1)]], ["token", "allow", "block"])

    counted = sized_batches(places).mapInArrow(of, "token string, allow long, block long").groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    found = {r["token"]: [r["allow"], r["block"]] for r in counted.collect()}
    return found, found.pop(None, [0, 0])


class Bayes:
    """Multinomial naive Bayes with two classes: the log odds of ``block`` are sums over tokens."""

    def __init__(self, tokens: dict[str, list[int]], rows: Sequence[int]):
        size = len(tokens) + 1
        totals = [sum(t[k] for t in tokens.values()) + size for k in (0, 1)]
        self.weights = {t: math.log((n[1] + 1) / totals[1]) - math.log((n[0] + 1) / totals[0]) for t, n in tokens.items()}
        self.prior = math.log((rows[1] + 1) / (rows[0] + 1))

    def log_odds(self, tokens: Sequence[str]) -> float:
        """Without the prior; tokens that training did not meet say nothing."""
        return sum(self.weights.get(t, 0.0) for t in tokens)


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", text_col: str | None = "html", threshold: float = THRESHOLD) -> DataFrame:
    """Per page its id, host, path, the longest fitting rule, the verdict ``allow`` or ``block``, and the score.

    The rule decides where one fits. Else words decide: counts of words in all pages' texts (``text_col``, tags left
    out; None for the URLs' own words only) and of all URLs make the unigram model, by which hosts and paths are split;
    naive Bayes, learned from all rows with the classes that ``SEEDS`` in the host give, blocks at a posterior of
    ``threshold``. ``score`` is that posterior, also where a rule decides.

    A null URL, or one without ``://``, has an empty host and path, which fit no rule and are allowed. Repeated rows are
    judged alike and each is a row of the result; URLs of any length are read whole; other columns are not read; an empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    places = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    texts = F.concat_ws(" ", *[F.col(c) for c in ([text_col] if text_col else [])], F.lit(" "), host_of(F.col(url_col)), path_of(F.col(url_col)))
    words = Words(count_words(pages.select(texts.alias("t")), "t"))
    bayes = Bayes(*count_tokens(places.select("host", "path"), words))
    shared = spark.sparkContext.broadcast((Rules(rules), words, bayes))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_place, known, model = shared.value
        for batch in batches:
            split = [_distinct_tokens(known, batch.column(c)) for c in ("host", "path")]
            odds = model.prior + sum(np.array([model.log_odds(t) for t in tokens], float)[at] for at, tokens in split if len(at))
            scores = 1 / (1 + np.exp(-np.clip(odds, -700, 700))) * np.ones(batch.num_rows)
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            scores[[not h and not p for h, p in zip(hosts, paths, strict=True)]] = 0.0
            fits = [by_place.fitting(h, p) for h, p in zip(hosts, paths, strict=True)]
            verdicts = [r.verdict if r else ("block" if s >= threshold else "allow") for r, s in zip(fits, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "host", "path")], pa.array([r and r.text for r in fits], pa.string()), pa.array(verdicts, pa.string()), pa.array(scores)], ["page_id", "host", "path", "rule", "verdict", "score"]
            )

    return sized_batches(places).mapInArrow(judge, f"page_id {dict(places.dtypes)['page_id']}, host string, path string, rule string, verdict string, score double")
