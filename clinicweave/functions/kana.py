"""Readings: romaji from kana, and agreement of two spellings."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from clinicweave.functions.hours import let
from clinicweave.functions.text import fold_romaji, to_hiragana

#: Similarity of folded spellings from which they agree.
AGREES = 0.9

# The syllabary by rows of five vowels (a dot where a row has a gap), and its irregular readings.
ROWS = {"": "あいうえお", "k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ", "m": "まみむめも", "y": "や.ゆ.よ", "r": "らりるれろ", "w": "わ...を", "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ"}
IRREGULAR = {"し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "を": "o", "ゐ": "i", "ゑ": "e", "ん": "n", "ゔ": "vu"}
SMALL = {"ぁ": "a", "ぃ": "i", "ぅ": "u", "ぇ": "e", "ぉ": "o", "ゃ": "ya", "ゅ": "yu", "ょ": "yo", "ゎ": "wa"}
# Syllables of two characters that no rule of rows and glides gives.
JOINED = {
    "ふぁ": "fa", "ふぃ": "fi", "ふぇ": "fe", "ふぉ": "fo", "ゔぁ": "va", "ゔぃ": "vi", "ゔぇ": "ve", "ゔぉ": "vo", "てぃ": "ti", "でぃ": "di", "とぅ": "tu", "どぅ": "du",
    "うぃ": "wi", "うぇ": "we", "うぉ": "wo", "しぇ": "she", "ちぇ": "che", "じぇ": "je", "つぁ": "tsa", "つぃ": "tsi", "つぇ": "tse", "つぉ": "tso",
}


def syllables() -> dict[str, str]:
    """Kana of one or two characters -> romaji, from the rows, the rules of glides and the pairs."""
    table = {kana: consonant + vowel for consonant, row in ROWS.items() for kana, vowel in zip(row, "aiueo", strict=True) if kana != "."} | IRREGULAR | SMALL
    for kana in "きしちにひみりぎじぢびぴ":
        stem = table[kana][:-1]
        glide = stem if stem in ("sh", "ch", "j") else stem + "y"
        table |= {kana + small: glide + vowel for small, vowel in zip("ゃゅょ", "auo", strict=True)}
    return table | JOINED


def to_romaji(reading: Column) -> Column:
    """Hepburn without marks of length: ー goes, っ doubles the next consonant, ん before a vowel or y gets a sign.

    The reading is cut into syllables, two characters where the table has them, and each is looked up with the next.
    """
    table = syllables()
    pairs = "|".join(sorted(k for k in table if len(k) == 2))
    known = F.map_from_arrays(F.array(*map(F.lit, table)), F.array(*map(F.lit, table.values())))
    parts = F.regexp_extract_all(F.translate(reading, "ー", ""), F.lit(f"{pairs}|(?s:.)"), F.lit(0))

    def of(kana: Column) -> Column:
        latin = F.transform(kana, lambda k: F.try_element_at(known, k))

        def one(x: Column) -> Column:
            def part(k: Column, i: Column) -> Column:
                own, following = F.get(x["latin"], i), F.coalesce(F.get(x["latin"], i + 1), F.lit(""))
                doubled = F.when(following.rlike("^[aiueo]"), "").otherwise(F.substring(following, 1, 1))
                return F.when(k == "っ", doubled).when((k == "ん") & following.rlike("^[aiueoy]"), "n'").otherwise(F.coalesce(own, k))

            return F.array_join(F.transform(x["kana"], part), "")

        return let(F.struct(kana.alias("kana"), latin.alias("latin")), one)

    return let(parts, of)


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def with_similarity(df: DataFrame, source: str, reading: str, to: str = "similarity") -> DataFrame:
    """0 to 1 between a source's romaji and the romaji of a reading, spellings folded; 0 if either is empty or null.

    Spellings are folded by column functions; the ratio, which Spark lacks, is computed once for each different pair.
    """
    folded = df.withColumn("_a", fold_romaji(F.coalesce(to_romaji(to_hiragana(F.col(reading))), F.lit("")))).withColumn("_b", fold_romaji(F.coalesce(F.col(source), F.lit(""))))
    pairs = folded.select("_a", "_b").distinct().withColumn(to, _ratio("_a", "_b"))
    return folded.join(pairs, ["_a", "_b"], "left").drop("_a", "_b")


@F.arrow_udf(StringType())
def nfkc(text: pa.Array) -> pa.Array:
    """Compatibility characters in their plain form; each different text of a batch once. Arrow's own function does not
    compose characters, so Python's stands here."""
    coded = text.dictionary_encode()
    return pa.array([unicodedata.normalize("NFKC", x) for x in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
