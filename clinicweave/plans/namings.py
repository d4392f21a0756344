"""Names and readings as queries whose texts are made from the rows of customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinicweave.functions.kana import AGREES, to_romaji, with_similarity
from clinicweave.functions.names import NameWords, with_stripped_names
from clinicweave.functions.text import titlecase_latin
from clinicweave.plans.places import SIGNS
from clinicweave.plans.queries import query

# Word lists of the query.
WORDS = NameWords(("医療法人社団", "医療法人"), ("会", "機構"), ("病院", "医院", "診療所", "クリニック", "歯科"), ("内科", "外科"), ("市立", "県立"), ("国民健康保険",), ("医", "有", "株"))
# Names by the key's remainder: before and behind the key's signs, what is left of both, what goes and what of it is a guess.
# N stands for the signs, B for a body's signs.
SHAPES = (
    ("医療法人B会N病院", "", "N病院", "医療法人／B会", "B会"),
    ("N 歯科", "N歯科", "N 歯科", "", ""),
    ("(医)B会N内科クリニック", "", "N内科クリニック", "(医)／B会", "B会"),
    ("市立 N診療所", "市立N診療所", "N診療所", "市立", "市立"),
    ("医療法人社団 N クリニック", "", "Nクリニック", "医療法人社団", ""),
    ("医)N医院", "", "N医院", "医)", ""),
    ("N町国民健康保険診療所", "", "N町診療所", "国民健康保険", ""),
    ("医療法人N会クリニック", "", "N会クリニック", "医療法人", ""),
    ("B機構 N外科病院", "", "N外科病院", "B機構", ""),
    ("B N病院 ", "N病院", "N病院", "B", "B"),
    ("(医療法人B会)N医院", "", "N医院", "(医療法人B会)", ""),
    ("医療法人社団)N歯科", "", "N歯科", "医療法人社団", ""),
)


def _shape_sql(k: int) -> str:
    cases = " ".join(f"WHEN {i} THEN '{s[k]}'" for i, s in enumerate(SHAPES))
    return f"replace(replace(CASE c_custkey % {len(SHAPES)} {cases} END, 'N', n), 'B', b)"


@query(
    f"SELECT c_custkey AS id, {_shape_sql(0)} AS source, {_shape_sql(2)} AS name, {_shape_sql(3)} AS removed, {_shape_sql(4)} AS guessed FROM"
    f" (SELECT c_custkey, translate(CAST(c_custkey AS VARCHAR), '0123456789', '{SIGNS}') AS n, translate(CAST(c_nationkey AS VARCHAR), '0123456789', '{SIGNS}') AS b FROM customer)"
)
def name_stripping(t):
    """Names of all customers without the bodies that run them."""
    signs = lambda c: F.translate(F.col(c).cast("string"), "0123456789", SIGNS)
    shape = lambda k: F.replace(F.replace(F.get(F.array(*[F.lit(s[k]) for s in SHAPES]), (F.col("c_custkey") % len(SHAPES)).cast("int")), F.lit("N"), signs("c_custkey")), F.lit("B"), signs("c_nationkey"))
    rows = t("customer").select(F.col("c_custkey").alias("id"), shape(0).alias("source"), shape(1).alias("short"))
    s = F.col("stripped")
    return with_stripped_names(rows, "source", "short", WORDS).select("id", "source", s["name"].alias("name"), F.array_join(s["removed"], "／").alias("removed"), F.array_join(s["guessed"], "／").alias("guessed"))


# Kana that stand for the digits of a key, and their letters; N and Q are changed by what follows.
KANA = ("か", "きょ", "し", "つ", "ふぁ", "じゃ", "ん", "っち", "あ", "やー")
LATIN = ("ka", "kyo", "shi", "tsu", "fa", "ja", "N", "cchi", "a", "ya")
LETTERS_SQL = "x"
for _digit, _latin in enumerate(LATIN):
    LETTERS_SQL = f"replace({LETTERS_SQL}, '{_digit}', '{_latin}')"


@query(
    f"""SELECT id, romaji, source, id % 3 <> 2 AS agrees FROM (SELECT id, romaji, CASE WHEN id % 3 = 2 THEN 'zz' WHEN id % 3 = 1 THEN upper(substr(romaji, 1, 1)) || substr(romaji, 2) ELSE upper(romaji) END AS source
 FROM (SELECT c_custkey AS id, replace(regexp_replace({LETTERS_SQL}, 'N([aiueoy])', 'n''\\1', 'g'), 'N', 'n') AS romaji FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS x FROM customer)))"""
)
def romaji_readings(t):
    """Readings of all customers in romaji, and whether a spelling of theirs agrees with it."""
    k = F.col("c_custkey")
    reading = F.array_join(F.transform(F.split(k.cast("string"), ""), lambda c: F.get(F.array(*map(F.lit, KANA)), c.cast("int"))), "")
    rows = t("customer").select(k.alias("id"), reading.alias("reading"), to_romaji(reading).alias("romaji"))
    source = F.when(F.col("id") % 3 == 2, "zz").when(F.col("id") % 3 == 1, titlecase_latin(F.col("romaji"))).otherwise(F.upper("romaji"))
    return with_similarity(rows.withColumn("source", source), "source", "reading").select("id", "romaji", "source", (F.col("similarity") >= AGREES).alias("agrees"))
