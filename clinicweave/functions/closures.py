"""Closed dates in free text, read by column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.hours import MONTH_STARTS, let
from clinicweave.functions.kana import nfkc

#: Longer ranges are taken for typing errors.
MAX_RANGE_DAYS = 31
# Words that say nothing once dates were found, and words of undated periods with their labels.
NOISE = ("年末年始", "年末", "年始", "休診日", "休診", "休業", "休み", "振替", "および", "及び", "から", "まで", "改行", "等", "など", "予定", "の", "は", "を", "に", "と")
PERIODS = (("ゴールデンウィーク", "GW"), ("GW", "GW"), ("お盆", "お盆"), ("盆", "お盆"), ("年末年始", "年末年始"), ("創立記念日", "創立記念日"), ("夏季", "夏季"), ("夏期", "夏季"))

_LENGTHS = tuple(b - a for a, b in zip(MONTH_STARTS, (*MONTH_STARTS[1:], 366), strict=True))
_POINT = r"(?:([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日|([0-9]{1,2})\s*/\s*([0-9]{1,2}))"
_RANGE = rf"{_POINT}\s*[〜~\-−]\s*{_POINT}"
#: Stands where a range was that is too long, so that what is around it does not become one word.
_MARK = ""


def _ordinal(token: Column, pattern: str, first_group: int) -> Column:
    """The day of a leap year of one point of a match, null if no calendar has it."""
    part = lambda k: F.nullif(F.regexp_extract(token, f"(?U)^{pattern}$", first_group + k), F.lit("")).try_cast("int")
    month, day = F.coalesce(part(0), part(2)), F.coalesce(part(1), part(3))
    in_year = lambda table: F.array(*map(F.lit, table))[month - 1]
    return F.when(month.between(1, 12), F.when(day.between(1, in_year(_LENGTHS)), in_year(MONTH_STARTS) + day - 1))


def _scan(text: Column, pattern: str, read) -> Column:
    """Array of (text, dates, quoted): the matches of a pattern as ``read`` takes them, what is between them as it is."""
    tokens = F.regexp_extract_all(text, F.lit(f"(?U)(?:{pattern}|(?s:.))"), F.lit(0))
    plain = lambda t: F.struct(t.alias("text"), F.array().cast("array<int>").alias("dates"), F.lit(None).cast("string").alias("quoted"))
    return F.transform(tokens, lambda t: F.when(F.length(t) < 3, plain(t)).otherwise(read(t, plain(t))))


def _range(token: Column, plain: Column) -> Column:
    def of(x: Column) -> Column:
        days = F.pmod(x["b"] - x["a"], F.lit(366)) + 1
        dates = F.transform(F.sequence(F.lit(0), days - 1), lambda i: (x["a"] + i) % 366)
        taken = F.struct(F.lit(" ").alias("text"), dates.alias("dates"), F.lit(None).cast("string").alias("quoted"))
        refused = F.struct(F.lit(f" {_MARK} ").alias("text"), F.array().cast("array<int>").alias("dates"), token.alias("quoted"))
        return F.when(x["a"].isNull() | x["b"].isNull(), plain).when(days > MAX_RANGE_DAYS, refused).otherwise(taken)

    return let(F.struct(_ordinal(token, _RANGE, 1).alias("a"), _ordinal(token, _RANGE, 5).alias("b")), of)


def _single(token: Column, plain: Column) -> Column:
    taken = lambda d: F.struct(F.lit(" ").alias("text"), F.array(d).alias("dates"), F.lit(None).cast("string").alias("quoted"))
    return let(_ordinal(token, _POINT, 1), lambda d: F.when(d.isNull(), plain).otherwise(taken(d)))


def closed_dates(text: Column) -> Column:
    """Struct (dates, rest) of a text in NFKC: sorted days of a leap year, and what could not be read.

    Ranges are read first, then single dates in what is left. A range over the new year goes on in January, one of more
    than ``MAX_RANGE_DAYS`` gives no day and is quoted in the rest. Dates that no calendar has stay in the rest.
    Years in front of dates go first; once any date was found, words that only lead to dates go as well.
    """
    whole = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "，、\n\r", ",,,,"), r"(?U)(?:19|20)[0-9]{2}\s*[年/]", " ")
    join = lambda tokens: F.array_join(F.transform(tokens, lambda x: x["text"]), "")
    dates = lambda tokens: F.flatten(F.transform(tokens, lambda x: x["dates"]))

    def of(r: Column) -> Column:
        return let(_scan(join(r), _POINT, _single), lambda s: F.struct(F.array_sort(F.array_distinct(F.concat(dates(r), dates(s)))).alias("dates"), join(s).alias("left"), F.array_compact(F.transform(r, lambda x: x["quoted"])).alias("quoted")))

    def result(x: Column) -> Column:
        left = F.regexp_replace(x["left"], r"(?U)[,\s　:：]+", "")
        left = F.when(F.size(x["dates"]) > 0, F.regexp_replace(left, "|".join(NOISE) + r"|[()（）・:：]", "")).otherwise(left)
        quotes = F.array_join(F.transform(x["quoted"], lambda q: F.concat(F.lit(f"[{MAX_RANGE_DAYS}日超の範囲:"), q, F.lit("]"))), "")
        return F.struct(x["dates"].alias("dates"), F.concat(F.replace(left, F.lit(_MARK), F.lit("")), quotes).alias("rest"))

    return let(let(_scan(whole, _RANGE, _range), of), result)


def with_closed_dates(df: DataFrame, column: str) -> DataFrame:
    """``closed`` (dates, rest) beside a free-text column, null for null; each distinct text is read once."""
    texts = df.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("closed", nfkc(F.col(column)))
    return df.join(texts.withColumn("closed", closed_dates(F.col("closed"))), column, "left")


def closure_comment(rest: Column) -> Column:
    """``GW・お盆は休診`` for the undated periods that a text names, empty if it names none.

    Separators go first, then 休み, then 休診, so that a word that they split is found.
    """
    folded = F.translate(F.coalesce(rest, F.lit("")), "・，,、 　／/", "")
    for word in ("休み", "休診"):
        folded = F.replace(folded, F.lit(word), F.lit(""))
    labels = F.array_compact(F.array_distinct(F.array(*[F.when(F.contains(folded, F.lit(word)), label) for word, label in PERIODS])))
    return F.when(F.size(labels) > 0, F.concat(F.array_join(labels, "・"), F.lit("は休診"))).otherwise("")
