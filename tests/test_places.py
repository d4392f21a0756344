"""Towns and closed dates against plain versions, and on known cases."""

import random
import re
import unicodedata
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clinicweave.functions import closures, kana, towns
from clinicweave.functions.hours import fold_dates


def values(spark, column, texts, kind="string"):
    return [r["y"] for r in spark.createDataFrame(list(enumerate(texts)), f"i int, x {kind}").select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


# --- towns ----------------------------------------------------------------------------------------------------------------

TOWNS = [("神奈川県", "横浜市鶴見区", "鶴見町", "鶴見町"), ("神奈川県", "横浜市鶴見区", "鶴見中央", "鶴見中央一丁目"), ("神奈川県", "藤沢市", "辻堂", "辻堂"), ("神奈川県", "藤沢市", "辻堂元町", "辻堂元町一丁目"), ("大分県", "大分市", "大字下郡", "大字下郡"), ("大分県", "大分市", "大字下郡", "大字下郡北"), ("愛知県", "豊橋市", "牟呂町", "牟呂町字内田"), ("愛知県", "豊橋市", "牟呂内田町", "牟呂内田町")]
ADDRESSES = [
    ("神奈川県", "横浜市鶴見区", "神奈川県横浜市鶴見区鶴見中央", "鶴見町", "中央", "なし", "鶴見中央"),
    ("神奈川県", "藤沢市", "神奈川県藤沢市辻堂元町", "辻堂", "元町", "なし", "辻堂元町"),
    ("神奈川県", "横浜市鶴見区", "神奈川県横浜市鶴見区鶴見中央1-2-3", "鶴見町", "中央", "照合済み", ""),
    ("神奈川県", "横浜市鶴見区", "神奈川県横浜市鶴見区鶴見町1234", "鶴見町", "1234", "なし", ""),
    ("大分県", "大分市", "大分県大分市大字下郡北", "大字下郡", "北", "なし", ""),
    ("愛知県", "豊橋市", "愛知県豊橋市牟呂内田町１９－１３", "牟呂町字内田", "町19-13", "なし", "牟呂内田町"),
    (None, "藤沢市", None, "辻堂", "元町", "なし", ""),
]


def plain_numeral(run):
    if not set(run) & set("十百千"):
        return str(int("".join(str("〇一二三四五六七八九".index(c)) for c in run)))
    total, digit = 0, None
    for c in run:
        if c in "十百千":
            total, digit = total + (1 if digit is None else digit) * 10 ** ("十百千".index(c) + 1), None
        else:
            digit = "〇一二三四五六七八九".index(c)
    return str(total + (digit or 0))


def plain_fold(text):
    table = {**{ord(c): "-" for c in towns.HYPHENS}, **{0xFF10 + i: str(i) for i in range(10)}, ord("ヶ"): "ケ", ord("ヵ"): "カ"}
    return re.sub("大?字", "", re.sub("[〇一二三四五六七八九十百千]+", lambda m: plain_numeral(m[0]), text.translate(table)))


def plain_longer(row, registers):
    pref, city, address, town, rest, evidence = (x or "" for x in row)
    cut = len(address) - len(rest)
    if not (town and rest and evidence == "なし" and cut > 0 and address[cut] == rest[0]) or not re.match(towns.KANJI, rest) or re.match("[0-9０-９]", address[cut - 1]):
        return ""
    run = plain_fold(re.match(towns.WORD + "+", rest)[0])
    own = [(p, n) for a, b, p, n in registers if (a, b) == (pref, city)]
    best = (0, None)
    for p, n in own:
        f = plain_fold(n)
        k = max((k for k in range(len(run) + 1, len(f) + 1) if (plain_fold(address[:cut]) + run).endswith(f[:k])), default=0)
        best = (k, (p, n)) if k > best[0] and run else best
    if not best[0]:
        return ""
    mine = next((p for p, n in own if plain_fold(n) == plain_fold(town)), None)
    return "" if mine is not None and plain_fold(mine) == plain_fold(best[1][0]) else best[1][0] or best[1][1]


def longer(spark, addresses, registers):
    t = spark.createDataFrame([(*r, i) for i, r in enumerate(registers)], "pref string, city string, part string, name string, at int")
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(addresses)], "id int, pref string, city string, address string, town string, rest string, evidence string")
    return [r["longer_town"] for r in towns.with_longer_towns(rows, t.repartition(3)).orderBy("id").collect()]


def test_known_towns(spark):
    assert longer(spark, [a[:-1] for a in ADDRESSES], TOWNS) == [a[-1] for a in ADDRESSES]
    assert [plain_longer(a[:-1], TOWNS) for a in ADDRESSES] == [a[-1] for a in ADDRESSES]
    assert longer(spark, [a[:-1] for a in ADDRESSES], []) == [""] * len(ADDRESSES)


def test_joins_of_towns_carry_no_addresses(spark):
    t = spark.createDataFrame([(*r, i) for i, r in enumerate(TOWNS)], "pref string, city string, part string, name string, at int")
    rows = spark.createDataFrame([(i, *a[:-1]) for i, a in enumerate(ADDRESSES)], "id int, pref string, city string, address string, town string, rest string, evidence string")
    plan = towns.with_longer_towns(rows, t).select("id", "longer_town")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 4 and not any("address" in line for line in joins)


def test_folding(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("〇一二三九十百千字大町ヶケ－ー３5a") for _ in range(rng.randint(0, 9))) for _ in range(400)] + ["大字大槻町字天正坦", "茅ヶ崎", "二三", "千九百八十四番", "〇〇", ""]
    assert values(spark, towns.fold, texts) == [plain_fold(t) for t in texts]


def test_towns_against_a_scan(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("東西本町田二十中ヶノ") for _ in range(rng.randint(1, 5)))
    registers = [("p", rng.choice("xy"), rng.choice(["", "本", word()]), word()) for _ in range(150)]
    rows = []
    for _ in range(500):
        _, city, _, name = rng.choice(registers)
        whole = name + rng.choice(["", "12", word(), "1-2"])
        cut = rng.randint(0, len(whole))
        rows.append(("p", city, rng.choice(["市", "市3"]) + whole, whole[:cut], whole[cut:], rng.choice(["なし", "なし", "なし", "推定"])))
    rows += rows[:50]
    want = [plain_longer(r, registers) for r in rows]
    assert longer(spark, rows, registers) == want and sum(x != "" for x in want) > 20


# --- closed dates -----------------------------------------------------------------------------------------------------------

DATES = [
    ("01月01日，01月02日，01月03日，12月30日，12月31日", "Dec 30-Jan 03", "", ""),
    ("年末年始（12月29日～1月3日）", "Dec 29-Jan 03", "", ""),
    ("12/29~1/3", "Dec 29-Jan 03", "", ""),
    ("8/14-5/16\n12/29-1/3", "Dec 29-Jan 03", "[31日超の範囲:8/14-5/16]", ""),
    ("GW・お盆休み", "", "GW・お盆休み", "GW・お盆は休診"),
    ("2024年13月40日", "", "13月40日", ""),
    ("年末・年始、創立 記念日", "", "年末・年始創立記念日", "年末年始・創立記念日は休診"),
    ("夏休み季", "", "夏休み季", "夏季は休診"),
    ("", "", "", ""),
    (None, "", None, ""),
]
NOISE = r"年末年始|年末|年始|休診日?|休業|休み|振替|および|及び|から|まで|[()（）・:：]|改行|等|など|予定|の|は|を|に|と"


def plain_dates(text):
    """Two passes of substitutions, over real dates of a leap year."""
    s = re.sub(r"(19|20)[0-9]{2}\s*[年/]", " ", re.sub("[，、\n\r]", ",", unicodedata.normalize("NFKC", text)))
    point = r"(?:([0-9]{1,2})\s*月\s*([0-9]{1,2})\s*日|([0-9]{1,2})\s*/\s*([0-9]{1,2}))"
    days, quoted = set(), []

    def day(a, b, c, d):
        try:
            return date(2024, int(a or c), int(b or d))
        except ValueError:
            return None

    def span(m):
        a, b = day(*m.groups()[:4]), day(*m.groups()[4:])
        if a is None or b is None:
            return m[0]
        b = b if b >= a else b.replace(year=2025) if b != date(2024, 2, 29) else date(2025, 3, 1)
        run = (b - a).days + 1
        if run > 31:
            quoted.append(m[0])
            return " # "
        days.update((x.month, x.day) for x in (a + timedelta(i) for i in range(run)))
        return " "

    def single(m):
        if (x := day(*m.groups())) is None:
            return m[0]
        days.add((x.month, x.day))
        return " "

    s = re.sub(point, single, re.sub(point + r"\s*[〜~\-−]\s*" + point, span, s))
    rest = re.sub(r"[,\s　:：]+", "", s)
    rest = re.sub(NOISE, "", rest) if days else rest
    return sorted((date(2024, *x) - date(2024, 1, 1)).days for x in days), rest.replace("#", "") + "".join(f"[31日超の範囲:{q}]" for q in quoted)


def test_known_closed_dates(spark):
    df = closures.with_closed_dates(spark.createDataFrame([(i, r[0]) for i, r in enumerate(DATES)], "i int, t string"), "t")
    got = [tuple(r)[1:] for r in df.select("i", F.coalesce(fold_dates(F.col("closed.dates")), F.lit("")), "closed.rest", closures.closure_comment(F.col("closed.rest"))).orderBy("i").collect()]
    assert got == [r[1:] for r in DATES]


def test_closed_dates_against_substitutions(spark):
    rng = random.Random(3)
    bits = ["1/2", "12月31日", "２月３０日", "11/25 〜 12/5", "3/1-4/20", "12/29~1/3", "13/1-1/5", "2/30−3/2", "、", "，", "年末年始", "休診日", "GW", "　", " ", "\n", "2023年", "2024/", "の", "まで", "午後", "(", "）", "5", "/", "月", "日", "〜", "1/2/3", "🙂"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(600)] + ["12/1 " * 4000]
    normal = [unicodedata.normalize("NFKC", t) for t in texts]
    assert values(spark, kana.nfkc, texts) == normal
    got = [(r["dates"], r["rest"]) for r in values(spark, closures.closed_dates, normal)]
    assert got == [plain_dates(t) for t in texts]


@pytest.mark.parametrize("text", [None, ""])
def test_nothing_said(spark, text):
    assert values(spark, closures.closed_dates, [text])[0].asDict() == {"dates": [], "rest": ""}
