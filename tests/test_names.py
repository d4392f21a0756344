"""Names without bodies, against a plain version that works on strings step by step."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clinicweave.functions import names, text

WORDS = names.NameWords(("医療法人社団", "医療法人"), ("会", "機構", "社団"), ("病院", "医院", "診療所", "クリニック", "歯科", "センター", "荘"), ("内科", "外科", "消化器内科", "歯科"), ("市立", "県立"), ("国民健康保険",), ("医", "有", "株"))
KNOWN = [
    ("楠井 歯科", "楠井歯科", "楠井 歯科", "", ""),
    ("医療法人ことはる 東栄内科クリニック", "医療法人ことはる 東栄内科クリニック", "東栄内科クリニック", "医療法人／ことはる", "ことはる"),
    ("楠井 歯科", "", "楠井歯科", "", ""),
    ("すえおか こども クリニック", "", "すえおかこどもクリニック", "", ""),
    ("医療法人社団 すえおか こども クリニック", "", "すえおかこどもクリニック", "医療法人社団", ""),
    ("市立 診療所", "", "市立診療所", "", ""),
    ("OKP with Life クリニック", "", "OKP with Lifeクリニック", "", ""),
    ("楠井 小児科クリニック", "", "小児科クリニック", "楠井", "楠井"),
    ("消化器内科 中畑クリニック", "消化器内科中畑クリニック", "中畑クリニック", "消化器内科", "消化器内科"),
    ("市立 風間浦診療所", "市立風間浦診療所", "風間浦診療所", "市立", "市立"),
    ("晋栄福祉会 診療所", "", "晋栄福祉会診療所", "", ""),
    ("医療法人たんぽぽ会 歯科", "", "たんぽぽ会歯科", "医療法人", ""),
    ("仁寿会 荘病院", "荘病院", "荘病院", "仁寿会", ""),
    ("医療法人仁泉会朝倉病院", "", "朝倉病院", "医療法人／仁泉会", "仁泉会"),
    ("医療法人天宣会天宣会循環器クリニック", "", "循環器クリニック", "医療法人／天宣会／天宣会", "天宣会天宣会"),
    ("医療法人ちぐさ会クリニック", "", "ちぐさ会クリニック", "医療法人", ""),
    ("医療法人久保会医院", "久保会医院", "久保会医院", "医療法人", ""),
    ("医療法人(社団)児玉医院", "", "児玉医院", "医療法人／(社団", "(社団)"),
    ("医療法人敬仁会館診療所", "", "敬仁会館診療所", "医療法人", ""),
    ("コスモ調剤薬局 会津店", "", "コスモ調剤薬局 会津店", "", ""),
    ("医療法人山室会山室会外科", "", "山室会外科", "医療法人／山室会", "山室会"),
    ("医療法人会田医院", "", "会田医院", "医療法人", ""),
    ("遠別町国民健康保険診療所", "", "遠別町診療所", "国民健康保険", ""),
    ("下北医療センター 国民健康保険 大畑診療所", "", "下北医療センター 大畑診療所", "国民健康保険", ""),
    ("(医)成心会なりた内科クリニック", "", "なりた内科クリニック", "(医)／成心会", "成心会"),
    ("(医療法人真生会)佐藤医院", "", "佐藤医院", "(医療法人真生会)", ""),
    ("(土田整形外科医院)", "", "(土田整形外科医院)", "", ""),
    ("医)工藤整形外科", "", "工藤整形外科", "医)", ""),
    ("医療法人社団)いのまた循環器科内科", "", "いのまた循環器科内科", "医療法人社団", ""),
    ("医療法人潮友会(巡回診療所ヤマナシ", "", "巡回診療所ヤマナシ", "医療法人／潮友会", "潮友会"),
    ("キムデンタルクリニック(D.KIMS D", "", "キムデンタルクリニック(D.KIMS D", "", ""),
    ("医)", "", "医)", "", ""),
]

_GAP = re.compile(r"[ 　]{2,}")
_NOISE = re.compile(r"^[\s　)\]）】」』＞>》・,、.。／/－-]+")
_LOOSE_BLANK = re.compile(r"(?<![A-Za-z0-9]) +| +(?![A-Za-z0-9])")


def squash(text: str) -> str:
    return (text or "").replace(" ", "").replace("　", "")


def tighten(text: str) -> str:
    """Blanks stay between ASCII letters and digits only."""
    return _LOOSE_BLANK.sub("", text)


def _words(words) -> re.Pattern:
    return re.compile("|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) or r"(?!)")


class _Name:
    def __init__(self, rest):
        self.rest, self.removed, self.guessed, self.legal, self.tighten = rest, [], [], False, False


class PlainRules:
    """Word lists of legal forms, suffixes of bodies, facility kinds and so on, compiled once."""

    def __init__(self, prefixes=(), suffixes=(), facility=(), speciality=(), operators=(), anywhere=(), brackets=()):
        self.prefixes, self.suffixes, self.facility = frozenset(prefixes), tuple(suffixes), frozenset(facility)
        self.speciality, self.operators, self.anywhere = frozenset(speciality), tuple(operators), tuple(anywhere)
        self._legal = re.compile(f"(?P<form>{_words(prefixes).pattern})(?=.)")
        self._kinds = _words(facility)
        mark = _words(brackets).pattern
        self._mark_only = re.compile(f"(?:{mark})[)）](?=.)")
        self._bracketed = re.compile(rf"[(（]\s*(?:(?:{mark})\s*|(?:{_words(prefixes).pattern})[^()（）]*)[)）]")

    def only_kinds(self, text: str) -> bool:
        """Nothing but words for kinds of facilities."""
        left = squash(text)
        if not left:
            return False
        while (less := self._kinds.sub("", left)) != left:
            left = less
        return not left

    def ends_as_facility(self, text: str) -> bool:
        return text.endswith(tuple(self.facility))

    # Steps, each of which takes away what it is sure of.

    def _bracket_forms(self, n: _Name, short: str) -> None:
        if m := self._mark_only.match(n.rest):
            n.removed.append(m[0])
            n.rest, n.legal = n.rest[m.end() :].strip(), True
        found = [m[0] for m in self._bracketed.finditer(n.rest)]
        left = _GAP.sub(" ", self._bracketed.sub("", n.rest)).strip()
        if found and left:
            n.removed += found
            n.rest, n.legal = left, True

    def _legal_forms(self, n: _Name, short: str) -> None:
        while m := self._legal.match(n.rest):
            n.removed.append(m["form"])
            n.rest, n.legal = n.rest[m.end() :].strip(), True

    def _stray_bracket(self, n: _Name, short: str) -> None:
        lone = n.rest[:1] in tuple(")）") or (n.rest[:1] in tuple("(（") and not re.search("[)）]", n.rest))
        if n.rest and lone and n.rest[1:].strip():
            n.rest = n.rest[1:].strip()

    def _leading_words(self, n: _Name, short: str) -> None:
        untouched = None
        while len(pair := n.rest.split(" ", 1)) == 2 and (tail := pair[1].strip()):
            head = pair[0]
            if head in self.prefixes or head.endswith(self.suffixes):
                if self.only_kinds(tail) and squash(short) != squash(tail):
                    n.tighten = True
                    break
                n.removed.append(head)
            elif not self.ends_as_facility(head) and self.ends_as_facility(tail.rsplit(" ", 1)[-1]):
                certain = head in self.speciality or any(w in head for w in self.operators)
                if not certain and short and squash(short) == squash(head + tail):
                    break
                untouched = n.rest if untouched is None else untouched
                n.removed.append(head)
                n.guessed.append(head)
            else:
                break
            n.rest = tail
        if untouched is not None and self.only_kinds(n.rest):
            for word in n.guessed:
                n.removed.remove(word)
            n.guessed, n.rest = [], tighten(untouched)

    def _bare_forms(self, n: _Name, short: str) -> None:
        for form in ("社団", "財団"):
            if n.rest.startswith(form) and n.rest != form:
                n.removed.append(form)
                n.rest = n.rest[len(form) :].strip()

    def _body(self, text: str) -> str:
        """The shortest beginning that ends as a body's name and is followed by a new word."""
        for size in range(2, min(len(text) - 1, names.BODY_CHARS) + 1):
            head = text[:size]
            if " " in head or "　" in head:
                return ""
            if text[size] not in names.CARRIES_ON and any(head.endswith(s) and head != s for s in self.suffixes):
                return head
        return ""

    def _attached_bodies(self, n: _Name, short: str) -> None:
        start = n.rest
        while n.legal and (head := self._body(n.rest)):
            tail = _NOISE.sub("", n.rest[len(head) :])
            own_name = squash(short) == squash(head + tail)
            vague = not tail or self.only_kinds(tail) or tail in self.speciality or tail.startswith(("附属", "付属"))
            if own_name or vague:
                break
            n.removed.append(head)
            n.rest = tail
        if n.rest != start:
            n.guessed.append(start[: len(start) - len(n.rest)])

    def _insurers(self, n: _Name, short: str) -> None:
        for word in self.anywhere:
            left = _GAP.sub(" ", n.rest.replace(word, "")).strip()
            if word in n.rest and word not in squash(short) and left and left not in self.facility | self.speciality:
                n.removed.append(word)
                n.rest = left

    def strip(self, name: str, short: str = "") -> tuple[str, list[str], list[str]]:
        """(name, words taken away, words taken away on a guess)."""
        n = _Name(name)
        for step in (self._bracket_forms, self._legal_forms, self._stray_bracket, self._leading_words, self._legal_forms, self._bare_forms, self._attached_bodies, self._stray_bracket, self._insurers):
            step(n, short)
        return (tighten(n.rest) if n.tighten else n.rest), n.removed, n.guessed




def stripped(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, source string, short string")
    got = names.with_stripped_names(df, "source", "short", WORDS).orderBy("i").select("stripped.*").collect()
    return [(r["name"], r["removed"], r["guessed"]) for r in got]


def test_known_names(spark):
    got = stripped(spark, [r[:2] for r in KNOWN])
    assert [(n, "／".join(a), "／".join(b)) for n, a, b in got] == [r[2:] for r in KNOWN]


def test_names_against_the_plain_version(spark):
    rules = PlainRules(WORDS.prefixes, WORDS.suffixes, WORDS.facility, WORDS.speciality, WORDS.operators, WORDS.anywhere, WORDS.brackets)
    rng = random.Random(5)
    bits = [*WORDS.prefixes, *WORDS.suffixes, *WORDS.facility, *WORDS.speciality, *WORDS.operators, *WORDS.anywhere, "(医)", "(医療法人 甲)", "医)", "（", ")", " ", " ", "  ", "　", "甲乙", "丙", "館", "附属", "財団", "社団", "OKP", "・"]
    rows = []
    for _ in range(1500):
        name = "".join(rng.choice(bits) for _ in range(rng.randint(1, 7))).strip()
        short = rng.choice(["", "", name, "".join(name.split(" ")[1:]), name[4:], name.replace(" ", "")])
        rows.append((name, short))
    want = [rules.strip(n, s) for n, s in rows]
    got = stripped(spark, rows)
    for row, g, w in zip(rows, got, want, strict=True):
        assert (g[0], sorted(g[1]), g[2]) == (w[0], sorted(w[1]), w[2]), row
    assert sum(bool(w[1]) for w in want) > 500


def test_nulls_repeats_and_long_names(spark):
    long = "医療法人" * 500 + "甲病院"
    got = stripped(spark, [(None, None), ("", ""), ("甲病院", None), ("甲病院", None), (long, "")])
    assert got[:4] == [("", [], []), ("", [], []), ("甲病院", [], []), ("甲病院", [], [])]
    assert got[4][0] == "甲病院" and len(got[4][1]) == 500
    empty = spark.createDataFrame([("甲会 病院", "x")], "source string, short string")
    assert names.with_stripped_names(empty, "source", "short", names.NameWords()).first()["stripped"]["name"] == "甲会 病院"


@pytest.mark.parametrize("source,want", [(")甲", "甲"), ("（甲", "甲"), ("（甲）", "（甲）"), ("(", "("), ("甲(", "甲("), ("", ""), ("） 甲 ", "甲")])
def test_stray_brackets(spark, source, want):
    assert spark.range(1).select(text.drop_stray_bracket(F.lit(source)).alias("x")).first()["x"] == want


@pytest.mark.parametrize("source,want", [("アサノ（シュッチョウ）", "アサノ"), ("（ア）", "（ア）"), ("ア （イ） ウ", "ア ウ"), ("ア（イ", "ア（イ")])
def test_readings_without_brackets(spark, source, want):
    assert spark.range(1).select(text.strip_brackets(F.lit(source)).alias("x")).first()["x"] == want


def test_any_of_is_longest_first():
    assert re.findall(text.any_of(["a", "ab", "abc"]), "abcab") == ["abc", "ab"]
