"""Facility names without the bodies that run them, as rewrite steps over columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.functions.hours import let
from clinicweave.functions.text import any_of, drop_stray_bracket, join_tokens, squash

# The longest name of a body before a facility's name, characters that carry on a suffix as a word, legal forms
# that stand without the words around them, and beginnings that belong to the facility.
BODY_CHARS = 10
CARRIES_ON = "館社立営店"
BARE_FORMS = ("社団", "財団")
ATTACHED = ("附属", "付属")

_GAP = "[ 　]{2,}"
_NOISE = r"(?U)^[\s　)\]）】」』＞>》・,、.。／/－-]+"
STATE = "struct<rest:string,removed:array<string>,guessed:array<string>,legal:boolean,tight:boolean>"


@dataclass(frozen=True)
class NameWords:
    """Word lists: legal forms, suffixes of bodies, kinds of facilities, specialities, operators, insurers, marks in brackets."""

    prefixes: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    facility: tuple[str, ...] = ()
    speciality: tuple[str, ...] = ()
    operators: tuple[str, ...] = ()
    anywhere: tuple[str, ...] = ()
    brackets: tuple[str, ...] = ()


def _one(words: tuple[str, ...]) -> str:
    return any_of(list(words)) if words else "(?!)"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def only_kinds(text: Column, words: NameWords) -> Column:
    """Nothing but words for kinds of facilities, taken away again and again until none is left."""

    def of(t: Column) -> Column:
        left = F.aggregate(F.sequence(F.lit(0), F.length(t)), t, lambda a, _: F.when(a == "", a).otherwise(F.regexp_replace(a, _one(words.facility), "")))
        return (t != "") & (left == "")

    return let(squash(text), of)


def entity_head(text: Column, words: NameWords) -> Column:
    """The shortest beginning that ends as a body's name, is more than that ending and is followed by a new word; else empty."""
    return F.regexp_extract(text, rf"^[^ 　]{{2,{BODY_CHARS}}}?(?<=.{_one(words.suffixes)})(?=[^{CARRIES_ON}])", 0)


def _put(state: Column, **changes: Column) -> Column:
    return F.struct(*[changes.get(k, state[k]).alias(k) for k in ("rest", "removed", "guessed", "legal", "tight")])


def _add(words: Column, *new: Column) -> Column:
    return F.concat(words, F.array(*new))


def _after(text: Column, head: Column) -> Column:
    return F.substring(text, F.length(head) + 1, F.length(text))


def _bracket_forms(s: Column, _: Column, words: NameWords) -> Column:
    """``医)`` at the start, and legal forms and marks in brackets anywhere, unless nothing else would be left."""
    mark = F.regexp_extract(s["rest"], rf"^{_one(words.brackets)}[)）](?=.)", 0)
    bracketed = rf"(?U)[(（]\s*(?:{_one(words.brackets)}\s*|{_one(words.prefixes)}[^()（）]*)[)）]"

    def inside(s: Column) -> Column:
        found = F.regexp_extract_all(s["rest"], F.lit(bracketed), F.lit(0))
        left = strip(F.regexp_replace(F.regexp_replace(s["rest"], bracketed, ""), _GAP, " "))
        return let(F.struct(found.alias("found"), left.alias("left")), lambda x: F.when((F.size(x["found"]) > 0) & (x["left"] != ""), _put(s, rest=x["left"], removed=F.concat(s["removed"], x["found"]), legal=F.lit(True))).otherwise(s))

    return let(F.when(mark != "", _put(s, rest=strip(_after(s["rest"], mark)), removed=_add(s["removed"], mark), legal=F.lit(True))).otherwise(s), inside)


def _legal_forms(s: Column, _: Column, words: NameWords) -> Column:
    """Legal forms at the start, one after another, as long as something follows."""
    form = _one(words.prefixes)
    head = F.regexp_extract(s["rest"], rf"(?U)^(?>{form}(?=.)\s*)+", 0)
    return let(head, lambda h: F.when(h != "", _put(s, rest=strip(_after(s["rest"], h)), removed=F.concat(s["removed"], F.regexp_extract_all(h, F.lit(form), F.lit(0))), legal=F.lit(True))).otherwise(s))


def _stray_bracket(s: Column, _: Column, words: NameWords) -> Column:
    return _put(s, rest=drop_stray_bracket(s["rest"]))


def _leading_words(s: Column, short: Column, words: NameWords) -> Column:
    """Words before the facility's own: bodies and legal forms, and others in front of a word for a facility.

    The latter are guesses; they come back where only words for kinds of facilities would be left.
    """
    ends = lambda c: c.rlike(f"{_one(words.facility)}$")

    def step(a: Column, _: Column) -> Column:
        head = F.regexp_extract(a["rest"], "^([^ ]*) ", 1)
        tail = strip(F.regexp_extract(a["rest"], "(?s)^[^ ]* (.*)$", 1))

        def of(x: Column) -> Column:
            head, tail = x["head"], x["tail"]
            body = head.rlike(f"^{_one(words.prefixes)}$") | head.rlike(f"{_one(words.suffixes)}$")
            kinds = only_kinds(tail, words) & (squash(short) != squash(tail))
            guess = ~ends(head) & ends(F.element_at(F.split(tail, " "), -1))
            certain = head.rlike(f"^{_one(words.speciality)}$") | head.rlike(_one(words.operators))
            own = ~certain & (short != "") & (squash(short) == squash(F.concat(head, tail)))
            put = lambda **c: F.struct(*[c.get(k, a[k]).alias(k) for k in ("rest", "bodies", "words", "guessed", "untouched", "tight", "on")])
            stop = put(on=F.lit(False))
            return (
                F.when(tail == "", stop).when(body & kinds, put(tight=F.lit(True), on=F.lit(False))).when(body, put(rest=tail, bodies=_add(a["bodies"], head), words=_add(a["words"], head)))
                .when(guess & ~own, put(rest=tail, words=_add(a["words"], head), guessed=_add(a["guessed"], head), untouched=F.coalesce(a["untouched"], a["rest"]))).otherwise(stop)
            )

        return F.when(a["on"], let(F.struct(head.alias("head"), tail.alias("tail")), of)).otherwise(a)

    none = F.array().cast("array<string>")
    start = F.struct(s["rest"].alias("rest"), none.alias("bodies"), none.alias("words"), none.alias("guessed"), F.lit(None).cast("string").alias("untouched"), s["tight"].alias("tight"), F.lit(True).alias("on"))

    def end(a: Column) -> Column:
        back = a["untouched"].isNotNull() & only_kinds(a["rest"], words)
        return F.when(back, _put(s, rest=join_tokens(a["untouched"]), removed=F.concat(s["removed"], a["bodies"]), tight=a["tight"])).otherwise(
            _put(s, rest=a["rest"], removed=F.concat(s["removed"], a["words"]), guessed=F.concat(s["guessed"], a["guessed"]), tight=a["tight"])
        )

    return let(F.aggregate(F.split(s["rest"], " "), start, step), end)


def _bare_forms(s: Column, _: Column, words: NameWords) -> Column:
    for form in BARE_FORMS:
        bare = s["rest"].startswith(form) & (s["rest"] != form)
        s = F.when(bare, _put(s, rest=strip(_after(s["rest"], F.lit(form))), removed=_add(s["removed"], F.lit(form)))).otherwise(s)
    return s


def _attached_bodies(s: Column, short: Column, words: NameWords) -> Column:
    """Bodies written together with the facility's name, where a legal form went before; the stretch that goes is a guess."""

    def step(a: Column, _: Column) -> Column:
        def of(head: Column) -> Column:
            def with_tail(tail: Column) -> Column:
                own = squash(short) == squash(F.concat(head, tail))
                vague = (tail == "") | only_kinds(tail, words) | tail.rlike(f"^{_one(words.speciality)}$") | tail.rlike(f"^{_one(ATTACHED)}")
                gone = F.struct(tail.alias("rest"), _add(a["words"], head).alias("words"), F.lit(True).alias("on"))
                return F.when((head == "") | own | vague, F.struct(a["rest"].alias("rest"), a["words"].alias("words"), F.lit(False).alias("on"))).otherwise(gone)

            return let(F.regexp_replace(_after(a["rest"], head), _NOISE, ""), with_tail)

        return F.when(a["on"], let(entity_head(a["rest"], words), of)).otherwise(a)

    start = F.struct(s["rest"].alias("rest"), F.array().cast("array<string>").alias("words"), s["legal"].alias("on"))
    gone = lambda a: F.substring(s["rest"], F.lit(1), F.length(s["rest"]) - F.length(a["rest"]))
    turns = F.sequence(F.lit(0), F.floor(F.length(s["rest"]) / 2).cast("int"))
    return let(F.aggregate(turns, start, step), lambda a: F.when(a["rest"] == s["rest"], s).otherwise(_put(s, rest=a["rest"], removed=F.concat(s["removed"], a["words"]), guessed=_add(s["guessed"], gone(a)))))


def _insurers(s: Column, short: Column, words: NameWords) -> Column:
    """Words that go wherever they stand, unless the short name has them or only a kind or speciality would be left."""
    for word in words.anywhere:

        def of(left: Column) -> Column:
            goes = s["rest"].contains(word) & ~squash(short).contains(word) & (left != "") & ~left.rlike(f"^{_one((*words.facility, *words.speciality))}$")  # noqa: B023  called at once
            return F.when(goes, _put(s, rest=left, removed=_add(s["removed"], F.lit(word)))).otherwise(s)  # noqa: B023

        s = let(strip(F.regexp_replace(F.regexp_replace(s["rest"], re.escape(word), ""), _GAP, " ")), of)
    return s


#: The steps in order, each of which takes away what it is sure of.
STEPS: tuple[Callable[[Column, Column, NameWords], Column], ...] = (_bracket_forms, _legal_forms, _stray_bracket, _leading_words, _legal_forms, _bare_forms, _attached_bodies, _stray_bracket, _insurers)


def strip_entity(df: DataFrame, name: str, short: str, words: NameWords) -> DataFrame:
    """``df`` with ``stripped`` (name, removed, guessed): one projection a step, so that no step is computed twice."""
    none = F.array().cast("array<string>")
    text = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    start = F.struct(text(name).alias("rest"), none.alias("removed"), none.alias("guessed"), F.lit(False).alias("legal"), F.lit(False).alias("tight"))
    out = df.withColumn("_s", start.cast(STATE)).withColumn("_short", F.coalesce(F.col(short), F.lit("")))
    for step in STEPS:
        out = out.withColumn("_s", let(F.col("_s"), lambda s: step(s, F.col("_short"), words)))  # noqa: B023  the lambda is called at once
    s = F.col("_s")
    return out.withColumn("stripped", F.struct(F.when(s["tight"], join_tokens(s["rest"])).otherwise(s["rest"]).alias("name"), s["removed"].alias("removed"), s["guessed"].alias("guessed"))).drop("_s", "_short")


def with_stripped_names(df: DataFrame, name: str, short: str, words: NameWords) -> DataFrame:
    """``stripped`` (name, removed, guessed) beside the names; each distinct (name, short name) is worked on once.

    Null names are empty; blanks around a name go.
    """
    done = strip_entity(df.select(F.col(name).alias("_n"), F.col(short).alias("_k")).distinct(), "_n", "_k", words)
    return df.join(done, df[name].eqNullSafe(F.col("_n")) & df[short].eqNullSafe(F.col("_k")), "left").drop("_n", "_k")
