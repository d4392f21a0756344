"""Names, readings, notes and web addresses as column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicweave.functions.hours import let

# Rules for character tables: full-width ASCII is U+FF01 to U+FF5E, katakana U+30A1 to U+30F6 lies 0x60 above hiragana.
FULL = "".join(map(chr, range(0xFF01, 0xFF5F)))
HALF = "".join(map(chr, range(0x21, 0x7F)))
KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))

#: Any white space, the ideographic blank too.
BLANK = r"(?U)\s+"


def any_of(words: list[str]) -> str:
    """A pattern for one of the words, longest first."""
    return "(?:" + "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w))) + ")"


def normalize_chars(text: Column) -> Column:
    """Full-width ASCII as half-width, runs of blanks as one; other characters stay."""
    return F.trim(F.regexp_replace(F.translate(text, FULL, HALF), BLANK, " "))


def to_hiragana(text: Column) -> Column:
    return F.translate(text, KATAKANA, HIRAGANA)


def fold_romaji(text: Column) -> Column:
    """Romaji spellings made comparable: letters only, long vowels and doubles short, one system of consonants."""
    out = F.regexp_replace(F.lower(text), "[^a-z]", "")
    # Replacements in this order, each over the result of the one before it.
    for pattern, to in (("ou", "o"), ("oo", "o"), ("uu", "u"), ("ei", "e"), (r"(.)\1+", "$1"), ("sy", "sh"), ("ty", "ch"), ("jy", "j"), ("zy", "j"), ("si", "shi"), ("ti", "chi"), ("tu", "tsu"), ("hu", "fu")):
        out = F.regexp_replace(out, pattern, to)
    return out


def titlecase_latin(text: Column) -> Column:
    """First letter of each word upper, the rest lower; a word that begins with anything else stays, blanks become one."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    title = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike(r"^\p{L}"), title(w)).otherwise(w)), " ")


def squash(text: Column) -> Column:
    """Without blanks."""
    return F.translate(text, " 　", "")


def join_tokens(text: Column) -> Column:
    """Blanks stay between ASCII letters and digits only."""
    return F.regexp_replace(text, r"(?<![A-Za-z0-9]) +| +(?![A-Za-z0-9])", "")


def strip_bracket_notes(text: Column, notes: list[str]) -> Column:
    """Without ``(…)`` whose trimmed content is one of the notes; the text itself if nothing would be left."""
    out = F.trim(F.regexp_replace(text, rf"[(（]\s*{any_of(notes)}\s*[)）]", "")) if notes else text
    return F.when(out == "", text).otherwise(out)


def strip_brackets(text: Column) -> Column:
    """Without any bracket and its content, the gap one blank; the text itself if nothing would be left."""
    out = F.trim(F.regexp_replace(F.regexp_replace(text, r"[(（][^()（）]*[)）]", ""), "[ 　]{2,}", " "))
    return F.when(out == "", text).otherwise(out)


def drop_stray_bracket(text: Column) -> Column:
    """Without a bracket at the start that is never opened or closed; the text itself if nothing would be left."""
    rest = F.regexp_replace(F.substring(text, F.lit(2), F.length(text)), r"(?U)^\s+|\s+$", "")
    return F.when(text.rlike(r"^[)）]|(?s)^[(（][^)）]*$") & (rest != ""), rest).otherwise(text)


def bracket_contents(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"[(（]([^()（）]*)[)）]"), F.lit(1)), lambda x: F.trim(x))


def clean_english(text: Column) -> Column:
    """Half-width ASCII with plain punctuation and single blanks."""
    plain = F.translate(text, "‘’“”–—−‐　・", "''\"\"----  ")
    return F.trim(F.regexp_replace(F.translate(plain, FULL, HALF), BLANK, " "))


def join_notes(notes: list[Column]) -> Column:
    """Notes that aren't empty, joined by `` / `` in the given order."""
    return F.array_join(F.filter(F.array(*[F.coalesce(n, F.lit("")) for n in notes]), lambda x: x != ""), " / ")


def clip_notes(text: Column, most: int = 200) -> Column:
    """As many leading notes as fit in ``most`` characters; of a first note that is too long, its beginning."""

    def of(notes: Column) -> Column:
        fits = F.filter(F.sequence(F.size(notes), F.lit(0), F.lit(-1)), lambda n: F.length(F.array_join(F.slice(notes, F.lit(1), n), " / ")) <= most)
        return F.when(fits[0] == 0, F.substring(text, 1, most)).otherwise(F.array_join(F.slice(notes, F.lit(1), fits[0]), " / "))

    return F.when(F.length(text) <= most, text).otherwise(let(F.split(text, " / "), of))


# Addresses of search engines that lead on to another site.
REDIRECTS = r"(?i)^https?://(www\.)?(bing\.com/ck/|google\.[a-z.]+/url\?|search\.yahoo\.[a-z.]+/)"


def clean_url(url: Column, redirects: str = REDIRECTS, most: int = 255) -> Column:
    """Struct (url, note): a web address put right where that is safe, dropped with a note where it isn't.

    In this order: redirecting and overlong addresses go; full addresses stay; a missing colon is added; a bare domain,
    letters of any script allowed, gets ``https://``; the rest goes. ``note`` is a code, ``url_note`` its sentence.
    """
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?U)^\s+|\s+$", "")
    result = lambda value, note: F.struct(value.alias("url"), F.lit(note).alias("note"))
    none = F.lit("")
    return (
        F.when(u == "", result(none, ""))
        .when(u.rlike(redirects), result(none, "redirect"))
        .when(F.length(u) > most, result(none, "too_long"))
        .when(u.rlike(r"(?U)^https?://\S+$"), result(u, ""))
        .when(u.rlike(r"(?U)^https?//\S+$"), result(F.regexp_replace(u, r"^(https?)//", "$1://"), "colon_added"))
        .when(u.rlike(r"(?U)^[\w-]+(\.[\w-]+)+(/\S*)?$"), result(F.concat(F.lit("https://"), u), "scheme_added"))
        .otherwise(result(none, "unusable"))
    )


def url_note(url: Column, note: Column) -> Column:
    """The sentence of a note of ``clean_url``, with the beginning of the address; of one that is too long, its length."""
    u = F.trim(F.coalesce(url, F.lit("")))
    # The sentences by code.
    sentences = {"redirect": "検索エンジンの転送 URL のため出力しない: ", "colon_added": "コロンの脱字を補った: ", "scheme_added": "website に https を補った: ", "unusable": "website に使えない形式のため出力しない: "}
    out = F.when(note == "too_long", F.concat(F.lit("255文字を超えるため出力しない: "), F.length(u).cast("string"), F.lit("文字"))).otherwise("")
    for code, text in sentences.items():
        out = F.when(note == code, F.concat(F.lit(text), F.substring(u, 1, 60))).otherwise(out)
    return out


def has_any(text: Column, words: list[str]) -> Column:
    """One of the words stands anywhere in the text, blanks aside."""
    return squash(F.coalesce(text, F.lit(""))).rlike(any_of(words))


def ends_with_any(text: Column, words: list[str]) -> Column:
    return squash(F.coalesce(text, F.lit(""))).rlike(any_of(words) + "$")


def use_short_name(name: Column, short: Column, kinds: list[str], specialities: list[str]) -> Column:
    """The name holds no word of a facility at all and the short name ends like one."""
    words = [*kinds, *specialities]
    return ~has_any(name, words) & ends_with_any(short, words)


def bracket_alternatives(name: Column, table: dict[str, tuple[str, str]]) -> Column:
    """Struct (name, alt_name, old_name): ``(…)`` with a known content leaves the name and becomes another name.

    ``table``: content -> (kind, value), the kind being alt or old. A name that would be empty stays as it is.
    """
    contents = F.transform(F.regexp_extract_all(name, F.lit(r"[(（]([^)）]*)[)）]"), F.lit(1)), lambda x: F.trim(x))
    known = F.create_map(*[F.lit(x) for k, (kind, value) in table.items() for x in (k, f"{kind}:{value}")]) if table else F.expr("map('', '')")
    found = F.filter(F.transform(contents, lambda c: known[c]), lambda v: v.isNotNull())
    cut = F.trim(F.regexp_replace(F.regexp_replace(name, r"[(（]\s*" + any_of(list(table)) + r"\s*[)）]", "") if table else name, "[ 　]{2,}", " "))
    of = lambda kind: F.array_join(F.transform(F.filter(found, lambda v: F.startswith(v, F.lit(kind + ":"))), lambda v: F.substring(v, F.lit(len(kind) + 2), F.length(v))), "／")
    whole = (F.size(found) == 0) | (cut == "")
    return F.struct(F.when(whole, name).otherwise(cut).alias("name"), F.when(whole, "").otherwise(of("alt")).alias("alt_name"), F.when(whole, "").otherwise(of("old")).alias("old_name"))


# Words that mark an English name.
ENGLISH = ("hospital", "clinic", "pharmacy", "dental", "dentist", "medical", "center", "centre", "university", "institute", "college", "association", "foundation", "corporation", "surgery", "care", "health", "maternity", "midwife", "drug", "dispensary", "eye", "children", "general", "memorial")


def looks_english(text: Column) -> Column:
    return F.lower(text).rlike("|".join(ENGLISH))


def kept_reading(reading: Column, n_removed: Column, short_used: Column) -> Column:
    """The reading as hiragana, unless it also reads an operator that the name lost or a name that was not used."""
    lost = (n_removed > 0) | F.coalesce(short_used, F.lit(False))
    return F.when(lost, "").otherwise(to_hiragana(normalize_chars(F.coalesce(reading, F.lit("")))))


def route_english(english: Column, reading: Column, similarity: Column, least: float = 0.9) -> Column:
    """Struct (english, latin, note) of a cleaned English field: a name in English words, or a transcription that the
    reading confirms (``similarity`` of the two); anything else is dropped with a note."""
    e, result = F.coalesce(english, F.lit("")), lambda en, latin, note: F.struct(en.alias("english"), latin.alias("latin"), F.lit(note).alias("note"))
    none = F.lit("")
    return (
        F.when(e == "", result(none, none, ""))
        .when(~looks_english(e) & (F.coalesce(reading, F.lit("")) == ""), result(none, none, "unverified"))
        .when(~looks_english(e), F.when(similarity >= least, result(none, titlecase_latin(e), "")).otherwise(result(none, none, "disagrees")))
        .when(~e.rlike(r"^\p{ASCII}*$"), result(none, none, "not_ascii"))
        .otherwise(result(e, none, ""))
    )


def decode_object_id(text: Column) -> Column:
    """Struct (type, number) of a prefixed object id; areas hold ways (even) and relations (odd) at twice their number."""
    kind, n = F.substring(text, 1, 1), F.substring(text, F.lit(2), F.length(text)).try_cast("long")
    out = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("number"))
    half = F.floor(n / 2).cast("long")
    return F.when(n.isNull(), None).when(kind == "n", out("node", n)).when(kind == "w", out("way", n)).when(kind == "r", out("relation", n)).when((kind == "a") & (n % 2 == 0), out("way", half)).when(kind == "a", out("relation", half))
