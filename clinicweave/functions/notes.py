"""Notes, review marks and tags of an assembled facility as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicweave.functions.text import join_notes

# Department codes of emergency care, closure texts that lose nothing, meanings of position levels.
EMERGENCY = ("09010",)
NO_CLOSURE = ("", "なし", "無し", "ない", "無", "特になし", "年中無休", "。", "．", ".", "-", "ー", "―", "−")
LEVELS = {1: "都道府県庁所在地", 2: "市区町村役場の所在地", 3: "大字と丁目の代表点", 8: "住居表示の位置"}
# The sentences of the notes.
NUMBER_NOTES = {
    "地番": "地番のため addr:block_number と addr:housenumber をタグ出力していない",
    "不一致": "番地が住居表示にも地番にも見つからないため addr:block_number と addr:housenumber をタグ出力していない",
    "判定不能": "対応する住居表示レコードが無いため番地をタグ出力していない",
}
NUMBER_NOTE = "番地が推定のため addr:block_number と addr:housenumber をタグ出力していない"
TOWN_NOTE = "町字が入力と別のものになったため addr:neighbourhood をタグ出力していない。修正候補: "


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def has_emergency(codes: Column) -> Column:
    """Whether an array of department codes holds an emergency department."""
    return F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in EMERGENCY])), F.lit(False))


def emergency_tag(amenity: Column, codes: Column) -> Column:
    """``yes`` for hospitals with an emergency department; decided on the codes, before values are shortened."""
    return F.when((amenity == "hospital") & has_emergency(codes), "yes").otherwise("")


def beds_tag(beds: Column) -> Column:
    """The number of beds where it is digits above 0."""
    b = blank(beds)
    return F.when(b.rlike(r"^\d+$") & b.rlike("[1-9]"), b).otherwise("")


def needs_review_hours(n_excluded: Column, n_conflicts: Column, hours: Column, unparsed: Column, comment: Column) -> Column:
    lost = (blank(unparsed) != "") & (blank(comment) == "") & ~blank(unparsed).isin(*NO_CLOSURE)
    return F.when((n_excluded > 0) | (n_conflicts > 0) | (blank(hours) == "") | lost, "yes").otherwise("")


def needs_review_name(name: Column, why: Column) -> Column:
    return F.when((blank(name) == "") | (blank(why) != ""), "yes").otherwise("")


def needs_review(*marks: Column, town_note: Column, number_dropped: Column) -> Column:
    """One of the parts asks for a review, or a town or a number was not written."""
    any_mark = F.array_contains(F.array(*[blank(m) != "" for m in marks]), True)
    return F.when(any_mark | (blank(town_note) != "") | F.coalesce(number_dropped, F.lit(False)), "yes").otherwise("")


def checked_numbers(evidence: Column, block: Column, house: Column) -> Column:
    """Struct (block, house, dropped): inferred numbers are not written, and only a number that was there is dropped."""
    inferred = F.coalesce(evidence, F.lit("")) == "推定"
    b, h = F.coalesce(block, F.lit("")), F.coalesce(house, F.lit(""))
    return F.struct(F.when(inferred, "").otherwise(b).alias("block"), F.when(inferred, "").otherwise(h).alias("house"), (inferred & ((b != "") | (h != ""))).alias("dropped"))


def coord_note(reason: Column, level: Column) -> Column:
    """Why a geocoded point replaced the source, else the level of the address point."""
    return F.when(blank(reason) != "", blank(reason)).otherwise(F.concat(F.lit("座標は住所から付与（位置レベル"), level.cast("string"), F.lit("）")))


def asked_note(review: Column, why: Column) -> Column:
    """What a part asks of a reviewer; nothing where it has no mark. For names and hours."""
    return F.when(blank(review) == "", "").otherwise(blank(why))


def number_note(verdict: Column) -> Column:
    out = F.lit(NUMBER_NOTE)
    for kind, note in NUMBER_NOTES.items():
        out = F.when(blank(verdict) == kind, note).otherwise(out)
    return out


def checked_town(town: Column, correction: Column) -> Column:
    """Struct (town, note): a town that the address does not name is not written, and the note has the correction."""
    wrong = blank(correction) != ""
    return F.struct(F.when(wrong, "").otherwise(F.coalesce(town, F.lit(""))).alias("town"), F.when(wrong, F.concat(F.lit(TOWN_NOTE), blank(correction))).otherwise("").alias("note"))


def discarded_point(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("元データの座標 "), F.trim(lat), F.lit(", "), F.trim(lon))


def adopted_point(lat: Column, lon: Column, level: Column, reason: Column, rule: Column, notes: Column, residue: Column) -> Column:
    """Struct of a row that takes the address point: the point, its level and meaning, the reason, its rule, and the note."""
    meaning = F.lit("")
    for n, text in LEVELS.items():
        meaning = F.when(level == n, text).otherwise(meaning)
    rest = F.when(blank(residue) != "", F.concat(F.lit("住所の未解釈部分: "), residue)).otherwise("")
    return F.struct(
        lat.alias("lat"), lon.alias("lon"), F.lit("ジオコーディング").alias("origin"), level.cast("string").alias("level"), meaning.alias("level_meaning"),
        F.lit("yes").alias("review"), reason.alias("reason"), rule.alias("rule"), join_notes([notes, reason, rest]).alias("note"),
    )


def hours_notes(overnight: Column, exclusions: Column, withheld_days: Column, unknown_days: Column, n_conflicts: Column, decisions: Column, nth: Column, n_dates: Column, comment: Column, unparsed: Column) -> Column:
    """Struct (note, why) of a facility's hours: all that was done, and what asks for work only.

    ``exclusions`` is an array of sentences; the other texts may be empty. What the tag itself holds is recorded;
    excluded times, undecided days, conflicts and closures that were not understood ask for work.
    """
    when = lambda cond, *text: F.when(cond, F.concat(*[t if isinstance(t, Column) else F.lit(t) for t in text])).otherwise("")
    text = F.substring(blank(unparsed), 1, 40)
    kept = (blank(comment) != "") | text.isin(*NO_CLOSURE)
    excluded = F.array_join(F.coalesce(exclusions, F.array().cast("array<string>")), " / ")
    asked = [
        excluded,
        F.when(blank(withheld_days) != "", F.concat(F.lit("opening_hours をタグ出力していない。営業日の"), withheld_days, F.lit("曜に時刻の記載が無い")))
        .when(blank(unknown_days) != "", F.concat(F.lit("営業日の"), unknown_days, F.lit("曜に時刻の記載が無いため opening_hours に unknown と書いた")))
        .otherwise(""),
        when((n_conflicts > 0) & (blank(decisions) != ""), "営業曜日と時刻が食い違う曜日が", n_conflicts.cast("string"), "件。", decisions),
    ]
    lost = when((text != "") & ~kept, "休診日の記述「", text, "」を opening_hours に変換できていない")
    recorded = [
        when(blank(nth) != "", "定期週の休診を反映: ", nth),
        when(n_dates > 0, "その他の休診日から", n_dates.cast("string"), "日を反映"),
        when(blank(comment) != "", "日付不明の休診期間をコメントに退避: ", comment),
    ]
    first = when(overnight > 0, "日跨ぎとして採用 ", overnight.cast("string"), "件")
    harmless = when((text != "") & kept, "未変換の休診日記述: ", text)
    return F.struct(join_notes([first, *asked, *recorded, harmless, lost]).alias("note"), join_notes([*asked, lost]).alias("why"))
