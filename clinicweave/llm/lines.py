"""Line dedup by a segment-partition edit join, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import BROADCAST_BYTES, join_bounded, let, materialize

#: Lines within so many edits count as one line.
MAX_EDITS = 2
#: Lines of fewer characters are alike only where they are equal: two edits make another line of them.
LEAST_CHARS = 24
#: In a key of more lines, lines are brought together by where they deviate from its earliest one.
FREQUENT = 32
#: Places of a line that make one block.
PLACES = 32


def _pieces(edits: int) -> list[tuple[bool, int, int, int]]:
    """(probe, shorter, segment, shift) of the pieces that a line has a key for.

    A line's own segments come first. Then the substrings that can equal a segment of a line that is up to ``edits``
    characters shorter: of the places of a segment those that leave as many edits on its left as segments stand
    there, and as many on its right. For 2 edits these are 12 substrings over the three lengths.
    """
    own = [(False, 0, i, 0) for i in range(edits + 1)]
    shifts = lambda shorter, i: range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1)
    return own + [(True, shorter, i, shift) for shorter in range(edits + 1) for i in range(edits + 1) for shift in shifts(shorter, i)]


def segment_keys(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(h1, h2, probe, key) of lines (h1, h2, line): a row for each piece, by its text, its segment and that line's length.

    Segments are equal parts, the longer ones last. Pieces are rows, so that their keys are compiled code.
    """
    parts = edits + 1
    pieces = F.array(*[F.struct(F.lit(p).alias("probe"), F.lit(n).alias("shorter"), F.lit(i).alias("i"), F.lit(x).alias("shift")) for p, n, i, x in _pieces(edits)])
    rows = lines.select("h1", "h2", "line", F.length("line").alias("n")).withColumn("p", F.explode(pieces))
    rows = rows.select("h1", "h2", "line", "n", "p.*", (F.col("n") - F.col("p.shorter")).alias("other"))
    rows = rows.withColumn("longer", F.col("other") % parts).withColumn("base", F.floor((F.col("other") - F.col("longer")) / parts).cast("int"))
    rows = rows.withColumn("start", F.col("i") * F.col("base") + F.greatest(F.lit(0), F.col("i") - parts + F.col("longer")) + F.col("shift"))
    rows = rows.withColumn("size", F.col("base") + (F.col("i") >= parts - F.col("longer")).cast("int"))
    fits = (F.col("other") >= least) & (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n"))
    piece = F.substring("line", F.col("start") + 1, F.col("size"))
    return rows.filter(fits).select("h1", "h2", "probe", F.xxhash64("other", "i", piece).alias("key"))


def _some_lines(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, line, first) of the occurrences (rid, no) in ``wanted``; each text is read once and joined to its list.

    ``let`` splits a text once: a plain column would be moved into the lambda and split again for every line.
    """
    lists = materialize(wanted.groupBy("rid").agg(F.collect_list("no").alias("nos")), "line-numbers")
    n, total = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("nos")), F.lit(0))).first()
    joined = rows.join(F.broadcast(lists) if 64 * n + 4 * total <= BROADCAST_BYTES else lists.hint("merge"), "rid")
    numbered = lambda x: F.transform("nos", lambda i: F.struct(i.alias("no"), F.get(x, i).alias("line")))
    one = joined.select("doc_id", "rid", F.explode(let(F.split("text", "\n", -1), numbered)).alias("x"))
    place = F.struct("doc_id", "rid", F.col("x.no").alias("no"))
    return one.select(F.xxhash64("x.line").alias("h1"), F.xxhash64(F.reverse("x.line")).alias("h2"), F.col("x.line").alias("line"), place.alias("first"))


def _common(t: Column, i: Column, j: Column) -> Column:
    """Length of the common prefix of ``t.a`` from character ``i`` and ``t.b`` from ``j``, by halving steps.

    ``t`` also has the lengths of both, so that nothing is counted or reversed again at every step.
    """

    def of(most: Column) -> Column:
        steps = F.transform(F.sequence(F.ceil(F.log2(most + 1)).cast("int"), F.lit(0)), lambda k: F.call_function("shiftleft", F.lit(1), k))
        same = lambda n, step: (n + step <= most) & (F.substring(t["a"], i + n + 1, step) == F.substring(t["b"], j + n + 1, step))
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(same(n, step), n + step).otherwise(n))

    return let(F.greatest(F.least(t["la"] - i, t["lb"] - j), F.lit(0)), of)


def _reach(a: Column, b: Column, edits: int) -> Column:
    """Struct of the common prefix of ``a`` and ``b`` and of the longest prefix of ``b`` that is within ``edits`` edits
    of some prefix of ``a``: the furthest points of the diagonals, an edit at a time."""

    def of(t: Column) -> Column:
        follow = lambda s: let(_common(t, s["i"], s["j"]), lambda n: F.struct((s["i"] + n).alias("i"), (s["j"] + n).alias("j")))
        spot = lambda i, j: let(F.struct(F.least(i, t["la"]).alias("i"), F.least(j, t["lb"]).alias("j")), follow)

        def after(spots: Column, n: int) -> Column:
            if n == 0:
                return F.array_max(F.transform(spots, lambda s: s["j"]))
            return let(F.array_distinct(F.flatten(F.transform(spots, lambda s: F.array(spot(s["i"] + 1, s["j"] + 1), spot(s["i"] + 1, s["j"]), spot(s["i"], s["j"] + 1))))), lambda x: after(x, n - 1))

        return let(spot(F.lit(0), F.lit(0)), lambda s: F.struct(s["i"].alias("same"), after(F.array(s), edits).alias("far")))

    return let(F.struct(a.alias("a"), b.alias("b"), F.length(a).alias("la"), F.length(b).alias("lb")), of)


def _signature(line: Column) -> Column:
    """64 bits: each is the parity of the number of character pairs in a class. An edit changes four of them at most."""
    pairs = lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda c, d: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c, d), F.lit(64))))
    return F.aggregate(let(F.split(line, ""), pairs), F.lit(0).cast("long"), lambda bits, bit: bits.bitwiseXOR(bit))


def _deviating(big: DataFrame, texts, edits: int) -> DataFrame:
    """Pairs (h1, h2, g1, g2) of frequent keys that may be similar, g the earlier line; of rows (key, h1, h2, g1, g2,
    probe, first, done), g being the key's earliest line, the hub, and ``texts(a, b, name)`` the texts by their hashes.

    A line x leaves the hub r after ``left`` characters and comes back to it for good at ``right``. With all edits spent
    it follows r up to ``far`` from the left, and from ``near`` on seen from the right. If y is similar to x, y's part
    before its own ``left`` is r's, so that x follows it: left(y) <= far(x), and all of that the other way round and
    from the right. So intervals [left, far] of two lines that are not similar to r meet, and an earlier y that is
    similar to r has [left, right] around far(x) or in touch with [near(x), far(x)]. Blocks of places make keys of it.
    Lines that deviate in the same places still have to agree in their signatures but for the bits that the edits change.

    A line is held against a hub once, however many keys they share.
    """
    size = F.length("hub")
    both = materialize(big.select("h1", "h2", "g1", "g2").distinct(), "lines-and-hubs").join(texts("h1", "h2", "line"), ["h1", "h2"]).join(texts("g1", "g2", "hub"), ["g1", "g2"])
    both = both.select("h1", "h2", "g1", "g2", size.alias("size"), _signature(F.col("line")).alias("bits"), _reach(F.col("line"), F.col("hub"), edits).alias("a"), _reach(F.reverse("line"), F.reverse("hub"), edits).alias("z"))
    both = materialize(both, "line-deviations")
    both = both.select("h1", "h2", "g1", "g2", "bits", F.col("a.same").alias("left"), F.col("a.far").alias("far"), (F.col("size") - F.col("z.same")).alias("right"), (F.col("size") - F.col("z.far")).alias("near"))
    rows = materialize(join_bounded(big, both, ["h1", "h2", "g1", "g2"], "inner", 64), "deviating-lines")
    blocks = lambda x, y: F.explode(F.sequence(F.floor(x / PLACES), F.floor(F.greatest(x, y) / PLACES))).alias("block")
    left, far, right, near = (F.col(c) for c in ("left", "far", "right", "near"))
    sides = ("key", "h1", "h2", "probe", "first", "bits", "left", "far", "right", "near")
    found = None
    for like_hub, own, its in ((False, (left, far), (left, far)), (True, (F.least(near, far), far), (left, right))):
        x = rows.filter("not done").select(*sides, blocks(*own))
        y = rows.filter(F.col("done") == like_hub).select("key", *[F.col(c).alias(f"y_{c}") for c in sides[1:]], blocks(*its))
        meet = (F.col("y_first") < F.col("first")) & (F.col("y_probe") != F.col("probe")) & (F.col("y_left") <= far) & (left <= F.col("y_far")) & (F.col("y_right") >= near) & (right >= F.col("y_near"))
        alike = F.bit_count(F.col("bits").bitwiseXOR(F.col("y_bits"))) <= 4 * edits
        pairs = x.join(y, ["key", "block"]).filter(meet & alike).select("h1", "h2", F.col("y_h1").alias("g1"), F.col("y_h2").alias("g2"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def near_earlier(rows: DataFrame, distinct: DataFrame, edits: int, least: int) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within ``edits`` edits.

    ``distinct`` has (h1, h2, rid, no): a line and its first occurrence. A line is cut into ``edits + 1`` segments; of
    two similar lines one holds a segment of the other unchanged, at a place that differs by the edits before it. So
    keys of segments and of probed substrings bring them together, and the banded Levenshtein distance decides.

    A line needs one similar earlier line, so that pairs come in turns and a line leaves at its first match. First each
    line meets the earliest one of each of its keys. Lines that remain meet the other earlier ones of their rare keys.
    In keys of more than ``FREQUENT`` lines they meet those that deviate from the earliest line in the same places.
    """
    lines = _some_lines(rows, distinct.select("rid", "no"))
    keyed = materialize(segment_keys(lines, edits, least), "segment-keys")
    spread = (F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2"))
    shared = materialize(keyed.groupBy("key").agg(F.min("probe").alias("probe"), spread.alias("spread")).filter("spread and not probe").select("key"), "shared-keys")
    met = materialize(join_bounded(keyed, shared, "key", "left_semi", 16).distinct(), "keyed-lines")
    needed = materialize(met.select("h1", "h2").distinct(), "needed-lines")
    texts = _some_lines(rows, join_bounded(distinct, needed, ["h1", "h2"], "left_semi", 32).select("rid", "no"))
    texts = materialize(texts.dropDuplicates(["h1", "h2"]), "line-texts")
    n, total = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("line")), F.lit(0))).first()
    fits = 96 * n + total <= BROADCAST_BYTES
    of = lambda a, b, name: (F.broadcast if fits else lambda x: x)(texts.select(F.col("h1").alias(a), F.col("h2").alias(b), F.col("line").alias(name)))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        near = pairs.join(of("h1", "h2", "line"), ["h1", "h2"]).join(of("g1", "g2", "other"), ["g1", "g2"]).filter(F.levenshtein("line", "other", edits) >= 0)
        return materialize(near.select("h1", "h2").distinct(), name)

    firsts = texts.select("h1", "h2", "first")
    members = materialize(met.join(firsts, ["h1", "h2"]), "key-members")
    hubs = members.groupBy("key").agg(F.min(F.struct("first", "h1", "h2")).alias("m"), F.count(F.lit(1)).alias("n"))
    hubs = materialize(hubs.select("key", F.col("m.h1").alias("g1"), F.col("m.h2").alias("g2"), "n"), "key-hubs")
    other = (F.col("h1") != F.col("g1")) | (F.col("h2") != F.col("g2"))
    rest = join_bounded(members, hubs, "key", "inner", 40).filter(other)
    near = verified(rest.select("h1", "h2", "g1", "g2").distinct(), "near-hub")

    marked = join_bounded(rest, near.withColumn("done", F.lit(True)), ["h1", "h2"], "left", 24).withColumn("done", F.coalesce("done", F.lit(False)))
    marked = materialize(marked, "open-lines")
    rare = marked.filter(F.col("n") <= FREQUENT)
    earlier = rare.select("key", F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("first").alias("y_first"), F.col("probe").alias("y_probe"))
    pairs = rare.filter("not done").drop("g1", "g2").join(earlier, "key").filter((F.col("y_first") < F.col("first")) & (F.col("y_probe") != F.col("probe")))
    pairs = pairs.select("h1", "h2", "g1", "g2")
    big = marked.filter(F.col("n") > FREQUENT)
    if not big.isEmpty():
        pairs = pairs.unionByName(_deviating(big.drop("n"), of, edits))
    return near.unionByName(verified(pairs.distinct(), "near-others")).distinct()


def line_dedup(docs: DataFrame, *, edits: int = MAX_EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, n_near (removed without an equal earlier line), kept_sha256.

    Lines are what stands between line feeds. A line with a word is removed where it occurs earlier: in a document with
    a smaller id, or above in the same one; one of ``least`` characters or more also where a line of as many within
    ``edits`` edits of it occurs earlier. Lines without a word stay. Likeness is not carried on from line to line. Null texts are one empty line; rows with equal ids are
    ordered by a hash of their text, and rows that are equal in full are one document; rows with a null id stay whole.

    Lines travel as 128-bit hashes with their places; equal lines are aggregated before the shuffle. Texts are only
    read again for one occurrence of each different line, and for the pairs that have to be verified.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))
    all_lines = rows.filter("doc_id is not null").select("doc_id", "rid", F.posexplode(F.split("text", "\n", -1)).alias("no", "line")).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    places = materialize(all_lines.select("doc_id", "rid", "no", (F.length("line") >= least).alias("long"), F.xxhash64("line").alias("h1"), F.xxhash64(F.reverse("line")).alias("h2")), "line-places")
    place = F.struct("doc_id", "rid", "no")
    distinct = materialize(places.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.max("long").alias("long")), "lines")

    near = materialize(near_earlier(rows, distinct.filter("long").select("h1", "h2", "first.rid", "first.no"), edits, least), "near-lines")
    alike = join_bounded(distinct, near.withColumn("near", F.lit(True)), ["h1", "h2"], "left", 24)
    affected = alike.filter((F.col("n") > 1) | F.col("near")).select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))

    gone = places.join(affected, ["h1", "h2"]).filter(F.col("near") | (F.col("first") < place))
    removed = materialize(gone.groupBy("rid").agg(F.collect_set("no").alias("nos"), F.count_distinct(F.when(F.col("first") == place, F.col("no"))).alias("near")), "removed-lines")
    n, total = removed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("nos")), F.lit(0))).first()
    joined = rows.join(F.broadcast(removed) if 64 * n + 4 * total <= BROADCAST_BYTES else removed.hint("merge"), "rid", "left")
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("nos").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("nos", i)), "\n"))
    return joined.select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("nos"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.sha2(kept, 256).alias("kept_sha256"),
    )
