"""Mixing sources to target weights by a splitting tree over blocks, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicweave.llm.common import join_bounded, let, materialize, n_words_of

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its size.
MAX_PASSES = 3
#: 2 ** LEVELS output shards.
LEVELS = 4
SEED = "mix-1"

_FIRST = Window.unboundedPreceding


def _hex_byte(digest: Column, at: int) -> Column:
    """A byte of a hexadecimal digest, 0 to 255."""
    return F.conv(F.substring(digest, 2 * at + 1, 2), 16, 10).cast("int")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) of rows (source, size).

    Sources are ordered by code point, null last, and get the weights in turn. The sum of all sizes is shared by
    weight; a target that would exceed ``passes`` times its source's size stops there, and the excess is shared
    again. In order of (bound / weight) the stopped sources come first: the first source whose bound holds what is
    left for its weight ends them, so that no iteration is needed. One row a source.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sums.withColumn("_w", w[rank % len(weights)]).withColumn("_cap", (passes * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy())
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(_FIRST, -1)), F.lit(0.0))
    left = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", (total - before) / left).withColumn("_stops", F.col("_cap") < F.col("_level") * F.col("_w"))
    # The level of the first source that does not stop holds for all that follow it.
    level = F.min(F.when(~F.col("_stops"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level"))))
    rows = rows.withColumn("_share", level.over(Window.partitionBy())["_level"])
    return rows.select("source", "source_size", F.least("_cap", F.coalesce(F.col("_w") * F.col("_share"), F.col("_cap"))).alias("target"))


def _left_quotas(quotas: Column, seed: Column) -> Column:
    """Struct of the quotas of the left and of the right child of a node: a multivariate hypergeometric draw.

    The left child gets half of all units. Units are decided one by one, each taken with the chance (still wanted) /
    (still there), which takes exactly half and gives the counts by source their joint law.
    """
    total = F.aggregate(quotas, F.lit(0), lambda a, q: a + q)
    chance = lambda i, t: F.pmod(F.xxhash64(seed, i, t), F.lit(1 << 31)) / float(1 << 31)

    def unit(a: Column, i: Column, t: Column) -> Column:
        return let((chance(i, t) * a["there"] < a["wanted"]).cast("int"), lambda take: F.struct((a["wanted"] - take).alias("wanted"), (a["there"] - 1).alias("there"), (a["taken"] + take).alias("taken")))

    def source(acc: Column, i: Column) -> Column:
        begin = F.struct(acc["wanted"].alias("wanted"), acc["there"].alias("there"), F.lit(0).alias("taken"))
        end = F.aggregate(F.filter(F.sequence(F.lit(0), quotas[i]), lambda t: t > 0), begin, lambda a, t: unit(a, i, t))
        return let(end, lambda e: F.struct(e["wanted"].alias("wanted"), e["there"].alias("there"), F.concat(acc["left"], F.array(e["taken"])).alias("left")))

    begin = F.struct(F.ceil(total / 2).cast("int").alias("wanted"), total.alias("there"), F.array().cast("array<int>").alias("left"))
    left = F.aggregate(F.sequence(F.lit(0), F.size(quotas) - 1), begin, source)["left"]
    return let(left, lambda x: F.struct(x.alias("left"), F.zip_with(quotas, x, lambda q, n: q - n).alias("right")))


def shard_quotas(quotas: DataFrame, levels: int = LEVELS, seed: str = SEED) -> DataFrame:
    """(_s, shard, _from, _to) of rows (_s, quota): the units of each source that each shard draws, as a run of them.

    A splitting tree over the vector of all quotas: every node deals its vector to two children by a hypergeometric
    draw, down to ``2 ** levels`` shards. A row a node, as long as there are sources.
    """
    node = quotas.agg(F.array_sort(F.collect_list(F.struct("_s", "quota"))).alias("x")).filter(F.size("x") > 0)
    node = node.select(F.lit(1).alias("node"), F.col("x._s").alias("_s"), F.col("x.quota").alias("quota"))
    for _ in range(levels):
        halves = node.select("node", "_s", _left_quotas(F.col("quota"), F.xxhash64(F.lit(seed), "node")).alias("h"))
        child = F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), F.col("h.left").alias("quota")), F.struct((2 * F.col("node") + 1).alias("node"), F.col("h.right").alias("quota"))))
        node = materialize(halves.select("_s", child.alias("c")).select("c.node", "_s", "c.quota"), "mix-tree")
    runs = node.select((F.col("node") - (1 << levels)).alias("shard"), F.explode(F.arrays_zip("_s", "quota")).alias("z")).select("z._s", "shard", "z.quota")
    to = F.sum("quota").over(Window.partitionBy("_s").orderBy("shard").rowsBetween(_FIRST, 0))
    return runs.withColumn("_to", to).withColumn("_from", F.col("_to") - F.col("quota")).drop("quota")


def mix_plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES, levels: int = LEVELS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Tables (documents with size, source_size, target) and (draws: doc_id, _row, _key, copy, shard, place).

    ``key_col`` names a column that draws carry as ``_key``, the id if none is given.

    A source's documents fall into 256 permuted blocks by a seeded hash of the id. The mix takes whole passes over a
    source, then blocks in permuted order until the rest of its target is met; the block at the edge is cut into 256
    smaller ones in the same way, and the one at that edge by documents; one more document fills the gap that is left
    if that comes nearer to the target. So a draw never exceeds ``passes`` times a document, and reruns draw alike.

    Blocks times passes are the units, and their numbers by source the quotas, which ``shard_quotas`` splits exactly
    among ``2 ** levels`` shards. Every shard draws its quota of each source from the source's permuted units: the
    runs of the shards are disjoint and leave nothing over. ``place`` shuffles a shard locally.

    Null sources are one source, null texts have size 0, equal ids fall into one block, repeated rows are rows, texts
    of any length count whole, extra columns are ignored, an empty table gives empty tables. Windows run over at most
    256 rows a source and pass, except the last one over a 65,536th of a source's documents.
    """
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(key_col or id_col).alias("_key"), F.col(source_col).alias("source"), n_words_of(F.col(text_col)).alias("size"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    rows = materialize(sized.select("doc_id", "_key", "source", "size", F.monotonically_increasing_id().alias("_row"), digest.alias("_d")), "mix-sizes")
    rows = rows.withColumn("_b", _hex_byte(F.col("_d"), 0)).withColumn("_c", _hex_byte(F.col("_d"), 1)).withColumn("_s", F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("v")))

    key = lambda *more: F.md5(F.concat_ws(":", F.lit(seed), F.col("_s.n").cast("string"), F.col("_s.v"), *[F.col(x).cast("string") for x in more]))
    targets = source_targets(rows.select("source", "size"), weights, passes)
    full = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-9), F.lit(passes))).otherwise(0).cast("int")
    targets = targets.withColumn("_full", full).withColumn("_rest", F.greatest(F.lit(0.0), F.col("target") - F.col("_full") * F.col("source_size")))
    targets = materialize(targets.withColumn("_s", F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("v"))).drop("source"), "mix-targets")

    def edge(parts: DataFrame, *by: str) -> DataFrame:
        """Parts with the running size before them; ``_whole`` where they fit, ``_edge`` for the first that doesn't."""
        order = Window.partitionBy("_s").orderBy(key(*by), *by)
        at = F.coalesce(F.sum("_size").over(order.rowsBetween(_FIRST, -1)), F.lit(0))
        out = parts.withColumn("_at", at.cast("double")).withColumn("_whole", F.col("_at") + F.col("_size") <= F.col("_rest"))
        return out.withColumn("_edge", ~F.col("_whole") & (F.col("_at") < F.col("_rest")))

    blocks = materialize(edge(rows.groupBy("_s", "_b").agg(F.sum("size").alias("_size")).join(targets, "_s"), "_b"), "mix-blocks")
    first = blocks.filter("_edge").select("_s", "_b", (F.col("_rest") - F.col("_at")).alias("_rest"))
    inside = rows.join(first, ["_s", "_b"])
    parts = edge(inside.groupBy("_s", "_b", "_c", "_rest").agg(F.sum("size").alias("_size")), "_b", "_c")
    second = parts.filter("_edge").select("_s", "_b", "_c", (F.col("_rest") - F.col("_at")).alias("_rest"))
    last = Window.partitionBy("_s").orderBy("_d", "doc_id", "size", "_row")
    at = F.coalesce(F.sum("size").over(last.rowsBetween(_FIRST, -1)), F.lit(0))
    single = rows.join(second, ["_s", "_b", "_c"]).withColumn("_at", at).filter(F.col("_at") + F.col("size") <= F.col("_rest")).select("_row", "_s", "size")
    partial = rows.join(parts.filter("_whole").select("_s", "_b", "_c"), ["_s", "_b", "_c"]).select("_row", "_s", "size").unionByName(single)
    partial = materialize(partial, "mix-edge")

    # What is left of a source's target goes to the one more document that comes nearest to it.
    whole_sizes = blocks.groupBy("_s").agg(F.first("_rest").alias("_rest"), F.sum(F.when(F.col("_whole"), F.col("_size")).otherwise(0)).alias("_sum"))
    left = whole_sizes.join(partial.groupBy("_s").agg(F.sum("size").alias("_more")), "_s", "left").select("_s", (F.col("_rest") - F.col("_sum") - F.coalesce("_more", F.lit(0))).alias("_left"))
    others = rows.join(blocks.filter("not _whole").select("_s", "_b"), ["_s", "_b"]).join(partial.select("_row"), "_row", "left_anti").join(left, "_s")
    nearest = others.groupBy("_s").agg(F.min(F.struct(F.abs(F.col("_left") - F.col("size")).alias("off"), "_d", "size", "_row")).alias("_m"), F.first("_left").alias("_left"))
    partial = partial.select("_row").unionByName(nearest.filter(F.col("_m.off") < F.col("_left")).select("_m._row"))

    copies = F.col("_full") + F.when(F.col("_whole") | F.col("_edge"), 1).otherwise(0)
    units = blocks.filter(copies > 0).select("_s", "_b", "_full", "_edge", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    units = units.withColumn("_cut", F.col("_edge") & (F.col("copy") > F.col("_full")))
    nth = F.row_number().over(Window.partitionBy("_s").orderBy(key("_b", "copy"), "_b", "copy"))
    units = units.withColumn("_nth", nth).select("_s", "_b", "copy", "_cut", "_nth")
    quotas = materialize(shard_quotas(units.groupBy("_s").agg(F.count(F.lit(1)).cast("int").alias("quota")), levels, seed), "mix-quotas")
    drawn = units.join(quotas, "_s").filter((F.col("_nth") > F.col("_from")) & (F.col("_nth") <= F.col("_to")))
    units = materialize(drawn.select("_s", "_b", "copy", "_cut", "shard"), "mix-units")

    place = F.xxhash64(F.lit(seed), "copy", "_d")
    pick = lambda r, u, on: r.join(u, on).select("doc_id", "_row", "_key", "copy", "shard", place.alias("place"))
    whole = pick(rows, units.filter("not _cut"), ["_s", "_b"])
    cut = pick(rows.join(partial, "_row", "left_semi"), units.filter("_cut").drop("_b"), ["_s"])
    out = rows.join(targets.select("_s", "source_size", "target"), "_s").select("doc_id", "_row", "_key", "source", "size", "source_size", "target")
    return out, whole.unionByName(cut)


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """Per document: size, source_size, target of its source, and the words that the mix takes of it."""
    rows, draws = mix_plan(docs, **options)
    times = draws.groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    taken = F.col("size") * F.coalesce("_n", F.lit(0))
    return rows.join(times, "_row", "left").select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix with all their columns, a row for each time one is taken, shard after shard and each
    shard in its shuffled order.

    Rows that are equal in id and text are taken alike. The draws of a document are joined to it as it is read: as a
    broadcast within a checked size, else by a shuffle. Shards are ranges of (shard, place), so that a large shard is
    many tasks. Helper columns have names of their own, whatever the columns of ``docs`` are called.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    keyed = docs.toDF(*names).withColumn("rid", F.xxhash64(of[id_col], of[text_col]))
    rows, draws = mix_plan(keyed, id_col=of[id_col], key_col="rid", text_col=of[text_col], source_col=of[source_col], **options)
    equal = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("rows"))
    lists = draws.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(F.struct("copy", "shard", "place"))).alias("draws")).join(equal, "_key")
    lists = lists.select(F.col("_key").alias("rid"), F.slice("draws", 1, F.round(F.col("n") / F.col("rows")).cast("int")).alias("draws")).filter(F.size("draws") > 0)
    mixed = join_bounded(keyed, materialize(lists, "mix-draws"), "rid", "inner", 40 + 40 * MAX_PASSES)
    mixed = mixed.select(*names, F.explode("draws").alias("d")).select(*names, "d.shard", "d.place")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "shard", "place").sortWithinPartitions("shard", "place").select(*names).toDF(*docs.columns)
