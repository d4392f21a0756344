"""What filters of a corpus do to each other: posting lists of failing ids, merged by galloping over id ranges."""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import let, materialize, sized_batches, words_of

#: A range holds 2 ** RANGE_BITS ids. A range of a part is one row of posting lists, so that this bounds a list.
RANGE_BITS = 14
#: Orders are the permutations of the filters: 720 for six.
MOST_FILTERS = 6


def standard_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: A short, B repetitive, C capitals, D symbols. Null texts are empty."""
    t = F.coalesce(text, F.lit(""))
    counts = let(words_of(t), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))
    fails = let(counts, lambda c: F.struct((c["n"] < 200).alias("A"), (100 * c["distinct"] < 50 * c["n"]).alias("B")))
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    return {"A": fails["A"], "B": fails["B"], "C": 100 * capitals > 2 * F.length(t), "D": t.rlike("[#$%&*|]")}


def with_failures(docs: DataFrame, filters: dict[str, Column], repeats: str, *, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, mask): bit k of the mask is set if the k-th filter by name fails, ``repeats`` among them.

    ``repeats`` fails for a row whose text stands under a smaller id anywhere in the table. The texts' 128-bit hashes are
    grouped to their smallest ids, and rows find themselves among these by hash and id together: a text that is a third
    of all rows is one row of a partial aggregate, and no key of the join is hot but that of a row repeated as a whole.
    """
    names = sorted([*filters, repeats])
    t = F.coalesce(F.col(text_col), F.lit(""))
    bits = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << names.index(k)) for k, c in filters.items()), F.lit(0))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), bits.alias("bits"), F.unhex(F.md5(t)).alias("h"))
    rows = materialize(read, "failures")
    first = rows.filter("doc_id IS NOT NULL").groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    own = rows.join(first, ["doc_id", "h"], "left")
    again = (F.col("doc_id").isNotNull() & F.col("first").isNull()).cast("int") * (1 << names.index(repeats))
    return own.select("doc_id", "part", (F.col("bits") + again).alias("mask"))


def posting_lists(failures: DataFrame, labels: DataFrame, n_filters: int, *, id_col: str = "doc_id", good: str = "quality", bad: str = "toxic", range_bits: int = RANGE_BITS) -> DataFrame:
    """One row a part and range of ids: n, and sorted lists of the ids that fail each filter and that have either label.

    An entry of a list is the id's place in its range with the mask behind it, so that rows of one id that fail
    differently are entries of their own, at most ``2 ** (range_bits + n_filters)`` a range. Rows that are alike are
    counted before they are gathered, and ``weighted`` lists entries that stand for several rows.
    A label holds for an id if any of its rows says so.
    """
    held = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(good) == 1).alias("good"), F.max(F.col(bad) == 1).alias("bad"))
    marked = failures.join(held, "doc_id", "left")
    place = F.coalesce(F.col("doc_id").bitwiseAND((1 << range_bits) - 1), F.lit(0)).cast("int")
    keyed = marked.select(
        "part", F.shiftright("doc_id", range_bits).alias("range"), (F.shiftleft(place, n_filters) + F.col("mask")).alias("entry"), "mask",
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "bad")],
    )
    counted = keyed.groupBy("part", "range", "entry", "mask", "good", "bad").agg(F.count(F.lit(1)).alias("n"))
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("entry"))))
    failing = [listed(F.col("mask").bitwiseAND(1 << k) != 0).alias(f"fails{k}") for k in range(n_filters)]
    weighted = F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.struct("entry", "n")))).alias("weighted")
    return counted.groupBy("part", "range").agg(F.sum("n").alias("n"), *failing, listed(F.col("good")).alias("good"), listed(F.col("bad")).alias("bad"), weighted)


def gallop(ids: np.ndarray, within: np.ndarray) -> np.ndarray:
    """For each of the sorted ``ids`` the first place of the sorted list ``within`` that is not smaller.

    Every id starts where it would stand if both lists were spread alike, steps double away from there until they
    bracket its place, and the bracket is halved. All ids step at once.
    """
    n = len(within)
    if not n:
        return np.zeros(len(ids), np.int64)
    low = np.arange(len(ids)) * n // max(len(ids), 1)
    high, step = low.copy(), 1
    while (on := (high < n) & (within[np.minimum(high, n - 1)] < ids)).any():
        low, high = np.where(on, high + 1, low), np.where(on, np.minimum(high + step, n), high)
        step *= 2
    step = 1
    while (on := (low > 0) & (within[low - 1] >= ids)).any():
        low, high = np.where(on, np.maximum(low - step, 0), low), np.where(on, low - 1, high)
        step *= 2
    while (on := low < high).any():
        middle = (low + high) // 2
        less = within[np.minimum(middle, n - 1)] < ids
        low, high = np.where(on & less, middle + 1, low), np.where(on & ~less, middle, high)
    return low


def members(ids: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ids`` stand in the sorted list ``within``; the shorter list gallops through the longer."""
    if len(ids) <= len(within):
        at = gallop(ids, within)
        return (at < len(within)) & (within[np.minimum(at, len(within) - 1)] == ids) if len(within) else np.zeros(len(ids), bool)
    out = np.zeros(len(ids) + 1, bool)
    at = gallop(within, ids)
    out[at[ids[np.minimum(at, len(ids) - 1)] == within]] = True
    return out[: len(ids)]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of two sorted lists: ids of the shorter one that the longer one lacks are put in at their places."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    new = short[~members(short, long)]
    return np.insert(long, gallop(new, long), new) if len(new) else long


def union_sizes(fails: list[np.ndarray], good: np.ndarray, bad: np.ndarray, entries: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """``[2 ** filters, 3]``: for every set of filters the rows that fail any of them, and of these the good and the bad.

    A k-way union is the union of one filter less, which is merged but once, and one list more. ``extra`` rows stand
    behind some ``entries`` besides the one that each entry counts.
    """
    out = np.zeros((1 << len(fails), 3), np.int64)
    unions = {0: np.zeros(0, np.int64)}
    counted = [(None, entries, extra)]
    for ids in (good, bad):
        own = members(entries, ids)
        counted.append((ids, entries[own], extra[own]))
    for s in range(1, len(out)):
        last = s.bit_length() - 1
        union = unions[s] = merge(unions[s & ~(1 << last)], fails[last])
        for k, (ids, own, more) in enumerate(counted):
            plain = len(union) if ids is None else np.count_nonzero(members(ids, union))
            out[s, k] = plain + (int(more[members(own, union)].sum()) if len(own) else 0)
    return out


def _merge_ranges(n_filters: int):
    """Per part of a batch: rows in all (set -1), and the sizes of every union of lists, summed over the batch's ranges."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            column = {c: batch.column(c) for c in batch.schema.names}
            ids = lambda c, i: column[c][i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            for i, (part, n) in enumerate(zip(column["part"].to_pylist(), column["n"].to_pylist(), strict=True)):
                several = column["weighted"][i].values
                entries, rows = (several.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                sizes = union_sizes([ids(f"fails{k}", i) for k in range(n_filters)], ids("good", i), ids("bad", i), entries, rows - 1)
                sums[part] = sums.get(part, 0) + np.concatenate([[[n, 0, 0]], sizes])
            every = np.concatenate([*sums.values(), np.zeros((0, 3), np.int64)])
            parts = pa.array(list(sums), pa.string()).take(pa.array(np.repeat(np.arange(len(sums)), (1 << n_filters) + 1)))
            sets = pa.array(np.tile(np.arange(-1, 1 << n_filters, dtype=np.int32), len(sums)))
            yield pa.RecordBatch.from_arrays([parts, sets, *[pa.array(every[:, k]) for k in range(3)]], ["part", "set", "n", "good", "bad"])

    return of


def _steps(names: list[str]) -> Column:
    """Array of all orders and steps: filter_order, step, place of the step's filter, the set of it alone and of those before it."""
    rows = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append({"filter_order": "".join(names[k] for k in order), "step": step, "f": f, "own": 1 << f, "before": before})
            before |= 1 << f
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,f:int,own:int,before:int>>")


def filter_audit(docs: DataFrame, labels: DataFrame, *, filters: dict[str, Column] | None = None, repeats: str = "E", id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", range_bits: int = RANGE_BITS) -> DataFrame:
    """Per part, order of all filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``filters`` are failure conditions by name (``standard_filters`` unless given), to which ``repeats`` adds texts that
    stand under a smaller id. Rows are read once; posting lists of a part's id ranges are merged where they are, and
    only the sizes of the unions travel on: everything else is differences of these. A step removes what the union
    with its filter has more than the union before it.

    Null texts are empty, a null part is the empty one, null conditions do not fail. A row with a null id repeats nothing,
    is repeated by nothing and has no label. Repeated rows count each; rows of one id with equal texts do not repeat each
    other. Labels of ids that no document has are ignored. Other columns are not read. An empty table has no part and
    gives no row.
    """
    filters = standard_filters(F.col(text_col)) if filters is None else filters
    names = sorted([*filters, repeats])
    n = len(names)
    if n > MOST_FILTERS or len(set(names)) < n:
        raise ValueError(f"filters need different names, {MOST_FILTERS} at most")
    failures = with_failures(docs, filters, repeats, id_col=id_col, text_col=text_col, part_col=part_col)
    lists = posting_lists(failures, labels, n, id_col=id_col, range_bits=range_bits)
    merged = sized_batches(lists.drop("range")).mapInArrow(_merge_ranges(n), "part string, set int, n long, good long, bad long")
    sizes = merged.groupBy("part", "set").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    parts = sizes.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("set", "n", "good", "bad"))).alias("u"))
    # The sizes by set; shapley weights the sets without f by the orders in which they stand before it.
    whole, unions = F.col("u")[0]["n"], F.slice("u", 2, 1 << n)
    weight = lambda s, f: factorial(s.bit_count() - 1) * factorial(n - s.bit_count()) if s >> f & 1 else -factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())
    shapley = F.array(*[F.aggregate(F.zip_with(F.col("v"), F.array(*[F.lit(weight(s, f)).cast("long") for s in range(1 << n)]), lambda x, w: x["n"] * w), F.lit(0).cast("long"), lambda a, x: a + x) for f in range(n)])
    wide = parts.select("part", whole.alias("whole"), unions.alias("v")).withColumn("shapleys", shapley)
    rows = wide.select("part", "whole", "v", "shapleys", F.explode(_steps(names)).alias("s")).select("part", "whole", "v", "shapleys", "s.*")
    at = lambda s: F.get("v", s)
    then, before = at(F.col("before").bitwiseOR(F.col("own"))), at(F.col("before"))
    removed = then["n"] - before["n"]
    return rows.select(
        "part", "filter_order", "step", (F.col("whole") - then["n"]).alias("kept"), removed.alias("removed"), (at(F.col("own"))["n"] - removed).alias("redundant"),
        (at(F.lit((1 << n) - 1))["n"] - at(F.lit((1 << n) - 1).bitwiseXOR(F.col("own")))["n"]).alias("unique_fails"), (then["good"] - before["good"]).alias("good_lost"),
        (then["bad"] - before["bad"]).alias("toxic_lost"), F.get("shapleys", F.col("f")).alias("shapley"),
    )
