"""MinHash near-duplicates by an LSH forest: sorted signature orders, prefix neighbours, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicweave.llm.common import bounded_batches, join_bounded, materialize
from clinicweave.llm.graph import components
from clinicweave.llm.tokens import groups

#: Hash functions, orders of the signature, and values of an order that are sorted by.
HASHES, ORDERS, DEPTH = 128, 24, 8
#: Neighbours share so many values of an order at least.
LEAST_PREFIX = 3
#: Within a region of at most so many sets all pairs are candidates; a larger region is searched at greater depth.
REGION = 16
#: A region of more sets that share so many values of an order is a crowd: all pairs of it are tested that links have
#: not joined yet. Of 200,000 simulated pairs at 80 % one shared no order's first three values, 117 no order's first five.
CROWD_DEPTH = 3
#: Sets of a crowd with the most links, which all others are tested against first, and sets of a block of a crowd.
REPRESENTATIVES, BLOCK = 4, 512
#: Candidates whose signatures agree in fewer places than this share of the threshold are dropped: at 128 hashes a
#: pair at the threshold falls below it with a chance of about 1e-8.
SKETCH_SLACK = 0.75
#: Bytes of a shingle's hash in a set that is compared.
HASH_BYTES = 6

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_A = _RNG.integers(1, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_PICKS = np.stack([_RNG.permutation(HASHES)[:DEPTH] for _ in range(ORDERS)])
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """A 64-bit hash of every word of each text, A-Z in lower case; words are what lies between ASCII white space.

    One pass over the bytes of all texts: a word's hash is a difference of prefix sums, shifted to its start.
    """
    raws = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" " + b" ".join(raws) + b" ", np.uint8)
    up, down = _powers(len(data) + 1)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    sums = np.cumsum(_BYTE[data] * up[: len(data)])
    hashes = mix((sums[ends - 1] - sums[starts - 1]) * down[starts] + (ends - starts).astype(np.uint64))
    sizes = np.array([len(r) + 1 for r in raws])
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]) + 1)
    return [hashes[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words are one shingle, none give none."""
    if not len(words):
        return words
    k = min(k, len(words))
    h = words[: len(words) - k + 1]
    for i in range(1, k):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - k + 1 + i])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (x[at : at + 1024] * _A + _B).min(axis=0), out=out)
    return out


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in groups(batch.column("text"), 1 << 20):
                sets = [shingle_set(w, k) for w in word_hashes(group)]
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                signs = [signature(s).tobytes() if len(s) else None for s in sets]
                same = [batch.column(c).slice(at, len(group)) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*same, pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "text_hash", "n_shingles", "key", "sign"])
                at += len(group)

    return run


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in groups(batch.column("text"), 1 << 20):
                sets = [shingle_set(w, k) for w in word_hashes(group)]
                packed = [np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :]).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(group)), pa.array(packed, pa.binary())], ["node", "members"])
                at += len(group)

    return run


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each set and order: the first values of the order, 16 bits each, so that bytes sort like values."""
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), "<u4").reshape(-1, HASHES)
        values = mix(signs.astype(np.uint64)).astype(np.uint16).astype(">u2")
        for order in range(ORDERS):
            labels = np.ascontiguousarray(values[:, _PICKS[order]]).tobytes()
            width = 2 * DEPTH
            fixed = pa.Array.from_buffers(pa.binary(width), len(nodes), [None, pa.py_buffer(labels)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), order, np.int32)), fixed, pa.array(nodes)], ["tree", "label", "node"])


def _neighbours(tree: np.ndarray, labels: np.ndarray, nodes: np.ndarray, new: int) -> np.ndarray:
    """Candidate pairs of sorted rows, the second of which is not before row ``new``."""
    n = len(nodes)
    if n < 2:
        return np.empty((0, 2), np.int64)
    same = (labels[1:] == labels[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.cumprod(same, axis=1).sum(axis=1)  # values that a row shares with the one before it
    sizes = np.zeros((DEPTH + 1, n), np.int32)  # of the region of a row at each depth
    for depth in range(LEAST_PREFIX, DEPTH + 1):
        first = np.concatenate([[True], common < depth])
        at = np.flatnonzero(first)
        sizes[depth] = np.repeat(np.diff(np.append(at, n)), np.diff(np.append(at, n)))
    found, lcp = [], common
    for step in range(1, min(REGION, n - 1) + 1):
        if step > 1:
            lcp = np.minimum(lcp[:-1], common[step - 1 :])
        left = np.flatnonzero(lcp >= LEAST_PREFIX)
        if not len(left):
            break
        left = left[left + step >= new]
        if step > 1:
            left = left[sizes[lcp[left], left] <= REGION]
        found.append(np.stack([nodes[left], nodes[left + step]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    pairs = np.unique(np.sort(pairs, axis=1), axis=0) if len(pairs) else pairs
    none = pa.nulls(len(pairs))
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary()), none.cast(pa.int32())], _EDGE_NAMES)


_EDGE_NAMES = ["a", "b", "part", "tree", "label", "place"]


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of a sorted partition, and its first and last rows for the pairs across partitions."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    keep = 2 * REGION
    tree, labels, nodes = np.empty(0, np.int32), np.empty((0, DEPTH), np.uint16), np.empty(0, np.int64)
    head: tuple | None = None
    for batch in batches:
        t = batch.column("tree").to_numpy()
        x = np.frombuffer(b"".join(batch.column("label").to_pylist()), ">u2").astype(np.uint16).reshape(-1, DEPTH)
        i = batch.column("node").to_numpy()
        new = len(nodes)
        tree, labels, nodes = np.concatenate([tree, t]), np.concatenate([labels, x]), np.concatenate([nodes, i])
        if head is None or len(head[2]) < keep:
            head = tuple(v[:keep] if head is None else np.concatenate([h, v])[:keep] for h, v in zip(head or (t, x, i), (t, x, i), strict=True))
        pairs = _neighbours(tree, labels, nodes, new)
        if len(pairs):
            yield _pair_batch(pairs)
        tree, labels, nodes = tree[-keep:], labels[-keep:], nodes[-keep:]
    for (t, x, i), edge, first in ((head or (tree, labels, nodes), part, len(nodes)), ((tree, labels, nodes), part + 1, 0)):
        n, side = len(i), 1 if edge == part else 0
        if n:
            raw = [r.astype(">u2").tobytes() for r in x]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.nulls(n).cast(pa.int64()), pa.array(np.full(n, edge, np.int32)), pa.array(t), pa.array(raw, pa.binary()), pa.array((np.arange(n) + side * keep).astype(np.int32))], _EDGE_NAMES)


def candidate_pairs(signed: DataFrame) -> DataFrame:
    """Distinct candidate pairs (a, b), a < b, of the sets (node, sign).

    The forest's orders are range-partitioned by (order, values, a random number), so that a region of very many sets
    spreads over tasks; each task walks its sorted rows. Rows at the edges of tasks are walked again together.
    """
    rows = signed.mapInArrow(_orders, "tree int, label binary, node long")
    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "label", "shade", "node"]
    spread = rows.withColumn("shade", F.hash("node", "tree")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "a long, b long, part int, tree int, label binary, place int"
    out = materialize(spread.select("tree", "label", "node").mapInArrow(_sorted_rows, schema), "forest")

    def across(key, pdf):
        pdf = pdf.sort_values("place")
        labels = np.frombuffer(b"".join(pdf["label"]), ">u2").astype(np.uint16).reshape(-1, DEPTH)
        import pandas as pd

        pairs = _neighbours(pdf["tree"].to_numpy(), labels, pdf["a"].to_numpy(), 0)
        pairs = np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    edges = out.filter("b is null").groupBy("part").applyInPandas(across, "a long, b long")
    return out.filter("b is not null").select("a", "b").unionByName(edges).distinct()


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("x", "y"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((x == y).sum(axis=1).astype(np.int32))], ["a", "b", "agree"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), "<u4").reshape(-1, HASHES)
        small = mix(signs.astype(np.uint64)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in small], pa.binary())], ["node", "sketch"])


def _unpack(b: bytes) -> np.ndarray:
    wide = np.zeros((len(b) // HASH_BYTES, 8), np.uint8)
    wide[:, 8 - HASH_BYTES :] = np.frombuffer(b, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view(np.uint64).ravel()


def _overlap(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_overlap(_unpack(x.as_py()), _unpack(y.as_py()), percent) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each set and order: a hash of the order and of its first values, CROWD_DEPTH of them."""
    for batch in batches:
        nodes = batch.column("node")
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), "<u4").reshape(-1, HASHES).astype(np.uint64)
        for order in range(ORDERS):
            h = np.full(len(nodes), order + 1, np.uint64)
            for place in _PICKS[order][:CROWD_DEPTH]:
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + signs[:, place])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), nodes], ["region", "node"])


def crowds(sets: DataFrame) -> DataFrame:
    """(region, node) of the regions of more than REGION sets at CROWD_DEPTH."""
    rows = sets.mapInArrow(_regions, "region long, node long")
    large = materialize(rows.groupBy("region").count().filter(F.col("count") > REGION).select("region"), "large-regions")
    return materialize(join_bounded(rows, large, "region", "left_semi", 16), "crowds")


def _unsettled(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """(region, node, label) of the crowds that hold sets of several components."""
    rows = crowd.join(labels, "node", "left").select("region", "node", F.coalesce("label", "node").alias("label"))
    open_ = rows.groupBy("region").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("region")
    return materialize(join_bounded(rows, materialize(open_, "open-regions"), "region", "left_semi", 16), "open-crowds")


def _to_representatives(crowd: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of the sets of each crowd and those of its sets that have the most links."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    rated = crowd.join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("region").orderBy(F.desc("degree"), "node"))
    some = rated.withColumn("place", place).filter(F.col("place") <= REPRESENTATIVES)
    some = materialize(some.select("region", F.col("node").alias("other"), F.col("label").alias("its")), "representatives")
    met = join_bounded(crowd, some, "region", "inner", 40).filter("label != its")
    return met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _block_pairs(crowd: DataFrame) -> DataFrame:
    """(region, p, q, block, node, label): every two blocks of a crowd whose sets may have different components.

    The sets of the largest component of a crowd are blocks of their own, which never meet one another.
    """
    sizes = crowd.groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
    sums = sizes.groupBy("region").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("long")
    sums = materialize(sums.select("region", F.col("m.label").alias("major"), blocks(F.col("n") - F.col("m.n")).alias("rest"), blocks(F.col("m.n")).alias("most")), "crowd-sizes")
    rows = join_bounded(crowd, sums, "region", "inner", 48)
    salt, minor = F.xxhash64("node"), F.col("label") != F.col("major")
    block = F.when(minor, F.pmod(salt, F.col("rest"))).otherwise(F.col("rest") + F.pmod(salt, F.col("most")))
    last = F.when(minor, F.col("rest") + F.col("most")).otherwise(F.col("rest")) - 1
    rows = rows.withColumn("block", block).select("region", "node", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
    return rows.select("region", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "node", "label")


def _block_links(percent: int):
    """Links of two blocks that join components: pairs that pass the signature check, most similar first, on full sets."""
    bar = int(HASHES * percent / 100 * SKETCH_SLACK)

    def run(table: pa.Table) -> pa.Table:
        t = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("p", "q", "block", "node", "label")}
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
        left, right = np.flatnonzero(t["block"] == t["p"]), np.flatnonzero(t["block"] == t["q"])
        found = []
        for i in left.tolist():
            j = right[t["label"][right] != t["label"][i]]
            agree = (sketch[j] == sketch[i]).sum(axis=1)
            found += [(-n, i, k) for n, k in zip(agree[agree >= bar].tolist(), j[agree >= bar].tolist(), strict=True)]
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                x = up
            return x

        members, sets, out = table.column("members"), {}, []
        for _, i, j in sorted(found):
            x, y = find(t["label"][i]), find(t["label"][j])
            if x == y:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = _unpack(members[k].as_py())
            if _overlap(sets[i], sets[j], percent):
                parent[x] = y
                out.append(sorted((int(t["node"][i]), int(t["node"][j]))))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def near_duplicates(docs: DataFrame, *, shingle_words: int = 2, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable by links), kept (doc_id = component_id).

    Two documents are linked if their sets of distinct shingles overlap by ``percent`` % of their union. Equal sets
    are one class, found by a 128-bit hash; the forest searches one set a class. Candidates pass a signature check
    with a wide margin and are confirmed on the full sets. First every set confirms its most similar candidate; of
    the other candidates only those between different components are left to confirm, so that a group of n near
    copies costs about n comparisons. In a crowd, a region too large for all of its pairs to be candidates, what
    links have not joined is then tested against the sets with the most links, and block against block after that:
    no pair of it stays untested unless it is in one component. Null texts and texts without words are empty and stay
    alone; rows with equal ids are one document for the links of all their texts; a null id has no component and is
    kept. Extra columns are ignored, and an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    plain = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signed = materialize(plain.mapInArrow(_signed(shingle_words), "doc_id long, text_hash long, n_shingles long, key binary, sign binary"), "signed")
    some = signed.filter("key is not null and doc_id is not null")
    classes = some.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min_by("text_hash", "doc_id").alias("text_hash"), F.min_by("sign", "doc_id").alias("sign"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    again = materialize(some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "repeated-ids")
    sets = classes.select("node", "sign")

    pairs = candidate_pairs(sets)
    sketches = sets.mapInArrow(_sketch, "node long, sketch binary")
    side = lambda c, to: sketches.select(F.col("node").alias(c), F.col("sketch").alias(to))

    def rate(candidates: DataFrame, name: str) -> DataFrame:
        agreeing = candidates.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(_agreeing, "a long, b long, agree int")
        return materialize(agreeing.filter(F.col("agree") >= int(HASHES * percent / 100 * SKETCH_SLACK)), name)

    def nearest(rated: DataFrame, name: str) -> DataFrame:
        both = rated.select(F.col("a").alias("node"), F.col("b").alias("other"), "agree").unionByName(rated.select(F.col("b").alias("node"), F.col("a").alias("other"), "agree"))
        best = both.groupBy("node").agg(F.max(F.struct("agree", (-F.col("other")).alias("o"))).alias("m")).select("node", (-F.col("m.o")).alias("other"))
        return materialize(best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), name)

    rated = rate(pairs, "rated")
    first = nearest(rated, "first-pairs")

    def full_sets(needed: DataFrame) -> DataFrame:
        needed = materialize(classes.select("node", "doc_id", "text_hash").join(needed.distinct(), "node"), "needed")
        full = join_bounded(plain, needed, ["doc_id", "text_hash"], "inner", 48).select("node", "text")
        full = full if again.isEmpty() else full.dropDuplicates(["node"])
        return materialize(full.mapInArrow(_full_sets(shingle_words), "node long, members binary"), "sets")

    def confirm(candidates: DataFrame, name: str) -> DataFrame:
        full = full_sets(candidates.select(F.explode(F.array("a", "b")).alias("node")))
        of = lambda c, to: full.select(F.col("node").alias(c), F.col("members").alias(to))
        joined = candidates.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y")
        return materialize(joined.mapInArrow(_linked(percent), "a long, b long"), name)

    links = confirm(first, "links")
    if not again.isEmpty():
        own = materialize(join_bounded(some, again, "doc_id", "left_semi", 16).join(classes.select("key", "node"), "key").select("doc_id", "node").distinct(), "classes-of-ids")
        least = own.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = links.unionByName(materialize(own.join(least, "doc_id").filter("a != node").select("a", F.col("node").alias("b")), "links-of-ids"))
    labels = components(links)
    to = lambda df, c, out: df.join(labels.select(F.col("node").alias(c), F.col("label").alias(out)), c, "left").withColumn(out, F.coalesce(out, c))
    rest = to(to(rated.select("a", "b"), "a", "la"), "b", "lb").filter("la != lb").join(first, ["a", "b"], "left_anti")
    rest = materialize(rest, "other-pairs")
    if not rest.isEmpty():
        more = confirm(rest.select("a", "b"), "more-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)

    crowd = crowds(sets)
    open_ = _unsettled(crowd, labels)
    if not open_.isEmpty():
        met = confirm(nearest(rate(_to_representatives(open_, links), "rated-crowds"), "crowd-pairs"), "crowd-links")
        if not met.isEmpty():
            links = links.unionByName(met)
            labels = components(links)
            open_ = _unsettled(crowd, labels)
        full = full_sets(open_.select("node")).join(sketches, "node")
        blocks = _block_pairs(open_).join(full, "node").groupBy("region", "p", "q")
        left = materialize(blocks.applyInArrow(_block_links(percent), "a long, b long").distinct(), "block-links")
        if not left.isEmpty():
            labels = components(links.unionByName(left))

    label = classes.select("key", "node", "doc_id").join(labels, "node", "left").select("key", "doc_id", F.coalesce("label", "node").alias("label"))
    least = label.groupBy("label").agg(F.min("doc_id").alias("least"))
    out = signed.select("doc_id", "n_shingles", "key").join(label.join(least, "label").select("key", "least"), "key", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their component, with all columns.

    Rows that are equal in every column and have an id are one document and stay once; rows of one id that differ stay
    each, as do rows with a null id. Null and empty texts are linked with nothing and stay. Only rows of repeated ids
    are compared, so that texts are not shuffled for it.
    """
    gone = materialize(near_duplicates(docs, shingle_words=shingle_words, percent=percent).filter("not kept").select("doc_id").distinct(), "near-copies")
    kept = join_bounded(docs, gone, "doc_id", "left_anti", 16)
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = materialize(ids.filter("rows > 1").select("doc_id"), "repeated-rows")
    if repeated.isEmpty():
        return kept
    once = join_bounded(kept, repeated, "doc_id", "left_semi", 16).distinct()
    return join_bounded(kept, repeated, "doc_id", "left_anti", 16).unionByName(once)
