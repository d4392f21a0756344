"""Removal of repeated byte strings across documents by suffix arrays of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import BROADCAST_BYTES, bounded_batches, join_bounded, materialize
from clinicweave.llm.neardup import _BYTE, _powers, mix
from clinicweave.llm.suffix import permuted_lcp, suffix_array
from clinicweave.llm.tokens import groups

#: Bytes of a string that counts as repeated.
LENGTH = 50
#: Bytes of an anchor. Every string of LENGTH bytes holds LENGTH - ANCHOR + 1 anchors; the least hash of them is its own.
ANCHOR = 30
#: Texts of about so many bytes are compared at once by a mapper, and so many documents: their numbers have 16 bits.
BATCH_BYTES, BATCH_DOCS = 16 << 20, 48_000
#: An anchor with more different contexts is compared string by string, spread over tasks.
MAX_CONTEXTS = 2000
#: Bytes of the contexts that one suffix array is built over.
SHARD_BYTES = 1 << 20


def _anchors(raws: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of string starts that have one anchor: (text, first start, starts, anchor's hash, anchor) and the joined bytes.

    Starts are positions in the joined bytes. The anchor of a start is the leftmost least hash of the anchors inside
    its string, so that equal strings have equal anchors wherever they stand.
    """
    data = np.frombuffer(b"".join(raws), np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, np.empty(0, np.uint64), none, data
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[: len(data)])])
    hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(data) - ANCHOR + 1])
    value, place, width = hashes, np.arange(len(hashes), dtype=np.int32), 1
    window = LENGTH - ANCHOR + 1
    while width < window:
        step = min(width, window - width)
        left = value[:-step] <= value[step:]
        value = np.where(left, value[:-step], value[step:])
        place = np.where(left, place[:-step], place[step:])
        width += step
    sizes = np.array([len(r) for r in raws])
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(raws), dtype=np.int32), np.maximum(sizes - LENGTH + 1, 0))
    skip = np.repeat((ends - sizes) - np.concatenate([[0], np.cumsum(np.maximum(sizes - LENGTH + 1, 0))[:-1]]), np.maximum(sizes - LENGTH + 1, 0))
    starts = np.arange(len(text)) + skip
    if not len(starts):
        return none, none, none, np.empty(0, np.uint64), none, data
    own = place[starts]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    return text[first], starts[first], np.diff(np.append(first, len(starts))), hashes[own[first]], own[first], data


def _raw(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


_SENT = "bucket int, batch long, rids binary, hashes binary, owners binary"
_SENT_NAMES = ["bucket", "batch", "rids", "hashes", "owners"]


def _send_anchors(buckets: int):
    """Blocks of (anchor hash, number of its document in the batch) by bucket of the hash, and the documents' keys."""

    def flush(rids, hashes, owners, batch):
        h, o = np.concatenate(hashes), np.concatenate(owners)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        h, o = h[order], o[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(batch % buckets, batch, np.array(rids, np.int64).tobytes(), None, None)]
        rows += [(b, batch, None, h[x:y].tobytes(), o[x:y].tobytes()) for b, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if y > x]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 64], strict=True), kinds, strict=True)], _SENT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        rids, hashes, owners, size = [], [], [], 0
        for b in batches:
            ids, at = b.column("rid").to_pylist(), 0
            for group in groups(b.column("text"), 1 << 20):
                text, _, _, h, _, data = _anchors(_raw(group))
                if len(h):
                    hashes.append(h)
                    owners.append((text + len(rids)).astype(np.uint16))
                rids += ids[at : at + len(group)]
                at += len(group)
                size += len(data)
                if size >= BATCH_BYTES or len(rids) + 10_000 > BATCH_DOCS:
                    if hashes:
                        yield from flush(rids, hashes, owners, batch)
                    batch += 1
                    rids, hashes, owners, size = [], [], [], 0
        if hashes:
            yield from flush(rids, hashes, owners, batch)

    return run


def _find_shared(key, pdf):
    """Of a bucket's anchors those that stand in two documents, back to their batches; 16 bits of a hash are enough
    there, because they only say which strings are worth comparing."""
    import pandas as pd

    passed = pdf[pdf["hashes"].isna()][["batch", "rids"]].assign(marks=None, owners=None)
    sent = pdf[pdf["hashes"].notna()]
    if not len(sent):
        return passed[["batch", "rids", "marks", "owners"]]
    h = [np.frombuffer(x, np.uint64) for x in sent["hashes"]]
    sizes = [len(x) for x in h]
    h = np.concatenate(h)
    own = np.concatenate([np.frombuffer(x, np.uint16) for x in sent["owners"]])
    row = np.repeat(np.arange(len(sizes)), sizes)
    who = row.astype(np.int64) << 16 | own
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    shared = np.maximum.reduceat(who, first) != np.minimum.reduceat(who, first)
    keep = np.repeat(shared, np.diff(np.append(first, len(h))))
    h, who = h[keep], who[keep]
    order = np.argsort(who, kind="stable")
    h, who = (h[order] >> np.uint64(48)).astype(np.uint16), who[order]
    cuts = np.searchsorted(who >> 16, np.arange(len(sizes) + 1))
    batch = sent["batch"].tolist()
    rows = [(batch[i], None, h[a:b].tobytes(), (who[a:b] & 0xFFFF).astype(np.uint16).tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
    return pd.concat([passed[["batch", "rids", "marks", "owners"]], pd.DataFrame(rows, columns=["batch", "rids", "marks", "owners"])])


def _by_document(key, pdf):
    """Marks of a batch by document."""
    import pandas as pd

    marks = pdf[pdf["marks"].notna()]
    if not len(marks):
        return pd.DataFrame({"rid": np.empty(0, np.int64), "marks": []})
    rids = np.frombuffer(pdf["rids"].dropna().iloc[0], np.int64)
    m = np.concatenate([np.frombuffer(x, np.uint16) for x in marks["marks"]])
    own = np.concatenate([np.frombuffer(x, np.uint16) for x in marks["owners"]])
    order = np.argsort(own, kind="stable")
    m, own = m[order], own[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    cuts = np.append(first, len(own)).tolist()
    return pd.DataFrame({"rid": rids[own[first]], "marks": [np.unique(m[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around every shared anchor that the strings of this anchor cover."""
    for b in batches:
        at = 0
        ids, docs, marks = (b.column(c).to_pylist() for c in ("rid", "doc_id", "marks"))
        for group in groups(b.column("text"), 1 << 20):
            raws = _raw(group)
            text, first, count, h, place, data = _anchors(raws)
            top = (h >> np.uint64(48)).astype(np.int64) + (text.astype(np.int64) << 16)
            known = [np.frombuffer(m, np.uint16).astype(np.int64) + (i << 16) for i, m in enumerate(marks[at : at + len(group)])]
            known = np.concatenate(known) if known else np.empty(0, np.int64)
            near = np.searchsorted(known, top)
            keep = np.flatnonzero((near < len(known)) & (known[np.minimum(near, max(len(known) - 1, 0))] == top)) if len(known) else np.empty(0, np.int64)
            if len(keep):
                text, first, count, h, place = text[keep], first[keep], count[keep], h[keep], place[keep]
                begins = np.cumsum([0, *map(len, raws[:-1])])
                buffer = data.tobytes()
                context = [buffer[x:y] for x, y in zip(first.tolist(), (first + count + LENGTH - 1).tolist(), strict=True)]
                rid = np.array(ids[at : at + len(group)], np.int64)[text]
                doc = np.array(docs[at : at + len(group)], np.int64)[text]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(context, pa.binary()), pa.array(rid), pa.array(doc), pa.array((first - begins[text]).astype(np.int32)), pa.array((place - first).astype(np.int32))], ["key", "context", "rid", "doc_id", "at", "anchor"])
            at += len(group)


def compare_contexts(contexts: list[bytes], docs: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """For distinct contexts with their smallest document: bits of the starts whose string a smaller document has.

    One suffix array over all contexts with separators, in which an anchor, whole in each of its strings, is a single
    character; suffixes with equal anchors whose common prefixes reach the length left are one string.
    """
    least, numbers = LENGTH - ANCHOR + 1, {}
    number = np.array([numbers.setdefault(c[a : a + ANCHOR], len(numbers)) for c, a in zip(contexts, anchors.tolist(), strict=True)])
    lengths = np.array([len(c) for c in contexts])
    raw = np.frombuffer(b"\0".join(contexts) + b"\0\0", np.uint8).astype(np.int64) + 2
    ends = np.cumsum(lengths + 1) - 1
    raw[ends] = 1
    raw[-1] = 0
    at = ends - lengths + anchors
    raw[at] = 258
    keep = np.ones(len(raw), bool)
    keep[at[:, None] + np.arange(1, ANCHOR)] = False
    raw, lengths = raw[keep], lengths - ANCHOR + 1
    ends = np.cumsum(lengths + 1) - 1

    sa = suffix_array(raw, 259)
    left = np.repeat(ends, lengths + 1) - np.arange(len(raw) - 1)
    common = np.minimum(permuted_lcp(raw, sa, 259, least), np.append(left, 0))[sa]
    owner = np.repeat(np.arange(len(contexts)), lengths + 1)
    string = np.cumsum(common < least) - 1
    inside = sa < len(owner)
    sa, string = sa[inside], string[inside]
    own = owner[sa]
    offset = sa - (ends - lengths)[own]
    full = offset + least <= lengths[own]
    string, own, offset = string[full], own[full], offset[full]
    out = np.zeros(len(contexts), np.int64)
    if len(string):
        string = string * len(numbers) + number[own]
        order = np.argsort(string, kind="stable")
        string, own, offset = string[order], own[order], offset[order]
        first = np.flatnonzero(np.concatenate([[True], string[1:] != string[:-1]]))
        smallest = np.repeat(np.minimum.reduceat(docs[own], first), np.diff(np.append(first, len(string))))
        gone = smallest < docs[own]
        np.bitwise_or.at(out, own[gone], np.int64(1) << offset[gone])
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts of sorted contexts; a shard ends between two keys, because contexts of one key are compared.

    The only context of a key shares no string with another one, so that no suffix array has to hold it.
    """
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
    shard, size, group = [], 0, []  # rows (key, id, context, least, anchor)

    def verdicts(rows, gone):
        cols = [[r[i] for r in rows] for i in (0, 1, 3)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((*cols, gone), kinds, strict=True)], ["key", "id", "least", "gone"])

    def compared():
        return verdicts(shard, compare_contexts([r[2] for r in shard], np.array([r[3] for r in shard], np.int64), np.array([r[4] for r in shard], np.int64)))

    for b in batches:
        alone = []
        for row in zip(*(b.column(x).to_pylist() for x in ("key", "id", "context", "least", "anchor")), strict=True):
            if group and row[0] != group[0][0]:
                if len(group) == 1:
                    alone += group
                else:
                    shard += group
                    size += sum(len(r[2]) for r in group)
                    if size >= SHARD_BYTES:
                        yield compared()
                        shard, size = [], 0
                group = []
            group.append(row)
        if alone:
            yield verdicts(alone, [0] * len(alone))
    if len(group) == 1:
        yield verdicts(group, [0])
    else:
        shard += group
    if shard:
        yield compared()


def _string_by_string(contexts: DataFrame) -> DataFrame:
    """The verdicts of ``_shards`` for contexts of very frequent anchors: strings are grouped and joined, no key is
    compared in one task. Only strings of contexts with different smallest documents are judged."""
    starts = F.sequence(F.lit(0), F.length("context") - LENGTH)
    strings = contexts.withColumn("offset", F.explode(starts)).withColumn("string", F.substring("context", F.col("offset") + 1, F.lit(LENGTH)))
    strings = strings.select("key", "id", "least", "offset", "string")
    shared = strings.groupBy("string").agg(F.min("least").alias("all"), F.max("least").alias("most")).filter("all < most")
    bit = F.when(F.col("all") < F.col("least"), F.expr("shiftleft(1L, offset)")).otherwise(F.lit(0).cast("long"))
    judged = strings.join(shared, "string").groupBy("key", "id").agg(F.bit_or(bit).alias("gone"))
    return contexts.select("key", "id", "least").join(judged, ["key", "id"], "left").withColumn("gone", F.coalesce("gone", F.lit(0).cast("long")))


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed runs of each document, as pairs of 32-bit numbers."""
    for b in batches:
        runs = []
        for at, size, gone in zip(*(b.column(c).to_pylist() for c in ("at", "size", "gone")), strict=True):
            at, size, gone = np.array(at, np.int64), np.array(size, np.int64), np.array(gone, np.int64)
            whole = gone < 0
            bits = (gone[~whole, None] >> np.arange(LENGTH - ANCHOR + 1)) & 1
            which, offset = np.nonzero(bits)
            first = np.concatenate([at[whole], at[~whole][which] + offset])
            last = np.concatenate([at[whole] + size[whole], at[~whole][which] + offset + LENGTH])
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order])
            new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]]))
            stop = last[np.append(new[1:] - 1, len(last) - 1)]
            runs.append(np.stack([first[new], stop], axis=1).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(runs, pa.binary())], ["rid", "runs"])


def removed_runs(rows: DataFrame) -> DataFrame:
    """(rid, runs) of rows (rid, doc_id, text) that lose bytes; runs are (start, end) pairs of 32-bit numbers."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.select("rid", "text").mapInArrow(_send_anchors(buckets), _SENT)
    shared = sent.groupBy("bucket").applyInPandas(_find_shared, "batch long, rids binary, marks binary, owners binary")
    marked = materialize(shared.groupBy("batch").applyInPandas(_by_document, "rid long, marks binary"), "shared-anchors")
    n, size = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("marks")), F.lit(0))).first()
    joined = rows.join(F.broadcast(marked) if n * 64 + size <= BROADCAST_BYTES else marked.hint("merge"), "rid")
    found = joined.select("rid", "doc_id", "marks", "text").mapInArrow(_contexts, "key long, context binary, rid long, doc_id long, at int, anchor int")
    found = materialize(found.withColumn("id", F.xxhash64("context")), "contexts")

    distinct = found.groupBy("key", "id", "context").agg(F.min("doc_id").alias("least"), F.min("anchor").alias("anchor"))
    distinct = materialize(distinct, "distinct-contexts")
    hot = materialize(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MAX_CONTEXTS).select("key"), "frequent-anchors")
    usual = join_bounded(distinct, hot, "key", "left_anti", 16).repartition(buckets, "key").sortWithinPartitions("key")
    verdicts = usual.select("key", "id", "context", "least", "anchor").mapInArrow(_shards, "key long, id long, least long, gone long")
    verdicts = verdicts.unionByName(_string_by_string(join_bounded(distinct, hot, "key", "left_semi", 16)))
    places = found.select("key", "id", "rid", "doc_id", "at", F.octet_length("context").alias("size"))
    judged = places.join(verdicts, ["key", "id"]).withColumn("gone", F.when(F.col("doc_id") > F.col("least"), F.lit(-1).cast("long")).otherwise(F.col("gone"))).filter("gone != 0")
    lists = judged.groupBy("rid").agg(F.collect_list(F.struct("at", "size", "gone")).alias("x"))
    return lists.select("rid", F.col("x.at").alias("at"), F.col("x.size").alias("size"), F.col("x.gone").alias("gone")).mapInArrow(_covered, "rid long, runs binary")


def exact_copies(rows: DataFrame) -> DataFrame:
    """(rid, runs) of rows whose whole text, of LENGTH bytes at least, a smaller document has: all of it goes.

    They need not be searched: the smallest of them holds the same strings. Texts meet as 128-bit hashes.
    """
    hashed = rows.filter(F.octet_length("text") >= LENGTH).select("rid", "doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("h1"), F.xxhash64(F.reverse("text")).alias("h2"))
    least = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = hashed.join(least, ["h1", "h2"]).filter(F.col("doc_id") > F.col("least")).select("rid", "size").distinct()
    little = lambda c: F.concat(*[F.unhex(F.lpad(F.hex(F.shiftright(c, 8 * i).bitwiseAND(255)), 2, "0")) for i in range(4)])
    return later.select("rid", F.concat(F.unhex(F.lit("00000000")), little(F.col("size"))).alias("runs"))


def _cut(raw: bytes, runs: bytes | None) -> tuple[bytes, int, int]:
    if not runs:
        return raw, 0, 0
    pairs = np.frombuffer(runs, "<u4").reshape(-1, 2).tolist()
    kept, at = [], 0
    for a, b in pairs:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    rest = b"".join(kept)
    return rest, len(raw) - len(rest), len(pairs)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist(), strict=True):
            raw = t.encode("utf-8", "surrogatepass")
            rest, removed, spans = _cut(raw, runs)
            out.append((len(raw), removed, spans, hashlib.sha256(rest).hexdigest()))
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    plain = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return plain.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 after removing repeated byte strings.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id; strings
    are those of the input, and never cross documents. Exact copies of a smaller document lose all at once. Null texts are empty. Rows with equal ids never remove from
    each other; rows that are equal in full share their runs. Rows with a null id neither lose nor remove anything.

    Strings are brought together by anchors: the least hash among a string's 30-byte windows, which any copy of the
    string shares. Anchors of one document only are dropped on 64-bit hashes sent in blocks; around the others the
    bytes that their strings cover are kept as contexts, each distinct one once with its smallest document. Shards of
    contexts get a suffix array by induced sorting and permuted common prefixes; runs of suffixes with 50 common
    bytes are one string, and its smallest document decides. An anchor with very many contexts is compared string by
    string over all tasks instead. What each text loses is joined to it as a broadcast within a checked size, else by
    a shuffle.
    """
    rows = _keyed(docs)
    known = rows.filter("doc_id is not null")
    copies = materialize(exact_copies(known), "exact-copies")
    rest = join_bounded(known, copies, "rid", "left_anti", 48)
    runs = removed_runs(rest).unionByName(copies.select("rid", "runs"))
    runs = materialize(runs, "removed-runs")
    n, size = runs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("runs")), F.lit(0))).first()
    joined = rows.join(F.broadcast(runs) if n * 64 + size <= BROADCAST_BYTES else runs.hint("merge"), "rid", "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
