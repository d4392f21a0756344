"""Benchmark decontamination: CGK walks over windows of texts, keys of sampled steps, and exact edit verification.

A walk emits a character a step and then stays or goes on, by a random bit of the step and the character. Two walks with
the same bits that part at an edit soon meet again, so that few edits leave most steps equal: edit distance becomes
Hamming distance. A key is the characters of some sampled steps; equal keys of a text and an item are a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicweave.llm.common import bounded_batches, join_bounded, materialize
from clinicweave.llm.tokens import groups

#: An item leaks into a document that holds a passage within this share of its length in edits.
MAX_EDITS = 0.15
#: Steps of a walk, which pass about half as many characters, steps sampled for a key, and keys sampled from each walk.
#: Steps are taken and sampled two at a time.
STEPS, KEY_STEPS, KEYS = 48, 16, 8
#: Bits of a character's class.
BITS = 6
#: Walks begin at every so many characters of a text, and at every character of an item.
STRIDE = 6
#: Items of fewer characters are too short for walks from several places; they are searched by their segments.
LEAST_WALKED = 64
#: Walks are added until this share of edited copies of items is found, or ``MOST_WALKS`` are taken.
TARGET_RECALL, LEAST_WALKS, MOST_WALKS = 0.98, 2, 12
#: Items of which edited copies are made on the driver to measure recall.
MEASURED_ITEMS = 200
#: Characters of texts that are searched at once, and windows that walk at once.
GROUP_CHARS, WINDOWS = 256 << 10, 1 << 14
#: Characters of items that are broadcast at once; more items are searched block by block.
BLOCK_CHARS = 512 << 10
#: Characters of the grams of which a passage within the edits has to keep enough before it is verified.
GRAMS = (4, 5, 6)


def normalize(text: str | None) -> str:
    """Lower case, blanks between words only."""
    return " ".join((text or "").lower().replace("\0", " ").split())


def _classes(text: str) -> np.ndarray:
    """One of ``1 << BITS`` classes of each character; those of a-z, blanks, digits and ASCII signs are distinct."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return ((codes ^ codes >> 1 & 32 ^ codes >> 7 ^ codes >> 13) & ((1 << BITS) - 1)).astype(np.uint8)


def _pairs(classes: np.ndarray) -> np.ndarray:
    """Number of the two classes at each place but the last, by which two steps are looked up."""
    out = classes[:-1].astype(np.int64)
    out <<= BITS
    out |= classes[1:]
    return out


def _grams(classes: np.ndarray) -> list[np.ndarray]:
    """For each length of ``GRAMS`` 16 bits of a hash of the grams that begin at each place; equal grams have equal ones."""
    out, hashed = [], np.zeros(len(classes), np.uint32)
    for i in range(GRAMS[-1]):
        n = max(0, len(classes) - i)
        hashed = hashed[:n] * np.uint32(0x9E3779B1) + classes[i:]
        if i + 1 in GRAMS:
            out.append((hashed * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.int64))
    return out


class Walk:
    """Random bits of one walk and the steps that its keys sample; equal seeds give equal walks everywhere.

    Two steps are one look-up: by the classes of a place and the next, the hashes of the characters that both steps emit,
    summed, with the places that both go on in the lowest two bits.
    """

    def __init__(self, seed: int):
        random = np.random.default_rng([7, seed])
        moves = random.integers(0, 2, (STEPS, 1 << BITS)).astype(np.uint64)
        hashes = random.integers(0, 2**62, (STEPS, 1 << BITS), dtype=np.uint64) * np.uint64(4)
        first, second = np.arange(1 << 2 * BITS) >> BITS, np.arange(1 << 2 * BITS) & ((1 << BITS) - 1)
        self.steps = []
        for step in range(0, STEPS, 2):
            then = np.where(moves[step][first] == 1, second, first)
            self.steps.append(hashes[step][first] + hashes[step + 1][then] + moves[step][first] + moves[step + 1][then])
        sampled = np.array([random.choice(STEPS // 2, KEY_STEPS // 2, replace=False) for _ in range(KEYS)])
        self.keys_of = [np.flatnonzero((sampled == step).any(axis=1)) for step in range(STEPS // 2)]

    def keys(self, pairs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Keys (one row each) of the walks from each start; ``pairs`` has ``STEPS`` more entries than starts can be.

        All places are within their arrays; "clip" only spares numpy's slower check of them.
        """
        at, out = starts.copy(), np.zeros((KEYS, len(starts)), np.uint64)
        for steps, keys in zip(self.steps, self.keys_of, strict=True):
            emitted = steps.take(pairs.take(at, mode="clip"), mode="clip")
            for key in keys:
                out[key] += emitted
            at += (emitted & np.uint64(3)).view(np.int64)
        return out


def best_match(item: str, text: str) -> tuple[int, int]:
    """(fewest edits between the item and any substring of the text, end of the first such substring).

    Myers' bit-parallel columns in whole integers; the match may start anywhere.
    """
    n = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = n, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d = (((x & up) + up) ^ up) | x
        rise = down | ~(d | up) & full
        fall = up & d
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | ~(x | rise) & full, rise & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """Items of at least ``LEAST_WALKED`` characters by the keys of walks from each of their characters.

    Of an item with the same key at several places the first and the last are kept, so that a window meets it once.
    """

    def __init__(self, items: list[tuple[int, str]], walks: list[Walk]):
        self.walks, self.tables = walks, []
        pairs = [_pairs(np.concatenate([_classes(t), np.zeros(STEPS + 1, np.uint8)])) for _, t in items]
        starts = [np.arange(max(STRIDE, len(t) - STEPS // 2 + 1)) for _, t in items]
        owner, place = np.repeat(np.arange(len(items)), [len(x) for x in starts]), np.concatenate(starts)
        for walk in walks:
            for keys in np.concatenate([walk.keys(p, x) for p, x in zip(pairs, starts, strict=True)], axis=1):
                order = np.lexsort((place, owner, keys))
                k, o, x = keys[order], owner[order], place[order]
                first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]))
                last = np.concatenate([first[1:], [len(k)]]) - 1
                shift = np.uint64(64 - max(12, int(len(first)).bit_length() + 3))
                there = np.zeros((2, 1 << (64 - int(shift))), bool)
                for bits, held in zip(self._bits(k[first], shift), there, strict=True):
                    held[bits] = True
                self.tables.append((shift, there, k[first], o[first].astype(np.int32), x[first].astype(np.int32), x[last].astype(np.int32)))

    @staticmethod
    def _bits(keys: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """The highest bits of each key and as many lower ones."""
        return (keys >> shift).view(np.int64), (keys << (np.uint64(64) - shift) >> shift).view(np.int64)

    def candidates(self, pairs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows of (window's start, item, first place, last place) of all equal keys.

        Few windows pass both tables of bits, and only those are searched for among the keys.
        """
        found = []
        for at in range(0, len(starts), WINDOWS):
            some = starts[at : at + WINDOWS]
            for w, walk in enumerate(self.walks):
                for keys, (shift, there, own, *columns) in zip(walk.keys(pairs, some), self.tables[w * KEYS : (w + 1) * KEYS], strict=True):
                    near = np.flatnonzero(there[0].take((keys >> shift).view(np.int64), mode="clip"))
                    near = near[there[1].take(self._bits(keys[near], shift)[1], mode="clip")]
                    low, high = np.searchsorted(own, keys[near], "left"), np.searchsorted(own, keys[near], "right")
                    n = high - low
                    if n.any():
                        row = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                        found.append(np.stack([np.repeat(some[near], n), *(c[row] for c in columns)]))
        return np.unique(np.concatenate(found, axis=1), axis=1).T if found else np.zeros((0, 4), np.int64)


def _edited(text: str, edits: int, random: np.random.Generator, evenly: bool) -> str:
    """The text after replacements, insertions and deletions at distinct places, random ones or evenly spread ones.

    Evenly spread edits leave the shortest stretches between them, which is hardest for walks.
    """
    out = list(text)
    places = (np.arange(edits) + 0.5) * len(out) // max(1, edits) if evenly else random.choice(len(out), edits, replace=False)
    for at in sorted(places.astype(np.int64).tolist(), reverse=True):
        kind, other = random.integers(3), text[random.integers(len(text))]
        out[at : at + 1] = ["" if kind == 0 else other if kind == 1 else out[at] + other]
    return "".join(out)


def walks_needed(items: list[tuple[int, str]], max_edits: float) -> list[Walk]:
    """Walks whose keys find ``TARGET_RECALL`` of edited copies of items, with all the edits that count.

    Measured on ``MEASURED_ITEMS`` items spread over all, each with random and with evenly spread edits; copies begin at
    different distances from a window's start.
    """
    some = [items[i] for i in np.unique(np.linspace(0, len(items) - 1, min(MEASURED_ITEMS, len(items))).astype(int))]
    random, missing = np.random.default_rng(23), []
    for i, (_, t) in enumerate(some):
        for evenly in (False, True):
            edits, begin = int(max_edits * len(t)), int(random.integers(STRIDE))
            missing.append((i, edits, begin, " " * begin + _edited(t, edits, random, evenly)))
    copies = len(missing)
    walks: list[Walk] = []
    while len(walks) < LEAST_WALKS or (len(missing) > (1 - TARGET_RECALL) * copies and len(walks) < MOST_WALKS):
        walks.append(Walk(len(walks)))
        index, left = Index(some, walks[-1:]), []
        for copy in missing:
            i, edits, begin, text = copy
            x = index.candidates(_pairs(np.concatenate([_classes(text), np.zeros(STEPS + 1, np.uint8)])), np.arange(0, len(text), STRIDE))
            x = x[x[:, 1] == i]
            if not ((x[:, 0] - x[:, 3] - 2 * edits <= begin) & (begin <= x[:, 0] - x[:, 2] + 2 * edits)).any():
                left.append(copy)
        missing = left
    return walks


class Items:
    """Items of one block, prepared on the driver: the index of the long ones, the segments of the short ones."""

    def __init__(self, rows: list[tuple[int, str]], max_edits: float):
        rows = [(i, t) for i, t in ((i, normalize(t)) for i, t in rows) if t]
        self.rows = [r for r in rows if len(r[1]) >= LEAST_WALKED]
        self.long = len(self.rows)
        self.index = Index(self.rows, walks_needed(self.rows, max_edits)) if self.rows else None
        self.rows += [r for r in rows if len(r[1]) < LEAST_WALKED]
        self.most = [int(max_edits * len(t)) for _, t in self.rows]
        self.grams = [_grams(_classes(t)) for _, t in self.rows]
        self.segments = []
        for item, (_, t) in enumerate(self.rows[self.long :], self.long):
            cuts = [len(t) * k // (self.most[item] + 1) for k in range(self.most[item] + 2)]
            self.segments.append((item, [(x, t[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]))

    def places(self, texts: list[str], begins: np.ndarray, classes: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """By (text, item) the (least, greatest) places that a passage may begin at."""
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        if self.index:
            starts = np.concatenate([np.arange(b, b + len(t), STRIDE) for b, t in zip(begins.tolist(), texts, strict=False)])
            found = self.index.candidates(_pairs(classes), starts)
            which = np.searchsorted(begins, found[:, 0], "right") - 1
            for text, (at, item, first, last) in zip(which.tolist(), found.tolist(), strict=True):
                at, most = at - int(begins[text]), self.most[item]
                out.setdefault((text, item), []).append((at - last - 2 * most, at - first + 2 * most))
        for item, segments in self.segments:
            for x, segment in segments:
                for text, body in enumerate(texts):
                    at = body.find(segment)
                    while at >= 0:
                        out.setdefault((text, item), []).append((at - x - self.most[item], at - x + self.most[item]))
                        at = body.find(segment, at + 1)
        return out

    def keeps(self, item: int, k: int, grams: np.ndarray, there: np.ndarray) -> bool:
        """Among the grams of a part of a text are enough of the item's: an edit touches as many as a gram has characters.

        ``there`` is all false, before and after.
        """
        kept = len(self.rows[item][1]) - GRAMS[k] + 1 - self.most[item] * GRAMS[k]
        if kept <= 0:
            return True
        there[grams] = True
        n = np.count_nonzero(there.take(self.grams[item][k], mode="clip"))
        there[grams] = False
        return n >= kept

    def leaks(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item id, edits, end) of the best verified passage of each item in each text."""
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        classes = np.concatenate([_classes("\0".join(texts)), np.zeros(STEPS + 1, np.uint8)])
        grams, there = _grams(classes), np.zeros(1 << 16, bool)
        for (text, item), places in self.places(texts, begins, classes).items():
            wanted, most, best, begin = self.rows[item][1], self.most[item], None, int(begins[text])
            merged: list[list[int]] = []
            for low, high in sorted(places):
                low = max(0, low)
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            for low, high in merged:
                high = min(len(texts[text]), max(0, high + len(wanted) + most))
                if not all(self.keeps(item, k, grams[k][begin + low : max(begin + low, begin + high - n + 1)], there) for k, n in enumerate(GRAMS)):
                    continue
                edits, end = passage(wanted, texts[text], low, high)
                if edits <= most and (best is None or (edits, end) < best):
                    best = edits, end
            if best:
                yield text, self.rows[item][0], *best


def passage(item: str, text: str, low: int, high: int) -> tuple[int, int]:
    """(edits, end in the text) of the best passage in text[low:high].

    Items too short for walks are passages of whole words: what stands inside a longer word is met by chance.
    """
    if len(item) >= LEAST_WALKED:
        edits, end = best_match(item, text[low:high])
        return edits, low + end
    begin, end = text.rfind(" ", 0, low) + 1, text.find(" ", high)
    part = f" {text[begin : end if end >= 0 else len(text)]} "
    edits, at = best_match(f" {item} ", part)
    return edits, min(begin + max(0, at - 2), len(text))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, max_edits: float = MAX_EDITS) -> DataFrame:
    """(doc_id, item_id, edits, item_chars, end) of every document and item of which it holds a passage.

    Texts are compared in lower case with single blanks. A document leaks an item if some passage of it is within
    ``max_edits`` of the item's length in edits (Levenshtein), rounded down. Windows begin at every ``STRIDE`` characters
    of whole texts and walk as the item does from each of its characters; equal keys are verified over the whole item.
    As many walks are taken as find ``TARGET_RECALL`` of edited copies of the items. Items shorter than ``LEAST_WALKED``
    are passages of whole words: with a blank on each side, which counts as a character of theirs, they are found
    exactly, by the segments of which one stays without an edit. What is returned is right whatever the keys find.
    Null or empty texts, ids and items leak nothing; equal items are found each; repeated rows have their own rows;
    texts of any length are searched whole; extra columns are ignored.

    One narrow pass over the documents for each block of ``BLOCK_CHARS`` characters of items, which is what a task
    gets as a broadcast, a block at a time; nothing is shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("item_id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_CHARS))
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")

    def search(block: int) -> tuple[DataFrame, object]:
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Items([(r["item_id"], r["text"]) for r in part], max_edits))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            chars = {i: len(t) for i, t in items.rows}
            for batch in batches:
                at, ids = 0, batch.column("doc_id").to_pylist()
                for group in groups(batch.column("text"), GROUP_CHARS):
                    texts = [normalize(t) for t in group]
                    found = [(ids[at + t], i, e, chars[i], end) for t, i, e, end in items.leaks(texts)]
                    at += len(group)
                    if found:
                        cols = zip(*found, strict=True)
                        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "edits", "item_chars", "end"])

        return rows.mapInArrow(run, "doc_id long, item_id long, edits int, item_chars int, end int"), shared

    if blocks == 1:
        return search(0)[0]
    out = None
    for block in range(blocks):
        found, shared = search(block)
        found = materialize(found, "leaks")
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with all columns; rows with a null id stay."""
    gone = materialize(find_leaks(docs, benchmark, **options).select("doc_id").distinct(), "leaking")
    return join_bounded(docs, gone, "doc_id", "left_anti", 16)
