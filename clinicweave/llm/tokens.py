"""Token ids in Parquet files, and token counts.

Both operators encode each distinct word of a text once: a text is cut only where no token of the tokenizer can
span the cut, the words met before are looked up in a bounded cache of the Python worker, and the new ones go to the
library in one batch. The sums and concatenations are the library's own results for the whole text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinicweave.llm.common import bounded_batches, scratch

#: Entries that a worker keeps; its older half leaves when it is full, which costs time and changes nothing else.
CACHE_ENTRIES = 450_000
#: Characters of the words that a cache keeps, in one of its two generations, and of the longest word that it keeps: texts
#: without blanks are words of any length.
CACHE_CHARS, LONGEST_KEPT = 8 << 20, 128
#: Words that go to the library in one call.
WORDS_IN_A_CALL = 20_000
#: Texts are encoded in groups of about so many bytes.
GROUP_BYTES = 4 << 20
#: Bytes that a row counts for besides its text.
ROW_BYTES = 64
#: Texts that are not cut into words are cut into parts of about so many characters at safe boundaries.
PART_CHARS = 1 << 16

_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer of a file, loaded once a worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            _LOADED[path] = Tokenizer.from_file(path)
        else:
            import sentencepiece

            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def _encode(path: str, texts: list[str]) -> list[list[int]]:
    t = tokenizer(path)
    if path.endswith(".json"):
        return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    return t.encode(texts, num_threads=1)


def slices(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of a text column of about ``size`` bytes each, so that no step holds many long texts at once.

    A row counts for ``ROW_BYTES`` more, so that empty texts do not pile up either.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES)
    at = 0
    while at < len(column):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "left")) + 1)
        yield column.slice(at, min(end, len(column)) - at)
        at = end


def groups(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[list[str]]:
    """``slices`` as lists of texts; null is empty."""
    for part in slices(column, size):
        yield [t or "" for t in part.to_pylist()]


def _encode_words(path: str, words: list[str]) -> list[np.ndarray]:
    """The ids of each word, many words in one call of the library where it says which word an id belongs to."""
    out: list[np.ndarray] = []
    for at in range(0, len(words), WORDS_IN_A_CALL):
        part = words[at : at + WORDS_IN_A_CALL]
        if path.endswith(".json"):
            e = tokenizer(path).encode(part, is_pretokenized=True, add_special_tokens=False)
            owners = e.word_ids
            if None not in owners:
                sizes = np.bincount(np.array(owners, np.int64), minlength=len(part))
                ends = np.cumsum(sizes).tolist()
                ids = np.array(e.ids, "<u4")
                out += [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                continue
        out += [np.array(x, "<u4") for x in _encode(path, part)]
    return out


class _Words(dict):
    """Word -> what ``keep`` makes of its ids. Two generations: words not met for a while leave first."""

    def __init__(self, path: str, prefix: str, keep):
        super().__init__()
        self.path, self.prefix, self.keep, self.old = path, prefix, keep, {}
        self.chars, self.long = 0, []

    def learn(self, words: set[str]) -> None:
        for w in self.long:  # these stay until the next call only
            del self[w]
        self.long = [w for w in words if len(w) > LONGEST_KEPT]
        new = words - self.keys()
        added = sum(len(w) for w in new if len(w) <= LONGEST_KEPT)
        if len(self) + len(new) > CACHE_ENTRIES or self.chars + added > CACHE_CHARS:
            self.old = dict(self)
            self.clear()
            new = words
            self.chars, added = 0, sum(len(w) for w in new if len(w) <= LONGEST_KEPT)
        self.chars += added
        known = new & self.old.keys()
        self.update((w, self.old[w]) for w in known)
        rest = list(new - known)
        self.update(zip(rest, map(self.keep, _encode_words(self.path, [self.prefix + w for w in rest])), strict=True))


_CACHES: dict[tuple, _Words] = {}


def _cache(path: str, prefix: str, what: str, keep) -> _Words:
    return _CACHES.setdefault((path, prefix, what), _Words(path, prefix, keep))


# --- ids -----------------------------------------------------------------------------------------------------------

# Plain Latin letters, which composition keeps and lower case turns into one letter each.
PLAIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: A comma or full stop that follows a plain letter or digit and ends a word is a word of its own.
_APART = f"([{PLAIN}0-9])([.,])( |$)"
#: A comma or full stop that does not follow a plain letter or digit may belong to a longer token.
_RUN = re.compile(f"(?<![{PLAIN}0-9])[.,]")
#: Plain words that go to the library as one text.
WORDS_IN_A_TEXT = 256
#: Such texts in a call: what the library returns takes some hundred bytes a token.
TEXTS_IN_A_CALL = 32
#: Texts of about so many bytes are encoded at once; their different words go to the library.
SLICE_BYTES = 16 << 20
#: Words whose ids are gathered at once.
WORDS_AT_ONCE = 1 << 19


def _plain_words(path: str):
    """(tokenizer of plain words, which ids end a word), where words of plain letters need lower case and their bytes
    only and the vocabulary marks the ends of words; else None. It has the model of the file's tokenizer."""
    if (path, "plain") not in _LOADED:
        from tokenizers import normalizers, pre_tokenizers

        whole, lean = tokenizer(path), type(tokenizer(path)).from_file(path)
        suffix = getattr(whole.model, "end_of_word_suffix", None)
        steps, cuts = str(whole.normalizer), str(whole.pre_tokenizer)
        simple = suffix and "NFC" in steps and "Lowercase" in steps and r"[\p{L}]+" in cuts and "ByteLevel" in cuts
        _LOADED[path, "plain"] = None
        if simple:
            lean.normalizer = normalizers.Lowercase()
            lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = whole.get_vocab()
            ends = np.zeros(max(vocabulary.values()) + 1, bool)
            ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            _LOADED[path, "plain"] = lean, ends
    return _LOADED[path, "plain"]


def _encode_plain(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of words of plain letters: many words are one text, and the marks of word ends cut it again."""
    if lean := _plain_words(path):
        texts = [" ".join(words[at : at + WORDS_IN_A_TEXT]) for at in range(0, len(words), WORDS_IN_A_TEXT)]
        some = (texts[at : at + TEXTS_IN_A_CALL] for at in range(0, len(texts), TEXTS_IN_A_CALL))
        ids = np.concatenate([np.empty(0, "<u4"), *(np.array(e.ids, "<u4") for part in some for e in lean[0].encode_batch_fast(part, add_special_tokens=False))])
        last = np.flatnonzero(lean[1][ids])
        if len(last) == len(words):
            return ids, np.diff(last, prepend=-1)
    return _joined(_encode_words(path, words))


def _joined(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.empty(0, "<u4"), *ids]), np.array([len(x) for x in ids], np.int64)


def encode_column(path: str, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, ids of each text) of consecutive parts of a column, for a tokenizer that drops white space; null is empty.

    Blanks and line ends separate words for such a tokenizer, so every word is encoded alone: Arrow splits the texts
    and numbers their words, the different ones are encoded once, and the ids are gathered by number.
    """
    t = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), "\n", " ")
    lists = pc.split_pattern(pc.replace_substring_regex(t, _APART, r"\1 \2 "), " ")
    del t
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
    del lists
    words, numbers, offsets = coded.dictionary, coded.indices.to_numpy(), offsets - offsets[0]
    plain = pc.match_substring_regex(words, f"^[{PLAIN}]+$")
    simple, odd = _encode_plain(path, words.filter(plain).to_pylist()), _joined(_encode_words(path, words.filter(pc.invert(plain)).to_pylist()))
    pool, sizes, is_plain = np.concatenate([simple[0], odd[0]]), np.empty(len(words), np.int64), plain.to_numpy(zero_copy_only=False)
    starts = np.empty(len(words), np.int64)
    for which, (_, n), first in ((is_plain, simple, 0), (~is_plain, odd, len(simple[0]))):
        sizes[which], starts[which] = n, first + np.cumsum(n) - n
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + WORDS_AT_ONCE, "right")) - 1)
        word = numbers[offsets[at] : offsets[end]]
        n = sizes[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        yield pool[np.repeat(starts[word] - ends[:-1], n) + np.arange(ends[-1])], np.diff(ends[offsets[at : end + 1] - offsets[at]])
        at = end


def _id_batches(path: str, end_id: int | None, id_col: str, text_col: str):
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            doc, at = batch.column(id_col), 0
            for ids, sizes in (x for texts in slices(batch.column(text_col), SLICE_BYTES) for x in encode_column(path, texts)):
                n = len(sizes)
                ids = np.insert(ids, np.cumsum(sizes), end[0]) if len(end) else ids
                sizes = sizes + len(end)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids.view("<i4")))
                yield pa.RecordBatch.from_arrays([doc.slice(at, n), pa.array(np.arange(place, place + n)), pa.array(sizes.astype(np.int32)), lists], ["doc_id", "place", "n_tokens", "ids"])
                at, place = at + n, place + n
        pa.default_memory_pool().release_unused()

    return run


FILES = "doc_id long, shard int, place long, n_tokens int, ids array<int>"


def write_token_ids(docs: DataFrame, path: str, vocabulary: str, *, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = 32 << 20, page_bytes: int = 128 << 10, page_rows: int = 2000) -> DataFrame:
    """Encode whole texts and write ``(doc_id, shard, place, n_tokens, ids)`` as Parquet, ordered by document id.

    Every shard is a range of ids, sorted; shard numbers follow the ranges, places count the rows of a shard. Ids are
    dictionary-coded list columns; columns whose dictionary does not pay, as document ids, are delta-coded (pages of
    format 2). Row groups and pages have the given sizes, and the column and offset indexes let ``read_token_ids``
    fetch the pages of a few documents, and ``read_token_counts`` the counts alone. A null text has no ids but the
    end id, a very long one is one row, an empty table gives an empty result. Rows with one id stay in one shard,
    ordered by text; repeated rows stay rows; null ids come first. Other columns are ignored.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ordered = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_id_batches(vocabulary, end_id, "doc_id", "text"), "doc_id long, place long, n_tokens int, ids array<int>")
    options = {"compression": "snappy", "parquet.writer.version": "v2", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows, "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": 1 << 20}
    rows.withColumn("shard", F.spark_partition_id()).select("doc_id", "shard", "place", "n_tokens", "ids").write.options(**options).parquet(path)
    return spark.read.schema(FILES).parquet(path)


def read_token_ids(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The rows of documents ``first`` to ``last``: the bounds reach the scan, which skips files, row groups and pages."""
    return spark.read.schema(FILES).parquet(path).filter(F.col("doc_id").between(first, last))


def read_token_counts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens) of all documents; the ids are not read."""
    return spark.read.schema(FILES).parquet(path).select("doc_id", "n_tokens")


def _crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))
        data = memoryview(values).cast("B")
        crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        same = [batch.column(c) for c in ("doc_id", "shard", "place")]
        yield pa.RecordBatch.from_arrays([*same, pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())], ["doc_id", "shard", "place", "n_tokens", "ids_crc32"])


def token_file_digest(files: DataFrame) -> DataFrame:
    """Per document of token files: start (ids before it), number of ids, crc32 of the ids.

    The starts come in two steps, so that no task orders all documents: sums of shards, then a running sum in each.
    """
    rows = files.mapInArrow(_crc_batches, "doc_id long, shard int, place long, n_tokens long, ids_crc32 long")
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = files.groupBy("shard").agg(F.sum(F.col("n_tokens").cast("long")).alias("_all"))
    before = sums.select("shard", F.coalesce(F.sum("_all").over(order), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(F.broadcast(before), "shard")  # a row a shard
    return out.select("doc_id", (F.col("_before") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32", "shard")


def token_output(docs: DataFrame, vocabulary: str, path: str | None = None, **options) -> DataFrame:
    """``write_token_ids`` and the digest of what the files hold."""
    return token_file_digest(write_token_ids(docs, path or scratch(docs.sparkSession, "token-ids"), vocabulary, **options))


# --- counts --------------------------------------------------------------------------------------------------------

#: White space that the short way of counting does not handle.
_ODD_SPACE = re.compile(r"\s\s|[^\S \n]")
#: No token of a byte-level tokenizer spans a non-blank and the blank after it.
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def safe_parts(text: str, chars: int = PART_CHARS) -> list[str]:
    """A long text in parts whose token counts add up to its own: cut only between a non-blank and a blank."""
    parts, at = [], 0
    while len(text) - at > chars:
        cut = _SAFE_CUT.search(text, at + chars)
        if not cut:
            break
        parts.append(text[at : cut.start()])
        at = cut.start()
    return [*parts, text[at:]]


def count_tokens_byte_level(path: str, texts: list[str]) -> list[int]:
    """Token counts of whole texts for a byte-level tokenizer whose words carry the blank before them."""
    first, later = _cache(path, "", "n", len), _cache(path, " ", "n", len)
    comma, stop, newline = (len(x) for x in _encode(path, [",", ".", "\n"]))
    out: list[int] = [0] * len(texts)
    lines: list[tuple[int, list[str]]] = []
    odd: list[tuple[int, str]] = []
    for i, t in enumerate(texts):
        if _ODD_SPACE.search(t):
            odd += ((i, p) for p in safe_parts(t))
            continue
        n = newline * t.count("\n")
        if not _RUN.search(t):
            for mark, each in ((", ", comma), (". ", stop), (".\n", stop), (",\n", comma)):
                if mark in t:
                    n += each * t.count(mark)
                    t = t.replace(mark, mark[1])
        out[i] = n
        lines += ((i, x.split(" ")) for x in t.split("\n"))
    first.learn({w[0] for _, w in lines})
    later.learn(set().union(*(w[1:] for _, w in lines)))
    begin, get = first.__getitem__, later.__getitem__
    for i, w in lines:
        out[i] += begin(w[0]) + sum(map(get, w[1:]))
    for (i, _), ids in zip(odd, _encode(path, [p for _, p in odd]), strict=True):
        out[i] += len(ids)
    return out


def _count_batches(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[int] = []
            for group in groups(batch.column("text")):
                counts += count_tokens_byte_level(path, group)
            n = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, vocabulary: str, *, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: UTF-8 bytes, tokens of the whole text, and whether they are more than ``limit``.

    One narrow pass over the two columns, no shuffle; texts go to the library in groups of about equal bytes. Null
    texts count as empty; rows with equal ids and repeated rows stay rows; an empty table gives an empty result; other
    columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(_count_batches(vocabulary, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
