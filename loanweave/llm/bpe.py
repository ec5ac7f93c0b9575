"""Byte-level BPE through a table of distinct words: encoding each word once, decoding through an id-to-piece join.

Texts are split into words by Spark. Tasks number the distinct words of a block of documents (about ``BLOCK_CHARS``
characters) and write every document as places in that numbering, so a word crosses the network once per block and not
once per occurrence. The distinct words of all blocks form one table, dealt and sorted by word; each distinct word is
encoded once, and its ids return to the blocks by place. A block lays them out and joins ids with the table of pieces.

A null text is empty and has no ids; an empty text decodes to an empty text; repeated rows and equal or null doc_ids
each give their own row (no join uses doc_id); a text of any length is one row of one block, never cut; an empty table
gives no rows; other columns are left out and their names never matter. There are no ties: the merges of a word are
ordered. Tables of word ids hold no counters or caps: every distinct word is a row, however many there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

#: Characters of a block; one document more may start below this number.
BLOCK_CHARS = 1 << 24
#: Words, or bytes of ids, that a task packs at a time; words of documents that lie in one row.
PACK_ROWS = 1 << 18
PACK_BYTES = 1 << 26
ROW_WORDS = 1 << 16

#: White space and the word pattern of the published byte-level vocabularies, with the space class spelt out.
_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


@dataclass(frozen=True)
class Vocabulary:
    """Path of a tokenizers file with a byte-level BPE; the same path must hold on every machine."""

    tokenizer: str

    @classmethod
    def public(cls) -> Vocabulary:
        import public_tokenizers

        return cls(public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: Vocabulary):
    """One per process, without truncation and padding."""
    from tokenizers import Tokenizer

    with open(vocabulary.tokenizer, encoding="utf-8") as lines:
        parts = json.load(lines)
    splitter = parts["pre_tokenizer"] or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
    flags = [t for t in parts["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if not plain or parts["normalizer"] or flags:
        raise ValueError("only byte-level vocabularies that neither normalise nor add spaces are supported")
    tokenizer = Tokenizer.from_file(vocabulary.tokenizer)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_tokens(vocabulary: Vocabulary) -> list[str]:
    """Strings that are one token wherever they stand, the longest first."""
    found = [t.content for t in _tokenizer(vocabulary).get_added_tokens_decoder().values()]
    return sorted(found, key=lambda t: (-len(t), t))


def words_of(text: Column, special: list[str]) -> Column:
    """The words of ``text`` in order; joined, they are the text. Special tokens' strings are words of their own."""
    plain = lambda part: F.regexp_extract_all(part, F.lit(WORDS), F.lit(0))
    if not special:
        return plain(text)
    pattern = "|".join(r"\Q" + s + r"\E" for s in special)
    between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    with_mark = lambda part, i: F.when(i == 0, plain(part)).otherwise(F.concat(F.array(F.get(between, i - 1)), plain(part)))
    return F.when(text.rlike(pattern), F.flatten(F.transform(F.split(text, pattern, -1), with_mark))).otherwise(plain(text))


@lru_cache(maxsize=2)
def _spellings(vocabulary: Vocabulary) -> list[tuple[int, bytes]]:
    """Id and bytes of every token, in order of the ids."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    # fixed values: bytes that do not print are shown as the characters from U+0100 on
    hidden = [b for b in range(256) if b not in set(printable)]
    shown = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(hidden)}
    found = []
    for token, number in _tokenizer(vocabulary).get_vocab(with_added_tokens=True).items():
        found.append((number, bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()))
    return sorted(found)


def pieces(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """id and piece of every token; a piece is a string whose characters up to U+00FF stand for its bytes."""
    rows = [(number, data.decode("latin-1")) for number, data in _spellings(vocabulary)]
    return spark.createDataFrame(rows, "id int, piece string")


def spelled(sequences: DataFrame, table: DataFrame) -> DataFrame:
    """``sequences`` (one row per value of all columns but ``ids``: array<int>) with ``bytes``, joined on the ids.

    Ids that the table does not hold give nothing. The table has one row per token of the vocabulary, which bounds the broadcast.
    """
    keys = [c for c in sequences.columns if c != "ids"]
    placed = sequences.select(*keys, F.posexplode("ids").alias("at", "id"))
    found = placed.join(F.broadcast(table), "id").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "id", "piece"))).alias("found"))
    joined = F.array_join(F.col("found.piece"), "")
    return found.select(*keys, F.col("found.id").alias("ids"), F.encode(joined, "ISO-8859-1").alias("bytes"))


def decode(sequences: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``sequences`` with ``decoded``, the text of its column ``ids`` (array<int>); malformed bytes become U+FFFD.

    Null or empty ids, and ids outside the vocabulary only, give an empty text. Columns ``decoded`` and ``_row`` of the
    input are replaced.
    """
    vocabulary = vocabulary or Vocabulary.public()
    rows = written(sequences.drop("decoded", "_row").withColumn("_row", F.monotonically_increasing_id()), "sequences")
    found = spelled(rows.select("_row", "ids"), pieces(sequences.sparkSession, vocabulary))
    text = F.expr("make_valid_utf8(cast(bytes as string))")
    with_text = rows.join(found.select("_row", text.alias("decoded")), "_row", "left")
    return with_text.withColumn("decoded", F.coalesce("decoded", F.lit(""))).drop("_row")


def encode_places(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """block, mark and ``coded`` (places of some words of the block with their ids) for ``words`` (block, mark, place, word).

    Rows are dealt by word and sorted, so equal words follow each other and each distinct word is encoded once; a word
    crosses the network once per block, its ids once on the way back, packed by block.
    """

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        block, mark, place = (rows.column(c).to_numpy() for c in ("block", "mark", "place"))
        order = np.lexsort((place, mark, block))
        block, mark, place = block[order], mark[order], place[order]
        ids = rows.column("ids").combine_chunks().take(pa.array(order))
        ends, flat = _laid_out(ids)
        ends, flat = ends // 4, flat.view("<u4")
        sizes = np.diff(ends)
        first = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (mark[1:] != mark[:-1])]))
        coded = []
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
            steps = np.diff(place[i:j], prepend=0)
            coded.append(_packed(np.concatenate([[j - i], steps, sizes[i:j], flat[ends[i] : ends[j]]])))
        return pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array(mark[first]), pa.array(coded, pa.binary())], ["block", "mark", "coded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        last, last_ids, held, rows, size = None, b"", [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            numbers = []
            for word in coded.dictionary.to_pylist():
                if word != last:
                    last, last_ids = word, np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
                numbers.append(last_ids)
            ids = pa.array(numbers, pa.binary()).take(coded.indices)
            held.append(pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "mark", "place")), ids], ["block", "mark", "place", "ids"]))
            rows, size = rows + batch.num_rows, size + ids.nbytes
            if rows >= PACK_ROWS or size >= PACK_BYTES:
                yield pack(held)
                held, rows, size = [], 0, 0
        if held:
            yield pack(held)

    dealt = words.select("block", "mark", "place", "word").repartition("word").sortWithinPartitions("word")
    return dealt.mapInArrow(run, "block long, mark long, coded binary")


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed numbers below 2^32: small ones are frequent, so the planes of high bytes are nearly empty."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _laid_out(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends (from 0) and all bytes, one after the other, of a string or binary array without nulls."""
    wide = pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type)
    _, ends, data = values.buffers()
    if not len(values) or data is None:
        return np.zeros(len(values) + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def _block(number: int, batches: list[tuple[pa.Array, pa.Array]], of_words: bool) -> Iterator[pa.RecordBatch]:
    """One block: its distinct words by place, or its documents as places. ``mark`` is a hash of all its words in order."""
    keys = pa.concat_arrays([k for k, _ in batches])
    lists = pa.concat_arrays([w for _, w in batches])
    coded = lists.flatten().dictionary_encode()
    codes, sizes = coded.indices.to_numpy(), pc.list_value_length(lists).to_numpy()
    counts = np.bincount(codes, minlength=len(coded.dictionary))
    order = np.argsort(-counts, kind="stable")
    mark = xxhash.xxh3_64(codes.tobytes())
    for part in _laid_out(coded.dictionary):
        mark.update(part.tobytes())
    named = lambda n: [pa.array(np.full(n, x, np.int64)) for x in (number, mark.intdigest() >> 1)]
    if of_words:
        words = coded.dictionary.take(pa.array(order))
        n = len(order)
        yield pa.RecordBatch.from_arrays([*named(n), pa.array(np.arange(n, dtype=np.int32)), words], ["block", "mark", "place", "word"])
        return
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    # runs of whole documents
    group = ends[:-1] // ROW_WORDS
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    bounds = [*first.tolist(), len(sizes)]
    packed = [_packed(place[codes[ends[i] : ends[j]]]) for i, j in zip(bounds, bounds[1:])]
    offsets = pa.array(bounds, pa.int32())
    columns = [pa.ListArray.from_arrays(offsets, keys), pa.ListArray.from_arrays(offsets, pa.array(sizes, pa.int32())), pa.array(packed, pa.binary())]
    yield pa.RecordBatch.from_arrays([*named(len(packed)), *columns], ["block", "mark", "doc_ids", "sizes", "places"])


def _blocks(documents: DataFrame, vocabulary: Vocabulary, block_chars: int, of_words: bool) -> DataFrame:
    """block and mark with ``place`` and ``word`` of each distinct word, or ``doc_ids``, ``sizes`` and ``places`` of documents."""
    text = F.coalesce("text", F.lit(""))
    # code points that only newer tables of letters know are left to the tokenizers library's own splitter
    odd = text.rlike(r"\p{Cn}")
    split = documents.select(
        "doc_id", F.when(~odd, words_of(text, special_tokens(vocabulary))).alias("words"), F.when(odd, text).alias("text")
    )
    kind = documents.select("doc_id").schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys, lists, texts = batch.columns
            lists = lists.cast(pa.list_(pa.string()))
            if texts.null_count < len(texts):
                tokenizer = _tokenizer(vocabulary)
                own = lists.to_pylist()
                for i, text in enumerate(texts.to_pylist()):
                    if text is not None:
                        own[i] = _split_by_library(tokenizer, text)
                lists = pa.array(own, pa.list_(pa.string()))
            sizes = np.cumsum(pc.fill_null(_characters(lists), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(sizes):
                room = block_chars - chars + (sizes[start - 1] if start else 0)
                end = min(len(sizes), int(np.searchsorted(sizes, room, "left")) + 1)
                held.append((keys.slice(start, end - start), lists.slice(start, end - start)))
                chars += int(sizes[end - 1] - (sizes[start - 1] if start else 0))
                start = end
                if chars >= block_chars:
                    yield from _block(number, held, of_words)
                    held, chars, number = [], 0, number + 1
        if held:
            yield from _block(number, held, of_words)

    columns = "place int, word string" if of_words else f"doc_ids array<{kind}>, sizes array<int>, places binary"
    return split.mapInArrow(run, f"block long, mark long, {columns}")


def _characters(lists: pa.Array) -> pa.Array:
    """Characters of each row's words."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False))])
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    last = np.cumsum(sizes)
    return pa.array(ends[last] - ends[last - sizes])


def _split_by_library(tokenizer, text: str) -> list[str]:
    parts = [(text, False)]
    for special in sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True):
        cut = []
        for part, done in parts:
            if done:
                cut.append((part, True))
                continue
            first, *rest = part.split(special)
            cut.append((first, False))
            for more in rest:
                cut += [(special, True), (more, False)]
        parts = cut
    words = []
    for part, done in parts:
        words += [part] if done else [part[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(part)]
    return words


def round_trip(documents: DataFrame, vocabulary: Vocabulary | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, ``ids`` (binary: little-endian unsigned 32-bit) and ``decoded`` (the text of these ids) of every document.

    Ids meet their pieces in the task that lays out a block, as a broadcast join: the pieces are as many as the tokens of
    the vocabulary. Whether the bytes are well-formed is judged on the whole document.

    Documents are split twice, for their words and for their places, instead of being written between. That needs rows
    that come in the same order each time, as those of a table do: a block's ``mark`` differs otherwise and the run fails.
    """
    vocabulary = vocabulary or Vocabulary.public()
    kind = documents.select("doc_id").schema["doc_id"].dataType.simpleString()
    coded = encode_places(_blocks(documents, vocabulary, block_chars, of_words=True), vocabulary)
    texts = _blocks(documents, vocabulary, block_chars, of_words=False)
    shared = documents.sparkSession.sparkContext.broadcast(_spellings(vocabulary))

    def lay_out(texts: pa.Table, words: pa.Table) -> pa.Table:
        spelling = [b""] * (shared.value[-1][0] + 1)
        for number, data in shared.value:
            spelling[number] = data
        spelling = pa.array(spelling, pa.large_binary())
        at, sizes, flat = ([np.zeros(0, np.uint32)] for _ in range(3))
        for data in words.column("coded").to_pylist():
            own = _unpacked(data)
            n = int(own[0])
            at.append(np.cumsum(own[1 : n + 1], dtype=np.uint32))
            sizes.append(own[n + 1 : 2 * n + 1])
            flat.append(own[2 * n + 1 :])
        at, sizes, flat = np.concatenate(at), np.concatenate(sizes), np.concatenate(flat)
        begin, length = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        begin[at], length[at] = np.cumsum(sizes, dtype=np.int64) - sizes, sizes
        out = []
        for own_keys, n_words, places in zip(texts.column("doc_ids"), texts.column("sizes"), texts.column("places")):
            places = _unpacked(places.as_py())
            if len(places) and places.max() >= len(at):
                raise ValueError("the documents changed between two readings; write them as a table first")
            long = length[places]
            ends = np.concatenate([[0], np.cumsum(long)])
            ids = flat[np.repeat(begin[places] - ends[:-1], long) + np.arange(ends[-1])]
            found = spelling.take(pa.array(ids))
            sides, data = _laid_out(found)
            data = data.tobytes()
            words_end = np.concatenate([[0], np.cumsum(n_words.values.to_numpy())])
            cuts = ends[words_end]
            numbers = ids.astype("<u4").tobytes()
            pairs = list(zip(cuts.tolist(), cuts[1:].tolist()))
            letters = sides[cuts].tolist()
            out.append(
                pa.table(
                    {
                        "doc_id": own_keys.values,
                        "ids": pa.array([numbers[4 * i : 4 * j] for i, j in pairs], pa.binary()),
                        "decoded": pa.array([data[i:j].decode("utf-8", "replace") for i, j in zip(letters, letters[1:])], pa.string()),
                    }
                )
            )
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], texts.schema.field("doc_ids").type.value_type), "ids": pa.array([], pa.binary()), "decoded": pa.array([], pa.string())})

    laid = texts.groupBy("block", "mark").cogroup(coded.groupBy("block", "mark"))
    return laid.applyInArrow(lay_out, f"doc_id {kind}, ids binary, decoded string")
