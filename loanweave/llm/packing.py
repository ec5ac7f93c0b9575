"""Best-fit packing by levels: tasks pack what they read, nearly full bins leave, the others merge in a tree.

Level 0 tokenizes the documents of a task, cuts what is longer than a sequence and packs the rest by best fit, the
longest first. Bins with at most ``SLACK`` free places are done. Every later level takes the remaining bins as items,
in fewer tasks of at most about ``BINS_PER_TASK`` bins, until one task suffices or a level no longer lessens the bins.

A null or empty text is the end mark alone; repeated rows are packed as often as they occur; other columns are left
out; an empty table gives no rows. Only lengths, checksums and places move, never token ids.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CAPACITY = 2048
END_ID = 0
SLACK = 16
BINS_PER_TASK = 20_000
#: Pieces that a task of level 0 holds before it packs them; later levels merge what stays open.
PIECES_PER_ROUND = 100_000
CACHED_CHUNKS = 250_000

ITEM = "struct<doc_id: string, piece: int, start: long, length: long, ids_crc32: long, offset: long>"


@dataclass(frozen=True)
class Vocabulary:
    """Paths of one vocabulary: a tokenizers file and the same merges as ranks, with the splitting pattern."""

    tokenizer: str
    ranks: str
    pattern: str

    @classmethod
    def public(cls) -> Vocabulary:
        import public_tokenizers

        return cls(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


class _Irregular(Exception):
    """A chunk that borders on white space besides the space it was split at."""


class _Chunks(dict):
    """Ids of text chunks as little-endian bytes; forgets everything when full."""

    def __init__(self, encode, prefix: str, inner: bool = False):
        super().__init__()
        self.encode, self.prefix, self.inner = encode, prefix, inner

    def __missing__(self, chunk: str) -> bytes:
        # chunks that are kept have been looked at, so each distinct one is looked at once
        if self.inner and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
            raise _Irregular
        ids = self.encode(self.prefix + chunk)
        if len(chunk) <= 48:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Encoder:
    """Token ids of whole texts, as ``tokenizers`` gives them, with a cache of space-separated chunks.

    A space between two characters that are no white space always starts a token, so such a text may be encoded chunk
    by chunk. Texts with other white space next to a space, or with a special token's string, go through the
    tokenizers library as they are.
    """

    def __init__(self, vocabulary: Vocabulary):
        import numpy as np
        import tiktoken
        from tokenizers import Tokenizer

        self.np = np
        self.whole = Tokenizer.from_file(vocabulary.tokenizer)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        as_bytes = lambda text: np.array(fast.encode_ordinary(text), dtype="<u4").tobytes()
        self.first, self.rest, self.last = _Chunks(as_bytes, ""), _Chunks(as_bytes, " ", True), _Chunks(as_bytes, " ")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not any(s in text for s in self.special):
            try:
                return self._by_chunks(text)
            except _Irregular:
                pass
        return self.np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _by_chunks(self, text: str) -> bytes:
        head, *inner = text.split(" ")
        if not inner:
            return self.first[head]
        # the last chunk may end in white space, as no space follows it
        last = inner.pop()
        if not head or head[-1].isspace() or not last or last[0].isspace():
            raise _Irregular
        return self.first[head] + b"".join(map(self.rest.__getitem__, inner)) + self.last[last]


_ENCODERS: dict[Vocabulary, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per Python worker."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def cut(ids: bytes, capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, checksum) of a document's ids; all pieces but the first are full."""
    total = len(ids) // 4
    start, piece = 0, 0
    while start < total:
        length = (total - start) % capacity or capacity
        yield piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start, piece = start + length, piece + 1


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Places of ``lengths`` by bin: the longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has r places left
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[at]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(at)
        room -= length
        if room:
            by_room[room].append(chosen)
            rooms |= 1 << room
    return bins


def _merged(bins: list[list[dict]], fills: list[int]) -> pd.DataFrame:
    """Pack bins as items; pieces keep their order within a bin and are moved by the bin's new offset."""
    done = []
    for places in best_fit(fills):
        items, fill = [], 0
        for at in places:
            items += [dict(item, offset=item["offset"] + fill) for item in bins[at]]
            fill += fills[at]
        done.append((fill, items))
    return pd.DataFrame(done, columns=["fill", "items"])


def pack(documents: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document."""
    vocabulary = vocabulary or Vocabulary.public()
    schema = f"fill int, items array<{ITEM}>"
    end = END_ID.to_bytes(4, "little")

    def level_0(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).ids
        full, pieces, lengths = [], [], []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for piece, start, length, crc in cut(encode(text or "") + end):
                    item = {"doc_id": doc_id, "piece": piece, "start": start, "length": length, "ids_crc32": crc, "offset": 0}
                    if length == CAPACITY:
                        full.append((length, [item]))
                    else:
                        pieces.append([item])
                        lengths.append(length)
            if full:
                yield pd.DataFrame(full, columns=["fill", "items"])
                full = []
            if len(pieces) >= PIECES_PER_ROUND:
                yield _merged(pieces, lengths)
                pieces, lengths = [], []
        if pieces:
            yield _merged(pieces, lengths)

    def level(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, fills = [], []
        for batch in batches:
            bins += [list(items) for items in batch["items"]]
            fills += batch["fill"].tolist()
        if bins:
            yield _merged(bins, fills)

    packed = written(documents.select(F.col("doc_id").cast("string"), "text").mapInPandas(level_0, schema), "packed-0")
    done = []
    before = None
    while True:
        is_open = F.col("fill") < CAPACITY - SLACK
        waiting = packed.filter(is_open)
        count = waiting.count()
        tasks = -(-count // BINS_PER_TASK)
        # a level that could not join a hundredth of its bins leaves them as they are
        if count < 2 or (before is not None and (before == (count, 1) or before[0] * 0.99 < count)):
            done.append(packed)
            break
        done.append(packed.filter(~is_open))
        before = (count, tasks)
        first = F.col("items")[0]
        dealt = waiting.repartition(tasks, F.xxhash64(first["doc_id"], first["piece"], F.size("items")))
        packed = written(dealt.mapInPandas(level, schema), f"packed-{len(done)}")
        if tasks == 1:
            done.append(packed)
            break
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    # the ids stem from files already written, so a repeated task gives the same ones
    sequences = every.withColumn("sequence_id", F.monotonically_increasing_id())
    return sequences.select("sequence_id", F.explode("items").alias("i")).select(
        F.col("i.doc_id").cast(documents.schema["doc_id"].dataType).alias("doc_id"), "i.piece", "i.start", "i.length", "i.ids_crc32", "sequence_id", "i.offset"
    )
