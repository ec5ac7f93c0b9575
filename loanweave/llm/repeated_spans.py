"""Removing bytes of long strings that occur elsewhere, by bucket-pointer refinement over sampled suffixes.

A string of ``LENGTH`` bytes holds ``LENGTH - GRAM + 1`` q-grams. The one with the smallest bucket number is its
anchor, so equal strings have equal anchors at equal places and need only be compared within the anchor's bucket. As in
bucket-pointer refinement of suffix arrays, names are refined by pointing to the names at later offsets: a string's name
combines the bucket numbers at offsets 0, q, 2q and at its end, and the name of an anchor's whole surroundings (its
"context", all strings it anchors) reuses the string names at both of its ends.

1. Anchors are grouped by bucket and context. A context found twice covers all its strings, in one step.
2. Buckets with one context are done. In the others each different context is taken apart into its strings once: within
   the tasks for ordinary buckets, as rows for buckets with very many contexts.

Names are 64-bit numbers, used in pairs. Matches never cross documents, nothing is sampled away: every string has an
anchor. A null or empty text has no bytes. Exact repeats of a row are copies of each other like any two documents, in
which case every string of them goes. Only doc_id and text are used. Strings are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_by_frequency, written

LENGTH = 200
GRAM = 64
#: Strings of a text that are handled at once; longer texts go piece by piece, with overlap.
PIECE = 1 << 17
#: Contexts of a bucket that one task compares, some 7 MB; buckets with more are compared as rows of a shuffle.
TASK_CONTEXTS = 20_000
ROWS_AT_ONCE = 8_000

_U = np.uint64
_PLACE_BITS = 20
_BYTE = np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    steps = np.full(PIECE + LENGTH + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def buckets(data: np.ndarray) -> np.ndarray:
    """Initial buckets: a number for the q-gram at every place of ``data`` (bytes)."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _UP[: len(data)], out=sums[1:])
    return _mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: len(data) - GRAM + 1])


def string_names(grams: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Refined names of the strings that start at ``places``: pointers to the buckets at later offsets, step by step."""
    name = grams[places]
    for offset in (*range(GRAM, LENGTH - GRAM, GRAM), LENGTH - GRAM):
        name = _mix(name * _U(_BASE) + grams[places + offset])
    return name


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, bucket, context) for each run of strings with the same anchor; places in ``data``."""
    grams, width = buckets(data), LENGTH - GRAM + 1
    # the place in the low bits makes numbers unique and ties fall to the first gram
    keys = (grams & ~_U((1 << _PLACE_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
    rows = np.concatenate([keys, np.full(-len(keys) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - LENGTH + 1
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _U((1 << _PLACE_BITS) - 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([first[1:], [n]]) - 1
    anchor = least[first].astype(np.int64)
    shape = ((last - first) * 256 + anchor - first).astype(np.uint64)
    context = _mix(_mix(string_names(grams, first) * _U(_BASE) + string_names(grams, last)) * _U(_BASE) + shape)
    return first, last, anchor, grams[anchor], context


def pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(data) - LENGTH + 1, PIECE):
        yield at, data[at : at + PIECE + LENGTH - 1]


def _packed(first, last, anchor, tag) -> np.ndarray:
    """One long: 15 bits of the row's second key, then start, anchor offset and number of strings less one."""
    return (tag & 0x7FFF) << 48 | first << 16 | (anchor - first) << 8 | (last - first)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16 & 0xFFFFFFFF, place >> 8 & 0xFF, place & 0xFF


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text and a key of 64 and 15 bits that only equal rows share."""
    tag = F.pmod(F.hash("text", "doc_id"), F.lit(1 << 15)).cast("long")
    return documents.select(F.col("doc_id").cast("string"), F.xxhash64("doc_id", "text").alias("key"), tag.alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def find_anchors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[tuple] = []
            held = 0
            for key, tag, text in zip(batch["key"], batch["tag"], batch["text"]):
                for at, data in pieces(text.encode("utf-8", "replace")):
                    first, last, anchor, bucket, context = anchors(data)
                    found.append((bucket, context, np.full(len(first), key), _packed(first + at, last + at, anchor + at, tag)))
                    held += len(first)
                    if held > 200_000:
                        yield joined(found)
                        found, held = [], 0
            if found:
                yield joined(found)

    def joined(found: list[tuple]) -> pd.DataFrame:
        bucket, context, key, place = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"bucket": bucket.view(np.int64), "context": context.view(np.int64), "key": key, "place": place})

    return rows.select("key", "tag", "text").mapInPandas(run, "bucket long, context long, key long, place long")


def _squeezed(rows: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield batch.assign(text=[squeeze(t.encode("utf-8", "replace")) for t in batch["text"]])

    return rows.mapInPandas(run, "doc_id string, key long, tag long, text binary")


def _bytes(squeezed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(squeezed)


def repeated_starts(contexts: DataFrame) -> DataFrame:
    """key and place (runs of strings) of strings that ``contexts`` (bucket, key, place, needs, hot, own) hold twice."""

    def strings(part: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """bucket, name, row and offset of every string; equal strings have the same distance to the anchor."""
        names, rows, offsets, ahead = [], [], [], []
        start, to_anchor, more = _unpacked(part["place"].to_numpy())
        for row, own in enumerate(part["own"]):
            data = np.frombuffer(own, dtype=np.uint8)
            at = np.arange(more[row] + 1)
            names.append(string_names(buckets(data), at))
            rows.append(np.full(len(at), row))
            offsets.append(at)
            ahead.append(to_anchor[row] - at)
        name, row, offset, ahead = (np.concatenate(x) for x in (names, rows, offsets, ahead))
        name = _mix(name * _U(_BASE) + ahead.astype(np.uint64))
        return part["bucket"].to_numpy()[row], name.view(np.int64), row, offset, start[row] + offset

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= ROWS_AT_ONCE:
                part = pd.concat(waiting, ignore_index=True)
                # the last bucket may go on in the next batch
                ends = part["bucket"].to_numpy() != part["bucket"].iloc[-1]
                waiting = [part[~ends]]
                if ends.any():
                    yield compared(part[ends].reset_index(drop=True))
        if waiting and sum(map(len, waiting)):
            yield compared(pd.concat(waiting, ignore_index=True))

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        bucket, name, row, _, start = strings(part)
        order = np.lexsort((name, bucket))
        same = (bucket[order][1:] == bucket[order][:-1]) & (name[order][1:] == name[order][:-1])
        twice = np.zeros(len(order), dtype=bool)
        twice[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        twice &= part["needs"].to_numpy()[row]
        # strings of a context that follow each other leave as one run
        row, start = row[twice], start[twice]
        begins = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])[: len(row)]
        ends = np.concatenate([begins[1:], [True]])[: len(row)]
        tag = part["place"].to_numpy()[row[begins]] >> 48
        return pd.DataFrame({"key": part["key"].to_numpy()[row[begins]], "place": _packed(start[begins], start[ends], start[begins], tag)})

    def as_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                part = batch.iloc[at : at + 1_000].reset_index(drop=True)
                bucket, name, row, _, start = strings(part)
                tag = part["place"].to_numpy()[row] >> 48
                yield pd.DataFrame(
                    {"bucket": bucket, "name": name, "key": part["key"].to_numpy()[row],
                     "place": _packed(start, start, start, tag), "needs": part["needs"].to_numpy()[row]}
                )

    columns = ["bucket", "key", "place", "needs", "own"]
    few = contexts.filter(~F.col("hot")).select(columns).repartition("bucket").sortWithinPartitions("bucket")
    found = few.mapInPandas(within, "key long, place long")
    hot = contexts.filter("hot").select(columns)
    if hot.isEmpty():
        return found
    rows = written(hot.mapInPandas(as_rows, "bucket long, name long, key long, place long, needs boolean"), "strings")
    twice = rows.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return found.unionByName(split_by_frequency(rows.filter("needs"), twice, ["bucket", "name"], "n").select("key", "place"))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end of each removed run, in bytes)."""
    rows = keyed(documents)
    found = written(find_anchors(rows), "anchors")
    counts = found.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))
    kinds = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    kinds = written(kinds, "buckets")
    useful = written(split_by_frequency(counts, kinds.drop("total"), ["bucket"], "kinds"), "contexts")
    shared = written(split_by_frequency(found, useful, ["bucket", "context"], "n").drop("context"), "shared")
    whole = shared.filter("n > 1").select("key", "place")
    apart = shared.filter("kinds > 1 and (n = 1 or key = first_key)").select(
        "bucket", "key", "place", (F.col("n") == 1).alias("needs"), (F.col("kinds") > TASK_CONTEXTS).alias("hot")
    )
    tag = F.shiftright("place", 48).alias("tag")
    asked = apart.groupBy("key", tag).agg(F.collect_list(F.struct("bucket", "place", "needs", "hot")).alias("asked"))

    def surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, squeezed, asked in zip(batch["key"], batch["text"], batch["asked"]):
                text = _bytes(squeezed)
                for a in asked:
                    start, _, more = (int(x) for x in _unpacked(np.int64(a["place"])))
                    out.append((a["bucket"], key, a["place"], a["needs"], a["hot"], text[start : start + more + LENGTH]))
            yield pd.DataFrame(out, columns=["bucket", "key", "place", "needs", "hot", "own"])

    texts = _squeezed(rows)
    contexts = texts.select("key", "tag", "text").join(asked, ["key", "tag"]).mapInPandas(
        surroundings, "bucket long, key long, place long, needs boolean, hot boolean, own binary"
    )
    single = repeated_starts(written(contexts, "surroundings"))
    starts = whole.unionByName(single).groupBy("key", tag).agg(F.collect_list("place").alias("places"))

    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, squeezed, places in zip(batch["doc_id"], batch["text"], batch["places"]):
                text = _bytes(squeezed)
                spans = spans_of(places)
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                out.append((doc_id, len(text), sum(e - s for s, e in spans), len(spans), kept.hexdigest(), spans))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    found = texts.join(starts, ["key", "tag"], "left").drop("key", "tag").mapInPandas(removed, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def spans_of(places) -> list[list[int]]:
    """Maximal runs of bytes under strings given as packed places (null: none)."""
    if places is None or not len(places):
        return []
    start, _, more = _unpacked(np.sort(np.asarray(places, dtype=np.int64) & 0xFFFFFFFFFFFF))
    reach = np.maximum.accumulate(start + more + LENGTH)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return [[int(s), int(e)] for s, e in zip(start[new], reach[np.concatenate([new[1:], [True]])])]
