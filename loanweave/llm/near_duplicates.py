"""Near-duplicate groups from bottom-k sketches of one hash function.

A text's sketch is its ``SKETCH`` smallest shingle hashes. Texts with equal shingle sets become one class. Each class
is entered under the rarer of its retained values: two sets as similar as asked share so many retained values that they
meet under one of those (``least_overlap``). A list of classes under a value is first compared with its most central
member: pairs whose union sketch makes the similarity unlikely are dropped, all others are verified on the full sets.
Classes of a list that are then still in different groups are compared with each other, as far as the rarest of their
differences to that member allow (``cross_pairs``). Groups are the connected components of verified pairs.

How rare a value is comes from a table of ``COUNTERS`` counters, a size that does not depend on the data; it only
orders values, so collisions cost time, never links. No list is capped: long ones meet in blocks of ``BLOCK``.

A null text, or one without words, has an empty set and is linked with nothing. Fewer words than a shingle are one
shingle. Repeated rows are copies. Columns other than doc_id and text are left out. A null doc_id is never the smallest
of a group; a group of nulls only has a null component and keeps all its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import split_by_frequency, written
from .components import components

SHINGLE = 5
SKETCH = 64
PER_CENT = 85
#: Standard deviations below its mean that the overlap of two sketches may fall: one such link in about 10^5 is not
#: proposed by its two texts, and then only if their similarity is the threshold itself.
DEVIATIONS = 4.5
COUNTERS = 1 << 20
CHUNK = 1 << 14
BLOCK = 4096

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes (63 bits, as int64) of the text's shingles; A-Z count as a-z."""
    # bytes.lower and bytes.split know ASCII only: just the letters and the six separators that are asked for
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(w))
    total = np.full(len(w) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += w[k : len(w) - width + 1 + k] * _ODD[k % 5] * np.uint64(2 * (k // 5) + 1)
    return np.unique((_mix(total) >> np.uint64(1)).astype(np.int64))


def least_overlap(n: int, per_cent: int = PER_CENT) -> int:
    """Retained values that a set of n shingles shares with the sketch of any set as similar as asked."""
    share, k = per_cent / 100, min(n, SKETCH)
    spread = math.sqrt(SKETCH * share * (1 - share) * max(0.0, 1 - SKETCH * share / n))
    return max(1, math.ceil(share * k - 1e-9 - DEVIATIONS * spread))


def sketched(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, set_key (null for an empty set) and sketch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "row_key": batch["row_key"],
                    "n_shingles": [len(s) for s in sets],
                    "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "sketch": [s[:SKETCH] for s in sets],
                }
            )

    rows = documents.select(F.col("doc_id").cast("string"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    found = rows.mapInPandas(run, "doc_id string, row_key long, n_shingles long, set_key binary, sketch array<long>")
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def rarity(sketches: DataFrame, column: str = "sketch") -> np.ndarray:
    """How many of the arrays in ``column`` hold a value of each counter; ``COUNTERS`` numbers whatever the data."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            values = np.concatenate([np.zeros(0, dtype=np.int64), *batch[column]])
            total += np.bincount(values % COUNTERS, minlength=COUNTERS)
        salt = TaskContext.get().partitionId() % 64
        chunks = range(0, COUNTERS, CHUNK)
        yield pd.DataFrame({"chunk": [c // CHUNK for c in chunks], "salt": salt, "counts": [total[c : c + CHUNK].tobytes() for c in chunks]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype=np.int64) for c in group["counts"])
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "salt": [0], "counts": [total.tobytes()]})

    schema = "chunk int, salt int, counts binary"
    parts = sketches.select(column).mapInPandas(count, schema)
    sums = parts.groupBy("chunk", "salt").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    found = np.zeros(COUNTERS, dtype=np.int64)
    for row in sums.collect():
        found[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], dtype=np.int64)
    return found


def entries(classes: DataFrame, counts: np.ndarray, per_cent: int) -> DataFrame:
    """value, id and place of each class under the rarer of its retained values; a low place is a central class."""
    shared = classes.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, ids, places = [], [], []
            for cid, n, sketch in zip(batch["id"], batch["n_shingles"], batch["sketch"]):
                held = shared.value[sketch % COUNTERS]
                own = sketch[np.lexsort((sketch, held))[: len(sketch) - least_overlap(n, per_cent) + 1]]
                values.append(own)
                ids.append(np.full(len(own), cid))
                places.append(np.full(len(own), -int(np.minimum(held, 1 << 20).sum())))
            if values:
                yield pd.DataFrame({"value": np.concatenate(values), "id": np.concatenate(ids), "place": np.concatenate(places)})

    return classes.select("id", "n_shingles", "sketch").mapInPandas(run, "value long, id long, place long")


def _likely(sketch_a, n_a, sketch_b, n_b, per_cent: int):
    """Whether the union sketch leaves the similarity possible; sketches need not be longer than ``SKETCH``."""
    union = F.slice(F.sort_array(F.array_union(sketch_a, sketch_b)), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect(sketch_a, sketch_b), union))
    share = per_cent / 100
    spread = DEVIATIONS * math.sqrt(share * (1 - share))
    # fewer values than the sketch holds: the union sketch is the union itself
    noise = F.when((F.size(union) < SKETCH), 0.0).otherwise(spread * math.sqrt(SKETCH))
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * per_cent) & (common >= share * F.size(union) - noise - 1e-9)


def _attach(pairs: DataFrame, table: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """Columns of ``table`` (one row per id) for ``column`` of ``pairs``, also where one id has very many pairs."""
    renamed = table.select(F.col("id").alias(column), *(F.col(k).alias(v) for k, v in names.items()))
    counts = written(pairs.groupBy(column).agg(F.count(F.lit(1)).alias("_n")), "pair-counts")
    limit = max(2_000, (counts.agg(F.sum("_n")).first()[0] or 0) // 1_000)
    hot = counts.filter(F.col("_n") > limit)
    if hot.isEmpty():
        return pairs.join(renamed, column)
    # at most a thousand ids exceed the limit: their pairs are spread over salts and their rows copied to each salt
    salts = 64
    few = F.broadcast(hot.select(column))
    dealt = pairs.join(few, column).withColumn("_salt", F.pmod(F.xxhash64(*pairs.columns), F.lit(salts)))
    copies = renamed.join(few, column).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    cold = pairs.join(few, column, "left_anti").join(renamed, column)
    return cold.unionByName(dealt.join(copies, [column, "_salt"]).drop("_salt"))


def likely_pairs(pairs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """Pairs a, b of class ids whose union sketch leaves the similarity possible."""
    table = classes.select("id", "n_shingles", "sketch")
    one = _attach(pairs, table, "a", {"n_shingles": "n_a", "sketch": "s_a"})
    both = _attach(one, table, "b", {"n_shingles": "n_b", "sketch": "s_b"})
    return both.filter(_likely(F.col("s_a"), F.col("n_a"), F.col("s_b"), F.col("n_b"), per_cent)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs whose full sets are as similar as asked."""
    both = _attach(_attach(pairs, sets, "b", {"shingles": "s_b"}), sets, "a", {"shingles": "s_a"})
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.filter(100 * common >= per_cent * (F.size("s_a") + F.size("s_b") - common)).select("a", "b")


def full_sets(documents: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and all shingles of the classes in ``wanted`` (id), computed again from one row of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "shingles": [shingles(t) for t in batch["text"]]})

    keys = classes.join(wanted, "id", "left_semi").select("id", "row_key")
    rows = documents.select(F.xxhash64("doc_id", "text").alias("row_key"), "text").join(keys, "row_key")
    return rows.mapInPandas(run, "id long, shingles array<long>").dropDuplicates(["id"])


def differences(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """pivot, id, c, n, linked, near and values for pairs of a head (a) and a member (b) of its lists.

    ``values`` are the shingles in one of the two sets only, hashed with the head; c and n are the sizes of head and
    member. Pairs further apart than three links (a similarity below 3 * per_cent - 200) are left out; ``near`` ones are
    not further apart than two.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for head, cid, s_head, s_own in zip(batch["a"], batch["b"], batch["s_a"], batch["s_b"]):
                apart = np.setxor1d(s_head, s_own, assume_unique=True)
                c, n = len(s_head), len(s_own)
                union = (c + n + len(apart)) // 2
                likeness = 100 * (union - len(apart))
                if likeness >= (3 * per_cent - 200) * union:
                    keyed = _mix(apart.astype(np.uint64) + _mix(np.full(1, head, dtype=np.uint64))) >> np.uint64(1)
                    rows.append((head, cid, c, n, likeness >= per_cent * union, likeness >= (2 * per_cent - 100) * union, keyed.astype(np.int64)))
            yield pd.DataFrame(rows, columns=["pivot", "id", "c", "n", "linked", "near", "values"])

    both = _attach(_attach(pairs, sets, "b", {"shingles": "s_b"}), sets, "a", {"shingles": "s_a"})
    return both.mapInPandas(run, "pivot long, id long, c long, n long, linked boolean, near boolean, values array<long>")


def least_shared(apart: int, n: int, c: int, linked: bool, per_cent: int) -> int:
    """Values that a difference of ``apart`` shares with that of any similar set in another group.

    Sets a and b are similar if |a ^ b| * (100 + p) <= (100 - p) * (|a| + |b|), and a ^ b is what just one of their
    differences to the head holds. One of two sets in different groups is not linked with the head, so its own
    difference exceeds this bound. Without a head (c = 0) a set is its own difference.
    """
    more, less = 100 + per_cent, 100 - per_cent
    if c == 0:
        return -(-per_cent * n // 100)
    own = more * apart + (less * (c - n) + 1 if linked else -less * (c + n))
    return max(1, -(-own // (2 * more)), apart - less * n // per_cent)


def prefixes(table: DataFrame, counts: np.ndarray, per_cent: int) -> DataFrame:
    """value, id, at, apart and n: the rarest values of each difference, enough that similar sets share one, with places."""
    shared = table.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, ids, places, aparts, sizes = [], [], [], [], []
            for cid, c, n, linked, own in zip(batch["id"], batch["c"], batch["n"], batch["linked"], batch["values"]):
                keep = len(own) - least_shared(len(own), n, c, linked, per_cent) + 1
                rarest = own[np.lexsort((own, shared.value[own % COUNTERS]))[: max(0, keep)]]
                values.append(rarest)
                ids.append(np.full(len(rarest), cid))
                places.append(np.arange(len(rarest)))
                aparts.append(np.full(len(rarest), len(own)))
                sizes.append(np.full(len(rarest), n))
            if values:
                found = [np.concatenate(x) for x in (values, ids, places, aparts, sizes)]
                yield pd.DataFrame(dict(zip(("value", "id", "at", "apart", "n"), found)))

    return table.select("id", "c", "n", "linked", "values").mapInPandas(run, "value long, id long, at long, apart long, n long")


def cross_pairs(lists: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame, per_cent: int) -> DataFrame:
    """Pairs of sets in different groups that share a list (id, head) and can still be as similar as asked.

    Members near their head meet by what they do not have in common with it: copies of one original share nearly all
    shingles, but few of their edits. Members far from a head meet by their own rarest shingles. Two similar sets are at
    most one link apart, so both are within three links of the head or both beyond two: exact but for the sketches.
    The first value that two differences share, in order of rarity, bounds what they share by what follows it in either.
    Lists of more than ``BLOCK`` sets are joined block by block.
    """
    pairs = written(lists.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(), "open-stars")
    apart = written(differences(likely_pairs(pairs, classes, max(0, 3 * per_cent - 200)), sets, per_cent), "differences")
    close = apart.filter("near").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    far = pairs.join(close, ["a", "b"], "left_anti").select(F.col("b").alias("id")).distinct()
    alone = sets.join(far, "id", "left_semi").select(
        "id", F.lit(0).cast("long").alias("c"), F.size("shingles").cast("long").alias("n"), F.lit(False).alias("linked"), F.col("shingles").alias("values")
    )
    table = written(apart.select(alone.columns).unionByName(alone), "compared")
    entered = prefixes(table, rarity(table, "values"), per_cent).join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    entered = written(entered, "prefixes")
    spans = entered.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    open_lists = written(spans.filter("low < high").select("value", "size"), "open-prefixes")
    members = split_by_frequency(entered, open_lists, ["value"], "size")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (
        members.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
    )
    columns = ("own", "id", "label", "at", "apart", "n")
    dealt = written(dealt.select("value", "x", "y", *columns), "blocks")
    left, right = (dealt.select("value", "x", "y", *(F.col(c).alias(f"{c}_{side}") for c in columns)) for side in "ab")
    most = F.least(F.col("apart_a") - F.col("at_a"), F.col("apart_b") - F.col("at_b"))
    # |a ^ b| = apart_a + apart_b - 2 * shared, at most (100 - p) / (100 + p) of both sizes, in whole numbers
    least = (F.col("apart_a") + F.col("apart_b")) * (100 + per_cent) - (F.col("n_a") + F.col("n_b")) * (100 - per_cent)
    possible = (most * (2 * (100 + per_cent)) >= least) & (F.col("label_a") < F.col("label_b"))
    meeting = (F.col("x") == F.col("y")) | (F.col("own_a") != F.col("own_b"))
    found = left.join(right, ["value", "x", "y"]).filter(possible & meeting)
    return found.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links, itself included), kept and row_key.

    ``row_key`` is a hash of doc_id and text, by which rows of ``documents`` can be told apart where ids repeat.
    """
    sketches = written(sketched(documents), "sketches")
    grouped = (
        sketches.filter("n_shingles > 0").groupBy("set_key")
        .agg(F.min("doc_id").alias("first_doc"), F.first("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"),
             F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"))
    )
    classes = written(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    entered = written(entries(classes, rarity(classes), per_cent), "entries")
    heads = (
        entered.groupBy("value").agg(F.min(F.struct("place", "id")).alias("head"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1").select("value", "size", F.col("head.id").alias("head"))
    )
    heads = written(heads, "heads")
    lists = written(split_by_frequency(entered, heads, ["value"], "size").select("value", "id", "head"), "lists")
    stars = lists.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    sets = written(full_sets(documents, classes, lists.select("id").distinct()), "sets")
    links = written(verified(likely_pairs(stars, classes, per_cent), sets, per_cent), "links")
    labels = components(links)
    # a list in one group is done; the members of the others are compared across groups
    grouped = lists.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    spans = grouped.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    open_lists = written(spans.filter("low < high").select("value", "size"), "open-lists")
    undecided = split_by_frequency(grouped, open_lists, ["value"], "size").select("id", "head")
    crossing = written(cross_pairs(undecided, classes, sets, labels, per_cent), "crossing")
    if not crossing.isEmpty():
        labels = components(links.unionByName(written(verified(crossing, sets, per_cent), "more-links")))
    named = classes.join(labels, "id", "left").select("set_key", "copies", "first_doc", F.coalesce("label", "id").alias("label"))
    lowest = named.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    members = written(named.join(lowest, "label").select("set_key", "copies", "component_id"), "members")
    filled = split_by_frequency(sketches.filter("n_shingles > 0").drop("sketch"), members, ["set_key"], "copies")
    empty = sketches.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "row_key"]
    result = filled.select(*columns).unionByName(empty.select(*columns))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(documents: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """The kept document of each group, all columns as they are; rows equal in doc_id and text are one document."""
    key = "_kept_key"
    while key in {c.lower() for c in documents.columns}:
        key += "_"
    kept = near_duplicates(documents, per_cent).filter("kept").select(F.col("row_key").alias(key)).distinct()
    marked = documents.withColumn(key, F.xxhash64("doc_id", "text"))
    return marked.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
