"""Entries in parts, and the vectors they need sent once to every part.

A part holds whole targets (or slices of very large ones) with the places of their entries in the part's own list of
vectors. The routing table says which vectors a part lists, so a pass over the entries ships each vector once per part
that uses it, in the type it is stored in, and never once per entry.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vec
from ..session import cut_lineage, discard, ensure_checkpoint_dir, shuffles_dropped, task_slots

PART_ENTRIES = 500_000
#: What is sent to parts at a time: bytes of vectors and runs, and entries while parts are laid out. Shuffles are dropped after each round.
ROUND_BYTES, ROUND_ENTRIES = 2 << 30, 64_000_000
_WRITTEN = (
    "role string, part int, kind int, target long, salt int, parts int, mask int, slots binary, c binary, p binary, slot int, bit int, other long"
)


@dataclass
class Parts:
    """``runs`` (part, kind, target, salt, parts, mask, slots, c, p), one row per target and part, and ``routes`` (part, slot, bit, other)."""

    runs: DataFrame
    routes: DataFrame
    split_targets: bool
    path: str
    count: int = 1
    entries: int = 0

    def routed(self, vectors: DataFrame) -> DataFrame:
        """``part, slot, bit, features`` of ``vectors(bit, other, features)``; those a part lacks stand for zeros."""
        return self.routes.join(vectors, ["bit", "other"]).select("part", "slot", "bit", "features")

    def rounds(self, width: int) -> list[Parts]:
        """Ranges of parts whose runs and vectors of ``width`` singles together stay under ``ROUND_BYTES``, if one part does."""
        sent = self.routes.count() * (4 * width + 40) + self.entries * 13
        number = min(self.count, max(1, math.ceil(sent / ROUND_BYTES)))
        if number == 1:
            return [self]
        edges = [self.count * at // number for at in range(number + 1)]
        own = lambda frame, low, high: frame.filter((F.col("part") >= low) & (F.col("part") < high))
        return [replace(self, runs=own(self.runs, low, high), routes=own(self.routes, low, high)) for low, high in zip(edges, edges[1:])]

    def each(self, send: Callable[[Parts], DataFrame], kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str, width: int) -> DataFrame:
        """``kernel`` over the runs of every part and what ``send`` makes for it, a round of parts at a time."""
        found, rounds = None, self.rounds(width)
        for own in rounds:
            sent = send(own).withColumnRenamed("part", "to_part")
            done = own.runs.groupBy("part").cogroup(sent.groupBy("to_part")).applyInArrow(kernel, schema)
            done = done if len(rounds) == 1 else cut_lineage(done)
            found = done if found is None else found.unionByName(done)
        return found

    def discard(self) -> None:
        """Delete the files once no frame that reads them is needed."""
        discard(self.runs.sparkSession, self.path)


def _salted(entries: DataFrame, keys: list[str], others: list[str], part_entries: int) -> tuple[DataFrame, int, int, int]:
    """Entries with ``parts`` slices of their target and ``salt``, the entry's own; the number of entries, of the largest target, and of parts."""
    sizes = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n"), F.max("_n")).first()
    count, largest = total[0] or 0, total[1] or 0
    rows = entries.withColumn("parts", F.lit(1)).withColumn("salt", F.lit(0))
    if largest > part_entries:
        heavy = sizes.filter(F.col("_n") > part_entries).select(*keys, F.ceil(F.col("_n") / part_entries).cast("int").alias("parts"))
        rows = entries.join(heavy, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64(*others), F.col("parts")).cast("int"))
    parts = max(task_slots(entries.sparkSession), math.ceil(count / part_entries))
    return rows.withColumn("part", F.pmod(F.xxhash64(*keys, "salt"), F.lit(parts)).cast("int")), count, largest, parts


def _block(table: pa.Table) -> pa.Table:
    """Runs and routes of one part."""
    code, target, other, c = (table.column(name).to_numpy() for name in ("code", "target", "other", "c"))
    number, kind, bit, p = int(code[0] >> 32), (code >> 16 & 0xFFFF) - 1, code >> 8 & 0xFF, code & 0xFF
    whole = np.zeros(len(code), np.int32), np.ones(len(code), np.int32)
    salt, parts = (table.column(name).to_numpy() for name in ("salt", "parts")) if "salt" in table.column_names else whole
    by_other = np.lexsort((other, bit))
    first = np.append(True, (np.diff(other[by_other]) != 0) | (np.diff(bit[by_other]) != 0))
    listed = np.stack([bit[by_other][first].astype(np.int64), other[by_other][first]])
    slot = np.empty(len(other), np.int32)
    slot[by_other] = np.cumsum(first) - 1
    order = np.lexsort((salt, target, kind))
    kind, target, salt, parts, bit, c, p = (x[order] for x in (kind, target, salt, parts, bit, c, p))
    slot = slot[order]
    change = (np.diff(kind) != 0) | (np.diff(target) != 0) | (np.diff(salt) != 0)
    starts = np.concatenate([[0], np.flatnonzero(change) + 1])
    ends = np.append(starts, len(kind))

    def packed(values: np.ndarray) -> pa.Array:
        places = pa.py_buffer((ends * values.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, places, pa.py_buffer(np.ascontiguousarray(values))])

    runs, routes = len(starts), listed.shape[1]
    none = lambda kind, n: pa.nulls(n, kind)
    column = lambda values, kind, empty: pa.concat_arrays([pa.array(values, kind) if isinstance(values, np.ndarray) else values, none(kind, empty)])
    lead = lambda values, kind: column(values, kind, routes)
    tail = lambda values, kind: pa.concat_arrays([none(kind, runs), pa.array(values, kind)])
    return pa.table(
        {
            "role": pa.array(["run"] * runs + ["route"] * routes),
            "part": pa.array(np.full(runs + routes, number, np.int32)),
            "kind": lead(kind[starts], pa.int32()),
            "target": lead(target[starts], pa.int64()),
            "salt": lead(salt[starts], pa.int32()),
            "parts": lead(parts[starts], pa.int32()),
            "mask": lead(np.bitwise_or.reduceat(1 << bit.astype(np.int32), starts), pa.int32()),
            "slots": lead(packed(slot), pa.binary()),
            "c": lead(packed(c), pa.binary()),
            "p": lead(packed(p.astype(np.int8)), pa.binary()),
            "slot": tail(np.arange(routes, dtype=np.int32), pa.int32()),
            "bit": tail(listed[0].astype(np.int32), pa.int32()),
            "other": tail(listed[1], pa.int64()),
        }
    )


def lay_out(entries: DataFrame, part_entries: int = PART_ENTRIES) -> Parts:
    """``entries(kind, target, bit, other, c, p)`` in parts of about ``part_entries``, written once; ``bit`` is under 31, ``p`` 0 or 1."""
    spark = entries.sparkSession
    rows, count, largest, parts = _salted(entries, ["kind", "target"], ["other", "bit"], part_entries)
    path = f"{ensure_checkpoint_dir(spark)}/parts-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield from _block(pa.Table.from_batches(held).combine_chunks()).to_batches()

    # few columns: Arrow batches are measured column by column after each row
    code = F.shiftleft(F.col("part").cast("long"), 32) + F.shiftleft(F.col("kind") + 1, 16) + F.shiftleft("bit", 8) + F.col("p").cast("int")
    split = largest > part_entries
    needed = [code.alias("code"), "target", "other", "c"] + (["salt", "parts"] if split else [])
    # every part is a partition of its own, so nothing has to be sorted to find it
    number = min(parts, max(1, math.ceil(count / ROUND_ENTRIES)))
    edges = [parts * at // number for at in range(number + 1)]
    for low, high in zip(edges, edges[1:]):
        some = rows if number == 1 else rows.filter((F.col("part") >= low) & (F.col("part") < high))
        with shuffles_dropped(spark):
            dealt = some.repartitionById(high - low, F.col("part") - low).select(*needed)
            dealt.mapInArrow(run, _WRITTEN).write.mode("append").partitionBy("role").parquet(path)
    stored = spark.read.schema(_WRITTEN).parquet(path)
    runs = stored.filter(F.col("role") == "run").select("part", "kind", "target", "salt", "parts", "mask", "slots", "c", "p")
    routes = stored.filter(F.col("role") == "route").select("part", "slot", "bit", "other")
    return Parts(runs, routes, split, path, parts, count)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of ``width`` as rows, in double precision."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def listed_vectors(routed: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and bits of a part by slot."""
    slot = routed.column("slot").to_numpy()
    size = int(slot.max()) + 1 if len(slot) else 1
    rows, bits = np.zeros((size, width)), np.zeros(size, np.int64)
    rows[slot], bits[slot] = matrix(routed.column("features"), width), routed.column("bit").to_numpy()
    return rows, bits


def run_arrays(row_slots: bytes, row_c: bytes, row_p: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, confidences and preferences of a run."""
    return np.frombuffer(row_slots, np.int32), np.frombuffer(row_c), np.frombuffer(row_p, np.int8)


def lists(rows: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def weighted_sums(entries: DataFrame, vectors: DataFrame, dim: int, part_entries: int = PART_ENTRIES) -> DataFrame:
    """``target, total``: the sum of ``weight`` times the vector of ``other`` over ``entries(target, other, weight)``.

    ``vectors`` has ``other`` and ``features`` of length ``dim``; entries without a vector add nothing, and a target
    with none is left out; so do vectors of zeros. Targets above ``part_entries`` are summed in slices.
    """
    # a vector of zeros takes as much room on its way as any other
    vectors = vectors.filter(F.coalesce(F.exists("features", lambda x: x != 0), F.lit(True)))
    rows, *_ = _salted(entries, ["target"], ["other"], part_entries)
    wanted = rows.select(F.col("part").alias("to_part"), F.col("other").alias("listed")).distinct()
    sent = wanted.join(vectors.select(F.col("other").alias("listed"), "features"), "listed").select("to_part", "listed", "features")

    def add_up(own: pa.Table, given: pa.Table) -> pa.Table:
        if not len(own) or not len(given):
            return pa.table({"target": pa.nulls(0, pa.int64()), "total": pa.nulls(0, pa.list_(pa.float64()))})
        ids = given.column("listed").to_numpy()
        order = np.argsort(ids)
        ids, features = ids[order], matrix(given.column("features"), dim)[order]
        at = np.minimum(np.searchsorted(ids, own.column("other").to_numpy()), len(ids) - 1)
        met = ids[at] == own.column("other").to_numpy()
        target, weight, at = own.column("target").to_numpy()[met], own.column("weight").to_numpy()[met], at[met]
        order = np.argsort(target, kind="stable")
        target, weight, at = target[order], weight[order], at[order]
        names, starts = np.unique(target, return_index=True)
        ends = np.append(starts[1:], len(target))
        totals = np.zeros((len(names), dim))
        for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            totals[k] = weight[a:b] @ features[at[a:b]]
        return pa.table({"target": pa.array(names), "total": lists(totals)})

    parts = rows.select("part", "target", "other", F.col("weight").cast("double").alias("weight"))
    found = parts.groupBy("part").cogroup(sent.groupBy("to_part")).applyInArrow(add_up, "target long, total array<double>")
    return found.groupBy("target").agg(vec.vector_sum(F.col("total")).alias("total"))
