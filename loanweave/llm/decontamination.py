"""Benchmark decontamination by pigeonhole edit matching.

An item that occurs in a text with at most k edits, cut into k + 1 pieces, has one piece unharmed. All pieces of all
items are searched at once (Aho-Corasick). A hit is verified with Myers' bit-parallel edit distance on growing parts of
the item: j neighbouring pieces with at most j - 1 edits. Where both halves of a part exceed their budgets the part does
too, so an occurrence passes from one of its pieces up to the whole item, while chance hits of short pieces mostly end
at two pieces. Texts and items are compared in lower case with white space as single spaces.

The error budget of an item is ``ERROR_RATE`` of its length, rounded down, whatever the length of its pieces. An item of fewer than ``WHOLE_BELOW`` characters would be found by chance; it matches only texts that equal
it as a whole. Null and empty texts and items match nothing; equal items each match; repeated rows are reported alike;
columns other than doc_id, text, item_id are left out. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.1
WHOLE_BELOW = 20
#: Characters of items that are searched at once; a larger benchmark takes more passes over the documents.
BLOCK_CHARS = 1_000_000


def normalized(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(rate * len(item))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors + 1`` pieces of nearly equal length."""
    ends = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


class Myers:
    """Edit distance of a pattern to the best-fitting stretch of a text, one machine-word-like step per character."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.full = (1 << self.size) - 1
        self.top = 1 << (self.size - 1)
        self.at: dict[str, int] = {}
        for k, c in enumerate(pattern):
            self.at[c] = self.at.get(c, 0) | 1 << k

    def ends(self, text: str) -> Iterator[tuple[int, int]]:
        """(end, distance) after each character: the distance to the best stretch that ends there."""
        plus, minus, score, full, top, get = self.full, 0, self.size, self.full, self.top, self.at.get
        for end, c in enumerate(text, 1):
            equal = get(c, 0)
            down = equal | minus
            across = (((equal & plus) + plus) ^ plus) | equal
            rise = minus | (full & ~(across | plus))
            fall = plus & across
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            rise = rise << 1 & full
            fall = fall << 1 & full
            plus = fall | (full & ~(down | rise))
            minus = rise & down
            yield end, score


@lru_cache(maxsize=4096)
def _matcher(pattern: str) -> Myers:
    return Myers(pattern)


@lru_cache(maxsize=4096)
def parts(errors: int, piece: int) -> list[tuple[int, int]]:
    """Piece numbers [a, b) of the growing parts around a piece, from two pieces up to all of ``errors + 1``."""
    a, b, found = 0, errors + 1, []
    while b - a > 1:
        found.append((a, b))
        middle = (a + b) // 2
        a, b = (a, middle) if piece < middle else (middle, b)
    return found[::-1]


def holds(item: str, errors: int, piece: int, text: str, start: int) -> bool:
    """Whether all parts around a piece occur within their budgets, if the piece lies where ``start`` is the item's."""
    for a, b in parts(errors, piece):
        first, last = len(item) * a // (errors + 1), len(item) * b // (errors + 1)
        spare = b - a - 1
        around = text[max(0, start + first - spare) : max(0, start + last + spare)]
        if not any(distance <= spare for _, distance in _matcher(item[first:last]).ends(around)):
            return False
    return True


def best_match(item: str, text: str, errors: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best stretch of ``text`` within the budget, the first of equally good ones."""
    exact = text.find(item)
    if exact >= 0:
        return 0, exact, exact + len(item)
    end, distance = min(Myers(item).ends(text), key=lambda found: (found[1], found[0]), default=(0, len(item)))
    if distance > errors:
        return None
    # backwards from the end, the reversed item reaches the same distance where the stretch starts
    back = text[:end][::-1]
    length = next(e for e, d in Myers(item[::-1]).ends(back) if d == distance)
    return distance, end - length, end


@dataclass
class Items:
    """A block of items with the automaton of their pieces."""

    ids: list
    texts: list[str]
    rate: float

    def __post_init__(self):
        import ahocorasick

        self.errors = [budget(t, self.rate) for t in self.texts]
        self.whole: dict[str, list[int]] = {}
        owners: dict[str, list[tuple[int, int, int]]] = {}
        for k, text in enumerate(self.texts):
            if len(text) < WHOLE_BELOW:
                self.whole.setdefault(text, []).append(k)
                continue
            for number, (offset, piece) in enumerate(pieces(text, self.errors[k])):
                owners.setdefault(piece, []).append((k, number, offset))
        self.automaton = ahocorasick.Automaton() if owners else None
        for piece, owned in owners.items():
            self.automaton.add_word(piece, (len(piece), owned))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end), the best match of every item found in a normalized text."""
        found = [(k, 0, 0, len(text)) for k in self.whole.get(text, ())]
        places: dict[int, list[int]] = {}
        for end, (size, owned) in self.automaton.iter(text) if self.automaton else ():
            for k, number, offset in owned:
                start, known = end + 1 - size - offset, places.get(k)
                # next to a place that is already one, this hit is no more than a wider stretch
                if known and abs(start - known[-1]) <= self.errors[k] or holds(self.texts[k], self.errors[k], number, text, start):
                    places.setdefault(k, []).append(start)
        for k, starts in sorted(places.items()):
            item, errors, best = self.texts[k], self.errors[k], None
            for low, high in self._stretches(sorted(starts), len(item), errors):
                match = best_match(item, text[max(0, low) : high], errors)
                if match and (best is None or match[0] < best[0]):
                    best = match[0], match[1] + max(0, low), match[2] + max(0, low)
            if best:
                found.append((k, *best))
        return found

    @staticmethod
    def _stretches(starts: list[int], size: int, errors: int) -> Iterator[tuple[int, int]]:
        """Stretches around supposed starts, overlapping ones joined."""
        low, high = starts[0] - errors, starts[0] + size + errors
        for start in starts[1:]:
            if start - errors > high:
                yield low, high
                low = start - errors
            high = start + size + errors
        yield low, high


def original_places(text: str, start: int, end: int) -> tuple[int, int]:
    """Places in ``text`` of the stretch [start, end) of its normalized form, to whole characters."""
    at, first, last = 0, None, 0
    for word in re.finditer(r"\S+", text):
        size = len(word[0].lower())
        if first is None and start < at + size + 1:
            first = word.start() + min(max(0, start - at), len(word[0]))
        if end > at:
            last = word.start() + min(end - at, len(word[0]))
        at += size + 1
        if at >= end:
            break
    return first or 0, last


_BUILT: dict[str, Items] = {}


def _built(key: str, shared, rate: float) -> Items:
    """The automaton of a broadcast block, built once per Python worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Items(*shared.value, rate)
    return _BUILT[key]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[str, object]]:
    """(key, broadcast ids and normalized texts) of each block: about ``block_chars`` characters, whatever the benchmark's size."""
    spark = benchmark.sparkSession
    items = benchmark.filter(F.length("text") > 0).select(F.col("item_id").cast("string"), "text").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    for block in range(count):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        pairs = sorted(((r["item_id"], normalized(r["text"])) for r in own), key=repr)
        pairs = [p for p in pairs if p[1]]
        yield uuid.uuid4().hex, spark.sparkContext.broadcast(([p[0] for p in pairs], [p[1] for p in pairs]))


def contaminated(documents: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, start and end (characters of the text as it is) of each item found in each document."""
    texts = documents.select(F.col("doc_id").cast("string"), "text")
    found = None
    for key, shared in _blocks(benchmark, block_chars):

        def search(batches: Iterator[pd.DataFrame], key=key, shared=shared) -> Iterator[pd.DataFrame]:
            items = _built(key, shared, rate)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    for k, distance, start, end in items.find(normalized(text)) if text else ():
                        rows.append((doc_id, items.ids[k], distance, *original_places(text, start, end)))
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "start", "end"])

        part = texts.mapInPandas(search, "doc_id string, item_id string, distance int, start int, end int")
        found = part if found is None else found.unionByName(part)
    return found.withColumns(
        {"doc_id": F.col("doc_id").cast(documents.schema["doc_id"].dataType), "item_id": F.col("item_id").cast(benchmark.schema["item_id"].dataType)}
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which no item is found, all columns as they are; no shuffle."""
    for key, shared in _blocks(benchmark, block_chars):

        def keep(batches: Iterator[pa.RecordBatch], key=key, shared=shared) -> Iterator[pa.RecordBatch]:
            items = _built(key, shared, rate)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                yield batch.filter(pa.array([not (text and items.find(normalized(text))) for text in texts], pa.bool_()))

        documents = documents.mapInArrow(keep, documents.schema)
    return documents
