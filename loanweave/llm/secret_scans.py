"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class over candidate strings.

A candidate is a run of key-like characters. Its class is read from the characters it holds, and the entropy of every
window of ``WINDOW`` characters follows from the previous window's counts: one character leaves, one enters. A
candidate whose highest window reaches the threshold of its class is a span, unless an allow-list pattern fits it;
segments that are sample values are left out before. Without a digit, a segment of mixed case that is no camel-case
name is judged, at a higher threshold; keys of letters in one case look like words and are not found.
Everything is SQL functions. A null or empty text has no spans; repeated rows are scanned alike; positions are code
points, ends exclusive. Texts and runs of any length are scanned whole, in time that grows with their length; spans that
start together go by kind. An empty table gives no rows. The new column's name is a parameter, for input that has one of
that name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base patterns, the order of kinds, and the least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

WINDOW = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Characters a class may hold and the entropy in bits that one window must reach; the first class that fits counts.
#: A run of digits only is a number and belongs to no class.
CLASSES = (
    ("letters", r"^[A-Za-z+/_=-]+$", 3.5),
    ("hex", r"^[0-9a-f]+$|^[0-9A-F]+$", 2.7),
    ("lower", r"^[a-z0-9_-]+$", 3.2),
    ("upper", r"^[A-Z0-9_-]+$", 3.2),
    ("mixed", r"^[A-Za-z0-9+/_=-]+$", 3.4),
)
#: Capitalized words of a name; one of two letters (In, To) stands before a longer one.
#: Repeated groups are possessive: Java walks these in a loop, any other with one stack frame per repetition.
_HUMPS = r"(?:[A-Z][a-z]{2,}|[A-Z][a-z](?=[A-Z][a-z]{2}))*+"
#: A segment of letters that is no name: both cases, and not a chain of capitalized words.
LETTERS = (
    rf"(?<![A-Za-z])(?![a-z]*{_HUMPS}[A-Z]{{0,4}}(?![A-Za-z]))(?=[A-Za-z]*[a-z])(?=[A-Za-z]*[A-Z])"
    r"[A-Za-z]{16,}(?![A-Za-z])"
)
#: Segments that hold a sample value; they are taken out of a candidate before it is judged.
SAMPLES = r"(?i)(?<![A-Za-z0-9])(?:[A-Za-z0-9]*(?:example|sample|placeholder|dummy|changeme|0123456789|abcdefgh)[A-Za-z0-9]*|x{4,})(?![A-Za-z0-9])"
#: A word fills its segment, so that no repetition ever has to be given back.
_WORD = rf"(?:[A-Z]+|[a-z]*{_HUMPS}[A-Z]{{0,4}}|[A-Z][a-z]*|[0-9]+)(?=[/_-]|$)"
_GROUPS = "|".join(rf"[A-Z0-9]{{{n}}}(?:-[A-Z0-9]{{{n}}}){{{least},}}+" for n, least in ((4, 3), (5, 2), (6, 2), (7, 2), (8, 1)))
#: Candidates that are no secrets: UUIDs, vendors' example keys, paths of plain words but not keys in equal groups.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"[A-Za-z0-9]EXAMPLE(?:KEY)?$",
    rf"^(?!(?=.*[A-Z])(?=.*[0-9])(?:{_GROUPS})$)/?{_WORD}(?:[/_-]{_WORD})++/?$",
)


#: Spans are gathered in lists of this length, which are joined at the end: adding one copies no longer list.
_LIST = 256
_SPAN = "struct<start:int,end:int,kind:int>"


def _gathered(items: Column, start: Column, spans) -> Column:
    """The spans that ``spans(state, item)`` gives as (next state, span or null) while the state goes through ``items``."""
    none = F.array().cast(f"array<{_SPAN}>")
    first = F.struct(start.alias("state"), none.alias("list"), F.array().cast(f"array<array<{_SPAN}>>").alias("lists"))

    def step(done, item):
        state, span = spans(done["state"], item)
        longer = F.concat(done["list"], F.array(span))
        closes = span.isNotNull() & (F.size(done["list"]) >= _LIST - 1)
        return F.struct(
            state.alias("state"),
            F.when(span.isNull(), done["list"]).when(closes, none).otherwise(longer).alias("list"),
            F.when(closes, F.concat(done["lists"], F.array(longer))).otherwise(done["lists"]).alias("lists"),
        )

    return F.aggregate(items, first, step, lambda done: F.flatten(F.concat(done["lists"], F.array(done["list"]))))


def _spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """Spans of the leftmost matches of ``pattern`` that ``keep`` accepts: what lies between matches gives their places."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(gaps.alias("gap"), found.alias("hit"))
    # judged once each, before places are added up; the last gap has no match after it
    judged = F.transform(both, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.when(x["hit"].isNull(), False).otherwise(keep(x["hit"])).alias("kept")))

    def place(at, x):
        begin = at + x["gap"]
        end = begin + x["hit"]
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"))
        return F.coalesce(end, at), F.when(x["kept"], span)

    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.rlike(text, F.lit(pattern)), _gathered(judged, F.lit(0), place)).otherwise(none)


def _window_bits(candidate: Column) -> Column:
    """Highest Shannon entropy of the candidate's windows, in bits, from counts kept up to date step by step."""
    codes = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda c: F.ascii(c))
    # every character leaves the window WINDOW places after it came
    leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), WINDOW), codes)
    pairs = F.transform(F.arrays_zip(leaving.alias("out"), codes.alias("into")), lambda x, i: F.struct(x["out"], x["into"], (i >= WINDOW - 1).alias("full")))
    event = lambda at, by, full: F.struct(at.alias("at"), F.lit(by).alias("by"), full.alias("full"))
    # the last characters never leave: leaving is the longer list
    events = F.flatten(
        F.transform(F.filter(pairs, lambda x: x["into"].isNotNull()), lambda x: F.array(event(x["out"], -1, F.lit(False)), event(x["into"], 1, x["full"])))
    )
    # c * log2(c) for counts 0..WINDOW, and the differences an entering or leaving character makes
    weigh = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 1))]
    gain = F.array(*(F.lit(weigh[c + 1] - weigh[c]) for c in range(WINDOW)))
    # one character a counter, 0 to 16 as the characters from "0" on: a string changes in one place without a new array
    zero = ord("0")
    first = F.struct(F.lit("0" * 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(state, x):
        now = F.ascii(F.substring(state["counts"], x["at"] + 1, 1)) - zero
        total = state["sum"] + F.when(x["by"] > 0, F.get(gain, now)).otherwise(-F.get(gain, now - 1))
        counts = F.overlay(state["counts"], F.char(now + x["by"] + zero), x["at"] + 1, 1)
        bits = F.when(x["full"], F.lit(math.log2(WINDOW)) - total / WINDOW).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(state["best"], bits).alias("best"))

    return F.aggregate(F.filter(events, lambda x: x["at"].isNotNull()), first, step, lambda state: state["best"])


def is_random(candidate: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """Whether a candidate's entropy reaches the threshold of its class and no allow-list pattern fits it."""
    rest = F.regexp_replace(candidate, F.lit(SAMPLES), F.lit(""))
    least = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        least = F.when(F.rlike(rest, F.lit(pattern)), F.lit(bits)).otherwise(least)
    plausible = F.rlike(rest, F.lit("[0-9]")) & F.rlike(rest, F.lit("[A-Za-z]")) | F.rlike(rest, F.lit(LETTERS))
    for pattern in allow:
        plausible &= ~F.rlike(candidate, F.lit(pattern)) & ~F.rlike(rest, F.lit(pattern))
    # CASE keeps the window walk to candidates that could be secrets
    return F.when(plausible, F.coalesce(_window_bits(rest) >= least, F.lit(False))).otherwise(F.lit(False))


def scan(documents: DataFrame, allow: tuple[str, ...] = ALLOW, into: str = "_spans") -> DataFrame:
    """All columns of ``documents`` plus ``into``: array of (start, kind index, end), by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [
        _spans(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE),
        _spans(text, ACCESS, "access", lambda m: F.length(m) >= ACCESS_LENGTH),
        # runs are maximal, so asking for the length in the pattern finds the same ones and passes over short runs
        _spans(text, HEX[:-1] + f"{{{HEX_LENGTH},}}", "hex", lambda m: F.lit(True)),
        _spans(text, CANDIDATE, "entropy", lambda m: is_random(m, allow)),
    ]
    by_place = F.transform(F.concat(*kinds), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return documents.withColumn(into, F.sort_array(by_place))


def count_of(kind: str) -> Column:
    return F.size(F.filter("_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def described(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(scanned: DataFrame, mark: str = "[SECRET]", spans: str = "_spans") -> DataFrame:
    """Replace every span of ``scan``'s texts by ``mark`` (overlapping spans together by one) and drop the column ``spans``.

    Spans are worked off in lists of ``_LIST``, each on its own part of the text, so a place is never sought from the
    beginning of a long text for every span.
    """
    text = F.col("text")
    ends = lambda part: F.coalesce(F.array_max(F.transform(part, lambda s: s["end"])), F.lit(0))

    def part(number):
        own = F.slice(spans, number * _LIST + 1, _LIST)
        begin = F.when(number == 0, 0).otherwise(ends(F.slice(spans, 1, F.greatest(number * _LIST, F.lit(1)))))
        end = F.greatest(begin, ends(own))
        return F.struct(own.alias("own"), begin.alias("begin"), F.substring(text, begin + 1, end - begin).alias("text"))

    def masked(x):
        first = F.struct(x["begin"].alias("at"), F.lit("").alias("out"))

        def step(done, s):
            gap = F.substring(x["text"], done["at"] - x["begin"] + 1, s["start"] - done["at"])
            out = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
            return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

        return F.aggregate(x["own"], first, step, lambda done: done["out"])

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _LIST).cast("int")), part)
    rest = F.substring(text, ends(F.col(spans)) + 1, F.length(text))
    clean = F.concat(F.array_join(F.transform(parts, masked), ""), rest)
    return scanned.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(text)).drop(spans)
