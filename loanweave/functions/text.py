"""Text cleaning as native column expressions.

Python's ``\\s``, ``\\d`` and ``strip`` know Unicode, Java's do not unless asked; every pattern here
switches that on and adds the four separator controls Python counts as white space.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Category labels the encoders and matrices must agree on.
UNKNOWN = "__UNKNOWN__"
RARE_AUTHOR = "__RARE_AUTHOR__"
RARE_PUBLISHER = "__RARE_PUBLISHER__"

# Fixed value: public cover service address pattern.
COVER_URL = "https://covers.openlibrary.org/b/isbn/%s-%s.jpg"
NO_COVER = "data:,no-cover"

_SPACE = r"[\s\x1c-\x1f]"


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+$", "")


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){_SPACE}+", " ")


def _missing(text: Column) -> Column:
    return text.isNull() | (text == "")


def normalize_text(text: Column) -> Column:
    return collapse_space(strip_space(F.coalesce(text, F.lit(""))))


def clean_title(title: Column) -> Column:
    return F.regexp_replace(normalize_text(title), rf"(?U){_SPACE}*/{_SPACE}*$", "")


def clean_publisher(publisher: Column) -> Column:
    return F.when(_missing(publisher), UNKNOWN).otherwise(normalize_text(publisher))


def author_label(author: Column) -> Column:
    """Catalogue author as one lower-case label, life dates at the end removed."""
    undated = F.regexp_replace(strip_space(author), rf"(?U),?{_SPACE}*\d{{4}}-?\d{{0,4}}\.?$", "")
    label = collapse_space(strip_space(F.lower(undated)))
    return F.when(_missing(author) | (label == ""), UNKNOWN).otherwise(label)


def author_names(author: Column) -> Column:
    """Several authors in one field, each as ``First Last``, first mention kept; null stays null."""

    def one_name(part: Column) -> Column:
        undated = F.regexp_replace(strip_space(part), rf"(?U),?{_SPACE}*\d{{4}}-?", "")
        surname = strip_space(F.regexp_extract(undated, r"(?s)^([^,]*),", 1))
        given = strip_space(F.regexp_extract(undated, r"(?s)^[^,]*,(.*)$", 1))
        flipped = F.when(undated.contains(","), F.concat(given, F.lit(" "), surname)).otherwise(undated)
        return strip_space(collapse_space(flipped))

    names = F.transform(F.split(author, "[;&]"), one_name)
    return F.array_join(F.array_distinct(F.filter(names, lambda name: name != "")), "; ")


def parse_subjects(subjects: Column) -> Column:
    """Semicolon list to lower-case tags; order and duplicates stay."""
    tags = F.transform(F.split(subjects, ";"), lambda tag: F.lower(strip_space(tag)))
    return F.coalesce(F.filter(tags, lambda tag: tag != ""), F.array().cast("array<string>"))


def has_any(items: Column) -> Column:
    return F.size(items) > 0


@F.pandas_udf(T.StringType())
def _without_marks(values: pd.Series) -> pd.Series:
    # Spark has no Unicode decomposition; repeated tags in a batch are decomposed once.
    codes, distinct = pd.factorize(values)
    plain = [
        text
        if text.isascii()
        else "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
        for text in distinct
    ]
    plain.append(None)
    return pd.Series([plain[code] for code in codes], dtype=object)


def normalize_subject(subject: Column) -> Column:
    """Accent-free lower-case tag without years or punctuation; null gives an empty string."""
    text = F.lower(_without_marks(F.coalesce(subject, F.lit(""))))
    text = F.regexp_replace(text, "--|/|,", " ")
    text = F.regexp_replace(text, r"(?U)\b\d{4}(-\d{4})?\b", "")
    text = F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]", "")
    return strip_space(collapse_space(text))


def isbn_list(field: Column) -> Column:
    """All ISBNs of a field, 13-digit ones first, each once."""
    codes = F.transform(
        F.split(F.coalesce(field, F.lit("")), ";"), lambda part: F.regexp_replace(F.upper(part), "[^0-9X]", "")
    )
    thirteen = F.filter(codes, lambda code: code.rlike("^[0-9]{13}$"))
    ten = F.filter(codes, lambda code: F.length(code) == 10)
    return F.array_distinct(F.concat(thirteen, ten))


def cover_candidates(field: Column, size: str, cached: Column | None = None, placeholder: str = NO_COVER) -> Column:
    """Cover addresses in the order to try them, the placeholder last."""
    found = F.transform(isbn_list(field), lambda code: F.format_string(COVER_URL, code, F.lit(size)))
    if cached is not None:
        found = F.concat(F.when(cached.isNull(), F.array().cast("array<string>")).otherwise(F.array(cached)), found)
    return F.concat(F.array_distinct(found), F.array(F.lit(placeholder)))


def escape_html(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def shorten(text: Column, width: int) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def subject_badges(subjects: Column, limit: int = 3) -> Column:
    """The first few tags of a field with markup removed, ready for display."""
    plain = strip_space(F.regexp_replace(F.coalesce(subjects, F.lit("")), "<[^>]+>", ""))
    badges = F.transform(F.slice(F.split(plain, ";"), 1, limit), lambda tag: escape_html(strip_space(tag)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(badges)


def char_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside word boundaries: each word padded with one space on both sides."""
    words = F.filter(F.split(text, rf"(?U){_SPACE}+"), lambda word: word != "")
    padded = F.transform(words, lambda word: F.concat(F.lit(" "), word, F.lit(" ")))
    empty = F.array().cast("array<string>")

    def of_width(word: Column, width: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(word) - width + 1)
        return F.when(F.length(word) >= width, F.transform(starts, lambda at: F.substring(word, at, width))).otherwise(
            empty
        )

    def of_word(word: Column) -> Column:
        return F.concat(*[of_width(word, width) for width in range(low, high + 1)])

    return F.flatten(F.transform(padded, of_word))
