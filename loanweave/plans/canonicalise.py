"""Rewrite the catalogue's authors and subjects to canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import subjects as sb
from ..operators.indexing import contiguous_index
from ..session import cut_lineage


def canonicalise(items: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """Items with flipped, undated authors and canonical ``Subjects``, plus ``Subjects_fine``.

    ``embeddings(subject, embedding)`` drives the attachment of rare tags; n-grams stand in without it.
    """
    named = items.withColumn("Author", tx.author_names(F.col("Author")))
    exploded = cut_lineage(sb.exploded_subjects(items))
    frequencies = sb.subject_frequencies(exploded)
    canonical = cut_lineage(sb.canonical_map(frequencies))
    singles = frequencies.filter("not frequent").select("subject")
    targets = canonical.select(F.col("canonical").alias("subject")).distinct()
    if embeddings is None:
        parents = sb.attach_by_ngrams(singles, targets)
    else:
        parents = sb.attach_by_embedding(
            contiguous_index(singles, ["subject"], "id").join(embeddings, "subject", "left"),
            contiguous_index(targets, ["subject"], "id").join(embeddings, "subject", "left"),
        )
    return sb.rebuild_subjects(named, exploded, sb.unified_map(canonical, parents))
