"""Toxicity by cumulative-link ordinal regression on severity grades.

Grades come from ``labels``: 0 not toxic, 1 toxic in otherwise good text, 2 toxic in poor text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.ordinal import CumulativeLink, fit_rated, graded

#: Most rated texts that the fit takes; fewer labels are all taken.
SAMPLE = 6000


def severity(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("toxic") == 0, 0).when(F.coalesce("quality", F.lit(0)) == 1, 1).otherwise(2)
    return labels.where("toxic IS NOT NULL").select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> CumulativeLink | None:
    """None if the rated documents aren't of two grades."""
    return fit_rated(docs, severity(labels), most)


def toxicity(docs: DataFrame, labels: DataFrame, limit: float = 0.5, most: int = SAMPLE) -> DataFrame:
    """A row for each row of docs: doc_id, expected_severity, p_toxic (grade 1 or more), p_severe (the top
    grade), rejected (p_toxic >= limit). Null and empty texts get the model's base rates, by which they
    aren't rejected as long as most labels are clean; without labels of two grades nothing is."""
    model = train(docs, labels, most)
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("expected_severity"), F.lit(0.0).alias("p_toxic"), F.lit(0.0).alias("p_severe"), F.lit(False).alias("rejected"))
    scored = docs.select("doc_id", graded(model, F.col("text")).alias("s"))
    first = F.col("s.tails")[0]
    return scored.select("doc_id", F.col("s.expected").alias("expected_severity"), first.alias("p_toxic"), F.element_at("s.tails", -1).alias("p_severe"), (first >= limit).alias("rejected"))


def accepted(docs: DataFrame, labels: DataFrame, limit: float = 0.5, most: int = SAMPLE) -> DataFrame:
    """docs without the rejected ones; all columns stay."""
    model = train(docs, labels, most)
    return docs if model is None else docs.where(graded(model, F.col("text"))["tails"][0] < limit)
