"""Quality by ordinal cumulative-link regression on graded ratings.

The ratings come from the two labels: 0 poor and toxic, 1 poor, 2 good but toxic, 3 good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.ordinal import fit_rated, graded

#: Most rated texts that the fit takes.
SAMPLE = 6000


def ratings(labels: DataFrame) -> DataFrame:
    return labels.where("quality IS NOT NULL").select("doc_id", (2 * F.col("quality") + F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("grade"))


def quality(docs: DataFrame, labels: DataFrame, good: int = 2, limit: float = 0.5, most: int = SAMPLE) -> DataFrame:
    """A row for each row of docs: doc_id, expected_grade, p_good (grade ``good`` or more), p_best (the top
    grade), selected (p_good >= limit). Null and empty texts get the model's base rates; without ratings of
    two grades the three numbers are null and nothing is selected."""
    model = fit_rated(docs, ratings(labels), most)
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.select("doc_id", nothing.alias("expected_grade"), nothing.alias("p_good"), nothing.alias("p_best"), F.lit(False).alias("selected"))
    scored = docs.select("doc_id", graded(model, F.col("text")).alias("s"))
    tail = F.col("s.tails")[min(good, len(model.thresholds)) - 1]
    return scored.select("doc_id", F.col("s.expected").alias("expected_grade"), tail.alias("p_good"), F.element_at("s.tails", -1).alias("p_best"), (tail >= limit).alias("selected"))
