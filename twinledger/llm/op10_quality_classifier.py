"""Quality classifier: a generalised additive model with pairwise interactions over text statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.additive import AdditiveModel, train
from twinledger.llm.sampling import binary_labels, bounded_sample, fold
from twinledger.llm.stats import COUNTS, count_table, features, rule_statistics

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 20_000
HELD_OUT = 5
CUT = 0.3


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label: str = "quality", rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    Rows without label, id or known label value are passed over; null texts count as empty. Without
    any labelled row the model gives 0.5 to every text.
    """
    learn = binary_labels(labels, id_col, label).where(fold(id_col, HELD_OUT) != 0)
    chosen = bounded_sample(learn, id_col, rows)
    got = (
        docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # at most ``rows`` ids
        .select(id_col, label, rule_statistics(text_col).alias("stats"))
        .dropDuplicates([id_col]).select(label, "stats.*").toPandas()
    )
    x = features({c: got[c].to_numpy(np.int64) for c in COUNTS})
    return train(x, got[label].to_numpy(np.float64))


def score(text: str | Column, model: AdditiveModel) -> Column:
    """Probability of the label 1 for whole texts; null is scored as an empty text."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(features(count_table(texts))), pa.float64())

    return scored(text)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label: str = "quality", cut: float = CUT) -> DataFrame:
    """``id_col, held_out, score, predicted``, a row for each row of ``docs``. One pass without shuffle."""
    model = fit(docs, labels, id_col, text_col, label)
    return docs.select(
        id_col, (fold(id_col, HELD_OUT) == 0).alias("held_out"), score(text_col, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label: str = "quality", cut: float = CUT) -> DataFrame:
    """Rows of ``docs`` with a score of at least ``cut``, with all their columns."""
    return docs.where(score(text_col, fit(docs, labels, id_col, text_col, label)) >= cut)
