"""Quality rules by isolation forest on rule statistics.

Fixed rules look at the length and at repeated three-word windows. What they pass is scored by an
isolation forest over ratios of the same statistics, and rejected above a threshold that is
calibrated on all labelled rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.isolation import IsolationForest, grow
from twinledger.llm.sampling import binary_labels, bounded_sample
from twinledger.llm.stats import COUNTS, FEATURES, features, rule_statistics
from twinledger.operators.balance import written

#: Ratios that the forest sees: those that rules look at, whatever the length or language of a text.
RULES = ("word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share",
         "pipes_per_word", "exclaims_per_word", "same_share", "capital_share", "short_share", "symbol_word_share")
#: Rows that the trees are drawn from.
FIT_ROWS = 25_600
SCORE_STEPS = 2_000
DEFAULT_CUT = 0.65


def rule_ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    return features(counts)[:, [FEATURES.index(r) for r in RULES]]


def base_failed(stats: str = "stats"):
    n = F.col(f"{stats}.n_words")
    return (n < 50) | (F.col(f"{stats}.n_repeat_words") * 100 > n * 50)


def fit_forest(table: DataFrame, id_col: str = "doc_id", stats: str = "stats", rows: int = FIT_ROWS,
               trees: int = 200, sample: int = 256) -> IsolationForest:
    """Forest over a bounded sample of documents that the fixed rules pass or not."""
    got = bounded_sample(table.select(id_col, stats), id_col, rows).select(f"{stats}.*").toPandas()
    return grow(rule_ratios({c: got[c].to_numpy() for c in COUNTS}), trees=trees, sample=sample)


def anomaly(forest: IsolationForest, stats: str = "stats"):
    """Anomaly score of a struct of rule statistics."""

    @F.arrow_udf("double")
    def scored(table: pa.Array) -> pa.Array:
        counts = dict(zip(COUNTS, (c.to_numpy(zero_copy_only=False) for c in table.flatten())))
        return pa.array(forest.scores(rule_ratios(counts)), pa.float64())

    return scored(F.struct(*[F.col(f"{stats}.{c}") for c in COUNTS]))


def calibrate(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
              min_kept: float = 0.997) -> float:
    """Threshold that rejects the most rows labelled 0 over those labelled 1, among thresholds that
    keep at least ``min_kept`` of the latter. Every labelled row that the fixed rules pass counts;
    only a histogram over SCORE_STEPS steps reaches the driver. Without both labels: DEFAULT_CUT."""
    step = F.least(F.floor(F.col("anomaly") * SCORE_STEPS), F.lit(SCORE_STEPS - 1)).cast("int")
    rows = (
        scored.where(~F.col("base_failed")).select(id_col, step.alias("step"))
        .join(binary_labels(labels, id_col, label), id_col)
        .groupBy("step", label).count().collect()
    )
    seen = np.zeros((2, SCORE_STEPS))
    for r in rows:
        seen[r[label], r["step"]] += r["count"]
    if not seen.sum(1).all():
        return DEFAULT_CUT
    kept, rejected = np.cumsum(seen[1]) / seen[1].sum(), 1 - np.cumsum(seen[0]) / seen[0].sum()
    # the cut lies above a step; among equal ones the highest, which rejects the least
    gain = np.where(kept >= min_kept, rejected + kept, -1)
    best = SCORE_STEPS - 1 - int(np.argmax(gain[::-1]))
    return (best + 1) / SCORE_STEPS


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label: str = "quality", keep: Sequence[str] = ()) -> DataFrame:
    """``id_col``, the columns in ``keep``, all rule statistics, ``base_failed``, ``anomaly``, ``kept``.

    One row for each row of ``docs``, repeated ones included. A null or empty text has counts of
    zero and fails the fixed rules. An empty table gives an empty result. The statistics are written
    once to the scratch folder, since forest, threshold and result read them.
    """
    table = written(docs.select(id_col, *keep, rule_statistics(text_col).alias("stats")), "rule-stats")
    forest = fit_forest(table, id_col)
    scored = table.select("*", base_failed().alias("base_failed"), anomaly(forest).alias("anomaly"))
    cut = calibrate(scored, labels, id_col, label)
    return scored.select(
        id_col, *keep, "stats.*", "base_failed", "anomaly",
        (~F.col("base_failed") & (F.col("anomaly") < cut)).alias("kept"),
    )
