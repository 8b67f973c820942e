"""A pluggable model scorer with a constant to fall back on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORE_TYPE = "fraud_probability double, model_version string, model_latency_ms double, used_fallback boolean"
FALLBACK_VERSION = "fallback"

Scorer = Callable[[pd.DataFrame], pd.Series]


def score(
    df: DataFrame,
    features: list[str],
    load_scorer: Callable[[], Scorer],
    model_version: str,
    fallback_score: float = 0.0,
) -> DataFrame:
    """Adds the score columns; a batch the model fails on gets the fallback and is marked.

    `load_scorer` runs once per task. The scorer sees a pandas frame of the
    feature columns, one Arrow batch at a time.
    """

    @F.pandas_udf(SCORE_TYPE)
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        try:
            model = load_scorer()
        except Exception:
            model = None
        for batch in batches:
            start = time.perf_counter()
            failed = model is None
            values: object = fallback_score
            if not failed:
                try:
                    values = model(batch)
                except Exception:
                    failed = True
            spent = (time.perf_counter() - start) * 1000 / max(1, len(batch))
            yield pd.DataFrame(
                {
                    "fraud_probability": fallback_score if failed else values,
                    "model_version": FALLBACK_VERSION if failed else model_version,
                    "model_latency_ms": spent,
                    "used_fallback": failed,
                },
                index=batch.index,
            )

    return df.select("*", scored(F.struct(*features)).alias("_score")).select(*df.columns, "_score.*")
