"""Apply a fitted plan to a stream.

Once fitted, every step but duplicate handling is a projection or a filter of single
rows, so a plan that keeps duplicates needs no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.plan import FittedPlan


def transform_stream(fitted: FittedPlan, stream: DataFrame) -> DataFrame:
    if not stream.isStreaming:
        raise ValueError("not a streaming table; use FittedPlan.transform")
    if fitted.plan.duplicates != "keep":
        raise ValueError("duplicate handling compares all rows, so it cannot run on a stream")
    return fitted.transform(stream)
