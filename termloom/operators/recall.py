"""Recall risk of securities loans: labels, bands and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import add_business_days

#: Horizons in business days, thresholds of the bands, and the default reason.
HORIZONS = (1, 3, 5, 10)
BANDS = ((0.10, "LOW"), (0.25, "MODERATE"), (0.50, "HIGH"))
DEFAULT_REASON = "NO_DOMINANT_DRIVER_IDENTIFIED"


def label(predicted: Column, recalled: Column, horizon: int) -> Column:
    """1 where the recall falls after the prediction and by the horizon's end."""
    return F.when((recalled > predicted) & (recalled <= add_business_days(predicted, F.lit(horizon))), 1).otherwise(0)


def band(p: Column) -> Column:
    """The risk band of a probability; outside 0 to 1 none."""
    out = F.when((p < 0) | (p > 1) | F.isnan(p), None)
    for edge, name in BANDS:
        out = out.when(p < edge, name)
    return out.when(p <= 1, "CRITICAL")


def predictions(loans: DataFrame, probabilities: dict[int, Column], reasons: Column) -> DataFrame:
    """Loans with each horizon's probability, the band of the largest, three padded reasons, and ``error`` where one is missing or out of range."""
    if set(probabilities) != set(HORIZONS):
        raise ValueError(f"a prediction needs the horizons {HORIZONS}")
    named = {f"p_{h}": p for h, p in probabilities.items()}
    out = loans.withColumns(named)
    bad = F.lit(False)
    for n in named:
        bad = bad | F.col(n).isNull() | (F.col(n) < 0) | (F.col(n) > 1)
    top = F.greatest(*named)
    codes = F.slice(F.concat(reasons, F.array_repeat(F.lit(DEFAULT_REASON), 3)), 1, 3)
    return out.withColumns({"max_probability": top, "band": band(top), "reasons": F.array_join(codes, ","), "error": F.when(bad, "probability_out_of_range")})


def request_problems(requests: DataFrame) -> DataFrame:
    """``requests`` (loan_ids, horizons) with ``problem``: no loans, or horizons that aren't served; no horizons stand for all."""
    strange = F.array_except(F.coalesce("horizons", F.array(*[F.lit(h) for h in HORIZONS])), F.array(*[F.lit(h) for h in HORIZONS]))
    told = F.concat(F.lit("unsupported horizons: "), F.array_join(F.array_sort(strange), ","))
    return requests.withColumn("problem", F.when(F.coalesce(F.size("loan_ids"), F.lit(0)) <= 0, "no_loans").when(F.size(strange) > 0, told))
