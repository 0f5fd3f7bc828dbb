"""Categories, flags and small arithmetic on metric columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cut points and labels of the daily relations.
STRESS_CUTS = ((25, "RESTING", 1), (50, "LOW", 2), (75, "MEDIUM", 3))
STRESS_TOP = ("HIGH", 4)
RECOVERY_CUTS = ((20, "Great Recovery"), (0, "Good Recovery"), (-20, "Slight Drain"))
RECOVERY_BOTTOM = "Heavy Drain"
ACTIVITY_CUTS = ((5000, "Sedentary"), (7500, "Low Active"), (10000, "Moderate"))
ACTIVITY_TOP = "Active"
ACTIVITY_NONE = "No Data"
LOW_STEPS = 1000
HIGH_STRESS = 50
SHORT_NIGHT_HOURS = 6


def _ladder(tests, default) -> Column:
    chain = F
    for condition, label in tests:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(default)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, the same whatever order the rows were added up in.

    Sums of doubles differ in their last bits with the order of rows, which would flip exact ties from
    run to run; rounding to nine digits first removes that noise.
    """
    return F.round(F.round(value.cast("double"), 9), digits)


def to_number(text: Column, kind: str = "bigint", strict: bool = False) -> Column:
    return text.cast(kind) if strict else text.try_cast(kind)


def seconds_to_hours(seconds: Column) -> Column:
    return seconds.cast("double") / F.lit(3600.0)


def zero_to_null(total: Column) -> Column:
    return F.nullif(total, F.lit(0).cast("bigint"))


def steps_quality(total: Column) -> Column:
    """A NULL total passes both tests and ends as OK."""
    return _ladder([(total == 0, "NO_DATA"), (total < LOW_STEPS, "LOW")], F.lit("OK"))


def stress_category(level: Column) -> Column:
    """NULL ends in the top category."""
    return _ladder([(level <= cut, name) for cut, name, _ in STRESS_CUTS], F.lit(STRESS_TOP[0]))


def stress_level_number(level: Column) -> Column:
    tests = [(level <= cut, number) for cut, _, number in STRESS_CUTS]
    return _ladder(tests, F.lit(STRESS_TOP[1])).cast("bigint")


def recovery_status(net: Column) -> Column:
    """NULL ends as the heaviest drain."""
    return _ladder([(net > cut, name) for cut, name in RECOVERY_CUTS], F.lit(RECOVERY_BOTTOM))


def activity_level(steps: Column) -> Column:
    tests = [(steps.isNull(), ACTIVITY_NONE)] + [(steps < cut, name) for cut, name in ACTIVITY_CUTS]
    return _ladder(tests, F.lit(ACTIVITY_TOP))


def high_stress_label(level: Column) -> Column:
    return (level > HIGH_STRESS).cast("int")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return half_up(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def direction(correlation: Column) -> Column:
    """Zero and undefined correlations read as "decreases"."""
    return F.when(correlation > 0, F.lit("increases")).otherwise(F.lit("decreases"))


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def linear_logit(weights: dict[str, float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return total


def odds_ratio(coefficient: Column) -> Column:
    return F.exp(coefficient)
