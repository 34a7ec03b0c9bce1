"""Column expressions. All are built-in Spark functions, none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier names, cut points and texts of the business rules.
PLAN_TIERS = ("starter", "professional", "enterprise")
RISK_TIERS = ("Critical", "High", "Moderate", "Low")
CRITICAL_FROM, HIGH_FROM, MODERATE_FROM = 0.75, 0.50, 0.25
ACTION_TIERS = ("Critical", "High")
URGENT_PRIORITIES = ("high", "critical")
CRITICAL_ENTERPRISE = "Executive escalation + QBR within 7 days"
CRITICAL_OTHER = "CSM intervention call within 48 hours"
HIGH_ENTERPRISE = "CSM check-in + usage review this week"
HIGH_OTHER = "Automated re-engagement sequence + CSM follow-up"


def numpy_round(value: Column, digits: int) -> Column:
    """Half-even rounding of the scaled double, the rule numpy and pandas use.

    ``F.round`` is half-up and ``F.bround`` rounds the decimal text; both differ
    from numpy where the scaled binary product lands on a tie.
    """
    number = value.cast("double")
    if digits == 0:
        return F.rint(number)
    scale = float(10**digits)
    return F.rint(number * scale) / scale


def ratio(top: Column, bottom: Column) -> Column:
    """Division in doubles; NULL where the denominator is 0 (ANSI mode would raise)."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean_of(value: Column) -> Column:
    """Mean as sum over count, NULLs skipped.

    For integer and DECIMAL columns the sum is exact, so the mean does not depend
    on the order in which tasks are merged.
    """
    return ratio(F.sum(value), F.count(value))


def clip_lower(value: Column, floor: int) -> Column:
    """Lower clip that keeps NULL (``greatest`` alone would turn NULL into the floor)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def is_one_of(value: Column, members: Sequence[str]) -> Column:
    """Set membership; NULL is no member."""
    return F.coalesce(value.isin(list(members)), F.lit(False))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def lookup(value: Column, table: dict) -> Column:
    """Scalar lookup; a value without an entry gives NULL."""
    expression = None
    for key, found in table.items():
        branch = value == F.lit(key)
        expression = (
            F.when(branch, F.lit(found)) if expression is None else expression.when(branch, F.lit(found))
        )
    return expression


def plan_tier_code(tier: Column) -> Column:
    return lookup(tier, {name: code for code, name in enumerate(PLAN_TIERS)})


def churn_label(churned: Column) -> Column:
    return lookup(churned, {0: "Active", 1: "Churned"})


def one_hot(value: Column, categories: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per category, in alphabetical order; NULL sets none, an unlisted value is an error."""
    unlisted = F.raise_error(F.concat(F.lit(f"{prefix} is not among the listed ones: "), value))
    listed = value.isNull() | value.isin(list(categories))
    return {
        f"{prefix}_{name}": F.when(listed, flag(value == F.lit(name))).otherwise(unlisted)
        for name in sorted(categories)
    }


def category_position(value: Column, order: Sequence[str]) -> Column:
    """0-based place of a category in a given order, NULL when it has none."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
    return F.when(place > 0, (place - 1).cast("int"))


def risk_tier(probability: Column) -> Column:
    return (
        F.when(probability >= CRITICAL_FROM, RISK_TIERS[0])
        .when(probability >= HIGH_FROM, RISK_TIERS[1])
        .when(probability >= MODERATE_FROM, RISK_TIERS[2])
        .otherwise(RISK_TIERS[3])
    )


def recommended_action(risk: Column, tier: Column) -> Column:
    """Text for the two tiers that are acted on."""
    enterprise = F.coalesce(tier == "enterprise", F.lit(False))
    return F.when(
        risk == "Critical",
        F.when(enterprise, CRITICAL_ENTERPRISE).otherwise(CRITICAL_OTHER),
    ).otherwise(F.when(enterprise, HIGH_ENTERPRISE).otherwise(HIGH_OTHER))


def expected_loss(probability: Column, arr: Column) -> Column:
    """Probability times yearly revenue, to the whole unit."""
    return numpy_round(probability.cast("double") * arr.cast("double"), 0)


def f1_of(precision: Column, recall: Column) -> Column:
    """Harmonic mean with the small guard against 0 / 0."""
    return 2 * (precision * recall) / (precision + recall + F.lit(1e-9))


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def millions(amount: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount / 1e6, digits), F.lit("M"))
