"""Row-level features as column expressions; nothing here needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feature cut-offs and the ratio's guard against a zero score.
NIGHT_LAST_HOUR = 5
MORNING_LAST_HOUR = 11
AFTERNOON_LAST_HOUR = 17
HIGH_AMOUNT = 500
LOW_TRUST = 40
TRUST_EPSILON = 1e-6


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def _known(name: str) -> Column:
    # NaN compares greater than everything here; a missing amount must not raise a flag.
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def is_night(hour: str = "transaction_hour") -> Column:
    return flag(F.col(hour).between(0, NIGHT_LAST_HOUR))


def time_of_day(hour: str = "transaction_hour") -> Column:
    """Four parts of the day; anything that is not an hour of the first three is Evening."""
    h = F.col(hour)
    return (
        F.when(h.between(0, NIGHT_LAST_HOUR), "Night")
        .when(h.between(NIGHT_LAST_HOUR + 1, MORNING_LAST_HOUR), "Morning")
        .when(h.between(MORNING_LAST_HOUR + 1, AFTERNOON_LAST_HOUR), "Afternoon")
        .otherwise("Evening")
    )


def amount_to_trust() -> Column:
    return F.col("amount") / (F.col("device_trust_score") + F.lit(TRUST_EPSILON))


def amount_to_velocity() -> Column:
    return F.col("amount") / (F.col("velocity_last_24h") + F.lit(1))


def is_high_risk_location() -> Column:
    return flag((F.col("foreign_transaction") == 1) | (F.col("location_mismatch") == 1))


def location_anomaly_score() -> Column:
    return F.col("foreign_transaction") + F.col("location_mismatch")


def is_high_amount() -> Column:
    return flag(_known("amount") > HIGH_AMOUNT)


def is_low_trust() -> Column:
    return flag(_known("device_trust_score") < LOW_TRUST)


def engineered_columns() -> dict[str, Column]:
    """All derived columns, in table order, for one ``withColumns`` call."""
    return {
        "is_night_transaction": is_night(),
        "time_of_day_category": time_of_day(),
        "amount_to_trust_ratio": amount_to_trust(),
        "amount_velocity_ratio": amount_to_velocity(),
        "is_high_risk_location": is_high_risk_location(),
        "location_anomaly_score": location_anomaly_score(),
        "is_high_amount": is_high_amount(),
        "is_low_trust": is_low_trust(),
    }


def right_closed_bin(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval ``(edge, next edge]`` holding the value; null outside all of them."""
    binned = F.when(value <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        binned = binned.when(value <= upper, label)
    return binned
