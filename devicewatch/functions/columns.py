"""Scalar expressions: dates, flags, JSON text, rates, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from devicewatch.params import LOWEST_TIER, NO_OUTCOME, OUTCOME_LABELS, RISK_TIERS


def report_date(text: Column | str) -> Column:
    """``yyyyMMdd`` text as a date; anything else is NULL."""
    return F.try_to_date(text, "yyyyMMdd")


def is_yes(flag: Column | str) -> Column:
    """True for exactly ``Y``; NULL stays NULL."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return column == "Y"


def json_list(text: Column) -> Column:
    """JSON text, ``[]`` where the field is missing or null. The text is kept as it came."""
    return F.coalesce(text, F.lit("[]"))


def variant_json(value: Column) -> Column:
    """A variant as JSON text in one spelling, so equal values are equal group keys.

    NULL where the value is missing or a JSON null.
    """
    return F.when(~F.is_variant_null(value), F.to_json(value))


def percentage(part: Column | str, whole: Column | str) -> Column:
    """Rate in percent to one decimal; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * 100, 1)


def risk_tier(rate: Column | str, tiers: Sequence[tuple[str, float]] = RISK_TIERS,
              lowest: str = LOWEST_TIER) -> Column:
    """Tier of a (rounded) rate. A NULL rate is in the lowest tier."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return F.coalesce(*[F.when(rate >= floor, F.lit(name)) for name, floor in tiers],
                      F.lit(lowest))


def outcome_label(code: Column | str, labels: Mapping[str, str] = OUTCOME_LABELS,
                  other: str = NO_OUTCOME) -> Column:
    """Readable outcome; unknown and missing codes share one label."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(*[F.when(code == key, F.lit(label)) for key, label in labels.items()],
                      F.lit(other))
