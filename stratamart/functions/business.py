"""The named business routines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import NUMERIC


def calculate_ltv(total_revenue: Column, order_count: Column, months_active: Column) -> Column:
    """Revenue scaled to twelve months; unchanged when there are no active months.

    ``order_count`` takes no part in the value; it is kept for the call signature.
    """
    yearly = (total_revenue.cast(T.DecimalType(26, 9)) * F.lit(12).cast(T.DecimalType(2, 0))
              / months_active.cast(T.DecimalType(9, 0)))
    return F.when(months_active > 0, F.round(yearly, 2).cast(NUMERIC)).otherwise(
        total_revenue.cast(NUMERIC))


def clean_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def format_currency(c: Column) -> Column:
    """Dollar text with thousands separators; rounded half up before formatting,
    because ``format_number`` alone rounds half to even."""
    return F.concat(F.lit("$"), F.format_number(F.round(c.cast(NUMERIC), 2), 2))


def calculate_sla_status(shipped_at: Column, delivered_at: Column, target_days: Column) -> Column:
    """A delivery without a shipping time counts as late: its difference is NULL."""
    days = F.timestamp_diff("DAY", shipped_at, delivered_at)
    return (F.when(delivered_at.isNull(), "Pending")
            .when(days <= target_days, "On Time")
            .otherwise("Late"))
