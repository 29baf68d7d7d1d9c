"""Calendar and payday columns of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: str = "date") -> dict[str, Column]:
    """Parts of the date, and weekday (0 is Monday) and month as points on a circle."""
    columns = {
        "dayofweek": f"weekday({day})",
        "day": f"day({day})",
        "month": f"month({day})",
        "year": f"year({day})",
        "weekofyear": f"weekofyear({day})",
        "is_weekend": f"int(weekday({day}) >= 5)",
        "sin_dow": f"sin(2 * pi() * weekday({day}) / 7)",
        "cos_dow": f"cos(2 * pi() * weekday({day}) / 7)",
        "sin_month": f"sin(2 * pi() * month({day}) / 12)",
        "cos_month": f"cos(2 * pi() * month({day}) / 12)",
    }
    return {name: F.expr(sql) for name, sql in columns.items()}


def payday_columns(day: str = "date") -> dict[str, Column]:
    """Wages are paid on the 15th and on the last day of the month."""
    month_end = f"last_day({day})"
    return {
        "is_payday": F.expr(f"int(day({day}) = 15 OR {day} = {month_end})"),
        "days_to_payday": F.expr(
            f"if(day({day}) <= 15, 15 - day({day}), day({month_end}) - day({day}))"
        ),
    }


def on_month_day(day: str, month_days: tuple[tuple[int, int], ...]) -> Column:
    """True on any of the given (month, day) pairs."""
    hits = [f"(month({day}) = {m} AND day({day}) = {d})" for m, d in month_days]
    return F.expr(" OR ".join(hits) or "false")
