"""Schemas of the raw CSV files and the typed tables made from them."""

from __future__ import annotations

# Raw columns are read as they stand in the files; nothing is inferred.
_SALES = "id long, date date, store_nbr int, family string, sales double, onpromotion double"
RAW = {
    "train": _SALES,
    "test": _SALES.replace(" sales double,", ""),
    "stores": "store_nbr int, city string, state string, type string, cluster int",
    "oil": "date date, dcoilwtico double",
    "holidays_events": (
        "date date, type string, locale string, locale_name string, description string, transferred boolean"
    ),
    "transactions": "date date, store_nbr int, transactions int",
}

# Reports that a later job may read back.
BENCHMARK = (
    "model string, rmsle double, mae double, rmse double, wape_pct double, bias_pct double, n_scored long"
)
SUBMISSION = "id long, sales double"
