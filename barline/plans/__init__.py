"""Registered queries and their SQL."""

from __future__ import annotations

from barline.plans import events, extra, features, judged, judging, learned, more, panels, priced, resampled, rows, stores
from barline.plans.helpers import plain

MODULES = (features, panels, more, extra, rows, stores, events, judged, learned, resampled, priced, judging)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL = {name: q for m in MODULES for name, q in m.ORACLE_SQL.items()}

#: Columns of whole numbers or dates that may be null; numbers leave as doubles and dates as strings, so that readers without such types agree.
NULLABLE = {
    "c06_as_of_disclosures": {"holders": "double", "age": "double", "period": "string"},
    "c07_strict_as_of": {"holders": "double", "age": "double"},
    "c09_next_trading_day": {"next_day": "string"},
    "c15_lag_pointer": {"then": "string", "span": "double"},
    "d01_market_days": {"large": "double"},
    "d10_decile_cells": {"bin": "double"},
    "d11_grouping_sets": {"year": "double"},
    "h01_label_up": {"y": "double", "first": "double"},
    "h04_label_buyable": {"y_open": "double"},
    "h05_path_risk": {"y_safe": "double"},
    "h06_continuation": {"cont": "double"},
    "h08_grades": {"grade": "double"},
    "i02_base_launch_adjust_trigger": {"date": "string"},
}
for _name, _columns in NULLABLE.items():
    QUERIES[_name], ORACLE_SQL[_name] = plain(QUERIES[_name], ORACLE_SQL[_name], _columns)
