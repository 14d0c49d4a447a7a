"""All queries of the workload and their SQL."""

from __future__ import annotations

from . import marks, regions, serving, slides, statistics, tiling

MODULES = (statistics, tiling, serving, slides, regions, marks)
QUERIES = {name: f for module in MODULES for name, f in module.Q.items()}
SQL = {name: text for module in MODULES for name, text in module.SQL.items()}
FLAGSHIP = QUERIES["anomaly_flag_counts"]
