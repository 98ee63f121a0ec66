"""Queries over the input tables, one module per family."""

import importlib

FAMILIES = [
    "loading", "rows", "joins", "aggregates", "windows", "sets", "scalars",
    "streams", "statistics", "series", "risk", "learning", "texts", "web",
]


def load_all() -> None:
    for family in FAMILIES:
        importlib.import_module(f"tidemill.plans.{family}")
