"""Queries over the given tables, one per operator, each beside the SQL it must equal."""

import importlib

MODULES = ["marts", "hourly", "cleaning", "io", "quality"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"weatherloom.bindings.{name}")
