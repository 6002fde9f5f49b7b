"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from legwork.registry.base import ENTRIES

MODULES = [
    "cleaning", "history", "chain", "state", "calendar", "profiling", "shaping",
    "scoring", "graphs", "storage", "feature_rows", "modeling", "records", "streams",
]


def load() -> dict:
    for name in MODULES:
        import_module(f"legwork.registry.{name}")
    return ENTRIES
