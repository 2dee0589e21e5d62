"""Registered queries over the driver tables, each next to its DuckDB twin."""

from importlib import import_module

MODULES = ("columns", "tables", "statistics", "scoring", "samples", "layers", "raw_files", "model_parts", "models")


def load_all() -> None:
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"workloads.{module}")
