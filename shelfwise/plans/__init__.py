"""Bindings of the operators to a data folder."""

from __future__ import annotations

import importlib

QUERY_MODULES = ("q_sources", "q_rows", "q_scalars", "q_aggregates", "q_models", "q_scenarios", "q_panel", "q_streams")


def all_queries():
    """The registry, filled by every query module."""
    for name in QUERY_MODULES:
        importlib.import_module(f"shelfwise.plans.{name}")
    return importlib.import_module("shelfwise.plans.registry")
