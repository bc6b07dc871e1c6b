"""Registered queries, one module per inventory group."""

from __future__ import annotations

import importlib

MODULES = ("metric_queries", "feature_queries", "relational_queries", "series_queries", "usage_eval_queries", "text_queries", "ingest_queries", "model_queries", "stream_queries")


def load_all():
    """Import every plan module and return the filled registry."""
    for name in MODULES:
        importlib.import_module(f"beaconry.plans.{name}")
    return importlib.import_module("beaconry.plans.registry")
