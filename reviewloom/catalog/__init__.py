"""Registered queries of every operator family with their check SQL."""

from __future__ import annotations

import importlib

_FAMILIES = ["tagging", "dashboard", "keyed", "health", "scalars", "extraction", "files", "ingest"]


def _load():
    from reviewloom.catalog import bindings

    for family in _FAMILIES:
        importlib.import_module(f"reviewloom.catalog.{family}")
    return bindings


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLES)
