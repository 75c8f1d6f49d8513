"""Query catalogue (Spark) and its oracle statements (DuckDB SQL)."""

from __future__ import annotations

import importlib


def all_queries() -> dict:
    base = importlib.import_module(".catalogue", __name__)
    importlib.import_module(".catalogue_models", __name__)  # registers part 2
    importlib.import_module(".catalogue_ml", __name__)  # registers part 3
    importlib.import_module(".catalogue_contract", __name__)  # registers part 4
    importlib.import_module(".catalogue_stack", __name__)  # registers part 5
    return dict(base.REGISTRY)


def all_sql() -> dict:
    base = importlib.import_module(".oracle", __name__)
    importlib.import_module(".oracle_models", __name__)
    importlib.import_module(".oracle_ml", __name__)
    importlib.import_module(".oracle_contract", __name__)
    importlib.import_module(".oracle_stack", __name__)
    return dict(base.SQL)
