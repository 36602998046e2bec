"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def ship_by_value(module_name: str) -> None:
    """Pickle the functions of ``module_name`` by value when they go to Python
    workers, so executors need not have this package installed (a cluster
    would otherwise need it shipped with ``--py-files``)."""
    import sys

    from pyspark import cloudpickle
    mod = sys.modules.get(module_name)
    if mod is not None:
        try:
            cloudpickle.register_pickle_by_value(mod)
        except (ValueError, TypeError):
            pass


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process (workers are
    reused across tasks), for objects such as models that are costly to build."""
    import sys
    cache = getattr(sys, "_lumisort_worker_cache", None)
    if cache is None:
        cache = {}
        sys._lumisort_worker_cache = cache
    return cache
