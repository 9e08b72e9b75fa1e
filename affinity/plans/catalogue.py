"""Imports every query module and exposes the filled registry."""

import importlib
import pkgutil

from affinity.plans import queries as _package
from affinity.plans.registry import QUERIES, SQL

for _module in sorted(m.name for m in pkgutil.iter_modules(_package.__path__)):
    importlib.import_module(f"{_package.__name__}.{_module}")

__all__ = ["QUERIES", "SQL"]
