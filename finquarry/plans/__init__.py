"""All registered queries."""

from importlib import import_module

from finquarry.plans.registry import QUERIES

SECTIONS = []
import os as _os

for _f in sorted(_os.listdir(_os.path.dirname(__file__))):
    if _f.startswith("q_") and _f.endswith(".py"):
        SECTIONS.append(_f[:-3])
        import_module(f"finquarry.plans.{_f[:-3]}")

__all__ = ["QUERIES", "SECTIONS"]
