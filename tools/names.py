"""Print the queries one report module registers: python tools/names.py sql"""
import importlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from tideline.reports import registry

module = sys.argv[1]
for other in ("joins", "windows", "aggregates", "sql", "streams", "storage", "udfs", "patterns"):
    if other == module:
        before = set(registry.QUERIES)
    try:
        importlib.import_module(f"tideline.reports.{other}")
    except ModuleNotFoundError:
        continue
    if other == module:
        print(" ".join(n for n in registry.QUERIES if n not in before))
