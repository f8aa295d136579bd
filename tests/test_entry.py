import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_subpackage():
    """The other queries are there when the subpackage for training text is not."""
    code = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith("seriesloom.llm"):
            raise ModuleNotFoundError(name, name=name)
import importlib.util
own = importlib.util.find_spec
importlib.util.find_spec = lambda name, *a: None if name.startswith("seriesloom.llm") else own(name, *a)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
assert "naive_forecast_scores" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
