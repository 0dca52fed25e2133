"""The entry points without the training-data package."""

import json
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_package(tmp_path):
    """A copy of the tree without that folder still imports, and has every other query and its SQL."""
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
    names, sql = json.loads(out.stdout.splitlines()[-1])
    assert names == sql and len(names) >= 69 and not any(n.startswith("op") or n == "pipeline" for n in names)
