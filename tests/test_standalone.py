"""The library without its optional subpackage."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from workload.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_other_queries_stay_without_the_subpackage(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(*gone, ".git", "__pycache__", ".*_cache"))
    run = subprocess.run([sys.executable, "-c", LISTED], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, sql = json.loads(run.stdout.splitlines()[-1])
    assert set(QUERIES) <= set(queries) and set(QUERIES) <= set(sql)
    assert "pipeline" not in queries
    if "llm" in gone:
        assert set(queries) == set(QUERIES) == set(sql)
