"""The entry point with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'pipeline' in q, any(k.startswith('op1') for k in q))"


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_loads_without_the_subpackage(tmp_path, with_pipeline_file):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline_file else ["corpus_pipeline.py"])))
    found = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, env=dict(os.environ, PYTHONPATH=str(copy)), capture_output=True, text=True, check=True)
    n, sql, pipeline, operators = found.stdout.split()
    assert int(n) > 150 and int(sql) > 150 and (pipeline, operators) == ("False", "False")
