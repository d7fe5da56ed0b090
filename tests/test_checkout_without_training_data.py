"""The rest of the library works in a checkout that lacks the training-data package, with and without the pipeline module."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import __spark_entry__ as contract
from tidewell.session import local_session

spark = local_session("2", 2, "1g")
names = contract.queries()
assert len(names) > 200 and not [n for n in names if n.startswith("op") or n == "pipeline"], sorted(names)
assert set(contract.oracle_sql()) <= set(names)
assert names["agg_02_revenue_by_category"](spark, "/root/testdata/sf0.001").count() > 0
spark.stop()
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_training_data(tmp_path, pipeline):
    copy = tmp_path / "checkout"
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=gone)
    assert (copy / "corpus_pipeline.py").exists() is (pipeline and (ROOT / "corpus_pipeline.py").exists())
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
