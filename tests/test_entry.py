"""The driver's entry points, with and without the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and out.columns == ["local_date", "p_30ppb", "p_50ppb", "p_60ppb", "p_75ppb"]


def test_oracles_are_of_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_text_operators(tmp_path):
    shutil.copytree(ROOT / "forelight", tmp_path / "forelight", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op') and q[2].isdigit()])"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=False)
    assert said.returncode == 0, said.stderr
    assert said.stdout.strip().endswith("[]") and int(said.stdout.split()[0]) > 50
