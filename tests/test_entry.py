"""The entry module without the parts that may be left out."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
PROBE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "daily_metrics" in names and "pipeline" not in names and not [n for n in names if n.startswith("op1_")]
assert set(entry.oracle_sql()) <= names
import bench
"""


def without_llm(target, pipeline):
    shutil.copytree(ROOT / "eventlake", target / "eventlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        shutil.copy(ROOT / name, target)


def test_entry_without_the_llm_folders(tmp_path):
    """With the pipeline's file left behind, and without it."""
    for pipeline in (True, False):
        target = tmp_path / str(pipeline)
        target.mkdir()
        without_llm(target, pipeline)
        done = subprocess.run([sys.executable, "-c", PROBE], cwd=target, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
