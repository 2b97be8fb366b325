"""The entry points without the corpus folders, and from another folder."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(set(e.oracle_sql()) - set(e.queries())))"


def names(root: str, cwd: str) -> list[str]:
    env = {**os.environ, "PYTHONPATH": root, "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=cwd, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    found, strays = done.stdout.splitlines()[-2:]
    assert strays == "[]"
    return found


def copy_without(target, *left_out: str) -> str:
    shutil.copytree(ROOT, target, ignore=lambda d, n: {x for x in n if os.path.relpath(os.path.join(d, x), ROOT) in {".git", *left_out}})
    return str(target)


def test_imports_without_the_corpus_folders(tmp_path):
    folders = (os.path.join("sparkwatch", "llm"), os.path.join("tests", "llm"))
    whole = names(ROOT, str(tmp_path))
    without = names(copy_without(tmp_path / "a", *folders, "corpus_pipeline.py"), str(tmp_path))
    assert without == names(copy_without(tmp_path / "b", *folders), str(tmp_path))
    assert "batch_pipeline" in without and "op1_" not in without and "pipeline'" in whole


WORKER = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from sparkwatch.functions.matching import _winner_at
from sparkwatch.session import build_session
spark = build_session("shipped", master="local[1]", **{{"spark.ui.enabled": "false"}})
places = F.udf(lambda i: str(_winner_at(["a", "a b"], "word")))
print("ROWS", [r[0] for r in spark.range(1).select(places("id")).collect()])
spark.stop()
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WORKER.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "ROWS ['[0, 0]']" in done.stdout, done.stderr[-2000:]
