"""The driver's entry with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q), set(o) <= set(q))"


def names(folder):
    return subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


def test_queries_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "tidewright"), tmp_path / "tidewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    n, training, known = names(tmp_path)
    assert int(n) > 60 and training == "0" and known == "True"


def test_every_oracle_has_a_query():
    n, training, known = names(ROOT)
    assert known == "True" and training in ("0", "11")
