"""The library without the part on training text."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_loads_without_the_part_on_training_text(tmp_path):
    copy = tmp_path / "repo"
    copy.mkdir()
    for name in ("gridagro", "checks"):
        shutil.copytree(f"{ROOT}/{name}", copy / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", copy / name)
    code = "import __spark_entry__ as e, bench; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    queries, sql, training = out.stdout.split()
    assert int(queries) == int(sql) > 100 and training == "False"
