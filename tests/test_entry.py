"""The registry stands without the folders that can be removed."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(folder):
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, 'op1_warc' in q, set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(folder)}).stdout.split()
    return int(out[0]), *out[1:]


def test_imports_without_removed_parts(tmp_path):
    for name in ("litmill", "__spark_entry__.py", "corpus_pipeline.py"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        if os.path.exists(f"{ROOT}/{name}"):
            copy(f"{ROOT}/{name}", tmp_path / name)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    _, pipeline, ops, known = registered(tmp_path)
    assert pipeline == "False" and known == "True" and ops == str(os.path.exists(f"{ROOT}/litmill/llm/queries.py"))
    shutil.rmtree(tmp_path / "litmill" / "llm", ignore_errors=True)
    (tmp_path / "litmill" / "llm" / "__pycache__").mkdir(parents=True)
    n, pipeline, ops, known = registered(tmp_path)
    assert n > 150 and (pipeline, ops, known) == ("False", "False", "True")
