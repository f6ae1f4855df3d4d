import os
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_module_works_without_the_training_data_folders(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/claimlake", tmp_path / "claimlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n[:2] == 'op' or n == 'pipeline' for n in q), list(q); assert e.oracle_sql()"
    for kept in (True, False):
        if not kept and (tmp_path / "corpus_pipeline.py").exists():
            os.remove(tmp_path / "corpus_pipeline.py")
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
