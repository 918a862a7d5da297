"""The entry module without the subpackage for training data."""

import json
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import json, __spark_entry__ as e
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""


def test_entry_without_llm(tmp_path):
    """With ``lakeward/llm`` gone, ``corpus_pipeline.py`` still there or gone too, the library's queries and SQL remain."""
    from lakeward.plans.queries import build_queries

    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "lakeward"), copy / "lakeward", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "oracle_sql.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy)
    own = sorted(build_queries())
    for _ in range(2):
        env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
        out = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout
        assert json.loads(out) == [own, own]
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
