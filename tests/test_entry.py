"""The entry module without the text operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"


@pytest.mark.parametrize("gone", [("ionweave/llm", "tests/llm"), ("ionweave/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_text_operators(tmp_path, gone):
    left_out = {str(ROOT / g) for g in gone}
    ignore = lambda folder, names: [n for n in names if str(Path(folder) / n) in left_out or n in (".git", "__pycache__", ".pytest_cache")]
    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    said = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=tmp_path / "copy", env=dict(os.environ, PYTHONPATH=os.pathsep.join(p for p in sys.path if "site-packages" in p)), capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    queries, oracles, text = map(int, said.stdout.split())
    assert queries >= 150 and oracles >= 145 and text == 0
