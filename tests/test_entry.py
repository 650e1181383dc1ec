"""The entry without the training-data operators, and without a library of theirs."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; q = e.queries(); print('ohlcv_15min' in q, any(n.startswith('op1_') for n in q), 'pipeline' in q)"


def shown(folder, before=""):
    found = subprocess.run([sys.executable, "-c", before + SHOW], cwd=folder, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    return found.stdout.split()


@pytest.mark.parametrize("gone", [["candlewick/llm", "corpus_pipeline.py"], ["candlewick/llm"], ["corpus_pipeline.py"]])
def test_entry_without_the_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", "tests") or str(Path(d, n).relative_to(ROOT)) in gone])
    assert shown(copy) == ["True", "False", "False"]


def test_entry_without_a_library():
    assert shown(ROOT, "import sys; sys.modules['xxhash'] = None\n") == ["True", "False", "False"]


def test_entry_takes_no_pipeline_of_another_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", str(ROOT))
    test_entry_without_the_operators(tmp_path, ["corpus_pipeline.py"])
    assert shown(ROOT) == ["True", "True", "True"]
