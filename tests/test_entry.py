"""The contract with the driver."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


CODE = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q)"


def check(folder, before=""):
    subprocess.run([sys.executable, "-B", "-c", before + CODE], cwd=folder, check=True, timeout=120)


def test_works_without_the_optional_part(tmp_path):
    """Without its folder, with and without the pipeline beside it; and where something that it needs isn't installed."""
    shutil.copytree(ROOT / "linkloom", tmp_path / "linkloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    check(tmp_path)
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
        check(tmp_path)
    if (ROOT / "linkloom" / "llm").exists():
        shutil.copytree(ROOT / "linkloom" / "llm", tmp_path / "linkloom" / "llm", ignore=shutil.ignore_patterns("__pycache__"))
        check(tmp_path, "import sys; sys.modules['ahocorasick'] = None; ")


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
