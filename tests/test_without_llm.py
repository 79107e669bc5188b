"""The library and its queries do not need the training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_registry_without_training_data_operators():
    code = (
        "import sys; sys.modules['callinsight.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert set(e.queries()) == set(e.oracle_sql()) == set(e.call_queries()) and len(e.queries()) > 50"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_them():
    for path in (ROOT / "callinsight").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
