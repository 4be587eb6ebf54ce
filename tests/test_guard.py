import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_everything_else_works_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    n, sql, text = said.split(maxsplit=2)
    assert n == sql and int(n) >= 38 and text.strip() == "[]"


def test_nothing_else_imports_them():
    for file in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert not re.search(r"tidemark(\.|\s+import\s+)llm|corpus_pipeline", file.read_text()), file
