"""Every query that has SQL gives DuckDB's rows, over the whole smallest tables."""

import ast
import os
from pathlib import Path

import pytest
from sql_compare import DATA, compare

from verbena import queries_core

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.skipif(not os.path.exists(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(queries_core.SQL))
def test_core(spark, name):
    compare(spark, queries_core.QUERIES[name], queries_core.SQL[name])


def test_nothing_imports_the_llm_package():
    for path in (ROOT / "verbena").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(path.read_text(encoding="utf-8"))):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") for n in names), path
