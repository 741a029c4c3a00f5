import ast
import pathlib

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_outside_imports_the_optional_subpackage():
    for path in (ROOT / "tidebook").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_entry_has_sql_for_every_named_query_only():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
