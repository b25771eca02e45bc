"""The oracle shares no constants with the Spark plans."""

import ast
import pathlib

import stayframe.oracle as oracle

FOLDER = pathlib.Path(oracle.__file__).parent


def _imports(path):
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.ImportFrom):
            yield node.module, {a.name for a in node.names}
        elif isinstance(node, ast.Import):
            yield from ((a.name, set()) for a in node.names)


def test_oracle_imports_nothing_from_the_plans():
    for path in FOLDER.glob("*.py"):
        for module, names in _imports(path):
            assert not module.startswith(("stayframe.plans", "stayframe.operators")), path
            if module.startswith("stayframe.functions"):
                assert names == {"numeric_round_sql"}, path
            if module == "stayframe.sources":
                assert names == {"fixture_spec"} and path.name == "fixture_sql.py"
