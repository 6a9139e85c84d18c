import importlib.util
import os
import subprocess
import sys

import pytest

from helpers import table
from quipuflow.plans.queries import oracle_sql, queries

HEAVY = {"entity_resolution", "quality_pipeline"}


@pytest.mark.parametrize("name", sorted(set(queries()) - HEAVY))
def test_query_gives_the_rows_of_its_sql(spark, data, con, name):
    got = queries()[name](spark, data).toPandas()
    assert len(set(got.columns)) == len(got.columns)
    if name in oracle_sql():
        assert table(got) == table(con.execute(oracle_sql()[name]).df())


def test_entry_and_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert ("p8_ids" in e.queries()) == (importlib.util.find_spec("quipuflow.llm") is not None)


def test_the_rest_imports_nothing_of_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    modules = []
    for folder, _, files in os.walk(os.path.join(root, "quipuflow")):
        part = os.path.relpath(folder, root).replace(os.sep, ".")
        if not part.startswith("quipuflow.llm"):
            modules += [f"{part}.{f[:-3]}" for f in files if f.endswith(".py") and f != "__init__.py"]
    code = f"import sys, importlib\nfor m in {modules!r}:\n    importlib.import_module(m)\nassert not [m for m in sys.modules if m.startswith('quipuflow.llm')]"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.queries()["relation_report"](spark, data).count() > 0
