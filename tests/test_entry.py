import subprocess
import sys
from pathlib import Path

import __spark_entry__ as engine
from tidemark import schemas

TOP = Path(__file__).resolve().parents[1]


def test_flagship_has_rows_and_a_stable_schema(spark):
    out = engine.entry(spark)
    assert out.schema.names == schemas.SUMMARY.names and out.count() > 0


def test_every_query_but_those_without_sql_has_an_oracle():
    queries, sql = engine.queries(), engine.oracle_sql()
    assert set(sql) <= set(queries)
    assert {n for n in queries if n not in sql and not n.startswith("op") and n != "pipeline"} == set()


def test_the_rest_works_without_the_training_data_folder(tmp_path):
    for name in ("__spark_entry__.py",):
        (tmp_path / name).write_bytes((TOP / name).read_bytes())
    for f in (TOP / "tidemark").rglob("*.py"):
        to = tmp_path / f.relative_to(TOP)
        if "llm" not in to.parts:
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(f.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'summary_full' in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_nothing_else_imports_the_folder():
    for f in (TOP / "tidemark").rglob("*.py"):
        if "llm" not in f.parts:
            assert "tidemark.llm" not in f.read_text()
