"""Corpus queries against their SQL on the smallest tables, and the guard around them."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from llm_fixtures import SMALL
from tickloom.llm.oracles import oracles
from tickloom.llm.queries import registry

HERE = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(df):
    def text(value):
        if value is None or value != value:
            return ""
        return repr(float(value)) if isinstance(value, (int, float)) else str(value)

    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_sql(spark, duck, name):
    got, want = registry()[name](spark, SMALL).toPandas(), duck.execute(oracles()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_there_is_one_query_per_operator():
    assert [int(n[2:].split("_")[0]) for n in registry()] == list(range(1, 14))


def test_the_rest_imports_without_the_corpus_operators(tmp_path):
    shutil.copytree(HERE / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(HERE / "__spark_entry__.py", tmp_path)
    program = "import __spark_entry__ as e; print(any(n.startswith('op') or n == 'pipeline' for n in e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    found, count = done.stdout.split() or ("", 0)
    assert found == "False" and int(count) >= 58, done.stderr[-1000:]
