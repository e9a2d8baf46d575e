import importlib
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


def test_contract():
    e = importlib.import_module("__spark_entry__")
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 40


def test_core_stands_alone():
    """The core imports and lists its queries without the llm package."""
    code = "import sys; sys.modules['loomwright.llm'] = None; import __spark_entry__ as e; assert not any(k[1:2].isdigit() for k in e.queries()); print(len(e.queries()))"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True).stdout.strip().isdigit()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables missing")
def test_queries_equal_sql(spark):
    import duckdb

    from loomwright.plans import catalogue

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SMALL}/{f}'")
    for name, sql in catalogue.SQL.items():
        df = catalogue.QUERIES[name](spark, SMALL)
        cols = sorted(df.columns)
        r = con.execute(sql)
        at = [[d[0] for d in r.description].index(c) for c in cols]
        show = lambda v: str(round(v, 6)) if isinstance(v, float) else str(v)
        want = sorted(tuple(show(x[i]) for i in at) for x in r.fetchall())
        assert sorted(tuple(show(x[c]) for c in cols) for x in df.collect()) == want, name
