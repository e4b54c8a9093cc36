"""Every registered query against its SQL counterpart, at the smallest scale."""

import math
import os

import duckdb
import pytest

from waymesh.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.8g}" if v else "0"
    return str([shown(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(name, spark, sf_dir, con):
    got = registry.queries()[name](spark, sf_dir)
    cols = sorted(got.columns)
    rows = sorted(tuple(shown(r[c]) for c in cols) for r in got.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        # a few find nothing among the 150 segments of the smallest scale
        assert rows or registry.queries()[name](spark, "/root/testdata/sf0.01").limit(1).collect()
        return
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    assert rows == sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in rel.fetchall())


def test_entry_imports_without_the_corpus_subpackage(tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for f in ("__spark_entry__.py",):
        os.symlink(f"{root}/{f}", tmp_path / f)
    os.makedirs(tmp_path / "waymesh")
    for f in os.listdir(f"{root}/waymesh"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{root}/waymesh/{f}", tmp_path / "waymesh" / f)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
