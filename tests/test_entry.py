import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "report_date" in df.columns and "region" in df.columns


def test_queries_and_oracle_keys_align():
    m = _entry()
    assert set(m.oracle_sql()) <= set(m.queries())
    assert set(m.QUERIES) <= set(m.oracle_sql())
    assert len(m.queries()) >= 50
