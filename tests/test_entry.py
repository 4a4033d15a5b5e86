"""Registered queries: every one has a twin, and the entry query runs."""

import __spark_entry__ as entry


def test_every_query_has_a_twin():
    assert entry.queries() and entry.oracle_sql()
    assert len(entry.QUERIES) > 180 and entry.QUERIES.keys() == entry.ORACLES.keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["grp", "horizon", "surv"] and df.count() == 75


def test_queries_are_named_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 150)"], cwd=root, capture_output=True, text=True)
    assert done.stdout.split()[-1:] == ["True"], done.stderr
