import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import compare
from conftest import ROOT


def test_sql_needs_no_session_and_every_name_has_a_query():
    code = "import __spark_entry__ as e; s = e.oracle_sql(); assert set(s) <= set(e.queries()), set(s) - set(e.queries()); print(len(s))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert int(out.stdout) > 70


def test_every_query_of_the_library_has_sql():
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own - set(entry.oracle_sql()) == set()


def test_sql_is_accepted_by_duckdb():
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    for text in entry.oracle_sql().values():
        con.execute(f"EXPLAIN {text}")


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 38 and not df.isEmpty()


QUICK = ["bi_produccion_por_mes", "feat_online", "dim_area", "ts_counter_rate", "ts_alert_episodes", "dq_relationships"]


@pytest.mark.parametrize("name", QUICK)
def test_queries_equal_sql(spark, sf_dir, name):
    assert compare.difference(entry.queries()[name](spark, sf_dir), compare.duck(sf_dir), entry.oracle_sql()[name]) is None


def test_entry_works_without_the_optional_folder(tmp_path):
    """The llm package and the pipeline may be taken out; a fault inside them must still show."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *a):\n"
        "        if name.startswith('mensura.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'feat_offline' in e.queries() and len(e.oracle_sql()) > 70"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)


def test_a_wrong_lag_in_the_engine_turns_its_row_red(spark, sf_dir, monkeypatch):
    from mensura.plans import features

    monkeypatch.setitem(features.LAGS, "prod_pet_lag2", ("prod_pet", 3))
    assert compare.difference(entry.queries()["feat_lags"](spark, sf_dir), compare.duck(sf_dir), entry.oracle_sql()["feat_lags"])
