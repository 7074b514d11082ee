"""Registered queries against their DuckDB oracle on the smallest tables (one key per family)."""

import duckdb
import pytest

from checks.compare import TABLES, _rows
from conftest import SF_SMALL

KEYS = [
    "map", "ndcg_cut", "Rndcg", "G", "iprec_at_recall", "relstring", "map_avgjg", "ranked", "judged_only",
    "complete_topics", "zscore", "postings", "score_lnc_ltn", "score_lm_jm", "ltr_dataset", "kfold_split",
    "prefs_pair", "prefs_avgjg_Rnonrel_ret", "prefs_measures_qrels", "pref_closure", "article_plain_text",
    "leaf_section_paths", "read_run", "qrels_lookup", "write_run",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"run_id", "qid", "measure", "value"}
