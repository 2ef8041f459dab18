"""Registered queries do the whole job: nothing narrower than the operators' own defaults."""

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, oracle_sql, queries
from cohortlens.functions.columns import panel_column_name
from cohortlens.sources.tables import TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_flagship_holds_every_panel_taxon(spark, duck):
    df = queries()["targeted_features"](spark, SMOKE_DIR)
    rows = {r["run_accession"]: r for r in df.collect()}
    # The whole matrix against the query's SQL.
    got = duck.execute(oracle_sql()["targeted_features"])
    names = [d[0] for d in got.description]
    told = got.fetchall()
    assert set(names) == set(df.columns) and len(told) == len(rows)
    for t in told:
        row = dict(zip(names, t, strict=True))
        own = rows[row["run_accession"]]
        for k in names:
            assert own[k] == (pytest.approx(row[k], abs=2e-6) if isinstance(row[k], float) else row[k])
    # Every taxon of the panel has its columns, the automatic ones by place.
    panel = [r[0] for r in duck.execute(f"SELECT taxon FROM ({oracle_sql()['panel_merge']}) ORDER BY position").fetchall()]
    one = next(iter(rows.values()))
    auto = [t for t in panel if panel_column_name(t) not in names]
    assert auto and [one[f"auto_{i + 1}_taxon"] for i in range(len(auto))] == auto
    long = duck.execute(f"SELECT run_accession, taxon, value, value_log10, present FROM ({oracle_sql()['panel_values']})").fetchall()
    assert len(long) == len(panel) * len(rows)
    for run, taxon, value, log, present in long:
        c = f"auto_{auto.index(taxon) + 1}" if taxon in auto else panel_column_name(taxon)
        assert [rows[run][c], rows[run][f"{c}_log10"]] == pytest.approx([value, log], abs=2e-6)
        assert rows[run][f"{c}_present"] == present
