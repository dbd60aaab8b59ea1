import os

import duckdb
import pytest

import __spark_entry__ as entry
from rolewise.catalog import modelling

FOLDER = "/root/testdata/sf0.001"
QUICK = ("scan_parquet", "infer_task", "numeric_profile", "class_balance", "cap_outliers", "frequency_encode",
         "target_encode_oof", "tfidf_terms", "chi_square", "mann_whitney_u", "stratified_split", "ols_multi", "cv_linear",
         "roc_auc", "acf", "series_freq", "target_by_category")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{FOLDER}/{name}')")
    return connection


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and set(QUICK) <= set(sql)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
@pytest.mark.parametrize("query,step", [("model_rf_reg", "fit_all"), ("model_gbt_clf", "fit_all"), ("model_gbt_multiclass", "fit_all"),
                                        ("cross_validate", "cross_validate"), ("model_comparison", "run_models"), ("analyze_events", "analyze")])
def test_model_queries_run_the_defaults(spark, monkeypatch, query, step):
    class Reached(Exception):
        pass

    def reached(*args, **options):
        raise Reached([x for x in [*args, options.get("settings")] if isinstance(x, modelling.Settings)], options)
    monkeypatch.setattr(modelling, step, reached)
    with pytest.raises(Reached) as found:
        entry.queries()[query](spark, FOLDER)
    settings, options = found.value.args
    assert settings == [modelling.Settings()] * (step != "analyze") and not {"model_names", "segment_restarts"} & set(options)


def test_entry(spark):
    assert entry.entry(spark).count() == 11


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    mine = sorted(map(repr, (tuple(r[c] for c in sorted(names)) for r in df.collect())))
    theirs = sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall())))
    assert mine == theirs
