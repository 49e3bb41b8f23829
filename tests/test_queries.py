"""Every registered query against its SQL, and independence from the partitioning."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lodeworks.plans import inputs
from lodeworks.plans.catalog import QUERIES
from lodeworks.plans.oracle import ORACLE
from tools.compare import TABLES, canonical

MODELS = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = canonical(result.fetchall(), columns)
    assert want, "the SQL gives no rows"
    assert canonical(df.collect(), df.columns) == want


def test_only_models_lack_sql():
    assert MODELS == [
        "als_best", "als_grid", "als_predict", "als_recommend", "kmeans_assign", "kmeans_k_compare",
        "kmeans_mixed_features", "kmeans_thermo_profile", "malware_cluster_ports", "mlp_epochs",
        "mlp_fit_curve", "mlp_predict",
        "tree_depth_compare", "tree_nodes", "tree_predict", "tree_rules",
    ]
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", [
    "word_count", "top_rated_in_genre", "two_period_trend", "frequent_port_sets", "hash_split_3way",
    "string_index", "cluster_dominant_feature", "multi_hot_topn", "f1_weighted",
])
def test_result_does_not_depend_on_partitioning(spark, sf_dir, name, monkeypatch):
    table = inputs.table
    results = []
    for parts in (1, 7):
        monkeypatch.setattr(inputs, "table", lambda s, d, n: table(s, d, n).repartition(parts))
        df = queries()[name](spark, sf_dir)
        results.append(canonical(df.collect(), df.columns))
    assert results[0] == results[1]
