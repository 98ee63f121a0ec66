"""Queries keep values that the given tables lack: further types, priorities, segments, classes, months and longer vectors."""

import os

import pytest
from conftest import SF_DIR, plain

from tidemill.plans import load_all
from tidemill.plans.registry import QUERIES, TWINS

load_all()

# What each table gets besides its rows.
CHANGES = {
    "events": """SELECT * FROM src UNION ALL BY NAME SELECT max(event_id) OVER () + row_number() OVER () AS event_id, TIMESTAMP '2024-01-09 10:00:00' + INTERVAL (i % 3000) SECOND AS ts,
        1 AS user_id, CASE WHEN i < 2000 THEN 'click' ELSE 'refund' END AS event_type, i * 0.5 AS value, '{"k": 3}' AS props
        FROM (SELECT event_id FROM src LIMIT 1), range(2100) r(i)""",
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN '6-NEVER' ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 2 YEAR ELSE o_orderdate END AS o_orderdate) FROM src""",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 10 = 0 THEN 'SHIPPING' WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment) FROM src",
    "embeddings": "SELECT * REPLACE (list_concat(embedding, list_transform(range(8), lambda j: ((vec_id + j) % 5)::FLOAT)) AS embedding, CASE WHEN vec_id % 9 = 0 THEN 10 ELSE label END::INTEGER AS label) FROM src",
}
NAMES = [
    "acf", "pacf", "seasonal_decompose", "lag_features", "forecast_leaderboard", "nest_entries_by_date", "stream_nested_json", "stream_flat_json",
    "stream_foreachbatch_append", "stream_append_sink", "stream_running_volume", "stream_dedup", "stream_threshold_alerts", "mean_over_runs", "unpivot_wide",
    "pivot_matrix", "one_hot", "one_hot_mapping", "random_baseline", "davies_bouldin", "silhouette_squared", "avg_pool_embedding", "join_left", "join_right",
    "shared_category_countries",
]


@pytest.fixture(scope="module")
def changed(tmp_path_factory):
    duckdb = pytest.importorskip("duckdb")
    folder, con = str(tmp_path_factory.mktemp("changed")), duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        sql = CHANGES.get(name, "SELECT * FROM src").replace("src", f"'{SF_DIR}/{file}'")
        con.execute(f"COPY ({sql}) TO '{folder}/{file}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_keeps_new_values(spark, changed, name):
    folder, con = changed
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    result = con.execute(TWINS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert ours == theirs
    assert ours
