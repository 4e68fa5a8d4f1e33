"""Every registered query against its SQL twin on the smallest tables, and the plans that matter."""

import os
import sys

import duckdb
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, TYPE_NAMES, canonical  # noqa: E402

from freshet.checks import oracle, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


TWINS = oracle.oracle_sql()


def test_registry_is_complete():
    assert set(TWINS) == set(queries.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_twin(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(TWINS[name])
    assert dict(df.dtypes) == {c: TYPE_NAMES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types, strict=True)}
    assert canonical(df.toPandas()) == canonical(pd.DataFrame(rel.fetchall(), columns=rel.columns))


def test_entry(spark):
    assert E.entry(spark).count() > 0


def test_same_result_twice(spark):
    fn = E.queries()["viirs_alerts"]
    assert canonical(fn(spark, SF).toPandas()) == canonical(fn(spark, SF).toPandas())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fusion_shuffles_the_merged_rows_once(spark):
    """Five sources meet in one exchange on (run_ts, pfaf_id); no full outer join is planned."""
    text = plan(E.queries()["viirs_alerts"](spark, SF))
    assert "FullOuter" not in text and text.count("REPARTITION_BY_COL") == 1


def test_no_python_in_batch_queries(spark):
    for name in ("viirs_alerts", "zonal_gfms", "points_in_watersheds", "flood_duration"):
        text = plan(E.queries()[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_class_predicate_reaches_the_scan(spark, tmp_path):
    from freshet.checks import fixtures as X
    from freshet.operators import zonal as Z

    X.dfo_pixels(spark, SF).write.parquet(f"{tmp_path}/px")
    out = Z.dfo_layers(spark.read.parquet(f"{tmp_path}/px"), X.watersheds(spark, SF), X.GRID, keep_empty=False)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(value,3.0)" in text


def test_every_edge_occurs(spark):
    """The inputs drop no row and still reach every branch that matters."""
    from pyspark.sql import functions as F

    from freshet.checks import fixtures as X

    edge = "/root/testdata/sf0.01"
    for made, name in ((X.stations, "orders"), (X.dfo_summary, "part"), (X.viirs_summary, "part")):
        assert made(spark, edge).count() == X.table(spark, edge, name).count()
    lines = X.table(spark, edge, "lineitem")
    for made in (X.gfms_runs, X.hwrf_runs):
        summed = made(spark, edge).agg(F.countDistinct("pfaf_id")).first()[0]
        assert summed == lines.select("l_partkey").distinct().count()
    run = queries.QUERIES
    alerts = run["viirs_alerts"](spark, edge).groupBy("alert").count()
    assert {"Information", "Advisory", "Watch", "Warning"} <= {r.alert for r in alerts.collect()}
    assert run["stations_rejected"](spark, edge).select("error").distinct().count() == 5
    fused = run["fuse_forecast"](spark, edge).agg(
        F.count_if(F.col("glofas_score").isNull()), F.count_if(F.col("gfms_score").isNull()),
        F.count_if(F.col("glofas_score").isNotNull() & F.col("gfms_score").isNotNull())).first()
    assert all(fused)
    exposed = run["severity"](spark, edge).agg(F.count_if(F.col("scaled_riverine_risk").isNull()), F.count_if(F.col("severity") == 1.0)).first()
    assert exposed[0]
    seen = run["dfo_alerts"](spark, edge).groupBy("flag").count().collect()
    assert {r.flag for r in seen} >= {None, 2}
