import pytest

from conftest import SF001
from ledgerlight import jobs


def test_customer_analytics_writes_results_and_cleans_up(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS flow_db")
    written = jobs.customer_analytics(spark, SF001, database="flow_db")
    assert sorted(written) == sorted(jobs.RESULT_TABLES)
    names = {t.name for t in spark.catalog.listTables("flow_db")}
    assert set(jobs.RESULT_TABLES) <= names
    assert not any(n.startswith(("tmp__", "stg_")) for n in names)
    assert spark.table("flow_db.pres_clv").count() > 0
    # a second run replaces, it does not append
    n = spark.table("flow_db.attribution_touches").count()
    jobs.customer_analytics(spark, SF001, database="flow_db")
    assert spark.table("flow_db.attribution_touches").count() == n


def test_taxi_flow_writes_once_by_default(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS taxi_db")
    out = jobs.taxi_regression(spark, SF001, database="taxi_db")
    assert set(out["metrics"]) == {"train_score", "test_score"}
    assert spark.table(out["table"]).columns == [
        "pickup_location_id", "dropoff_location_id", "hour_of_day", "trip_duration_sec_pred"]
    with pytest.raises(Exception):
        jobs.taxi_regression(spark, SF001, database="taxi_db")
    jobs.taxi_regression(spark, SF001, database="taxi_db", write_mode="overwrite")
