import datetime as dt
from decimal import Decimal
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

import micro
from stayline.plans.features import build_features
from stayline.sources import metric_store, schemas, warehouse
from stayline.sources.tables import read_raw, read_table, write_table


def test_csv_round_trip_keeps_types_and_nulls(spark, tmp_path):
    rows = [
        dict(account_id="a", churned=1, churn_date=dt.date(2025, 1, 2), mrr=Decimal("10.05")),
        dict(account_id="b", region=None),
    ]
    path = str(tmp_path / "accounts.csv")
    write_table(micro.accounts(spark, rows), path, "csv")
    back = read_table(spark, path, schemas.ACCOUNTS)
    assert back.schema == schemas.ACCOUNTS
    got = micro.by_id(back)
    assert got["a"]["churn_date"] == dt.date(2025, 1, 2) and got["a"]["mrr"] == Decimal("10.05")
    assert got["b"]["churn_date"] is None and got["b"]["region"] is None


def test_raw_folder_to_stored_features(spark, tmp_path):
    folder = str(tmp_path / "raw")
    tables = {
        "accounts": micro.accounts(spark, [dict(account_id="a"), dict(account_id="b")]),
        "usage_metrics": micro.usage(spark, [("a", "2024-06-01", 3)]),
        "support_tickets": micro.tickets(spark, [("a", "2025-01-01", "high", 4, None)]),
        "nps_surveys": micro.nps(spark, [("a", "2024-06-30", 8)]),
    }
    for name, table in tables.items():
        write_table(table, f"{folder}/{name}.csv", "csv")
    raw = read_raw(spark, folder)
    features = build_features(*[raw[n] for n in tables], micro.SNAPSHOT)
    for kind in ("csv", "parquet"):
        path = str(tmp_path / f"features.{kind}")
        doubles = features.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.features_schema()]
        )
        write_table(doubles, path, kind)
        back = read_table(spark, path, schemas.features_schema(), kind)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, doubles.collect()))


def test_malformed_date_is_an_error(spark, tmp_path):
    (tmp_path / "n.csv").write_text("account_id,survey_date,quarter,nps_score,respondent_role\na,yesterday,Q1,3,x\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        read_table(spark, str(tmp_path / "n.csv"), schemas.NPS_SURVEYS).collect()


@pytest.mark.parametrize("ratio, volume", [("0.12345678", "1"), ("0.5", "1.23456"), ("x", "1"), ("123.5", "1")])
def test_digits_a_column_does_not_hold_are_an_error(spark, tmp_path, ratio, volume):
    names = [f.name for f in schemas.USAGE_METRICS]
    row = {"account_id": "a", "active_user_ratio": ratio, "data_processed_gb": volume}
    lines = [",".join(names), ",".join(row.get(n, "") for n in names)]
    (tmp_path / "u.csv").write_text("\n".join(lines))
    with pytest.raises(Exception, match="can't be cast"):
        read_table(spark, str(tmp_path / "u.csv"), schemas.USAGE_METRICS).collect()


def test_rank_is_a_column_in_the_file(spark, tmp_path):
    from stayline.operators.ordering import rank_rows

    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "account_id string, v double")
    path = str(tmp_path / "list")
    write_table(rank_rows(df, [F.desc("v"), "account_id"]).select("rank", "account_id"), path, "csv")
    lines = spark.read.text(path).collect()
    assert {r[0] for r in lines} >= {"rank,account_id", "1,b", "2,a"}


def _row(spark, name, f1):
    names = [f.name for f in schemas.MODEL_COMPARISON]
    return spark.createDataFrame([(name, *([f1] * 7))], f"{names[0]} string, " + ", ".join(f"{n} double" for n in names[1:]))


def test_metric_store(spark, tmp_path):
    folder = str(tmp_path / "comparison")
    assert metric_store.read_metrics(spark, folder) is None
    metric_store.upsert_metrics(spark, folder, _row(spark, "A", 0.5))
    metric_store.upsert_metrics(spark, folder, _row(spark, "B", 0.6))
    got = metric_store.upsert_metrics(spark, folder, _row(spark, "A", 0.7))
    assert {(r["model"], r["f1"]) for r in got.collect()} == {("A", 0.7), ("B", 0.6)}
    # an unfinished entry does not count
    (tmp_path / "comparison" / "entry=000009-x").mkdir()
    assert metric_store.read_metrics(spark, folder).count() == 2
    # a reset leaves the new models only, and later ones join them
    metric_store.upsert_metrics(spark, folder, _row(spark, "C", 0.1), reset=True)
    got = metric_store.upsert_metrics(spark, folder, _row(spark, "B", 0.2))
    assert {(r["model"], r["f1"]) for r in got.collect()} == {("B", 0.2), ("C", 0.1)}


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "comparison")
    metric_store.upsert_metrics(spark, folder, _row(spark, "A", 0.1))
    # Each of the writers sees the table as it was before the others wrote.
    seen = metric_store._entries(spark, folder)
    with monkeypatch.context() as m:
        m.setattr(metric_store, "_entries", lambda *_: seen)
        with ThreadPool(4) as pool:
            pool.map(lambda name: metric_store.upsert_metrics(spark, folder, _row(spark, name, 0.5)), "BCDE")
        metric_store.upsert_metrics(spark, folder, _row(spark, "A", 0.3))
    got = {(r["model"], r["f1"]) for r in metric_store.read_metrics(spark, folder).collect()}
    assert got == {("A", 0.3), *((name, 0.5) for name in "BCDE")}


def test_tasks_of_the_join_of_lines_and_orders_grow_with_the_lines(spark, tmp_path, monkeypatch):
    i = F.col("id")
    lines = spark.range(300).select((i % 60).alias("l_orderkey"), F.lit(2.0).alias("l_quantity"), F.timestamp_seconds(800_000_000 + i * 86_400).cast("timestamp_ntz").alias("l_shipdate"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60).select(i.alias("o_orderkey"), (i % 7).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")

    def usage():
        return warehouse.Warehouse(spark, str(tmp_path)).usage.select("account_id", "month", "logins")

    few = usage()
    monkeypatch.setattr(warehouse, "LINES_PER_TASK", 3)
    many = usage()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan(few) and plan(many).count("REPARTITION_BY_NUM") == 2
    assert sorted(few.collect()) == sorted(many.collect()) and sum(r.logins for r in many.collect()) == 600
