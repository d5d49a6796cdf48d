"""The document source: byte ranges, pushed filters, one report over the store."""

import datetime as dt
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.schemas import PORTFOLIOS, USERS
from ledgerlake.sources import document_store, fixtures
from ledgerlake.sources.document_store import lines_of, ranges

SF = "/root/testdata/sf0.001"


def plan(df):
    spark = df.sparkSession
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_ranges_hold_every_line_once():
    rng = random.Random(4)
    for ending in ("\n", ""):
        lines = [b"x" * rng.choice([0, 1, 3, 50, 400]) + b"%d" % i for i in range(300)]
        data = b"\n".join(lines) + ending.encode()
        for size in (1, 7, 64, 1000, 10 ** 6):
            got = []
            for r in ranges([("f", len(data))], size):
                for part in lines_of(pa.BufferReader(data), r.start, r.end, 97):
                    got += part.split(b"\n")[:-1] if part.endswith(b"\n") else part.split(b"\n")
            assert got == lines, (size, ending)


def test_documents_round_trip(spark, tmp_path):
    t = fixtures.load(spark, SF)
    t.users.repartition(3).write.json(str(tmp_path / "u"))
    t.portfolios.repartition(2).write.json(str(tmp_path / "p"))
    u = document_store.read(spark, str(tmp_path / "u"), USERS, range_bytes=5000)
    p = document_store.read(spark, str(tmp_path / "p"), PORTFOLIOS)
    assert u.rdd.getNumPartitions() > 5
    assert sorted(u.collect()) == sorted(t.users.select(*u.columns).collect())
    want = t.portfolios.select(*p.columns).orderBy("portfolio_id").collect()
    assert p.orderBy("portfolio_id").collect() == want


def test_filters_are_pushed(spark, tmp_path):
    t = fixtures.load(spark, SF)
    t.users.write.json(str(tmp_path / "u"))
    u = document_store.read(spark, str(tmp_path / "u"), USERS)
    cases = [F.col("kyc_status") == "verified", F.col("region").isin("ASIA", "EUROPE"), F.col("name").isNull(),
             F.col("kyc_status") != "verified", F.col("user_id") > "USER_000100", ~F.col("region").isin("ASIA"),
             (F.col("kyc_status") == "verified") & (F.col("risk_profile") >= "m")]
    for c in cases:
        got = u.where(c)
        assert sorted(r.user_id for r in got.collect()) == sorted(r.user_id for r in t.users.where(c).collect())
        assert "PushedFilters: [" in plan(got) and ") Filter" not in plan(got), plan(got)
    # a nested field stays with Spark
    nested = u.where("metadata.age > 40")
    assert ") Filter" in plan(nested) and nested.count() == t.users.where("metadata.age > 40").count()


def test_pushed_filter_leaves_nulls_out(spark, tmp_path):
    docs = [{"user_id": "a", "region": None, "extra": {"x": 1}}, {"user_id": "b", "region": "ASIA"}, {"user_id": "c"},
            {"user_id": "d", "region": "EUROPE", "created_at": "2024-01-02T03:04:05"}]
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, docs)) + "\n\n")
    u = document_store.read(spark, str(tmp_path / "d.json"), USERS)
    ids = lambda c: sorted(r.user_id for r in u.where(c).collect())
    assert ids("region <> 'ASIA'") == ["d"] and ids("region IS NULL") == ["a", "c"]
    assert ids("region IN ('ASIA', NULL)") == ["b"] and ids("NOT region IN ('ASIA')") == ["d"]
    assert u.where("user_id = 'd'").first().created_at == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_empty_store_and_missing_schema(spark, tmp_path):
    (tmp_path / "e").mkdir()
    assert document_store.read(spark, str(tmp_path / "e"), USERS).count() == 0
    with pytest.raises(Exception, match="declared schema"):
        spark.read.format(document_store.FORMAT).load(str(tmp_path / "e")).count()


def test_report_over_the_store(spark):
    from ledgerlake.plans import catalog
    df = catalog.queries()["regional_profitability_from_store"](spark, SF)
    text = plan(df)
    pushed = [line for line in text.splitlines() if "PushedFilters: [" in line]
    assert any("kyc_status" in line and "verified" in line for line in pushed), text
    assert sorted(df.collect()) == sorted(catalog.queries()["regional_profitability"](spark, SF).collect())
