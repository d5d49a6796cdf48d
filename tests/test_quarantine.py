"""Malformed rows of a feed: what is rejected and why, nothing lost, the limit."""

import dataclasses
import os

import pytest

from ledgerlake import pipeline
from ledgerlake.sources import quarantine
from ledgerlake.sources.quarantine import Feed, TooManyRejects

FX = pipeline.FX_FEED
LINES = {"USD,EUR,1.5": None, "USD,EUR,n/a": "type:rate", "USD,GBP": "fields", "USD,GBP,1.5,9": "fields",
         "USD,,1.5": "missing:quote_ccy", ",EUR,1.5": "missing:base_ccy", "USD,EUR,": "missing:rate",
         'USD,"E,R",2': None, "USD": "fields", "USD,JPY,1e2": None}


def land(root, day, lines, header="base_ccy,quote_ccy,rate"):
    folder = f"{root}/ds={day}"
    os.makedirs(folder)
    with open(f"{folder}/part.csv", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return str(root)


def test_every_line_is_good_or_rejected(spark, tmp_path):
    path = land(tmp_path / "fx", "2024-01-01", list(LINES) + [""])
    rows = quarantine.scan(spark, path, FX)
    good, bad = quarantine.good_rows(rows, FX), quarantine.rejected_rows(rows, FX)
    want = {line: why for line, why in LINES.items() if why}
    assert {r.line: r.reason for r in bad.collect()} == want
    assert {r.file.rsplit("/", 2)[-2] for r in bad.collect()} == {"ds=2024-01-01"}
    assert sorted((r.quote_ccy, r.rate) for r in good.collect()) == [("E,R", 2.0), ("EUR", 1.5), ("JPY", 100.0)]
    assert good.count() + bad.count() == len(LINES)
    # the columns asked for do not change what is malformed
    assert good.select("base_ccy").count() == 3 and bad.select("reason").count() == len(want)


def test_limit_fails_before_anything_is_written(spark, tmp_path):
    path = land(tmp_path / "fx", "2024-01-01", list(LINES) * 20)
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    with pytest.raises(TooManyRejects, match="140 of 200"):
        pipeline.ingest_fx(spark, paths, path, "2024-01-01", "2024-01-02")
    assert not os.path.exists(paths.fx)
    assert quarantine.read_rejects(spark, paths.rejects).count() == 140
    lenient = dataclasses.replace(FX, max_share=0.7)
    assert pipeline.ingest_fx(spark, paths, path, "2024-01-01", "2024-01-02", lenient) == 3
    # the same run again replaces its rejects
    rejects = quarantine.read_rejects(spark, paths.rejects)
    assert rejects.count() == 140 and {r.feed for r in rejects.collect()} == {"fx_rates"}


def test_few_rejects_are_always_allowed():
    assert FX.allows(100, 100) and not FX.allows(101, 200) and FX.allows(101, 10_100)


def test_symbols_with_malformed_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("symbol,exchange,sector,tick_size\nA,NYSE,Tech,0.01\n,NYSE,Tech,0.01\n"
                                    "B,NYSE,Tech,cheap\nA,NYSE,Tech,0.01\n")
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    assert pipeline.ingest_symbols(spark, paths, str(tmp_path / "s.csv")) == 1
    got = sorted((r.line, r.reason) for r in quarantine.read_rejects(spark, paths.rejects).collect())
    assert got == [(",NYSE,Tech,0.01", "missing:symbol"), ("B,NYSE,Tech,cheap", "type:tick_size")]


def test_files_that_repeat_the_day(spark, tmp_path):
    """A ``ds`` column in the file is read over; the folder tells the day."""
    path = land(tmp_path / "fx", "2024-01-01", ["USD,EUR,1.5,2024-01-09", "USD,EUR,1.5"], "base_ccy,quote_ccy,rate,ds")
    feed = dataclasses.replace(FX, repeated=("ds",))
    rows = quarantine.scan(spark, path, feed)
    assert [str(r.ds) for r in quarantine.good_rows(rows, feed).collect()] == ["2024-01-01"]
    assert [r.reason for r in quarantine.rejected_rows(rows, feed).collect()] == ["fields"]


def test_empty_feed(spark, tmp_path):
    path = land(tmp_path / "fx", "2024-01-01", [])
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    assert pipeline.ingest_fx(spark, paths, path, "2024-01-01", "2024-01-01") == 0
    rows = quarantine.scan(spark, path, FX)
    assert quarantine.set_aside(rows, FX, paths.rejects, "r").count() == 0
    assert isinstance(FX, Feed)
