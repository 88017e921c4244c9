import pytest

from adpulse.__main__ import main
from conftest import event, records

CLOSING = [event(0, hour=12)]
DAYS = ["--from-day", "2026-01-09", "--to-day", "2026-01-10"]


@pytest.fixture
def source(spark, tmp_path):
    lines = [event(s, ip="bot" if s % 2 else f"ip{s}", minute=1) for s in range(60)]
    records(spark, lines + CLOSING).coalesce(1).write.text(f"{tmp_path}/in")
    return ["--source-format", "text", "--source-path", f"{tmp_path}/in"]


def report(capsys, store, *args):
    capsys.readouterr()
    main(["report", *args, "--store", store, "--as-of", "2026-01-09T08:02:00+00:00", "--minutes", "10"])
    return capsys.readouterr().out


def test_stream_then_report(spark, tmp_path, source, capsys):
    store = f"file://{tmp_path}/tables"
    main(["stream", *source, "--store", store, "--checkpoint", f"file://{tmp_path}/c", "--window", "1 minute", "--until-caught-up"])
    assert "campaign_1\t60\t" in report(capsys, store, "top-campaigns", "--mode", "current")
    # 10:01 in the producers' zone, +02:00.
    assert "2026-01-09 10:01:00" in report(capsys, store, "global-series", "--mode", "current")
    assert "Pipeline may be catching up" in report(capsys, store, "health")


def test_backfill_then_report(spark, tmp_path, source, capsys):
    store = f"file://{tmp_path}/history"
    for _ in range(2):  # a repeated run replaces its own rows
        main(["backfill", *source, "--store", store, "--window", "10 seconds", "--distinct", "exact", "--unordered-input", *DAYS])
    out = report(capsys, store, "stats")
    assert "traffic_metrics\t7\t" in out and "alerts" in out
    out = report(capsys, store, "campaign-breakdown", "--campaign", "campaign_1", "--mode", "historical", "--minutes", "1")
    assert "10:01:00" in out and "10:01:50" in out


def test_reports_show_and_write_every_row(spark, tmp_path, capsys):
    records(spark, [event(s, ip=f"ip{s}", minute=m, hour=9) for m in range(53, 59) for s in range(0, 60, 10)]).write.text(f"{tmp_path}/in")
    store = f"file://{tmp_path}/history"
    main(["backfill", "--source-format", "text", "--source-path", f"{tmp_path}/in", "--store", store, "--window", "10 seconds", *DAYS])
    wanted = ("global-series", "--mode", "historical", "--hours-back", "0", "--minutes-back", "0")
    assert len(report(capsys, store, *wanted).strip().split("\n")) == 1 + 36
    report(capsys, store, *wanted, "--output", f"{tmp_path}/out", "--output-format", "parquet")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 36


def test_side_tables_thresholds_and_compaction(spark, tmp_path, source, capsys):
    store, thresholds = f"file://{tmp_path}/tables", f"file://{tmp_path}/thresholds"
    side = [part for table in ("arrivals", "untimed_events", "user_sketches", "address_activity") for part in ("--side", table)]
    job = ["stream", *source, "--store", store, "--checkpoint", f"file://{tmp_path}/c", "--window", "1 minute", "--until-caught-up"]
    main([*job, *side, "--activity-gap", "10 minutes", "--sketch-rollup", "10 minutes", "--thresholds", thresholds])
    assert report(capsys, store, "arrivals").split("\n")[1].startswith("61\t0\t0\t1\t")
    assert "campaign_1\t60\t31" in report(capsys, store, "campaign-users", "--mode", "current")
    assert report(capsys, store, "late-events").strip().endswith("\t60\t60\t0")
    assert "lag_seconds" in report(capsys, store, "processing-lag", "--mode", "current")
    main(["calibrate", "--store", store, "--thresholds", thresholds])
    assert "version 1" in capsys.readouterr().out
    main(["compact", "--store", store, *DAYS, "--table", "campaign_metrics", "--ended", "--vacuum-hours", "0"])
    assert "campaign_metrics: 1 days" in capsys.readouterr().out
    assert "campaign_1\t60\t" in report(capsys, store, "top-campaigns", "--mode", "current")


def test_wrong_arguments_are_refused(capsys):
    for args in (["report", "weather", "--store", "x"], ["stream", "--store", "x"], []):
        with pytest.raises(SystemExit):
            main(args)
