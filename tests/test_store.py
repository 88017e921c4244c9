from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.operators import derive, parse_events, scored_rollup
from adpulse.plans import TimeRange
from adpulse.plans.backfill import backfill
from adpulse.plans.reports import REPORTS, report
from adpulse.schemas import ALERTS, CAMPAIGN, SIDE_TABLES, TABLE_COLUMNS, TABLES, TRAFFIC
from adpulse.session import session_conf
from adpulse.sources import ResultStore, SourceConfig, json_events, read_batch
from conftest import event, plan_text, records

CONFIG = PipelineConfig(window="1 hour", event_zone="+00:00")
MONTH = date(2024, 1, 1), date(2024, 2, 1)
DAY = date(2026, 1, 9)


@pytest.fixture
def store(tmp_path):
    return ResultStore(f"file://{tmp_path}/tables")


def rows_of(spark, seconds, config=CONFIG):
    scored = scored_rollup(parse_events(records(spark, [event(s) for s in seconds]), config), config=config)
    return scored.withColumn("processed_at", F.current_timestamp())


def test_a_replayed_batch_replaces_itself(spark, store):
    first, second = rows_of(spark, [1, 2]), rows_of(spark, [3])
    for _ in range(2):
        store.write(TRAFFIC, derive(first, TRAFFIC), 0, 1)
        store.write(TRAFFIC, derive(second, TRAFFIC), 1)
    assert sorted(r["total_hits"] for r in store.read(spark, TRAFFIC).collect()) == [1, 2]


def test_newest_version_of_each_row(spark, store):
    for batch, seconds in enumerate(([1], [1, 2], [1, 2, 3])):
        store.write(CAMPAIGN, derive(rows_of(spark, seconds), CAMPAIGN), batch)
    (row,) = store.current(spark, CAMPAIGN).collect()
    assert row["total_hits"] == 3
    assert store.current(spark, CAMPAIGN).columns == list(TABLE_COLUMNS[CAMPAIGN])


def test_tables_keep_their_columns_and_start_empty(spark, store):
    store.create(spark)
    for table in TABLES:
        df = store.read(spark, table)
        assert [f.name for f in df.schema] == list(TABLE_COLUMNS[table])
        assert [f.dataType.simpleString() for f in df.schema] == list(TABLE_COLUMNS[table].values())
        assert df.count() == 0
    with pytest.raises(ValueError):
        store.path("visitors")


@pytest.fixture(scope="module")
def filled(spark, sf_dir_module, tmp_path_factory):
    store = ResultStore(f"file://{tmp_path_factory.mktemp('store')}/tables")
    backfill(spark, parse_events(json_events(spark, sf_dir_module), CONFIG), store, *MONTH, config=CONFIG)
    return store


@pytest.fixture(scope="module")
def sf_dir_module():
    from conftest import SF_DIR

    return SF_DIR


def test_backfill_equals_the_derived_tables(spark, filled, sf_dir):
    scored = scored_rollup(parse_events(json_events(spark, sf_dir), CONFIG), config=CONFIG)
    for table in TABLES:
        stored = filled.read(spark, table).drop("processed_at", "timestamp")
        derived = derive(scored, table).drop("processed_at", "timestamp")
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, derived.collect()))


def test_a_time_bound_prunes_days(spark, filled):
    since = F.lit("2024-01-29 12:00:00+00:00").cast("timestamp")
    until = F.lit("2024-01-30 02:00:00+00:00").cast("timestamp")
    pruned = filled.read(spark, TRAFFIC, since, until)
    everything = filled.read(spark, TRAFFIC)
    assert "GreaterThanOrEqual(window_start" in plan_text(pruned).split("PushedFilters: [")[1].split("]")[0]
    assert days_of(pruned) == {"2024-01-29", "2024-01-30"}
    assert len(days_of(everything)) > 20
    assert len(days_of(report(spark, filled, "global-series", TimeRange.current(datetime(2024, 1, 31), 1500)))) == 2
    expected = everything.where((F.col("window_start") >= since) & (F.col("window_start") <= until))
    assert pruned.count() == expected.count() > 0


def days_of(rows):
    """Days whose files are listed for ``rows``."""
    return {name.split("window_date=")[1][:10] for name in rows.inputFiles()}


def hits(spark, store):
    return sorted(r["total_hits"] for r in store.read(spark, TRAFFIC).collect())


def parsed(spark, *lines):
    return parse_events(records(spark, list(lines)), CONFIG)


def on(day, count=1):
    return [event(s, timestamp=f"{day} 10:00:00.{s:03d}") for s in range(count)]


def test_backfills_replace_their_days_only(spark, store):
    after = DAY + timedelta(days=1)
    backfill(spark, parsed(spark, *on(DAY, 2)), store, DAY, after, [TRAFFIC], CONFIG)
    backfill(spark, parsed(spark, *on(DAY, 5), *on(after, 3)), store, after, after + timedelta(days=1), [TRAFFIC], CONFIG)
    assert hits(spark, store) == [2, 3]
    for _ in range(2):
        backfill(spark, parsed(spark, *on(DAY, 4)), store, DAY, after, [TRAFFIC], CONFIG)
        assert hits(spark, store) == [3, 4]


def test_a_backfill_replaces_the_rows_of_streams(spark, store):
    for writer, count in (("a", 1), ("b", 2)):
        rows = scored_rollup(parsed(spark, *on(DAY, count)), config=CONFIG).withColumn("processed_at", F.current_timestamp())
        store.write(TRAFFIC, derive(rows, TRAFFIC), 0, 1, writer)
    assert hits(spark, store) == [1, 2]  # two jobs, both with a batch 0
    interval = DAY, DAY + timedelta(days=1)
    backfill(spark, parsed(spark, *on(DAY, 3)), store, *interval, [TRAFFIC], CONFIG)
    assert hits(spark, store) == [3]
    # A recomputed day without rows is empty, and stays replaceable.
    backfill(spark, parsed(spark, "nope"), store, *interval, [TRAFFIC], CONFIG)
    assert hits(spark, store) == [] and store.newest(spark, TRAFFIC).first()[0] is None
    backfill(spark, parsed(spark, *on(DAY, 6)), store, *interval, [TRAFFIC], CONFIG)
    assert hits(spark, store) == [6] and store.newest(spark, TRAFFIC).first()[0] is not None


def test_only_whole_days_that_are_over_are_recomputed(spark, store):
    events, today = parsed(spark, event(1)), datetime.now().date()
    for since, until in (
        (DAY, DAY), (today, today + timedelta(days=2)), (datetime(2026, 1, 9, 10), datetime(2026, 1, 9, 11)), ("2026-01-09", DAY),
    ):
        with pytest.raises(ValueError):
            backfill(spark, events, store, since, until, [TRAFFIC], CONFIG)


def test_a_table_that_was_never_made_is_an_error(spark, store):
    with pytest.raises(FileNotFoundError):
        store.read(spark, TRAFFIC)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_days_do_not_depend_on_the_session_zone(spark, filled, zone):
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        since = F.lit("2024-01-10 23:00:00+00:00").cast("timestamp")
        bounded = filled.read(spark, TRAFFIC, since=since).count()
        plain = filled.read(spark, TRAFFIC).where(F.col("window_start") >= since).count()
        newest = filled.read(spark, TRAFFIC).agg(F.max("window_start")).first()[0]
        found = filled.newest(spark, TRAFFIC).first()[0]
    assert bounded == plain > 0
    assert found == newest


def test_narrow_reads_touch_few_columns(spark, filled):
    plan = plan_text(filled.read(spark, CAMPAIGN).select("campaign_id", "total_hits", "unique_users"))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<campaign_id:string,unique_users:bigint,total_hits:bigint>"


def test_every_report_runs_on_stored_tables(spark, filled):
    as_of = datetime(2024, 1, 31, 0, 5)
    filled.create(spark, SIDE_TABLES)  # not filled by a backfill
    for time_range in (TimeRange.auto(as_of, 1440 * 20, 120), TimeRange.historical(as_of, 24, 0, 1440 * 20)):
        for name in REPORTS:
            rows = report(spark, filled, name, time_range, "campaign_2", "+02:00").collect()
            assert rows or name in ("alerts", "campaign-users", "low-and-slow", "arrival-rate", "late-events")
    with pytest.raises(ValueError):
        report(spark, filled, "weather", TimeRange.current(as_of))
    with pytest.raises(ValueError):
        report(spark, filled, "campaign-series", TimeRange.current(as_of))


def test_tables_as_views(spark, filled):
    filled.create_views(spark)
    total = spark.sql(f"SELECT sum(total_hits) FROM {TRAFFIC}").first()[0]
    assert total == spark.sql(f"SELECT sum(total_hits) FROM {CAMPAIGN}").first()[0]
    assert spark.sql(f"SELECT count(*) FROM {ALERTS}").first()[0] >= 0


def test_sources_are_reduced_to_their_value(spark, tmp_path):
    path = f"{tmp_path}/in"
    records(spark, [event(1), "nope"]).coalesce(1).write.text(path)
    df = read_batch(spark, SourceConfig.json_lines(path))
    assert df.dtypes == [("value", "binary")]
    assert parse_events(df).where("is_malformed = 0").count() == 1


def test_topic_options():
    kafka = SourceConfig.kafka("broker:9092", "ads", max_records_per_trigger=1000, minPartitions="64")
    assert kafka.options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "ads",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "maxOffsetsPerTrigger" not in SourceConfig.kafka("broker:9092", "ads").options


# -- commits -----------------------------------------------------------------------------------------------------


def _batches(spark, store, table=CAMPAIGN, writer="w", days=(9, 10, 11), batches=3):
    """One row per day and batch."""
    for batch in range(batches):
        lines = [event(batch + 1, timestamp=f"2026-01-{day:02d} 10:00:0{batch + 1}.000") for day in days]
        scored = scored_rollup(parse_events(records(spark, lines), CONFIG), config=CONFIG)
        store.write(table, derive(scored.withColumn("processed_at", F.current_timestamp()), table), batch, writer=writer)


def _per_day(spark, store, table=CAMPAIGN):
    days = store.read(spark, table).groupBy(F.to_date("window_start").alias("day")).agg(F.count("*").alias("n"), F.sum("total_hits").alias("hits"))
    return {r["day"].day: (r["n"], r["hits"]) for r in days.collect()}


def test_readers_see_a_replacement_whole_or_not_at_all(spark, store, monkeypatch):
    for table in (CAMPAIGN, TRAFFIC):
        _batches(spark, store, table)
    old = {table: _per_day(spark, store, table) for table in (CAMPAIGN, TRAFFIC)}
    scored = scored_rollup(parse_events(records(spark, [event(1), event(2)]), CONFIG), config=CONFIG).withColumn("processed_at", F.current_timestamp())
    new = {table: derive(scored, table) for table in (CAMPAIGN, TRAFFIC)}
    interval = date(2026, 1, 9), date(2026, 1, 11)
    written = []
    overwrite = ResultStore._overwrite

    def fail_between(self, table, placed):
        written.append(table)
        if len(written) == 2:
            raise OSError("no space")
        overwrite(self, table, placed)
        assert {t: _per_day(spark, store, t) for t in old} == old

    monkeypatch.setattr(ResultStore, "_overwrite", fail_between)
    with pytest.raises(OSError):
        store.replace_days_of(new, *interval, spark)
    monkeypatch.undo()
    assert {t: _per_day(spark, store, t) for t in old} == old

    def lose_driver(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(ResultStore, "_commit", lose_driver)
    with pytest.raises(OSError):
        store.replace_days_of(new, *interval, spark)
    monkeypatch.undo()
    assert {t: _per_day(spark, store, t) for t in old} == old
    store.replace_days_of(new, *interval, spark)
    for table in old:
        assert _per_day(spark, store, table) == {9: (1, 2), 11: old[table][11]}
    # Folders of the failed runs are not named by any commit.
    assert store.vacuum(spark, CAMPAIGN, timedelta(0)) > 0
    assert _per_day(spark, store) == {9: (1, 2), 11: old[CAMPAIGN][11]}


def test_a_commit_number_is_taken_once(spark, store):
    from adpulse.sources import folders

    path = f"{store.base}/_commits/0000000001.json"
    assert folders.create_new(spark, path, "{}") and not folders.create_new(spark, path, "{1}")
    assert folders.read_text(spark, path) == "{}" and folders.children(spark, f"{store.base}/_commits") == ["0000000001.json"]


def test_replacements_of_two_writers_both_stand(spark, store, monkeypatch):
    from adpulse.sources import folders

    _batches(spark, store)

    def day(n):
        start = F.expr(f"timestamp'2026-01-{n:02d} 10:00:00+00:00'")
        return derive(rows_of(spark, [n]).withColumn("window_start", start), CAMPAIGN)

    create_new, rivals = folders.create_new, []

    def overtaken(spark_, path, text):
        if not rivals:
            rivals.append(path)
            store.replace_days(CAMPAIGN, day(10), date(2026, 1, 10), date(2026, 1, 11))
        return create_new(spark_, path, text)

    monkeypatch.setattr(folders, "create_new", overtaken)
    store.replace_days(CAMPAIGN, day(9), date(2026, 1, 9), date(2026, 1, 10))
    assert _per_day(spark, store) == {9: (1, 1), 10: (1, 1), 11: (3, 3)}
    assert len(folders.children(spark, f"{store.base}/_commits")) == 2


def test_compaction_keeps_what_readers_see(spark, store):
    _batches(spark, store, writer="a")
    _batches(spark, store, writer="b", batches=2)
    month = date(2026, 1, 1), date(2026, 2, 1)
    before = sorted(map(repr, store.read(spark, CAMPAIGN).collect()))
    assert store.compact(spark, CAMPAIGN, *month) == 3
    assert sorted(map(repr, store.read(spark, CAMPAIGN).collect())) == before
    # The newest batch of each writer is left alone: one file per day for the others.
    assert len(store.read(spark, CAMPAIGN).inputFiles()) == 3 * (1 + 2)
    assert store.compact(spark, CAMPAIGN, *month) == 0
    # A replayed covered batch changes nothing, a later one adds.
    _batches(spark, store, writer="a", batches=1)
    assert sorted(map(repr, store.read(spark, CAMPAIGN).collect())) == before
    assert len(store.read(spark, CAMPAIGN).collect()) == 15
    _batches(spark, store, writer="a", batches=4)
    assert len(store.read(spark, CAMPAIGN).collect()) == 18
    assert store.compact(spark, CAMPAIGN, *month, ended=True) == 3
    assert len(store.read(spark, CAMPAIGN).inputFiles()) == 3 and store.read(spark, CAMPAIGN).count() == 18
    assert store.newest(spark, CAMPAIGN).first()[0] is not None
    assert store.vacuum(spark, CAMPAIGN) == 0 and store.vacuum(spark, CAMPAIGN, timedelta(0)) > 0
    assert store.read(spark, CAMPAIGN).count() == 18 and store.hidden_batches(spark, CAMPAIGN) == []


def test_compaction_notices_a_change_in_between(spark, store, monkeypatch):
    from adpulse.sources.store import CommitConflict

    _batches(spark, store)
    generation = ResultStore._write_generation
    raced = []

    def race(self, spark_, table, placed, name):
        out = generation(self, spark_, table, placed, name)
        if not raced:
            raced.append(name)
            store.replace_days(CAMPAIGN, derive(rows_of(spark, [1, 2, 3]), CAMPAIGN), DAY, date(2026, 1, 10))
        return out

    monkeypatch.setattr(ResultStore, "_write_generation", race)
    with pytest.raises(CommitConflict, match="2026-01-09"):
        store.compact(spark, CAMPAIGN, date(2026, 1, 1), date(2026, 2, 1))
    assert _per_day(spark, store) == {9: (1, 3), 10: (3, 3), 11: (3, 3)}


def test_compaction_of_updated_tables_keeps_newest_versions(spark, store):
    for batch, seconds in enumerate(([1], [1, 2], [1, 2, 3])):
        store.write(CAMPAIGN, derive(rows_of(spark, seconds), CAMPAIGN), batch)
    store.compact(spark, CAMPAIGN, DAY, date(2026, 1, 10), latest_only=True, ended=True)
    assert [r["total_hits"] for r in store.read(spark, CAMPAIGN).collect()] == [3]
    store.write(CAMPAIGN, derive(rows_of(spark, [1, 2, 3, 4]), CAMPAIGN), 3)
    assert [r["total_hits"] for r in store.current(spark, CAMPAIGN).collect()] == [4]


def test_rows_hidden_by_a_recomputation_are_named(spark, store):
    _batches(spark, store, days=(9,))
    store.replace_days(CAMPAIGN, derive(rows_of(spark, [1]), CAMPAIGN), DAY, date(2026, 1, 10))
    assert store.hidden_batches(spark, CAMPAIGN) == []
    _batches(spark, store, days=(9,), batches=5)
    assert store.hidden_batches(spark, CAMPAIGN) == [(DAY, "w", 3), (DAY, "w", 4)]
    assert _per_day(spark, store) == {9: (1, 1)}
