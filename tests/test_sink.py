"""Writes to the sink table: what changes, what must not, and what a failure leaves behind."""

import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures_small import TODAY, as_set, at_age, by_age, pending
from tidemark.operators import sink
from tidemark.operators.settle import settle
from tidemark.operators.sink import DateOutcome, append, full_load, replace_partitions, stage, update_rows
from tidemark.schema import SHIPMENT_SPECS, STORED_COLUMNS, create_table, drop_table
from tidemark.sources.tables import scan_date, scan_window, shipments
from tidemark.functions.dates import Window


@pytest.fixture
def table(spark):
    name = f"sink_{uuid.uuid4().hex}"
    yield name
    drop_table(spark, name)


def stored(spark, table):
    return as_set(spark.table(table))


def files_of(spark, table):
    location = next(
        r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location"
    )
    return sorted(Path(location.removeprefix("file:")).rglob("*.parquet"))


def test_create_is_idempotent_and_typed(spark, table):
    create_table(spark, table)
    create_table(spark, table)
    types = {f.name: f.dataType for f in spark.table(table).schema}
    assert types == {s.name: s.data_type for s in SHIPMENT_SPECS}
    assert drop_table(spark, table) and not drop_table(spark, table)


def test_table_defaults(spark, table):
    create_table(spark, table)
    spark.sql(
        f"INSERT INTO {table} (shipment_id, carrier_code, origin_region, destination_region, "
        "estimated_cost, weight_lbs, payload, shipment_date) "
        "VALUES (1, 'CAR-A', 'North', 'West', 1.00, 2.00, 'p', DATE'2024-01-01')"
    )
    row = spark.table(table).first()
    assert (row.record_version, row.settlement_status, row.actual_cost) == (1, "Pending", None)


def test_full_load_only_into_a_new_table(spark, table):
    rows = by_age(spark, {1: 3, 80: 2})
    full_load(rows, table)
    assert stored(spark, table) == as_set(rows)
    with pytest.raises(ValueError, match="already holds data"):
        full_load(rows, table)


def test_append_keeps_what_is_there(spark, table):
    rows = by_age(spark, {1: 3, 80: 2})
    full_load(rows.filter("shipment_id < 3"), table)
    append(rows.filter("shipment_id >= 3"), table)
    assert stored(spark, table) == as_set(rows)


@pytest.mark.parametrize("clustered", [False, True])
def test_replace_touches_only_its_dates(spark, table, clustered):
    old = by_age(spark, {1: 3, 2: 2, 80: 2})
    full_load(old, table)
    new = settle(by_age(spark, {1: 5, 2: 4, 3: 1, 80: 9}), TODAY)
    dates = [at_age(1), at_age(3)]
    outcome = replace_partitions(new, table, dates, clustered)
    assert outcome == [
        DateOutcome(at_age(1), 5, "REPLACED"),
        DateOutcome(at_age(3), 1, "REPLACED"),
    ]
    wanted = F.col("shipment_date").isin(dates)
    assert stored(spark, table) == sorted(as_set(new.filter(wanted)) + as_set(old.filter(~wanted)))


def test_replace_twice_is_replace_once(spark, table):
    full_load(by_age(spark, {1: 3, 80: 2}), table)
    new = settle(by_age(spark, {1: 5, 2: 1}), TODAY)
    replace_partitions(new, table, [at_age(1), at_age(2)])
    first, files = stored(spark, table), len(files_of(spark, table))
    replace_partitions(new, table, [at_age(1), at_age(2)])
    assert stored(spark, table) == first
    assert len(files_of(spark, table)) == files


def test_emptied_date_is_cleared_and_can_be_filled_again(spark, table):
    rows = by_age(spark, {1: 3, 2: 2})
    full_load(rows, table)
    outcome = replace_partitions(rows.filter("shipment_id > 3"), table, [at_age(1), at_age(5)])
    assert outcome == [DateOutcome(at_age(1), 0, "CLEARED"), DateOutcome(at_age(5), 0, "ABSENT")]
    assert stored(spark, table) == as_set(rows.filter("shipment_id > 3"))
    append(rows.filter("shipment_id = 1"), table)
    assert stored(spark, table) == as_set(rows.filter("shipment_id = 1 OR shipment_id > 3"))
    replace_partitions(rows, table, [at_age(1)])
    assert stored(spark, table) == as_set(rows)


def test_replaced_date_that_was_appended_to_keeps_no_old_file(spark, table):
    rows = by_age(spark, {1: 4})
    create_table(spark, table)
    append(rows.filter("shipment_id <= 2"), table)
    append(rows.filter("shipment_id > 2"), table)
    replace_partitions(rows.filter("shipment_id = 1"), table, [at_age(1)])
    assert stored(spark, table) == as_set(rows.filter("shipment_id = 1"))
    assert len(files_of(spark, table)) == 1
    append(rows.filter("shipment_id > 1"), table)
    assert stored(spark, table) == as_set(rows)


def test_failing_write_leaves_every_date_as_it_was(spark, table):
    rows = by_age(spark, {1: 30, 2: 30})
    full_load(rows, table)
    before = stored(spark, table)
    broken = settle(rows, TODAY).withColumn(
        "payload", F.when(F.col("shipment_id") == 45, F.lit(None)).otherwise(F.col("payload"))
    )
    with pytest.raises(Exception, match="payload is null"):
        replace_partitions(broken, table, [at_age(1), at_age(2)])
    assert stored(spark, table) == before
    replace_partitions(settle(rows, TODAY), table, [at_age(1), at_age(2)])
    assert stored(spark, table) == as_set(settle(rows, TODAY))


def test_nothing_published_while_staging(spark, table, tmp_path):
    rows = by_age(spark, {1: 3})
    full_load(rows, table)
    staged = stage(settle(rows, TODAY), str(tmp_path / "staged"))
    assert stored(spark, table) == as_set(rows)
    assert staged.rows_per_date(spark) == {at_age(1): 3}


def test_replace_from_the_table_itself(spark, table):
    rows = by_age(spark, {1: 3, 2: 2})
    full_load(rows, table)
    replace_partitions(settle(shipments(spark, table), TODAY), table, [at_age(1)], clustered=True)
    assert Counter(r.record_version for r in spark.table(table).collect()) == {1: 2, 2: 3}


def test_update_rewrites_only_matching_dates(spark, table):
    rows = by_age(spark, {1: 3, 2: 2, 3: 1})
    full_load(rows, table)
    untouched = {f for f in files_of(spark, table) if at_age(2).isoformat() not in str(f)}
    changed = update_rows(
        spark,
        table,
        (F.col("shipment_date") == F.lit(at_age(2))) & (F.col("shipment_id") == 4),
        {"record_version": F.lit(2), "actual_cost": (F.col("estimated_cost") * 2).cast("decimal(18,2)")},
    )
    assert changed == {at_age(2): 1}
    assert {r.shipment_id: r.record_version for r in spark.table(table).collect()} == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1}
    assert untouched <= set(files_of(spark, table))
    assert update_rows(spark, table, F.col("record_version") == 9, {"record_version": F.lit(1)}) == {}


def test_hot_date_is_split_over_files(spark, table):
    rows = pending(spark, [(1, at_age(1)), (2, at_age(2))])
    many = spark.range(200_000).select(F.col("id").alias("shipment_id"))
    hot = many.crossJoin(rows.limit(1).drop("shipment_id")).withColumn(
        "shipment_date", F.when(F.col("shipment_id") % 3 == 0, F.lit(at_age(1))).otherwise(
            F.date_sub(F.lit(at_age(2)), (F.col("shipment_id") % 20).cast("int"))
        )
    ).withColumn("payload", F.sha2(F.col("shipment_id").cast("string"), 256)).repartition(8)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "512k")
    try:
        full_load(hot, table)
    finally:
        spark.conf.set(setting, before)
    per_date = Counter(f.parent.name for f in files_of(spark, table))
    assert per_date[f"shipment_date={at_age(1)}"] > 2
    assert spark.table(table).count() == 200_000


def test_scans_prune_partitions_and_columns(spark, table):
    full_load(by_age(spark, {1: 1, 2: 1, 3: 1}), table)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    one = scan_date(spark.table(table), at_age(2).isoformat())
    assert f"= {at_age(2)}" in plan(one).split("PartitionFilters")[1].split("]")[0]
    window = scan_window(spark.table(table), Window(at_age(2), at_age(1))).groupBy("shipment_date").agg(
        F.max("record_version")
    )
    assert "ReadSchema: struct<record_version:int>" in plan(window)
    assert window.count() == 2


def test_load_lost_between_two_batches_is_completed_by_running_it_again(spark, table, monkeypatch):
    rows = by_age(spark, {1: 3, 2: 2, 80: 2})
    add, batches = sink._add_partitions, []

    def lost(*args):
        batches.append(args)
        if len(batches) == 2:
            raise RuntimeError("driver lost")
        add(*args)

    monkeypatch.setattr(sink, "_PARTITIONS_PER_STATEMENT", 1)
    monkeypatch.setattr(sink, "_add_partitions", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        full_load(rows, table)
    assert 0 < spark.table(table).count() < 7
    monkeypatch.setattr(sink, "_add_partitions", add)
    full_load(rows, table)
    assert stored(spark, table) == as_set(rows)
    assert len({f.parent.name for f in files_of(spark, table)}) == 3
    assert len({f.parent.parent for f in files_of(spark, table)}) == 1
    with pytest.raises(ValueError, match="already holds data"):
        full_load(rows, table)


def test_lost_staging_leaves_nothing_after_the_next_run(spark, table, monkeypatch):
    rows = by_age(spark, {1: 3, 2: 2})
    full_load(rows, table)
    publish = sink.publish
    monkeypatch.setattr(sink, "publish", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replace_partitions(rows, table, [at_age(1), at_age(2)])
    monkeypatch.setattr(sink, "publish", publish)
    assert len({f.parent.parent for f in files_of(spark, table)}) == 2
    replace_partitions(rows, table, [at_age(2)])
    used = {Path(f.removeprefix("file:").replace("//", "")) for f in spark.table(table).inputFiles()}
    assert set(files_of(spark, table)) == used
    assert stored(spark, table) == as_set(rows)


def test_run_lost_while_publishing_keeps_what_is_in_use(spark, table, monkeypatch):
    rows = by_age(spark, {1: 3, 2: 2})
    full_load(rows, table)
    folder = sink._date_folder
    monkeypatch.setattr(sink, "_date_folder", lambda root, d: 1 / 0 if d == at_age(2) else folder(root, d))
    with pytest.raises(ZeroDivisionError):
        replace_partitions(settle(rows, TODAY), table, [at_age(1), at_age(2)])
    monkeypatch.setattr(sink, "_date_folder", folder)
    mixed = as_set(settle(rows, TODAY).filter("shipment_id <= 3")) + as_set(rows.filter("shipment_id > 3"))
    assert stored(spark, table) == sorted(mixed)
    replace_partitions(by_age(spark, {3: 1}), table, [at_age(3)])
    assert stored(spark, table) == sorted(mixed + as_set(by_age(spark, {3: 1})))
    assert len(files_of(spark, table)) == len(spark.table(table).inputFiles())


def test_retained_files_go_with_the_next_run(spark, table):
    rows = by_age(spark, {1: 3, 80: 2})
    full_load(rows, table)
    reader = spark.table(table)
    before = files_of(spark, table)
    replace_partitions(settle(rows, TODAY), table, [at_age(1)], retain=True)
    assert set(before) <= set(files_of(spark, table))
    replace_partitions(settle(rows, TODAY), table, [at_age(1)], retain=True)
    kept = set(before) & set(files_of(spark, table))
    assert {f.parent.name for f in kept} == {f"shipment_date={at_age(80)}"}
    assert reader.count() == 5


def test_listings_do_not_grow_with_the_runs(spark, table, monkeypatch):
    rows = by_age(spark, {1: 1, 2: 1})
    full_load(rows, table)
    listed, children = [], sink._HadoopPath.children
    monkeypatch.setattr(sink._HadoopPath, "children", lambda self: listed.append(self.path) or children(self))
    per_run = []
    for _ in range(6):
        listed.clear()
        replace_partitions(rows, table, [at_age(1)], clustered=True, retain=True)
        per_run.append(len(listed))
    assert per_run[1:] == per_run[1:2] * 5


def test_vacuum_removes_what_no_partition_points_at(spark, table):
    rows = by_age(spark, {1: 3, 80: 2})
    full_load(rows, table)
    location = sink._table_location(spark, table)
    stage(rows, f"{location}/_runs/lost")
    assert sink.vacuum(spark, table) == 2
    assert stored(spark, table) == as_set(rows)
    assert len(files_of(spark, table)) == len(spark.table(table).inputFiles())
    assert sink.vacuum(spark, table) == 0


def test_isolated_date_fails_alone(spark, table):
    rows = by_age(spark, {1: 3, 2: 2})
    full_load(rows, table)
    new = settle(rows, TODAY)
    broken = new.withColumn("payload", F.when(F.col("shipment_id") <= 2, F.lit(None)).otherwise(F.col("payload")))
    outcome = replace_partitions(broken, table, [at_age(1), at_age(2), at_age(3)], isolate=True)
    assert outcome == [
        DateOutcome(at_age(1), 0, "FAILED", 2, "payload is null"),
        DateOutcome(at_age(2), 2, "REPLACED"),
        DateOutcome(at_age(3), 0, "ABSENT"),
    ]
    assert stored(spark, table) == sorted(as_set(rows.filter("shipment_id <= 3")) + as_set(new.filter("shipment_id > 3")))
    assert spark.table(table).columns == list(STORED_COLUMNS)
    assert len(files_of(spark, table)) == len(spark.table(table).inputFiles())
