"""Ids over many nights, the digest ledger, set reconciliation, loads that stop and reads that fail."""

import sys
import threading
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import tidemark.operators.sink as sink_module
from fixtures_small import TODAY, as_set, at_age, by_age
from tidemark.functions.dates import lookback_window
from tidemark.operators import profile, profile_states, setdiff
from tidemark.operators.arrivals import arrive, nightly_arrivals
from tidemark.operators.ids import LARGEST_ID, IdLedger
from tidemark.operators.ledger import DATE, MONTH, TABLE, DigestLedger, date_files
from tidemark.operators.profile import date_checksums
from tidemark.operators.profile_states import ProfileStates
from tidemark.operators.reconcile import row_differences
from tidemark.operators.setdiff import sparse_row_differences
from tidemark.operators.sink import append, full_load, replace_partitions
from tidemark.plans.load import LoadProgress, batches, resumable_load
from tidemark.plans.rebuild import rebuild, rebuild_dates
from tidemark.schema import create_table
from tidemark.session import scratch_path
from tidemark.sources.tables import shipments

# The package exports a function of the module's name.
rebuild_module = sys.modules["tidemark.plans.rebuild"]


@pytest.fixture
def table(spark, request):
    name = f"maintained_{request.node.name.split('[')[0]}_{abs(hash(request.node.name)) % 10**6}"
    create_table(spark, name, scratch_path(spark, name))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def one_task(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def _failing_on(df, *dates):
    broken = F.col("shipment_date").isin([F.lit(d) for d in dates])
    return df.withColumn("payload", F.when(broken, F.raise_error(F.lit("unreadable block")).cast("string")).otherwise(F.col("payload")))


# Ids


def test_sixty_nights_of_ids(spark, table, one_task):
    append(by_age(spark, {0: 3, 1: 2, 90: 4}), table)
    largest = shipments(spark, table).agg(F.max("shipment_id")).first()[0]
    ids = IdLedger(spark, f"{table}_ids")
    ids.start(largest)
    for night in range(60):
        assert arrive(spark, table, TODAY + timedelta(days=night), ids) == 3
    rows = shipments(spark, table).filter(F.col("shipment_date") > F.lit(TODAY))
    found = [(r.shipment_date, r.shipment_id) for r in rows.orderBy("shipment_id").collect()]
    assert [i for _, i in found] == list(range(largest + 1, largest + 181))
    assert found == sorted(found)
    assert ids.high_water() == largest + 180


def test_a_night_run_again_adds_nothing(spark, table):
    append(by_age(spark, {0: 3}), table)
    ids = IdLedger(spark, f"{table}_ids")
    ids.start(10**6)
    assert arrive(spark, table, TODAY, ids, rows=2) == 2
    assert arrive(spark, table, TODAY, ids, rows=2) == 0
    assert ids.high_water() == 10**6 + 2


def test_a_lost_night_gets_its_range_again(spark, table):
    ids = IdLedger(spark, f"{table}_ids")
    with pytest.raises(Exception):
        ids.high_water()
    ids.start(5)
    ids.start(99)
    assert ids.high_water() == 5
    assert ids.reserve(TODAY, 10) == 6
    assert ids.reserve(TODAY, 10) == ids.reserve(TODAY, 4) == 6
    assert ids.reserve(TODAY, 11) == 16
    assert ids.reserve(TODAY, 0) == 16 or ids.high_water() == 26
    with pytest.raises(OverflowError):
        ids.reserve(TODAY + timedelta(days=1), LARGEST_ID)


def test_offsets_of_chained_nights_do_not_double(spark):
    known = by_age(spark, {0: 3, 5: 2})
    for night in range(4):
        known = known.unionByName(nightly_arrivals(known, TODAY + timedelta(days=night))).localCheckpoint()
    ids = [r.shipment_id for r in known.collect()]
    assert len(set(ids)) == len(ids) == 17 and max(ids) < 5 * 900_000_000


def test_arrivals_without_seeds(spark, table):
    ids = IdLedger(spark, f"{table}_ids")
    ids.start(0)
    assert arrive(spark, table, TODAY, ids) == 0
    append(by_age(spark, {-5: 2}), table)
    assert arrive(spark, table, TODAY, ids) == 0


# Digest ledger


@pytest.fixture
def recorded(spark, table):
    append(by_age(spark, {age: 3 for age in range(1, 130, 4)}), table)
    ledger = DigestLedger(spark, table, f"{table}_digests")
    return ledger, ledger.start()


def test_ledger_holds_what_the_table_holds(spark, recorded):
    ledger, version = recorded
    stored = {r.shipment_date: tuple(r)[1:] for r in date_checksums(shipments(spark, ledger.sink)).collect()}
    names = ("row_count", "hash_xor", "hash_sum", "estimated_total", "actual_total")
    nodes = {r.node: tuple(r[n] for n in names) for r in ledger.nodes(DATE).collect()}
    assert nodes == stored
    root = ledger.nodes(TABLE).first()
    assert root.row_count == sum(v[0] for v in stored.values())
    assert root.row_count == sum(r.row_count for r in ledger.nodes(MONTH).collect())
    assert ledger.start() == version and ledger.unrecorded() == []


def test_an_unchanged_table_is_not_read(spark, recorded, monkeypatch):
    ledger, version = recorded
    monkeypatch.setattr(DigestLedger, "_held", lambda *_: pytest.fail("the sink was read"))
    changes = ledger.changes(TODAY, version)
    assert changes.count() == 0
    assert not any(ledger.sink + "/" in path for path in changes.inputFiles())


def test_only_changed_dates_are_read(spark, recorded, monkeypatch):
    ledger, version = recorded
    rows = shipments(spark, ledger.sink)
    same, fewer, gone, window = at_age(81), at_age(85), at_age(89), at_age(5)
    lost = (F.col("shipment_date") == F.lit(fewer)) & (F.col("shipment_id") % 2 == 0)
    source = rows.filter(~lost & (F.col("shipment_date") != F.lit(gone)))
    replace_partitions(source, ledger.sink, [same, fewer, gone, window])
    assert ledger.unrecorded() == sorted([same, fewer, gone, window])
    read = []
    held = DigestLedger._held
    monkeypatch.setattr(DigestLedger, "_held", lambda self, dates: read.extend(dates) or held(self, dates))
    found = {r[0]: (r[1], r[2]) for r in ledger.changes(at_age(60), version).collect()}
    left = shipments(spark, ledger.sink).filter(F.col("shipment_date") == F.lit(fewer)).count()
    assert found == {fewer: (3, left), gone: (3, None)}
    assert set(read) == {same, fewer, gone}


def test_recorded_changes_need_no_read_at_all(spark, recorded, monkeypatch):
    ledger, version = recorded
    source = shipments(spark, ledger.sink).withColumn("estimated_cost", F.col("estimated_cost") + 1)
    rebuild_dates(source, ledger.sink, [at_age(81), at_age(1)], ledger=ledger)
    assert ledger.version() == version + 1 and ledger.unrecorded() == []
    monkeypatch.setattr(DigestLedger, "_held", lambda *_: pytest.fail("the sink was read"))
    assert [tuple(r) for r in ledger.changes(at_age(60), version).collect()] == [(at_age(81), 3, 3)]
    assert ledger.changes(at_age(60), ledger.version()).count() == 0


def test_a_row_stored_twice_is_a_change(spark, recorded):
    ledger, version = recorded
    rows = shipments(spark, ledger.sink).filter(F.col("shipment_date") == F.lit(at_age(81)))
    replace_partitions(rows.unionByName(rows), ledger.sink, [at_age(81)])
    assert [tuple(r) for r in ledger.changes(TODAY, version).collect()] == [(at_age(81), 3, 6)]


def test_file_lists_are_listed_not_read(spark, recorded):
    ledger, _ = recorded
    listed = date_files(spark, ledger.sink, [at_age(81), at_age(85)])
    assert {r.node for r in listed.collect()} == {at_age(81), at_age(85)}
    assert not any(ledger.sink + "/" in path for path in listed.inputFiles())


# Set reconciliation


def _many(spark, rows=600, days=3):
    ids = spark.range(1, rows + 1).withColumnRenamed("id", "shipment_id")
    model = by_age(spark, {1: 1}).drop("shipment_id", "shipment_date")
    day = F.date_sub(F.lit(TODAY), (F.col("shipment_id") % days).cast("int"))
    return ids.crossJoin(model).withColumn("shipment_date", day).withColumn("payload", F.concat(F.lit("P"), F.col("shipment_id")))


def _odd(source, sink):
    """Repeated rows, ids on several dates, lost, new and changed rows."""
    k = F.col("shipment_id")
    sink = sink.filter(k % 97 != 0).withColumn("payload", F.when(k % 89 == 0, F.lit("new")).otherwise(F.col("payload")))
    twice = source.filter(k % 83 == 0)
    moved = source.filter(k % 79 == 0).withColumn("shipment_date", F.lit(TODAY))
    return source.unionByName(twice).unionByName(twice), sink.unionByName(moved)


@pytest.mark.parametrize("cells", [setdiff.CELLS, (96,), (12,), ()])
def test_sparse_differences_are_the_full_ones(spark, cells):
    """Whatever tables there are: they are emptied, grow, or leave the dates to the grouping."""
    source, sink = _odd(_many(spark), _many(spark))
    negative = source.filter("shipment_id < 40").withColumn("shipment_id", -F.col("shipment_id") * 2**40)
    source = source.unionByName(negative)
    expected = row_differences(source, sink)
    assert expected.count() > 30
    found = sparse_row_differences(source, sink, cells)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))


def test_equal_sides_shuffle_no_rows(spark):
    rows = _many(spark)
    assert sparse_row_differences(rows, rows.repartition(3)).count() == 0
    assert sparse_row_differences(rows, rows.limit(0)).count() == 600


def test_rows_without_id_are_compared(spark):
    rows = _many(spark, 30)
    nameless = rows.limit(2).withColumn("shipment_id", F.lit(None).cast("bigint"))
    found = sparse_row_differences(rows.unionByName(nameless), rows).collect()
    assert [(r.shipment_id, r.rows_source, r.rows_sink) for r in found] == [(None, 2, 0)]


@pytest.fixture
def tables(monkeypatch):
    """Sizes of the tables that were filed."""
    sizes, peeled = [], setdiff._peeled
    monkeypatch.setattr(setdiff, "_peeled", lambda sides, dates, size: sizes.append(size) or peeled(sides, dates, size))
    return sizes


@pytest.mark.parametrize("cells", [setdiff.CELLS, (96,), (12,)])
def test_tables_give_the_full_differences(spark, monkeypatch, tables, cells):
    monkeypatch.setattr(setdiff, "CELLS_PER_ROW", 1_000)
    source, sink = _odd(_many(spark), _many(spark))
    found = sparse_row_differences(source, sink, cells)
    assert tables
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, row_differences(source, sink).collect()))


@pytest.mark.parametrize("parts, filed", [(1, [96]), (64, [])])
def test_tables_are_filed_where_their_cells_are_few(spark, tables, parts, filed):
    """Every task that holds rows of a date sends cells of its own."""
    rows = _many(spark, 3_000, 1).coalesce(1)
    source = rows.repartition(parts) if parts > 1 else rows
    found = sparse_row_differences(source, source.filter("shipment_id > 5")).collect()
    assert sorted(r.shipment_id for r in found) == [1, 2, 3, 4, 5] and tables == filed


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString().count("LeftSemi")


def test_many_differences_are_grouped_without_a_join(spark, monkeypatch, tables):
    rows = _many(spark)
    sink = rows.filter("shipment_id % 2 = 0")
    found = sparse_row_differences(rows, sink)
    assert _joins(found) == 0 and tables == [] and found.count() == 300
    few = sparse_row_differences(rows, rows.filter("shipment_id > 1"))
    assert _joins(few) == 2 and few.count() == 1
    monkeypatch.setattr(setdiff, "IDS_SENT", 0)
    more = sparse_row_differences(rows, rows.filter("shipment_id > 1"))
    assert _joins(more) == 0 and more.count() == 1


def test_rows_without_date_are_compared_where_they_differ(spark):
    rows = _many(spark, 30)
    undated = rows.limit(2).withColumn("shipment_date", F.lit(None).cast("date"))
    twice = undated.unionByName(undated)
    for source, sink in ((undated, undated.limit(0)), (undated, undated), (twice, undated), (undated.limit(0), twice)):
        source, sink = rows.unionByName(source), rows.unionByName(sink)
        found = sparse_row_differences(source, sink).collect()
        assert Counter(map(tuple, found)) == Counter(map(tuple, row_differences(source, sink).collect()))


@pytest.mark.parametrize("differences", [5, 60, 500])
def test_tables_are_emptied_at_their_load(spark, differences):
    source = _many(spark, 40_000, 1)
    sink = source.filter(F.col("shipment_id") > differences)
    size = next(c for c in setdiff.CELLS if differences <= setdiff.LOAD * c)
    peeled = setdiff._peeled([source, sink], [TODAY], size).collect()
    assert sorted(r.shipment_id for r in peeled) == list(range(1, differences + 1))
    assert all(r.emptied for r in peeled)


def test_a_table_too_small_says_so(spark):
    source = _many(spark, 3_000, 1)
    peeled = setdiff._peeled([source, source.filter("shipment_id > 900")], [TODAY], 96).collect()
    assert [(r.shipment_id, r.emptied) for r in peeled] == [(None, False)]


# Loads


def test_a_stopped_load_goes_on(spark, table, monkeypatch):
    source = by_age(spark, {age: 5 for age in range(40)})
    progress = LoadProgress(spark, f"{table}_progress")
    with pytest.raises(Exception, match="unreadable"):
        resumable_load(_failing_on(source, at_age(19)), table, progress, rows_per_batch=20)
    stored = shipments(spark, table).count()
    assert stored == 100
    staged = []
    replace = replace_partitions
    monkeypatch.setattr("tidemark.plans.load.replace_partitions", lambda df, t, dates, c: staged.extend(dates) or replace(df, t, dates, c))
    resumed = resumable_load(source, table, progress, rows_per_batch=20)
    assert sum(b.rows for b in resumed) == 100 and sorted(staged) == [at_age(age) for age in range(19, -1, -1)]
    assert as_set(shipments(spark, table)) == as_set(source)
    assert resumable_load(source, table, progress, rows_per_batch=20) == []


def test_a_batch_lost_while_published_is_replaced(spark, table):
    source = by_age(spark, {age: 5 for age in range(8)})
    progress = LoadProgress(spark, f"{table}_progress")
    append(source.filter(F.col("shipment_date") == F.lit(at_age(7))).limit(2), table)
    resumable_load(source, table, progress, rows_per_batch=20)
    assert as_set(shipments(spark, table)) == as_set(source)


def test_loads_of_several_sinks_share_a_ledger(spark, table):
    source = by_age(spark, {1: 2})
    progress = LoadProgress(spark, f"{table}_progress")
    assert len(resumable_load(source, table, progress)) == 1
    assert len(resumable_load(source, f"{table}_b", progress)) == 1
    spark.sql(f"DROP TABLE {table}_b")


def test_batches_hold_whole_dates_in_order():
    days = {date(2020, 1, 1) + timedelta(days=i): n for i, n in enumerate([5, 5, 30, 1, 1, 1, 9, 0, 2])}
    cut = list(batches(days, 10))
    assert [d for b in cut for d in b.dates] == sorted(days)
    assert [b.rows for b in cut] == [10, 30, 3 + 9, 2] or sum(b.rows for b in cut) == sum(days.values())
    assert list(batches({}, 10)) == []


def test_rows_without_date_stop_a_load(spark, table):
    source = by_age(spark, {1: 2}).withColumn("shipment_date", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="shipment_date"):
        resumable_load(source, table, LoadProgress(spark, f"{table}_progress"))


# Failing reads


def test_dates_that_cannot_be_read_fail_alone(spark, table):
    old = by_age(spark, {age: 2 for age in range(1, 20)})
    append(old, table)
    new = by_age(spark, {age: 3 for age in range(1, 20)})
    broken = [at_age(4), at_age(15)]
    result = rebuild(_failing_on(new, *broken), table, TODAY, lookback_days=19)
    assert [o.shipment_date for o in result.failed()] == broken
    assert all("unreadable block" in o.problem and o.rows_written == 0 for o in result.failed())
    assert [o.shipment_date for o in result.outcomes] == [at_age(age) for age in range(1, 20)]
    with pytest.raises(ValueError, match="unreadable"):
        result.check()
    failed = F.col("shipment_date").isin([F.lit(d) for d in broken])
    assert as_set(shipments(spark, table)) == as_set(new.filter(~failed).unionByName(old.filter(failed)))


def test_a_read_that_recovers_is_published(spark, table, monkeypatch):
    append(by_age(spark, {1: 2}), table)
    calls = []
    replace = rebuild_module.replace_partitions

    def flaky(*args, **settings):
        calls.append(args)
        if len(calls) < 3:
            raise RuntimeError("connection lost")
        return replace(*args, **settings)

    monkeypatch.setattr(rebuild_module, "replace_partitions", flaky)
    assert rebuild_dates(by_age(spark, {1: 5}), table, [at_age(1)]).failed() == []
    assert len(calls) == 3


def test_a_source_out_of_order_is_given_up(spark, table, monkeypatch):
    calls = []

    def fails(source, sink, dates, *args, **settings):
        calls.append(dates)
        raise RuntimeError("no source")

    monkeypatch.setattr(rebuild_module, "replace_partitions", fails)
    result = rebuild(by_age(spark, {1: 1}), table, TODAY)
    assert len(result.failed()) == 60 and len(calls) < 60
    assert {o.problem for o in result.outcomes} == {"no source", "not tried, too many reads failed"}


def test_bad_rows_and_failing_reads_in_one_run(spark, table):
    append(by_age(spark, {age: 2 for age in range(1, 6)}), table)
    new = by_age(spark, {age: 3 for age in range(1, 6)})
    new = new.withColumn("carrier_code", F.when(F.col("shipment_date") == F.lit(at_age(2)), F.lit(None)).otherwise(F.col("carrier_code")))
    outcomes = {o.shipment_date: o for o in rebuild(_failing_on(new, at_age(4)), table, TODAY, lookback_days=5).outcomes}
    assert [outcomes[at_age(a)].action for a in range(1, 6)] == ["REPLACED", "FAILED", "REPLACED", "FAILED", "REPLACED"]
    assert outcomes[at_age(2)].bad_rows == 3 and outcomes[at_age(4)].bad_rows == 0


def test_fail_all_leaves_nothing_behind(spark, table):
    append(by_age(spark, {1: 2}), table)
    with pytest.raises(Exception, match="unreadable"):
        rebuild(_failing_on(by_age(spark, {1: 3}), at_age(1)), table, TODAY, fail_all=True)
    location = sink_module._HadoopPath(spark, sink_module._table_location(spark, table))
    assert location.child("_runs").children() == [] and location.child("_open").children() == []
    assert shipments(spark, table).count() == 2


# Publication


@pytest.mark.parametrize("days", [60, 150])
def test_one_listing_and_parallel_statements(spark, table, monkeypatch, days):
    full_load(by_age(spark, {age: 1 for age in range(1, days + 1)}), table)
    described, threads, groups = [], set(), set()
    location, point = sink_module._location, sink_module._at_once
    monkeypatch.setattr(sink_module, "_location", lambda d: described.append(d) or location(d))

    def watched(session, step, dates):
        def seen(d):
            threads.add(threading.get_ident())
            groups.add(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
            step(d)

        point(session, seen, dates)

    monkeypatch.setattr(sink_module, "_at_once", watched)
    spark.sparkContext.setJobGroup("nightly", "the nightly run")
    try:
        rebuild(by_age(spark, {age: 2 for age in range(1, days + 1)}), table, TODAY, lookback_days=days).check()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(described) < 8
    assert 1 < len(threads) <= 8 and groups == {"nightly"}
    assert shipments(spark, table).count() == 2 * days


# Profiles from stored states


PROFILES = {
    "table_overview": (),
    "status_breakdown": (),
    "carrier_profile": (),
    "recent_dates": (2,),
    "version_counts": (),
    "seed_date": (TODAY,),
    "band_violations": (TODAY,),
}


def same_profiles(states, rows):
    for name, arguments in PROFILES.items():
        merged = getattr(profile_states, name)(states, *arguments)
        plain = getattr(profile, name)(rows, *arguments)
        assert merged.dtypes == plain.dtypes, name
        assert sorted(map(str, merged.collect())) == sorted(map(str, plain.collect())), name


def test_profiles_from_states_equal_those_of_the_table(spark, table):
    append(by_age(spark, {1: 5, 30: 1, 31: 2, 59: 4, 61: 3, 400: 2}), table)
    states = ProfileStates(spark, table, f"{table}_states")
    first = states.start()
    assert states.start() == first
    same_profiles(states.states(), shipments(spark, table))
    before = shipments(spark, table).collect()
    # Costs and versions change on two dates, one date loses its rows, one appears.
    kept = shipments(spark, table).filter(F.col("shipment_date") != F.lit(at_age(59)))
    source = kept.withColumn("actual_cost", F.col("estimated_cost")).withColumn("record_version", F.lit(2))
    source = source.unionByName(by_age(spark, {2: 3}))
    rebuild_dates(source, table, [at_age(1), at_age(2), at_age(31), at_age(59)], states=states)
    assert states.version() == first + 1
    same_profiles(states.states(), shipments(spark, table))
    same_profiles(states.states(first), spark.createDataFrame(before, shipments(spark, table).schema))
    # Everything recorded anew gives the same.
    states.record()
    same_profiles(states.states(), shipments(spark, table))
    spark.sql(f"DROP TABLE {states.table}")


def test_recording_reads_published_dates_alone(spark, table):
    append(by_age(spark, {1: 5, 31: 2, 400: 2}), table)
    states = ProfileStates(spark, table, f"{table}_states")
    states.start()
    other = shipments(spark, table).filter(F.col("shipment_date") == F.lit(at_age(400)))
    for path in other.inputFiles():
        with open(path.removeprefix("file://"), "wb") as file:
            file.write(b"not a Parquet file")
    replace_partitions(by_age(spark, {1: 7}), table, [at_age(1)])
    states.record([at_age(1)])
    assert profile_states.table_overview(states.states()).first().total_rows == 11
    assert not any(f"/{table}/" in path for path in states.states().inputFiles())
    spark.sql(f"DROP TABLE {states.table}")


def test_states_of_an_empty_table(spark, table):
    states = ProfileStates(spark, table, f"{table}_states")
    assert states.start() == states.record([]) == -1
    same_profiles(states.states(), shipments(spark, table))
    append(by_age(spark, {3: 2}), table)
    states.record([at_age(3), at_age(4)])
    same_profiles(states.states(), shipments(spark, table))
    spark.sql(f"DROP TABLE {states.table}")
