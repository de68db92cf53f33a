"""Registered queries: every operator of the library, run over the given tables.

Queries that change a table write it under the shared folder and return the table afterwards.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle_queries import ORACLE_SQL
from tidemark.functions.bands import BANDS
from tidemark.functions.dates import Window, in_window, lookback_window, window_spine
from tidemark.operators import profile as pf
from tidemark.operators import profile_states as ps
from tidemark.operators import reconcile as rc
from tidemark.operators.align import align
from tidemark.operators.arrivals import arrive, nightly_arrivals as arrivals_of, smallest_ids
from tidemark.operators.expand import base_rows_only, copies_of, expand, id_distance
from tidemark.operators.ids import IdLedger
from tidemark.operators.ledger import DATE, DigestLedger
from tidemark.operators.profile_states import ProfileStates
from tidemark.operators.ranges import dense_ids_by_ranges
from tidemark.operators.setdiff import sparse_row_differences
from tidemark.operators.settle import advance_boundary as advanced, band_assignments, crosses_boundary, settle
from tidemark.operators.sink import StagedDates, append, full_load as load, publish, stage, update_rows
from tidemark.plans.load import LoadProgress, resumable_load
from tidemark.plans.rebuild import rebuild, rebuild_dates, repair
from tidemark.plans.strategies import compare_strategies
from tidemark.plans.validate import validation
from tidemark.schema import KEY_COLUMN, PARTITION_COLUMN, create_table
from tidemark.session import scratch_path
from tidemark.sources.jdbc import profile_query
from tidemark.sources.orders import base_shipments as base_of, read_orders
from tidemark.sources.tables import scan_date, scan_window, shipments

try:
    import corpus_pipeline
    from tidemark.llm.queries import QUERIES as LLM_QUERIES
    from tidemark.llm.sql import ORACLE_SQL as LLM_SQL
except ModuleNotFoundError as missing:
    # The subpackage may be left out, and so may the libraries that only it needs.
    if not (missing.name or "").startswith(("corpus_pipeline", "tidemark.llm")):
        warnings.warn(f"queries of tidemark.llm are left out: {missing}")
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_SQL = LLM_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

# The day after the newest order date, at every scale factor.
AS_OF = date(2001, 8, 2)
WINDOW = lookback_window(AS_OF)
# A date that cannot be read, and the date from which on a load fails.
BROKEN_DATE = AS_OF - timedelta(days=23)
LOST_FROM = date(1998, 6, 1)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_of(read_orders(spark, sf_dir))


def _settled(spark: SparkSession, sf_dir: str, nights_ago: int = 0) -> DataFrame:
    return settle(_base(spark, sf_dir), AS_OF - timedelta(days=nights_ago))


def _planted_source(df: DataFrame) -> DataFrame:
    return df.filter(F.dayofmonth(PARTITION_COLUMN) != 28)


def _planted_sink(df: DataFrame) -> DataFrame:
    day = F.dayofmonth(PARTITION_COLUMN)
    lost = day.isin(3, 13, 23) | (day.isin(5, 15, 25) & (F.col(KEY_COLUMN) % 2 == 0))
    return df.filter(~lost)


_STAGED: dict[tuple[str, str, int], StagedDates] = {}


def _history(spark: SparkSession, sf_dir: str, nights_ago: int = 0) -> StagedDates:
    """All rows as they stood some nights ago, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, nights_ago)
    if key not in _STAGED:
        rows = _settled(spark, sf_dir, nights_ago)
        _STAGED[key] = stage(rows, scratch_path(spark, f"history_{nights_ago}"))
    return _STAGED[key]


def _new_table(spark: SparkSession, label: str, history: StagedDates | None = None) -> str:
    """A sink table of its own, holding a history.

    Dates that are replaced get folders of their own and leave the history as it is; rows appended to a
    date of the history would be seen by all tables that share it, so queries append to new dates only.
    """
    table = f"tidemark_{label}_{uuid.uuid4().hex}"
    create_table(spark, table, scratch_path(spark, table))
    if history:
        publish(spark, table, history, history.dates)
    return table


# Rows and scans


def base_shipments(spark, sf_dir):
    return _base(spark, sf_dir)


def settled_snapshot(spark, sf_dir):
    return _settled(spark, sf_dir)


def partition_scan_one_date(spark, sf_dir):
    newest = WINDOW.last.isoformat()
    return scan_date(_settled(spark, sf_dir), newest)


def window_scan(spark, sf_dir):
    return scan_window(_settled(spark, sf_dir), WINDOW)


def lookback_spine(spark, sf_dir):
    """The window before the day after the newest date, with the rows of each of its dates."""
    base = _base(spark, sf_dir)
    newest = base.agg(F.max("shipment_date")).first()[0]
    window = lookback_window(newest + timedelta(days=1))
    per_date = base.filter(in_window(window)).groupBy("shipment_date").agg(F.count("*").alias("n"))
    return (
        window_spine(spark, window)
        .join(per_date, "shipment_date", "left")
        .select(
            (F.datediff(F.lit(window.last), "shipment_date") + 1).alias("day_no"),
            "shipment_date",
            F.coalesce("n", F.lit(0)).alias("row_count"),
        )
    )


def schema_align(spark, sf_dir):
    """The base rows from a frame with other types, an extra column and no lifecycle columns."""
    base = _base(spark, sf_dir)
    return align(
        base.drop("record_version", "settlement_status", "actual_cost").withColumns(
            {
                "shipment_id": F.col("shipment_id").cast("string"),
                "shipment_date": F.col("shipment_date").cast("timestamp_ntz"),
                "estimated_cost": F.col("estimated_cost").cast("decimal(30,6)"),
                "weight_lbs": F.col("weight_lbs").cast("double"),
                "unknown_column": F.lit("not in the sink"),
            }
        )
    )


def surrogate_ids(spark, sf_dir):
    return dense_ids_by_ranges(
        _base(spark, sf_dir).select("shipment_id", "shipment_date"), "shipment_date", "shipment_id"
    )


def capped_rows(spark, sf_dir):
    return smallest_ids(_base(spark, sf_dir), 1_000)


# Expansion and arrivals


def _largest_id(base: DataFrame) -> Column:
    return base.agg(F.max("shipment_id")).scalar()


def expand_copies(spark, sf_dir):
    base = _base(spark, sf_dir)
    return expand(base)


def expand_profile(spark, sf_dir):
    return pf.table_overview(expand_copies(spark, sf_dir))


def expand_resumed(spark, sf_dir):
    """Copies 11 to 20 added to a frame that already holds 1 to 10."""
    base = _base(spark, sf_dir)
    offset = id_distance(base)
    partly = base.unionByName(copies_of(base, 1, 10, offset))
    return pf.table_overview(
        partly.unionByName(copies_of(base_rows_only(partly, _largest_id(base)), 11, 20, offset))
    )


def nightly_arrivals(spark, sf_dir):
    return arrivals_of(_base(spark, sf_dir), AS_OF)


def nightly_arrivals_capped(spark, sf_dir):
    return arrivals_of(_base(spark, sf_dir), AS_OF, rows=1)


def arrival_delta(spark, sf_dir):
    """The night's arrivals appended to a table: rows counted before and after, and the difference."""
    table = _new_table(spark, "arrivals", _history(spark, sf_dir))
    before = shipments(spark, table).count()
    append(arrivals_of(shipments(spark, table), AS_OF), table)
    return spark.table(table).agg(
        F.lit(before).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.count("*") - F.lit(before)).alias("new_rows"),
        F.max("shipment_date").alias("newest_date"),
    )


def nightly_arrivals_month(spark, sf_dir):
    """Thirty nights in a row: each night's rows seed the next, and ids come from the ledger."""
    base = _base(spark, sf_dir).filter(F.col("shipment_date") >= F.lit(AS_OF - timedelta(days=7)))
    table = _new_table(spark, "month")
    append(base, table)
    ids = IdLedger(spark, f"{table}_ids")
    ids.start(_base(spark, sf_dir).agg(F.max("shipment_id")).first()[0])
    for night in range(30):
        arrive(spark, table, AS_OF + timedelta(days=night), ids)
    return shipments(spark, table).filter(F.col("shipment_date") > F.lit(AS_OF))


# Profiles


def table_overview(spark, sf_dir):
    return pf.table_overview(_settled(spark, sf_dir))


def status_breakdown(spark, sf_dir):
    return pf.status_breakdown(_settled(spark, sf_dir))


def carrier_profile(spark, sf_dir):
    return pf.carrier_profile(_settled(spark, sf_dir))


def recent_dates_top10(spark, sf_dir):
    return pf.recent_dates(_settled(spark, sf_dir))


def profile_sample(spark, sf_dir):
    report = pf.per_date_profile(_settled(spark, sf_dir), WINDOW)
    return report.orderBy(F.desc("shipment_date")).limit(5)


def date_version_status_70d(spark, sf_dir):
    return pf.date_version_status(_settled(spark, sf_dir), AS_OF)


def window_status(spark, sf_dir):
    return pf.window_status(_settled(spark, sf_dir), AS_OF)


def frozen_rows(spark, sf_dir):
    return pf.frozen_rows(_settled(spark, sf_dir), AS_OF)


def per_date_profile(spark, sf_dir):
    return pf.per_date_profile(_settled(spark, sf_dir), WINDOW)


def pushed_profile(spark, sf_dir):
    """The text a relational source is asked for its profile with, run by Spark itself."""
    view = f"settled_{uuid.uuid4().hex}"
    _settled(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {profile_query(view, WINDOW)}")


def version_counts(spark, sf_dir):
    return pf.version_counts(_settled(spark, sf_dir))


def seed_date(spark, sf_dir):
    return pf.seed_date(_base(spark, sf_dir), AS_OF)


def band_violations(spark, sf_dir):
    return pf.band_violations(_settled(spark, sf_dir, 11), AS_OF)


# Profiles from stored states


def _states(spark, sf_dir, rebuilt=True):
    """The states of a table eleven nights old, as recorded then, or after a rebuild that makes up for missed nights."""
    table = _new_table(spark, "states", _history(spark, sf_dir, 11))
    states = ProfileStates(spark, table, f"{table}_states")
    states.start()
    if rebuilt:
        rebuild(_settled(spark, sf_dir), table, AS_OF, missed_nights=10, states=states)
    return states.states()


def table_overview_states(spark, sf_dir):
    return ps.table_overview(_states(spark, sf_dir))


def status_breakdown_states(spark, sf_dir):
    return ps.status_breakdown(_states(spark, sf_dir))


def carrier_profile_states(spark, sf_dir):
    return ps.carrier_profile(_states(spark, sf_dir))


def recent_dates_top10_states(spark, sf_dir):
    return ps.recent_dates(_states(spark, sf_dir))


def version_counts_states(spark, sf_dir):
    return ps.version_counts(_states(spark, sf_dir))


def band_violations_states(spark, sf_dir):
    return ps.band_violations(_states(spark, sf_dir, rebuilt=False), AS_OF)


# Reconciliation


def _planted_report(spark, sf_dir):
    settled = _settled(spark, sf_dir)
    return rc.reconcile(
        pf.per_date_profile(_planted_source(settled), WINDOW),
        pf.per_date_profile(_planted_sink(settled), WINDOW),
    )


def reconcile_report(spark, sf_dir):
    return _planted_report(spark, sf_dir)


def reconcile_summary(spark, sf_dir):
    return rc.summarise(_planted_report(spark, sf_dir))


def reconcile_verdict(spark, sf_dir):
    return rc.verdict(_planted_report(spark, sf_dir))


def reconcile_spine(spark, sf_dir):
    return rc.with_absent_dates(_planted_report(spark, sf_dir), WINDOW)


def deep_reconcile(spark, sf_dir):
    """The sink is also three nights old, which equal counts cannot show."""
    source = _planted_source(_settled(spark, sf_dir))
    sink = _planted_sink(_settled(spark, sf_dir, 3))
    return rc.deep_reconcile(
        pf.per_date_profile(source, WINDOW, checksums=True),
        pf.per_date_profile(sink, WINDOW, checksums=True),
    )


def partition_row_diff(spark, sf_dir):
    source = _planted_source(_settled(spark, sf_dir))
    sink = _planted_sink(_settled(spark, sf_dir, 3))
    return sparse_row_differences(scan_window(source, WINDOW), scan_window(sink, WINDOW))


def _order_lines(spark, sf_dir):
    """Order lines as shipments, whose ids and versions repeat."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("shipment_id"),
        F.col("l_shipdate").cast("date").alias("shipment_date"),
        (1 + F.col("l_linenumber") % 4).cast("int").alias("record_version"),
        F.lit("Pending").alias("settlement_status"),
        F.lit("CAR-A").alias("carrier_code"),
        F.lit("North").alias("origin_region"),
        F.lit("South").alias("destination_region"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("estimated_cost"),
        F.lit(None).cast("decimal(18,2)").alias("actual_cost"),
        F.col("l_quantity").cast("decimal(10,2)").alias("weight_lbs"),
        F.lit("LINE").alias("payload"),
    )


def partition_row_diff_repeated(spark, sf_dir):
    """Repeated ids: one side lacks some ids, some rows of others, and has other versions on some dates."""
    lines = _order_lines(spark, sf_dir)
    key, version = F.col("shipment_id"), F.col("record_version")
    moved = (F.dayofmonth("shipment_date") == 9) & (version == 2)
    sink = lines.filter((key % 7 != 0) & ~((key % 5 == 0) & (version == 3))).withColumn(
        "record_version", F.when(moved, F.lit(4)).otherwise(version)
    )
    return sparse_row_differences(lines, sink)


def failing_dates(spark, sf_dir):
    return rc.failing_dates(_planted_report(spark, sf_dir))


# Table maintenance


def full_load(spark, sf_dir):
    table = _new_table(spark, "full")
    load(_settled(spark, sf_dir), table)
    return shipments(spark, table)


def _stopped_load(spark, sf_dir):
    """A load whose source fails from one date on, run again with the whole source: table, batches of both runs."""
    table = _new_table(spark, "resumed")
    progress = LoadProgress(spark, f"{table}_progress")
    rows = _settled(spark, sf_dir)
    lost = F.when(F.col(PARTITION_COLUMN) >= F.lit(LOST_FROM), F.raise_error(F.lit("the source is gone")).cast("string"))
    failing = rows.withColumn("payload", F.coalesce(lost, "payload"))
    per_batch = -(-rows.count() // 10)
    try:
        resumable_load(failing, table, progress, per_batch)
    except Exception as error:
        if "the source is gone" not in str(error):
            raise
    before = spark.table(progress.table).agg(F.sum("dates_written"), F.sum("rows_written")).first()
    resumed = resumable_load(rows, table, progress, per_batch)
    return table, tuple(before), (sum(len(b.dates) for b in resumed), sum(b.rows for b in resumed))


def full_load_resumed(spark, sf_dir):
    return shipments(spark, _stopped_load(spark, sf_dir)[0])


def full_load_progress(spark, sf_dir):
    """Dates and rows that the run that stopped wrote, and the run after it."""
    _, before, after = _stopped_load(spark, sf_dir)
    return spark.createDataFrame([(1, *before), (2, *after)], "run int, dates_written bigint, rows_written bigint")


def append_insert(spark, sf_dir):
    """History first, the window appended to it."""
    table = _new_table(spark, "append")
    append(_settled(spark, sf_dir).filter(~in_window(WINDOW)), table)
    append(scan_window(_settled(spark, sf_dir), WINDOW), table)
    return shipments(spark, table)


def update_in_place(spark, sf_dir):
    """A table eleven nights old brought up to date by one update per band."""
    table = _new_table(spark, "update", _history(spark, sf_dir, 11))
    for band in BANDS:
        outdated = band.covers(AS_OF) & (F.col("record_version") != band.version)
        update_rows(spark, table, outdated, band_assignments(band))
    return shipments(spark, table)


def advance_boundary(spark, sf_dir):
    table = _new_table(spark, "advance", _history(spark, sf_dir, 1))
    update_rows(spark, table, crosses_boundary(AS_OF), band_assignments(BANDS[1]))
    return shipments(spark, table)


def advance_boundary_moved(spark, sf_dir):
    """How many dates and rows the boundary step moves, as the step itself counts them."""
    table = _new_table(spark, "moved", _history(spark, sf_dir, 1))
    moved = update_rows(spark, table, crosses_boundary(AS_OF), band_assignments(BANDS[1]))
    return spark.createDataFrame([(len(moved), sum(moved.values()))], "dates_moved bigint, rows_moved bigint")


def boundary_preview(spark, sf_dir):
    """The table after the boundary step, without writing one: its version counts."""
    return pf.version_counts(advanced(_settled(spark, sf_dir, 1), AS_OF))


def rebuild_window(spark, sf_dir):
    """Eleven nights missed and not made up for: the dates that froze meanwhile stay stale."""
    table = _new_table(spark, "rebuild", _history(spark, sf_dir, 11))
    rebuild(_settled(spark, sf_dir), table, AS_OF)
    return shipments(spark, table)


def rebuild_missed_night(spark, sf_dir):
    """The same with the window widened by the missed nights."""
    table = _new_table(spark, "missed", _history(spark, sf_dir, 11))
    rebuild(_settled(spark, sf_dir), table, AS_OF, missed_nights=10)
    return shipments(spark, table)


def rebuild_one_date(spark, sf_dir):
    table = _new_table(spark, "one_date", _history(spark, sf_dir, 11))
    boundary = AS_OF - timedelta(days=31)
    rebuild_dates(_settled(spark, sf_dir), table, [boundary])
    return shipments(spark, table)


def rebuild_empty_date(spark, sf_dir):
    """Dates that have no rows at the source any more."""
    table = _new_table(spark, "empty", _history(spark, sf_dir, 1))
    rebuild(_planted_source(_settled(spark, sf_dir)), table, AS_OF)
    return shipments(spark, table)


def rebuild_summary(spark, sf_dir):
    table = _new_table(spark, "summary", _history(spark, sf_dir, 1))
    return rebuild(_planted_source(_settled(spark, sf_dir)), table, AS_OF).summary(spark).drop("dates_failed")


def rebuild_by_date(spark, sf_dir):
    table = _new_table(spark, "by_date", _history(spark, sf_dir, 1))
    return rebuild(_planted_source(_settled(spark, sf_dir)), table, AS_OF).by_date(spark).drop("bad_rows")


def _with_bad_dates(df: DataFrame) -> DataFrame:
    bad = F.dayofmonth(PARTITION_COLUMN).isin(7, 17, 27) & (F.col(KEY_COLUMN) % 2 == 0)
    return df.withColumn("payload", F.when(bad, F.lit(None)).otherwise(F.col("payload")))


def rebuild_with_bad_date(spark, sf_dir):
    """Some dates hold rows that do not fit the table: these dates fail, all others are rebuilt."""
    table = _new_table(spark, "bad_date", _history(spark, sf_dir, 11))
    return rebuild(_with_bad_dates(_settled(spark, sf_dir)), table, AS_OF).by_date(spark)


def rebuild_around_bad_date(spark, sf_dir):
    """The table after such a rebuild: failed dates are as they were."""
    table = _new_table(spark, "around_bad", _history(spark, sf_dir, 11))
    rebuild(_with_bad_dates(_settled(spark, sf_dir)), table, AS_OF)
    return shipments(spark, table)


def _with_failing_read(df: DataFrame) -> DataFrame:
    """A source that breaks while one date is read."""
    broken = F.col(PARTITION_COLUMN) == F.lit(BROKEN_DATE)
    error = F.raise_error(F.lit("unreadable block")).cast("string")
    return df.withColumn("payload", F.when(broken, error).otherwise(F.col("payload")))


def rebuild_with_failing_read(spark, sf_dir):
    """One date cannot be read: it fails, all others are rebuilt."""
    table = _new_table(spark, "failing", _history(spark, sf_dir, 11))
    return rebuild(_with_failing_read(_settled(spark, sf_dir)), table, AS_OF).by_date(spark)


def rebuild_around_failing_read(spark, sf_dir):
    """The table after such a rebuild: the failed date is as it was."""
    table = _new_table(spark, "around_failing", _history(spark, sf_dir, 11))
    rebuild(_with_failing_read(_settled(spark, sf_dir)), table, AS_OF)
    return shipments(spark, table)


def _repaired(spark, sf_dir):
    """Planted defects found and the failing dates rebuilt: the repair, and a new comparison of the window."""
    source = _planted_source(_settled(spark, sf_dir))
    table = _new_table(spark, "repair", _history(spark, sf_dir))
    rebuild(_planted_sink(_settled(spark, sf_dir)), table, AS_OF)

    def report():
        return rc.reconcile(
            pf.per_date_profile(source, WINDOW), pf.per_date_profile(shipments(spark, table), WINDOW)
        )

    return repair(source, table, report()), report()


def repair_cycle(spark, sf_dir):
    return _repaired(spark, sf_dir)[1]


def repair_cycle_dates(spark, sf_dir):
    """Which dates the repair rebuilt, and how."""
    return _repaired(spark, sf_dir)[0].by_date(spark)


def _ledger_around_rebuild(spark, sf_dir, missed_nights=0):
    """A table eleven nights old, rebuilt by a run that records it: its ledger and the version before the run."""
    table = _new_table(spark, "frozen", _history(spark, sf_dir, 11))
    ledger = DigestLedger(spark, table, f"{table}_digests")
    before = ledger.start()
    rebuild(_settled(spark, sf_dir), table, AS_OF, missed_nights=missed_nights, ledger=ledger)
    return ledger, before


def frozen_guard_changed(spark, sf_dir):
    """A rebuild that makes up for missed nights changes dates that count as frozen by now; they are named."""
    ledger, before = _ledger_around_rebuild(spark, sf_dir, missed_nights=10)
    return ledger.changes(WINDOW.first, before)


def frozen_guard_unrecorded(spark, sf_dir):
    """Frozen months replaced without the ledger being told, one by the rows it had: only dates of the other are named."""
    ledger, before = _ledger_around_rebuild(spark, sf_dir)
    same, other = Window(date(2001, 3, 1), date(2001, 3, 31)), Window(date(2001, 4, 1), date(2001, 4, 30))
    rows = shipments(spark, ledger.sink).filter(~in_window(other) | (F.col(KEY_COLUMN) % 2 == 0))
    rebuild_dates(rows, ledger.sink, same.dates() + other.dates())
    return ledger.changes(WINDOW.first, before)


def frozen_guard(spark, sf_dir):
    """Frozen dates and rows, and how many of those dates a rebuild changed."""
    ledger, before = _ledger_around_rebuild(spark, sf_dir)
    frozen = ledger.nodes(DATE).filter((F.col("node") < F.lit(WINDOW.first)) & (F.col("row_count") > 0))
    return frozen.agg(
        F.count("*").alias("frozen_dates"),
        F.sum("row_count").alias("frozen_rows"),
        F.lit(ledger.changes(WINDOW.first, before).count()).alias("changed_dates"),
    )


def strategy_comparison(spark, sf_dir):
    """A sink of last night, without the newest date, meets tonight's source."""
    base = _base(spark, sf_dir)
    old_sink = settle(base.filter(F.col("shipment_date") < F.lit(WINDOW.last)), AS_OF - timedelta(days=1))
    return compare_strategies(old_sink, settle(base, AS_OF), WINDOW)


def strategy_comparison_repeated(spark, sf_dir):
    """The same over order lines, whose ids and versions repeat, with old versions of late dates changed."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("shipment_id"),
        F.col("l_shipdate").cast("date").alias("shipment_date"),
        (1 + F.col("l_linenumber") % 4).cast("int").alias("record_version"),
    )
    changed = F.when(F.col("shipment_date") >= "2001-06-20", 1 + F.col("record_version") % 4)
    old = lines.filter(F.col("shipment_id") % 7 != 0).withColumn(
        "record_version", changed.otherwise(F.col("record_version")).cast("int")
    )
    return compare_strategies(old, lines, WINDOW)


def validation_widened(spark, sf_dir):
    """A rebuild that makes up for ten missed nights, validated over its seventy dates."""
    source = _settled(spark, sf_dir)
    table = _new_table(spark, "widened", _history(spark, sf_dir, 11))
    rebuild(source, table, AS_OF, missed_nights=10)
    with validation(source, shipments(spark, table), AS_OF, missed_nights=10) as check:
        return check.report.select("shipment_date", "validation_result", "row_count_source", "row_count_sink")


def entry(spark: SparkSession) -> DataFrame:
    """The reconciliation report at the smallest scale."""
    return reconcile_report(spark, "/root/testdata/sf0.001")


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the settling-table operators."""
    registered = [
        base_shipments,
        settled_snapshot,
        partition_scan_one_date,
        window_scan,
        lookback_spine,
        schema_align,
        surrogate_ids,
        capped_rows,
        expand_copies,
        expand_profile,
        expand_resumed,
        nightly_arrivals,
        nightly_arrivals_capped,
        nightly_arrivals_month,
        arrival_delta,
        table_overview,
        status_breakdown,
        carrier_profile,
        recent_dates_top10,
        profile_sample,
        date_version_status_70d,
        window_status,
        frozen_rows,
        per_date_profile,
        pushed_profile,
        version_counts,
        seed_date,
        band_violations,
        table_overview_states,
        status_breakdown_states,
        carrier_profile_states,
        recent_dates_top10_states,
        version_counts_states,
        band_violations_states,
        reconcile_report,
        reconcile_summary,
        reconcile_verdict,
        reconcile_spine,
        deep_reconcile,
        partition_row_diff,
        partition_row_diff_repeated,
        failing_dates,
        full_load,
        full_load_resumed,
        full_load_progress,
        append_insert,
        update_in_place,
        advance_boundary,
        advance_boundary_moved,
        boundary_preview,
        rebuild_window,
        rebuild_missed_night,
        rebuild_one_date,
        rebuild_empty_date,
        rebuild_summary,
        rebuild_by_date,
        rebuild_with_bad_date,
        rebuild_around_bad_date,
        rebuild_with_failing_read,
        rebuild_around_failing_read,
        repair_cycle,
        repair_cycle_dates,
        frozen_guard,
        frozen_guard_changed,
        frozen_guard_unrecorded,
        strategy_comparison,
        strategy_comparison_repeated,
        validation_widened,
    ]
    return {query.__name__: query for query in registered}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return table_queries() | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL | LLM_SQL
