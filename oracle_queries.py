"""The registered queries as plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

# Fixed values throughout: names and letters of columns, regions, carriers, statuses and payloads.
AS_OF = "DATE '2001-08-02'"
IN_WINDOW = "shipment_date BETWEEN DATE '2001-06-03' AND DATE '2001-08-01'"
COLUMNS = (
    "shipment_id, shipment_date, record_version, settlement_status, carrier_code, origin_region, "
    "destination_region, estimated_cost, actual_cost, weight_lbs, payload"
)

BASE = """base AS (
  SELECT o_orderkey AS shipment_id,
         CAST(o_orderdate AS DATE) AS shipment_date,
         CAST(1 AS INTEGER) AS record_version,
         'Pending' AS settlement_status,
         concat('CAR-', chr(CAST(65 + o_custkey % 5 AS INTEGER))) AS carrier_code,
         CASE o_orderkey % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East'
                             WHEN 3 THEN 'West' ELSE 'Central' END AS origin_region,
         CASE o_custkey % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East'
                            WHEN 3 THEN 'West' ELSE 'Central' END AS destination_region,
         CAST(o_totalprice AS DECIMAL(18,2)) AS estimated_cost,
         CAST(NULL AS DECIMAL(18,2)) AS actual_cost,
         CAST(100 + o_orderkey % 900 AS DECIMAL(10,2)) AS weight_lbs,
         concat('SHIPMENT-BATCH-INITIAL-', CAST(o_orderkey % 10000 AS VARCHAR)) AS payload
  FROM orders)"""


# Shipments with repeated ids, and repeated versions of an id.
LINES = """lines AS (
  SELECT l_orderkey AS shipment_id, CAST(l_shipdate AS DATE) AS shipment_date,
         CAST(1 + l_linenumber % 4 AS INTEGER) AS record_version
  FROM lineitem)"""


def settled(name: str, nights_ago: int = 0, source: str = "base") -> str:
    """A CTE with the rows as they stood some nights before the processing date."""
    age = f"(({AS_OF} - {nights_ago}) - shipment_date)"

    def by_age(future: str, first: str, second: str, frozen: str) -> str:
        return (
            f"CASE WHEN {age} < 0 THEN {future} WHEN {age} <= 30 THEN {first} "
            f"WHEN {age} <= 59 THEN {second} ELSE {frozen} END"
        )

    def cost(rate: str) -> str:
        return f"CAST(estimated_cost * {rate} AS DECIMAL(18,2))"

    return f"""{name} AS (
  SELECT shipment_id, shipment_date,
         CAST({by_age('record_version', '2', '3', '4')} AS INTEGER) AS record_version,
         {by_age('settlement_status', "'Settling'", "'Settling'", "'Settled'")} AS settlement_status,
         carrier_code, origin_region, destination_region, estimated_cost,
         {by_age('actual_cost', cost('0.97'), cost('0.95'), cost('0.94'))} AS actual_cost,
         weight_lbs, payload
  FROM {source})"""


def with_ctes(*parts: str) -> str:
    *ctes, body = parts
    return "WITH " + ",\n".join(ctes) + "\n" + body


NOW = settled("now_rows")
OLD_1 = settled("old_rows", 1)
OLD_3 = settled("old_rows", 3)
OLD_11 = settled("old_rows", 11)

PLANTED_SOURCE_RULE = "day(shipment_date) <> 28"
PLANTED_SINK_RULE = (
    "day(shipment_date) NOT IN (3, 13, 23) "
    "AND NOT (day(shipment_date) IN (5, 15, 25) AND shipment_id % 2 = 0)"
)
BAD_ROW = "day(shipment_date) IN (7, 17, 27) AND shipment_id % 2 = 0"


def planted(sink_rows: str = "now_rows") -> str:
    return f"""source_rows AS (SELECT * FROM now_rows WHERE {IN_WINDOW} AND {PLANTED_SOURCE_RULE}),
sink_rows AS (SELECT * FROM {sink_rows} WHERE {IN_WINDOW} AND {PLANTED_SINK_RULE})"""


def profile(name: str, rows: str) -> str:
    return f"""{name} AS (
  SELECT CAST(shipment_date AS VARCHAR) AS shipment_date, count(*) AS row_count,
         max(record_version) AS max_version, min(settlement_status) AS settlement_status
  FROM {rows} GROUP BY 1)"""


REPORT = f"""{profile('source_profile', 'source_rows')},
{profile('sink_profile', 'sink_rows')},
report AS (
  SELECT coalesce(a.shipment_date, b.shipment_date) AS shipment_date,
         a.row_count AS row_count_source, b.row_count AS row_count_sink,
         coalesce(b.row_count, 0) - coalesce(a.row_count, 0) AS row_diff,
         CASE WHEN b.row_count IS NULL THEN 'MISSING_IN_SINK'
              WHEN a.row_count IS NULL THEN 'MISSING_IN_SOURCE'
              WHEN a.row_count = b.row_count THEN 'PASS' ELSE 'MISMATCH' END AS validation_result,
         a.max_version AS max_version_source, b.max_version AS max_version_sink,
         a.settlement_status AS status_source, b.settlement_status AS status_sink
  FROM source_profile a FULL OUTER JOIN sink_profile b ON a.shipment_date = b.shipment_date)"""


def planted_report(*parts: str) -> str:
    return with_ctes(BASE, NOW, planted(), REPORT, *parts)


OVERVIEW = """SELECT count(*) AS total_rows, min(shipment_date) AS earliest_date,
       max(shipment_date) AS latest_date, count(DISTINCT shipment_date) AS distinct_dates,
       count(DISTINCT carrier_code) AS distinct_carriers FROM """

VERSION_COUNTS = """SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE record_version = 1) AS version_1_rows,
       count(*) FILTER (WHERE record_version = 2) AS version_2_rows,
       count(*) FILTER (WHERE record_version = 3) AS version_3_rows,
       count(*) FILTER (WHERE record_version = 4) AS version_4_rows FROM """


def copies(first: int, last: int) -> str:
    return f"""SELECT shipment_id + i * greatest(5000000, (SELECT max(shipment_id) + 1 FROM base)) AS shipment_id,
         CAST(shipment_date - CAST((2 * i) % 365 AS INTEGER) AS DATE) AS shipment_date,
         CAST(1 AS INTEGER) AS record_version, 'Pending' AS settlement_status,
         carrier_code, origin_region, destination_region, estimated_cost,
         CAST(NULL AS DECIMAL(18,2)) AS actual_cost, weight_lbs,
         concat('SHIPMENT-BATCH-', CAST(i AS VARCHAR)) AS payload
  FROM base CROSS JOIN generate_series({first}, {last}) AS g(i)"""


ARRIVALS = f"""arrivals AS (
  SELECT shipment_id + greatest(900000000, (SELECT max(shipment_id) + 1 FROM base)) AS shipment_id, CAST({AS_OF} + 1 AS DATE) AS shipment_date,
         CAST(1 AS INTEGER) AS record_version, 'Pending' AS settlement_status,
         carrier_code, origin_region, destination_region, estimated_cost,
         CAST(NULL AS DECIMAL(18,2)) AS actual_cost, weight_lbs,
         concat('SHIPMENT-NIGHTLY-NEW-', CAST(shipment_id % 10000 AS VARCHAR)) AS payload
  FROM base
  WHERE shipment_date = (SELECT max(shipment_date) FROM base WHERE shipment_date <= {AS_OF})
  ORDER BY shipment_id)"""

DIFFERENCES = """differences AS (
  SELECT coalesce(a.shipment_id, b.shipment_id) AS shipment_id,
         a.shipment_date AS date_source, b.shipment_date AS date_sink,
         CASE WHEN b.shipment_id IS NULL THEN 'ONLY_IN_SOURCE'
              WHEN a.shipment_id IS NULL THEN 'ONLY_IN_SINK' ELSE 'CHANGED' END AS difference,
         CAST(CASE WHEN a.shipment_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_source,
         CAST(CASE WHEN b.shipment_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_sink,
         a.record_version AS version_source, b.record_version AS version_sink,
         a.actual_cost AS actual_cost_source, b.actual_cost AS actual_cost_sink
  FROM source_rows a FULL OUTER JOIN sink_rows b ON a.shipment_id = b.shipment_id
  WHERE a.shipment_id IS NULL OR b.shipment_id IS NULL
     OR a.record_version <> b.record_version OR a.settlement_status <> b.settlement_status
     OR a.actual_cost IS DISTINCT FROM b.actual_cost OR a.shipment_date <> b.shipment_date
     OR a.estimated_cost <> b.estimated_cost OR a.payload <> b.payload
     OR a.carrier_code <> b.carrier_code OR a.weight_lbs <> b.weight_lbs
     OR a.origin_region <> b.origin_region OR a.destination_region <> b.destination_region)"""


def rebuilt(rule: str) -> str:
    """Rows of the new state where the rule holds, of the old state elsewhere."""
    return f"""SELECT {COLUMNS} FROM now_rows WHERE {rule}
UNION ALL SELECT {COLUMNS} FROM old_rows WHERE NOT ({rule})"""


def strategy(name: str, kept: str, written: str) -> str:
    """One strategy carried out in full: the sink it leaves, compared with the source."""
    return f"""SELECT '{name}' AS strategy,
  (SELECT count(*) FROM now_rows WHERE {written}) AS rows_written,
  (SELECT count(*) FROM old_rows WHERE {kept}) + (SELECT count(*) FROM now_rows WHERE {written}) AS rows_after,
  (SELECT count(*) - count(DISTINCT shipment_id) FROM (
     SELECT shipment_id FROM old_rows WHERE {kept}
     UNION ALL SELECT shipment_id FROM now_rows WHERE {written})) AS duplicate_rows,
  (SELECT count(*) FROM old_rows WHERE ({kept}) AND shipment_id IN (SELECT shipment_id FROM now_rows)
     AND (shipment_id, record_version) NOT IN (SELECT (shipment_id, record_version) FROM now_rows)) AS stale_rows,
  (SELECT count(DISTINCT shipment_id) FROM now_rows WHERE shipment_id NOT IN (
     SELECT shipment_id FROM old_rows WHERE {kept}
     UNION ALL SELECT shipment_id FROM now_rows WHERE {written})) AS missing_rows,
  (SELECT count(*) FROM old_rows WHERE ({kept})
     AND shipment_id NOT IN (SELECT shipment_id FROM now_rows)) AS surplus_rows"""


STRATEGIES = "\nUNION ALL ".join(
    [
        strategy("append_only", "true", IN_WINDOW),
        strategy("watermark", "true", "shipment_date > (SELECT max(shipment_date) FROM old_rows)"),
        strategy("full_reload", "false", "true"),
        strategy("delete_append", f"NOT ({IN_WINDOW})", IN_WINDOW),
        strategy("delete_append_interrupted", f"NOT ({IN_WINDOW})", "false"),
        strategy("partition_replace", f"NOT ({IN_WINDOW})", IN_WINDOW),
    ]
)

PER_DATE = """SELECT CAST(shipment_date AS VARCHAR) AS shipment_date, count(*) AS row_count,
       max(record_version) AS max_version, min(settlement_status) AS settlement_status
FROM now_rows WHERE """ + IN_WINDOW + " GROUP BY 1"

SPINE = "spine AS (SELECT CAST(DATE '2001-06-03' + CAST(i AS INTEGER) AS DATE) AS d FROM generate_series(0, 59) AS g(i))"

ORACLE_SQL = {
    "base_shipments": with_ctes(BASE, f"SELECT {COLUMNS} FROM base"),
    "settled_snapshot": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows"),
    "partition_scan_one_date": with_ctes(
        BASE, NOW, f"SELECT {COLUMNS} FROM now_rows WHERE shipment_date = DATE '2001-08-01'"
    ),
    "window_scan": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows WHERE {IN_WINDOW}"),
    "lookback_spine": with_ctes(
        BASE,
        "spine AS (SELECT CAST(i AS INTEGER) AS day_no, CAST((SELECT max(shipment_date) FROM base) + 1 "
        "- CAST(i AS INTEGER) AS DATE) AS shipment_date FROM generate_series(1, 60) AS g(i))",
        "SELECT day_no, spine.shipment_date, count(base.shipment_id) AS row_count FROM spine "
        "LEFT JOIN base ON base.shipment_date = spine.shipment_date GROUP BY 1, 2",
    ),
    "schema_align": with_ctes(BASE, f"SELECT {COLUMNS} FROM base"),
    "surrogate_ids": with_ctes(
        BASE,
        "SELECT shipment_id, shipment_date, "
        "row_number() OVER (ORDER BY shipment_date, shipment_id) AS surrogate_id FROM base",
    ),
    "capped_rows": with_ctes(BASE, f"SELECT {COLUMNS} FROM base ORDER BY shipment_id LIMIT 1000"),
    "expand_copies": with_ctes(
        BASE, f"SELECT {COLUMNS} FROM base\nUNION ALL SELECT {COLUMNS} FROM ({copies(1, 40)})"
    ),
    "expand_profile": with_ctes(
        BASE, f"all_rows AS (SELECT {COLUMNS} FROM base UNION ALL {copies(1, 40)})", OVERVIEW + "all_rows"
    ),
    "expand_resumed": with_ctes(
        BASE, f"all_rows AS (SELECT {COLUMNS} FROM base UNION ALL {copies(1, 20)})", OVERVIEW + "all_rows"
    ),
    "nightly_arrivals": with_ctes(BASE, ARRIVALS, f"SELECT {COLUMNS} FROM arrivals"),
    "nightly_arrivals_capped": with_ctes(
        BASE, ARRIVALS, f"SELECT {COLUMNS} FROM arrivals ORDER BY shipment_id LIMIT 1"
    ),
    "nightly_arrivals_month": with_ctes(
        BASE,
        f"""seeds AS (
  SELECT *, row_number() OVER (ORDER BY shipment_id) AS rank, count(*) OVER () AS n, (SELECT max(shipment_id) FROM base) AS largest
  FROM base WHERE shipment_date = (SELECT max(shipment_date) FROM base WHERE shipment_date <= {AS_OF}))""",
        "nights AS (SELECT i FROM generate_series(0, 29) AS g(i))",
        f"""SELECT largest + i * n + rank AS shipment_id, CAST({AS_OF} + 1 + CAST(i AS INTEGER) AS DATE) AS shipment_date, record_version,
       settlement_status, carrier_code, origin_region, destination_region, estimated_cost, actual_cost, weight_lbs,
       concat('SHIPMENT-NIGHTLY-NEW-',
              CAST(CASE i WHEN 0 THEN shipment_id ELSE largest + (i - 1) * n + rank END % 10000 AS VARCHAR)) AS payload
FROM seeds, nights""",
    ),
    "arrival_delta": with_ctes(
        BASE,
        ARRIVALS,
        "SELECT (SELECT count(*) FROM base) AS rows_before, "
        "(SELECT count(*) FROM base) + (SELECT count(*) FROM arrivals) AS rows_after, "
        "(SELECT count(*) FROM arrivals) AS new_rows, "
        "(SELECT max(shipment_date) FROM arrivals) AS newest_date",
    ),
    "table_overview": with_ctes(BASE, OVERVIEW + "base"),
    "status_breakdown": with_ctes(
        BASE,
        NOW,
        "SELECT settlement_status, record_version, count(*) AS row_count, "
        "min(actual_cost) AS min_actual_cost, max(actual_cost) AS max_actual_cost "
        "FROM now_rows GROUP BY 1, 2",
    ),
    "carrier_profile": with_ctes(
        BASE,
        "SELECT carrier_code, count(*) AS row_count, min(shipment_date) AS earliest_date, "
        "max(shipment_date) AS latest_date FROM base GROUP BY 1",
    ),
    "recent_dates_top10": with_ctes(
        BASE,
        NOW,
        "SELECT shipment_date, count(*) AS row_count, min(record_version) AS min_version, "
        "max(record_version) AS max_version, min(settlement_status) AS settlement_status "
        "FROM now_rows GROUP BY 1 ORDER BY shipment_date DESC LIMIT 10",
    ),
    "profile_sample": with_ctes(BASE, NOW, PER_DATE + " ORDER BY 1 DESC LIMIT 5"),
    "date_version_status_70d": with_ctes(
        BASE,
        NOW,
        "SELECT shipment_date, record_version, settlement_status, count(*) AS row_count "
        f"FROM now_rows WHERE shipment_date >= {AS_OF} - 70 GROUP BY 1, 2, 3",
    ),
    "window_status": with_ctes(
        BASE,
        NOW,
        "SELECT settlement_status, record_version, count(*) AS row_count "
        f"FROM now_rows WHERE shipment_date >= {AS_OF} - 60 GROUP BY 1, 2",
    ),
    "frozen_rows": with_ctes(
        BASE,
        NOW,
        "SELECT count(*) AS frozen_rows, min(shipment_date) AS earliest_frozen, "
        "max(shipment_date) AS latest_frozen FROM now_rows "
        f"WHERE shipment_date < {AS_OF} - 60 AND settlement_status = 'Settled'",
    ),
    "per_date_profile": with_ctes(BASE, NOW, PER_DATE),
    "pushed_profile": with_ctes(BASE, NOW, PER_DATE),
    "version_counts": with_ctes(BASE, NOW, VERSION_COUNTS + "now_rows"),
    "seed_date": with_ctes(
        BASE, f"SELECT max(shipment_date) AS seed_date FROM base WHERE shipment_date <= {AS_OF}"
    ),
    "band_violations": with_ctes(
        BASE,
        OLD_11,
        NOW,
        "SELECT o.shipment_date, o.record_version, o.settlement_status, count(*) AS row_count, "
        "count(*) FILTER (WHERE o.actual_cost IS NULL) AS uncosted_rows, "
        "n.record_version AS expected_version, n.settlement_status AS expected_status "
        "FROM old_rows o JOIN now_rows n ON o.shipment_id = n.shipment_id "
        "WHERE o.record_version <> n.record_version GROUP BY 1, 2, 3, 6, 7",
    ),
    "reconcile_report": planted_report("SELECT * FROM report"),
    "reconcile_summary": planted_report(
        "SELECT validation_result, count(*) AS date_count FROM report GROUP BY 1"
    ),
    "reconcile_verdict": planted_report(
        """totals AS (
  SELECT count(*) AS total_dates,
         count(*) FILTER (WHERE validation_result = 'PASS') AS pass_dates,
         count(*) FILTER (WHERE validation_result = 'MISSING_IN_SINK') AS missing_in_sink_dates,
         count(*) FILTER (WHERE validation_result = 'MISSING_IN_SOURCE') AS missing_in_source_dates,
         count(*) FILTER (WHERE validation_result = 'MISMATCH') AS mismatch_dates,
         CAST(0 AS BIGINT) AS stale_dates FROM report)""",
        """SELECT *, CASE WHEN total_dates = pass_dates THEN 'ALL_PASSED' ELSE concat_ws(',',
  CASE WHEN mismatch_dates > 0 THEN 'MISMATCHES' END,
  CASE WHEN missing_in_sink_dates > 0 THEN 'MISSING_DATES' END,
  CASE WHEN missing_in_source_dates > 0 THEN 'EXTRA_DATES' END) END AS verdict FROM totals"""
    ),
    "reconcile_spine": planted_report(
        SPINE,
        """SELECT CAST(d AS VARCHAR) AS shipment_date, row_count_source, row_count_sink,
       coalesce(row_diff, 0) AS row_diff, coalesce(validation_result, 'ABSENT') AS validation_result,
       max_version_source, max_version_sink, status_source, status_sink
FROM spine LEFT JOIN report ON report.shipment_date = CAST(d AS VARCHAR)"""
    ),
    "deep_reconcile": with_ctes(
        BASE,
        NOW,
        OLD_3,
        planted("old_rows"),
        REPORT,
        DIFFERENCES,
        """SELECT r.shipment_date, row_count_source, row_count_sink, row_diff,
       CASE WHEN validation_result = 'PASS' AND EXISTS (
              SELECT 1 FROM differences d WHERE CAST(coalesce(d.date_source, d.date_sink) AS VARCHAR) = r.shipment_date)
            THEN 'STALE' ELSE validation_result END AS validation_result,
       max_version_source, max_version_sink, status_source, status_sink FROM report r""",
    ),
    "partition_row_diff": with_ctes(
        BASE, NOW, OLD_3, planted("old_rows"), DIFFERENCES, "SELECT * FROM differences"
    ),
    "partition_row_diff_repeated": with_ctes(
        """lines AS (
  SELECT l_orderkey AS shipment_id, CAST(l_shipdate AS DATE) AS shipment_date,
         CAST(1 + l_linenumber % 4 AS INTEGER) AS record_version,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS estimated_cost, CAST(l_quantity AS DECIMAL(10,2)) AS weight_lbs
  FROM lineitem)""",
        """others AS (
  SELECT * REPLACE (CAST(CASE WHEN day(shipment_date) = 9 AND record_version = 2 THEN 4 ELSE record_version END
                         AS INTEGER) AS record_version)
  FROM lines WHERE shipment_id % 7 <> 0 AND NOT (shipment_id % 5 = 0 AND record_version = 3))""",
        *(
            f"""{side} AS (
  SELECT shipment_id, count(*) AS n, max(shipment_date) AS newest, max(record_version) AS version,
         list_sort(list((shipment_date, record_version, estimated_cost, weight_lbs))) AS rows_of_id
  FROM {rows} GROUP BY 1)"""
            for side, rows in (("a", "lines"), ("b", "others"))
        ),
        """SELECT coalesce(a.shipment_id, b.shipment_id) AS shipment_id, a.newest AS date_source, b.newest AS date_sink,
       CASE WHEN b.n IS NULL THEN 'ONLY_IN_SOURCE' WHEN a.n IS NULL THEN 'ONLY_IN_SINK' ELSE 'CHANGED' END AS difference,
       coalesce(a.n, 0) AS rows_source, coalesce(b.n, 0) AS rows_sink,
       a.version AS version_source, b.version AS version_sink,
       CAST(NULL AS DECIMAL(18,2)) AS actual_cost_source, CAST(NULL AS DECIMAL(18,2)) AS actual_cost_sink
FROM a FULL OUTER JOIN b ON a.shipment_id = b.shipment_id WHERE a.rows_of_id IS DISTINCT FROM b.rows_of_id""",
    ),
    "failing_dates": planted_report(
        "SELECT shipment_date, validation_result FROM report WHERE validation_result <> 'PASS'"
    ),
    "full_load": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows"),
    "full_load_resumed": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows"),
    "full_load_progress": with_ctes(
        BASE,
        "dates AS (SELECT shipment_date, count(*) AS n FROM base GROUP BY 1)",
        "cut AS (SELECT *, (sum(n) OVER (ORDER BY shipment_date) - n) // ((SELECT count(*) + 9 FROM base) // 10) AS batch FROM dates)",
        """runs AS (SELECT CASE WHEN max(shipment_date) < DATE '1998-06-01' THEN 1 ELSE 2 END AS run,
                 count(*) AS dates_written, sum(n) AS rows_written FROM cut GROUP BY batch)""",
        """SELECT CAST(run AS INTEGER) AS run, CAST(sum(dates_written) AS BIGINT) AS dates_written,
       CAST(sum(rows_written) AS BIGINT) AS rows_written FROM runs GROUP BY run""",
    ),
    "append_insert": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows"),
    "update_in_place": with_ctes(BASE, NOW, f"SELECT {COLUMNS} FROM now_rows"),
    "advance_boundary": with_ctes(BASE, NOW, OLD_1, rebuilt(f"shipment_date = {AS_OF} - 31")),
    "advance_boundary_moved": with_ctes(
        BASE,
        f"SELECT count(DISTINCT shipment_date) AS dates_moved, count(*) AS rows_moved "
        f"FROM base WHERE shipment_date = {AS_OF} - 31",
    ),
    "boundary_preview": with_ctes(
        BASE, NOW, OLD_1, f"moved AS ({rebuilt(f'shipment_date = {AS_OF} - 31')})", VERSION_COUNTS + "moved"
    ),
    "rebuild_window": with_ctes(BASE, NOW, OLD_11, rebuilt(IN_WINDOW)),
    "rebuild_missed_night": with_ctes(
        BASE, NOW, OLD_11, rebuilt(f"shipment_date BETWEEN {AS_OF} - 70 AND {AS_OF} - 1")
    ),
    "rebuild_one_date": with_ctes(BASE, NOW, OLD_11, rebuilt(f"shipment_date = {AS_OF} - 31")),
    "rebuild_empty_date": with_ctes(
        BASE,
        NOW,
        OLD_1,
        f"SELECT {COLUMNS} FROM now_rows WHERE {IN_WINDOW} AND {PLANTED_SOURCE_RULE}\n"
        f"UNION ALL SELECT {COLUMNS} FROM old_rows WHERE NOT ({IN_WINDOW})",
    ),
    "rebuild_summary": with_ctes(
        BASE,
        f"""SELECT CAST(60 AS BIGINT) AS dates_rebuilt, DATE '2001-06-03' AS oldest_date,
       DATE '2001-08-01' AS newest_date,
       count(*) FILTER (WHERE {PLANTED_SOURCE_RULE}) AS rows_written,
       count(DISTINCT shipment_date) FILTER (WHERE {PLANTED_SOURCE_RULE}) AS dates_replaced,
       count(DISTINCT shipment_date) FILTER (WHERE NOT ({PLANTED_SOURCE_RULE})) AS dates_cleared
FROM base WHERE {IN_WINDOW}""",
    ),
    "rebuild_by_date": with_ctes(
        BASE,
        SPINE,
        f"""SELECT d AS shipment_date,
       count(shipment_id) FILTER (WHERE {PLANTED_SOURCE_RULE}) AS rows_written,
       CASE WHEN count(shipment_id) = 0 THEN 'ABSENT'
            WHEN count(shipment_id) FILTER (WHERE {PLANTED_SOURCE_RULE}) = 0 THEN 'CLEARED'
            ELSE 'REPLACED' END AS action
FROM spine LEFT JOIN base ON shipment_date = d GROUP BY d""",
    ),
    "rebuild_with_bad_date": with_ctes(
        BASE,
        SPINE,
        f"""SELECT d AS shipment_date,
       CASE WHEN count(shipment_id) FILTER (WHERE {BAD_ROW}) > 0 THEN 0 ELSE count(shipment_id) END AS rows_written,
       CASE WHEN count(shipment_id) = 0 THEN 'ABSENT'
            WHEN count(shipment_id) FILTER (WHERE {BAD_ROW}) > 0 THEN 'FAILED' ELSE 'REPLACED' END AS action,
       count(shipment_id) FILTER (WHERE {BAD_ROW}) AS bad_rows
FROM spine LEFT JOIN base ON shipment_date = d GROUP BY d""",
    ),
    "rebuild_around_bad_date": with_ctes(
        BASE,
        NOW,
        OLD_11,
        rebuilt(f"{IN_WINDOW} AND shipment_date NOT IN (SELECT shipment_date FROM base WHERE {BAD_ROW})"),
    ),
    "rebuild_with_failing_read": with_ctes(
        BASE,
        SPINE,
        f"""SELECT d AS shipment_date, CASE WHEN d = {AS_OF} - 23 THEN 0 ELSE count(shipment_id) END AS rows_written,
       CASE WHEN count(shipment_id) = 0 THEN 'ABSENT' WHEN d = {AS_OF} - 23 THEN 'FAILED' ELSE 'REPLACED' END AS action,
       CAST(0 AS BIGINT) AS bad_rows
FROM spine LEFT JOIN base ON shipment_date = d GROUP BY d""",
    ),
    "rebuild_around_failing_read": with_ctes(
        BASE, NOW, OLD_11, rebuilt(f"{IN_WINDOW} AND shipment_date <> {AS_OF} - 23")
    ),
    "repair_cycle_dates": planted_report(
        """SELECT CAST(shipment_date AS DATE) AS shipment_date, coalesce(row_count_source, 0) AS rows_written,
       CASE WHEN row_count_source IS NULL THEN 'CLEARED' ELSE 'REPLACED' END AS action, CAST(0 AS BIGINT) AS bad_rows
FROM report WHERE validation_result <> 'PASS'"""
    ),
    "frozen_guard_changed": with_ctes(
        BASE,
        NOW,
        OLD_11,
        f"""SELECT o.shipment_date, count(*) AS rows_before, count(*) AS rows_after
FROM old_rows o JOIN now_rows n ON o.shipment_id = n.shipment_id
WHERE o.shipment_date BETWEEN {AS_OF} - 70 AND {AS_OF} - 61 AND o.record_version <> n.record_version GROUP BY 1""",
    ),
    "repair_cycle": with_ctes(
        BASE,
        NOW,
        f"source_rows AS (SELECT * FROM now_rows WHERE {IN_WINDOW} AND {PLANTED_SOURCE_RULE}),\n"
        "sink_rows AS (SELECT * FROM source_rows)",
        REPORT,
        "SELECT * FROM report",
    ),
    "frozen_guard_unrecorded": with_ctes(
        BASE,
        """SELECT shipment_date, count(*) AS rows_before,
       nullif(count(*) FILTER (WHERE shipment_id % 2 = 0), 0) AS rows_after
FROM base WHERE shipment_date BETWEEN DATE '2001-04-01' AND DATE '2001-04-30' GROUP BY 1 HAVING count(*) > count(*) FILTER (WHERE shipment_id % 2 = 0)""",
    ),
    "frozen_guard": with_ctes(
        BASE,
        "SELECT count(DISTINCT shipment_date) AS frozen_dates, count(*) AS frozen_rows, "
        f"CAST(0 AS BIGINT) AS changed_dates FROM base WHERE shipment_date < {AS_OF} - 60",
    ),
    "validation_widened": with_ctes(
        BASE,
        NOW,
        f"""SELECT CAST(shipment_date AS VARCHAR) AS shipment_date, 'PASS' AS validation_result,
       count(*) AS row_count_source, count(*) AS row_count_sink
FROM now_rows WHERE shipment_date BETWEEN {AS_OF} - 70 AND {AS_OF} - 1 GROUP BY 1""",
    ),
    "strategy_comparison_repeated": with_ctes(
        LINES,
        "now_rows AS (SELECT * FROM lines)",
        "old_rows AS (SELECT * REPLACE (CAST(CASE WHEN shipment_date >= DATE '2001-06-20' THEN 1 + record_version % 4 "
        "ELSE record_version END AS INTEGER) AS record_version) FROM lines WHERE shipment_id % 7 <> 0)",
        STRATEGIES,
    ),
    "strategy_comparison": with_ctes(
        BASE,
        NOW,
        "known AS (SELECT * FROM base WHERE shipment_date < DATE '2001-08-01')",
        settled("old_rows", 1, "known"),
        STRATEGIES,
    ),
}

# Profiles from stored states give the rows of those that read the table.
ORACLE_SQL |= {
    f"{name}_states": ORACLE_SQL[name]
    for name in (
        "table_overview",
        "status_breakdown",
        "carrier_profile",
        "recent_dates_top10",
        "version_counts",
        "band_violations",
    )
}
