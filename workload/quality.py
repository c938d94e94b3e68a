"""Data-quality checks over whole tables. Result rows without time stamp and details."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.operators.gold import dq_trend
from oreflow.operators.incremental import IncrementalChecks
from oreflow.operators.quality import (
    AcceptedValuesCheck,
    DataQualityChecker,
    NotNullCheck,
    RangeCheck,
    ReferentialCheck,
    RegexCheck,
    RowCountCheck,
    Severity,
    UniquenessCheck,
    blocking,
    summarise,
)
from oreflow.sources.paths import scratch_path
from workload.inputs import RAW_ORDERS_SQL, raw_orders, table

STATUSES = [" pending ", "delivered"]


def results(suite, rows):
    """Check results, with the rate rounded as it is stored."""
    return suite.results(rows).withColumn("pass_rate", F.round("pass_rate", 6))


def suite_of(*checks, name="raw.orders"):
    suite = DataQualityChecker(name)
    for check in checks:
        suite.add_check(check)
    return suite


def on_raw_orders(*make_checks):
    def query(spark, sf_dir):
        return results(suite_of(*[make() for make in make_checks]), raw_orders(spark, sf_dir))

    return query


def unique_lineitem(spark, sf_dir):
    suite = suite_of(
        UniquenessCheck(["l_orderkey", "l_linenumber"]),
        UniquenessCheck("l_orderkey", threshold=0.8),
        name="lineitem",
    )
    return results(suite, table(spark, sf_dir, "lineitem"))


def regex_events(spark, sf_dir):
    suite = suite_of(
        RegexCheck("props", r'^\{"k": \d\d\}$'), RegexCheck("event_type", "i"), name="events"
    )
    return results(suite, table(spark, sf_dir, "events"))


def row_count(spark, sf_dir):
    suite = suite_of(RowCountCheck(), RowCountCheck(max_rows=10), name="lineitem")
    return results(suite, table(spark, sf_dir, "lineitem"))


def range_lineitem(spark, sf_dir):
    suite = suite_of(
        RangeCheck("l_quantity", 1, 40),
        RangeCheck("l_discount", min_val=0.0),
        RangeCheck("l_tax"),
        name="lineitem",
    )
    return results(suite, table(spark, sf_dir, "lineitem"))


def referential(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    parts = table(spark, sf_dir, "part")
    suite = suite_of(
        ReferentialCheck("l_partkey", parts, "p_partkey"),
        ReferentialCheck("l_orderkey", customers, "c_custkey", Severity.WARN),
        name="lineitem",
    )
    return results(suite, table(spark, sf_dir, "lineitem"))


def full_suite():
    return suite_of(
        RowCountCheck(min_rows=1),
        NotNullCheck("order_id"),
        NotNullCheck("customer_id", threshold=0.1),
        UniquenessCheck("order_id"),
        UniquenessCheck(["order_id", "status", "order_date"], Severity.WARN, 0.5),
        RangeCheck("unit_price", min_val=0.0, max_val=400000.0),
        AcceptedValuesCheck("status", STATUSES),
        RegexCheck("order_id", r"^ORD-\d+$"),
    )


def full(spark, sf_dir):
    return results(full_suite(), raw_orders(spark, sf_dir))


def incremental(spark, sf_dir):
    """The suite over three loads, each read when it comes; the first comes twice."""
    checks = IncrementalChecks(full_suite(), scratch_path(spark, "checks"))
    rows = raw_orders(spark, sf_dir)
    load = F.coalesce("quantity", F.lit(0)) % 3
    for name in (0, 1, 2, 0):
        checks.add(rows.filter(load == name), str(name))
    return results(checks, spark)


def summary(spark, sf_dir):
    return summarise(full_suite().results(raw_orders(spark, sf_dir)))


def gate(spark, sf_dir):
    """The checks that would stop a load."""
    return blocking(results(full_suite(), raw_orders(spark, sf_dir)))


def stored_runs(spark, sf_dir):
    """Two runs of one suite and one of another, stored and read back."""
    path = scratch_path(spark, "dq")
    orders, lines = full_suite(), suite_of(NotNullCheck("l_tax"), name="lineitem")
    lines.add_check(UniquenessCheck(["l_orderkey", "l_linenumber"]))
    for suite, rows, run_ts in (
        (orders, raw_orders(spark, sf_dir), "2024-01-01T08:00:00+00:00"),
        (orders, table_as_raw(spark, sf_dir), "2024-01-01T20:00:00+00:00"),
        (lines, table(spark, sf_dir, "lineitem"), "2024-01-02T08:00:00+00:00"),
    ):
        suite.run(rows, run_ts=run_ts)
        suite.persist_results(spark, path)
    return spark.read.parquet(path)


def table_as_raw(spark, sf_dir):
    return raw_orders(spark, sf_dir).dropDuplicates()


def append_results(spark, sf_dir):
    return stored_runs(spark, sf_dir).drop("details")


def trend(spark, sf_dir):
    out = dq_trend(stored_runs(spark, sf_dir))
    return out.withColumn("avg_pass_rate", F.round("avg_pass_rate", 4))


def aggregate_counts(spark, sf_dir):
    """Rows, rows under a condition, and distinct composite keys with NULL as a value."""
    return raw_orders(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("status").isNull()).alias("n_no_status"),
        F.count_distinct(F.struct("customer_id", "product_id")).alias("n_keys"),
    )


def result_sql(source, name, dataset, severity, failing, threshold=0.0, total="count(*)"):
    """One result row computed by counting, independent of the suite."""
    return f"""
SELECT '{name}' AS check_name, '{dataset}' AS dataset,
  CASE WHEN failing <= {threshold} * total THEN 'PASS' ELSE '{severity.upper()}' END AS status,
  '{severity}' AS severity, total AS total_rows, failing AS failing_rows,
  total - failing AS passing_rows,
  round(1.0 - CAST(failing AS DOUBLE) / total, 6) AS pass_rate
FROM (SELECT {total} AS total, CAST({failing} AS BIGINT) AS failing FROM {source})"""


def count_sql(source, dataset, low, high):
    passed = f"(n >= {low} AND n <= {high})"
    return f"""
SELECT 'row_count' AS check_name, '{dataset}' AS dataset,
  CASE WHEN {passed} THEN 'PASS' ELSE 'WARN' END AS status, 'warn' AS severity,
  n AS total_rows, CAST(CASE WHEN {passed} THEN 0 ELSE 1 END AS BIGINT) AS failing_rows,
  CAST(CASE WHEN {passed} THEN n ELSE 0 END AS BIGINT) AS passing_rows,
  CASE WHEN {passed} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pass_rate
FROM (SELECT count(*) AS n FROM {source})"""


def failing(condition):
    return f"count(*) FILTER (WHERE {condition})"


def repeats(source, columns):
    """Scalar: rows beyond the first of each key, NULL being a value."""
    return f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}))"


def joined(*parts, raw=True):
    head = f"WITH {RAW_ORDERS_SQL}" if raw else ""
    return head + " UNION ALL ".join(parts)


def order_row(name, severity, condition, threshold=0.0):
    return result_sql("raw_orders", name, "raw.orders", severity, condition, threshold)


def full_rows(source="raw_orders"):
    def row(name, severity, condition, threshold=0.0):
        return result_sql(source, name, "raw.orders", severity, condition, threshold)

    return [
        count_sql(source, "raw.orders", 1, "n"),
        row("not_null:order_id", "fail", failing("order_id IS NULL")),
        row("not_null:customer_id", "fail", failing("customer_id IS NULL"), 0.1),
        row("unique:order_id", "fail", repeats(source, "order_id")),
        row(
            "unique:order_id,status,order_date",
            "warn",
            repeats(source, "order_id, status, order_date"),
            0.5,
        ),
        row(
            "range:unit_price",
            "fail",
            failing("CAST(unit_price AS DOUBLE) < 0.0 OR CAST(unit_price AS DOUBLE) > 400000.0"),
        ),
        row(
            "accepted_values:status",
            "warn",
            failing("status NOT IN (' pending ', 'delivered')"),
        ),
        row(
            "regex:order_id",
            "fail",
            failing("order_id IS NOT NULL AND NOT regexp_matches(order_id, '^ORD-[0-9]+$')"),
        ),
    ]


def orphan_row(column, severity, parent, parent_column):
    absent = (
        f"{column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {parent})"
    )
    source = f"(SELECT {absent} AS orphan FROM lineitem)"
    return result_sql(source, f"references:{column}", "lineitem", severity, failing("orphan"))


_LINES = [
    result_sql("lineitem", "not_null:l_tax", "lineitem", "fail", failing("l_tax IS NULL")),
    result_sql(
        "lineitem",
        "unique:l_orderkey,l_linenumber",
        "lineitem",
        "fail",
        repeats("lineitem", "l_orderkey, l_linenumber"),
    ),
]

_RUNS = f"""
WITH {RAW_ORDERS_SQL}, dedup_orders AS (SELECT DISTINCT * FROM raw_orders),
runs AS (
  SELECT *, '2024-01-01T08:00:00+00:00' AS run_ts FROM ({" UNION ALL ".join(full_rows())})
  UNION ALL
  SELECT *, '2024-01-01T20:00:00+00:00' AS run_ts
  FROM ({" UNION ALL ".join(full_rows("dedup_orders"))})
  UNION ALL
  SELECT *, '2024-01-02T08:00:00+00:00' AS run_ts FROM ({" UNION ALL ".join(_LINES)})
)"""

def default_thresholds(spark, sf_dir):
    """The suite's thresholds hold where a check has none, also against an explicit 0.0."""
    suite = DataQualityChecker("raw.orders", null_threshold=0.5, duplicate_threshold=0.9)
    suite.add_check(NotNullCheck("customer_id")).add_check(NotNullCheck("order_id", threshold=0.0))
    suite.add_check(UniquenessCheck("order_id"))
    return results(suite, raw_orders(spark, sf_dir))


def range_text(spark, sf_dir):
    rows = raw_orders(spark, sf_dir).withColumn("day", F.col("order_date").cast("string"))
    return results(suite_of(RangeCheck("day", min_val="1995-01-01", max_val="1997-12-31")), rows)


ENTRIES = {
    "dq_default_thresholds": (
        default_thresholds,
        joined(
            order_row("not_null:customer_id", "fail", failing("customer_id IS NULL"), 0.5),
            order_row("not_null:order_id", "fail", failing("order_id IS NULL")),
            order_row("unique:order_id", "fail", repeats("raw_orders", "order_id"), 0.9),
        ),
    ),
    "dq_range_text": (
        range_text,
        joined(
            order_row(
                "range:day",
                "fail",
                failing(
                    "strftime(order_date, '%Y-%m-%d') < '1995-01-01'"
                    " OR strftime(order_date, '%Y-%m-%d') > '1997-12-31'"
                ),
            )
        ),
    ),
    "dq_accepted_mixed": (
        on_raw_orders(lambda: AcceptedValuesCheck("channel", [1, 2, "  urgent"])),
        joined(
            order_row(
                "accepted_values:channel", "warn", failing("channel NOT IN ('1', '2', '  urgent')")
            )
        ),
    ),
    "dq_not_null": (
        on_raw_orders(
            lambda: NotNullCheck("order_id"),
            lambda: NotNullCheck("status", Severity.WARN, threshold=0.3),
        ),
        joined(
            order_row("not_null:order_id", "fail", failing("order_id IS NULL")),
            order_row("not_null:status", "warn", failing("status IS NULL"), 0.3),
        ),
    ),
    "dq_uniqueness": (
        unique_lineitem,
        joined(
            _LINES[1],
            result_sql(
                "lineitem",
                "unique:l_orderkey",
                "lineitem",
                "fail",
                repeats("lineitem", "l_orderkey"),
                0.8,
            ),
            raw=False,
        ),
    ),
    "dq_accepted_values": (
        on_raw_orders(
            lambda: AcceptedValuesCheck("status", STATUSES),
            lambda: AcceptedValuesCheck("quantity", [1, 2, 3], Severity.FAIL),
        ),
        joined(
            order_row(
                "accepted_values:status",
                "warn",
                failing("status NOT IN (' pending ', 'delivered')"),
            ),
            order_row(
                "accepted_values:quantity", "fail", failing("quantity NOT IN (1, 2, 3)")
            ),
        ),
    ),
    "dq_row_count": (
        row_count,
        joined(
            count_sql("lineitem", "lineitem", 1, "n"),
            count_sql("lineitem", "lineitem", 1, 10),
            raw=False,
        ),
    ),
    "dq_range": (
        range_lineitem,
        joined(
            result_sql(
                "lineitem",
                "range:l_quantity",
                "lineitem",
                "fail",
                failing("l_quantity < 1 OR l_quantity > 40"),
            ),
            result_sql(
                "lineitem", "range:l_discount", "lineitem", "fail", failing("l_discount < 0.0")
            ),
            result_sql("lineitem", "range:l_tax", "lineitem", "fail", failing("FALSE")),
            raw=False,
        ),
    ),
    "dq_regex": (
        regex_events,
        joined(
            result_sql(
                "events",
                "regex:props",
                "events",
                "fail",
                failing("""NOT regexp_matches(props, '^\\{"k": [0-9][0-9]\\}$')"""),
            ),
            result_sql(
                "events",
                "regex:event_type",
                "events",
                "fail",
                failing("event_type NOT LIKE '%i%'"),
            ),
            raw=False,
        ),
    ),
    "dq_referential": (
        referential,
        joined(
            orphan_row("l_partkey", "fail", "part", "p_partkey"),
            orphan_row("l_orderkey", "warn", "customer", "c_custkey"),
            raw=False,
        ),
    ),
    "dq_suite": (full, joined(*full_rows())),
    "dq_incremental": (incremental, joined(*full_rows())),
    "dq_gate": (
        gate,
        f"""WITH {RAW_ORDERS_SQL}, r AS ({" UNION ALL ".join(full_rows())})
            SELECT * FROM r WHERE severity = 'fail' AND status <> 'PASS'""",
    ),
    "dq_summary": (
        summary,
        f"""WITH {RAW_ORDERS_SQL}, r AS ({" UNION ALL ".join(full_rows())})
            SELECT dataset, count(*) AS total_checks,
              count(*) FILTER (WHERE status = 'PASS') AS passed,
              count(*) FILTER (WHERE status <> 'PASS') AS failed,
              CAST(count(*) FILTER (WHERE status = 'PASS') AS DOUBLE) / count(*) AS pass_rate
            FROM r GROUP BY dataset""",
    ),
    "dq_results_append": (append_results, f"{_RUNS} SELECT * FROM runs"),
    "dq_trend": (
        trend,
        f"""{_RUNS} SELECT dataset, check_name, CAST(substr(run_ts, 1, 10) AS DATE) AS run_date,
              round(avg(pass_rate), 4) AS avg_pass_rate, count(*) AS nb_runs
            FROM runs GROUP BY ALL""",
    ),
    "aggregate_counts": (
        aggregate_counts,
        f"""WITH {RAW_ORDERS_SQL} SELECT count(*) AS n_rows,
              count(*) FILTER (WHERE status IS NULL) AS n_no_status,
              (SELECT count(*) FROM (SELECT DISTINCT customer_id, product_id FROM raw_orders))
                AS n_keys
            FROM raw_orders""",
    ),
}
