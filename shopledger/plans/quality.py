"""The blocking quality gate.

Row rules and volume are observed while Silver is written, or take one pass per table
without a shuffle of rows; key uniqueness shuffles keys alone. Orphans and the payment
reconciliation come from one aggregate per key over parent and children together, so a
key that holds a large share of a table costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators import SkewPolicy, hot_keys, skew_join
from shopledger.plans.silver import Silver
from shopledger.schemas import (
    AMOUNT_TOLERANCE,
    EVENT_TYPES,
    MINIMUM_ROWS,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PRIMARY_KEYS,
    RAW_PERSONAL_COLUMNS,
    SILVER_SCHEMAS,
    SOURCE_TABLES,
)

REQUIRED_KEYS = "required_keys_not_null"
UNIQUE_KEYS = "primary_keys_unique"
BUSINESS_STATUSES = "valid_business_statuses"
POSITIVE_AMOUNTS = "positive_amounts"
REFERENTIAL_INTEGRITY = "referential_integrity"
PAYMENT_RECONCILES = "payment_reconciles_to_items"
MINIMUM_VOLUME = "minimum_expected_volume"
RAW_PII_ABSENT = "raw_pii_absent_from_silver"
# A check of a run's extraction, next to those of Silver.
RECORDS_READABLE = "source_records_readable"
CHECKS = (
    REQUIRED_KEYS,
    UNIQUE_KEYS,
    BUSINESS_STATUSES,
    POSITIVE_AMOUNTS,
    REFERENTIAL_INTEGRITY,
    PAYMENT_RECONCILES,
    MINIMUM_VOLUME,
    RAW_PII_ABSENT,
)


ROW_CHECKS = (REQUIRED_KEYS, BUSINESS_STATUSES, POSITIVE_AMOUNTS)

_DOMAINS = {
    "order_status": ORDER_STATUSES,
    "payment_method": PAYMENT_METHODS,
    "event_type": EVENT_TYPES,
}
_ABOVE_ZERO = ("quantity", "unit_price", "line_amount", "payment_amount")
_NOT_NEGATIVE = ("revenue",)


def row_rules(table: str, row: str = "") -> dict[str, Column]:
    """When a row of a Silver table fails each check that looks at single rows. A
    null value fails the key check alone. Events may lack a campaign or a customer.
    ``row`` is the struct that holds the row, if it is one."""
    columns = SILVER_SCHEMAS[table].fieldNames()

    def value(column: str) -> Column:
        return F.col(f"{row}.{column}" if row else column)

    failing = {
        REQUIRED_KEYS: [
            value(c).isNull() for c in columns if c.endswith("_id") and table in SOURCE_TABLES
        ],
        BUSINESS_STATUSES: [~value(c).isin(*_DOMAINS[c]) for c in columns if c in _DOMAINS],
        POSITIVE_AMOUNTS: [
            *(value(c) <= 0 for c in columns if c in _ABOVE_ZERO),
            *(value(c) < 0 for c in columns if c in _NOT_NEGATIVE),
        ],
    }
    return {check: reduce(Column.__or__, rules) for check, rules in failing.items() if rules}


def written_measures(table: str) -> dict[str, Column]:
    """What to observe while a Silver table is written, so that its row rules and
    volume need no scan of their own. The row count is observed in any case."""
    return {check: F.count_if(rule) for check, rule in row_rules(table).items()}


def changed_measures(table: str) -> dict[str, Column]:
    """By how much the measures of a table move with rows (was, now) of its changes;
    ``was`` is null for a new key."""
    old, new = row_rules(table, "was"), row_rules(table, "now")
    moved = {
        check: F.count_if(new[check]) - F.count_if(F.col("was").isNotNull() & old[check]) for check in new
    }
    return {"rows_added": F.count_if(F.col("was").isNull())} | moved


# (child, parent, key)
RELATIONSHIPS = (
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("payments", "orders", "order_id"),
    ("campaign_events", "customers", "customer_id"),
)


class QualityGateError(RuntimeError):
    """A blocking check failed."""


def _table_checks(
    table: str, checks: Iterable[str], minimum_rows: Mapping[str, int]
) -> dict[str, Column]:
    """What one row per task decides: nothing but counts enters the shuffle."""
    rules = row_rules(table)
    found: dict[str, Column] = {}
    for check in checks:
        if check == UNIQUE_KEYS:
            found[check] = F.count(F.lit(1))
        elif check == MINIMUM_VOLUME:
            if table in minimum_rows:
                found[check] = (F.count(F.lit(1)) < minimum_rows[table]).cast("bigint")
        elif check in rules:
            found[check] = F.count_if(rules[check])
    return found


def measured_failures(
    spark: SparkSession,
    measures: Mapping[str, Mapping[str, int]],
    checks: Iterable[str],
    minimum_rows: Mapping[str, int],
) -> DataFrame:
    """Rows (table_name, check_name, failures) of row rules and volume from what was
    observed when the tables were written."""
    wanted, rows = set(checks), []
    for table, found in measures.items():
        rows += [(table, check, found[check]) for check in ROW_CHECKS if check in found and check in wanted]
        if MINIMUM_VOLUME in wanted and table in minimum_rows:
            rows.append((table, MINIMUM_VOLUME, int(found["rows"] < minimum_rows[table])))
    return spark.createDataFrame(rows, "table_name string, check_name string, failures long")


def _labelled(counts: DataFrame, table: str, checks: list[str]) -> DataFrame:
    return counts.unpivot([], checks, "check_name", "failures").select(
        F.lit(table).alias("table_name"), "check_name", "failures"
    )


def table_failures(
    silver: Silver,
    checks: Iterable[str],
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
) -> DataFrame:
    """Rows (table_name, check_name, failures). Rules and volume of a table are one
    plain aggregate. Keys are counted by themselves and taken off the number of
    rows, so their shuffle carries the key alone; null keys count as duplicates."""
    checks = list(checks)
    parts = []
    for table, df in silver.items():
        found = _table_checks(table, checks, minimum_rows)
        if found:
            wide = df.agg(*(value.alias(check) for check, value in found.items()))
            parts.append(_labelled(wide, table, list(found)))
        if UNIQUE_KEYS in checks:
            keys = df.agg((-F.count_distinct(PRIMARY_KEYS[table])).alias(UNIQUE_KEYS))
            parts.append(_labelled(keys, table, [UNIQUE_KEYS]))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_name", "check_name")
        .agg(F.sum("failures").alias("failures"))
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: how many child rows have no parent. A null key is an orphan."""
    return (
        child.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(parent.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
    )


_TOTAL = "decimal(22,2)"
_AGREES = "payment agrees"


def key_level(silver: Silver, parent: str, key: str) -> DataFrame:
    """One row per key value with all that the checks ask of it: whether the parent
    knows it (null is unknown), ``n_<child>`` rows of each child, and for orders the
    total of the items and the number of payments with an amount.

    Parent and children meet in one tagged union under one aggregate, combined
    map-side: each table is shuffled once by the key, and a key with a large share of
    a child is one row per map task."""
    children = [child for child, of, on in RELATIONSHIPS if (of, on) == (parent, key)]
    parts = [silver[parent].select(key, F.lit(True).alias("known"))]
    for child in children:
        columns = [key, F.lit(1).alias(f"n_{child}")]
        if child == "order_items":
            columns.append(F.col("line_amount").alias("item_amount"))
        elif child == "payments":
            columns.append(F.col("payment_amount").isNotNull().cast("int").alias("n_amounts"))
        parts.append(silver[child].select(*columns))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = [F.coalesce(F.max("known"), F.lit(False)).alias("known")]
    found += [F.coalesce(F.sum(f"n_{child}"), F.lit(0)).alias(f"n_{child}") for child in children]
    if "item_amount" in union.columns:
        found.append(F.round(F.sum("item_amount"), 2).cast(_TOTAL).alias("item_total"))
    if "n_amounts" in union.columns:
        found.append(F.coalesce(F.sum("n_amounts"), F.lit(0)).alias("n_amounts"))
    return union.groupBy(key).agg(*found).withColumn("known", F.col("known") & F.col(key).isNotNull())


def _parents() -> dict[tuple[str, str], list[str]]:
    found: dict[tuple[str, str], list[str]] = {}
    for child, parent, key in RELATIONSHIPS:
        found.setdefault((parent, key), []).append(child)
    return found


def _relationship(child: str, key: str, parent: str) -> str:
    return f"{child}.{key} -> {parent}"


def orphans_by_relationship(silver: Silver) -> DataFrame:
    """Rows (relationship, failures): child rows whose key the parent does not know."""
    return relationship_failures(silver, payments=False).where(F.col("relationship") != PAYMENT_RECONCILES)


def relationship_failures(silver: Silver, *, payments: bool = True) -> DataFrame:
    """Orphans of each relationship and, under the name of that check, the payments
    that differ from their order's items, from one pass at the level of each key."""
    parts = []
    for (parent, key), children in _parents().items():
        level = key_level(silver, parent, key)
        unknown = {
            _relationship(child, key, parent): F.when(~F.col("known"), F.col(f"n_{child}")).otherwise(0)
            for child in children
        }
        if payments and parent == "orders":
            parts.append(_order_failures(level, unknown, silver["payments"]))
            continue
        sums = [F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in unknown.items()]
        wide = level.agg(*sums)
        parts.append(wide.unpivot([], [F.col(f"`{c}`") for c in wide.columns], "relationship", "failures"))
    summed = reduce(DataFrame.unionByName, parts).groupBy("relationship")
    return summed.agg(F.sum("failures").cast("bigint").alias("failures"))


def _order_failures(orders: DataFrame, unknown: Mapping[str, Column], payments: DataFrame) -> DataFrame:
    """Rows (relationship, failures) of the ``unknown`` children and of the payments that
    differ from their order's items.

    Amounts have two places, so a payment agrees with its order within the tolerance
    if its amount is one of three values. The order level gives its counts and these
    values in one go; payments meet the values under an aggregate on order and amount,
    in which a hot order is spread over its amounts. Comparable payments that do not
    agree differ."""
    comparable = F.col("order_id").isNotNull() & F.col("item_total").isNotNull()
    cent = F.lit(AMOUNT_TOLERANCE).cast(_TOTAL)
    total = F.col("item_total")

    def row(name: str, n: Column, order: Column | None = None, amount: Column | None = None, right: bool = False) -> Column:
        return F.struct(
            F.lit(name).alias("relationship"),
            (F.lit(None) if order is None else order).cast("string").alias("order_id"),
            (F.lit(None) if amount is None else amount).cast(_TOTAL).alias("amount"),
            n.cast("bigint").alias("n"),
            F.lit(right).alias("right"),
        )

    counts = [row(name, n) for name, n in unknown.items()]
    counts.append(row(PAYMENT_RECONCILES, F.when(comparable, F.col("n_amounts")).otherwise(0)))
    near = [row(_AGREES, F.lit(0), F.col("order_id"), value, True) for value in (total - cent, total, total + cent)]
    given = F.when(comparable & (F.col("n_amounts") > 0), F.array(*counts, *near)).otherwise(F.array(*counts))
    paid = payments.where(F.col("payment_amount").isNotNull() & F.col("order_id").isNotNull()).select(
        row(_AGREES, F.lit(1), F.col("order_id"), F.col("payment_amount")).alias("given")
    )
    met = orders.select(F.explode(given).alias("given")).unionByName(paid).select("given.*")
    summed = met.groupBy("relationship", "order_id", "amount").agg(F.sum("n").alias("n"), F.max("right").alias("right"))
    agrees = F.col("relationship") == _AGREES
    return summed.where(~agrees | F.col("right")).select(
        F.when(agrees, PAYMENT_RECONCILES).otherwise(F.col("relationship")).alias("relationship"),
        F.when(agrees, -F.col("n")).otherwise(F.col("n")).alias("failures"),
    )


def payment_mismatches(
    payments: DataFrame, items: DataFrame, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Payments whose amount differs from the total of their order's items. A
    payment without items, or with a null amount, is not one of them."""
    totals = items.groupBy("order_id").agg(F.round(F.sum("line_amount"), 2).alias("item_total"))
    paired = skew_join(
        payments,
        totals,
        "order_id",
        left_hot=hot_keys(payments, "order_id", policy),
        left_id="payment_id",
    )
    difference = F.abs(F.col("payment_amount") - F.col("item_total"))
    return paired.where(difference > F.lit(AMOUNT_TOLERANCE).cast("decimal(12,2)"))


def raw_personal_columns(df: DataFrame) -> list[str]:
    return sorted({name.lower() for name in df.columns} & set(RAW_PERSONAL_COLUMNS))


def _as_checks(failures: DataFrame) -> DataFrame:
    return failures.groupBy("check_name").agg(F.sum("failures").alias("failures"))


def _named(df: DataFrame, check: str) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), "failures")


def check_frame(
    silver: Silver,
    checks: Iterable[str] = CHECKS,
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
    policy: SkewPolicy = SkewPolicy(),
    measures: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """One row per check: (check_name, failures, passed, blocking, detail).

    ``measures`` are those observed when these tables were written (see
    ``written_measures``); row rules and volume then read nothing. The ``policy`` is of no
    effect any more: no check joins rows of a hot key."""
    checks = list(checks)
    parts = []
    row_checks = [c for c in checks if c in (*ROW_CHECKS, UNIQUE_KEYS, MINIMUM_VOLUME)]
    if measures is not None:
        spark = silver["customers"].sparkSession
        parts.append(_as_checks(measured_failures(spark, measures, row_checks, minimum_rows)))
        row_checks = [c for c in row_checks if c == UNIQUE_KEYS]
    if row_checks:
        parts.append(_as_checks(table_failures(silver, row_checks, minimum_rows)))
    if {REFERENTIAL_INTEGRITY, PAYMENT_RECONCILES} & set(checks):
        found = relationship_failures(silver, payments=PAYMENT_RECONCILES in checks)
        check = F.when(F.col("relationship") == PAYMENT_RECONCILES, PAYMENT_RECONCILES).otherwise(REFERENTIAL_INTEGRITY)
        by_check = found.groupBy(check.alias("check_name")).agg(F.sum("failures").alias("failures"))
        parts.append(by_check.where(F.col("check_name").isin(checks)))
    detail = F.lit("")
    if RAW_PII_ABSENT in checks:
        # The answer is in the schema; the one-row aggregate only carries it.
        present = raw_personal_columns(silver["customers"])
        spark = silver["customers"].sparkSession
        schema_row = spark.range(1).select(F.lit(len(present)).cast("bigint").alias("failures"))
        parts.append(_named(schema_row, RAW_PII_ABSENT))
        detail = F.when(
            F.col("check_name") == RAW_PII_ABSENT,
            F.lit(f"Personal data in Silver: {', '.join(present)}" if present else ""),
        ).otherwise(detail)
    return reduce(DataFrame.unionByName, parts).select(
        "check_name",
        "failures",
        (F.col("failures") == 0).alias("passed"),
        F.lit(True).alias("blocking"),
        detail.alias("detail"),
    )


def with_item_fixture(silver: Silver, fixture: DataFrame) -> Silver:
    """Silver with extra order items put in front of the gate."""
    items = silver["order_items"].unionByName(fixture, allowMissingColumns=True)
    return {**silver, "order_items": items}


def gate_verdict(checks: DataFrame) -> DataFrame:
    """Fold the check rows into one row: status and blocking failures."""
    failed = F.count_if(F.col("blocking") & ~F.col("passed"))
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), failed.alias("blocking_failures")
    ).select(
        F.when(F.col("blocking_failures") > 0, "failed").otherwise("passed").alias("status"),
        "checks",
        "blocking_failures",
    )


def run_gate(
    silver: Silver,
    *,
    run_id: str,
    item_fixture: DataFrame | None = None,
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
    policy: SkewPolicy = SkewPolicy(),
    raise_on_failure: bool = True,
    measures: Mapping[str, Mapping[str, int]] | None = None,
) -> dict:
    """Run all checks and return the report; raise if a blocking one failed.

    Only the eight check rows reach the driver. ``measures`` as in ``check_frame``; a
    fixture is not among them, so with one the tables are read.
    """
    if item_fixture is not None:
        silver, measures = with_item_fixture(silver, item_fixture), None
    checks = check_frame(silver, CHECKS, minimum_rows, policy, measures)
    rows = {row["check_name"]: row.asDict() for row in checks.collect()}
    report = gate_report(run_id, [rows[name] for name in CHECKS])
    if raise_on_failure:
        require_passed(report)
    return report


def gate_report(run_id: str, checks: list[dict]) -> dict:
    failed = [c["check_name"] for c in checks if c["blocking"] and not c["passed"]]
    return {
        "run_id": run_id,
        "checked_at": datetime.now(timezone.utc),
        "status": "failed" if failed else "passed",
        "checks": checks,
        "blocking_failures": len(failed),
        "failed": failed,
    }


def with_rejected(report: dict, rejected: int, most: int) -> dict:
    """The report with a check of the records that extraction set aside. Up to ``most``
    of them are counted and named, and the run goes on."""
    failures = rejected if rejected > most else 0
    check = {
        "check_name": RECORDS_READABLE,
        "failures": failures,
        "passed": not failures,
        "blocking": True,
        "detail": f"{rejected} records set aside, {most} allowed",
    }
    checked = gate_report(report["run_id"], [*report["checks"], check])
    return checked | {"checked_at": report["checked_at"]}


def require_passed(report: dict) -> None:
    if report["status"] != "passed":
        raise QualityGateError(
            f"Run {report['run_id']} is stopped: blocking checks failed ({', '.join(report['failed'])})"
        )
