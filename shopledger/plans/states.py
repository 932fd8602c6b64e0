"""Mart states: totals that a run updates by what it changed.

Each state is a sum over orders or events by some key, so the totals after a run are
those before it, less what the changed orders and events added then, plus what they add
now. A state knows how many of them stand behind each row; a row with none goes. Marts
are read from the states alone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import surrogate_key
from shopledger.plans import marts
from shopledger.plans.warehouse import calendar_attributes

_MONEY, _COUNT = T.DecimalType(38, 2), T.LongType()


@dataclass(frozen=True)
class State:
    """Totals ``sums`` by ``keys``. ``count`` is the total that tells how much stands
    behind a row; ``totals`` makes them from rows of ``base`` and the products."""

    name: str
    base: str
    keys: Mapping[str, T.DataType]
    sums: Mapping[str, T.DataType]
    count: str
    totals: Callable[[DataFrame, DataFrame], DataFrame]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, kind) for c, kind in (self.keys | self.sums).items()])

    def of(self, rows: DataFrame, products: DataFrame) -> DataFrame:
        """The state of these rows alone."""
        found = self.totals(rows, products)
        return found.select(*self.keys, *(F.col(c).cast(kind).alias(c) for c, kind in self.sums.items()))

    def difference(self, was: DataFrame, now: DataFrame) -> DataFrame:
        """What to add to a state when the rows behind ``was`` become those behind ``now``."""
        off = was.select(*self.keys, *((-F.col(c)).cast(kind).alias(c) for c, kind in self.sums.items()))
        return self._summed(off.unionByName(now))

    def plus(self, state: DataFrame, difference: DataFrame) -> DataFrame:
        return self._summed(state.unionByName(difference)).where(F.col(self.count) != 0)

    def _summed(self, rows: DataFrame) -> DataFrame:
        sums = (F.sum(c).cast(kind).alias(c) for c, kind in self.sums.items())
        return rows.groupBy(*self.keys).agg(*sums)


def _product_totals(sales: DataFrame, products: DataFrame) -> DataFrame:
    return marts.product_performance(sales, products)


def _days(rows: DataFrame, _: DataFrame) -> DataFrame:
    return rows.groupBy("calendar_date").agg(F.count(F.lit(1)).alias("happened"))


def _channels(rows: DataFrame, _: DataFrame) -> DataFrame:
    return rows.groupBy("channel").agg(F.count(F.lit(1)).alias("events"))


_TEXT = T.StringType()

# ``activity`` has one row (calendar_date) per order and event that has a time, ``events``
# are those of Silver; the others are facts.
STATES = {
    s.name: s
    for s in (
        State(
            "state_days",
            "fact_sales",
            {"date_key": T.IntegerType()},
            {"revenue": _MONEY, "orders": _COUNT, "units": _COUNT},
            "orders",
            lambda sales, _: marts.day_totals(sales),
        ),
        State(
            "state_customers",
            "fact_sales",
            {"customer_key": _TEXT},
            {"revenue": _MONEY, "orders": _COUNT},
            "orders",
            lambda sales, _: marts.customer_totals(sales),
        ),
        State(
            "state_products",
            "fact_sales",
            {"category": _TEXT, "product_name": _TEXT},
            {"revenue": _MONEY, "units": _COUNT, "orders": _COUNT},
            "orders",
            _product_totals,
        ),
        State(
            "state_campaigns",
            "fact_campaign_events",
            {"campaign_id": _TEXT, "channel_key": _TEXT},
            {"clicks": _COUNT, "conversions": _COUNT, "revenue": _MONEY, "events": _COUNT},
            "events",
            lambda events, _: marts.campaign_totals(events),
        ),
        State("state_activity", "activity", {"calendar_date": T.DateType()}, {"happened": _COUNT}, "happened", _days),
        State("state_channels", "channels", {"channel": _TEXT}, {"events": _COUNT}, "events", _channels),
    )
}


def activity(orders: DataFrame, events: DataFrame) -> DataFrame:
    """The day of each order and event."""
    order_days = orders.select(F.to_date("order_timestamp").alias("calendar_date"))
    return order_days.union(events.select(F.to_date("event_timestamp").alias("calendar_date")))


def dim_date(states: Mapping[str, DataFrame]) -> DataFrame:
    return calendar_attributes(states["state_activity"].select("calendar_date"))


def dim_channel(states: Mapping[str, DataFrame]) -> DataFrame:
    return states["state_channels"].select(surrogate_key("channel").alias("channel_key"), "channel")


def marts_of(states: Mapping[str, DataFrame], customers: DataFrame) -> dict[str, DataFrame]:
    """The five marts from the states; ``customers`` is the dimension."""
    days = states["state_days"]
    daily = marts.daily_view(days, dim_date(states))
    totals = days.agg(*(F.sum(c).alias(c) for c in ("revenue", "orders", "units")))
    products = states["state_products"]
    return {
        "vw_executive_summary": totals.select(
            F.round("revenue", 2).alias("revenue"),
            # No order leaves a count of zero, and no revenue.
            F.coalesce("orders", F.lit(0)).alias("orders"),
            marts.ratio(F.col("revenue"), F.col("orders")).alias("average_order_value"),
            "units",
        ),
        "vw_daily_sales": daily,
        "vw_product_performance": products,
        "vw_customer_segments": marts.segment_view(states["state_customers"], customers),
        "vw_campaign_performance": marts.campaign_view(states["state_campaigns"], dim_channel(states)),
    }
