"""Sales KPIs: title sales by support (J1), total clients (J6), sales by
channel (J11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billetic.functions import equipment_label, int_div, support_label, to_day
from billetic.operators import (
    DateWindow,
    count_at_least,
    date_spine,
    day_range,
    in_key_range,
    last_day_histogram,
    last_seen,
    on_days,
    with_period_bounds,
)
from billetic.operators.window import TWELVE_MONTHS_AGO
from billetic.session import staged
from billetic.sources.targets import SALES_BY_CHANNEL, TITLE_SALES, TOTAL_CLIENTS, conform

TX = "bd_sales_transaction_id"
CARD = "bd_support_serial_number_lookup"


def title_sales_by_support(
    sale_detail: DataFrame, support: DataFrame, sales: DataFrame, window: DateWindow
) -> DataFrame:
    """Per sale day and support type, sale lines, distinct cards and
    lines per card (whole number).

    The reference joins sale lines to sales rows many-to-many on the
    transaction, so a transaction with k sales rows counts each of its sale
    lines k times. The sales are reduced before they meet, to one row per
    (transaction, day) carrying k, and a sale line adds k to its (day, card);
    ``Sales`` is the sum. No k-fold row is ever built, even for a huge
    transaction.

    Sale lines carry no date, so the window's transactions must prune them.
    These are staged first (one scan of the sales gives keys and counts, so a
    call runs that job and reads the least and the greatest key). Then

    * that range of keys reaches the scan of the lines: transactions are
      numbered through time, so lines sorted by them are read for the window
      only;
    * Spark plans with the keys' true size. Up to
      ``spark.sql.autoBroadcastJoinThreshold`` they are broadcast and no line
      is shuffled; up to
      ``spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold`` a
      runtime bloom filter of them drops other lines at the scan;
    * beyond both, lines stored by transaction (``sources.colocated``) stay
      where they are, and only the staged keys are shuffled to them.
    """
    sa = on_days(sales.select(TX, "bd_transaction_date"), "bd_transaction_date", window,
                 "SalesDate")
    per_tx = staged(sa.filter(F.col(TX).isNotNull()).groupBy(TX, "SalesDate").agg(
        F.count(F.lit(1)).alias("_k")), "window-sales")
    per_tx = per_tx.filter(F.col("_k") > 0)     # always true; Spark makes bloom filters of filtered scans only
    sd = in_key_range(sale_detail.select(TX, CARD), TX, per_tx).filter(F.col(CARD).isNotNull())
    lines = sd.join(per_tx, TX).groupBy("SalesDate", CARD).agg(F.sum("_k").alias("_lines"))
    joined = lines.join(support, F.col(CARD) == F.col("id"))
    agg = joined.groupBy(
        "SalesDate", support_label("bd_id_support_label").alias("support_type")
    ).agg(
        F.sum("_lines").alias("Sales"),
        F.countDistinct(CARD).alias("unique_cards"),
    )
    return conform(
        agg.withColumn("average_sales", int_div("Sales", "unique_cards")), TITLE_SALES
    )


CLIENT_KEYS = ["type_abonnement"]
CLIENT = ["_contact", "_anon_tx"]


def sale_clients(sales: DataFrame, since: dt.date) -> DataFrame:
    """``(type_abonnement, _contact, _anon_tx, _day)`` of the sales from
    ``since`` on: the client of a sale is its contact, or without one its
    transaction."""
    s = day_range(sales.select(TX, "bd_transaction_date", "bd_contact_linked",
                               "bd_productlonglabel"), "bd_transaction_date", since)
    return s.select(
        F.col("bd_productlonglabel").alias("type_abonnement"),
        F.col("bd_contact_linked").alias("_contact"),
        F.when(F.col("bd_contact_linked").isNull(), F.col(TX)).alias("_anon_tx"),
        to_day("bd_transaction_date").alias("_day"),
    )


def total_clients(sales: DataFrame, window: DateWindow) -> DataFrame:
    """Per execution date d and product, distinct identified contacts
    plus distinct anonymous transactions with a sale day >= d - 12 months
    (no upper bound).

    An entity (a contact, or a transaction without contact) counts for d iff
    its *latest* sale day is >= d - 12 months. So the facts are reduced once
    to (product, latest day) -> number of entities, a table bounded by days x
    products, and each date is answered from it. No fact row is copied per
    execution date, whatever the window length.
    """
    clients = sale_clients(sales, window.earliest_lookback())
    return total_clients_of(last_seen(clients, CLIENT, "_day", CLIENT_KEYS), window)


def total_clients_of(latest: DataFrame, window: DateWindow) -> DataFrame:
    """J6 from the latest day of each client and product (``last_seen`` of
    ``sale_clients`` over the window's lookback, or a kept one)."""
    hist = last_day_histogram(latest, CLIENT, CLIENT_KEYS)
    spine = with_period_bounds(date_spine(latest.sparkSession, window)).select(
        "d", TWELVE_MONTHS_AGO)
    out = count_at_least(hist, spine, "last_day", F.col(TWELVE_MONTHS_AGO),
                         keys=CLIENT_KEYS, out="total_clients")
    return conform(out.withColumnRenamed("d", "DateOfExecution"), TOTAL_CLIENTS)


def sales_by_channel(sales: DataFrame, window: DateWindow) -> DataFrame:
    """Per sale day, channel label and product: distinct transactions
    and the summed amount, landed in an int (truncated toward zero)."""
    s = on_days(
        sales.select(TX, "bd_transaction_date", "bd_equipment_type", "bd_productlonglabel",
                     "bd_global_amount"),
        "bd_transaction_date", window, "DateOfExecution",
    )
    agg = s.groupBy(
        "DateOfExecution",
        equipment_label("bd_equipment_type").alias("EquipementType"),
        F.col("bd_productlonglabel").alias("ProductType"),
    ).agg(
        F.countDistinct(TX).alias("SalesQuant"),
        F.sum("bd_global_amount").alias("Sales"),
    )
    return conform(agg, SALES_BY_CHANNEL)
