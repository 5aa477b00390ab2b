"""The eight logical ticketing sources, derived from the driver's TPC-H-style
tables (``FIXTURES.md`` section 2).

Production code would read the real tables with ``sources.catalog.load``;
these derivations exist so every job can run, and be checked, on the given
parquet data. They are lazy DataFrames: a job's filters and column pruning
flow through them into the parquet scans (for example a window filter on
``bd_transaction_date`` becomes a pushed filter on ``orders.o_orderdate``).

The modulo rules below define *which* rows are anonymous, unlabelled or
missing a birth date -- they never drop fact rows to make anything cheaper.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md section 2).
# ---------------------------------------------------------------------------
ANONYMOUS_ORDER_MOD = 7          # sales: no contact when o_orderkey % 7 = 0
NO_SUPPORT_LINENUMBER = 7        # sale detail: no card on line number 7
CONTRACT_DAYS_PER_UNIT = 8       # contract end = ship date + quantity * 8 days
SUPPORT_CODE_BASE = 899240000    # support label code = base + s_suppkey % 6
SUPPORT_CODE_MOD = 6
BIRTH_BASE = "1930-01-01"        # birth = base + (c_custkey * 7919) % 33000 days
BIRTH_MULT, BIRTH_MOD = 7919, 33000
NO_BIRTH_MOD = 11                # no birth date when c_custkey % 11 = 0
CREATED_BASE = "2023-06-01"      # created = base + (c_custkey * 13) % 240 days
CREATED_MULT, CREATED_MOD = 13, 240
NO_CARD_MOD = 13                 # card register leaves out c_custkey % 13 = 0
LINE_MOD = 25                    # line number = id % 25
ANON_EVENT_MOD = 10              # validation a: anonymous when event_id % 10 = 0
SUPPORT_CLASS_MOD = 3            # validation a: support class 'S' || event_id % 3
ANON_SUPPLIER_MOD = 10           # validation b: anonymous when l_suppkey % 10 = 0
VALIDATION_ID_MULT = 8           # validation b: id = l_orderkey * 8 + l_linenumber
EQUIPMENT_BY_PRIORITY = {
    "1-URGENT": "MG",
    "2-HIGH": "DI",
    "3-MEDIUM": "VM",
    "4-NOT SPECIFIED": "TW",
}
EQUIPMENT_FINISHED, EQUIPMENT_OTHER = "PC", "ZZ"   # else PC if status 'F', else ZZ
# ---------------------------------------------------------------------------


def _days_after(base: str, n: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), n.cast("int"))


@dataclass
class FixtureSources:
    """Logical sources over one scale-factor directory of driver tables.

    ``validation`` selects the validation fixture: ``"a"`` (dense, one month,
    from ``events``) or ``"b"`` (sparse, several years, from ``lineitem``).
    """

    spark: SparkSession
    root: str
    validation_kind: str = "a"
    _cache: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    # -- facts ---------------------------------------------------------------
    def sales(self) -> DataFrame:
        o, li, p = self.table("orders"), self.table("lineitem"), self.table("part")
        equipment = None
        for prio, code in EQUIPMENT_BY_PRIORITY.items():
            cond = F.col("o_orderpriority") == prio
            equipment = F.when(cond, code) if equipment is None else equipment.when(cond, code)
        equipment = equipment.otherwise(
            F.when(F.col("o_orderstatus") == "F", EQUIPMENT_FINISHED).otherwise(EQUIPMENT_OTHER)
        )
        joined = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).join(
            p, F.col("p_partkey") == F.col("l_partkey")
        )
        return joined.select(
            F.col("o_orderkey").alias("bd_sales_transaction_id"),
            F.col("o_orderdate").alias("bd_transaction_date"),
            F.when(F.col("o_orderkey") % ANONYMOUS_ORDER_MOD != 0, F.col("o_custkey")).alias(
                "bd_contact_linked"
            ),
            F.col("p_type").alias("bd_productlonglabel"),
            F.col("p_brand").alias("bd_articlelonglabel"),
            equipment.alias("bd_equipment_type"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("bd_global_amount"),
        )

    def sale_detail(self) -> DataFrame:
        li, o = self.table("lineitem"), self.table("orders")
        joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        days = (F.col("l_quantity") * CONTRACT_DAYS_PER_UNIT).cast("int")
        return joined.select(
            F.col("l_orderkey").alias("bd_sales_transaction_id"),
            F.when(F.col("l_linenumber") != NO_SUPPORT_LINENUMBER, F.col("l_suppkey")).alias(
                "bd_support_serial_number_lookup"
            ),
            F.col("o_custkey").alias("bd_contact_linked"),
            F.col("l_partkey").alias("bd_article_code_lookup"),
            F.col("l_shipdate").alias("bd_contract_start_date"),
            (F.col("l_shipdate") + F.make_dt_interval(days=days)).alias("bd_contract_end_date"),
        )

    def validation(self, kind: str | None = None) -> DataFrame:
        kind = kind or self.validation_kind
        if kind == "a":
            return self._validation_a()
        if kind == "b":
            return self._validation_b()
        raise ValueError(f"unknown validation fixture {kind!r}")

    def _validation_a(self) -> DataFrame:
        e = self.table("events")
        anon = F.col("event_id") % ANON_EVENT_MOD == 0
        return e.select(
            F.col("event_id").alias("validation_id"),
            F.col("ts").alias("DTHR_OPERATION"),
            F.when(~anon, F.col("user_id")).alias("bd_linkedcustomer"),
            F.when(anon, F.lit("0")).otherwise(F.col("user_id").cast("string")).alias(
                "bd_mobibnumber"
            ),
            (F.col("event_id") % LINE_MOD).alias("NUM_LIGNE"),
            F.col("event_type").alias("LIBEL_LONG_PRODUIRE"),
            F.concat(F.lit("S"), (F.col("event_id") % SUPPORT_CLASS_MOD).cast("string")).alias(
                "bd_support_class"
            ),
        )

    def _validation_b(self) -> DataFrame:
        li, o, p = self.table("lineitem"), self.table("orders"), self.table("part")
        joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(
            p, F.col("p_partkey") == F.col("l_partkey")
        )
        anon = F.col("l_suppkey") % ANON_SUPPLIER_MOD == 0
        return joined.select(
            (F.col("l_orderkey") * VALIDATION_ID_MULT + F.col("l_linenumber")).alias(
                "validation_id"
            ),
            (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias(
                "DTHR_OPERATION"
            ),
            F.when(~anon, F.col("o_custkey")).alias("bd_linkedcustomer"),
            F.when(anon, F.lit("0")).otherwise(F.col("o_custkey").cast("string")).alias(
                "bd_mobibnumber"
            ),
            (F.col("l_suppkey") % LINE_MOD).alias("NUM_LIGNE"),
            F.col("p_type").alias("LIBEL_LONG_PRODUIRE"),
            F.col("l_returnflag").alias("bd_support_class"),
        )

    # -- dimensions ----------------------------------------------------------
    def support(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("id"),
            (F.lit(SUPPORT_CODE_BASE) + F.col("s_suppkey") % SUPPORT_CODE_MOD)
            .cast("int")
            .alias("bd_id_support_label"),
        )

    def contact(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.table("customer").select(
            c.alias("Id"),
            F.when(
                c % NO_BIRTH_MOD != 0, _days_after(BIRTH_BASE, (c * BIRTH_MULT) % BIRTH_MOD)
            ).alias("birthdate"),
            _days_after(CREATED_BASE, (c * CREATED_MULT) % CREATED_MOD).alias("createdon"),
        )

    def card(self) -> DataFrame:
        return (
            self.table("customer")
            .filter(F.col("c_custkey") % NO_CARD_MOD != 0)
            .select(F.col("c_custkey").cast("string").alias("bd_mobibnumber"))
        )

    def article(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("bd_articleid"),
            F.col("p_type").alias("bd_productlonglabel"),
        )

    def line(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("NUM_LIGNE"),
            F.col("n_name").alias("LIBEL_LIGNE"),
        )
