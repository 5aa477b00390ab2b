"""Logical sources (section 1.2 of the survey) as stored tables.

In production each logical source is a table of its own; ``load`` reads it by
name from a directory of Parquet tables (or from the session catalog when
``root`` is None). The job functions never care where a DataFrame came from;
``sources.fixtures`` builds the same DataFrames from the driver's test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Logical source -> the columns the jobs read.
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "validation": ("validation_id", "DTHR_OPERATION", "bd_linkedcustomer", "bd_mobibnumber",
                   "NUM_LIGNE", "LIBEL_LONG_PRODUIRE", "bd_support_class"),
    "sales": ("bd_sales_transaction_id", "bd_transaction_date", "bd_contact_linked",
              "bd_productlonglabel", "bd_articlelonglabel", "bd_equipment_type",
              "bd_global_amount"),
    "sale_detail": ("bd_sales_transaction_id", "bd_support_serial_number_lookup",
                    "bd_contact_linked", "bd_article_code_lookup", "bd_contract_start_date",
                    "bd_contract_end_date"),
    "support": ("id", "bd_id_support_label"),
    "contact": ("Id", "birthdate", "createdon"),
    "article": ("bd_articleid", "bd_productlonglabel"),
    "line": ("NUM_LIGNE", "LIBEL_LIGNE"),
    "card": ("bd_mobibnumber",),
}


def load(spark: SparkSession, name: str, root: str | None = None,
         table: str | None = None) -> DataFrame:
    """Scan one logical source, projected to the columns the jobs use
    (further pruning and filter pushdown happen per job). ``table`` is the
    stored name of the source (a catalog table, or a folder under ``root``);
    it defaults to the logical name."""
    cols = SOURCE_COLUMNS[name]
    stored = table or name
    df = spark.table(stored) if root is None else spark.read.parquet(f"{root}/{stored}")
    return df.select(*cols)


class CatalogSources:
    """Same interface as ``FixtureSources`` over real tables.

    ``names`` maps a logical source to its stored table where the names
    differ, e.g. ``{"validation": "Prod_Validation",
    "sale_detail": "staging.stg_sale_detail"}`` for catalog tables.
    """

    def __init__(self, spark: SparkSession, root: str | None = None,
                 names: dict[str, str] | None = None):
        self.spark, self.root, self.names = spark, root, dict(names or {})

    def _get(self, name: str) -> DataFrame:
        return load(self.spark, name, self.root, self.names.get(name))

    def validation(self, kind: str | None = None) -> DataFrame:
        return self._get("validation")

    def sales(self) -> DataFrame:
        return self._get("sales")

    def sale_detail(self) -> DataFrame:
        return self._get("sale_detail")

    def support(self) -> DataFrame:
        return self._get("support")

    def contact(self) -> DataFrame:
        return self._get("contact")

    def article(self) -> DataFrame:
        return self._get("article")

    def line(self) -> DataFrame:
        return self._get("line")

    def card(self) -> DataFrame:
        return self._get("card")
