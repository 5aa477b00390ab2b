"""Reporting targets: fixed schemas (section 1.3 of the survey).

Every job returns exactly one of these schemas (``conform``); how it lands in
storage is the writers' business (``sources.sinks``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Target:
    name: str
    schema: T.StructType
    partition: str                      # date column the table is partitioned by
    keys: tuple[str, ...] = ()          # declared (unenforced) unique key, if any

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


_TYPES = {
    "date": T.DateType(),
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def _schema(*cols: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in cols])


# Names, columns and types of the reporting tables.
TITLE_SALES = Target(
    "pbi_AchatTitre",
    _schema(("SalesDate", "date"), ("support_type", "string"), ("Sales", "int"),
            ("unique_cards", "int"), ("average_sales", "int")),
    "SalesDate",
    keys=("SalesDate", "support_type"),
)
ACTIVE_CLIENTS = Target(
    "pbi_ClientActifs",
    _schema(("DateOfExecution", "date"), ("CurrentMonthActiveClients", "bigint"),
            ("LastMonthActiveClients", "bigint"), ("LastYearSameMonthActiveClients", "bigint")),
    "DateOfExecution",
)
ACTIVE_CONTRACT_CLIENTS = Target(
    "pbi_ClientActifsContract",
    _schema(("DateOfExecution", "date"), ("type_abonnement", "string"),
            ("Categorie_age", "string"), ("CurrentMonthActiveClients", "bigint"),
            ("LastMonthActiveClients", "bigint"), ("LastYearSameMonthActiveClients", "bigint")),
    "DateOfExecution",
)
CLIENTS_BY_LINE = Target(
    "pbi_ClientAgeLigne",
    _schema(("DateOfExecution", "date"), ("ClientID", "string"), ("Age", "int"),
            ("LIBEL_LIGNE", "string"), ("AgeCategory", "string"), ("ClientType", "string")),
    "DateOfExecution",
)
AVG_WEEKLY_VALIDATIONS = Target(
    "pbi_ClientAverageValidations",
    _schema(("ClientID", "string"), ("AccountCreationDate", "date"),
            ("DateOfExecution", "date"), ("ValidationCount", "double"), ("Weeks", "int"),
            ("AverageValidationsPerWeek", "double")),
    "DateOfExecution",
)
TOTAL_CLIENTS = Target(
    "pbi_ClientTotal",
    _schema(("DateOfExecution", "date"), ("type_abonnement", "string"),
            ("total_clients", "int")),
    "DateOfExecution",
)
PURCHASE_DELAY = Target(
    "pbi_DelaiAchat",
    _schema(("bd_contact_linked", "string"), ("bd_articlelonglabel", "string"),
            ("bd_support_class", "string"), ("max_transaction_date", "date"),
            ("first_validation_date_after_transaction", "date"), ("Delai", "int")),
    "max_transaction_date",
)
VALIDATIONS_BY_AGE = Target(
    "pbi_ValidationClient",
    _schema(("Date_de_validation", "date"), ("Type_abonnement", "string"),
            ("Type_support", "string"), ("Age", "int"), ("Categorie_age", "string"),
            ("Nombre_de_validation", "int")),
    "Date_de_validation",
)
# J8's kept state: its counts with the birth year in place of the age.
BY_BIRTH_YEAR = Target(
    "etat_ValidationClient",
    _schema(("Date_de_validation", "date"), ("Type_abonnement", "string"), ("Type_support", "string"),
            ("Annee_naissance", "int"), ("Nombre_de_validation", "int")),
    "Date_de_validation",
)
VALIDATION_COUNTS = Target(
    "pbi_ValidationCounts",
    _schema(("Date_de_validation", "date"), ("Type_abonnement", "string"),
            ("Nombre_de_validation", "int"), ("Nombre_de_validation_annee_precedente", "int")),
    "Date_de_validation",
    keys=("Date_de_validation", "Type_abonnement"),
)
# J9's kept state: the distinct taps of a day as words of 64 ids.
TAP_WORDS = Target(
    "etat_ValidationCounts",
    _schema(("Date_de_validation", "date"), ("Type_abonnement", "string"), ("id_word", "bigint"),
            ("id_bits", "bigint")),
    "Date_de_validation",
)
VALIDATION_RATE = Target(
    "pbi_ValidationRatePerUser",
    _schema(("ValidationDate", "date"), ("AverageValidationsPerUser", "double")),
    "ValidationDate",
)
SALES_BY_CHANNEL = Target(
    "pbi_VentesCanal",
    _schema(("DateOfExecution", "date"), ("EquipementType", "string"),
            ("ProductType", "string"), ("SalesQuant", "int"), ("Sales", "int")),
    "DateOfExecution",
)

ALL_TARGETS = (
    TITLE_SALES, ACTIVE_CLIENTS, ACTIVE_CONTRACT_CLIENTS, CLIENTS_BY_LINE,
    AVG_WEEKLY_VALIDATIONS, TOTAL_CLIENTS, PURCHASE_DELAY, VALIDATIONS_BY_AGE,
    VALIDATION_COUNTS, VALIDATION_RATE, SALES_BY_CHANNEL,
)


def conform(df: DataFrame, target: Target) -> DataFrame:
    """Select the target's columns in its order with its types (the
    reference's implicit casts on insert, made explicit)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
