"""Code -> label maps and age bands.

Both are short literal lists, turned into a chain of ``CASE WHEN`` (built-in
``F.when``), so they stay inside whole-stage codegen; no join, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billetic.functions._cols import as_col

# ---------------------------------------------------------------------------
# The reporting labels must be exactly these strings (UTF-8).
# ---------------------------------------------------------------------------

# Ticket support, keyed by the support label code.
SUPPORT_LABELS: dict[int, str] = {
    899240000: "Billet Papier",
    899240001: "Carte MOBIB",
    899240002: "M-Ticketing TEC",
    899240003: "M-Ticketing SNCB",
    899240004: "Ticket sans contact",
}

# Sales channel, keyed by the equipment type code; other codes pass through.
EQUIPMENT_LABELS: dict[str, str] = {
    "MG": "POS (guichet), Application dépositaire",
    "DI": "Valideur embarqué",
    "VM": "Valideur évènementiel",
    "TW": "VAD partenaire de rechargement, site web, Mobile",
    "PC": "Portable de contrôle",
}

# Age bands: (lowest age, highest age, label), then the label of everything
# else (older, negative ages and unknown birth dates).
AGE_BANDS: list[tuple[int, int, str]] = [
    (0, 12, "0-12 ans"),
    (13, 18, "12-18 ans"),
    (19, 24, "18-24 ans"),
    (25, 40, "24-40 ans"),
    (41, 65, "40-65 ans"),
]
AGE_BAND_OTHER = "65+"

# Client type of the client-by-line report.
KNOWN_CLIENT = "Client Connu"
UNKNOWN_CLIENT = "Client Non Connu"
UNKNOWN_CLIENT_ID = "N/A"
ANONYMOUS_CARD = "0"

# ---------------------------------------------------------------------------


def label_map(c, mapping: dict, default: Column | None = None) -> Column:
    """Simple ``CASE c WHEN k THEN v ... [ELSE default] END``.

    Without ``default`` an unknown code (and NULL) gives NULL; pass
    ``default=col`` for the pass-through form (``ELSE c``).
    """
    col = as_col(c)
    out = None
    for key, label in mapping.items():
        cond = col == F.lit(key)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return default if default is not None else F.lit(None).cast("string")
    return out.otherwise(default) if default is not None else out


def support_label(code) -> Column:
    return label_map(code, SUPPORT_LABELS)


def equipment_label(code) -> Column:
    return label_map(code, EQUIPMENT_LABELS, default=as_col(code))


def age_band(age, open_low: bool = False) -> Column:
    """Age band of an integer age.

    ``open_low=False`` (variant A): the first band is ``BETWEEN 0 AND 12``, so
    negative ages fall to the last label. ``open_low=True`` (variant B): the
    first band is ``<= 12``, so negative ages are in the first band. NULL
    age is the last label in both.
    """
    a = as_col(age)
    out = None
    for i, (lo, hi, label) in enumerate(AGE_BANDS):
        cond = (a <= hi) if (open_low and i == 0) else a.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(AGE_BAND_OTHER))
