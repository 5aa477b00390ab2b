"""As-of join: each row with the next row of another table (J7-a)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _day(time: Column) -> Column:
    return F.to_date(time)


def next_row_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
    ties: Sequence[str] = (), payload: Sequence[str] = (), how: str = "inner",
    part: Callable[[Column], Column] = _day,
) -> DataFrame:
    """Every left row with the first right row of its key at or after its own
    time: the left columns, ``right_time``, ``ties`` and ``payload``. Right
    rows of one time are ordered by ``ties``, nulls last. ``keys`` are
    columns of both tables; the other names must differ. ``how="left"`` keeps
    left rows without a next row, ``"inner"`` drops them. Null keys and null
    times never match.

    Plan: both tables go into one stream, tagged, and one sort per key and
    part of time answers all left rows in it, reading from the latest row to
    the earliest and remembering the last right row seen. A left row after the
    last right row of its part takes the first one of the next part that has
    any: these borders are one row per key and part, reduced in the map tasks
    first, and carried back from part to part. So a key with a third of all
    rows is sorted a day at a time, in as many tasks as it has days, and no row
    is copied (an inequality join would pair each left row with every later
    right row).
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    keys, found = list(keys), [right_time, *ties, *payload]
    clash = {c.lower() for c in left.columns} & {c.lower() for c in found}
    if clash:
        raise ValueError(f"both tables have {sorted(clash)}")
    kind = right.schema[right_time].dataType

    # the left row is one struct, so its names can't meet the helper columns
    l_rows = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         F.col(left_time).cast(kind).alias("_at"), F.struct(*left.columns).alias("_left"))
    r_rows = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          F.col(right_time).alias("_at"),
                          F.struct(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(found)]).alias("_right"))
    by = [f"_k{i}" for i in range(len(keys))]
    known = F.col("_at").isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    l_known, r_known = l_rows.filter(known), r_rows.filter(known)

    def tie_order(prefix: str, down: bool) -> list[Column]:
        cols = [F.col(f"{prefix}_v{i + 1}") for i in range(len(ties))]
        return [c.desc_nulls_first() if down else c.asc_nulls_last() for c in cols]

    stream = l_known.select(*by, "_at", "_left", F.lit(None).cast(r_rows.schema["_right"].dataType).alias("_right")) \
        .unionByName(r_known.select(*by, "_at", F.lit(None).cast(l_rows.schema["_left"].dataType).alias("_left"),
                                    "_right")).withColumn("_part", part(F.col("_at")))
    # from the latest on; of one time right rows first, of these the first in order last
    down = Window.partitionBy(*by, "_part").orderBy(
        F.col("_at").desc(), F.col("_right").isNotNull().desc(), *tie_order("_right.", True))
    inside = stream.withColumn("_next", F.last("_right", ignorenulls=True).over(down)).filter(
        F.col("_left").isNotNull())

    first = Window.partitionBy(*by, "_part").orderBy(F.col("_at"), *tie_order("_right.", False))
    borders = r_known.withColumn("_part", part(F.col("_at"))).withColumn(
        "_rn", F.row_number().over(first)).filter("_rn = 1").select(*by, "_part", F.col("_right").alias("_border"))
    # parts that only have left rows need the border after them, too
    parts = l_known.select(*by, part(F.col("_at")).alias("_part")).distinct().join(
        borders, [*by, "_part"], "full").select(*by, "_part", "_border")
    later = Window.partitionBy(*by).orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*by, "_part", F.last("_border", ignorenulls=True).over(later).alias("_after")).filter(
        F.col("_after").isNotNull())

    joined = inside.join(carried, [*by, "_part"], "left").select(
        "_left", F.coalesce("_next", "_after").alias("_found"))
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    else:
        joined = joined.unionByName(l_rows.filter(~F.coalesce(known, F.lit(False))).select(
            "_left", F.lit(None).cast(r_rows.schema["_right"].dataType).alias("_found")))
    return joined.select(*[F.col("_left")[c].alias(c) for c in left.columns],
                         *[F.col("_found")[f"_v{i}"].alias(c) for i, c in enumerate(found)])
