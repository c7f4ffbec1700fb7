"""Document ids."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import ordinals
from corpusloom.scratch import Scratch


def format_id(ordinal: Column, prefix: str = "id") -> Column:
    """``id-0000000042``; numbers beyond ten digits keep all of them."""
    digits = ordinal.cast("string")
    padded = F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)
    return F.concat(F.lit(f"{prefix}-"), padded)


def _number(given: Column, prefix: str) -> Column:
    """The number of an id that ``format_id`` could have made, else null."""
    digits = F.regexp_extract(given, f"^{re.escape(prefix)}-([0-9]{{10,38}})$", 1)
    # More than ten digits never begin with a zero.
    return F.when(digits.rlike("^([0-9]{10}|[1-9][0-9]{10,})$"), digits.try_cast("decimal(38,0)"))


def ensure_id(
    df: DataFrame,
    scratch: Scratch,
    id_col: str = "id",
    prefix: str = "id",
    order_by: Sequence[str] = (),
    fill: bool = False,
) -> DataFrame:
    """Add an id column where there is none; otherwise return ``df`` unchanged.

    With ``fill``, rows whose id is null get one: their ordinal among all rows,
    counted from beyond the largest number that a given id of the same form has. So
    no filled id equals a given one. Given ids stay, also where they repeat.
    """
    if id_col in df.columns:
        if not fill:
            return df
        numbered = ordinals(df, scratch, order_by, name="_ordinal")
        # Both read one column of the table that the ordinals have settled.
        beyond = numbered.agg(F.max(_number(F.col(id_col), prefix)).alias("n"))
        first = beyond.select(F.coalesce(F.col("n") + 1, F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)")).scalar()
        number = F.col("_ordinal").cast("decimal(38,0)") + first
        given = F.coalesce(F.col(id_col), format_id(number.cast("decimal(38,0)"), prefix))
        return numbered.withColumn(id_col, given).select(*df.columns)
    numbered = ordinals(df, scratch, order_by, name="_ordinal")
    return numbered.select(format_id(F.col("_ordinal"), prefix).alias(id_col), *df.columns)
