"""Column expressions for postal and occupation codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_zip(zipcode: Column) -> Column:
    """Left-pad with zeros to five characters; longer text stays whole."""
    return F.when(F.length(zipcode) < 5, F.lpad(zipcode, 5, "0")).otherwise(zipcode)


def is_five_digits(zipcode: Column) -> Column:
    return zipcode.rlike("^[0-9]{5}$")


def is_remote(zipcode: Column) -> Column:
    return F.lower(F.trim(zipcode)) == F.lit("remote")


def rollup_soc(code: Column, level: int = 1) -> Column:
    """Parent of a seven-character occupation code ``NN-NNNN``.

    Level 1 turns the last digit into 0, level 2 the last three. Any other
    level, and any text of another shape, comes back unchanged.
    """
    if level not in (1, 2):
        return code
    parts = F.split(code, "-")
    head, tail = parts[0], parts[1]
    kept = F.left(tail, F.length(tail) - 1) if level == 1 else F.left(tail, F.lit(1))
    zeros = "0" if level == 1 else "000"
    well_formed = (F.length(code) == 7) & (F.size(parts) == 2)
    return F.when(well_formed & (F.length(F.get(parts, F.lit(1))) > 0),
                  F.concat(head, F.lit("-"), kept, F.lit(zeros))).otherwise(code)


def segment_key(group: Column, src: Column, date: Column) -> Column:
    """The printable key ``group_src_date``."""
    return F.concat_ws("_", group, src, F.date_format(date, "yyyy-MM-dd"))
