"""Readers of the parquet tables and column rules that all of their users share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blanks that may stand around an identifier.
BLANKS = " \t\n\r\f\v     　﻿​"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm_id(col: Column | str) -> Column:
    """Lower case, without blanks around it; null for null and for blank."""
    col = F.col(col) if isinstance(col, str) else col
    out = F.lower(F.btrim(col, F.lit(BLANKS)))
    return F.when(out != "", out)


def norm_domain(col: Column | str) -> Column:
    """Host without case, outer blanks and ``www.``; null for null and for blank."""
    out = F.regexp_replace(norm_id(col), "^www\\.", "")
    return F.when(out != "", out)
