"""Code -> name lookup against a small dimension.

No hint and no row count: a left join on a table with one row per code.  Spark
broadcasts it when its bytes are below ``autoBroadcastJoinThreshold`` (static or,
with AQE, measured at run time); a larger table is joined by a shuffle that AQE
splits where one code holds a large share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import rules as R


@dataclass(frozen=True)
class CodeLookup:
    """A table of one (code, name) row per code."""

    table: DataFrame

    @classmethod
    def prepare(cls, dim: DataFrame, code_col: str = "iso_code", name_col: str = "country_name", order_col: str | None = None) -> "CodeLookup":
        """One row per code, so the lookup can never multiply fact rows.

        With ``order_col`` (say, the ingest time of an append-only table) the last
        name wins, so a correction counts; else, and on ties, the smallest name.
        """
        code = F.col(code_col).alias("code")
        if order_col is None:
            return cls(dim.groupBy(code).agg(F.min(name_col).alias("name")))
        last = dim.groupBy(code, F.col(order_col).alias("at")).agg(F.min(name_col).alias("name"))
        return cls(last.groupBy("code").agg(F.max_by("name", "at").alias("name")))

    def side(self, code_alias: str, name_alias: str) -> DataFrame:
        return self.table.select(F.col("code").alias(code_alias), F.col("name").alias(name_alias))


def lookup_name(code: Column, matched_name: Column) -> Column:
    """The unknown code XXX, an empty/null code and an unmatched code all read "Unknown"."""
    return F.when(code.eqNullSafe(R.UNKNOWN_COUNTRY_CODE), F.lit(R.UNKNOWN_LABEL)).otherwise(
        F.coalesce(matched_name, F.lit(R.UNKNOWN_LABEL))
    )


def add_country_name(df: DataFrame, lookup: CodeLookup, code_col: str, name_col: str) -> DataFrame:
    """Upper-case ``code_col`` in place and append ``name_col`` from the lookup (left join)."""
    key, found = f"__{code_col}__key", f"__{name_col}__found"
    joined = df.withColumn(code_col, F.upper(F.col(code_col))).join(
        lookup.side(key, found), F.col(code_col) == F.col(key), "left"
    )
    return joined.withColumn(name_col, lookup_name(F.col(code_col), F.col(found))).drop(key, found)
