"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "AS_OF", "as_of_lit", "code", "carrier_suffix", "is_will_call", "uom_qty",
    "purpose_code", "nz", "tsql_concat", "tsql_plus", "case_gtin", "upc_len_ok",
    "int_sum",
]

# Default "now" for jobs: every GETDATE() of the reference becomes this
# explicit parameter, so a job (and its replay) is deterministic.
AS_OF = "2001-09-01 00:00:00"


def as_of_lit(as_of: str | _dt.datetime | None = None) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ literal (source tables are NTZ)."""
    v = as_of or AS_OF
    if isinstance(v, _dt.datetime):
        v = v.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(v).cast("timestamp_ntz")


def code(c) -> Column:
    """A code column for comparison: trailing blanks ignored (SQL Server
    equality pads; Spark's does not)."""
    return F.rtrim(F.col(c) if isinstance(c, str) else c)


def carrier_suffix(c, n: int = 2) -> Column:
    """RIGHT(ISNULL(carrier,''), n) on the trimmed carrier."""
    col = F.col(c) if isinstance(c, str) else c
    return F.right(F.rtrim(F.coalesce(col, F.lit(""))), F.lit(n))


def is_will_call(c) -> Column:
    return carrier_suffix(c, 2) == F.lit("WC")


def nz(c, default=0) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(default))


def uom_qty(qty, factor) -> Column:
    """SUM(qty / factor) as an int; one rounding rule shared with the oracle:
    ``CAST(FLOOR(ROUND(SUM(CAST(q AS DOUBLE)/f), 6)) AS INT)``."""
    q = F.col(qty) if isinstance(qty, str) else qty
    f = F.col(factor) if isinstance(factor, str) else factor
    return F.floor(F.round(F.sum(q.cast("double") / f), 6)).cast("int")


def int_sum(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col).cast("bigint")


# Class id -> purpose code of a line (anything else is 13).
PURPOSE_BY_CLASS = {"CIG": 20, "CLR": 3, "DRY": 4, "FRZ": 6, "PRO": 7}
PURPOSE_DEFAULT = 13


def purpose_code(c, default=PURPOSE_DEFAULT) -> Column:
    """Class id -> purpose code; ``default`` when unmapped (None keeps NULL)."""
    col = code(c)
    e = None
    for k, v in PURPOSE_BY_CLASS.items():
        e = (F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v)))
    return e.otherwise(F.lit(default) if default is not None else F.lit(None).cast("int"))


def tsql_concat(*cols) -> Column:
    """CONCAT(...): NULL parts count as empty."""
    return F.concat(*[F.coalesce(c if isinstance(c, Column) else F.lit(c), F.lit("")) for c in cols])


def tsql_plus(*cols) -> Column:
    """a + b on strings: NULL if any part is NULL."""
    return F.concat(*[c if isinstance(c, Column) else F.lit(c) for c in cols])


def upc_len_ok(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.length(col).between(12, 14)


def case_gtin(c) -> Column:
    """RIGHT('000' + upc, 14)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.right(F.concat(F.lit("000"), col), F.lit(14))
