"""Column expressions shared by the operators (all JVM-side, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with a zero denominator giving null (pandas ``replace(0, nan)``)."""
    return col_(num) / F.nullif(col_(den), F.lit(0.0))


def nan_to_null(c: str | Column) -> Column:
    """pandas NaN means missing: turn NaN into null at ingest."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def rnd(c: str | Column, digits: int = 6) -> Column:
    """Round half to even on the scaled binary value, ``rint(x * 10^d) / 10^d``, as numpy and pandas do.

    Built only from exactly specified IEEE operations, so any engine given the same
    double returns the same double (Spark's ``round`` and ``bround`` work on the decimal
    string, others on the scaled value: they disagree on ties such as 101.7034375).
    Adding zero turns -0.0 into 0.0.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(col_(c).cast("double") * scale) / scale + F.lit(0.0)


def hash_hex(key: str | Column, seed: int) -> Column:
    """md5 of ``seed-key``: a stable per-row random draw that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}-"), col_(key).cast("string")))


def hash_unit(key: str | Column, seed: int) -> Column:
    """Uniform draw in [0, 1) from the first 8 hex digits of the row hash."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_fold(key: str | Column, k: int, seed: int) -> Column:
    """Fold number 0..k-1 from hex digits 9-16 of the row hash (independent of the split draw)."""
    return (F.conv(F.substring(hash_hex(key, seed), 9, 8), 16, 10).cast("long") % F.lit(k)).cast("int")


def is_test_row(key: str | Column, test_size: float = 0.2, seed: int = 42) -> Column:
    """Hash split: a row is in the test side when its first 8 hex digits fall below the threshold."""
    threshold = f"{int(test_size * 4294967296):08x}"
    return F.substring(hash_hex(key, seed), 1, 8) < F.lit(threshold)
