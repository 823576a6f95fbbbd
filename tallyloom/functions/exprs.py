"""Column expressions shared by the operators.  All are built-in functions; those with a lambda run interpreted inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.wire import LEDGER_ZONE, UTC


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts) -> Column:
    """UTC wall clock to ledger wall clock, both without zone."""
    return F.convert_timezone(F.lit(UTC), F.lit(LEDGER_ZONE), col(ts).cast("timestamp_ntz"))


def local_date(ts) -> Column:
    """GL and sale date of a UTC timestamp."""
    return F.to_date(local_time(ts))


def nz(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def total(*cols) -> Column:
    """Sum in which a missing part counts as zero."""
    out = nz(cols[0])
    for c in cols[1:]:
        out = out + nz(c)
    return out


def money(c, p=14, s=2) -> Column:
    return col(c).cast(f"decimal({p},{s})")


def whole(c) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(col(c), 0).cast("bigint")


def capitalise(c) -> Column:
    """Capital after a blank and after a hyphen; Spark's initcap breaks on blanks only."""
    return F.array_join(F.transform(F.split(col(c), "-"), F.initcap), "-")


def card_label(cc_type, gateway) -> Column:
    return F.when(F.coalesce(col(cc_type), F.lit("")) != "", col(cc_type)).otherwise(col(gateway))


def legacy_number(increment_id) -> Column:
    """Number before the first hyphen of an increment id."""
    return F.expr("try_cast(split_part({}, '-', 1) as bigint)".format(increment_id))


def lit_date(value) -> Column:
    return F.lit(value).cast("date")


def pick(df: DataFrame, *names) -> DataFrame:
    return df.select(*names)
