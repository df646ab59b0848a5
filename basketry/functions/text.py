from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(name: str) -> Column:
    """Strip spaces at both ends; the column keeps its name."""
    return F.trim(F.col(name)).alias(name)


def trimmed_upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def joined(*names: str, by: str = " ") -> Column:
    """Trimmed parts joined by ``by``; NULL parts leave no stray separator."""
    return F.concat_ws(by, *[F.trim(F.col(n)) for n in names])


def filled(name: str) -> Column:
    """True where the text is neither NULL nor blank."""
    return F.col(name).isNotNull() & (F.length(F.trim(F.col(name))) > 0)
