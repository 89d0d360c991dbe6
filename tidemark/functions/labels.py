"""Code -> label lookups of the edit-event normaliser."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import (
    NAMESPACE_LABELS,
    UNKNOWN_NAMESPACE,
    USER_TYPE_BOT,
    USER_TYPE_HUMAN,
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _namespace_map() -> Column:
    # A map of literals: Catalyst folds it to one constant, so the lookup is
    # a single hash probe per row inside generated code, no join.
    return F.create_map(
        *chain.from_iterable(
            (F.lit(code), F.lit(label)) for code, label in NAMESPACE_LABELS.items()
        )
    )


def namespace_label(col) -> Column:
    """Namespace code -> label; unknown or null codes -> ``unknown``."""
    return F.coalesce(_namespace_map()[_c(col).cast("int")], F.lit(UNKNOWN_NAMESPACE))


def user_type_label(col) -> Column:
    """P10: bot flag -> ``bot`` / ``human``; a null flag stays null."""
    c = _c(col)
    return F.when(c, F.lit(USER_TYPE_BOT)).when(~c, F.lit(USER_TYPE_HUMAN))
