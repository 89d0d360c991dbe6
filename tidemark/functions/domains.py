"""Domain keys shared by the stream and the batch side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_domain(col) -> Column:
    """Lower case, drop a leading ``www.`` and a trailing ``.org``.

    Stream domains are full host names (``en.wikipedia.org``); pageview
    domains are project names (``en.wikipedia``).  Both map to the same key.
    """
    c = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    c = F.regexp_replace(c, r"^www\.", "")
    return F.regexp_replace(c, r"\.org$", "")
