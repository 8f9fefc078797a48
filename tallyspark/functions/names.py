"""P14 name normaliser: NFKD -> drop non-ASCII -> lower -> keep [a-z0-9].

Unicode compatibility decomposition has no Spark SQL built-in, so the exact
form is an Arrow-batched ``pandas_udf`` (vectorised per batch, whole texts).
``normalize_name_sql`` is the JVM-only variant for inputs known to be ASCII
(identifiers): it skips the decomposition step.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_KEEP = re.compile(r"[^a-z0-9]+")


def normalize_text(value) -> str | None:
    if value is None:
        return None
    ascii_text = unicodedata.normalize("NFKD", str(value)).encode("ascii", "ignore").decode("ascii")
    return _KEEP.sub("", ascii_text.lower())


def _normalize_batch(s: pd.Series) -> pd.Series:
    return s.map(normalize_text, na_action="ignore")


_UDF = None


def normalize_name(c: Column) -> Column:
    """Exact normaliser as a vectorised UDF (created on first use, so that
    importing the module needs no session)."""
    global _UDF
    if _UDF is None:
        _UDF = pandas_udf(_normalize_batch, "string")
    return _UDF(c)


def normalize_name_sql(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
