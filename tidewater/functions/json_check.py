"""F8: JSON well-formedness check (quarantine helper).

Returns the text itself when it is not valid JSON and '' when it is (NULL stays NULL),
so a column of malformed payloads can be kept next to the parsed rows.

``strict=False`` uses Spark's ``try_parse_json`` (JVM, codegen); it accepts trailing text
after a complete value (``{"a":1} x``, ``"k": 69}``).  ``strict=True`` applies RFC 8259
(whole text one value, no NaN/Infinity) with Python's ``json`` in an Arrow-batched pandas
UDF - a small per-value helper.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reject_constant(name):
    raise ValueError(name)


def _valid(text: str) -> bool:
    try:
        json.loads(text, parse_constant=_reject_constant)
        return True
    except (ValueError, RecursionError):
        return False


@F.pandas_udf(T.BooleanType())
def json_valid_strict(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else _valid(t)).astype("boolean")


def json_valid(col: str | Column, strict: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if strict:
        return json_valid_strict(c)
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(F.try_parse_json(c).isNotNull())


def malformed_json(col: str | Column, strict: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit(None).cast("string")).when(json_valid(c, strict), F.lit("")).otherwise(c)
