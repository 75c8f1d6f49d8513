"""String cleaning and null policy (P1, P2, P7, P8, P16, P21; S1 token rule).

All functions return Column expressions, so a whole table is cleaned in one
``select`` inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The default missing-value tokens of pandas' CSV reader
# (public pandas documentation).  A cell equal to one of them is null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Text columns of the house table whose null means "absent".
ABSENCE_COLUMNS = (
    "Alley", "MasVnrType", "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1",
    "BsmtFinType2", "FireplaceQu", "GarageType", "GarageFinish", "GarageQual",
    "GarageCond", "PoolQC", "Fence", "MiscFeature",
)

ABSENT_TOKEN = "None"
MISSING_TOKEN = "Missing"

_EDGE_SPACE = r"^\s+|\s+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c) -> Column:
    """Exact NA tokens become null (no trimming first, as in the reader)."""
    c = _c(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


# A text that casts to a number starts (after blanks and a sign) with a digit,
# a dot, or one of the special literals; anything else is null without trying.
# the whole text is matched: Java literals such as 1d, 2f or 0x1p3 are no numbers.
_MAYBE_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"


def to_number(c, dtype: str = "double") -> Column:
    """Numeric coercion, anything unparsable becomes null.

    The guard keeps ``try_cast`` off the failure path (which raises and
    catches internally) for ordinary words; results are those of ``try_cast``."""
    c = _c(c)
    return F.when(c.rlike(_MAYBE_NUMBER), c.try_cast(dtype))


def strip_all(c) -> Column:
    """Python ``str.strip()``: all white space, not only blanks (``trim``)."""
    return F.regexp_replace(_c(c), _EDGE_SPACE, "")


def clean_string(c) -> Column:
    """Strip, unwrap one pair of single quotes when length >= 2, strip again."""
    s = strip_all(c)
    wrapped = (F.length(s) >= 2) & s.startswith("'") & s.endswith("'")
    inner = strip_all(F.substring(s, F.lit(2), F.length(s) - 2))
    return F.when(wrapped, inner).otherwise(s)


def is_quote_wrapped(c) -> Column:
    """Value starts or ends with a single quote (null -> false)."""
    c = _c(c)
    return F.coalesce(c.startswith("'") | c.endswith("'"), F.lit(False))


def absent(c) -> Column:
    """Null or the explicit absence token."""
    c = _c(c)
    return c.isNull() | F.coalesce(c == ABSENT_TOKEN, F.lit(False))


def string_columns(df: DataFrame) -> list[str]:
    """P5 for text: names of the string columns, from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_frame(df: DataFrame, absence_columns: Iterable[str] = ABSENCE_COLUMNS) -> DataFrame:
    """P1 on every string column, then P2 on the listed columns that exist."""
    strings = set(string_columns(df))
    fill = set(absence_columns)
    out = []
    for f in df.schema.fields:
        e = F.col(f.name)
        if f.name in strings:
            e = clean_string(e)
        if f.name in fill:
            e = F.coalesce(e, F.lit(ABSENT_TOKEN))
        out.append(e.alias(f.name))
    return df.select(*out)


def fill_token(c, token: str = MISSING_TOKEN) -> Column:
    """Category null token."""
    return F.coalesce(_c(c), F.lit(token))
