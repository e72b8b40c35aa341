"""Column functions with NULL rules of a statistics language rather than of SQL.

Everything here returns a ``Column`` built from JVM-side expressions; there is no Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: sentinels used by the source registries
CAPPED_AGE = "Age 90 or older"
UNKNOWN = "Unknown/Not Applicable"
CAP_YEARS = 90.0

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def to_number(c: str | Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes NULL."""
    text = col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def decode_age(c: str | Column, cap: float = CAP_YEARS) -> Column:
    """Age text with sentinels to double: capped ages become ``cap``, unknown ages NULL."""
    text = col(c).cast("string")
    return F.when(text == CAPPED_AGE, F.lit(float(cap))).otherwise(to_number(text))


def is_capped(c: str | Column) -> Column:
    """True where the age was recorded only as the cap (NULL where there is no age)."""
    return col(c).cast("string") == CAPPED_AGE


def null_if(c: str | Column, value) -> Column:
    return F.when(col(c).eqNullSafe(F.lit(value)), None).otherwise(col(c))


def number_text(c: str | Column) -> Column:
    """Double to text without a trailing ``.0`` and without an exponent."""
    x = col(c).cast("double")
    plain = F.regexp_replace(x.cast("string"), r"\.0$", "")
    wide = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,10)").cast("string"), "0+$", ""), r"\.$", "")
    small = (F.abs(x) < 1e-3) & (x != 0)
    return F.when((F.abs(x) >= 1e7) | small, wide).otherwise(plain)


def remove_first(c: str | Column, pattern: str) -> Column:
    """Delete the first match of ``pattern`` only."""
    return F.regexp_replace(col(c), f"(?s)^(.*?)(?:{pattern})", "$1")


def capture(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match, NULL when nothing matches."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def contains(c: str | Column, literal: str) -> Column:
    return col(c).contains(literal)


def contains_any(c: str | Column, literals: Sequence[str]) -> Column:
    test = F.lit(False)
    for text in literals:
        test = test | col(c).contains(text)
    return test


def recode(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Map values; unlisted values become ``default`` (a Column or a literal, NULL if not given)."""
    out = None
    for old, new in mapping.items():
        value = new if isinstance(new, Column) else F.lit(new)
        out = F.when(col(c) == F.lit(old), value) if out is None else out.when(col(c) == F.lit(old), value)
    rest = default if isinstance(default, Column) else F.lit(default)
    return rest if out is None else out.otherwise(rest)


def levels(c: str | Column, values: Sequence[str]) -> Column:
    """Ordered category: values outside the list become NULL."""
    return F.when(col(c).isin(list(values)), col(c))


def level_index(c: str | Column, values: Sequence[str]) -> Column:
    """Position of the value in the list of levels, from 1; NULL outside the list."""
    return recode(c, {v: i for i, v in enumerate(values, start=1)}).cast("int")


def bucket(c: str | Column, breaks: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Label the interval between ascending breaks; ``len(labels) == len(breaks) + 1``.

    Intervals are closed on the left, or on the right with ``right=True``.
    """
    if len(labels) != len(breaks) + 1:
        raise ValueError("need one label more than breaks")
    x = col(c)
    if not breaks:
        return F.when(x.isNotNull(), F.lit(labels[0]))
    out = None
    for edge, text in zip(breaks, labels):
        test = (x <= edge) if right else (x < edge)
        out = F.when(test, F.lit(text)) if out is None else out.when(test, F.lit(text))
    return out.when(x.isNotNull(), F.lit(labels[-1]))


def paste(*parts: str | Column) -> Column:
    """Concatenate text; a NULL part is written as ``NA``. Plain strings are literals."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("NA")) for p in parts]
    return F.concat(*cols)


def join_parts(cols: Sequence[str | Column], sep: str, empty_as_null: bool = True) -> Column:
    """Join the non-NULL parts. With no part at all the result is NULL, or ``''`` on request."""
    text = F.concat_ws(sep, *[col(c) for c in cols])
    return F.nullif(text, F.lit("")) if empty_as_null else text


def split_head_rest(c: str | Column, delim: str) -> tuple[Column, Column]:
    """Text before the first delimiter, and everything after it (NULL if there is no delimiter)."""
    parts = F.split(col(c), "\\Q" + delim + "\\E", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def any_of(flag: str | Column) -> Column:
    """Three-valued "any" as an aggregate: true, else NULL if some input is NULL, else false."""
    x = col(flag)
    return F.when(F.bool_or(x), F.lit(True)).when(F.count_if(x.isNull()) > 0, F.lit(None)).otherwise(F.lit(False))
