"""Column expressions shared by the checks.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing is evaluated in Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Flag literals that mark a current (active) or closed (inactive)
# version.  Compared after upper(trim(cast(flag as string))), so 'y', ' Y ',
# boolean true and integer 1 count as active; anything else is neither.
ACTIVE_FLAG_VALUES = ("Y", "TRUE", "1")
INACTIVE_FLAG_VALUES = ("N", "FALSE", "0")


def is_null_or_blank(column: str | Column, data_type: T.DataType | None) -> Column:
    """NULL for any type; for strings also empty after trimming spaces.

    ``trim`` removes only U+0020, so a tab or newline is *not* blank.
    """
    c = F.col(column) if isinstance(column, str) else column
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return c.isNull() | (F.trim(c) == F.lit(""))
    return c.isNull()


def normalised_flag(column: str | Column) -> Column:
    """upper(trim(cast(flag as string))): one comparable form for string, boolean and int flags."""
    c = F.col(column) if isinstance(column, str) else column
    return F.upper(F.trim(c.cast("string")))


def flag_in(column: str | Column, values: Iterable[str]) -> Column:
    """True when the normalised flag is one of ``values``; NULL flags give false, never NULL."""
    vals = [str(v).strip().upper() for v in values]
    return F.coalesce(normalised_flag(column).isin(vals), F.lit(False))


def is_active(column: str | Column, values: Iterable[str] = ACTIVE_FLAG_VALUES) -> Column:
    return flag_in(column, values)


def is_inactive(column: str | Column, values: Iterable[str] = INACTIVE_FLAG_VALUES) -> Column:
    return flag_in(column, values)


def keys_not_null(key: Sequence[str]) -> Column:
    """All key columns non-NULL (an ``=`` join never matches a NULL key part)."""
    cond = F.lit(True)
    for k in key:
        cond = cond & qcol(k).isNotNull()
    return cond


def sql_name(name: str) -> str:
    """Backtick-quote a column name for ``F.col``/``expr`` (names may hold spaces or dots)."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str, alias: str | None = None) -> Column:
    """Column reference that treats ``name`` literally, optionally qualified by a DataFrame alias."""
    q = sql_name(name)
    return F.col(f"{alias}.{q}" if alias else q)


def free_names(taken: Iterable[str], *stems: str) -> list[str]:
    """Names like ``stems`` that are not among ``taken`` (compared without case, as Spark resolves them)."""
    used, out = {t.lower() for t in taken}, []
    for stem in stems:
        name, i = stem, 0
        while name.lower() in used:
            i += 1
            name = f"{stem}_{i}"
        used.add(name.lower())
        out.append(name)
    return out
