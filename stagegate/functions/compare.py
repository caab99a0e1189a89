"""Type-aware comparison of one column between two sides.

``comparable_pair`` decides how a column present on both sides is compared:

* same type: natively, NULL-safe (``<=>``); maps, at any depth, are compared as
  their entries sorted by key, because Spark cannot order or ``=`` a map;
* both numeric but of different types: integral pairs as ``bigint``, integers and
  decimals in a decimal that holds both exactly (as plain decimal text where 38
  digits do not suffice), and as ``double`` only if a side is float or double;
* any other difference (type drift): as strings, and the pair is flagged.

The comparable forms are orderable, so the pair-free consistency path can also
group and join on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _contains_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _contains_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_contains_map(f.dataType) for f in dt.fields)
    return False


def _fold_negative_zero(c: Column) -> Column:
    # -0.0 = 0.0 is true, but the two print differently.
    return F.when(c == F.lit(0), F.lit(0.0)).otherwise(c.cast("double"))


def orderable(c: Column, dt: T.DataType) -> Column:
    """A form of ``c`` that supports ``<=>`` and grouping: maps, also nested ones, become sorted entry arrays."""
    if not _contains_map(dt):
        return c
    if isinstance(dt, T.MapType):
        entry = lambda e: F.struct(orderable(e["key"], dt.keyType).alias("key"), orderable(e["value"], dt.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(c), entry))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: orderable(e, dt.elementType))
    return F.when(c.isNotNull(), F.struct(*[orderable(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))


def canonical_string(c: Column, dt: T.DataType) -> Column:
    """String form of a value of type ``dt`` for comparing across drifted types (NULL stays NULL)."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return _fold_negative_zero(c).cast("string")
    if isinstance(dt, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(orderable(c, dt))
    if isinstance(dt, T.BinaryType):
        return F.base64(c)
    return c.cast("string")


@dataclass(frozen=True)
class ComparablePair:
    name: str
    left: Column
    right: Column
    drift: bool  # types differ and are not both numeric
    dtype: T.DataType  # type of the comparable forms (both sides)


def _orderable_type(dt: T.DataType) -> T.DataType:
    """The type of ``orderable``'s result."""
    if not _contains_map(dt):
        return dt
    if isinstance(dt, T.MapType):
        entry = [T.StructField("key", _orderable_type(dt.keyType)), T.StructField("value", _orderable_type(dt.valueType))]
        return T.ArrayType(T.StructType(entry))
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_orderable_type(dt.elementType), dt.containsNull)
    return T.StructType([T.StructField(f.name, _orderable_type(f.dataType), f.nullable) for f in dt.fields])


# digits of the integral types
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _common_decimal(a: T.DataType, b: T.DataType) -> T.DecimalType | None:
    """The decimal type that holds every value of both types exactly, if there is one."""
    sizes = [(_DIGITS[type(t)], 0) if type(t) in _DIGITS else (t.precision - t.scale, t.scale) for t in (a, b)]
    whole, scale = max(w for w, _ in sizes), max(s for _, s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _plain_decimal(c: Column) -> Column:
    """A number's decimal digits without zeros at the end of the fraction: equal numbers, equal texts."""
    cut = F.regexp_replace(F.regexp_replace(c.cast("string"), "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")
    return F.when(c == F.lit(0), F.lit("0")).otherwise(cut)


def comparable_pair(name: str, left: Column, left_type: T.DataType, right: Column, right_type: T.DataType) -> ComparablePair:
    if left_type == right_type:
        return ComparablePair(name, orderable(left, left_type), orderable(right, right_type), False, _orderable_type(left_type))
    if isinstance(left_type, _INTEGRAL) and isinstance(right_type, _INTEGRAL):
        return ComparablePair(name, left.cast("bigint"), right.cast("bigint"), False, T.LongType())
    exact = _INTEGRAL + (T.DecimalType,)
    if isinstance(left_type, exact) and isinstance(right_type, exact):
        common = _common_decimal(left_type, right_type)
        if common is not None:
            return ComparablePair(name, left.cast(common), right.cast(common), False, common)
        return ComparablePair(name, _plain_decimal(left), _plain_decimal(right), False, T.StringType())
    if isinstance(left_type, _INTEGRAL + _FRACTIONAL) and isinstance(right_type, _INTEGRAL + _FRACTIONAL):
        return ComparablePair(name, _fold_negative_zero(left), _fold_negative_zero(right), False, T.DoubleType())
    return ComparablePair(name, canonical_string(left, left_type), canonical_string(right, right_type), True, T.StringType())


def differs(pair: ComparablePair) -> Column:
    """True when exactly one side is NULL or both are non-NULL and unequal."""
    return ~pair.left.eqNullSafe(pair.right)
