"""Price clean-up, exact sums and ratios with zero guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import PRICE_TYPE


def safe_price_sql(column: str) -> str:
    value = f"try_cast({column} AS double)"
    return f"CASE WHEN NOT isnan({value}) AND {value} >= 0 THEN {value} ELSE 0D END"


def safe_price(column: str) -> Column:
    """Null, NaN and negative prices count as 0.

    NaN is tested by name: in Spark it compares as larger than every number.
    """
    return F.expr(safe_price_sql(column))


def price_if(condition: str, column: str = "price") -> Column:
    """Cleaned price as a decimal where the condition holds, else 0. A price that
    has no decimal form adds nothing; ``schema_violations`` reports it."""
    return F.expr(
        f"CASE WHEN {condition} THEN coalesce(try_cast({safe_price_sql(column)} AS {PRICE_TYPE}), 0) ELSE CAST(0 AS {PRICE_TYPE}) END"
    )


def has_no_decimal(column: str = "price") -> Column:
    """A number that is too large (or infinite) to be added."""
    return F.expr(f"NOT isnan({column}) AND {column} > 0 AND try_cast({column} AS {PRICE_TYPE}) IS NULL")


def as_double_sql(column: str) -> str:
    return f"CAST({column} AS double)"


def as_double(total: Column) -> Column:
    return total.cast("double")


def amount(value: Column, digits: int = 2) -> Column:
    """Money for output, rounded half up."""
    return F.round(value.cast("double"), digits)


def exact_part(value: Column, digits: int) -> Column:
    """An amount as a decimal with so many digits behind the point; null from 10^26 on,
    where a sum of them might have no decimal form any more."""
    return value.try_cast(f"decimal({26 + digits},{digits})")


def beyond(value: Column, digits: int) -> Column:
    """What :func:`exact_part` leaves out, as a double."""
    return F.when(exact_part(value, digits).isNull(), value)


def total_of(exact: Column, rest: Column) -> Column:
    """Sum of both parts; null where there was nothing to add."""
    return F.when(exact.isNotNull() | rest.isNotNull(), F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)))


def sum_of_doubles(value: Column) -> Column:
    """Sum of two-digit amounts of any size. It does not depend on row order as long
    as they are below 10^26; larger ones are added as doubles."""
    return total_of(F.sum(exact_part(value, 2)), F.sum(beyond(value, 2)))


def as_decimals(value: Column, kind: T.DataType, to: str = PRICE_TYPE) -> Column:
    """``value`` with every double and float in it as decimal ``to``, whatever arrays, maps
    and structs it lies in; numbers without such a form become null, all else stays."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value).try_cast(to)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: as_decimals(x, kind.elementType, to))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: as_decimals(x, kind.valueType, to))
    if isinstance(kind, T.StructType):
        fields = [as_decimals(value.getField(f.name), f.dataType, to).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def decimals_in(df: DataFrame, to: str = PRICE_TYPE) -> DataFrame:
    """All columns through :func:`as_decimals`."""
    return df.select(*[as_decimals(df[f"`{f.name}`"], f.dataType, to).alias(f.name) for f in df.schema.fields])


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, null when whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * F.lit(100.0)


def percent_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(percent(part, whole), F.lit(0.0))


def lenient_number(value: Column) -> Column:
    """Number from text; anything else is 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))
