"""Times: units, parsing, and the fields taken from them.

A numeric time above 1e11 is epoch milliseconds, else seconds. Texts keep their own offset for the fields (an
hour of ``T00:20+05:00`` is 0); anything that is no time gives nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Above this a number is milliseconds.
MS_FROM = 1e11
FIELDS = ("year", "month", "day", "hour", "minute", "second", "microsecond", "date", "datetime", "day_of_week", "is_weekend")
#: Formats tried when the plain cast fails.
ODD_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "dd MMM yyyy HH:mm:ss", "dd MMM yyyy", "MMM d, yyyy HH:mm:ss", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd'T'HHmmss")


def epoch_ms(x: Column) -> Column:
    """Milliseconds of a numeric time by the unit rule."""
    return F.when(x > MS_FROM, x.cast("long")).otherwise((x * 1000).cast("long"))


def _local_text(text: Column) -> Column:
    """The text without its offset, so that the fields are those written down."""
    return F.regexp_replace(F.trim(text), r"(?<=\d)(\s*(Z|[+-]\d{2}:?\d{2}|UTC))$", "")


def to_local(x: Column, kind: T.DataType) -> Column:
    """A wall-clock timestamp (without zone) of a text, number or timestamp column."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return x.cast("timestamp_ntz")
    if isinstance(kind, T.NumericType):
        return F.timestamp_micros((F.when(x > MS_FROM, x.cast("double") * 1000).otherwise(x.cast("double") * 1e6)).cast("long")).cast("timestamp_ntz")
    t = _local_text(x)
    odd = [F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in ODD_FORMATS]
    iso = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ]|$)"), t.try_cast("timestamp_ntz"))
    number = F.when(F.trim(x).rlike(r"^\d+(\.\d+)?$"), x.try_cast("double"))
    return F.coalesce(F.when(number.isNotNull(), to_local(number, T.DoubleType())), iso, *odd)


def to_utc(x: Column) -> Column:
    """An instant of a text; without an offset it is UTC, 9-digit fractions are cut to microseconds."""
    return F.coalesce(x.try_cast("timestamp"), *[F.try_to_timestamp(x, F.lit(f)) for f in ODD_FORMATS])


def fields(ts: Column) -> dict[str, Column]:
    """The fields of a wall-clock timestamp; Monday is day 0."""
    micro = (F.date_format(ts, "SSSSSS")).cast("int")
    return {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts), "microsecond": micro,
        "date": F.date_format(ts, "yyyy-MM-dd"), "datetime": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "day_of_week": F.weekday(ts), "is_weekend": F.weekday(ts) >= 5,
    }


def add_time_fields(df: DataFrame, field: str, fallback: str | None = None, prefix: str = "") -> DataFrame:
    """Adds the fields of ``field``, or of ``fallback`` where that is null or no time; unchanged if neither column is there."""
    have = [c for c in (field, fallback) if c and c in df.columns]
    if not have:
        return df
    kinds = {f.name: f.dataType for f in df.schema.fields}
    df = df.withColumn("_tf_ts", F.coalesce(*[to_local(F.col(c), kinds[c]) for c in have]))
    return df.withColumns({prefix + n: c for n, c in fields(F.col("_tf_ts")).items()}).drop("_tf_ts")


def market_hours(ts: Column, start: int = 9, end: int = 16) -> Column:
    return (F.hour(ts) >= start) & (F.hour(ts) < end)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)
