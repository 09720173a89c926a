"""Calendar and clock parts of timestamps and of text."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_of_week(ts: Column) -> Column:
    """Monday is 1 and Sunday is 7."""
    return (F.weekday(ts) + 1).cast("int")


def _digits(part: Column, width: int = 2) -> Column:
    return F.lpad(part.cast("int").cast("string"), width, "0")


# Texts are built from the parts: formatting a timestamp without a zone goes through the session's zone, where a clock
# change moves it.
def month_label(ts: Column) -> Column:
    return F.when(ts.isNotNull(), F.concat_ws("-", _digits(F.year(ts), 4), _digits(F.month(ts))))


def date_text(ts: Column) -> Column:
    """`yyyy-MM-dd`; NULL for NULL."""
    return F.when(ts.isNotNull(), F.concat_ws("-", month_label(ts), _digits(F.dayofmonth(ts))))


def clock_text(ts: Column) -> Column:
    """`HH:mm`; NULL for NULL."""
    return F.when(ts.isNotNull(), F.concat_ws(":", _digits(F.hour(ts)), _digits(F.minute(ts))))


def timestamp_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`; NULL for NULL."""
    seconds = F.concat_ws(":", clock_text(ts), _digits(F.floor(F.second(ts))))
    return F.when(ts.isNotNull(), F.concat_ws(" ", date_text(ts), seconds))


def three_hour_bucket(ts: Column) -> Column:
    """0 for 00:00-02:59 up to 7 for 21:00-23:59."""
    return F.floor(F.hour(ts) / 3).cast("int")


def second_of_hour(ts: Column) -> Column:
    return (F.minute(ts) * 60 + F.floor(F.second(ts))).cast("int")


def clock_parts(text: Column) -> tuple[Column, Column]:
    """Hour and minute of an `HH:MM` text; NULL where the text is not a time."""
    return F.substring(text, 1, 2).try_cast("int"), F.substring(text, -2, 2).try_cast("int")


def parse_date(text: Column) -> Column:
    """Date of a `yyyy-MM-dd` text; NULL where the text is not a date."""
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_timestamp(text: Column) -> Column:
    """Timestamp without a zone of a `yyyy-MM-dd HH:mm:ss` text; NULL where the text is none. No zone is involved."""
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Add dow, dom, month, hour and minute of the column `ts`."""
    c = F.col(ts)
    return df.withColumns(
        {
            "dow": day_of_week(c),
            "dom": F.dayofmonth(c),
            "month": F.month(c),
            "hour": F.hour(c),
            "minute": F.minute(c),
        }
    )
