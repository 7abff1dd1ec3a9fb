"""Event ids as columns: z/yyyy/MM/dd/HH/mm/<epoch ms>-<7-digit record number>, ordered by bytes.

Times are UTC whatever the session's time zone is: they are written from timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How many characters of yyyy/MM/dd/HH/mm/ an id has at each granularity.
LENGTHS = {"year": 4, "month": 7, "day": 10, "hour": 13, "minute": 16, "second": 17, "millisecond": 17, "full": 17}


def utc_time(ms: Column) -> Column:
    """The UTC wall-clock time of an epoch-ms time, as a timestamp without a zone."""
    seconds = ms.cast("decimal(20,0)") / F.lit(1000).cast("decimal(4,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_millis(at: Column) -> Column:
    """Epoch ms of a UTC wall-clock time without a zone; parts of a millisecond are cut."""
    since = at.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(since.cast("interval second").cast("decimal(18,6)") * 1000).cast("long")


def build_eid(ms: Column, record: Column | None = None, granularity: str = "full") -> Column:
    """The id of an epoch-ms time. An unknown granularity is full; second floors to whole seconds and has no record."""
    ms = ms.cast("long")
    n = LENGTHS.get(granularity, LENGTHS["full"])
    head = F.concat(F.lit("z/"), F.left(F.translate(utc_time(ms).cast("string"), "- :", "///"), F.lit(n)))
    if n < LENGTHS["full"]:
        return head
    if granularity == "second":
        return F.concat(head, (ms - F.pmod(ms, F.lit(1000))).cast("string"))
    out = F.concat(head, ms.cast("string"))
    return out if record is None else F.concat(out, F.lit("-"), F.right(F.concat(F.lit("0000000"), record.cast("string")), F.lit(7)))


def eid_millis(eid: Column) -> Column:
    """Epoch ms of an id: its ms part, else its leading date parts (UTC). Null for what is no id."""
    part = lambda k, other: F.coalesce(F.nullif(F.try_element_at(F.split(eid, "[/-]"), F.lit(k)), F.lit("")), F.lit(other))
    ms = part(7, "0").try_cast("long")
    text = F.concat_ws(" ", F.concat_ws("-", part(2, "1970"), part(3, "01"), part(4, "01")), F.concat_ws(":", part(5, "00"), part(6, "00"), F.lit("00")))
    return F.when(~eid.startswith("z"), None).when(ms > 10000, ms).otherwise(utc_millis(text.try_cast("timestamp_ntz")))


def after(eid: Column | str) -> Column:
    """What the ids after eid are greater than: a space sorts before the record number's dash."""
    return F.concat(F.lit(eid) if isinstance(eid, str) else eid, F.lit(" "))


def previous_eid(eid: Column) -> Column:
    """An id before this one: its last digit one lower, or a space for a 0; reading after it starts with this one."""
    last = F.right(eid, F.lit(1))
    return F.concat(F.left(eid, F.length(eid) - 1), F.when(last == "0", " ").otherwise((last.try_cast("int") - 1).cast("string")))


def day_bounds(start: str | None, end: str | None) -> list[Column]:
    """Filters on the partition column dt that follow from bounds on eid."""
    day = lambda e: "-".join((e.split("/")[1:4] + ["01", "01"])[:3]) if e and len(e.split("/")) >= 4 else None
    out = []
    if day(start):
        out.append(F.col("dt") >= F.lit(day(start)).cast("date"))
    if day(end):
        out.append(F.col("dt") <= F.lit(day(end)[:10]).cast("date"))
    return out
