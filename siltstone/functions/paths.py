"""Times in object paths, as column functions. Paths end like ``name-2010010801.log.gz`` and begin like ``2010/01-08/``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The last dash before the hour; what follows the hour begins with a dot (fixed values of the archive's naming).
HOURLY = r"^.*-([0-9]{10})\..*$"
DAILY = r"^([0-9]{4}/[0-9]{2}-[0-9]{2})/.*$"


def has_hour(path: Column) -> Column:
    return path.rlike(HOURLY)


def has_day(path: Column) -> Column:
    return path.rlike(DAILY)


def _at(text: Column, form: str, zone: str) -> Column:
    local = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(form))
    return local if zone == "UTC" else F.to_utc_timestamp(local, zone)


def logtime(path: Column, zone: str = "UTC") -> Column:
    """Epoch seconds of an object's hour, by its path; null without one. The session's zone must be UTC."""
    return F.unix_timestamp(_at(F.regexp_extract(path, HOURLY, 1), "yyyyMMddHH", zone))


def path_timestamp(path: Column, zone: str = "Europe/Helsinki", strict: bool = False) -> Column:
    """The time in a path, by hour or else by day; null without one, or an error if ``strict``."""
    found = F.coalesce(_at(F.regexp_extract(path, HOURLY, 1), "yyyyMMddHH", zone), _at(F.regexp_extract(path, DAILY, 1), "yyyy/MM-dd", zone))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no date in path "), path)).cast("timestamp")) if strict else found


def precision(path: Column) -> Column:
    return F.when(has_hour(path), "hourly").when(has_day(path), "daily")


def object_path(index: Column, host: Column, time: Column) -> Column:
    """The path of the hourly object that an event belongs to."""
    return F.concat(F.date_format(time, "yyyy/MM-dd"), F.lit("/"), host, F.lit("/"), index, F.lit("/"), index, F.lit(".log-"), F.date_format(time, "yyyyMMddHH"), F.lit(".log.gz"))
