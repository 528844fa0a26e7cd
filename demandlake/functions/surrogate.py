"""Surrogate keys that need no counter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR = "|"
_NULL_MARK = "~"


def surrogate_key(keys: list[Column], version: Column) -> Column:
    """A 60-bit hash of the business key and the version's start.

    It is the same on every retry and differs between versions of one key, and needs neither a
    global sort nor a shared counter.
    """
    parts = [F.coalesce(key.cast("string"), F.lit(_NULL_MARK)) for key in keys]
    digest = F.md5(F.concat_ws(_SEPARATOR, *parts, version))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
