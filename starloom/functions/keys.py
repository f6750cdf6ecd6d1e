"""Stable text keys derived from natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_uuid(*parts: Column | str) -> Column:
    """UUID-formatted text from SHA-256 of the '|'-joined parts.

    The same natural key gives the same id on every run and every engine
    (first 32 hex digits of the digest, grouped 8-4-4-4-12).
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    h = F.sha2(F.concat_ws("|", *cols), 256)
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4),
                       h.substr(17, 4), h.substr(21, 12))
