"""Business ids (prefix and zero-padded number) and stable hash routing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_id(prefix: str, number: Column, digits: int) -> Column:
    """The padding is a minimum: longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{digits}d", number)


def parse_id(text: Column, prefix: str) -> Column:
    """Number behind the prefix as BIGINT; NULL for anything that is not prefix and digits within white space."""
    digits = F.regexp_extract(text, rf"^\s*{re.escape(prefix)}([0-9]+)\s*$", 1)
    return digits.try_cast("bigint")


def hash_bucket(text: Column, buckets: int | Column) -> Column:
    """Whole 128-bit md5 of the text modulo ``buckets`` (below 2^31).

    The remainder is carried through four 32-bit digits, so no step leaves BIGINT.
    """
    size = (F.lit(buckets) if isinstance(buckets, int) else buckets).cast("bigint")
    digest = F.md5(text.cast("binary"))
    remainder = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        digit = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        remainder = (remainder * F.lit(2**32) + digit) % size
    return remainder
