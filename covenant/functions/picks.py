"""Deterministic row picks and choices from an md5 of (kind, key).

Unlike ``rand(seed)`` the result depends only on the row's key, not on how
the data is partitioned or on which executor recomputes a lost task, and a
plain SQL engine can reproduce it:

* pick at rate r  <=>  first 4 hex digits of md5("kind:key") < hex(floor(r * 65536))
* choice in 0..n-1 <=>  int(next 8 hex digits) mod n
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate_hex(rate: float) -> str:
    """Four-digit hex threshold for a pick rate in [0, 1]."""
    n = max(0, min(65536, int(rate * 65536)))
    return "10000" if n == 65536 else format(n, "04x")


def digest(kind: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{kind}:"), key.cast("string")))


def pick(kind: str, key: Column, rate: float) -> Column:
    """TRUE for about ``rate`` of the keys, the same ones on every run."""
    if rate >= 1:
        return F.lit(True)
    return F.substring(digest(kind, key), 1, 4) < F.lit(rate_hex(rate))


def choice(kind: str, key: Column, n: int) -> Column:
    """An int in 0..n-1 derived from the key (32 bits of the digest, so large n stay uniform)."""
    return F.pmod(F.conv(F.substring(digest(kind, key), 5, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def choose(kind: str, key: Column, values: list) -> Column:
    """One of ``values`` (a literal list) chosen by the key."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), choice(kind, key, len(values)) + 1)
