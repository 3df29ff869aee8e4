"""A hash that other engines can repeat: the leading bits of an MD5 over text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_bucket(keys: Sequence[str], buckets: int, seed: int | str = "") -> Column:
    """A number below ``buckets`` from the seed and the keys' text, null as the empty text.

    The 32 bits taken are the first eight hex digits of ``md5(seed|key|key...)``.
    """
    text = F.concat_ws(
        "|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    )
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(bits, F.lit(buckets)).cast("int")
