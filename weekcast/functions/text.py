"""Number formatting that rounds the stored binary value half to even.

``format_string('%.1f', x)`` rounds the shortest decimal form half up, which
prints 0.25 as 0.3 and 0.35 as 0.4; the expected texts are 0.2 and 0.3.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed0(value: Column) -> Column:
    """No decimals.  A half is exact in binary, so ``bround`` settles ties.

    NULL stays NULL; ``format_string`` alone would print the word.
    """
    return F.when(value.isNotNull(), F.format_string("%.0f", F.bround(value, 0)))


def fixed1(value: Column) -> Column:
    """One decimal.

    Ten times the value is 8v + 2v, both exact; their rounded sum and the
    exact error of that sum decide a tie without leaving double arithmetic.
    """
    size = F.abs(value)
    eight, two = size * 8, size * 2
    tenths = eight + two
    kept = tenths - eight
    lost = (eight - (tenths - kept)) + (two - kept)
    below = F.floor(tenths)
    part = tenths - below
    odd = below % 2 == 1
    up = (part > 0.5) | ((part == 0.5) & ((lost > 0) | ((lost == 0) & odd)))
    count = F.when(up, below + 1).otherwise(below).cast("long")
    whole = (count - count % 10) / 10
    return F.concat(
        F.when(value < 0, F.lit("-")).otherwise(F.lit("")),
        whole.cast("long").cast("string"),
        F.lit("."),
        (count % 10).cast("string"),
    )
