"""A bitmap of fixed size that tells for most values that they are not in a set.

It only spares work: what it lets through is still decided exactly elsewhere. Its size is a
parameter and doesn't grow with the data; a fuller one lets more through.
"""

import numpy as np
from pyspark.sql import functions as F

#: Bits of a bitmap, 16 MB of memory.
BITS = 2**27


def build(values, name, bits=BITS):
    """The bitmap of a long column, put together by Spark in parts of 32,768 bits."""
    place = F.col(name).bitwiseAND(bits - 1)
    parts = (
        values.groupBy(F.shiftright(place, 15).alias("part"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bitmap"))
        .collect()
    )
    out = np.zeros((bits // 32768, 4096), np.uint8)
    for row in parts:
        out[row["part"]] = np.frombuffer(row["bitmap"], np.uint8)
    return out.ravel()


def may_hold(bitmap, values):
    """Which values of an int64 array may be in the set; False is certain."""
    place = values & (8 * len(bitmap) - 1)
    return bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
