"""A bitmap of fixed size in front of a semi-join, so that rows without a partner are not shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits in all, and in one row of the bitmap: a megabyte in 256 rows, whatever the number of keys.
BITS, ROW_BITS = 1 << 23, 1 << 15


def maybe_in(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``rows`` whose ``key`` may be in the one column of ``keys``: none that is is missing, null keys are.

    With many more keys than bits everything passes; the join that follows decides.
    """
    place = F.pmod(F.xxhash64(F.col(keys.columns[0])), F.lit(BITS))
    bitmap = (keys.filter(F.col(keys.columns[0]).isNotNull()).select(place.alias("p"))
              .groupBy((F.col("p") / ROW_BITS).cast("int").alias("_row"))
              .agg(F.bitmap_construct_agg(F.col("p") % ROW_BITS).alias("_bits")))
    own = rows.filter(F.col(key).isNotNull()).withColumn("_p", F.pmod(F.xxhash64(key), F.lit(BITS)))
    own = own.withColumn("_row", (F.col("_p") / ROW_BITS).cast("int"))
    bit = F.col("_p") % ROW_BITS
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # At most BITS / ROW_BITS rows of ROW_BITS / 8 bytes.
    return (own.join(F.broadcast(bitmap), "_row").filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
            .select(*rows.columns))
