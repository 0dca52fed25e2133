"""Gapless numbers per key, whatever the size of a key's share.

Rows are range-partitioned on key and order together, so a key with a third of
all rows is cut along its order over many tasks. Each task numbers its own run;
only one count for each (partition, key) meets in the prefix sums. The laid
out rows are written once to the shared folder, so that counting and numbering see
the same partitions, also after a lost executor. So are the rows as they come, until
they are laid out: what computes them then runs once, not again to find the
ranges, and its shuffle files are gone when those of the layout are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import scratch_path
from ..plans.files import remove, written


def numbered(df: DataFrame, key: str, order: list[str], name: str = "seq") -> DataFrame:
    """``df`` with a number from 1 per ``key`` (null is a key of its own) in the order of the columns ``order``, nulls first."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    came = scratch_path(spark, "unnumbered")
    laid = written(df, came).repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    place = F.monotonically_increasing_id()
    laid = laid.withColumns({"_part": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    laid = written(laid, scratch_path(spark, "numbered"))
    remove(spark, came)
    counts = laid.groupBy("_part", key).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        F.col("_part").alias("_p"), F.col(key).alias("_k"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    on = (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k"))
    return laid.join(shift, on).withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_p", "_k", "_shift")
