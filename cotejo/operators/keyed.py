"""Key-based building blocks that stay balanced when one key holds a large share of the rows.

Three habits keep hot keys apart:

* one row per key is taken with ``row_number() = 1``: Spark then limits each map task's output to one row per
  key before the shuffle (WindowGroupLimit);
* the remaining rows are found by an anti join on the unique row id, never on the key;
* look-up joins add a hash of the key as a second join column. The look-up side was just grouped by the key and
  would otherwise be joined without a new shuffle, which hides it from AQE. With both sides freshly shuffled AQE
  measures them and splits a skewed partition over several tasks. The join is sorted by hint: Spark plans by the files'
  size, and millions of derived keys may come from a few megabytes, which would be broadcast through the driver.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_GUARD = "_key_hash"


def one_per_key(df: DataFrame, key: str, *order) -> DataFrame:
    """First row of every key in the given order (which must be total for a repeatable result)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def lookup_join(left: DataFrame, right: DataFrame, key: str, how="left") -> DataFrame:
    """Join to a side that holds each key once. ``how``: left, inner, left_semi or left_anti."""
    guarded = [side.withColumn(_GUARD, F.xxhash64(key)) for side in (left, right)]
    return guarded[0].join(guarded[1].hint("merge"), [key, _GUARD], how).drop(_GUARD)


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-blank keys; combined inside each task before the shuffle."""
    return df.where(F.col(key) != "").select(key).distinct()


def in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return lookup_join(df, keys, key, "left_semi")


def not_in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return lookup_join(df, keys, key, "left_anti")
