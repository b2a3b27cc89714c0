"""Equi-joins that stay balanced when one key holds a large share of the rows.

``skew_join`` is one pass over each input and one join; nothing runs while the
query is built. What keeps a hot key from being one task's work:

* a right side that only decides (semi, anti) is reduced to its distinct keys
  by a map-side combined aggregation before it is shuffled, however often a key
  repeats there;
* hot keys on the left, and on either side of an inner join, are split by
  AQE's skew-join handling, which sees the real partition sizes at run time.
  The right side always has an exchange of its own (the salt makes it so), a
  condition AQE sets for splitting;
* rows with a NULL key match nothing. Inner and semi joins drop them before the
  shuffle; left and anti joins keep them, and a salt in the join key spreads
  them over the partitions;
* a hot key on the right of a *left* join cannot be split by AQE (an unmatched
  row must be seen by one task). ``right_hot=True`` asks for the two-step form
  (inner join plus anti join), where every part can be split; it reads both
  inputs twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import quoted

_SALT = "_f_salt"
NULL_BUCKETS = 1024
_NAMES = {"left_outer": "left", "leftouter": "left", "semi": "left_semi", "anti": "left_anti"}


def _salts(keys: Sequence[str]) -> tuple[Column, Column]:
    """Join-key parts: 0 on both sides, but on the left a bucket from 1 for rows with a NULL key.

    The bucket comes from the input partition, so no other column has to be
    read and a retried task gives its rows the same buckets again. The right
    side's zero is computed from its keys: a literal would be folded into a
    filter on the left side.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(quoted(k)).isNull()
    bucket = F.pmod(F.hash(F.spark_partition_id()), F.lit(NULL_BUCKETS)) + 1
    return (F.when(null_key, bucket).otherwise(F.lit(0)),
            F.pmod(F.hash(*[F.col(quoted(k)) for k in keys]), F.lit(1)))


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str] | Sequence[tuple[str, str]], how: str = "inner",
              right_hot: bool = False) -> DataFrame:
    """``left.join(right, on, how)`` as described above.

    ``on`` is a list of shared column names, or of (left column, right column)
    pairs; the right key columns then take the left names (one key column each
    in the output, as with a join on names). Other join types than inner, left,
    left_semi and left_anti are plain joins.
    """
    how = _NAMES.get(how, how)
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    keys = [lk for lk, _ in pairs]
    renamed = {rk: lk for lk, rk in pairs if rk != lk}
    if renamed:
        right = right.withColumnsRenamed(renamed)
    if how in ("left_semi", "left_anti"):
        for k in keys:
            right = right.where(F.col(quoted(k)).isNotNull())
        right = right.select(*[F.col(quoted(k)) for k in keys]).distinct()
    if how == "left" and right_hot:
        missing = skew_join(left, right, keys, "left_anti")
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in keys]
        return skew_join(left, right, keys).unionByName(missing.select("*", *blank))
    if how not in ("left", "left_anti"):
        return left.join(right, keys, how)
    left_salt, right_salt = _salts(keys)
    return (left.withColumn(_SALT, left_salt).join(right.withColumn(_SALT, right_salt), [*keys, _SALT], how)
            .drop(_SALT))
