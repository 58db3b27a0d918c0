"""Left outer equi-joins and the ways to keep them even on skewed keys.

`left_join` leaves the strategy to Spark: it broadcasts the right side only when its measured size
is under `spark.sql.autoBroadcastJoinThreshold`, else sorts and merges, where adaptive execution
splits a left-side partition that a hot (or null) key has made too large. It does so only if both
sides come straight from a shuffle of the join, so a right side that was aggregated on the keys must
not be joined as it lies: the null-safe condition makes the join shuffle it anew.
`lookup_join` is for code tables joined on few distinct keys, where hash partitioning by
the key would use only as many tasks as there are keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.columns import quote
from orderlake.operators.quality import require_present

_SALT = "__salt"


def left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], unique_right: bool = False, how: str = "left"
) -> DataFrame:
    """Left outer (or anti, semi, inner) join on equal column names. Null keys never match.

    Several right rows for one key repeat the left row; `unique_right=True` checks the right
    side first (one aggregation) and refuses duplicates.
    """
    if unique_right:
        refuse_duplicate_keys(right, on)
    names = {c: f"__right_{c}" for c in on}
    present = require_present(right, on).withColumnsRenamed(names)
    same = reduce(and_, [F.col(quote(c)).eqNullSafe(F.col(quote(n))) for c, n in names.items()])
    joined = left.join(present, same, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*names.values())


def refuse_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = require_present(df, keys).groupBy(*map(quote, keys)).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"several rows for one key in {list(keys)}")


def lookup_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, salts: int = 1, unique_right: bool = False
) -> DataFrame:
    """Left outer join with a code table on differently named keys.

    `unique_right=True` refuses a table with several rows for one key (one aggregation of it).

    Spark broadcasts the table if its size is under the session's threshold. For a table that is
    not, and few keys, give `salts`: left rows are dealt over so many buckets and right rows are
    repeated once per bucket, so no key holds one task. Without `unique_right` nothing runs while the
    plan is built.
    """
    if unique_right:
        refuse_duplicate_keys(right, [right_key])
    same_key = F.col(quote(left_key)) == F.col(quote(right_key))
    if salts <= 1:
        return left.join(right, same_key, "left")

    # The salt comes from the row itself: a retried task deals its rows the same way again. Maps
    # have no hash.
    hashable = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    row = F.xxhash64(*[F.col(quote(c)) for c in hashable])
    dealt = left.withColumn(_SALT, F.pmod(row, F.lit(salts)).cast("int"))
    repeated = right.withColumn(
        _SALT + "_right", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return dealt.join(
        repeated, same_key & (F.col(_SALT) == F.col(_SALT + "_right")), "left"
    ).drop(_SALT, _SALT + "_right")
