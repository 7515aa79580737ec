"""Per-user sampling: keep whole users whose hash falls in one of n buckets.

Row sampling (``df.sample``) would break users apart; a user's visits must
stay together for gaps and chains. ``method="hash"`` spreads any id layout
evenly; ``method="modulo"`` (``UserID mod n``) is reproducible in plain SQL;
``method="range"`` keeps the users whose 32-bit integer hash (``functions.inthash``) lies in the i-th of n
equal parts of its range, as databases sample that order a table by that hash.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.inthash import with_int_hash32


def _bucket(user_col: str, n: int, method: str) -> Column:
    u = F.col(user_col)
    if method == "hash":
        return F.pmod(F.xxhash64(u), F.lit(n))
    if method == "modulo":
        return F.pmod(u, F.lit(n))
    raise ValueError(f"unknown sampling method {method!r}")


def user_sample(df: DataFrame, denominator: int, user_col: str = "UserID",
                method: str = "hash") -> DataFrame:
    """Keep 1/denominator of the users (bucket 0)."""
    return user_bucket(df, denominator, 0, user_col, method)


def user_bucket(df: DataFrame, n: int, i: int, user_col: str = "UserID",
                method: str = "hash") -> DataFrame:
    """Users of bucket i out of n; buckets 0..n-1 cover every user exactly once."""
    if not 0 <= i < n:
        raise ValueError("bucket index out of range")
    if method == "range":
        name = "_int_hash"
        while name in df.columns:
            name += "_"
        hashed = with_int_hash32(df, user_col, name)
        return hashed.where(F.shiftright(F.col(name) * n, 32) == i).drop(name)
    return df.where(_bucket(user_col, n, method) == i)
