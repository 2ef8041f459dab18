"""Keyed permutations of 0 .. n-1 that need no sort.

A number is written as a pair of digits, ``x = left + a * right`` with
``a * b >= n`` and ``a`` near the root of n.  Each round adds a keyed function
of one digit to the other, which can be undone, so the rounds together are a
bijection of 0 .. a b - 1.  A result of n or more is sent through again until
it falls below n (cycle walking); that keeps the bijection and takes at most
a b - n repetitions, one in about a root of n on average.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 4
#: A prime below 2^31: products of two remainders fit a long.
PRIME = 2_147_483_647
TIMES, AGAIN = 1_103_515_245, 1_664_525
#: Repetitions that are written out at most; a number that is left over fails the query.
WALK = 64


def permutation_keys(seed: int, j: int, r: int) -> list[int]:
    """The rounds' keys of one permutation."""
    digest = hashlib.md5(f"{seed}:{j}:{r}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) % PRIME for i in range(ROUNDS)]


def domain(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mixed(x: Column, key: Column) -> Column:
    t = ((x + 1) * TIMES + key) % PRIME
    return ((t * t) % PRIME * AGAIN + key) % PRIME


def walk_length(n: int) -> int:
    """Repetitions after which less than one number in 10^18 is left over (none, where fewer do not exist)."""
    a, b = domain(n)
    over = a * b - n
    return 0 if not over else min(over, WALK, math.ceil(42 / -math.log(over / (a * b))))


def _sent(x: Column, a: int, b: int) -> Column:
    """All rounds on one number; each lambda names what it uses more than once."""
    start = F.struct((x % a).alias("left"), F.floor(x / a).cast("bigint").alias("right"))
    keys = F.array(*[F.struct(F.col(f"k{i}").alias("one"), F.col(f"k{i + 1}").alias("two")) for i in range(0, ROUNDS, 2)])

    def two_rounds(pair: Column, key: Column) -> Column:
        left = (pair["left"] + _mixed(pair["right"], key["one"])) % a
        return F.struct(left.alias("left"), ((pair["right"] + _mixed(left, key["two"])) % b).alias("right"))
    return F.aggregate(keys, start, two_rounds, lambda pair: pair["left"] + F.lit(a).cast("bigint") * pair["right"])


def permute(df: DataFrame, n: int) -> DataFrame:
    """Add ``donor``: the place that ``pos`` (0 .. n-1) goes to under the keys k0, k1, ... of its row."""
    a, b = domain(n)
    first = _sent(F.col("pos").cast("bigint"), a, b)
    again = walk_length(n)
    donor = first if not again else F.aggregate(F.sequence(F.lit(1), F.lit(again)), first, lambda x, _: F.when(
        x < n, x).otherwise(_sent(x, a, b)))
    return df.withColumn("donor", donor).withColumn("donor", F.when(F.col("donor") < n, F.col("donor")).otherwise(
        F.raise_error(F.lit("a place is still open after the longest walk")).cast("bigint")))
