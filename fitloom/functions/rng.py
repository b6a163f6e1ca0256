"""Random draws that depend on a key only: the same rows draw the same whatever the partitions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(key: Column, salt: str, i: Column | int = 0) -> Column:
    """In (0, 1): the first 32 bits of md5(key|salt|i), in their middle."""
    n = F.lit(i) if isinstance(i, int) else i
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt), n.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(2**32)


def integer(key: Column, salt: str, low: Column | int, high: Column | int, i: Column | int = 0) -> Column:
    low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
    return (low + F.floor(uniform(key, salt, i) * (high - low + 1))).cast("int")


def normal(key: Column, salt: str, i: Column | int = 0) -> Column:
    """Standard Gaussian by Box and Muller."""
    return F.sqrt(-2.0 * F.log(uniform(key, salt + ".a", i))) * F.cos(2.0 * math.pi * uniform(key, salt + ".b", i))


def truncated(key: Column, salt: str, mean: Column, sd: Column, low: Column, high: Column) -> Column:
    """First of 12 Gaussian draws within bounds, else the mean put within them."""
    bounded = lambda x: F.when((x >= low) & (x <= high), x)
    draw = lambda i: F.transform(F.array(mean + sd * normal(key, salt, i)), bounded)[0]
    # a draw is made only while none before it was within bounds
    first = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(None).cast("double"), lambda found, i: F.coalesce(found, draw(i)))
    return F.coalesce(first, F.greatest(low, F.least(high, mean)))


def pick(items: Column, key: Column, salt: str, i: Column | int = 0) -> Column:
    """One item of an array; null of an empty one."""
    at = integer(key, salt, F.lit(1), F.greatest(F.size(items), F.lit(1)), i)
    return F.try_element_at(items, at)


def order(key: Column, seed: int | str) -> Column:
    """Sort key of a seeded shuffle."""
    return F.md5(F.concat(key.cast("string"), F.lit(str(seed))).cast("binary"))


def subset(items: Column, k: Column, key: Column, salt: str) -> Column:
    """k items in their order: those of the k least draws."""
    n = F.size(items)
    rows = F.transform(items, lambda x, i: F.struct(uniform(key, salt, i).alias("u"), i.alias("i"), x.alias("x")))
    chosen = F.slice(F.array_sort(rows), F.lit(1), F.greatest(F.least(k.cast("int"), n), F.lit(0)))
    return F.transform(F.array_sort(F.transform(chosen, lambda r: F.struct(r["i"], r["x"]))), lambda r: r["x"])


def jitter(base: Column, key: Column, salt: str, sd: float = 0.06) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + sd * normal(key, salt)))


def weighted_key(weight: Column, key: Column, salt: str) -> Column:
    """Sort key of weighted sampling without bias: the least comes first (Efraimidis and Spirakis)."""
    return -F.log(uniform(key, salt)) / weight
