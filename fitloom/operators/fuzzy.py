"""The fuzzy match of skills as a join of two tables: compact forms that are equal, or of which one of four
characters or more is within the other.

No pair is tried that has nothing in common.  A form that may be within others is looked up by its rarest run of
GRAM characters among the other side's forms, and a form with a run that nobody has is left out at once; forms
that share the run are compared exactly.  Both sides are reduced to distinct forms first.  The other side's forms
of a common run are dealt into blocks of about BLOCK, and the forms that ask for it go to each, so no key
gathers more than that in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compact

GRAM, BLOCK = 4, 4096
#: Forms that a task takes apart into runs.
FORMS = 20_000


def _grams(form: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(form) - GRAM + 1), lambda i: form.substr(i, F.lit(GRAM))))


def _within(small: DataFrame, large: DataFrame, block: int) -> DataFrame:
    """(small, large): forms of small strictly within one of large; both have one column of distinct forms."""
    whole = large.where(F.length("large") > GRAM).select("large", F.explode(_grams(F.col("large"))).alias("gram"))
    counts = whole.groupBy("gram").agg(F.count("*").alias("n"))
    parts = small.where(F.length("small") >= GRAM).select("small", F.explode(_grams(F.col("small"))).alias("gram"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram"))).alias("r")
    asked = parts.join(counts, "gram", "left").groupBy("small").agg(rarest).select("small", "r.gram", "r.n").where("n > 0")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block).cast("int"))))
    common = counts.where(F.col("n") > block).select("gram", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = whole.join(common, "gram", "left").withColumn("block", F.pmod(F.xxhash64("large"), F.coalesce("blocks", F.lit(1))).cast("int"))
    both = asked.join(dealt.select("gram", "block", "large"), ["gram", "block"])
    return both.where((F.length("small") < F.length("large")) & F.col("large").contains(F.col("small"))).select("small", "large")


def matching_forms(left: DataFrame, right: DataFrame, block: int = BLOCK, store=None) -> DataFrame:
    """(left_form, right_form), one row for each matching pair of distinct compact forms; left and right have one
    column of texts each.  Null and empty forms match nothing.

    store(df) writes the distinct forms to a table that is then read: the texts are read once and not at each use,
    and the forms are counted and dealt over tasks of about FORMS.  A partition that is small in forms is large in runs."""

    def forms(df: DataFrame, name: str) -> DataFrame:
        found = df.select(compact(F.col(df.columns[0])).alias(name)).where(F.col(name) != "").distinct()
        if not store:
            return found
        found = store(found)
        return found.repartition(found.count() // FORMS + 1, name)

    a, b = forms(left, "a"), forms(right, "b")
    equal = a.join(b, F.col("a") == F.col("b"))
    inside = _within(a.withColumnRenamed("a", "small"), b.withColumnRenamed("b", "large"), block).select(F.col("small").alias("a"), F.col("large").alias("b"))
    around = _within(b.withColumnRenamed("b", "small"), a.withColumnRenamed("a", "large"), block).select(F.col("large").alias("a"), F.col("small").alias("b"))
    return equal.unionAll(inside).unionAll(around).select(F.col("a").alias("left_form"), F.col("b").alias("right_form"))


def fuzzy_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, block: int = BLOCK, store=None) -> DataFrame:
    """Rows of left and right whose texts match, with the columns of both, which must differ in name."""
    forms = matching_forms(left.select(left_on), right.select(right_on), block, store)
    a, b = left.withColumn("left_form", compact(F.col(left_on))), right.withColumn("right_form", compact(F.col(right_on)))
    return a.join(forms, "left_form").join(b, "right_form").drop("left_form", "right_form")


def fuzzy_missing(left: DataFrame, right: DataFrame, left_on: str, right_on: str, block: int = BLOCK, store=None) -> DataFrame:
    """Rows of left whose text matches none of right."""
    found = matching_forms(left.select(left_on), right.select(right_on), block, store).select("left_form").distinct()
    return left.withColumn("left_form", compact(F.col(left_on))).join(found, "left_form", "left_anti").drop("left_form")
