"""The flagship plan: score four candidates for each order and rank them.

An order stands for a job description (its part names are the skills, its customer's nation and
segment the role and domain), customers stand for candidates (all part names they bought are their
inventory).  Work is linear in orders: each meets four customers by an equi-join, and matching runs
inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import score as S
from ..functions.coerce import half_up
from ..functions.match import compacted, contains_any, matched_pairs

TERMS = ["hot", "cold"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_custkey, o_orderdate, p_name), one row for each part of each order line."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return line.join(part, line.l_partkey == part.p_partkey).join(order, line.l_orderkey == order.o_orderkey).select("o_orderkey", "o_custkey", "o_orderdate", "p_name")


def scored(spark: SparkSession, sf_dir: str, resumes: DataFrame | None = None) -> DataFrame:
    """One row for each order and candidate with all axes (unrounded), overall, and the texts of both sides.

    resumes (o_orderkey, preset, resume_text) add texts, an array of those of the row: they meet the orders, before
    these meet candidates, as rows with an inventory are many times wider and four times as many."""
    rows = bought(spark, sf_dir)
    skills = rows.groupBy("o_orderkey").agg(F.array_sort(F.collect_set("p_name")).alias("jd_skills"))
    inventory = rows.groupBy("o_custkey").agg(F.array_sort(F.collect_set("p_name")).alias("inventory"), F.count_distinct(F.year("o_orderdate")).cast("double").alias("total_years"))
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    who = read(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    who = who.select("c_custkey", "n_name", "n_regionkey", "c_mktsegment", "c_acctbal")
    many = who.agg(F.count("*").alias("many"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").join(skills, "o_orderkey")
    if resumes is not None:
        found = resumes.groupBy("o_orderkey").agg(F.collect_list(F.struct("preset", "resume_text")).alias("found"))
        orders = orders.join(found, "o_orderkey", "left")
    else:
        orders = orders.withColumn("found", F.lit(None))
    jd = orders.join(who, orders.o_custkey == who.c_custkey).select(
        "o_orderkey", "o_custkey", "jd_skills", "found",
        F.col("n_name").alias("jd_role"), F.col("n_regionkey").alias("jd_region"), F.col("c_mktsegment").alias("jd_domain"),
        (F.col("o_orderpriority") == "1-URGENT").alias("jd_manages"), F.size("jd_skills").alias("required_years"),
    )
    # forms of the order's skills are made here, once, and not for each candidate; what is cheap is made after the shuffle
    jd = jd.withColumn("forms", compacted(F.col("jd_skills")))
    presets = F.posexplode(F.array(*map(F.lit, S.PRESETS))).alias("k", "preset")
    pairs = jd.crossJoin(F.broadcast(many)).select("*", presets)  # one row
    if resumes is not None:
        own = F.filter("found", lambda r: r["preset"] == F.col("preset"))
        pairs = pairs.withColumn("texts", F.coalesce(F.transform(own, lambda r: r["resume_text"]), F.array().cast("array<string>")))
    pairs = pairs.drop("found").withColumn("custkey", F.pmod(F.col("o_custkey") + 31 * F.col("k"), F.col("many")))
    candidate = who.join(inventory, who.c_custkey == inventory.o_custkey, "left").select(
        F.col("c_custkey").alias("custkey"), F.col("n_name").alias("cand_role"), F.col("n_regionkey").alias("cand_region"),
        F.col("c_mktsegment").alias("cand_domain"), (F.col("c_acctbal") > 5000).alias("cand_manages"),
        F.coalesce("inventory", F.array().cast("array<string>")).alias("inventory"), F.coalesce("total_years", F.lit(0.0)).alias("total_years"),
    )
    candidate = candidate.withColumn("compact", compacted(F.col("inventory")))
    both = pairs.join(candidate, "custkey").withColumn("pairs", F.transform("jd_skills", lambda x, i: F.struct(x.alias("x"), F.get("forms", i).alias("c"))))
    both = both.withColumns({"matched": matched_pairs(F.col("pairs"), F.col("compact")), "needed": F.filter("jd_skills", lambda x: contains_any(x, TERMS))}).drop("forms", "pairs")
    have = F.size(F.filter("needed", lambda x: F.array_contains("matched", x)))
    axes = {
        "skill_coverage": S.coverage(F.size("matched"), F.size("jd_skills")),
        "experience_fit": S.experience(F.col("total_years"), F.col("required_years")),
        "role_alignment": S.role(F.col("jd_role") == F.col("cand_role"), F.col("jd_region") == F.col("cand_region")),
        "domain_alignment": S.domain(F.col("jd_domain"), F.array("cand_domain")),
        "education_fit": F.lit(0.5),
        "deployment_alignment": F.when(F.size("needed") == 0, 0.5).otherwise(have / F.greatest(F.size("needed"), F.lit(1))),
        "management_alignment": S.management(F.col("jd_manages"), F.col("cand_manages")),
    }
    out = both.withColumns(axes)
    out = out.withColumn("overall", half_up(S.overall({a: F.col(a) for a in S.WEIGHTS}), 3))
    return out.withColumn("candidate_id", F.format_string("jd_%05d_cand_%02d_%s", "o_orderkey", F.col("k") + 1, "preset"))
