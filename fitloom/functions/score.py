"""The seven-axis fit score and its parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .match import DEPLOYMENT, contains_any, matched
from .text import normal, sentences

# Weights of the axes, in the order they are summed.
WEIGHTS = {"skill_coverage": 0.38, "experience_fit": 0.24, "role_alignment": 0.14, "domain_alignment": 0.09, "education_fit": 0.05, "deployment_alignment": 0.05, "management_alignment": 0.05}
# Least score, greatest score, greatest experience fit, whether roles must differ.
ACCEPTANCE = {"full_match": (0.72, None, None, False), "balanced": (0.50, 0.82, None, False), "hard_negative": (0.32, 0.72, 0.85, False), "mismatch": (None, 0.45, None, True)}
PRESETS = list(ACCEPTANCE)
# Title words of seniority bands and the years a band stands for.
BANDS = [("principal", 8, ["principal", "staff", "architect", "manager", "head of"]), ("senior", 5, ["lead", "senior", "sr "]), ("mid", 3, ["ii", "iii"])]
# Words of degrees and of institutions.
MASTER_WANTED = ["master", "m tech", "mca", "mba", "ms", "m sc", "postgraduate"]
MASTER_HELD = ["m tech", "mca", "mba", "ms", "m sc"]
BACHELOR_WANTED = ["bachelor", "graduate", "b tech", "b e", "degree"]
ELITE_WANTED = ["iit", "nit", "iiit", "bits"]
ELITE_HELD = ["iit", "iiit", "nit", "bits", "international institute", "technology"]


def coverage(hits: Column, wanted: Column) -> Column:
    return F.when(wanted == 0, 0.5).otherwise(hits / F.greatest(wanted, F.lit(1)))


def experience(years: Column, required: Column) -> Column:
    over = F.when(years <= 2.0, 1.0).when(years <= 5.0, F.greatest(F.lit(0.5), 1.0 - (years - 2.0) * 0.1)).otherwise(F.greatest(F.lit(0.3), 0.7 - (years - 5.0) * 0.08))
    return F.when(required > 0, F.least(F.lit(1.0), years / F.when(required > 0, required))).otherwise(over)


def role(same: Column, adjacent: Column) -> Column:
    return F.when(same, 1.0).when(adjacent, 0.6).otherwise(0.2)


def domain(wanted: Column, observed: Column) -> Column:
    """0.5 without a wanted domain; else what the first observed domain that fits is worth."""
    w = normal(wanted)
    worth = F.transform(
        F.filter(F.transform(observed, normal), lambda o: o != ""),
        lambda o: F.when(o.contains(w) | w.contains(o), 1.0).when(F.size(F.array_intersect(F.split(w, " "), F.split(o, " "))) >= 2, 0.8),
    )
    first = F.try_element_at(F.filter(worth, lambda x: x.isNotNull()), F.lit(1))
    return F.when(F.coalesce(wanted, F.lit("")) == "", 0.5).otherwise(F.coalesce(first, F.lit(0.35)))


def education(wanted: Column, degree: Column, institution: Column) -> Column:
    w, d, i = normal(wanted), normal(degree), normal(institution)
    base = (
        F.when(contains_any(w, MASTER_WANTED), F.when(contains_any(d, MASTER_HELD), 1.0).otherwise(0.45))
        .when(contains_any(w, BACHELOR_WANTED), F.when(d != "", 1.0).otherwise(0.6))
        .otherwise(0.5)
    )
    elite = F.when(contains_any(i, ELITE_HELD), F.least(F.lit(1.0), base + 0.1)).otherwise(F.least(base, F.lit(0.55)))
    return F.when(contains_any(w, ELITE_WANTED), elite).otherwise(base)


def management(wanted: Column, held: Column) -> Column:
    return F.when(wanted, F.when(held, 1.0).otherwise(0.45)).otherwise(F.when(held, 0.7).otherwise(1.0))


def deployment(skills: Column, observed_compact: Column, terms: list[str] | None = None) -> Column:
    """Share of the deployment skills among `skills` that are observed; 0.5 if there are none."""
    plain = F.transform(skills, lambda s: F.struct(s.alias("x"), normal(s).alias("t")))
    needed = F.transform(F.filter(plain, lambda r: contains_any(r["t"], terms or DEPLOYMENT)), lambda r: r["x"])
    have = F.size(matched(needed, observed_compact))
    return F.when(F.size(needed) == 0, 0.5).otherwise(have / F.greatest(F.size(needed), F.lit(1)))


def overall(axes: dict[str, Column]) -> Column:
    total = None
    for name, weight in WEIGHTS.items():
        total = axes[name] * weight if total is None else total + axes[name] * weight
    return total


def band(title: Column) -> Column:
    t, out = normal(title), F.when(F.lit(False), "")
    for name, _, words in BANDS:
        out = out.when(contains_any(t, words), name)
    return out.otherwise("unspecified")


def band_years(name: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for b, years, _ in BANDS:
        out = out.when(name == b, years)
    return out.otherwise(0)


def required_years(explicit: Column, title: Column) -> Column:
    """Struct of years and where they come from."""
    inferred = band_years(band(title))
    return F.when(explicit > 0, F.struct(explicit.cast("int").alias("years"), F.lit("explicit").alias("signal"))).when(inferred > 0, F.struct(inferred.cast("int").alias("years"), F.lit("title_inferred").alias("signal"))).otherwise(F.struct(F.lit(0).alias("years"), F.lit("unknown").alias("signal")))


def stage(years: Column) -> Column:
    return F.when(years >= 7, "senior").when(years >= 2.5, "mid").otherwise("entry")


def notice(dial: Column) -> Column:
    return F.when(dial > 0.65, "Immediate").when(dial > 0.35, "30 Days").otherwise("90 Days")


def college_tier(wanted: Column, dial: Column) -> Column:
    """Tier by the requirement's words, else by the dial."""
    w = normal(wanted)
    return F.when(contains_any(w, [*ELITE_WANTED, *MASTER_WANTED]), "tier_1").when(contains_any(w, BACHELOR_WANTED), "tier_2").when(dial >= 0.8, "tier_1").when(dial >= 0.4, "tier_2").otherwise("tier_3")


def usage_weight(n: Column) -> Column:
    return 1.0 / (1.0 + F.log1p(n))


def fits_preset(preset: Column, score: Column, experience_fit: Column, same_role: Column) -> Column:
    out = F.when(F.lit(False), True)
    for name, (low, high, most, differ) in ACCEPTANCE.items():
        ok = F.lit(True)
        if low is not None:
            ok = ok & (score >= low)
        if high is not None:
            ok = ok & (score <= high)
        if most is not None:
            ok = ok & (experience_fit <= most)
        if differ:
            ok = ok & ~same_role
        out = out.when(preset == name, ok)
    return out.otherwise(True)


def rationale(wanted: Column, found: Column, years: Column, required: Column, role_score: Column, domain_score: Column, manages: Column, management_score: Column) -> Column:
    """One sentence for each ground of the score.  wanted and found are arrays."""
    # The phrases of a rationale.
    shown = F.format_string("shows %.1f years", years)
    lead = F.array_join(F.slice(found, 1, 3), ", ")
    skills = F.concat(F.format_string("matches %d/%d JD skills", F.size(found), F.size(wanted)), F.when(lead != "", F.concat(F.lit(" including "), lead)).otherwise(""))
    over = F.when(years > 5.0, F.concat(shown, F.lit(" which may be overqualified for a fresher role"))).when(years > 2.0, F.concat(shown, F.lit(", slightly above fresher expectations"))).otherwise(F.concat(shown, F.lit(" which fits the fresher role expectation")))
    return sentences(
        F.array(
            F.when(F.size(wanted) > 0, skills),
            F.when(required > 0, F.concat(shown, F.format_string(" against a %d-year target", required))).otherwise(over),
            F.when(role_score == 1.0, "same role family").when(role_score >= 0.6, "adjacent role family").otherwise("different role family"),
            F.format_string("domain alignment %.2f", domain_score),
            F.when(manages, F.when(management_score >= 0.8, "management scope aligned").otherwise("limited management evidence")),
        )
    )
