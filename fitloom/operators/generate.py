"""Candidate generation as column expressions over a role-profile dimension.

Every draw is a hash of the row's key, a name for the draw site and a counter, so a row gives the same
candidate in any partition, on any retry.  Tables that the generator looks up (profiles, companies,
colleges) are dimensions that rows meet by equi-joins; a row gets the companies it may draw from, which are
worked out once for each list of preferred domains and order of tiers, never the whole pool.  Company usage
runs in rounds: the counts of the rounds so far weigh the next one's draws (in_rounds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import match as M
from ..functions import rng
from ..functions import score as S
from ..functions.coerce import half_up
from ..functions.text import normal
from . import joins

# Dials by preset, and the share of matched skills that a preset may keep.
DIALS = {
    "balanced": {"skill_coverage": 0.50, "experience_years": 0.52, "domain_relevance": 0.60, "deployment_skills": 0.36, "education_tier": 0.54, "notice_period": 0.50},
    "full_match": {"skill_coverage": 0.95, "experience_years": 0.88, "domain_relevance": 0.90, "deployment_skills": 0.78, "education_tier": 0.72, "notice_period": 0.67},
    "hard_negative": {"skill_coverage": 0.38, "experience_years": 0.15, "domain_relevance": 0.55, "deployment_skills": 0.12, "education_tier": 0.48, "notice_period": 0.38},
    "mismatch": {"skill_coverage": 0.05, "experience_years": 0.26, "domain_relevance": 0.18, "deployment_skills": 0.08, "education_tier": 0.44, "notice_period": 0.25},
}
MATCH_SHARE = {"full_match": (0.78, 1.0), "balanced": (0.32, 0.52), "hard_negative": (0.20, 0.38), "mismatch": (0.0, 0.08)}
# Of experience drawn around a requirement: shift and least share; without one: mean, spread, bounds.
SHIFT = {"full_match": (0.18, 0.6), "balanced": (-0.08, 0.6), "hard_negative": (-0.52, 0.3), "mismatch": (-0.30, 0.45)}
FRESHER = {"full_match": (1.0, 0.5, 0.5, 2.0), "balanced": (2.5, 0.7, 1.0, 4.0), "hard_negative": (4.5, 0.8, 3.0, 7.0), "mismatch": (2.0, 1.0, 0.5, 5.0)}
# Probability of staying in the domain as base and slope over the dial.
STAY = {"full_match": (0.50, 0.50), "balanced": (0.20, 0.70), "hard_negative": (0.10, 0.55), "mismatch": (0.0, 0.25)}
FALLBACK_DOMAINS = ["Internet", "Financial Services", "Retail", "E-Learning / EdTech", "Healthcare Technology", "IT Services & Consulting"]
LADDER = {"senior": ["tier_1", "tier_2", "tier_3"], "mid": ["tier_2", "tier_3", "tier_4"], "entry": ["tier_3", "tier_4", "tier_5"]}
COMPLEXITY = {"entry": "Internal Tool", "mid": "Production Grade", "senior": "Enterprise Scale"}
STAGE_LINES = {"entry": ["shipped scoped work with review", "learned production on call"], "mid": ["owned features from design to rollout", "removed recurring defects"], "senior": ["set technical direction", "led work across teams"]}
EXTRA_IMPACTS = {"entry": ["improved test coverage", "reduced manual steps", "fixed flaky checks", "cleaner handovers"], "mid": ["faster issue resolution", "safer releases", "lower tail latency", "fewer alerts"], "senior": ["predictable delivery", "lower running cost", "better recovery time", "simpler systems"]}
SUFFIXES = ["Platform", "Console", "Engine", "Portal", "Service", "Hub"]
LABELS = {"financial": ["Payments", "Risk"], "bank": ["Core Banking", "Treasury"], "retail": ["Catalog", "Checkout"], "internet": ["Growth", "Content"], "education": ["Learning", "Assessment"], "health": ["Clinical Data", "Claims"]}
GENERAL_LABELS = ["Platform", "Operations", "Workflow", "Customer"]
CITIES = ["Bengaluru", "Pune", "Chennai", "Hyderabad", "Delhi", "Noida"]
FIRST_NAMES, LAST_NAMES = ["Asha", "Ravi", "Meera", "Kiran", "Divya", "Arjun", "Nila", "Tara"], ["Rao", "Iyer", "Sen", "Das", "Nair", "Gill", "Bose", "Shah"]

MAILS = ["gmail.com", "outlook.com", "yahoo.com"]

KEY = "__key"
#: Companies of a pool, lists of company domains of roles, and rows of choices among companies that are broadcast.
POOL, LISTS, CHOICES = 10_000, 10_000, 20_000


def by_value(c: Column, values: dict[str, Column | float | str], other=None) -> Column:
    out = F.when(F.lit(False), other if isinstance(other, Column) else F.lit(other))
    for k, v in values.items():
        out = out.when(c == k, v if isinstance(v, Column) else F.lit(v))
    return out.otherwise(other if isinstance(other, Column) else F.lit(other)) if other is not None else out


def strings(values: list[str]) -> Column:
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return F.expr("array(" + ", ".join(f"'{v}'" for v in quoted) + ")")  # one call to the JVM


def dials(preset: Column, key: Column) -> Column:
    """The preset's dials, each jittered and held within 0 and 1."""
    names = list(DIALS["balanced"])
    return F.struct(*(rng.jitter(by_value(preset, {p: v[n] for p, v in DIALS.items()}, 0.5), key, f"dial.{n}").alias(n) for n in names))


def match_count(total: Column, dial: Column, preset: Column, key: Column) -> Column:
    """How many of the matched skills a candidate keeps."""
    low, high = (by_value(preset, {p: v[i] for p, v in MATCH_SHARE.items()}, MATCH_SHARE["balanced"][i]) for i in (0, 1))
    least = F.greatest(F.lit(1), F.bround(total * low, 0).cast("int"))
    most = F.greatest(least, F.bround(total * high, 0).cast("int"))
    target = F.greatest(least, F.bround(total * (low + (high - low) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), dial))), 0).cast("int"))
    floor = F.greatest(least, target - 1)
    ceiling = F.greatest(floor, F.least(total, F.greatest(most, target + 1)))
    few = F.least(total, F.when(dial < 0.1, 1).otherwise(2))
    return F.when(total <= 0, 0).when(preset == "mismatch", rng.integer(key, "count", F.lit(0), few)).otherwise(rng.integer(key, "count", floor, ceiling))


def experience(required: Column, fit: Column, preset: Column, key: Column) -> Column:
    """Years drawn around the requirement, or from the preset's fresher range, to one place."""
    shift, share = (by_value(preset, {p: v[i] for p, v in SHIFT.items()}, d) for i, d in ((0, 0.0), (1, 0.6)))
    years = required.cast("double")
    around = rng.truncated(key, "years", years * (1.0 + shift + (fit - 0.5) * 0.22), F.greatest(F.lit(0.8), years * 0.16), F.greatest(F.lit(0.8), years * share), F.greatest(years + 5.0, years * 1.7))
    mean, spread, low, high = (by_value(preset, {p: v[i] for p, v in FRESHER.items()}, d) for i, d in enumerate((2.0, 0.9, 0.5, 6.0)))
    fresh = rng.truncated(key, "fresh", mean, spread, low, high)
    return half_up(F.when(required > 0, around).otherwise(fresh), 1)


def domain(jd_domain: Column, preferences: Column, dial: Column, preset: Column, key: Column) -> Column:
    base, slope = (by_value(preset, {p: v[i] for p, v in STAY.items()}, float(i)) for i in (0, 1))
    stays = (F.trim(F.coalesce(jd_domain, F.lit(""))) != "") & (rng.uniform(key, "stay") < base + slope * dial)
    other = lambda a: F.filter(a, lambda d: normal(d) != normal(jd_domain))
    pool = F.when(F.size(preferences) > 0, preferences).otherwise(strings(FALLBACK_DOMAINS))
    pool = F.when(F.size(other(pool)) > 0, other(pool)).otherwise(other(strings(FALLBACK_DOMAINS)))
    return F.when(stays, F.trim(jd_domain)).otherwise(rng.pick(pool, key, "domain"))


def catalogue(paths: Column, supporting: Column, templates: Column) -> Column:
    """All skills of a profile in order, each once."""
    return M.distinct_in_order(F.concat(F.flatten(paths), supporting, F.flatten(F.transform(templates, lambda t: t["skills"]))))


def fillers(pairs: Column, jd_compact: Column) -> Column:
    """Skills of a profile, paired with their compact forms, that match none of the job's."""
    return M.let(M.joined(jd_compact), lambda job: F.transform(F.filter(pairs, lambda r: ~M.known(r["c"], job)), lambda r: r["x"]))


def shuffled(items: Column, key: Column, salt: str) -> Column:
    rows = F.transform(items, lambda x, i: F.struct(rng.uniform(key, salt, i).alias("u"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(rows), lambda r: r["x"])


def most_skills(strength: Column, preset: Column) -> Column:
    most = F.when(strength > 0.75, 10).when(strength > 0.45, 8).otherwise(6)
    return F.when(preset == "mismatch", F.least(most, F.lit(7))).otherwise(most)


def ranked_paths(paths: Column, matched_compact: Column, key: Column) -> Column:
    """Paths (p, with their compact forms c and whether they are delivery paths) by matched skills, length and
    chance, best first."""
    score = lambda r, known: F.lit(3) * F.size(F.filter(r["c"], lambda c: M.known(c, known)))
    rows = M.let(M.joined(matched_compact), lambda known: F.transform(paths, lambda r, i: F.struct((-score(r, known)).alias("s"), (-F.size(r["p"])).alias("n"), rng.uniform(key, "path", i).alias("u"), r["p"].alias("p"), r["delivery"].alias("delivery"))))
    return F.array_sort(rows)


def chosen_paths(ranked: Column, strength: Column, deployment: Column, preset: Column, key: Column) -> Column:
    """One to three paths: a seed among the best four (with a match if there is one), a delivery path if
    deployment weighs, then chance among the best three left."""
    top = F.slice(ranked, 1, 4)
    good = F.filter(top, lambda r: r["s"] < 0)
    seed = rng.pick(F.when(F.size(good) > 0, good).otherwise(top), key, "seed")["p"]
    wanted = (
        F.when((preset == "full_match") & (strength > 0.7) | (preset == "balanced") & (strength > 0.82), 3)
        .when(preset.isin("balanced", "full_match") | (strength > 0.58), 2)
        .otherwise(1)
    )
    all_paths = F.transform(ranked, lambda r: r["p"])
    delivery = F.try_element_at(F.filter(ranked, lambda r: (r["p"] != seed) & r["delivery"]), F.lit(1))["p"]

    def step(taken: Column, i: Column) -> Column:
        left = F.filter(all_paths, lambda p: ~F.array_contains(taken, p))
        use = (deployment > 0.58) & delivery.isNotNull() & ~F.array_contains(taken, delivery) & (rng.uniform(key, "deliver", i) < 0.8)
        following = F.when(use, delivery).otherwise(rng.pick(F.slice(left, 1, 3), key, "next", i))
        return F.when((F.size(taken) >= wanted) | (F.size(left) == 0), taken).otherwise(F.concat(taken, F.array(following)))

    first = F.when(seed.isNull(), F.array().cast("array<array<string>>")).otherwise(F.array(seed))
    return F.aggregate(F.sequence(F.lit(1), F.lit(2)), first, step)


def stack(paths: Column, skills: Column, limit: int) -> Column:
    """Skills of the paths, then others, each once, the first `limit`; Python if there are none."""
    every = F.slice(M.distinct_in_order(F.concat(F.flatten(paths), skills)), 1, limit)
    return F.when(F.size(every) > 0, every).otherwise(strings(["Python"]))


def degree(options: Column, wanted: Column, stage: Column, key: Column) -> Column:
    advanced = F.filter(options, lambda d: M.contains_any(normal(d), ["m.tech", "mca", "mba", "m.s", "ms", "m.sc"]))
    w = normal(wanted)
    use = (F.size(advanced) > 0) & M.contains_any(w, S.MASTER_WANTED) & (~w.contains("preferred") | (stage == "senior") | (rng.uniform(key, "honour") < 0.65))
    return F.when(use, rng.pick(advanced, key, "degree")).otherwise(rng.pick(options, key, "degree"))


def title(jd_title: Column, titles: Column, stage: Column, honoured: Column, key: Column, salt: str = "title") -> Column:
    keeps = honoured & (stage == "senior") & normal(jd_title).contains("senior")
    return F.when(keeps, jd_title).otherwise(F.coalesce(rng.pick(titles, key, salt), F.lit("Software Engineer")))


def earlier(stage: Column) -> Column:
    return F.when(stage == "senior", "mid").otherwise("entry")


def focus(themes: Column, matched: Column, target: Column, stage: Column, manages: Column, deployment: Column, used: Column, key: Column, salt: str) -> Column:
    """Focus lines: two themes, a stage line, skill lines, and lines of deployment and management."""
    n = F.size(themes)
    pool = F.when((stage == "entry") & (n > 4), F.slice(themes, F.lit(1), F.greatest(F.lit(5), F.floor(n / 2).cast("int")))).when((stage == "mid") & (n > 6), F.slice(themes, F.lit(1), F.greatest(F.lit(7), F.floor(n * 3 / 4).cast("int")))).otherwise(themes)
    fresh = F.filter(pool, lambda t: ~F.array_contains(used, t))
    pool = F.when(F.size(fresh) >= 2, fresh).otherwise(pool)
    lead = F.try_element_at(matched, F.lit(1))
    return M.distinct_in_order(
        F.concat(
            F.slice(shuffled(pool, key, salt + ".theme"), 1, 2),
            F.array(
                rng.pick(by_value(stage, {k: strings(v) for k, v in STAGE_LINES.items()}), key, salt + ".stage"),
                F.when(lead.isNotNull(), F.concat(F.lit("applied "), lead, F.lit(" to production work in "), target)),
                F.when(deployment > 0.55, "kept releases safe and observable"),
                F.when(manages, "coordinated and mentored a team"),
            ),
        )
    )


def figures(stage: Column, target: Column, branches: list[tuple[str, list[str]]], names: dict[str, list[str]], key: Column, salt: str) -> Column:
    """One of the stage's maps of the domain's branch, the first whose words the domain has, with values by
    stage.  A branch has five figures, a map two neighbours."""

    def branch_of(d: Column) -> Column:
        out = F.when(F.lit(False), strings([""]))
        for name, words in branches:
            out = out.when(M.contains_any(d, words), strings(names[name]))
        return out.otherwise(strings(names["other"]))

    size = by_value(stage, {"entry": 1, "mid": 10, "senior": 100}, 1)
    at = rng.integer(key, salt + ".map", F.lit(1), F.when(stage == "entry", 3).otherwise(4))
    one = F.concat((rng.integer(key, salt + ".a", 2, 9) * size).cast("string"), F.lit("k+"))
    other = F.concat(F.lit("<"), rng.integer(key, salt + ".b", 1, 5).cast("string"), F.lit("%"))
    two = lambda b: M.let(at, lambda i: F.create_map(F.element_at(b, i), one, F.element_at(b, i + 1), other))
    return M.let(M.let(normal(target), branch_of), two)


def with_design(figures: Column, architecture: Column) -> Column:
    """Figures, and more for event and serverless designs."""
    low, none = F.lower(architecture), F.create_map().cast("map<string,string>")
    event = F.when(low.contains("event"), F.create_map(F.lit("events"), F.lit("1M+/day"))).otherwise(none)
    serverless = F.when(low.contains("serverless"), F.create_map(F.lit("autoscaling"), F.lit("0 to 1k in 1 min"))).otherwise(none)
    return F.map_concat(figures, event, serverless)


def label(target: Column, key: Column, salt: str) -> Column:
    """A context word of the first known fragment of the domain, else a general one."""

    def of(d: Column) -> Column:
        out = F.when(F.lit(False), strings([""]))
        for fragment, labels in LABELS.items():
            out = out.when(d.contains(fragment), strings(labels))
        return out.otherwise(strings(GENERAL_LABELS))

    return M.let(normal(target), lambda d: M.let(of(d), lambda a: rng.pick(a, key, salt)))


def named(base: Column, words: Column, ctx: Column, plain: Column, key: Column, salt: str) -> Column:
    """One of the variants of a project's name (words: of its normal form) that don't repeat a word of its context
    ctx, whose normal form is plain."""

    def of(long: Column, suffix: Column) -> Column:
        overlap = F.arrays_overlap(words, F.split(plain, " "))
        variants = F.array(base, long, F.when(overlap, long).otherwise(F.concat(base, F.lit(" for "), ctx)), F.when(overlap, F.concat(base, F.lit(" Engine"))).otherwise(F.concat(ctx, F.lit(" "), suffix)))
        return M.let(F.array_distinct(variants), lambda a: rng.pick(a, key, salt + ".variant"))

    suffix = rng.pick(F.filter(strings(SUFFIXES), lambda x: (F.lower(x) != plain) & (F.lower(x) != F.element_at(words, -1))), key, salt + ".suffix")
    return M.let(suffix, lambda x: M.let(F.concat(base, F.lit(" "), x), lambda long: of(long, x)))


def project_name(name: Column, target: Column, key: Column, salt: str) -> Column:
    """One of the variants of a project's name that don't repeat a word."""
    return M.let(F.initcap(name), lambda base: M.let(F.split(normal(base), " "), lambda words: M.let(label(target, key, salt + ".ctx"), lambda ctx: M.let(normal(ctx), lambda plain: named(base, words, ctx, plain, key, salt)))))


def tail(target: Column, stage: Column, key: Column, salt: str) -> Column:
    """How a problem sentence ends."""
    of = lambda ctx: by_value(stage, {"entry": F.concat(F.lit("Aimed at "), ctx, F.lit(" users.")), "mid": F.concat(F.lit("Served the "), ctx, F.lit(" domain under load.")), "senior": F.concat(F.lit("Supports "), ctx, F.lit(" at scale."))})
    return M.let(label(target, key, salt + ".ctx"), of)


def problem(text: Column, target: Column, stage: Column, key: Column, salt: str) -> Column:
    return F.concat(text, F.lit(" "), tail(target, stage, key, salt))


def templates_for(templates: Column, skills_compact: Column, stage: Column, key: Column) -> Column:
    """The two (senior: three) templates with most matched skills, ties by chance."""
    hits = lambda t, known: F.filter(t["pairs"], lambda r: M.known(r["c"], known))
    rows = M.let(M.joined(skills_compact), lambda known: F.transform(templates, lambda t, i: F.struct((-F.size(hits(t, known))).alias("s"), rng.uniform(key, "template", i).alias("u"), t.alias("t"))))
    return F.transform(F.slice(F.array_sort(rows), F.lit(1), F.when(stage == "senior", 3).otherwise(2)), lambda r: r["t"])


def architecture(t: Column, i: Column, deployment: Column, key: Column) -> Column:
    """The design of the template that is a row's project i (from 0)."""
    more = F.when(deployment > 0.65, strings(["Event-Driven", "Serverless"])).otherwise(F.array().cast("array<string>"))
    return F.coalesce(M.let(M.distinct_in_order(F.concat(t["architecture"], more)), lambda a: rng.pick(a, key, "shape", i)), F.lit("Microservices"))


def metrics(chosen: Column, target: Column, stage: Column, deployment: Column, key: Column, branches, names) -> Column:
    """The quantitative_metrics of projects() alone: no project's figures depend on another project."""
    each = lambda own: F.transform(chosen, lambda t, i: with_design(own, architecture(t, i, deployment, key)))
    return M.let(figures(stage, target, branches, names, key, "figure"), each)


def projects(chosen: Column, recent: Column, recent_compact: Column, skills: Column, matched: Column, target: Column, stage: Column, deployment: Column, manages: Column, key: Column, branches, names) -> Column:
    """Projects in order; a fold carries the (compact) technologies and impacts that earlier ones used.  What all
    projects of a row share is made once, before it."""
    kind = "struct<done:array<struct<project_name:string,project_domain:string,business_problem:string,architecture_type:string,technologies_used:array<string>,complexity_tier:string,impact_signals:array<string>,quantitative_metrics:map<string,string>,resume_fit_reason:string>>,seen:array<string>,impacts:array<string>>"
    empty = F.from_json(F.lit('{"done":[],"seen":[],"impacts":[]}'), kind)
    lead = F.slice(F.when(F.size(matched) > 0, matched).otherwise(skills), 1, 2)
    why = F.concat(F.lit("Extends the "), F.array_join(lead, ", "), F.lit(" stack of the candidate's experience."), F.when(manages, " It also shows coordination.").otherwise(""))
    extra = by_value(stage, {k: strings(v) for k, v in EXTRA_IMPACTS.items()})
    shared = F.struct(
        M.joined(recent_compact).alias("recent"), M.paired(F.array_distinct(F.concat(recent, skills))).alias("every"), label(target, key, "name.ctx").alias("ctx"), tail(target, stage, key, "problem").alias("tail"),
        figures(stage, target, branches, names, key, "figure").alias("figures"), shuffled(extra, key, "extra").alias("extra"), why.alias("why"), by_value(stage, COMPLEXITY).alias("complexity"),
    )

    def own_of(t: Column, all_: Column, seen: Column) -> Column:
        """The template's skills that the recent stack has and no earlier project used."""
        return F.transform(F.filter(t["pairs"], lambda r: M.known(r["c"], all_["recent"]) & ~M.known(r["c"], seen)), lambda r: r["x"])

    def tech_of(t: Column, own: Column, all_: Column, seen: Column) -> Column:
        """Up to four: own ones first, then of the recent stack and the skills what is new."""
        fresh = M.let(M.joined(M.compacted(own)), lambda mine: F.filter(all_["every"], lambda r: ~M.known(r["c"], seen) & ~M.known(r["c"], mine)))
        more = F.slice(F.transform(fresh, lambda r: r["x"]), F.lit(1), F.greatest(F.lit(0), F.lit(4) - F.size(own)))
        return M.let(F.slice(M.distinct_in_order(F.concat(own, more)), 1, 6), lambda a: F.when(F.size(a) > 0, a).otherwise(F.slice(M.distinct_in_order(F.concat(t["skills"], skills)), 1, 4)))

    def signals_of(acc: Column, t: Column, all_: Column) -> Column:
        fresh = F.filter(M.distinct_in_order(F.concat(t["outcomes"], all_["extra"])), lambda x: ~F.array_contains(acc["impacts"], x))
        return M.let(fresh, lambda a: F.slice(shuffled(F.when(F.size(a) > 0, a).otherwise(extra), key, "impact"), 1, 2))

    def row_of(acc: Column, t: Column, all_: Column, plain: Column, tech: Column, shape: Column, signals: Column) -> Column:
        row = F.struct(
            named(t["title"], t["words"], all_["ctx"], plain, key, "name").alias("project_name"), target.alias("project_domain"), F.concat(t["problem"], F.lit(" "), all_["tail"]).alias("business_problem"),
            shape.alias("architecture_type"), tech.alias("technologies_used"), all_["complexity"].alias("complexity_tier"), signals.alias("impact_signals"),
            with_design(all_["figures"], shape).alias("quantitative_metrics"), all_["why"].alias("resume_fit_reason"),
        )
        return F.struct(F.concat(acc["done"], F.array(row)).alias("done"), F.concat(acc["seen"], M.compacted(tech)).alias("seen"), F.array_union(acc["impacts"], signals).alias("impacts")).cast(kind)

    def add(acc: Column, t: Column, all_: Column, plain: Column) -> Column:
        shape = architecture(t, F.size(acc["done"]), deployment, key)
        tech = lambda seen: M.let(own_of(t, all_, seen), lambda own: tech_of(t, own, all_, seen))
        return M.let(M.let(M.joined(acc["seen"]), tech), lambda tech: M.let(shape, lambda sh: M.let(signals_of(acc, t, all_), lambda sig: row_of(acc, t, all_, plain, tech, sh, sig))))

    fold = lambda all_, plain: F.aggregate(chosen, empty, lambda acc, t: add(acc, t, all_, plain), lambda acc: acc["done"])
    return M.let(shared, lambda all_: M.let(normal(all_["ctx"]), lambda plain: fold(all_, plain)))


def company_choices(jds: DataFrame, profiles: DataFrame, companies: DataFrame, usage: DataFrame | None) -> DataFrame:
    """(preferred, order, c_*): what rows with this list of preferred domains and this order of tiers draw from,
    for each role and each domain that a candidate of jds can end in.

    c_good are the companies of a preferred domain in the first tier that has any, c_mates others of that tier if
    these are few; c_next and c_next_mates the same of the next tier, for rows whose only one is taken; c_ladder
    those of the order's tiers, and c_all the pool, where next to nothing fits.  weight w is by usage.  The pool is
    one row of POOL companies at most, or the query fails; it meets the distinct lists, not the rows.  Up to CHOICES
    rows, which are counted, are broadcast; more meet by a shuffle."""
    own = profiles.select(F.explode("domains").alias("target"))
    targets = jds.select(F.trim("domain").alias("target")).union(own).union(profiles.select(F.explode(strings(FALLBACK_DOMAINS)))).where("target is not null").distinct()
    lists = profiles.agg(F.collect_set("company_domains").alias("lists"))
    lists = lists.select(F.when(F.size("lists") <= LISTS, F.col("lists")).otherwise(F.raise_error(F.lit(f"more than {LISTS} lists of company domains"))).alias("lists"))
    wanted = targets.crossJoin(F.broadcast(lists)).select("target", F.explode("lists").alias("own"))  # one row
    wanted = wanted.select(M.distinct_in_order(F.concat("own", F.array("target"))).alias("preferred")).distinct()
    few = len(LADDER) * 2 * wanted.count() <= CHOICES
    pool, weight = companies, F.lit(1.0)
    if usage is not None:
        pool = companies.join(usage, "name", "left")
        weight = S.usage_weight(F.coalesce(F.col("used"), F.lit(0)).cast("double"))
    every = pool.select(F.struct("tier", "name", "domain", "ctc", weight.alias("w"), normal(F.col("domain")).alias("plain")).alias("c")).agg(F.array_sort(F.collect_list("c")).alias("pool"))
    every = every.select(F.when(F.size("pool") <= POOL, F.col("pool")).otherwise(F.raise_error(F.lit(f"more than {POOL} companies"))).alias("pool"))
    orders = [F.struct(F.lit(f"{stage}|{weak}").alias("order"), strings(tiers[::-1] if weak else tiers).alias("tiers")) for stage, tiers in LADDER.items() for weak in (False, True)]
    fits = M.let(F.transform("preferred", normal), lambda wanted: F.filter("pool", lambda c: F.exists(wanted, lambda w: M.plain_domains_match(w, c["plain"]))))
    d = wanted.crossJoin(F.broadcast(every)).withColumn("fits", fits).select("*", F.inline(F.array(*orders)))  # one row
    d = d.withColumn("levels", F.filter("tiers", lambda t: F.exists("fits", lambda c: c["tier"] == t)))
    nothing = F.filter("pool", lambda c: F.lit(False))
    of = lambda k: F.filter("fits", lambda c: c["tier"] == F.get("levels", F.lit(k)))
    d = d.withColumns({"c_good": of(0), "c_next": of(1)}).withColumn("c_next", F.when(F.size("c_good") == 1, F.col("c_next")).otherwise(nothing))
    mates = lambda k: F.filter("pool", lambda c: (c["tier"] == F.get("levels", F.lit(k))) & ~F.exists("fits", lambda g: g["name"] == c["name"]))
    few = lambda c: (F.size(c) > 0) & (F.size(c) <= 3)
    none_left = (F.size("c_good") == 0) | ((F.size("c_good") == 1) & (F.size("c_next") == 0))
    ladder = F.when(none_left, F.filter("pool", lambda c: F.array_contains("tiers", c["tier"]))).otherwise(nothing)
    d = d.withColumns({"c_mates": F.when(few("c_good"), mates(0)).otherwise(nothing), "c_next_mates": F.when(few("c_next"), mates(1)).otherwise(nothing), "c_ladder": ladder})
    d = d.withColumn("c_all", F.when(none_left & (F.size("c_ladder") <= 1), F.col("pool")).otherwise(nothing))
    d = d.select("preferred", "order", "c_good", "c_mates", "c_next", "c_next_mates", "c_ladder", "c_all")
    return F.broadcast(d) if few else d


def choose_company(rows: DataFrame, choices: DataFrame, stage: str, strength: str, excluded: str | None, salt: str, out: str) -> DataFrame:
    """Adds a company struct: tiers in the stage's order (reversed for weak candidates), the first tier
    with companies of a preferred domain, blended with four tier-mates if it has fewer than three; weighted
    by usage, without bias.  rows has __key and preferred; choices are company_choices()."""
    key = F.col(KEY)
    r = rows.withColumn("order", F.concat(stage, F.when(F.col(strength) < 0.35, "|True").otherwise("|False"))).join(choices, ["preferred", "order"])
    free = lambda a: F.filter(a, lambda c: c["name"] != F.coalesce(F.col(excluded), F.lit(""))) if excluded else F.col(a)
    first = F.size(free("c_good")) > 0

    def blend(good: Column) -> Column:
        mates = F.when(first, free("c_mates")).otherwise(free("c_next_mates"))
        wide = F.when(F.size(free("c_ladder")) > 0, free("c_ladder")).otherwise(free("c_all"))
        return F.when(F.size(good) >= 3, good).when(F.size(good) > 0, F.concat(good, F.slice(shuffled(mates, key, salt + ".mate"), 1, 4))).otherwise(wide)

    cands = M.let(F.when(first, free("c_good")).otherwise(free("c_next")), blend)
    keyed = F.transform(cands, lambda c, i: F.struct((-F.log(rng.uniform(key, salt, i)) / c["w"]).alias("u"), c.alias("c")))
    won = F.try_element_at(F.array_sort(keyed), F.lit(1))["c"]
    default = F.struct(F.lit("tier_5").alias("tier"), F.lit("Confidential Company").alias("name"), F.lit("Technology").alias("domain"), F.lit("₹10 LPA").alias("ctc"), F.lit(1.0).alias("w"), F.lit("technology").alias("plain"))
    return r.withColumn(out, F.coalesce(won, default)).drop("order", *(c for c in choices.columns if c.startswith("c_")))


def contact(record_id: Column) -> Column:
    """Contact data that depend on the id only."""
    name = F.concat(rng.pick(strings(FIRST_NAMES), record_id, "first"), F.lit(" "), rng.pick(strings(LAST_NAMES), record_id, "last"))
    phone = F.format_string("+91 %d%09d", rng.integer(record_id, "p1", 6, 9), rng.integer(record_id, "p2", 100_000_000, 999_999_999))
    mail = F.concat(F.translate(F.lower(name), " '", "."), rng.integer(record_id, "m", 1, 99).cast("string"), F.lit("@"), rng.pick(strings(MAILS), record_id, "d"))
    return F.struct(name.alias("name"), rng.pick(strings(CITIES), record_id, "city").alias("city"), phone.alias("phone"), mail.alias("email"))


#: Parts of a candidate, in the order they are made, and what each needs.
PARTS = {"persona": [], "companies": ["persona"], "skills": ["persona"], "paths": ["skills"], "focus": ["skills"], "experience": ["companies", "paths", "focus"], "templates": ["skills"], "metrics": ["templates"], "projects": ["paths", "templates"], "school": ["persona"], "scored": ["experience", "projects", "school"]}


def candidates(jds: DataFrame, profiles: DataFrame, companies: DataFrame, colleges: DataFrame, adjacent: dict[str, str], mismatch: dict[str, list[str]], branches, names, usage: DataFrame | None = None, as_of_year: int = 2025, part: str = "scored") -> DataFrame:
    """One candidate for each row of jds (jd_id, job_title, jd_role, skills, domain, min_years, manages,
    education, preset, attempt), scored; or only the part of it that is asked for, and what that needs, which keeps
    the plan small.  usage is a table (name, used) of company counts."""
    make = {
        "persona": lambda r: _persona(r, profiles, adjacent, mismatch),
        "companies": lambda r: _companies(r, company_choices(jds, profiles, companies, usage)),
        "skills": lambda r: _skills(r, profiles),
        "paths": _paths,
        "focus": _focus,
        "experience": _experience,
        "templates": lambda r: r.withColumn("bundle_compact", M.compacted(F.col("bundle"))).withColumn("chosen", templates_for(F.col("p_templates"), F.col("bundle_compact"), F.col("stage"), F.col(KEY))),
        "metrics": lambda r: r.withColumn("metrics", metrics(F.col("chosen"), F.col("target"), F.col("stage"), F.col("dials.deployment_skills"), F.col(KEY), branches, names)),
        "projects": lambda r: _projects(r, branches, names),
        "school": lambda r: _school(r, colleges, as_of_year),
        "scored": lambda r: _scored(r, adjacent),
    }
    needed, todo = set(), [part]
    while todo:
        needed.add(todo[-1])
        todo += [x for x in PARTS[todo.pop()] if x not in needed]
    # unmarked, Spark deals all rows of a role, or of a tier of colleges, to one task
    profiles, colleges = joins.bounded(profiles), joins.bounded(colleges) if "school" in needed else colleges
    # a row costs a millisecond: few rows of one file would keep one task busy
    tasks = int(jds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = jds.withColumn(KEY, F.concat_ws("|", "jd_id", "preset", "attempt")).repartition(tasks, KEY)
    for name in PARTS:
        if name in needed:
            r = make[name](r)
    return r.drop(*(c for c in r.columns if c.startswith(("p_", "f_"))))


def _persona(r: DataFrame, profiles: DataFrame, adjacent: dict[str, str], mismatch: dict[str, list[str]]) -> DataFrame:
    k = F.col(KEY)
    pools = F.when(F.lit(False), strings([""]))
    for role, others in mismatch.items():
        pools = pools.when(F.col("jd_role") == role, strings(others))
    role = F.when(F.col("preset") == "mismatch", F.coalesce(rng.pick(pools, k, "role"), F.col("jd_role"))).otherwise(F.col("jd_role"))
    r = r.withColumns({"dials": dials(F.col("preset"), k), "role": role, "need": S.required_years(F.col("min_years"), F.col("job_title")), "band": S.band(F.col("job_title"))})
    filler = F.when(F.col("preset") == "hard_negative", F.coalesce(by_value(F.col("jd_role"), adjacent), F.col("role"))).otherwise(F.col("role"))
    strength = (F.col("dials.education_tier") + F.col("dials.skill_coverage")) / 2
    r = r.withColumns({"filler": filler, "strength": strength, "years": experience(F.col("need.years"), F.col("dials.experience_years"), F.col("preset"), k), "generated_manages": F.col("manages") | (F.col("band") == "principal")})
    mine = profiles.select("role", *(F.col(c).alias(f"p_{c}") for c in ("domains", "company_domains", "degrees", "themes", "titles")))
    r = r.join(mine, "role")  # one row a role
    r = r.withColumns({"stage": S.stage(F.col("years")), "target": domain(F.col("domain"), F.col("p_domains"), F.col("dials.domain_relevance"), F.col("preset"), k)})
    return r.withColumns({"before": earlier(F.col("stage")), "two": (F.col("years") >= 5.0) & F.col("stage").isin("mid", "senior")})


def _companies(r: DataFrame, choices: DataFrame) -> DataFrame:
    r = r.withColumns({"preferred": M.distinct_in_order(F.concat("p_company_domains", F.array("target"))), "weaker": F.col("strength") * 0.88})
    r = choose_company(r, choices, "stage", "strength", None, "company", "company").withColumn("taken", F.col("company.name"))
    return choose_company(r, choices, "before", "weaker", "taken", "previous", "previous")


def _prepared(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What depends on profiles alone, made once a profile and not once a row: compact forms of catalogue, templates
    and paths, titles of projects and their words, and which paths deliver; for a row's role and for its filler."""
    def template(t: Column) -> Column:
        return F.struct(*(t[f].alias(f) for f in ("name", "skills", "problem", "architecture", "outcomes")), M.paired(t["skills"]).alias("pairs"), F.initcap(t["name"]).alias("title"), F.split(normal(F.initcap(t["name"])), " ").alias("words"))

    paths, support, templates = F.col("skill_paths"), F.col("supporting_skills"), F.col("templates")
    mine = profiles.select("role", M.paired(catalogue(paths, support, templates)).alias("p_pairs"), F.transform(templates, template).alias("p_templates"))
    every = M.distinct_in_order(F.concat(F.flatten(paths), F.flatten(F.transform(templates, lambda t: t["skills"])), support))
    path = lambda p: F.struct(p.alias("p"), M.compacted(p).alias("c"), M.is_delivery(p).alias("delivery"))
    return mine, profiles.select(F.col("role").alias("filler"), F.transform(paths, path).alias("f_paths"), M.paired(every).alias("f_pairs"))


def _skills(r: DataFrame, profiles: DataFrame) -> DataFrame:
    k = F.col(KEY)
    mine, fill = _prepared(profiles)
    r = r.join(mine, "role").join(fill, "filler")
    firsts = F.transform("skills", lambda s: M.first_of_pairs(s, F.col("p_pairs")))
    r = r.withColumns({"jd_compact": M.compacted(F.col("skills")), "firsts": firsts, "most": most_skills(F.col("strength"), F.col("preset"))})
    r = r.withColumn("available", M.distinct_in_order(F.col("firsts")))
    r = r.withColumn("kept", rng.subset(F.col("available"), match_count(F.size("available"), F.col("dials.skill_coverage"), F.col("preset"), k), k, "keep"))
    spare = F.slice(shuffled(fillers(F.col("f_pairs"), F.col("jd_compact")), k, "fill"), F.lit(1), F.greatest(F.lit(0), F.col("most") - F.size("kept")))
    r = r.withColumn("bundle", M.distinct_in_order(F.concat("kept", spare)))
    short = (F.size("bundle") < 4) & (F.col("preset") != "mismatch")
    missing = F.filter("skills", lambda s, i: F.element_at(F.col("firsts"), i + 1).isNull())
    return r.withColumn("bundle", F.slice(F.when(short, M.distinct_in_order(F.concat("bundle", missing))).otherwise(F.col("bundle")), F.lit(1), F.col("most")))


def _paths(r: DataFrame) -> DataFrame:
    k = F.col(KEY)
    r = r.withColumn("ranked", ranked_paths(F.col("f_paths"), M.compacted(F.col("kept")), k))
    r = r.withColumn("paths", chosen_paths(F.col("ranked"), F.col("strength"), F.col("dials.deployment_skills"), F.col("preset"), k))
    return r.withColumn("recent_stack", stack(F.col("paths"), F.col("bundle"), 5))


def _focus(r: DataFrame) -> DataFrame:
    areas = focus(F.col("p_themes"), F.col("kept"), F.col("target"), F.col("stage"), F.col("generated_manages"), F.col("dials.deployment_skills"), F.array().cast("array<string>"), F.col(KEY), "now")
    return r.withColumn("now_focus", F.slice(areas, 1, 3))


def _experience(r: DataFrame) -> DataFrame:
    k = F.col(KEY)
    share = 0.45 + 0.17 * rng.uniform(k, "recent")
    recent = half_up(F.greatest(F.lit(1.5), F.least(F.col("years") - 1.0, F.col("years") * share)), 1)
    r = r.withColumn("recent", F.when(F.col("two"), recent).otherwise(F.greatest(F.lit(1.0), F.col("years"))))
    honoured = (F.col("role") == F.col("jd_role")) & (F.col("preset") != "mismatch")
    then_focus = F.slice(focus(F.col("p_themes"), F.slice("kept", 1, 2), F.col("target"), F.col("before"), F.col("generated_manages") & (F.col("before") != "entry"), F.greatest(F.lit(0.0), F.col("dials.deployment_skills") - 0.1), F.col("now_focus"), k, "then"), 1, 2)

    def job(company: str, years: Column, name: Column, tech: Column, areas: Column) -> Column:
        return F.struct(F.col(f"{company}.name").alias("company"), F.col(f"{company}.domain").alias("company_domain"), F.col("target").alias("role_domain"), years.alias("duration_years"), name.alias("role_title"), tech.alias("primary_tech_stack"), areas.alias("focus_areas"))

    current = job("company", F.col("recent"), title(F.col("job_title"), F.col("p_titles"), F.col("stage"), honoured, k), F.col("recent_stack"), F.col("now_focus"))
    past = job("previous", half_up(F.greatest(F.lit(1.0), F.col("years") - F.col("recent")), 1), title(F.col("job_title"), F.col("p_titles"), F.col("before"), F.lit(False), k, "title2"), stack(F.slice("paths", 1, 1), F.slice("bundle", 1, 5), 4), then_focus)
    return r.withColumn("experience", F.when(F.col("two"), F.array(current, past)).otherwise(F.array(current)))


def _projects(r: DataFrame, branches, names) -> DataFrame:
    return r.withColumn("projects", projects(F.col("chosen"), F.col("recent_stack"), M.compacted(F.col("recent_stack")), F.col("bundle"), F.col("kept"), F.col("target"), F.col("stage"), F.col("dials.deployment_skills"), F.col("generated_manages"), F.col(KEY), branches, names))


def _school(r: DataFrame, colleges: DataFrame, as_of_year: int) -> DataFrame:
    k = F.col(KEY)
    schools = colleges.groupBy("tier").agg(F.array_sort(F.collect_list("name")).alias("p_schools"))
    r = r.withColumn("tier", S.college_tier(F.col("education"), F.col("dials.education_tier"))).join(schools, "tier", "left")
    buffer = F.when(F.col("band") == "principal", 2).when(F.col("stage").isin("mid", "senior"), 1).otherwise(0)
    year = F.lit(as_of_year) - F.greatest(F.lit(1), F.bround(F.col("years") + buffer, 0).cast("int"))
    return r.withColumn("school", F.struct(F.coalesce(rng.pick(F.col("p_schools"), k, "school"), F.lit("Open University")).alias("institution"), degree(F.col("p_degrees"), F.col("education"), F.col("stage"), k).alias("degree"), year.alias("graduation_year")))


def in_rounds(jds: DataFrame, round_of: Column, rounds: int, companies: DataFrame, make, store) -> DataFrame:
    """Candidates of jds in rounds 0 .. rounds - 1 (round_of, an expression of jds; null counts as 0): a company
    that the rounds before used n times weighs 1 / (1 + ln(1 + n)) in a round's draws.

    make(rows, usage) generates, and store(df) writes a round to a table, which is then read: a lost executor costs
    its tasks of one round.  A round's counts are one row a company; both jobs of a candidate count if it has two."""
    rows = jds.withColumn("__round", F.coalesce(round_of.cast("int"), F.lit(0)))
    out, usage = None, companies.select("name", F.lit(0).cast("long").alias("used"))
    for n in range(rounds):
        done = store(make(rows.where(F.col("__round") == n), usage).withColumnRenamed("__round", "round"))
        out = done if out is None else out.unionByName(done)
        both = F.when(F.col("two"), F.array("company.name", "previous.name")).otherwise(F.array("company.name"))
        used = done.select(F.explode(both).alias("name")).groupBy("name").agg(F.count("*").alias("used"))
        usage = store(usage.unionByName(used).groupBy("name").agg(F.sum("used").alias("used")))
    return out


def _scored(r: DataFrame, adjacent: dict[str, str]) -> DataFrame:
    inventory = M.distinct_in_order(F.concat("bundle", F.flatten(F.transform("experience", lambda e: F.concat(e["primary_tech_stack"], e["focus_areas"]))), F.flatten(F.transform("projects", lambda p: F.concat(p["technologies_used"], p["impact_signals"], F.array(p["architecture_type"]))))))
    logistics = F.struct(S.notice(F.col("dials.notice_period")).alias("notice_period"), F.col("company.ctc").alias("current_ctc"))
    r = r.withColumns({"logistics": logistics, "inventory": inventory}).withColumn("inv_compact", M.compacted(F.col("inventory")))
    r = r.withColumn("matched", M.matched(F.col("skills"), F.col("inv_compact")))
    total = half_up(F.aggregate("experience", F.lit(0.0), lambda a, e: a + e["duration_years"]), 1)
    near = F.lit(False)
    for a, b in adjacent.items():
        near = near | ((F.col("jd_role") == a) & (F.col("role") == b))
    observed = F.concat(F.array(F.col("experience")[0]["role_domain"]), F.transform("experience", lambda e: e["company_domain"]), F.transform("projects", lambda p: p["project_domain"]))
    r = r.withColumn("total_years", total).withColumns(
        {
            "skill_coverage": S.coverage(F.size("matched"), F.size("skills")),
            "experience_fit": S.experience(F.col("total_years"), F.col("need.years")),
            "role_alignment": S.role(F.col("jd_role") == F.col("role"), near),
            "domain_alignment": S.domain(F.col("domain"), observed),
            "education_fit": S.education(F.col("education"), F.col("school.degree"), F.col("school.institution")),
            "deployment_alignment": S.deployment(F.col("skills"), F.col("inv_compact")),
            "management_alignment": S.management(F.col("manages"), F.col("generated_manages")),
        }
    )
    return r.withColumn("overall", half_up(S.overall({a: F.col(a) for a in S.WEIGHTS}), 3)).withColumn(
        "rationale", S.rationale(F.col("skills"), F.col("matched"), F.col("total_years"), F.col("need.years"), F.col("role_alignment"), F.col("domain_alignment"), F.col("manages"), F.col("management_alignment"))
    )


def passes() -> Column:
    """Whether a scored candidate is what its preset asks for."""
    return S.fits_preset(F.col("preset"), F.col("overall"), F.col("experience_fit"), F.col("jd_role") == F.col("role"))


def accepted(jds: DataFrame, by: list[str], make, store, most: int = 6, at_once: bool = False, ends: tuple[int, ...] | None = None) -> DataFrame:
    """One candidate for each row of jds (keys `by`): the first attempt that its preset accepts, else the last
    of `most`.  make(jds with column attempt) generates, and store(df) writes what is made to a table that is then
    read.  Only what is still open is tried again: attempt after attempt, or with at_once all further attempts in one
    plan, which makes more candidates but plans twice only.  ends says otherwise: the last attempt of each plan."""
    tried = lambda rows: store(make(rows).withColumn("accepted", passes()))
    ends = [n for n in ends or ((1,) if at_once else range(1, most)) if n < most] + [most]
    out, left, first = None, jds, 1
    for last in ends:
        if first == last:
            made = tried(left.withColumn("attempt", F.lit(first)))
        else:
            more = tried(left.withColumn("attempt", F.explode(F.sequence(F.lit(first), F.lit(last)))))
            taken = more.groupBy(*by).agg(F.coalesce(F.min(F.when(F.col("accepted"), F.col("attempt"))), F.lit(last)).alias("attempt"))
            made = more.join(taken, [*by, "attempt"]).select(*more.columns)
        done = made if last == most else made.where("accepted")
        out = done if out is None else out.unionByName(done)
        left, first = left.join(made.where("not accepted").select(*by), by, "left_semi"), last + 1
    return out
