"""The SQL that candidate generation is held against: the same rules and draws as chains of table expressions."""

from __future__ import annotations

from ..functions import match as M
from ..functions import score as S
from ..operators import generate as G
from . import profiles as P
from .tools import DOMAINS, TITLES, WANTED, contains_sql, sql_compact, sql_list, sql_match, sql_normal, sql_pick, sql_text, sql_u

NO_TEXT = "CAST([] AS VARCHAR[])"


def number(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def lit(x) -> str:
    """A text, a list or a struct of them."""
    if isinstance(x, str):
        return sql_text(x)
    if isinstance(x, dict):
        return "{" + ", ".join(f"'{k}': {lit(v)}" for k, v in x.items()) + "}"
    return "[" + ", ".join(map(lit, x)) + "]" if x else NO_TEXT


def u(salt: str, i: str = "0") -> str:
    return sql_u("key", salt, i)


def normal(salt: str, i: str = "0") -> str:
    return f"(sqrt({number(-2)} * ln({u(salt + '.a', i)})) * cos({number(2)} * pi() * {u(salt + '.b', i)}))"


def integer(salt: str, low, high, i: str = "0") -> str:
    return f"CAST({low} + floor({u(salt, i)} * ({high} - {low} + 1)) AS INT)"


def choice(items: str, salt: str, i: str = "0") -> str:
    return f"({items})[CAST(1 + floor({u(salt, i)} * greatest(len({items}), 1)) AS BIGINT)]"


def case(c: str, values: dict, other: str = "NULL") -> str:
    return f"CASE {c} " + " ".join(f"WHEN {sql_text(k)} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


def distinct(items: str) -> str:
    """Of a column: without nulls, empty and repeated items, in order."""
    return f"list_filter({items}, lambda dx, di: dx IS NOT NULL AND dx <> '' AND list_position({items}, dx) = di)"


def shuffled(items: str, salt: str) -> str:
    return f"list_transform(list_sort(list_transform({items}, lambda sx, si: {{'u': {u(salt, '(si - 1)')}, 'i': si, 'x': sx}})), lambda sr: sr.x)"


def subset(items: str, k: str, salt: str) -> str:
    rows = f"list_sort(list_transform({items}, lambda sx, si: {{'u': {u(salt, '(si - 1)')}, 'i': si, 'x': sx}}))"
    return f"list_transform(list_sort(list_transform(({rows})[1:greatest(0, {k})], lambda sr: {{'i': sr.i, 'x': sr.x}})), lambda st: st.x)"


def truncated(salt: str, mean: str, sd: str, low: str, high: str) -> str:
    return f"coalesce(list_filter(list_transform(range(1, 13), lambda ti: {mean} + {sd} * {normal(salt, 'ti')}), lambda tx: tx >= {low} AND tx <= {high})[1], greatest({low}, least({high}, {mean})))"


def half_up(x: str, digits: int) -> str:
    return f"(floor({x} * {number(10**digits)} + {number(0.5)}) / {number(10**digits)})"


def flat(items: str) -> str:
    return f"flatten({items})"


def has_match(x: str, known: str) -> str:
    """Whether x matches one of a list of compact texts."""
    return f"(len(list_filter({known}, lambda mo: {sql_match(sql_compact(x), 'mo')})) > 0)"


def domains_match(w: str, o: str) -> str:
    w, o = sql_normal(w), sql_normal(o)
    return f"({w} <> '' AND (contains({o}, {w}) OR contains({w}, {o}) OR len(list_intersect(string_split({w}, ' '), string_split({o}, ' '))) >= 2))"


def stage_of(years: str) -> str:
    return f"CASE WHEN {years} >= 7 THEN 'senior' WHEN {years} >= {number(2.5)} THEN 'mid' ELSE 'entry' END"


def match_count(total: str, dial: str) -> str:
    low, high = (case("preset", {p: number(v[i]) for p, v in G.MATCH_SHARE.items()}, number(G.MATCH_SHARE["balanced"][i])) for i in (0, 1))
    least = f"greatest(1, CAST(round_even({total} * {low}, 0) AS INT))"
    most = f"greatest({least}, CAST(round_even({total} * {high}, 0) AS INT))"
    target = f"greatest({least}, CAST(round_even({total} * ({low} + ({high} - {low}) * greatest({number(0)}, least({number(1)}, {dial}))), 0) AS INT))"
    floor = f"greatest({least}, {target} - 1)"
    ceiling = f"greatest({floor}, least({total}, greatest({most}, {target} + 1)))"
    few = f"least({total}, CASE WHEN {dial} < {number(0.1)} THEN 1 ELSE 2 END)"
    return f"CASE WHEN {total} <= 0 THEN 0 WHEN preset = 'mismatch' THEN {integer('count', 0, few)} ELSE {integer('count', floor, ceiling)} END"


def _experience() -> str:
    shift, share = (case("preset", {p: number(v[i]) for p, v in G.SHIFT.items()}) for i in (0, 1))
    need = "CAST(need AS DOUBLE)"
    around = truncated("years", f"{need} * ({number(1)} + {shift} + (d_experience_years - {number(0.5)}) * {number(0.22)})", f"greatest({number(0.8)}, {need} * {number(0.16)})", f"greatest({number(0.8)}, {need} * {share})", f"greatest({need} + {number(5)}, {need} * {number(1.7)})")
    fresh = truncated("fresh", *(case("preset", {p: number(v[i]) for p, v in G.FRESHER.items()}) for i in range(4)))
    return half_up(f"CASE WHEN need > 0 THEN {around} ELSE {fresh} END", 1)


def _band() -> str:
    t = sql_normal("job_title")
    return "CASE " + " ".join(f"WHEN {contains_sql(t, words)} THEN '{b}'" for b, _, words in S.BANDS) + " ELSE 'unspecified' END"


def _company(before: str, name: str, stage: str, strength: str, excluded: str | None, salt: str, out: str, used: str | None = None) -> str:
    """Steps that add a company struct `out` to table expression `before`, as `name`; used is a map of how often
    companies were drawn."""
    weight = f" / ({number(1)} / ({number(1)} + ln({number(1)} + coalesce({used}[c.name], 0))))" if used else ""
    pool = lit([{"tier": t, "name": n, "domain": d, "ctc": c} for t, n, d, c in sorted(P.COMPANIES)])
    ladder = case(stage, {k: sql_list(v) for k, v in G.LADDER.items()})
    free = f"list_filter({pool}, lambda c: c.name <> {excluded})" if excluded else pool
    blend = f"CASE WHEN len(good) < 3 THEN good || ({shuffled('mates', salt + '.mate')})[1:4] ELSE good END"
    none = "{'tier': 'tier_5', 'name': 'Confidential Company', 'domain': 'Technology', 'ctc': '₹10 LPA'}"
    return (
        f"{name}1 AS (SELECT *, CASE WHEN {strength} < {number(0.35)} THEN list_reverse({ladder}) ELSE {ladder} END AS ladder, {free} AS free FROM {before}), "
        f"{name}2 AS (SELECT *, list_filter(free, lambda c: len(list_filter(preferred, lambda w: {domains_match('w', 'c.domain')})) > 0) AS fits FROM {name}1), "
        f"{name}3 AS (SELECT *, list_filter(ladder, lambda t: len(list_filter(fits, lambda c: c.tier = t)) > 0)[1] AS level FROM {name}2), "
        f"{name}4 AS (SELECT *, list_filter(fits, lambda c: c.tier = level) AS good, list_filter(free, lambda c: c.tier = level AND len(list_filter(fits, lambda g: g.name = c.name)) = 0) AS mates, list_filter(free, lambda c: list_contains(ladder, c.tier)) AS near FROM {name}3), "
        f"{name}5 AS (SELECT *, CASE WHEN level IS NOT NULL THEN {blend} WHEN len(near) > 0 THEN near ELSE free END AS cands FROM {name}4), "
        f"{name} AS (SELECT * EXCLUDE (ladder, free, fits, level, good, mates, near, cands), coalesce(list_sort(list_transform(cands, lambda c, i: {{'u': -ln({u(salt, '(i - 1)')}){weight}, 'c': c}}))[1].c, {none}) AS {out} FROM {name}5)"
    )


def _focus(themes: str, lead: str, stage: str, manages: str, deployment: str, used: str, salt: str) -> str:
    """Raw focus lines, still with nulls and repeats."""
    n = f"len({themes})"
    pool = f"CASE WHEN {stage} = 'entry' AND {n} > 4 THEN ({themes})[1:greatest(5, CAST(floor({n} / 2) AS INT))] WHEN {stage} = 'mid' AND {n} > 6 THEN ({themes})[1:greatest(7, CAST(floor({n} * 3 / 4) AS INT))] ELSE {themes} END"
    fresh = f"list_filter({pool}, lambda fx: NOT list_contains({used}, fx))"
    pool = f"CASE WHEN len({fresh}) >= 2 THEN {fresh} ELSE {pool} END"
    line = choice(case(stage, {k: sql_list(v) for k, v in G.STAGE_LINES.items()}), salt + ".stage")
    return f"({shuffled(pool, salt + '.theme')})[1:2] || [{line}, CASE WHEN {lead} IS NOT NULL THEN 'applied ' || {lead} || ' to production work in ' || target END, CASE WHEN {deployment} > {number(0.55)} THEN 'kept releases safe and observable' END, CASE WHEN {manages} THEN 'coordinated and mentored a team' END]"


def label(salt: str) -> str:
    d = sql_normal("target")
    words = "CASE " + " ".join(f"WHEN contains({d}, {sql_text(f)}) THEN {sql_list(w)}" for f, w in G.LABELS.items()) + f" ELSE {sql_list(G.GENERAL_LABELS)} END"
    return choice(words, salt)


def project_steps(before: str, name: str, text: str, salt: str, out: str) -> str:
    """Steps that add a project's name `out`, made of column `text`, which is in lower case."""
    base = f"array_to_string(list_transform(string_split({text}, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"
    suffix = choice(f"list_filter({sql_list(G.SUFFIXES)}, lambda x: lower(x) <> plain AND lower(x) <> words[-1])", salt + ".suffix")
    variants = "[base, long, CASE WHEN overlap THEN long ELSE base || ' for ' || ctx END, CASE WHEN overlap THEN base || ' Engine' ELSE ctx || ' ' || suffix END]"
    return (
        f"{name}1 AS (SELECT *, {base} AS base, {label(salt + '.ctx')} AS ctx FROM {before}), {name}2 AS (SELECT *, string_split({sql_normal('base')}, ' ') AS words, {sql_normal('ctx')} AS plain FROM {name}1), "
        f"{name}3 AS (SELECT *, list_has_any(words, string_split(plain, ' ')) AS overlap, {suffix} AS suffix FROM {name}2), {name}4 AS (SELECT *, base || ' ' || suffix AS long FROM {name}3), "
        f"{name}5 AS (SELECT *, {variants} AS raw_variants FROM {name}4), {name}6 AS (SELECT *, {distinct('raw_variants')} AS variants FROM {name}5), "
        f"{name} AS (SELECT * EXCLUDE (base, ctx, words, plain, overlap, suffix, long, raw_variants, variants), {choice('variants', salt + '.variant')} AS {out} FROM {name}6)"
    )


def problem(text: str, stage: str, salt: str) -> str:
    ctx = label(salt + ".ctx")
    return f"{text} || ' ' || " + case(stage, {"entry": f"'Aimed at ' || {ctx} || ' users.'", "mid": f"'Served the ' || {ctx} || ' domain under load.'", "senior": f"'Supports ' || {ctx} || ' at scale.'"})


def figures(shape: str) -> str:
    """Entries 'name=value' of a project's figures."""
    d = sql_normal("target")
    names = "CASE " + " ".join(f"WHEN {contains_sql(d, words)} THEN {sql_list(P.METRIC_NAMES[b])}" for b, words in P.METRIC_BRANCHES) + f" ELSE {sql_list(P.METRIC_NAMES['other'])} END"
    at = integer("figure.map", 1, "CASE WHEN stage = 'entry' THEN 3 ELSE 4 END")
    size = case("stage", {"entry": "1", "mid": "10", "senior": "100"}, "1")
    return f"[({names})[{at}] || '=' || ({integer('figure.a', 2, 9)} * {size}) || 'k+', ({names})[{at} + 1] || '=<' || {integer('figure.b', 1, 5)} || '%'] || CASE WHEN contains(lower({shape}), 'event') THEN ['events=1M+/day'] ELSE {NO_TEXT} END || CASE WHEN contains(lower({shape}), 'serverless') THEN ['autoscaling=0 to 1k in 1 min'] ELSE {NO_TEXT} END"


def _project(before: str, name: str, n: int) -> str:
    """The n-th project of the fold: seen and impacts are what earlier ones used, done the list so far."""
    t = f"chosen[{n}]"
    extra = case("stage", {k: sql_list(v) for k, v in G.EXTRA_IMPACTS.items()})
    shapes = f"list_filter({t}.architecture || CASE WHEN d_deployment_skills > {number(0.65)} THEN ['Event-Driven', 'Serverless'] ELSE {NO_TEXT} END, lambda x: true)"
    rest = "list_filter(rest, lambda x: NOT " + has_match("x", f"(seen || list_transform(own, lambda y: {sql_compact('y')}))") + ")"
    fields = ["coalesce(pname, '')", "target", "coalesce(pproblem, '')", "shape", "array_to_string(tech, '+')", case("stage", {k: sql_text(v) for k, v in G.COMPLEXITY.items()}), "array_to_string(signals, '+')", f"array_to_string(list_sort({figures('shape')}), '+')", "why"]
    row = " || '/' || ".join(fields)
    return (
        f"{name}a AS (SELECT *, {t}.name AS tname, {t}.skills AS tskills, list_filter({t}.skills, lambda x: {has_match('x', 'recent_compact')} AND NOT {has_match('x', 'seen')}) AS own, recent_stack || bundle AS raw_rest, {shapes} AS raw_shapes, {t}.outcomes || {shuffled(extra, 'extra')} AS raw_outcomes FROM {before}), "
        f"{name}b AS (SELECT *, list_filter(raw_rest, lambda x, i: list_position(raw_rest, x) = i) AS rest, {distinct('raw_shapes')} AS shapes, {distinct('raw_outcomes')} AS outcomes FROM {name}a), "
        f"{name}c AS (SELECT *, own || ({rest})[1:greatest(0, 4 - len(own))] AS raw_tech, tskills || bundle AS raw_other, list_filter(outcomes, lambda x: NOT list_contains(impacts, x)) AS fresh, coalesce({choice('shapes', 'shape', str(n - 1))}, 'Microservices') AS shape FROM {name}b), "
        f"{name}d AS (SELECT *, ({distinct('raw_tech')})[1:6] AS tech1, ({distinct('raw_other')})[1:4] AS tech2, ({shuffled(f'CASE WHEN len(fresh) > 0 THEN fresh ELSE {extra} END', 'impact')})[1:2] AS signals, {problem(t + '.problem', 'stage', 'problem')} AS pproblem FROM {name}c), "
        f"{name}e AS (SELECT *, CASE WHEN len(tech1) > 0 THEN tech1 ELSE tech2 END AS tech FROM {name}d), "
        + project_steps(f"{name}e", f"{name}f", "tname", "name", "pname")
        + f", {name} AS (SELECT * EXCLUDE (tname, tskills, own, raw_rest, raw_shapes, raw_outcomes, rest, shapes, outcomes, raw_tech, raw_other, fresh, shape, tech1, tech2, signals, pproblem, tech, pname) REPLACE "
        f"(CASE WHEN {t} IS NULL THEN done ELSE done || [{row}] END AS done, CASE WHEN {t} IS NULL THEN seen ELSE seen || list_transform(tech, lambda x: {sql_compact('x')}) END AS seen, CASE WHEN {t} IS NULL THEN impacts ELSE impacts || list_filter(signals, lambda x: NOT list_contains(impacts, x)) END AS impacts, "
        f"CASE WHEN {t} IS NULL THEN shown ELSE shown || [array_to_string(signals, '+')] END AS shown, CASE WHEN {t} IS NULL THEN parts ELSE parts || tech || signals || [shape] END AS parts, CASE WHEN {t} IS NULL THEN metrics ELSE metrics || [array_to_string(list_sort({figures('shape')}), '+')] END AS metrics) FROM {name}f)"
    )


def chain(skills: list[str], roles: list[str], attempts: int = 1) -> str:
    """WITH expressions up to `made`: a row for each job, preset and attempt with all that generation works out."""
    picks = [(1, 0), (3, 1), (7, 2), (9, 5)]
    wanted = "[" + ", ".join(sql_pick(skills, "c_custkey", t, p) for t, p in picks) + "]"
    rows = ", ".join(f"({sql_text(r)}, {lit(paths)}, {lit(support)}, {lit([dict(zip(('name', 'skills', 'problem', 'outcomes', 'architecture'), t, strict=True)) for t in temps])}, {', '.join(lit(x) for x in rest)})" for r, paths, support, temps, *rest in P.ROLES)
    names = list(G.DIALS["balanced"])
    dials = ", ".join(f"greatest({number(0)}, least({number(1)}, {case('preset', {p: number(v[n]) for p, v in G.DIALS.items()})} + {number(0.06)} * {normal('dial.' + n)})) AS d_{n}" for n in names)
    pools = case("jd_role", {r: sql_list(o) for r, o in P.MISMATCH.items()})
    seed = "list_filter(top4, lambda r: r.s < 0)"
    delivery = "list_filter(every_path, lambda p: p <> seed AND len(list_filter(p, lambda s: " + contains_sql(sql_normal("s"), M.DELIVERY) + ")) > 0)[1]"

    def path_step(before: str, name: str, i: int) -> str:
        left = "list_filter(every_path, lambda p: NOT list_contains(paths, p))"
        use = f"d_deployment_skills > {number(0.58)} AND delivery IS NOT NULL AND NOT list_contains(paths, delivery) AND {u('deliver', str(i))} < {number(0.8)}"
        following = f"CASE WHEN {use} THEN delivery ELSE {choice(f'({left})[1:3]', 'next', str(i))} END"
        return f"{name} AS (SELECT * REPLACE (CASE WHEN len(paths) >= many_paths OR len({left}) = 0 THEN paths ELSE paths || [{following}] END AS paths) FROM {before})"

    base, slope = (case("preset", {p: number(v[i]) for p, v in G.STAY.items()}) for i in (0, 1))
    other = lambda a: f"list_filter({a}, lambda d: {sql_normal('d')} <> {sql_normal('domain')})"
    prefs, back = "CASE WHEN len(p_domains) > 0 THEN p_domains ELSE " + sql_list(G.FALLBACK_DOMAINS) + " END", sql_list(G.FALLBACK_DOMAINS)
    others = f"CASE WHEN len({other(prefs)}) > 0 THEN {other(prefs)} ELSE {other(back)} END"
    w = sql_normal("education")
    tier = f"CASE WHEN {contains_sql(w, [*S.ELITE_WANTED, *S.MASTER_WANTED])} THEN 'tier_1' WHEN {contains_sql(w, S.BACHELOR_WANTED)} THEN 'tier_2' WHEN d_education_tier >= {number(0.8)} THEN 'tier_1' WHEN d_education_tier >= {number(0.4)} THEN 'tier_2' ELSE 'tier_3' END"
    schools = case("tier", {t: sql_list(sorted(n for k, n in P.COLLEGES if k == t)) for t in ("tier_1", "tier_2", "tier_3")})
    advanced = "list_filter(p_degrees, lambda d: " + contains_sql(sql_normal("d"), ["m.tech", "mca", "mba", "m.s", "ms", "m.sc"]) + ")"
    honour = f"len({advanced}) > 0 AND {contains_sql(w, S.MASTER_WANTED)} AND (NOT contains({w}, 'preferred') OR stage = 'senior' OR {u('honour')} < {number(0.65)})"
    title = lambda salt: f"coalesce({choice('p_titles', salt)}, 'Software Engineer')"
    keeps = f"role = jd_role AND preset <> 'mismatch' AND stage = 'senior' AND contains({sql_normal('job_title')}, 'senior')"
    job = lambda c, years, name, stack, focus: f"array_to_string([{c}.name, {c}.domain, target, printf('%.1f', {years}), {name}, array_to_string({stack}, '+'), array_to_string({focus}, '+')], '/')"
    hits = "len(list_filter(t.skills, lambda s: " + has_match("s", "bundle_compact") + "))"
    steps = [
        f"prof(role, paths, support, templates, domains, company_domains, degrees, themes, titles) AS (VALUES {rows})",
        f"base AS (SELECT c_custkey AS jd_id, {sql_pick(TITLES, 'c_custkey')} AS job_title, {sql_pick(roles, 'c_custkey')} AS jd_role, {wanted} AS raw_skills, {sql_pick(DOMAINS, 'c_custkey', 3)} AS domain, CAST(c_custkey % 9 AS INT) AS min_years, c_custkey % 6 = 0 AS manages, {sql_pick(WANTED, 'c_custkey', 5)} AS education FROM customer)",
        f"jd AS (SELECT *, list_filter(raw_skills, lambda x, i: list_position(raw_skills, x) = i) AS skills, jd_id || '|' || preset || '|' || attempt AS key FROM base, (SELECT unnest({sql_list(S.PRESETS)}) AS preset), (SELECT unnest(range(1, {attempts + 1})) AS attempt))",
        f"g1 AS (SELECT *, {dials} FROM jd)",
        f"g2 AS (SELECT *, (d_education_tier + d_skill_coverage) / 2 AS strength, CASE WHEN preset = 'mismatch' THEN coalesce({choice(pools, 'role')}, jd_role) ELSE jd_role END AS role FROM g1)",
        f"g3 AS (SELECT *, CASE WHEN preset = 'hard_negative' THEN coalesce({case('jd_role', {a: sql_text(b) for a, b in P.ADJACENT.items()})}, role) ELSE role END AS filler, {_band()} AS band FROM g2)",
        "g4 AS (SELECT g3.*, p.support AS p_support, p.paths AS p_paths, p.templates AS p_templates, p.domains AS p_domains, p.company_domains AS p_company_domains, p.degrees AS p_degrees, p.themes AS p_themes, p.titles AS p_titles, f.paths AS f_paths, f.support AS f_support, f.templates AS f_templates, "
        f"CASE WHEN min_years > 0 THEN min_years ELSE {case('band', {b: str(y) for b, y, _ in S.BANDS}, '0')} END AS need FROM g3 JOIN prof p ON g3.role = p.role JOIN prof f ON g3.filler = f.role)",
        f"g5 AS (SELECT *, {_experience()} AS years FROM g4)",
        f"g6 AS (SELECT *, {stage_of('years')} AS stage, manages OR band = 'principal' AS gm, {flat('p_paths')} || p_support || {flat('list_transform(p_templates, lambda t: t.skills)')} AS raw_catalogue, {flat('f_paths')} || {flat('list_transform(f_templates, lambda t: t.skills)')} || f_support AS raw_fill, list_transform(skills, lambda s: {sql_compact('s')}) AS jd_compact FROM g5)",
        f"g7 AS (SELECT *, {distinct('raw_catalogue')} AS catalogue, list_filter(raw_fill, lambda s: NOT {has_match('s', 'jd_compact')}) AS raw_spare FROM g6)",
        f"g8 AS (SELECT *, list_transform(skills, lambda s: list_filter(catalogue, lambda c: {sql_match(sql_compact('s'), sql_compact('c'))})[1]) AS raw_available, {distinct('raw_spare')} AS spare FROM g7)",
        f"g9 AS (SELECT *, {distinct('raw_available')} AS available FROM g8)",
        f"g10 AS (SELECT *, {subset('available', match_count('CAST(len(available) AS INT)', 'd_skill_coverage'), 'keep')} AS kept, CASE WHEN strength > {number(0.75)} THEN 10 WHEN strength > {number(0.45)} THEN 8 ELSE 6 END AS most1 FROM g9)",
        f"g11 AS (SELECT *, list_transform(kept, lambda s: {sql_compact('s')}) AS kept_compact, CASE WHEN preset = 'mismatch' THEN least(most1, 7) ELSE most1 END AS most FROM g10)",
        f"g12 AS (SELECT *, kept || ({shuffled('spare', 'fill')})[1:greatest(0, most - len(kept))] AS raw_bundle FROM g11)",
        f"g13 AS (SELECT *, {distinct('raw_bundle')} AS bundle1 FROM g12)",
        f"g14 AS (SELECT *, bundle1 || list_filter(skills, lambda s: len(list_filter(catalogue, lambda c: {sql_match(sql_compact('s'), sql_compact('c'))})) = 0) AS raw_bundle2 FROM g13)",
        f"g15 AS (SELECT *, (CASE WHEN len(bundle1) < 4 AND preset <> 'mismatch' THEN {distinct('raw_bundle2')} ELSE bundle1 END)[1:most] AS bundle FROM g14)",
        f"g16 AS (SELECT *, list_transform(bundle, lambda s: {sql_compact('s')}) AS bundle_compact, list_sort(list_transform(f_paths, lambda p, i: {{'s': -3 * len(list_filter(p, lambda s: {has_match('s', 'kept_compact')})), 'n': -len(p), 'u': {u('path', '(i - 1)')}, 'p': p}})) AS ranked FROM g15)",
        "g17 AS (SELECT *, ranked[1:4] AS top4, list_transform(ranked, lambda r: r.p) AS every_path FROM g16)",
        f"g18 AS (SELECT *, {choice(f'CASE WHEN len({seed}) > 0 THEN {seed} ELSE top4 END', 'seed')}.p AS seed, CASE WHEN preset = 'full_match' AND strength > {number(0.7)} OR preset = 'balanced' AND strength > {number(0.82)} THEN 3 WHEN preset IN ('balanced', 'full_match') OR strength > {number(0.58)} THEN 2 ELSE 1 END AS many_paths FROM g17)",
        f"g19 AS (SELECT *, {delivery} AS delivery, [seed] AS paths FROM g18)",
        path_step("g19", "g20", 1),
        path_step("g20", "g21", 2),
        f"g22 AS (SELECT *, CASE WHEN trim(domain) <> '' AND {u('stay')} < {base} + {slope} * d_domain_relevance THEN trim(domain) ELSE {choice(others, 'domain')} END AS target FROM g21)",
        "g23 AS (SELECT *, p_company_domains || [target] AS raw_preferred, CASE WHEN stage = 'senior' THEN 'mid' ELSE 'entry' END AS prior, strength * 0.88::DOUBLE AS weaker FROM g22)",
        f"g24 AS (SELECT *, {distinct('raw_preferred')} AS preferred FROM g23)",
        _company("g24", "h", "stage", "strength", None, "company", "company"),
        _company("h", "k", "prior", "weaker", "company.name", "previous", "previous"),
        f"g25 AS (SELECT *, years >= 5 AND stage IN ('mid', 'senior') AS two, {half_up(f'greatest({number(1.5)}, least(years - 1, years * ({number(0.45)} + {number(0.17)} * {u("recent")})))', 1)} AS recent1, {_focus('p_themes', 'kept[1]', 'stage', 'gm', 'd_deployment_skills', NO_TEXT, 'now')} AS raw_now FROM k)",
        f"g26 AS (SELECT *, CASE WHEN two THEN recent1 ELSE greatest({number(1)}, years) END AS recent, ({distinct('raw_now')})[1:3] AS now_focus, {flat('paths')} || bundle AS raw_stack, {flat('paths[1:1]')} || bundle[1:5] AS raw_stack2 FROM g25)",
        f"g27 AS (SELECT *, {_focus('p_themes', 'kept[1]', 'prior', "(gm AND prior <> 'entry')", f'greatest({number(0)}, d_deployment_skills - {number(0.1)})', 'now_focus', 'then')} AS raw_then, ({distinct('raw_stack')})[1:5] AS stack, ({distinct('raw_stack2')})[1:4] AS stack2 FROM g26)",
        f"g28 AS (SELECT *, ({distinct('raw_then')})[1:2] AS then_focus, CASE WHEN len(stack) > 0 THEN stack ELSE ['Python'] END AS recent_stack, {half_up(f'greatest({number(1)}, years - recent)', 1)} AS past_years FROM g27)",
        f"g29 AS (SELECT *, [{job('company', 'recent', f'CASE WHEN {keeps} THEN job_title ELSE {title("title")} END', 'recent_stack', 'now_focus')}] || CASE WHEN two THEN [{job('previous', 'past_years', title('title2'), "CASE WHEN len(stack2) > 0 THEN stack2 ELSE ['Python'] END", 'then_focus')}] ELSE {NO_TEXT} END AS experience, list_transform(recent_stack, lambda s: {sql_compact('s')}) AS recent_compact, {tier} AS tier FROM g28)",
        f"g30 AS (SELECT *, coalesce({choice(schools, 'school')}, 'Open University') AS institution, CASE WHEN {honour} THEN {choice(advanced, 'degree')} ELSE {choice('p_degrees', 'degree')} END AS degree, 2025 - greatest(1, CAST(round_even(years + CASE WHEN band = 'principal' THEN 2 WHEN stage IN ('mid', 'senior') THEN 1 ELSE 0 END, 0) AS INT)) AS graduation_year, "
        f"list_transform(list_sort(list_transform(p_templates, lambda t, i: {{'s': -{hits}, 'u': {u('template', '(i - 1)')}, 't': t}}))[1:CASE WHEN stage = 'senior' THEN 3 ELSE 2 END], lambda r: r.t) AS chosen, (CASE WHEN len(kept) > 0 THEN kept ELSE bundle END)[1:2] AS lead FROM g29)",
        f"g31 AS (SELECT *, 'Extends the ' || array_to_string(lead, ', ') || ' stack of the candidate''s experience.' || CASE WHEN gm THEN ' It also shows coordination.' ELSE '' END AS why, {NO_TEXT} AS seen, {NO_TEXT} AS impacts, {NO_TEXT} AS done, {NO_TEXT} AS shown, {NO_TEXT} AS parts, {NO_TEXT} AS metrics FROM g30)",
        _project("g31", "p1", 1),
        _project("p1", "p2", 2),
        _project("p2", "made", 3),
    ]
    return "WITH " + ", ".join(steps) + " "


def in_rounds(skills: list[str], roles: list[str], rounds: int) -> str:
    """WITH expressions up to `drawn`: companies of jobs whose id leaves 0, 1, ... by `rounds`, one round after
    another, each weighted by what the rounds before drew."""
    steps = []
    for n in range(rounds):
        earlier = " UNION ALL ".join(f"SELECT company.name AS name FROM u{i}b UNION ALL SELECT previous.name FROM u{i}b WHERE two" for i in range(n)) or "SELECT NULL AS name WHERE false"
        steps += [
            f"used{n} AS (SELECT name, count(*) AS n FROM ({earlier}) GROUP BY name)",
            f"r{n} AS (SELECT *, {n} AS round, years >= 5 AND stage IN ('mid', 'senior') AS two, coalesce((SELECT map_from_entries(list((name, n))) FROM used{n}), CAST(MAP {{}} AS MAP(VARCHAR, BIGINT))) AS used FROM g24 WHERE jd_id % {rounds} = {n})",
            _company(f"r{n}", f"u{n}a", "stage", "strength", None, "company", "company", "used"),
            _company(f"u{n}a", f"u{n}b", "prior", "weaker", "company.name", "previous", "previous", "used"),
        ]
    every = " UNION ALL ".join(f"SELECT jd_id, preset, round, company, previous FROM u{n}b" for n in range(rounds))
    return chain(skills, roles).rstrip() + ", " + ", ".join(steps) + f", drawn AS ({every}) "


def _education() -> str:
    w, d, i = sql_normal("education"), sql_normal("degree"), sql_normal("institution")
    base = f"CASE WHEN {contains_sql(w, S.MASTER_WANTED)} THEN CASE WHEN {contains_sql(d, S.MASTER_HELD)} THEN {number(1)} ELSE {number(0.45)} END WHEN {contains_sql(w, S.BACHELOR_WANTED)} THEN CASE WHEN {d} <> '' THEN {number(1)} ELSE {number(0.6)} END ELSE {number(0.5)} END"
    elite = f"CASE WHEN {contains_sql(i, S.ELITE_HELD)} THEN least({number(1)}, {base} + {number(0.1)}) ELSE least({base}, {number(0.55)}) END"
    return f"CASE WHEN {contains_sql(w, S.ELITE_WANTED)} THEN {elite} ELSE {base} END"


def scored(skills: list[str], roles: list[str], attempts: int = 1) -> str:
    """chain() and what scores its rows, up to `scored`."""
    w, near = sql_normal("domain"), " OR ".join(f"jd_role = {sql_text(a)} AND role = {sql_text(b)}" for a, b in P.ADJACENT.items())
    observed = f"list_filter(list_transform([target, company.domain] || CASE WHEN two THEN [previous.domain] ELSE {NO_TEXT} END || list_transform(done, lambda x: target), lambda o: {sql_normal('o')}), lambda o: o <> '')"
    worth = f"CASE WHEN contains(o, {w}) OR contains({w}, o) THEN {number(1)} WHEN len(list_intersect(string_split({w}, ' '), string_split(o, ' '))) >= 2 THEN {number(0.8)} END"
    over = "'Shows ' || printf('%.1f', total_years) || ' years' || CASE WHEN total_years > 5 THEN ' which may be overqualified for a fresher role' WHEN total_years > 2 THEN ', slightly above fresher expectations' ELSE ' which fits the fresher role expectation' END"
    curve = f"CASE WHEN total_years <= 2 THEN {number(1)} WHEN total_years <= 5 THEN greatest({number(0.5)}, {number(1)} - (total_years - {number(2)}) * {number(0.1)}) ELSE greatest({number(0.3)}, {number(0.7)} - (total_years - {number(5)}) * {number(0.08)}) END"
    second = "CASE WHEN len(stack2) > 0 THEN stack2 ELSE ['Python'] END"
    needed = f"list_filter(skills, lambda s: {contains_sql(sql_normal('s'), M.DEPLOYMENT)})"
    said = (
        "array_to_string(CASE WHEN len(skills) > 0 THEN ['Matches ' || len(matched) || '/' || len(skills) || ' JD skills' || CASE WHEN len(matched) > 0 THEN ' including ' || array_to_string(matched[1:3], ', ') ELSE '' END] ELSE " + NO_TEXT + " END || "
        f"[CASE WHEN need > 0 THEN 'Shows ' || printf('%.1f', total_years) || ' years against a ' || need || '-year target' ELSE {over} END, CASE WHEN role_alignment = 1.0 THEN 'Same role family' WHEN role_alignment >= 0.6 THEN 'Adjacent role family' ELSE 'Different role family' END, "
        "'Domain alignment ' || printf('%.2f', domain_alignment)] || CASE WHEN manages THEN [CASE WHEN management_alignment >= 0.8 THEN 'Management scope aligned' ELSE 'Limited management evidence' END] ELSE " + NO_TEXT + " END, '. ') || '.'"
    )
    steps = [
        f"s1 AS (SELECT *, bundle || recent_stack || now_focus || CASE WHEN two THEN {second} || then_focus ELSE {NO_TEXT} END || parts AS raw_inventory, {half_up(f'({number(0)} + recent + CASE WHEN two THEN past_years ELSE {number(0)} END)', 1)} AS total_years FROM made)",
        f"s2 AS (SELECT *, list_transform({distinct('raw_inventory')}, lambda x: {sql_compact('x')}) AS inv_compact FROM s1)",
        f"s3 AS (SELECT *, list_filter(skills, lambda s: {has_match('s', 'inv_compact')}) AS matched, {needed} AS needed FROM s2)",
        f"s4 AS (SELECT *, CASE WHEN len(skills) = 0 THEN {number(0.5)} ELSE CAST(len(matched) AS DOUBLE) / len(skills) END AS skill_coverage, CASE WHEN need > 0 THEN least({number(1)}, total_years / need) ELSE {curve} END AS experience_fit, "
        f"CASE WHEN jd_role = role THEN {number(1)} WHEN {near} THEN {number(0.6)} ELSE {number(0.2)} END AS role_alignment, CASE WHEN domain = '' THEN {number(0.5)} ELSE coalesce(list_filter(list_transform({observed}, lambda o: {worth}), lambda x: x IS NOT NULL)[1], {number(0.35)}) END AS domain_alignment, {_education()} AS education_fit, "
        f"CASE WHEN len(needed) = 0 THEN {number(0.5)} ELSE CAST(len(list_filter(needed, lambda s: {has_match('s', 'inv_compact')})) AS DOUBLE) / len(needed) END AS deployment_alignment, CASE WHEN manages THEN CASE WHEN gm THEN {number(1)} ELSE {number(0.45)} END ELSE CASE WHEN gm THEN {number(0.7)} ELSE {number(1)} END END AS management_alignment FROM s3)",
        "s5 AS (SELECT *, " + half_up("(" + " + ".join(f"{a} * {number(x)}" for a, x in S.WEIGHTS.items()) + ")", 3) + " AS overall FROM s4)",
        f"scored AS (SELECT *, {said} AS rationale FROM s5)",
    ]
    return chain(skills, roles, attempts).rstrip() + ", " + ", ".join(steps) + " "


#: Acceptance by preset.
ACCEPTED = "CASE preset WHEN 'full_match' THEN overall >= 0.72::DOUBLE WHEN 'balanced' THEN overall >= 0.5::DOUBLE AND overall <= 0.82::DOUBLE WHEN 'hard_negative' THEN overall >= 0.32::DOUBLE AND overall <= 0.72::DOUBLE AND experience_fit <= 0.85::DOUBLE ELSE overall <= 0.45::DOUBLE AND jd_role <> role END"
