"""Fuzzy matching of skills and domains.  Both sides stay in arrays of the row: nothing is exploded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import compact, normal

# Words of delivery paths and of deployment skills (each is searched as a substring).
DELIVERY = ["docker", "kubernetes", "terraform", "jenkins", "ci cd", "aws", "azure", "gcp", "gitops", "monitoring"]
DEPLOYMENT = ["aws", "azure", "gcp", "docker", "kubernetes", "terraform", "ci/cd", "jenkins", "helm", "gitops", "monitoring"]


def compact_match(a: Column, b: Column) -> Column:
    """Whether compacted texts are equal, or one of 4 characters or more is within the other."""
    near = ((F.length(a) >= 4) & b.contains(a)) | ((F.length(b) >= 4) & a.contains(b))
    return (a != "") & (b != "") & ((a == b) | near)


def skill_match(a: Column, b: Column) -> Column:
    return compact_match(compact(a), compact(b))


def distinct_in_order(items: Column) -> Column:
    """Items without null, empty and repeated ones, in their order."""
    return F.array_distinct(F.filter(items, lambda x: F.coalesce(x, F.lit("")) != ""))


def compacted(items: Column) -> Column:
    """Compact forms of an array: make them once a row, as nested lambdas would repeat the work."""
    return F.transform(items, compact)


def paired(items: Column) -> Column:
    """Items with their compact forms, (x, c): lambdas would work a form out anew at each use."""
    return F.transform(items, lambda x: F.struct(x.alias("x"), compact(x).alias("c")))


def matched(required: Column, observed_compact: Column) -> Column:
    """Required items that match an observed one, distinct and in order."""
    return matched_pairs(paired(required), observed_compact)


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once: lambdas have no common subexpressions."""
    return F.transform(F.array(value), body)[0]


def matched_pairs(pairs: Column, observed_compact: Column) -> Column:
    """The same of items that are paired with their compact forms already.

    All observed forms as one text, between bars, tell by one search whether an item equals one of them or is
    within one.  Observed forms that may be within an item are first sought in the text of all items, so that
    items are held against these few one by one, and not against all."""

    def hits(text: Column, near: Column) -> Column:
        equal = lambda c: text.contains(F.concat(F.lit("|"), c, F.lit("|")))
        within = lambda c: (F.length(c) >= 4) & text.contains(c)
        return F.filter(pairs, lambda r: (r["c"] != "") & (equal(r["c"]) | within(r["c"]) | F.exists(near, lambda o: r["c"].contains(o))))

    whole = F.concat(F.lit("|"), F.array_join(observed_compact, "|"), F.lit("|"))
    items = F.array_join(F.transform(pairs, lambda r: r["c"]), "|")
    few = let(items, lambda t: F.filter(observed_compact, lambda o: (F.length(o) >= 4) & t.contains(o)))
    return distinct_in_order(F.transform(let(whole, lambda t: let(few, lambda n: hits(t, n))), lambda r: r["x"]))


def joined(items_compact: Column) -> Column:
    """Compact forms as one text between bars, and those that may be within others: what known() searches.  Bind it
    with let(), so that it is made once a row."""
    return F.struct(F.concat(F.lit("|"), F.array_join(items_compact, "|"), F.lit("|")).alias("text"), F.filter(items_compact, lambda o: F.length(o) >= 4).alias("long"))


def known(c: Column, items: Column) -> Column:
    """Whether a compact form matches one of the joined() items: one search of a text tells whether it equals or is
    within one, and only the items that may be within it are held against it one by one."""
    return (c != "") & (items["text"].contains(F.concat(F.lit("|"), c, F.lit("|"))) | ((F.length(c) >= 4) & items["text"].contains(c)) | F.exists(items["long"], lambda o: c.contains(o)))


def unmatched(catalogue: Column, known_compact: Column) -> Column:
    """Catalogue items that match no known one."""
    return let(joined(known_compact), lambda k: F.transform(F.filter(paired(catalogue), lambda r: ~known(r["c"], k)), lambda r: r["x"]))


def first_match(skill: Column, catalogue: Column) -> Column:
    """First catalogue item that matches the skill, or null."""
    return let(paired(catalogue), lambda pairs: first_of_pairs(skill, pairs))


def first_of_pairs(skill: Column, pairs: Column) -> Column:
    """The same of a catalogue whose items are paired with their compact forms."""
    return let(compact(skill), lambda own: F.try_element_at(F.filter(pairs, lambda r: compact_match(own, r["c"])), F.lit(1))["x"])


def contains_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def is_delivery(path: Column) -> Column:
    return F.exists(path, lambda s: contains_any(normal(s), DELIVERY))


def domains_match(wanted: Column, observed: Column) -> Column:
    """Whether one domain is within the other or they share two words; an empty wanted one never matches."""
    return plain_domains_match(normal(wanted), normal(observed))


def plain_domains_match(w: Column, o: Column) -> Column:
    """The same of normalised domains."""
    shared = F.size(F.array_intersect(F.split(w, " "), F.split(o, " ")))
    return (w != "") & (o.contains(w) | w.contains(o) | (shared >= 2))


def path_score(path: Column, matched_compact: Column) -> Column:
    """3 for each item of the path that matches one of the matched skills."""
    return F.lit(3) * F.size(F.filter(compacted(path), lambda c: F.exists(matched_compact, lambda m: compact_match(c, m))))
