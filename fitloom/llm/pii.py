"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Everything is built-in column expressions on the row, so there is no shuffle and no Python.  One pass of a
pattern sets a mark around each match; the text split at the marks alternates between what lies outside and
matches, and sums of lengths give the places.  Sums go by blocks, and blocks of blocks, of the cube root of the
number of pieces, as arrays have no running sum.

Base spans (email, ip, card, phone: the patterns of BASE, leftmost, without overlap, each with its check) are
always kept; their score only tells.  MORE adds spans where the base left none of that kind: e-mail addresses
spelled with (at) and (dot), IPv6 addresses, cards within longer digit runs, phones that a following number spoils
or that lack a country code, IBANs with their country's length and mod-97, social security numbers.  Such a span
stays if its score, raised by near context words of its kind and lowered by words for other numbers, reaches LEAST.

Java's matcher recurses on repeated groups, and repeats scans that start inside a run.  So separators that a
repeated group would take are replaced by one mark first, which makes every loop one of single characters, and
patterns start where a run starts: texts of one endless run stay linear.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a separator, encloses a match, and fills what is taken; texts that hold them hold OTHER instead.
JOINT, MARK, TAKEN, OTHER = "\x01", "\x02", "\x03", "\x04"
#: Least score of an added span, what a context word adds or takes, and the characters looked at on each side.
LEAST, STEP, NEAR = 0.5, 0.3, 40
_SPAN = "array<struct<start:bigint,end:bigint,kind:string,score:double,base:boolean>>"

# Registered lengths of IBANs by country.
IBAN = {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}

_LOCAL, _LABEL = rf"A-Za-z0-9._%+{JOINT}-", "A-Za-z0-9-"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_WORD_START, _WORD_END = "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"
_OTHER_NUMBERS = ["order", "invoice", "isbn", "version", "serial", "item", "part", "sku", "tracking", "bestellung", "rechnung", "commande", "facture", "pedido", "factura"]


def _digits(value: Column) -> Column:
    return F.translate(value, f" ().+-{JOINT}", "")


def _characters(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: value.substr(i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right last digit by Luhn."""
    doubled = F.transform(_characters(F.reverse(digits)), lambda c, i: F.when(i % 2 == 0, c).otherwise(F.translate(c, "0123456789", "0246813579")).cast("int"))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether a string of digits and capitals, its first four moved to the end, leaves 1 by 97."""
    turned = F.concat(value.substr(F.lit(5), F.length(value)), value.substr(1, 4))
    return F.aggregate(_characters(turned), F.lit(0), lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)) == 1


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


def _always(value: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Rule:
    """pattern: of the text, after view; gate: a plain pattern that a text with a match has; valid and score: of a match."""

    pattern: str
    score: Callable[[Column], Column] | float
    gate: str
    valid: Callable[[Column], Column] = _always
    view: Callable[[Column], Column] = lambda text: text


def _joined(inside: str, separators: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_replace(text, f"(?<=[{inside}])[{separators}](?=[{inside}])", JOINT)


#: Gates start with one class of characters, which a matcher looks for fastest; texts without numbers pass few.
_NUMBER, _LETTERS = "[0-9][0-9 .()-]{5}", "[A-Z][A-Z][0-9][0-9]"
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : dots between label characters are joints in the view
    "email": Rule(rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_LABEL}]++{JOINT}[{_LABEL}{JOINT}]++", 0.9, "@", view=_joined(_LABEL, ".")),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": Rule(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, _NUMBER, lambda v: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
    # [0-9]([\x20-]?[0-9])+ of 13 characters or more : single separators between digits are joints
    "card": Rule(rf"(?<![0-9{JOINT}])[0-9][0-9{JOINT}]{{12,}}+", 0.7, _NUMBER, _card, view=_joined("0-9", " -")),
    "phone": Rule(r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, _NUMBER, lambda v: F.length(_digits(v)).between(9, 15)),
}
_AT, _DOT = r" ?[\[(] ?(?:at|AT) ?[\])] ?", r" ?[\[(] ?(?:dot|DOT) ?[\])] ?"
_PLUS_ONE = r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
_NATIONAL = r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
_IBAN = "|".join(f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}{_WORD_END}" for n, countries in IBAN.items())
MORE = {
    "email": Rule(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[{_LABEL}]{{1,63}}+(?:{_DOT}[{_LABEL}]{{1,63}}+){{1,4}}", 0.6, r"[\[(] ?(?:at|AT) ?[\])]"),
    "ip": Rule(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", 0.6, ":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"),
    "card": Rule(rf"(?<![0-9])[3-6][0-9]{{3}}(?:{JOINT}?[0-9]{{4}}){{3}}(?![0-9])", 0.5, _NUMBER, _card),
    "phone": Rule(f"{_PLUS_ONE}|{_NATIONAL}", lambda v: F.when(v.startswith("+"), 0.6).otherwise(0.3), _NUMBER),
    "iban": Rule(f"{_WORD_START}(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})", 0.8, _LETTERS, lambda v: mod97(F.translate(v, " ", ""))),
    "ssn": Rule(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])", 0.5, _NUMBER),
}
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
#: Lower-case words near a span that speak for its kind.
CONTEXT = {
    "email": ["mail", "e-mail", "email", "contact", "correo", "courriel"],
    "ip": ["ip", "ipv4", "ipv6", "host", "address", "server", "adresse"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "handy", "téléphone", "teléfono", "móvil"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social", "security"],
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is worked out once."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _blocks(values: Column, step: Column) -> Column:
    """Sums of each `step` values."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(values) / step).cast("int")), lambda b: _total(F.slice(values, b * step + 1, step)))


def _has(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike(rf"(?<![\p{{L}}])(?:{'|'.join(words)})(?![\p{{L}}])")


def _near(pieces: Column, k: Column) -> Column:
    """Text on both sides of piece k, an odd one, without the piece."""
    left = F.concat(F.when(k > 2, F.substring(F.get(pieces, k - 3), -NEAR, NEAR)).otherwise(""), F.when(k > 2, F.substring(F.get(pieces, k - 2), -NEAR, NEAR)).otherwise(""), F.substring(F.get(pieces, k - 1), -NEAR, NEAR))
    return F.concat(F.substring(left, -NEAR, NEAR), F.lit(MARK), F.substring(F.get(pieces, k + 1), 1, NEAR))


def _spans(pieces: Column, kind: str, rule: Rule, base: bool) -> Column:
    """Spans of the pieces that a pattern cut; matches are the odd ones."""

    def places(lengths: Column) -> Column:
        return _let(F.ceil(F.cbrt(F.size(lengths))).cast("int"), lambda step: _let(_blocks(lengths, step), lambda sums: _let(_blocks(sums, step), lambda tops: F.transform(F.sequence(F.lit(1), F.size(lengths) - 2, F.lit(2)), lambda k: span(k, lengths, sums, tops, step)))))

    def span(k: Column, lengths: Column, sums: Column, tops: Column, step: Column) -> Column:
        block, top = F.floor(k / step).cast("int"), F.floor(k / (step * step)).cast("int")
        start = _total(F.slice(tops, 1, top)) + _total(F.slice(sums, top * step + 1, block - top * step)) + _total(F.slice(lengths, block * step + 1, k - block * step))
        value = F.get(pieces, k)
        score = rule.score(value) if callable(rule.score) else F.lit(rule.score)
        steps = _let(_near(pieces, k), lambda near: _has(near, CONTEXT[kind]).cast("int") - _has(near, _OTHER_NUMBERS).cast("int"))
        score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score + steps * STEP)), 2)
        made = _let(start, lambda at: F.struct(at.alias("start"), (at + F.get(lengths, k)).alias("end"), F.lit(kind).alias("kind"), score.alias("score"), F.lit(base).alias("base")))
        return F.when(rule.valid(value), made)

    found = _let(F.transform(pieces, lambda x: F.length(x).cast("bigint")), places)
    kept = F.filter(found, lambda s: s.isNotNull() if base else s["score"] >= LEAST)
    return F.when(F.size(pieces) > 1, kept).otherwise(F.array()).cast(_SPAN)


def _cut(text: Column, rule: Rule) -> Column:
    return F.split(F.regexp_replace(text, rule.pattern, f"{MARK}$0{MARK}"), MARK)


def _more(text: Column, kind: str) -> Column:
    return _let(_cut(text, MORE[kind]), lambda p: _spans(p, kind, MORE[kind], False))


def _base(text: Column, kind: str) -> Column:
    """Spans of BASE and, in what they leave, of MORE."""
    rule = BASE[kind]

    def both(pieces: Column) -> Column:
        blanked = F.transform(pieces, lambda x, k: F.when((k % 2 == 1) & rule.valid(x), F.repeat(F.lit(TAKEN), F.length(x))).otherwise(x))
        return F.array_sort(F.concat(_spans(pieces, kind, rule, True), _more(F.array_join(blanked, ""), kind)))

    return _let(_cut(rule.view(text), rule), both)


def _of_kind(text: Column, kind: str, gates: dict[str, Column]) -> Column:
    """All spans of a kind, in order; texts that no gate lets pass have none."""
    more = F.when(gates[MORE[kind].gate], _more(text, kind)).otherwise(F.array().cast(_SPAN))
    if kind not in BASE:
        return more
    found = F.when(gates[BASE[kind].gate], _base(text, kind))
    return found.otherwise(F.array().cast(_SPAN) if BASE[kind].gate == MORE[kind].gate else more)


def find(docs: DataFrame) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans) and pii, an array of (start, end, kind, score, base)
    by kind in the order of KINDS, then start; columns of docs of these names are replaced.

    start and end count code points, the end exclusive.  A null or empty text has no spans.  Spans of different
    kinds may overlap, those of one kind don't.  Rows are judged alone, so ids may be null or repeat."""
    text = F.coalesce(F.col("text"), F.lit(""))
    odd = F.contains(text, F.lit(JOINT)) | F.contains(text, F.lit(MARK)) | F.contains(text, F.lit(TAKEN))
    clean = F.when(odd, F.translate(text, JOINT + MARK + TAKEN, OTHER * 3)).otherwise(text)
    out = docs.select(*(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(docs.columns)), clean.alias("__clean"))
    patterns = list(dict.fromkeys(r.gate for r in (*BASE.values(), *MORE.values())))
    gates = {p: F.col(f"__gate{i}") for i, p in enumerate(patterns)}
    out = out.select("*", *(F.col("__clean").rlike(p).alias(f"__gate{i}") for i, p in enumerate(patterns)))
    out = out.select("*", *(_of_kind(F.col("__clean"), k, gates).alias(f"__{k}") for k in KINDS))
    base = {f"n_{k}": F.size(F.filter(f"__{k}", lambda s: s["base"])).cast("long") for k in BASE}
    extra = base | {"pii": F.concat(*(F.col(f"__{k}") for k in KINDS))}
    return out.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns) if c not in extra), *(v.alias(k) for k, v in extra.items()))


def listed(spans: Column) -> Column:
    """'kind:start:end' of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(found: DataFrame) -> DataFrame:
    """The result of find() with each span of text replaced by its kind in angle brackets; of spans that overlap,
    that which starts first, then the longest, covers the others."""
    order = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    seed = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    take = lambda a, s: F.when(s["start"] >= a["at"], F.struct((-s["end"]).alias("at"), F.concat(a["out"], F.array(F.col("text").substr(a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))).otherwise(a)
    join = lambda a: F.concat(F.array_join(a["out"], ""), F.col("text").substr(a["at"] + 1, F.lit(2**31 - 1)))
    return found.withColumn("text", F.when(F.size("pii") > 0, F.aggregate(order, seed, take, join)).otherwise(F.col("text")))
