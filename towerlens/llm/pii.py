"""Personal data by patterns, checksums and context, in built-in functions only.

Regular expressions propose spans; validators (Luhn, mod-97, number ranges)
confirm them; words near a candidate raise its score. What a plain pattern
accepts with its validator is a base span and always kept; candidates of the
wider patterns are kept from ``ACCEPT`` on, which needs a checksum or context.

Plan: one narrow scan with no shuffle. A text that cannot hold a kind (no "@",
no digit) skips its pattern. Patterns use possessive runs and anchors at run
starts, so matching is linear in the text and does not recurse. Positions are
running sums over the gaps between matches, folded in blocks of ``BLOCK``, so a
text with very many hits stays near linear too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCEPT = 0.5
BLOCK = 256
#: Code points before and after a candidate that count as its context.
CONTEXT = 40

_LOCAL = "A-Za-z0-9._%+-"
#: Kind: (pattern, what a text must hold). Each finds the same leftmost matches as its plain form.
PATTERNS = {
    "email": (rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None),
    # Whole runs of digits with single separators; the plain form finds just these runs, of any length.
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "local": (r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])", None),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None),
}
#: Score of a candidate that its validator accepts, and the words that add ``NEAR`` to it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "short_card": 0.4, "phone": 0.7, "local": 0.3, "iban": 0.9, "ssn": 0.3}
NEAR = 0.3
WORDS = {
    "email": "e-?mail|mail|contact|write",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|contact",
    "iban": "iban|bank|account|konto|cuenta|compte",
    "ssn": "ssn|social|security",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(i: Column) -> Column:
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number (spaces ignored) leaves 1 modulo 97, its first four characters moved to the end."""
    s = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _byte_parts(text: Column) -> Column:
    """Every dotted part is at most 255, whatever its zeros in front."""
    short = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _ssn_range(text: Column) -> Column:
    area, serial = F.substr(text, F.lit(1), F.lit(3)), F.substr(text, F.lit(8), F.lit(4))
    return ~area.isin("000", "666") & (area < "900") & (F.substr(text, F.lit(5), F.lit(2)) != "00") & (serial != "0000")


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return _byte_parts(text)
    if kind == "card":
        return luhn(_digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    if kind == "iban":
        return F.length(F.replace(text, F.lit(" "), F.lit(""))).between(15, 34) & mod97(text)
    if kind == "ssn":
        return _ssn_range(text)
    return F.lit(True)


def _near(kind: str, span: Column) -> Column:
    words = rf"(?i)(?<![a-z])(?:{WORDS['phone' if kind == 'local' else kind]})(?![a-z])"
    return span["before"].rlike(words) | span["after"].rlike(words)


def _scored(kind: str, span: Column) -> Column:
    """struct(start, end, score, base) of a located match."""
    base, score = F.lit(kind in ("email", "ip", "phone")), F.lit(SCORES[kind])
    if kind == "card":
        base = F.length(_digits(span["match"])) >= 16
        score = F.when(base, score).otherwise(F.lit(SCORES["short_card"]))
    if kind == "local":  # the inner part of a number that starts with "+" is no second number
        score = F.when(span["before"].rlike(r"\+[0-9][\x20().0-9-]*$"), F.lit(0.0)).otherwise(score)
    score = F.least(F.lit(1.0), F.round(score + F.when(_near(kind, span), F.lit(NEAR)).otherwise(F.lit(0.0)), 2))
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), score.alias("score"), base.alias("base"))


def _matches(pieces: Column, found: Column) -> Column:
    """Per match: the code points before it since the last one, itself, and its surroundings."""
    return F.transform(found, lambda m, i: F.struct(
        F.length(F.get(pieces, i)).cast("long").alias("gap"), m.alias("match"),
        F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("after")))


_LOCATED = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def _width(m: Column) -> Column:
    return m["gap"] + F.length(m["match"])


def _locate(blocks: Column, offsets: Column) -> Column:
    """Start and end of every match: each block is folded from its own offset."""
    def fold(block: Column, offset: Column) -> Column:
        def step(acc: Column, m: Column) -> Column:
            start = acc["at"] + m["gap"]
            end = start + F.length(m["match"])
            span = F.struct(start.alias("start"), end.alias("end"), m["match"].alias("match"), m["before"].alias("before"), m["after"].alias("after"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))
        first = F.struct(offset.alias("at"), F.array().cast(_LOCATED).alias("spans"))
        return F.aggregate(block, first, step, lambda acc: acc["spans"])
    return F.flatten(F.zip_with(blocks, offsets, fold))


def _blocks(matches: Column) -> Column:
    count = F.ceil(F.size(matches) / F.lit(BLOCK)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(matches, b * BLOCK + 1, F.lit(BLOCK)))


def _offsets(blocks: Column) -> Column:
    """Code points before each block."""
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, m: s + _width(m)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(sums, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                       lambda acc: acc["out"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and a column per kind (email, ip, card, phone, iban, ssn): an array of struct(start, end, score, base), by
    start; positions are code points, end exclusive. "phone" also holds local numbers, "card" also shorter ones.

    Null text is empty and has no spans; empty arrays stand for none. Repeated rows and null doc_ids are reported as
    they come; an empty table gives an empty result. Other columns are not read.
    """
    at = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    at = at.select("*", F.col("text").rlike("[0-9]").alias("has_digit"))
    split = []
    for kind, (pattern, sign) in PATTERNS.items():
        may = F.col("text").contains(sign) if sign else F.col("has_digit")
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        split.append(F.when(may, found).alias(f"{kind}_found"))
    at = at.select("doc_id", "text", *split)

    def hit(kind: str) -> Column:
        return F.size(f"{kind}_found") > 0

    # Each step is a projection of its own, so no regular expression runs twice.
    at = at.select("doc_id", *[F.when(hit(k), _matches(F.split("text", p, -1), F.col(f"{k}_found"))).alias(k) for k, (p, _) in PATTERNS.items()])
    at = at.select("doc_id", *[F.when(F.col(k).isNotNull(), _blocks(F.col(k))).alias(k) for k in PATTERNS])
    at = at.select("doc_id", *[c for k in PATTERNS for c in (F.col(k), F.when(F.col(k).isNotNull(), _offsets(F.col(k))).alias(f"{k}_offsets"))])
    at = at.select("doc_id", *[F.when(F.col(k).isNotNull(), _locate(F.col(k), F.col(f"{k}_offsets"))).alias(k) for k in PATTERNS])

    def kept(kind: str) -> Column:
        valid = F.filter(F.col(kind), lambda s: _valid(kind, s["match"]))
        scored = F.filter(F.transform(valid, lambda s: _scored(kind, s)), lambda s: s["base"] | (s["score"] >= ACCEPT))
        return F.coalesce(scored, F.array().cast("array<struct<start:bigint,end:bigint,score:double,base:boolean>>")).alias(kind)
    at = at.select("doc_id", *[kept(k) for k in PATTERNS])
    return at.select("doc_id", "email", "ip", "card", F.array_sort(F.concat("phone", "local")).alias("phone"), "iban", "ssn")


KINDS = ("email", "ip", "card", "phone", "iban", "ssn")


def joined_spans(base_only: bool) -> Column:
    """kind:start:end of every kind in turn, by start, comma-joined."""
    def of(kind: str) -> Column:
        spans = F.filter(F.col(kind), lambda s: s["base"]) if base_only else F.col(kind)
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))
    return F.array_join(F.concat(*[of(k) for k in KINDS]), ",")


def base_count(kind: str) -> Column:
    return F.size(F.filter(F.col(kind), lambda s: s["base"])).cast("long")
