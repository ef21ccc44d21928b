"""Personal data in texts: patterns propose, checksums confirm, context scores.

Only Spark expressions, and one projection: no shuffle and no Python.  Spark
gives a pattern's matches but not where they are, so positions are running
sums of the lengths of the matches and of the text between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The quantifiers are possessive and the starts guarded, so that a long run of
# one character costs one pass; the matches are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
BASE = ("email", "ip", "card", "phone")
# A cheap condition that every text with a match of the kind meets.
LIKELY = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": r"(?i)mail|contact|write to|kontakt|courriel|correo",
    "ip": r"(?i)\bip\b|address|host|server|adresse",
    "card": r"(?i)card|visa|master|credit|debit|karte|carte|tarjeta",
    "phone": r"(?i)phone|call|tel|mobile|fax|anruf|appel|llam",
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
    "ssn": r"(?i)ssn|social security|sozialversicherung",
}
CONTEXT_CHARS = 40
#: The fewest characters that a match of the kind can have.
LEAST_CHARS = {"email": 5, "ip": 7, "card": 12, "phone": 4, "iban": 12, "ssn": 11}
CONTEXT_BONUS = 0.2
LEAST_SCORE = 0.5
SPAN = "struct<start:int,end:int,rank:int,kind:string,value:string,score:double>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn checksum of 0."""
    def step(total, i):
        v = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(v > 4, v * 2 - 9).otherwise(v * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Remainder by 97 of an IBAN without spaces: first four characters last,
    letters as 10 to 35."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(rest, i):
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return (F.length(_digits(value)) <= 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        code = F.replace(value, F.lit(" "), F.lit(""))
        return F.length(code).between(15, 34) & (mod97(code) == 1)
    return F.lit(True)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, also where lambdas in
    the body use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(numbers: Column) -> Column:
    """The sum of an array of integers up to each place, by doubling steps: a
    step adds to each sum the one 1, 2, 4, ... places before it."""
    def step(sums, reach):
        added = F.transform(sums, lambda v, i: v + F.when(i >= reach, F.element_at(sums, F.greatest(i - reach + 1, F.lit(1)))).otherwise(0))
        return F.when(F.size(sums) > reach, added).otherwise(sums)

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"))
    return F.aggregate(F.transform(steps, lambda k: F.pow(F.lit(2), k).cast("int")), numbers, step)


def _spans(kind: str, text: Column, matches: Column) -> Column:
    """The kind's confirmed matches as an array of SPAN.

    Work grows with the text and n log n of the matches: the text is split
    once, positions are running sums of lengths, and the characters before a
    match are put together from the last pieces before it."""
    rank = list(PATTERNS).index(kind)
    # So many matches of the kind, with the text between them, hold the context.
    reach = -(-CONTEXT_CHARS // LEAST_CHARS[kind])

    def tail(value):
        return F.right(value, F.lit(CONTEXT_CHARS))

    # piece: the end of the match before and of the text between the two
    pieces = F.transform(
        F.arrays_zip(F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("value"),
                     F.concat(F.array(F.lit("")), matches).alias("last")),
        lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["value"]).alias("size"), m["value"].alias("value"),
                           F.concat(tail(m["last"]), tail(m["gap"])).alias("piece")))

    def placed(rows):
        def with_ends(ends):
            def one(m, i):
                end = F.element_at(ends, i + 1)
                lo = F.greatest(i + 1 - reach, F.lit(1))
                near = tail(F.array_join(F.transform(F.slice(rows, lo, i + 2 - lo), lambda r: r["piece"]), ""))
                score = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
                return F.when(_valid(kind, m["value"]), F.struct(
                    (end - m["size"]).alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                    m["value"].alias("value"), F.round(score, 2).alias("score")))

            return F.filter(F.transform(rows, one), lambda s: s.isNotNull())

        return _bound(running_sums(F.transform(rows, lambda m: m["gap"] + m["size"])), with_ends)

    # arrays_zip is as long as the longest, "last", by one row without a value.
    found = _bound(F.slice(pieces, F.lit(1), F.size(matches)), placed)
    if kind not in BASE:
        found = F.filter(found, lambda s: s["score"] >= LEAST_SCORE)
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def detect_pii(df: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``df`` with a column ``out``: the personal data of each text, sorted by
    start and then kind, as an array of SPAN.

    Positions are code points, end exclusive.  Per kind, matches are leftmost
    and do not overlap; those that fail their check are dropped without a
    retry: parts of an ip at most 255, cards of 12 to 19 digits with a Luhn
    checksum, phones of 9 to 15 digits, IBANs of 15 to 34 characters with a
    remainder of 1 by 97.  email, ip, card and phone stay at any score; an
    IBAN or SSN stays with a score of 0.5 or more, which a word of its kind in
    the 40 characters before it raises by 0.2.  A null or empty text has an
    empty array.  A column named ``out`` is replaced; all others stay.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    temp = {kind: f"__pii_{kind}" for kind in PATTERNS}
    held = df.withColumn("__pii_text", text)
    source = F.col("__pii_text")
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
        if kind in LIKELY:
            found = F.when(F.contains(source, F.lit(LIKELY[kind])), found).otherwise(F.array().cast("array<string>"))
        held = held.withColumn(temp[kind], found)
    every = F.concat(*(_spans(kind, source, F.col(temp[kind])) for kind in PATTERNS))
    return held.withColumn(out, F.array_sort(F.transform(every, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "rank", "end", "kind", "value", "score")))))) \
               .drop("__pii_text", *temp.values())


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
