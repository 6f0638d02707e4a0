"""Personal data in texts, by DataFrame functions only.

Regular expressions propose spans; validators confirm them (Luhn for cards, mod 97 for account numbers, number ranges
for addresses, digit counts for phones); words nearby raise or lower the score. Proposals of the base kinds that pass
their validator always count. The added kinds count from a score of ``ACCEPT`` on: account numbers (``iban``), and
social security numbers (``ssn``), which have no checksum and need a word nearby that speaks for them, and card numbers
in their issuers' own lengths and groups (``pan``), which the base kind loses when digits stand beside them: two cards
with a space between are one match of too many digits to it. Where a base card was found, ``pan`` adds nothing.

Matches are the leftmost, longest and not overlapping within a kind. Starts and ends count code points, the end is
exclusive. A failed match is dropped and not tried again from a later place. Null text is empty and has no spans.
Words count as near by their distance in the text alone, other matches between them or not; in ``redact`` the text is
what the kinds before have left.

Account numbers have the length that their country gives them, so a capitalised word, digits or another number after
one are no part of it. Under a country code that is not listed, a number is a whole word of 15 to 34 characters, or else
the longest run of them in groups.

The base patterns are written with possessive repeats, and tried only where a run begins, which changes no match but
keeps the work linear and the stack flat on very long texts; the added ones repeat a bounded number of times. Where a match lies follows from the pieces between matches, so
each kind costs one pass over a text without matches and two over one with some.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score from which spans of the added kinds count.
ACCEPT = 0.5
#: Characters before and after a span in which words count as near.
BEFORE, AFTER = 48, 24

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    near: str
    base: bool = True


# Characters of an account number by country, those in the register and those in use without being there.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Each listed country's code with as many characters as its numbers have; other codes as whole words or runs."""
    listed = "|".join(codes.replace(" ", "|") for codes in IBAN_LENGTHS.values())
    exact = (rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
    run = rf"(?:(?!\x20(?:{listed})[0-9]{{2}})\x20?[A-Z0-9]){{11,30}}"  # not into a number that begins after a space
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}(?![A-Za-z0-9])|{run})"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(exact)}|{other})(?![A-Za-z0-9])"


# What the kinds look like, and words that speak for them.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        "mail|contact|write",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", 0.7, "card|visa|credit|payment|paid"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|call|tel|mobile|fax|reach"),
    Kind("iban", _iban(), 0.8, "iban|account|bank", False),
    Kind(
        "pan",
        r"(?<![0-9])(?:[3-6][0-9]{3}(?:[0-9]{12}|\x20[0-9]{4}\x20[0-9]{4}\x20[0-9]{4}|-[0-9]{4}-[0-9]{4}-[0-9]{4})"
        r"|3[47][0-9]{2}(?:[0-9]{11}|\x20[0-9]{6}\x20[0-9]{5}|-[0-9]{6}-[0-9]{5}))(?![0-9])",
        0.7,
        "card|visa|credit|payment|paid",
        False,
    ),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social|security", False),
)
AGAINST = "version|isbn|release|order|sample|example"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number without spaces leaves 1 when divided by 97, its first four characters last."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        value = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(value >= 65, rest * 100 + value - 55).otherwise(rest * 10 + value - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def valid(kind: str, match: Column) -> Column:
    """Whether a proposed span is one."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "pan":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        code = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(F.lit(False))
    return F.lit(True)


def score(kind: Kind, near: Column) -> Column:
    """The kind's prior, raised by words nearby that speak for it and lowered by those against."""
    up = F.when(near.rlike(rf"(?i)\b(?:{kind.near})"), 0.3).otherwise(0.0)
    down = F.when(near.rlike(rf"(?i)\b(?:{AGAINST})\b"), 0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(kind.prior) + up - down))


def _rows(pieces: Column, matches: Column) -> Column:
    """Every match with the pieces of text before and after it."""
    n = F.size(matches)
    return F.arrays_zip(
        F.slice(pieces, F.lit(1), n).alias("before"), matches.alias("match"), F.slice(pieces, F.lit(2), n).alias("after")
    )


def _edges(pieces: Column, matches: Column) -> Column:
    """For every match, the last characters of the text up to its end and the first ones from its start on, as far as
    the pieces beside it reach."""
    return F.transform(
        _rows(pieces, matches),
        lambda r: F.struct(
            F.right(F.concat(r["before"], r["match"]), F.lit(BEFORE)).alias("tail"),
            F.left(F.concat(r["match"], r["after"]), F.lit(AFTER)).alias("head"),
        ),
    )


def _with_near(pieces: Column, matches: Column, edges: Column) -> Column:
    """The rows with the text near each match, whatever other matches lie in it.

    No match is empty, so as many edges as characters reach far enough. ``edges`` must be a column made before.
    """

    def put(row: Column, i: Column) -> Column:
        first = F.greatest(i - BEFORE, F.lit(0))
        tails = F.array_join(F.slice(edges, first + 1, i - first).getField("tail"), "")
        heads = F.array_join(F.slice(edges, i + 2, F.lit(AFTER)).getField("head"), "")
        before = F.right(F.concat(tails, row["before"]), F.lit(BEFORE))
        after = F.left(F.concat(row["after"], heads), F.lit(AFTER))
        return F.struct(row["before"].alias("before"), row["match"].alias("match"), F.concat_ws(" ", before, after).alias("near"))

    return F.transform(_rows(pieces, matches), put)


def _found(kind: Kind, rank: int, rows: Column) -> Column:
    """Spans of one kind, from its matches with the text before and near them."""
    empty = F.array().cast(_SPAN)

    def add(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["before"])
        end = start + F.length(row["match"])
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("end"),
            F.lit(kind.name).alias("kind"),
            score(kind, row["near"]).alias("score"),
        )
        more = F.concat(state["spans"], F.array(span).cast(_SPAN))
        spans = F.when(valid(kind.name, row["match"]), more).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    spans = F.aggregate(rows, start, add, lambda state: state["spans"])
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= ACCEPT)
    return F.coalesce(spans, empty)


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """doc_id, text and the spans of each document, by start and then by kind in the order listed."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("*", *(F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)).alias(f"m_{k.name}") for k in kinds))
    met = {k.name: F.size(f"m_{k.name}") > 0 for k in kinds}
    rows = rows.select("*", *(F.when(met[k.name], F.split("text", k.pattern, -1)).alias(f"p_{k.name}") for k in kinds))
    parts = {k.name: (F.col(f"p_{k.name}"), F.col(f"m_{k.name}")) for k in kinds}
    rows = rows.select("*", *(F.when(met[k.name], _edges(*parts[k.name])).alias(f"e_{k.name}") for k in kinds))
    near = {k.name: F.when(met[k.name], _with_near(*parts[k.name], F.col(f"e_{k.name}"))) for k in kinds}
    spans = [_found(k, i, near[k.name]) for i, k in enumerate(kinds)]
    of = {k.name: s for k, s in zip(kinds, spans, strict=True)}
    if {"pan", "card"} <= of.keys():  # a card of both kinds is one of the base kind
        rows = rows.select("doc_id", "text", *(s.alias(f"s_{n}") for n, s in of.items()))
        of = {n: F.col(f"s_{n}") for n in of}
        starts = F.transform("s_card", lambda s: s["start"])
        of["pan"] = F.filter("s_pan", lambda s: ~F.array_contains(starts, s["start"]))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*of.values())).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _equals(name: str) -> Callable[[Column], Column]:
    return lambda c: c == name


def _replaced(kind: Kind) -> Callable[[Column], Column]:
    """What stands before a match, and the match or, if it is a span, its kind."""

    def put(row: Column) -> Column:
        ok = valid(kind.name, row["match"])
        if not kind.base:
            ok = ok & (score(kind, row["near"]) >= ACCEPT)
        return F.concat(row["before"], F.when(ok, f"[{kind.name.upper()}]").otherwise(row["match"]))

    return put


def digests(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans."""
    base = [k.name for k in KINDS if k.base]
    counts = [
        F.size(F.filter(F.transform("spans", lambda s: s["kind"]), _equals(name))).cast("long").alias(f"n_{name}")
        for name in base
    ]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *counts, F.sha2(_listed(own), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


def redact(
    docs: DataFrame, text: str = "text", kinds: tuple[str, ...] = ("email", "phone", "card", "pan", "iban", "ip", "ssn")
) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, kind after kind; null stays null.

    A column ``n_chars`` follows the new text. All other columns and rows stay. No shuffle.
    """
    names, known = docs.columns, {k.name: k for k in KINDS}
    taken = {n.lower() for n in names}
    hidden = [next(f"{p}{'_' * i}" for i in range(99) if f"{p}{'_' * i}" not in taken) for p in ("pii_text", "pii_found", "pii_parts", "pii_edges")]
    now, found, parts, edges = hidden
    rows = docs.withColumn(now, F.col(text))
    for name in kinds:
        kind = known[name]
        rows = rows.withColumn(found, F.regexp_extract_all(now, F.lit(kind.pattern), F.lit(0)))
        rows = rows.withColumn(parts, F.when(F.size(found) > 0, F.split(now, kind.pattern, -1)))
        n, pieces, matches = F.size(found), F.col(parts), F.col(found)
        if kind.base:  # counts whatever stands near
            triple = _rows(pieces, matches)
        else:
            rows = rows.withColumn(edges, F.when(n > 0, _edges(pieces, matches)))
            triple = _with_near(pieces, matches, F.col(edges))
        new = F.concat(F.array_join(F.transform(triple, _replaced(kind)), ""), F.element_at(parts, -1))
        rows = rows.withColumn(now, F.when(n > 0, new).otherwise(F.col(now)))
    rows = rows.withColumn(text, F.col(now))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return rows.select(names)
