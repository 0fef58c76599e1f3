"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

All of it is column expressions.  Positions of matches come from splitting the
text at the pattern: a match starts after the pieces and matches before it.
Patterns are written so that each finds just the leftmost, non-overlapping
matches of its plain form while never trying one run of characters twice, so a
very long text takes time in proportion to its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty

#: Characters before a span that are searched for context words.
NEAR = 48
RAISE = 0.25


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: a cheap test of the text, the pattern, and how spans are scored."""

    name: str
    hint: str
    pattern: str
    base: float
    context: str


# The plain forms are
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
# A card is a whole run of digits with single separators, so its length is
# asked for in the pattern; an IBAN is two letters, two digits, 11 to 30 more.
KINDS = (
    Kind("email", "@",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.7, r"(?i)\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b"),
    Kind("ip", r"[0-9]\.[0-9]",
         r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         0.5, r"(?i)\b(?:ip|host|server|address|adresse|login)\b"),
    Kind("card", r"[0-9][ -]?[0-9]",
         r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
         0.7, r"(?i)\b(?:card|credit|visa|mastercard|amex|karte|carte|tarjeta)\b"),
    Kind("phone", r"\+[0-9]",
         r"\+[0-9][\x20().0-9-]+[0-9]",
         0.6, r"(?i)\b(?:phone|call|tel|mobile|fax|telefon|appeler|llamar)\b"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}",
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
         0.8, r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b"),
)
BASE = ("email", "ip", "card", "phone")

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.split(F.reverse(value), "")
    total = F.aggregate(
        F.transform(figures, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an IBAN without spaces passes its checksum: 1 modulo 97, letters as 10 to 35."""
    turned = F.concat(F.substring(value, 5, 64), F.substring(value, 1, 4))
    number = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: ((a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + number(c)) % 97).cast("int"))
    return rest == 1


def confirmed(kind: str, value: Column) -> Column:
    """Whether a proposed span passes its kind's check."""
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(value, F.lit(" "), F.lit("")))
    return F.lit(True)


def _proposed(text: Column, kind: Kind) -> Column:
    """All matches as array<struct<start,value>>, starts in code points from 0."""
    shape = "array<struct<start:int,value:string>>"
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    both = F.arrays_zip(found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("spans"))
    walked = F.aggregate(
        both, start,
        lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["value"])).alias("at"),
            F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(x["gap"])).alias("start"),
                                                  x["value"].alias("value")))).alias("spans")),
        lambda s: s["spans"],
    )
    return F.when(text.rlike(kind.hint), walked).otherwise(F.array().cast(shape))


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans with their scores."""
    kept = F.filter(_proposed(text, kind), lambda x: confirmed(kind.name, x["value"]))

    def scored(x: Column) -> Column:
        first = F.greatest(x["start"] - NEAR, F.lit(0))
        near = F.substring(text, first + 1, x["start"] - first)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"),
            F.least(F.lit(1.0), F.lit(kind.base) + F.when(near.rlike(kind.context), RAISE).otherwise(0.0)).alias("score"),
        )

    return F.transform(kept, scored)


def find_pii(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """The rows with a column of spans: kind, start, end (code points, end exclusive), value, score.

    Kinds come in the order of ``KINDS``, spans of a kind by their start.  Spans
    of different kinds may overlap.  A null or empty text has no spans.  Other
    columns stay as they are, but one named like ``into`` is replaced.
    """
    whole = text_or_empty(text)
    return docs.withColumn(into, F.concat(*[_spans(whole, kind) for kind in KINDS]))


def masked(text: Column, spans: Column, least: float = 0.0) -> Column:
    """The text with each span that scores ``least`` or more replaced by its kind in brackets.

    Where spans overlap, the one that starts first goes, then the longer one.
    """
    order = F.array_sort(F.transform(F.filter(spans, lambda s: s["score"] >= least), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.coalesce(text, F.lit(""))
    return F.aggregate(
        order, start,
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
            (-s["less"]).alias("at"),
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                     F.lit("["), s["kind"], F.lit("]")).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
