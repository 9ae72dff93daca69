"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score (native columns only).

All patterns use possessive repeats and start only where no earlier start could have matched, so that a text is
read once however long its runs are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns, in output order
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# further kinds
# fixed values: length of the countries' codes (IBAN registry), so that a code ends where the next word starts; others are a longest run
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
_listed = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
IBAN = "(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, codes in IBAN_LENGTHS.items()) + (
    rf"|(?!{_listed})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}+(?:\x20?[A-Z0-9]{{1,3}})?+)(?![A-Za-z0-9])")
ACCOUNT = r"(?<![A-Za-z0-9.@-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"

def digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("."), F.lit(0))


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    total = F.aggregate(
        _characters(F.reverse(number)), F.struct(F.lit(0).alias("at"), F.lit(0).alias("sum")),
        lambda acc, d: F.struct((acc["at"] + 1).alias("at"), (acc["sum"] + F.when(
            acc["at"] % 2 == 0, F.ascii(d) - 48).otherwise(
            (F.ascii(d) - 48) * 2 - F.when(d >= "5", F.lit(9)).otherwise(F.lit(0)))).alias("sum")))
    return total["sum"] % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 modulo 97, its first four characters moved to the end."""
    turned = F.concat(F.substring(code, 5, 99), F.substring(code, 1, 4))
    rest = F.aggregate(_characters(turned), F.lit(0), lambda acc, c: F.when(
        c >= "A", (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97))
    return rest == 1


def _ip_parts(span: Column) -> Column:
    return F.forall(F.split(span, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.lpad(F.right(p, F.lit(3)), 3, "0") <= "255"))


@dataclass(frozen=True)
class Kind:
    """``start`` is the score of a confirmed span; a context word within ``reach`` characters before it adds ``more``.
    Base kinds are kept whatever their score, others from the threshold on."""

    name: str
    pattern: str
    hint: str  # a pattern every match contains
    confirm: object
    start: float
    context: str
    base: bool = True
    more: float = 0.4
    reach: int = 48


KINDS = (
    Kind("email", EMAIL, "@", lambda s: F.lit(True), 0.9, r"e-?mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", IP, r"[0-9]\.[0-9]", _ip_parts, 0.6, r"\bip\b|address|host|server|adresse|direcci"),
    Kind("card", CARD, "[0-9]{2}", lambda s: luhn(digits(s)), 0.8, r"card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", PHONE, r"\+[0-9]", lambda s: F.length(digits(s)).between(8, 15), 0.7, r"phone|call|tel|mobile|fax|handy"),
    Kind("iban", IBAN, "[A-Z]{2}[0-9]{2}", lambda s: mod_97(F.replace(s, F.lit(" "), F.lit(""))), 0.8,
         r"iban|account|bank|konto|cuenta|compte", base=False),
    Kind("account", ACCOUNT, "[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda s: ~F.substring(s, 1, 3).isin("000", "666"), 0.3,
         r"ssn|social security|tax|national id|identity", base=False),
)
THRESHOLD = 0.6


def spans_of(text: Column, kind: Kind) -> Column:
    """All confirmed spans of a kind as array<struct<start, end, score>>, code points, end exclusive.

    The text between the matches (``split``) and the matches, in turn, give every start as a running length.
    """
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    walked = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("span")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,span:string>>").alias("list")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["span"]), F.lit(0))).alias("at"),
            F.when(x["span"].isNull() | ~F.coalesce(kind.confirm(x["span"]), F.lit(False)), acc["list"]).otherwise(
                F.concat(acc["list"], F.array(F.struct(
                    (acc["at"] + F.length(x["gap"])).alias("start"),
                    (acc["at"] + F.length(x["gap"]) + F.length(x["span"])).alias("end"), x["span"].alias("span"))))).alias("list")))

    def scored(x: Column) -> Column:
        first = F.greatest(F.lit(0), x["start"] - kind.reach)
        before = F.lower(F.substr(text, first + 1, x["start"] - first))
        near = F.when(before.rlike(kind.context), kind.more).otherwise(0.0)
        return F.struct(x["start"].alias("start"), x["end"].alias("end"),
                        F.least(F.lit(1.0), F.lit(kind.start) + near).alias("score"))

    spans = F.transform(walked["list"], scored)
    if not kind.base:
        spans = F.filter(spans, lambda x: x["score"] >= THRESHOLD)
    none = F.array().cast("array<struct<start:int,end:int,score:double>>")
    return F.when(F.coalesce(text.rlike(kind.hint), F.lit(False)), spans).otherwise(none)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and an array column of spans (start, end, score) per kind of ``KINDS`` for every row.

    A null text is empty; null ids and repeated rows are kept as they are; no document is cut short.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *[spans_of(text, k).alias(k.name) for k in KINDS])


def joined(kinds: list[str]) -> Column:
    """``kind:start:end`` of the kinds' spans in order, comma-joined."""
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))

    return F.array_join(F.concat(*map(named, kinds)), ",")
