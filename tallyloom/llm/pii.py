"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score (DataFrame functions only).

Base kinds are always reported: email, ip, card (16 to 19 digits passing Luhn), phone (8 to 15 digits after a plus).  Others need
a score of THRESHOLD: iban (mod-97), short_card (13 to 15 digits passing Luhn), national_id (3-2-4 digits) and local_phone.  A pattern brings its
prior, a passed checksum and a telling word within 40 code points before or 20 after, also beyond neighbouring matches,
add to it.  An account number has the length of its country.

The patterns in use match the same spans as the plain ones of the contract.  Possessive groups run as loops, so a digit
run of any length needs no stack; a run of address characters is tried only at its start or where the last
match ended, since every later start in the run meets the same end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.spans import Kind, digits, found, joined, placed

#: length of an account number by country
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_KNOWN = "(?:" + "|".join(c for v in LENGTHS.values() for c in v.split()) + ")"
# every alternative begins with two letters and two digits: the test in front saves trying them all at each character
IBAN = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join([f"(?:{v.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, v in LENGTHS.items()]
                + [f"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?(?!{_KNOWN}[0-9]{{2}})[A-Z0-9]){{11,30}}"]) + ")"
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", wide=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    Kind("iban", IBAN, wide=True),
    Kind("national_id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", wide=True),
    Kind("local_phone", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", wide=True),
]
NAMES = ["email", "ip", "card", "phone", "iban", "short_card", "national_id", "local_phone"]
BASE = ["email", "ip", "card", "phone"]
#: prior, telling words
SCORES = {
    "iban": (0.3, "iban|konto|account|bank|compte|cuenta"),
    "short_card": (0.1, "card|visa|amex|credit|karte|carte|tarjeta"),
    "national_id": (0.3, "ssn|social security|national id|passport|tax id"),
    "local_phone": (0.3, "phone|tel|call|mobile|fax"),
}
CHECKED, NEARBY, THRESHOLD = 0.4, 0.3, 0.5


def luhn(d: Column) -> Column:
    """Digits of ``d`` from the right, every second one doubled, sum to a multiple of ten."""
    def value(i):
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(hit: Column) -> Column:
    """ISO 7064 check of an account number: first four characters to the end, letters as 10 to 35."""
    plain = F.regexp_replace(hit, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(acc, i):
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def small_parts(hit: Column) -> Column:
    def ok(part):
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(F.when(F.length(bare) <= 3, bare).try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(hit, r"\."), ok)


def pii_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """rid, doc_id, kind, start, end, score, base, reported; one row with a null kind for a document without matches."""
    m = placed(found(docs, KINDS)).withColumn("digits", digits(F.col("hit"))).withColumn("n", F.length("digits"))
    kind, n = F.col("kind"), F.col("n")
    passes = F.when((kind == "card") & n.between(13, 19), luhn(F.col("digits"))).when(kind == "iban", mod97(F.col("hit")))
    m = m.withColumn("passes", passes).withColumn("kind", F.when((kind == "card") & n.between(13, 15), "short_card").otherwise(kind))
    kind, passes = F.col("kind"), F.coalesce(F.col("passes"), F.lit(False))
    good = (F.when(kind == "email", True).when(kind == "ip", small_parts(F.col("hit"))).when(kind == "card", n.between(16, 19) & passes)
            .when(kind == "phone", n.between(8, 15)).otherwise(False))
    score = F.lit(0.0)
    for name, (prior, words) in SCORES.items():
        must = passes if name in ("iban", "short_card") else F.lit(True)
        near = F.col("context").rlike(f"(^|[^a-z])({words})($|[^a-z])")
        points = F.lit(prior) + F.when(passes, CHECKED).otherwise(0.0) + F.when(near, NEARBY).otherwise(0.0)
        score = F.when((kind == name) & must, points).otherwise(score)
    base = kind.isin(BASE)
    reported = F.coalesce(F.when(base, good).otherwise(score >= threshold), F.lit(False))
    order = F.array_position(F.array(*[F.lit(x) for x in NAMES]), kind)
    return m.select("rid", "doc_id", "kind", order.alias("order"), "start", "end", F.when(base, 1.0).otherwise(score).alias("score"),
                    F.coalesce(base & reported, F.lit(False)).alias("base"), reported.alias("reported"))


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_scored (spans beyond the base).

    A null text is empty; an empty table gives no rows; a null or repeated doc_id is no key here.
    """
    order = ["order", "start", "end"]
    return pii_spans(docs).groupBy("rid", "doc_id").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.col("base"), order).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("reported"), order).alias("spans"),
        F.count(F.when(F.col("reported") & ~F.col("base"), 1)).alias("n_scored")).drop("rid")
