"""Format-preserving pseudonyms for personal data.

E-mail addresses, IP addresses, dates, social security, phone and card numbers are found by one pattern and validated
(octets, calendar, number ranges, Luhn's sum).  A valid value is permuted inside its own format by a Feistel network
keyed with a secret: digits stay digits, a date stays a date, a card number keeps a valid check digit, separators stay
where they were.  The permutation depends on the value alone, not on how it is written or where it stands, so
equal values stay linked across documents and different values stay different.  Everything is a Spark expression on the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# What is looked for, in order of precedence.  Repeated groups are possessive, so that a value of any length is matched
# without recursion.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7})(?![0-9A-Za-z])"
KINDS = {"email": EMAIL, "ip": IP, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
ANY = "|".join(KINDS.values())
# Dates of 1900 to 2099, as days since 1900-01-01; the network permutes a grid that is a little larger, and days outside walk on.
FIRST_DAY, DAYS = "1900-01-01", 73_049
DAY_GRID, MAX_WALK = (271, 270), 16
LETTERS, BASE26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"
LONGEST_HALF = {10: 18, 26: 13}


def _prf(secret: str, tweak: Column, i: Column, x: Column) -> Column:
    """60 bits of a keyed hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("/", F.lit(secret), tweak, i.cast("string"), x.cast("string"), F.lit(secret)), 256), 1, 15), 16, 10).cast("long")


def feistel(x: Column, mx: Column, y: Column, my: Column, secret: str, tweak: Column) -> Column:
    """The pair (x below mx, y below my), permuted among such pairs."""
    start = F.struct(x.cast("long").alias("x"), mx.cast("long").alias("mx"), y.cast("long").alias("y"), my.cast("long").alias("my"))

    def turn(c: Column, i: Column) -> Column:
        nx = F.pmod(c["x"] + F.pmod(_prf(secret, tweak, i, c["y"]), c["mx"]), c["mx"])
        turned = F.struct(nx.alias("x"), c["mx"].alias("mx"), c["y"].alias("y"), c["my"].alias("my"))
        other = F.struct(c["x"].alias("x"), c["mx"].alias("mx"), F.pmod(c["y"] + F.pmod(_prf(secret, tweak, i, c["x"]), c["my"]), c["my"]).alias("y"), c["my"].alias("my"))
        return F.when(i % 2 == 0, turned).otherwise(other)

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def _day(day: Column, secret: str) -> Column:
    """A day below ``DAYS``, permuted: the grid's cells past the last day walk on until they are inside.

    One cell in 604 lies outside; a walk past ``MAX_WALK`` of them, of a chance below 1e-44, is an error.
    """
    mx, my = (F.lit(n).cast("long") for n in DAY_GRID)

    def turned(v: Column) -> Column:
        pair = feistel(F.pmod(v, mx), mx, F.floor(v / mx), my, secret, F.lit("date"))
        return F.element_at(F.transform(F.array(pair), lambda c: c["y"] * mx + c["x"]), 1)

    def walk(p: Column) -> Column:
        steps = F.when(p < DAYS, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.lit(MAX_WALK)))
        return F.aggregate(steps, p, lambda q, _: F.when(q < DAYS, q).otherwise(turned(q)))

    inside = F.element_at(F.transform(F.array(turned(day)), walk), 1)
    checked = F.transform(F.array(inside), lambda p: F.when(p < DAYS, p).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long")))
    return F.element_at(checked, 1)


def _symbols(s: Column, base: int, secret: str, tweak: str) -> Column:
    """A string of digits, or of letters a-z, permuted among the strings of its length; long strings in pieces."""
    piece = 2 * LONGEST_HALF[base] - 2

    def number(c: Column) -> Column:
        text = F.when(F.length(c) > 0, c).otherwise(F.lit("0"))
        return text.cast("long") if base == 10 else F.conv(F.translate(text, LETTERS, BASE26), 26, 10).cast("long")

    def written(v: Column, width: Column) -> Column:
        raw = v.cast("string") if base == 10 else F.translate(F.lpad(F.lower(F.conv(v.cast("string"), 10, 26)), width, F.lit("0")), BASE26, LETTERS)
        return F.when(width > 0, F.lpad(raw, width, F.lit("0" if base == 10 else "a"))).otherwise(F.lit(""))

    def permute(p: Column, i: Column) -> Column:
        half = F.floor(F.length(p) / 2).cast("int")
        rest = F.length(p) - half
        left, right = F.substring(p, F.lit(1), half), F.substring(p, half + 1, rest)
        powers = F.array(*[F.lit(base**k).cast("long") for k in range(LONGEST_HALF[base] + 1)])
        size = lambda n: F.get(powers, n)
        label = F.concat_ws("/", F.lit(tweak), F.length(s).cast("string"), i.cast("string"))
        pair = feistel(number(left), size(half), number(right), size(rest), secret, label)
        return F.element_at(F.transform(F.array(pair), lambda c: F.concat(written(c["x"], half), written(c["y"], rest))), 1)

    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - 1) / piece).cast("int")), lambda i: F.substring(s, i * piece + 1, F.lit(piece)))
    return F.when(F.length(s) > 0, F.array_join(F.transform(pieces, permute), "")).otherwise(F.lit(""))


def _fill(form: Column, slots: str, symbols: Column) -> Column:
    """``form`` with the characters of class ``slots`` replaced by ``symbols``, in order."""
    gaps = F.split(form, slots, -1)
    return F.array_join(F.zip_with(gaps, F.split(symbols, ""), lambda g, c: F.concat(F.coalesce(g, F.lit("")), F.coalesce(c, F.lit("")))), "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a string of digits, the last one undoubled."""
    def value(c: Column, i: Column) -> Column:
        v = F.coalesce(F.when(c != "", c).cast("int"), F.lit(0))
        twice = F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return F.when(i % 2 == 1, twice).otherwise(v)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, v: a + v)


def _iso(s: Column) -> Column:
    slash = F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 4, 2), F.lit("-"), F.substring(s, 1, 2))
    return F.when(F.substring(s, 3, 1) == "/", slash).otherwise(s).try_cast("date")


def kind_of(m: Column) -> Column:
    """The kind of a match of ``ANY`` that is valid, else null."""
    octets = F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)
    day = _iso(m)
    ssn = ~F.substring(m, 1, 3).isin("000", "666") & (F.substring(m, 1, 1) != "9") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    return (
        F.when(F.contains(m, F.lit("@")), "email")
        .when(m.rlike(f"^(?:{IP})$"), F.when(octets, "ip"))
        .when(m.rlike(f"^(?:{DATE})$"), F.when((day >= F.lit(FIRST_DAY).cast("date")) & (day < F.lit("2100-01-01").cast("date")), "date"))
        .when(m.rlike(f"^(?:{SSN})$"), F.when(ssn, "ssn"))
        .when(m.rlike(f"^(?:{PHONE})$"), "phone")
        .otherwise(F.when(luhn_sum(_digits(m)) % 10 == 0, "card")))


def pseudonym(m: Column, kind: Column, secret: str) -> Column:
    """The pseudonym of a value of a kind, written in the value's own format."""
    digits = _digits(m)
    # e-mail: the local part's letters and digits, each among their own; the domain is nobody's name
    local = F.lower(F.substring_index(m, "@", 1))
    letters = F.regexp_replace(local, "[^a-z]", "")
    mail = _fill(_fill(local, "[a-z]", _symbols(letters, 26, secret, "email")), "[0-9]", _symbols(_digits(local), 10, secret, "email"))
    mail = F.concat(mail, F.lit("@"), F.substring_index(m, "@", -1))
    octet = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    pair = feistel(F.get(octet, F.lit(0)) * 256 + F.get(octet, F.lit(1)), F.lit(65536), F.get(octet, F.lit(2)) * 256 + F.get(octet, F.lit(3)), F.lit(65536), secret, F.lit("ip"))
    ip = F.element_at(F.transform(F.array(pair), lambda c: F.concat_ws(".", F.floor(c["x"] / 256), c["x"] % 256, F.floor(c["y"] / 256), c["y"] % 256)), 1)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), _day(F.datediff(_iso(m), F.lit(FIRST_DAY).cast("date")).cast("long"), secret).cast("int"))
    date = F.when(F.substring(m, 3, 1) == "/", F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    # social security: 898 areas (001 to 899 without 666), groups 01 to 99, serials 0001 to 9999
    area, tail = digits.substr(1, 3).cast("long"), (digits.substr(4, 2).cast("long") - 1) * 9999 + digits.substr(6, 4).cast("long") - 1
    pair = feistel(area - 1 - (area > 666).cast("long"), F.lit(898), tail, F.lit(99 * 9999), secret, F.lit("ssn"))
    ssn = F.element_at(F.transform(F.array(pair), lambda c: F.format_string(
        "%03d-%02d-%04d", c["x"] + 1 + (c["x"] >= 665).cast("long"), F.floor(c["y"] / 9999) + 1, c["y"] % 9999 + 1)), 1)
    # phone: the last ten digits, whatever country code stands before them
    n = F.length(digits)
    phone = F.concat(F.substring(digits, F.lit(1), n - 10), _symbols(F.substring(digits, n - 9, F.lit(10)), 10, secret, "phone"))
    payload = _symbols(F.substring(digits, F.lit(1), n - 1), 10, secret, "card")
    card = F.element_at(F.transform(F.array(payload), lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))), 1)
    return (
        F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "date", date)
        .when(kind == "ssn", ssn)
        .when(kind == "phone", _fill(m, "[0-9]", phone)).when(kind == "card", _fill(m, "[0-9]", card)).otherwise(m))


def pseudonymise(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_date, n_ssn, n_phone, n_card, n_private, text (pseudonymised).

    Invalid values (a card number with a wrong check digit, an octet above 255, the 30th of February) stay as they
    are.  Dates are written year-month-day, or day/month/year with slashes; month/day/year is not a date here.
    The secret stands in the query's plan, so plans and event logs need its protection.  A null text stays null and has no values; an empty one stays empty.  Null and repeated keys are rows like
    others; other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = rows.withColumn("_m", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    # only the values themselves go through the network; the text between them is cut out and put back
    some = F.size("_m") > 0
    values = F.transform("_m", lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    found = found.select("doc_id", "text", F.when(some, F.split("text", ANY, -1)).alias("_gaps"), F.when(some, values).alias("_v"))
    new = F.transform("_v", lambda v: pseudonym(v["m"], v["kind"], secret))
    whole = F.array_join(F.zip_with("_gaps", new, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    count = lambda k: F.coalesce(F.size(F.filter("_v", lambda v: v["kind"] == k)), F.lit(0)).cast("long")
    out = found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.when(F.col("_v").isNotNull(), whole).otherwise(F.col("text")).alias("text"))
    total = sum((F.col(f"n_{k}") for k in KINDS), F.lit(0))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], total.cast("long").alias("n_private"), "text")
