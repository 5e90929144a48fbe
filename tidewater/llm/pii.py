"""Format-preserving pseudonyms for personal numbers, dates, addresses.

Payment card numbers (Luhn), IBANs (mod 97), US social security numbers, phone
numbers, IPv4 addresses, calendar dates and e-mail local parts are replaced by a
keyed permutation of their own format: a Feistel network whose two halves are added
to modulo the size of each half, so it maps the format's domain onto itself without
rejection. Equal values get equal pseudonyms in every document; check digits stay
valid; numbers that fail validation are left alone.

Everything is DataFrame functions; rows are independent, so there is no shuffle.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import fresh

#: Rounds of every network (even, so that the halves end where they began).
ROUNDS = 10

_L, _R = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Characters of an IBAN by country: the registry, and the countries that use IBANs without being in it.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _iban_pattern() -> str:
    """One alternative a length; other country codes take the longest run of groups."""
    out = []
    for length in sorted(set(IBAN_LENGTHS.values())):
        groups, rest = divmod(length - 4, 4)
        countries = "|".join(c for c, n in IBAN_LENGTHS.items() if n == length)
        out.append(f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    out.append(f"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")
    return _L + r"(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(out) + ")" + _R


#: Patterns by kind, tried in this order at each place of the text; of the IBANs only those that are valid.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": _iban_pattern(),
    # also the date of a timestamp, and days and months of one digit
    "date": _L + r"(?:(?:19|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?:" + _R + r"|(?=T[0-9]))|[0-9]{1,2}([-/.])[0-9]{1,2}\2(?:19|20)[0-9]{2}" + _R + ")",
    "ssn": _L + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _R,
    "ip": r"(?<![\p{L}\p{N}])(?<![0-9]\.)(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}])(?!\.[0-9])",
    # three, three and four digits without a further group, or a country code and 7 to 12 digits in groups
    "phone": r"(?:(?:\+[0-9]{1,3}[ .-]?|(?<![\p{L}\p{N}+]))(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}(?: [0-9]{4}(?! [0-9]{3})|[.-][0-9]{4}(?![.-][0-9]{3}))"
    r"|(?<![\p{L}\p{N}+])(?=\+(?:[0-9][ .-]?){8,15}(?![0-9]))\+[1-9][0-9]{0,2}(?:[ .-][0-9]{2,4}){2,5}(?![ .-]?[0-9]))" + _R,
    "card": _L + r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\4[0-9]{5})" + _R,
}
_OTHERS = {kind: f"(?:{p})" for kind, p in PATTERNS.items() if kind != "iban"}
#: The tests that tell kinds apart on a whole match.
_FORM = {
    "email": "@",
    "date": r"^(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "ip": r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$",
    "iban": r"^[A-Z]{2}[0-9]{2}",
    "phone": r"^(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,5})$",
}
#: Phone numbers of three, three and four digits; others have a country code.
_THREE_THREE_FOUR = r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"


def _long(text: Column) -> Column:
    return F.coalesce(text.cast("bigint"), F.lit(0).cast("bigint"))


def _digest(key: str, kind: str, rnd: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), rnd.cast("string"), F.lit("|"), half.cast("string")), 256)


def _number(hexes: Column) -> Column:
    return F.conv(F.substring(hexes, 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """Permute pairs in [0, left_size) x [0, right_size); a struct ``l``, ``r``."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"), left_size.cast("bigint").alias("a"), right_size.cast("bigint").alias("b"))

    def step(s: Column, rnd: Column) -> Column:
        mixed = F.pmod(s["l"] + _number(_digest(key, kind, rnd, s["r"])), s["a"])
        return F.struct(s["r"].alias("l"), mixed.alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the strings of as many decimal digits (36 at most)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = (n - u).cast("int")
    s = feistel(
        _long(F.substring(digits, F.lit(1), u)), _long(F.substring(digits, u + 1, v)),
        F.pow(F.lit(10.0), u).cast("bigint"), F.pow(F.lit(10.0), v).cast("bigint"), key, kind,
    )
    # `s` would be expanded twice; a one-element array binds it once.
    return F.transform(F.array(s), lambda x: F.concat(F.lpad(F.when(u > 0, x["l"].cast("string")).otherwise(F.lit("")), u, "0"), F.lpad(x["r"].cast("string"), v, "0")))[0]


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn by ``digits``."""

    def put(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(digit, 1).otherwise(0)).cast("int").alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum; ``doubled_last``: the last digit is doubled (no check digit yet)."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == (0 if doubled_last else 1)
        return acc + F.when(twice, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    digits = only_digits(m)
    body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    full = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(-luhn_sum(b, True), F.lit(10)).cast("string")))[0]
    return F.when(F.pmod(luhn_sum(digits, False), F.lit(10)) == 0, refill(m, full)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """The country code stays: what stands before the last ten digits, or the first group of another number."""
    digits = only_digits(m)
    code = F.when(m.rlike(_THREE_THREE_FOUR), F.length(digits) - 10).otherwise(F.length(F.regexp_extract(m, r"^\+([0-9]+)", 1)))

    def moved(n: Column) -> Column:
        return refill(m, F.concat(F.substring(digits, F.lit(1), n), permute_digits(F.substring(digits, n + 1, F.length(digits) - n), key, "phone")))

    return F.transform(F.array(code), moved)[0]


def _ssn(m: Column, key: str) -> Column:
    """Valid numbers: area 1-665, 667-899 (898 values), group 1-99, serial 1-9999."""
    d = only_digits(m)
    area, group, serial = (_long(F.substring(d, at, n)) for at, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
    s = feistel(left, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def show(x: Column) -> Column:
        place = F.floor(x["l"] / 99)
        code = place + F.when(place >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(code.cast("string"), 3, "0"), F.lpad((x["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((x["r"] + 1).cast("string"), 4, "0"))

    return F.when(valid, F.transform(F.array(s), show)[0]).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    o = [_long(F.split(m, r"\.")[i]) for i in range(4)]
    s = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
    show = lambda x: F.concat_ws(".", *[y.cast("string") for y in (F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)])
    return F.transform(F.array(s), show)[0]


def _date(m: Column, key: str) -> Column:
    """Days 1900-01-01 to 2099-12-31: 73,049 = 17 x 4,297. Year first, or last with the
    month first for ``/`` (day first if that is no date) and the day first for ``.`` and ``-``.
    One day maps to one day in every notation; days and months have two digits if those of the match have."""
    first, day0 = m.rlike("^[0-9]{4}"), F.lit("1900-01-01").cast("date")
    sep = F.regexp_extract(m, "[-/.]", 0)

    def of(p: Column) -> Column:
        two = lambda i: F.lpad(p[i], 2, "0")
        day_of = lambda *at: F.try_to_timestamp(F.concat_ws("-", *at), F.lit("yyyy-MM-dd")).cast("date")
        us, eu, iso = day_of(p[2], two(0), two(1)), day_of(p[2], two(1), two(0)), day_of(p[0], two(1), two(2))
        month_first = ~first & (sep == "/") & us.isNotNull()
        padded = (F.length(p[1]) == 2) & (F.length(F.when(first, p[2]).otherwise(p[0])) == 2)
        return F.struct(F.when(first, iso).when(month_first, us).otherwise(eu).alias("day"), month_first.alias("month_first"), padded.alias("padded"))

    def moved(d: Column) -> Column:
        n = F.datediff(d["day"], day0).cast("bigint")
        s = feistel(F.floor(n / 4297), n % 4297, F.lit(17), F.lit(4297), key, "date")

        def show(x: Column) -> Column:
            to = F.date_add(day0, (x["l"] * 4297 + x["r"]).cast("int"))
            y = F.date_format(to, "yyyy")
            mo, da = (F.when(d["padded"], F.date_format(to, two)).otherwise(F.date_format(to, one)) for two, one in (("MM", "M"), ("dd", "d")))
            return F.when(first, F.concat(y, sep, mo, sep, da)).when(d["month_first"], F.concat(mo, sep, da, sep, y)).otherwise(F.concat(da, sep, mo, sep, y))

        return F.when(d["day"].isNotNull(), F.transform(F.array(s), show)[0]).otherwise(m)

    return F.transform(F.transform(F.array(F.split(m, "[-/.]")), of), moved)[0]


def _iban_mod(text: Column) -> Column:
    """The number's remainder modulo 97 with letters as 10..35."""

    def add(acc: Column, c: Column) -> Column:
        d = F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.pmod(acc * F.when(d > 9, 100).otherwise(10) + d, F.lit(97))

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban_parts(m: Column) -> tuple[Column, Column, Column]:
    """Country, account, and whether the check digits fit."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    head, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain) - 4)
    return head, account, _iban_mod(F.concat(account, F.substring(plain, 1, 4))) == 1


def _iban(m: Column, key: str) -> Column:
    """Country and letters stay; the account's digits are permuted and the check digits recomputed."""
    head, account, valid = _iban_parts(m)
    digits = only_digits(account)
    fresh = refill(account, permute_digits(digits, key, "iban"))
    check = lambda a: F.lpad((F.lit(98) - _iban_mod(F.concat(a, head, F.lit("00")))).cast("string"), 2, "0")
    shown = F.transform(F.array(fresh), lambda a: refill(m, F.concat(check(a), only_digits(a))))[0]
    return F.when(valid, shown).otherwise(m)


def _email(m: Column, key: str) -> Column:
    """The local part: digits, a-z and A-Z move within their kind, other characters stay; the domain is kept."""
    local = F.substring_index(m, "@", 1)
    half = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substring(local, F.lit(1), half).alias("l"), F.substring(local, half + 1, F.length(local) - half).alias("r"))

    def step(s: Column, rnd: Column) -> Column:
        hexes = _digest(key, "email", rnd, s["r"])

        def move(c: Column, i: Column) -> Column:
            by = F.conv(F.substring(hexes, F.pmod(i * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int")
            at = lambda base, size: F.char(F.lit(base) + F.pmod(F.ascii(c) - base + by, F.lit(size)))
            return F.when(c.rlike("^[0-9]$"), at(48, 10)).when(c.rlike("^[a-z]$"), at(97, 26)).when(c.rlike("^[A-Z]$"), at(65, 26)).otherwise(c)

        return F.struct(s["r"].alias("l"), F.array_join(F.transform(F.split(s["l"], ""), move), "").alias("r"))

    moved = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))
    return F.concat(moved, F.lit("@"), F.substring_index(m, "@", -1))


def kind_of(match: Column) -> Column:
    out = F.when(match.contains(_FORM["email"]), "email")
    for kind in ("date", "ssn", "ip", "iban", "phone"):
        out = out.when(match.rlike(_FORM[kind]), kind)
    return out.otherwise("card")


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match; the match itself where it fails validation."""
    kind = kind_of(match)
    out = F.when(kind == "email", _email(match, key))
    for name, fn in (("date", _date), ("ssn", _ssn), ("ip", _ip), ("iban", _iban), ("phone", _phone)):
        out = out.when(kind == name, fn(match, key))
    return out.otherwise(_card(match, key))


def pattern_of(text: Column) -> Column:
    """The pattern of all kinds for one text. Only its valid IBANs are part of it, word for word, so what
    merely looks like one hides nothing; candidates may overlap."""
    candidates = F.regexp_extract_all(text, F.lit(f"(?=({PATTERNS['iban']}))"), F.lit(1))
    valid = F.array_distinct(F.filter(candidates, lambda m: _iban_parts(m)[2]))
    first, *others = _OTHERS.values()
    ibans = F.transform(F.array(valid), lambda v: F.when(F.size(v) > 0, F.concat(F.lit(f"|{_L}(?:"), F.array_join(v, "|"), F.lit(f"){_R}"))).otherwise(F.lit("")))[0]
    return F.concat(F.lit(first), ibans, F.lit("|" + "|".join(others)))


def pseudonymize_text(text: Column, key: str) -> Column:
    """A struct ``text``, ``found``: the text with its personal values replaced, and what was replaced
    (an array of ``kind``, ``value``, ``pseudonym``). Null stays null. Texts without a digit or ``@``
    are passed on unread by the patterns."""
    def cut(pattern: Column) -> Column:
        matches = F.regexp_extract_all(text, pattern, F.lit(0))
        found = F.transform(matches, lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value"), pseudonym(m, key).alias("pseudonym")))
        return F.struct(F.split(text, pattern, -1).alias("between"), found.alias("found"))

    # Bound once: the pattern, the text between the matches, and the matches with their pseudonyms.
    parts = F.transform(F.array(pattern_of(text)), cut)

    def rebuild(p: Column) -> Column:
        fill = F.array_append(F.transform(p["found"], lambda m: m["pseudonym"]), F.lit(""))
        joined = F.array_join(F.flatten(F.zip_with(p["between"], fill, lambda a, b: F.array(a, b))), "")
        return F.struct(joined.alias("text"), F.filter(p["found"], lambda m: m["value"] != m["pseudonym"]).alias("found"))

    kind = "array<struct<kind:string,value:string,pseudonym:string>>"
    untouched = F.struct(text.alias("text"), F.array().cast(kind).alias("found"))
    return F.when(text.rlike("[0-9@]"), F.transform(parts, rebuild)[0]).otherwise(untouched)


#: The setting that holds the secret key.
KEY_SETTING = "spark.tidewater.pseudonym.key"
#: A public key for tests and for the registered queries where the setting is absent: it protects nothing.
TEST_KEY = "public test key, protects nothing"


def session_key(spark: SparkSession) -> str:
    """The key of this session's setting; without one the test key, with a warning."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        logging.getLogger(__name__).warning("%s is not set: pseudonyms are made with the public test key", KEY_SETTING)
    return key or TEST_KEY


def pseudonymize(df: DataFrame, text_col: str = "text", *, key: str, found_col: str | None = None) -> DataFrame:
    """Replace personal values in ``text_col``; other columns pass through in place.

    ``key`` is the secret of the permutation, and who has it can undo it; without it the values cannot be linked back.
    Replaced are e-mail addresses, valid IBANs, card numbers, dates of 1900 to 2099 in digits (year first or last, also before the
    ``T`` of a timestamp), social security numbers, IPv4 addresses, and phone numbers of three, three and four digits or with
    a country code and groups of two to four digits. Left alone are dates with names of months or two-digit years, numbers
    without groups or a country code that are no card, IPv6 addresses, names and postal addresses.
    ``found_col``: also return what was replaced under this name. Null and empty texts,
    repeated rows and empty tables pass through; every text is read whole.
    """
    done = pseudonymize_text(F.col(f"`{text_col}`"), key)
    bound = fresh("__pii", df.columns)
    rows = df.withColumn(bound, done)
    out = [F.col(f"`{bound}`.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    return rows.select(*out, *([F.col(f"`{bound}`.found").alias(found_col)] if found_col else []))
