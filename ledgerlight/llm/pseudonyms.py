"""Format-preserving pseudonyms for personal numbers, dates and addresses, in Spark expressions only.

Values are found by pattern and validated: cards by their Luhn digit, IBANs by
their remainder modulo 97, dates by the calendar, social security numbers by
their ranges, IP addresses by their octets; phone numbers and e-mail addresses
by form.  A valid value is replaced by its image under a keyed Feistel network
on the values of its own format: a digit stays a digit, separators, letter
case, country codes and e-mail domains stay, check digits are made right
again.  The network is a permutation, so equal values get equal pseudonyms in
every document, different values get different ones, and the holder of the
key can go back (``reveal``).  Separators and letter case don't count for
equality.

Everything is a per-row expression beside the scan: nothing is shuffled or
looked up.  Null texts stay null, empty ones empty; other columns are not
touched.  Invalid look-alikes stay as they are, as do dates outside 1700-05-29
to 2099-08-04, dates with one-digit days or months, and addresses longer than
the standards allow.  Patterns are flat and bounded, so the cost of a text is in
proportion to its length.

The key comes from the Spark setting ``KEY_SETTING``; ``KEY`` is a published
default for trials only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import fresh, let

ROUNDS = 10
#: Only for tests and trials: a real run sets a secret key of its own.
KEY, KEY_SETTING = "pseudonym-trial-key", "spark.ledgerlight.pseudonymKey"

_EDGE, _END = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z]|[.-][0-9])"
#: Local parts of up to 64 and domains of up to 253 characters, the standards' limits: flat and bounded, so that no text,
#: however long, costs more than its length or deepens the search.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9.-]{0,251}\.[A-Za-z]{2,63}"
#: IBAN lengths by country (the registry's, then those in use beside it): a known length ends a match
#: before a next word of upper-case letters or digits, which the check digits would else take in.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ",
    26: "IS TR DZ IR", 27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_NO_MORE = "(?![0-9A-Za-z])"
_KNOWN_IBAN = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in IBAN_LENGTHS.items()) + ")" + _NO_MORE
#: Of another country: as long as it goes, but not into a next IBAN of known length.
_OTHER_IBAN = f"[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!{_KNOWN_IBAN}))?[A-Z0-9]{{4}}){{2,7}}(?:(?: (?!{_KNOWN_IBAN}))?[A-Z0-9]{{1,3}})?" + _NO_MORE
IBAN = f"(?<![0-9A-Za-z])(?:{_KNOWN_IBAN}|{_OTHER_IBAN})"
DATE = _EDGE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})" + _END
SSN = _EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
#: After a plus, up to 15 digits: without separators, or with a long last part; then in parts of two to four digits.
PLAIN_PHONE = (r"\+(?:[0-9]{7,15}|(?!(?:[0-9][ .-]?){16})[0-9]{1,3}(?:[ .-][0-9]{2,4}){0,3}[ .-][0-9]{5,12}|[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4})(?![0-9])|"
               + _EDGE + r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}" + _END)
#: Calling codes; no code begins another.
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
#: Values start where a word starts (but for a phone number's bracket), which keeps the search linear.
ANY = PHONE + "|(?<![0-9A-Za-z])(?:" + "|".join((EMAIL, IBAN, DATE, SSN, PLAIN_PHONE, IP, CARD)) + ")"
#: Cheap to look for, and part of every value.
HINT = "[0-9]{2}|[0-9][.][0-9]|@"

#: First day of the blocks of dates, and days in a block (270 * 270).
_DAY_0, _SIDE = "1900-01-01", 270
#: The days of whole blocks around it, which are permuted.
_FIRST_DAY, _LAST_DAY = "1700-05-29", "2099-08-04"
#: Steps allowed to a walk to a day over 12; each step gets there with a chance of about 0.6.
_WALK = 200


def _digest(key: str, kind: str, round_: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), F.lower(other.cast("string"))), 256)


def _number(hexes: Column) -> Column:
    return F.conv(F.substring(hexes, 1, 15), 16, 10).cast("bigint")


def _rounds(back: bool) -> Column:
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.array(*[F.lit(r) for r in order])


def _pair(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str, back: bool) -> Column:
    """A permutation of the pairs 0 <= a < sizes[0], 0 <= b < sizes[1]."""
    sign = -1 if back else 1

    def turn(s: Column, r: Column) -> Column:
        even = (r % 2) == 0
        a2 = F.pmod(s["a"] + sign * _number(_digest(key, kind, r, s["b"])), F.lit(sizes[0]).cast("bigint"))
        b2 = F.pmod(s["b"] + sign * _number(_digest(key, kind, r, s["a"])), F.lit(sizes[1]).cast("bigint"))
        return F.struct(F.when(even, a2).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(b2).alias("b"))

    zero = F.struct(F.coalesce(a.cast("bigint"), F.lit(0).cast("bigint")).alias("a"),
                    F.coalesce(b.cast("bigint"), F.lit(0).cast("bigint")).alias("b"))
    return F.aggregate(_rounds(back), zero, turn)


def _shifted(text: Column, hexes: Column, sign: int) -> Column:
    """Each digit or ASCII letter of ``text`` moved within its own alphabet."""

    def move(i: Column) -> Column:
        c = F.ascii(F.substring(text, i, F.lit(1)))
        by = sign * F.conv(F.substring(hexes, 1 + 2 * F.pmod(i - 1, F.lit(32)), F.lit(2)), 16, 10).cast("int")
        in_ = lambda first, size: F.char(first + F.pmod(c - first + by, F.lit(size)))
        return F.when(c < 58, in_(48, 10)).when(c < 91, in_(65, 26)).otherwise(in_(97, 26))

    return F.when(F.length(text) == 0, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), move), ""))


def _string(text: Column, key: str, kind: str, back: bool) -> Column:
    """A permutation of the strings of digits and ASCII letters that have the form of ``text``."""
    sign, half = -1 if back else 1, F.floor(F.length(text) / 2).cast("int")

    def turn(s: Column, r: Column) -> Column:
        even = (r % 2) == 0
        return F.struct(
            F.when(even, let(_digest(key, kind, r, s["b"]), lambda h: _shifted(s["a"], h, sign))).otherwise(s["a"]).alias("a"),
            F.when(even, s["b"]).otherwise(let(_digest(key, kind, r, s["a"]), lambda h: _shifted(s["b"], h, sign))).alias("b"))

    zero = F.struct(F.coalesce(F.substring(text, F.lit(1), half), F.lit("")).alias("a"),
                    F.coalesce(F.substring(text, half + 1, F.length(text)), F.lit("")).alias("b"))
    return let(F.aggregate(_rounds(back), zero, turn), lambda out: F.concat(out["a"], out["b"]))


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _filled(value: Column, bare: Column) -> Column:
    """``value`` with its digits and letters replaced, in order, by those of ``bare``."""

    def place(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substring(bare, F.length(_bare(F.substring(value, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), place), "")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum of a digit string; ``double_last``: the last digit is doubled (no check digit yet)."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = ((n - i) % 2 == 0) if double_last else ((n - i) % 2 == 1)
        return total + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN's letters-as-numbers modulo 97, its first four characters moved to the end."""

    def remainder(moved: Column) -> Column:
        def add(r: Column, i: Column) -> Column:
            c = F.ascii(F.substring(moved, i, F.lit(1)))
            return F.when(c < 58, (r * 10 + c - 48) % 97).otherwise((r * 100 + c - 55) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)

    return let(F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4)), remainder)


def _card(v: Column, key: str, back: bool) -> Column:
    def new(digits: Column) -> Column:
        body = _string(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", back)
        checked = let(body, lambda d: F.concat(d, F.pmod(-_luhn_sum(d, True), F.lit(10)).cast("string")))
        return F.when(_luhn_sum(digits, False) % 10 == 0, let(checked, lambda bare: _filled(v, bare))).otherwise(v)

    return let(_bare(v), new)


def _iban(v: Column, key: str, back: bool) -> Column:
    def new(bare: Column) -> Column:
        country = F.substring(bare, 1, 2)
        check = lambda body: F.lpad((98 - _mod97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
        body = _string(F.substring(bare, F.lit(5), F.length(bare)), key, "iban", back)
        whole = let(body, lambda b: F.concat(country, check(b), b))
        return F.when(_mod97(bare) == 1, let(whole, lambda w: _filled(v, w))).otherwise(v)

    return let(_bare(v), new)


def _kept_form(own: Column, key: str, kind: str, back: bool) -> Column:
    return let(_string(_bare(own), key, kind, back), lambda bare: _filled(own, bare))


def _email(v: Column, key: str, back: bool) -> Column:
    local = F.substring_index(v, "@", 1)
    return F.concat(let(local, lambda own: _kept_form(own, key, "email", back)), F.substring(v, F.length(local) + 1, F.length(v)))


def _phone(v: Column, key: str, back: bool) -> Column:
    country = F.regexp_extract(v, r"^\+(?:[0-9]{1,3}(?=[ .(-])|" + COUNTRY + ")[ .-]?", 0)
    own = F.substring(v, F.length(country) + 1, F.length(v))
    return F.concat(country, let(own, lambda o: _kept_form(o, key, "phone", back)))


def _ip(v: Column, key: str, back: bool) -> Column:
    part = [F.split_part(v, F.lit("."), F.lit(k)).cast("int") for k in (1, 2, 3, 4)]
    pair = _pair(part[0] * 256 + part[1], part[2] * 256 + part[3], (65536, 65536), key, "ip", back)
    new = let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
        F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)]))
    return F.when(F.greatest(*part) < 256, new).otherwise(v)


def _ssn(v: Column, key: str, back: bool) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.split_part(v, F.lit("-"), F.lit(k)).cast("int") for k in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    number = area - 1 - F.when(area > 666, 1).otherwise(0)

    def new(p: Column) -> Column:
        a = F.floor(p["a"] / 99) + 1
        a = a + F.when(a >= 666, 1).otherwise(0)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((p["a"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((p["b"] + 1).cast("string"), 4, "0"))

    pair = _pair(number * 99 + group - 1, serial - 1, (898 * 99, 9999), key, "ssn", back)
    return F.when(valid, let(pair, new)).otherwise(v)


def _date(v: Column, key: str, back: bool) -> Column:
    """Days of the calendar, permuted within blocks of 72,900 days; day.month.year, month/day/year and
    ISO, where the same day is the same value in each.  A slash date that is a date only as day/month/year
    (a day over 12) is permuted among the days over 12, so that its image reads back the same way: the
    permutation is applied until it gives such a day, which keeps it a permutation."""
    block_days = F.lit(_SIDE**2).cast("bigint")
    as_day = lambda n: F.date_add(F.lit(_DAY_0).cast("date"), n.cast("int"))

    def moved(n: Column) -> Column:
        block, within = F.floor(n / block_days), F.pmod(n, block_days)
        pair = _pair(F.floor(within / _SIDE), within % _SIDE, (_SIDE, _SIDE), key, "date", back)
        return let(pair, lambda p: block * block_days + p["a"] * _SIDE + p["b"])

    def walked(n: Column) -> Column:
        def go(s: Column, _: Column) -> Column:
            return F.when(s["there"], s).otherwise(let(moved(s["n"]), lambda m: F.struct(
                m.alias("n"), (F.dayofmonth(as_day(m)) > 12).alias("there"))))

        start = F.struct(n.alias("n"), F.lit(False).alias("there"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), start, go)["n"]

    out = v
    for form, like, image in (("dd/MM/yyyy", "__/__/____", walked), ("MM/dd/yyyy", "__/__/____", moved),
                              ("dd.MM.yyyy", "__.__.____", moved), ("yyyy-MM-dd", "____-__-__", moved)):
        day = F.try_to_timestamp(v, F.lit(form)).cast("date")
        fits = v.like(like) & day.between(F.lit(_FIRST_DAY).cast("date"), F.lit(_LAST_DAY).cast("date"))
        new = let(let(F.datediff(day, F.lit(_DAY_0).cast("date")).cast("bigint"), image), as_day)
        out = F.when(fits, F.date_format(new, form)).otherwise(out)
    return out


def _value(v: Column, key: str, back: bool) -> Column:
    whole = lambda pattern: v.rlike("^(?:" + pattern + ")$")
    return (F.when(v.contains("@"), _email(v, key, back))
            .when(whole(DATE), _date(v, key, back))
            .when(whole(SSN), _ssn(v, key, back))
            .when(whole(IP), _ip(v, key, back))
            .when(whole(IBAN), _iban(v, key, back))
            .when(whole(PHONE + "|" + PLAIN_PHONE), _phone(v, key, back))
            .when(whole(CARD), _card(v, key, back)).otherwise(v))


def _replaced(documents: DataFrame, key: str, back: bool, count: str | None) -> DataFrame:
    text, pairs = F.col("text"), fresh(documents, "pairs")
    columns = [c for c in documents.columns if count is None or c.lower() != count.lower()]
    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
                        lambda v: F.struct(v.alias("old"), _value(v, key, back).alias("new")))
    rows = documents.withColumn(pairs, F.when(text.rlike(HINT) & text.rlike(ANY), found))
    joined = F.array_join(F.zip_with(F.split(text, ANY, -1), F.col(pairs), lambda gap, p: F.concat(
        F.coalesce(gap, F.lit("")), F.coalesce(p["new"], F.lit("")))), "")
    new = F.when(F.col(pairs).isNull(), text).otherwise(joined)
    changed = F.coalesce(F.size(F.filter(F.col(pairs), lambda p: p["old"] != p["new"])), F.lit(0))
    changed = F.when(F.col(pairs).isNull(), F.lit(0)).otherwise(changed)
    return rows.select(*[new.alias(c) if c == "text" else F.col(c) for c in columns],
                       *([changed.cast("int").alias(count)] if count else []))


def _key(documents: DataFrame, key: str | None) -> str:
    return key or documents.sparkSession.conf.get(KEY_SETTING, KEY)


def pseudonymised(documents: DataFrame, key: str | None = None, count: str | None = None) -> DataFrame:
    """``documents`` with personal values in ``text`` replaced; ``count`` names a column for
    the number of values replaced in a row (it replaces one of that name)."""
    return _replaced(documents, _key(documents, key), False, count)


def reveal(documents: DataFrame, key: str | None = None) -> DataFrame:
    """The inverse of ``pseudonymised`` for the holder of the key."""
    return _replaced(documents, _key(documents, key), True, None)
