"""Format-preserving pseudonyms for personal data.

Candidates are found by one pattern, validated (check digits, calendar,
ranges) and turned into a sequence of symbols, each with its radix: a digit
has radix 10, a letter 26, an IPv4 octet 256, a date is two symbols whose
radices multiply to the days of the calendar. A keyed Feistel network permutes
the sequence: in each round one half is shifted, symbol by symbol, by a digest
of the other half. Check digits are computed anew, so that a valid number
becomes another valid number of the same format, and equal values become equal
pseudonyms in every document. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.text import Guarded

ROUNDS = 10

#: days of 1900-01-01 .. 2100-01-01, as the product of two radices
FIRST_DAY, DAYS = "1900-01-01", (150, 487)

# The forms of personal data.
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SECRET = r"(?i:\b(?:token|secret|api[_-]?key|password)\b\s?[:=]\s?[\"'])[0-9A-Fa-f]{16,64}(?=[\"'])"
#: lengths of IBANs by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form(length: int, countries: str) -> str:
    """Groups of four, undivided or with a space between, up to the length; what follows is no part of it."""
    groups, rest = divmod(length - 4, 4)
    last = f"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}(?![A-Za-z0-9_])"


#: by the length of the country; other countries and lengths as far as groups go
IBAN = (
    rf"\b(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(_iban_form(n, c) for n, c in IBAN_LENGTHS.items())}"
    r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
)
IPV4 = r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"
_ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_DATE_END = r"(?![\w/-]|\.[0-9])"
DATE = (
    rf"(?<![\w./-])(?:{_ISO_DATE}(?=T[0-9]{{2}}:)"
    rf"|(?:{_ISO_DATE}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}){_DATE_END})"
)
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
_PHONE_3_3_4 = r"(?<![\w.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"
#: between the digits of a phone: a mark before a group of two or more digits that is no other value, or brackets
_PHONE_MARK = rf"(?:[ .-](?!{'|'.join([IPV4, DATE, SSN])})(?=[0-9]{{2}})|[ .-]?\((?=[0-9]{{1,4}}\))|\)[ .-]?)?"


def _phone_form(code: int) -> str:
    """A country code of so many digits and the others, 8 to 15 in all; the run ends where a group ends."""
    return rf"[0-9]{{{code}}}(?:[ .-]?\(|[ .-])?[0-9](?:{_PHONE_MARK}[0-9]){{{7 - code},{14 - code}}}"


_PHONE_10 = r"1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
PHONE = (
    rf"(?<![\w+])\+(?:{_PHONE_10}|{'|'.join(_phone_form(n) for n in (3, 2, 1))})(?!\w)|" + _PHONE_3_3_4
)

# The written forms of cards. A group of digits ends before a space, a mark or a dash and a short group;
# groups that begin another value are not taken along.
_CLOSED = r"(?!\w|-(?![0-9]{1,4}(?!\w)))"
_OTHER = f"(?!{'|'.join([IPV4, DATE, SSN, _PHONE_3_3_4])})"
_FOURS = (
    rf"(?<![\w.-])[0-9]{{4}}{_CLOSED}(?:[ -]{_OTHER}[0-9]{{4}}{_CLOSED}){{3,}}+(?:[ -]{_OTHER}[0-9]{{1,3}}{_CLOSED})?+"
)
_FOUR_SIX = rf"(?<![\w.-])[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}{_CLOSED}"
_UNDIVIDED = rf"(?<![\w.-])[0-9]{{13,19}}{_CLOSED}"
_SINGLE = rf"(?<![\w.-])(?<!(?<!\w)[0-9][ -])[0-9](?:[ -][0-9](?!\w)){{12,18}}+{_CLOSED}(?![ -][0-9](?!\w))"
_WRITTEN = "|".join([_FOURS, _FOUR_SIX, _UNDIVIDED, _SINGLE])
#: a written form, or else digits in any groups
CARD = (
    rf"{_WRITTEN}|(?<![\w.-])[0-9](?:(?:[ -]{_OTHER}(?!{_WRITTEN}))?[0-9]){{12,18}}(?![\w-])"
)
PATTERN = "|".join([EMAIL, SECRET, IBAN, IPV4, DATE, SSN, PHONE, CARD])

#: every match of the pattern holds a digit, an at sign or the start of a quoted value
LIKELY = r"[0-9@]|[:=]\s?[\"']"

_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"


def _number(text: Column) -> Column:
    return text.cast("int")


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def luhn_sum(digits: Column, first_weight: int) -> Column:
    """Sum of the digits from the right, weighted 1 and 2 in turn beginning with ``first_weight``."""

    def weighted(digit: Column, k: Column) -> Column:
        value = _number(digit) * F.when(k % 2 == first_weight - 1, 1).otherwise(2)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(F.reverse(_characters(digits)), weighted), F.lit(0), lambda a, b: a + b)


def mod_97(symbols: Column) -> Column:
    """Remainder of a digit and letter sequence, a letter counting as 10 .. 35."""

    def add(rest: Column, symbol: Column) -> Column:
        value = F.instr(F.lit(_ALPHABET), F.lower(symbol)) - 1
        return F.when(value > 9, (rest * 100 + value) % 97).otherwise((rest * 10 + value) % 97)

    return F.aggregate(_characters(symbols), F.lit(0), add)


def _iban_rest(iban: Column, check: Column) -> Column:
    return mod_97(F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(2)), check))


def permute(values: Column, radices: Column, key: str, kind: Column) -> Column:
    """Keyed Feistel permutation of a sequence of symbols below their radices (at most 64 symbols)."""
    n = F.size(values)
    half = F.floor(n / 2).cast("int")

    def a_round(state: Column, i: Column) -> Column:
        left = i % 2 == 0
        fixed = F.when(left, F.slice(state, half + 1, n)).otherwise(F.slice(state, F.lit(1), half))
        seed = F.concat_ws(":", F.lit(key), kind, i.cast("string"), n.cast("string"), F.array_join(fixed, ","))

        def shift(digest: Column) -> Column:
            def one(x: Column, j: Column) -> Column:
                moves = (j < half) == left
                place = F.when(left, j).otherwise(j - half)
                add = F.conv(F.substr(digest, place * 4 + 1, F.lit(4)), 16, 10).cast("int")
                return F.when(moves, (x + add) % F.get(radices, j)).otherwise(x)

            return F.transform(state, one)

        return _bind(F.sha2(seed, 512), shift)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, a_round)


def _alphanumerics(text: Column, key: str, kind: Column, radix: int) -> Column:
    """Letters and digits permuted in their places; upper case stays upper, other characters stay."""
    symbols = _characters(F.regexp_replace(F.lower(text), "[^0-9a-z]", ""))
    digit = lambda c: c.between("0", "9")
    base = lambda c: F.when(digit(c) | F.lit(radix == 16), 0).otherwise(10)
    values = F.transform(symbols, lambda c: F.instr(F.lit(_ALPHABET), c) - 1 - base(c))
    radices = F.transform(symbols, lambda c: F.lit(16) if radix == 16 else F.when(digit(c), 10).otherwise(26))
    moved = F.zip_with(
        permute(values, radices, key, kind), symbols, lambda v, c: F.substr(F.lit(_ALPHABET), v + base(c) + 1, F.lit(1))
    )

    def place(moved: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            before = F.length(F.regexp_replace(F.substr(text, F.lit(1), j), "[^0-9A-Za-z]", ""))
            symbol = F.get(moved, before)
            return (
                F.when(c.rlike("[0-9a-z]"), symbol).when(c.rlike("[A-Z]"), F.upper(symbol)).otherwise(c)
            )

        return F.array_join(F.transform(_characters(text), one), "")

    return _bind(moved, place)


def _email(m: Column, key: str) -> Column:
    at = F.instr(m, "@")
    return F.concat(
        _alphanumerics(F.substr(m, F.lit(1), at - 1), key, F.concat(F.lit("email"), F.lower(F.substr(m, at))), 10),
        F.substr(m, at),
    )


def _secret(m: Column, key: str) -> Column:
    start = F.regexp_extract(m, "^[^\"']*[\"']", 0)
    return F.concat(start, _alphanumerics(F.substr(m, F.length(start) + 1), key, F.lit("secret"), 16))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _in_places(shape: Column, digits: Column) -> Column:
    """The digits of ``shape`` replaced one by one."""

    def one(c: Column, j: Column) -> Column:
        before = F.length(_digits(F.substr(shape, F.lit(1), j)))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(shape), one), "")


def _card(m: Column, key: str) -> Column:
    payload = F.substr(_digits(m), F.lit(1), F.length(_digits(m)) - 1)
    return _bind(
        _alphanumerics(payload, key, F.lit("card"), 10),
        lambda p: _in_places(m, F.concat(p, ((10 - luhn_sum(p, 2) % 10) % 10).cast("string"))),
    )


def _phone(m: Column, key: str) -> Column:
    start = F.regexp_extract(m, r"^(\+[0-9]{1,3}[^0-9]+|\+1|)", 0)
    return F.concat(
        start, _alphanumerics(F.substr(m, F.length(start) + 1), key, F.concat(F.lit("phone"), _digits(start)), 10)
    )


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country = F.substr(plain, F.lit(1), F.lit(2))
    return _bind(
        _alphanumerics(F.substr(m, F.lit(5)), key, F.concat(F.lit("iban"), country), 10),
        lambda rest: F.concat(
            country,
            F.lpad((98 - mod_97(F.concat(F.replace(rest, F.lit(" "), F.lit("")), country, F.lit("00")))).cast("string"), 2, "0"),
            rest,
        ),
    )


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), _number)
    moved = permute(octets, F.transform(octets, lambda _: F.lit(256)), key, F.lit("ipv4"))
    return F.array_join(F.transform(moved, lambda v: v.cast("string")), ".")


def _ssn(m: Column, key: str) -> Column:
    part = F.transform(F.split(m, "-"), _number)
    area = F.get(part, F.lit(0))
    values = F.array(
        F.when(area < 666, area - 1).otherwise(area - 2), F.get(part, F.lit(1)) - 1, F.get(part, F.lit(2)) - 1
    )
    radices = F.array(F.lit(898), F.lit(99), F.lit(9999))

    def render(v: Column) -> Column:
        first = F.get(v, F.lit(0))
        return F.concat_ws(
            "-",
            F.lpad(F.when(first < 665, first + 1).otherwise(first + 2).cast("string"), 3, "0"),
            F.lpad((F.get(v, F.lit(1)) + 1).cast("string"), 2, "0"),
            F.lpad((F.get(v, F.lit(2)) + 1).cast("string"), 4, "0"),
        )

    return _bind(permute(values, radices, key, F.lit("ssn")), render)


#: date forms: pattern, position of year, month and day, format for the result
_DATES = {
    "iso": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", (1, 6, 9), "yyyy-MM-dd"),
    "month_first": (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", (7, 1, 4), "MM/dd/yyyy"),
    "day_first": (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", (7, 4, 1), "dd/MM/yyyy"),
    "dotted": (r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$", (7, 4, 1), "dd.MM.yyyy"),
}


def _day(m: Column, form: str) -> Column:
    """Days since the first day, null unless a day of the calendar in the range."""
    pattern, (y, mo, d), _ = _DATES[form]
    year, month, day = (_number(F.substr(m, F.lit(at), F.lit(n))) for at, n in ((y, 4), (mo, 2), (d, 2)))
    first = F.make_date(year, month, F.lit(1))
    number = F.datediff(F.date_add(first, day - 1), F.lit(FIRST_DAY).cast("date"))
    return F.when(
        m.rlike(pattern) & month.between(1, 12) & (year >= 1900),
        F.when(day.between(1, F.dayofmonth(F.last_day(first))) & (number < DAYS[0] * DAYS[1]), number),
    )


def _date(m: Column, key: str, form: str) -> Column:
    radices = F.array(F.lit(DAYS[0]), F.lit(DAYS[1]))
    values = lambda n: F.array(F.floor(n / DAYS[1]).cast("int"), n % DAYS[1])
    moved = _bind(_day(m, form), lambda n: permute(values(n), radices, key, F.lit("date")))
    return _bind(
        moved,
        lambda v: F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(v, F.lit(0)) * DAYS[1] + F.get(v, F.lit(1))), _DATES[form][2]
        ),
    )


def _rules(m: Column, key: str) -> list[tuple[Column, Column]]:
    """(is valid, pseudonym) for each kind; the first that holds counts."""
    digits = _digits(m)
    octets = F.transform(F.split(m, r"\."), _number)
    area = _number(F.substr(m, F.lit(1), F.lit(3)))
    plain = F.replace(m, F.lit(" "), F.lit(""))
    return [
        (F.contains(m, F.lit("@")), _email(m, key)),
        (m.rlike("[\"']"), _secret(m, key)),
        (
            m.rlike("^[A-Z]{2}[0-9]{2}") & F.length(plain).between(15, 34) & (_iban_rest(plain, F.substr(plain, F.lit(3), F.lit(2))) == 1),
            _iban(m, key),
        ),
        (m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") & F.forall(octets, lambda o: o < 256), _ipv4(m, key)),
        *[(_day(m, form).isNotNull(), _date(m, key, form)) for form in _DATES],
        (
            m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & area.between(1, 899) & (area != 666) & ~m.rlike("-00-|-0000$"),
            _ssn(m, key),
        ),
        (
            m.rlike(r"^(\+|\([0-9]{3}\)|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$)") & F.length(digits).between(8, 15),
            _phone(m, key),
        ),
        (m.rlike("^[0-9][0-9 -]+$") & F.length(digits).between(13, 19) & (luhn_sum(digits, 1) % 10 == 0), _card(m, key)),
    ]


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a candidate, null if it is not valid."""
    result = F.lit(None).cast("string")
    for valid, value in reversed(_rules(m, key)):
        result = F.when(valid, value).otherwise(result)
    return result


def _parts(m: Column) -> Column:
    """A candidate as an array; groups of four digits as the cards among them, from left to right, and single groups."""
    groups = F.regexp_extract_all(m, F.lit("[0-9]{1,4}[ -]?"), F.lit(0))
    state = "struct<parts: array<string>, skip: int>"

    def among(groups: Column) -> Column:
        def window(k: Column, n: int) -> Column:
            return F.array_join(F.slice(groups, k + 1, n), "")

        def valid(text: Column, least: int, most: int) -> Column:
            digits = _digits(text)
            return F.length(digits).between(least, most) & (luhn_sum(digits, 1) % 10 == 0)

        def step(done: Column, k: Column) -> Column:
            def put(text: Column, skip: int) -> Column:
                parts = F.array_append(done["parts"], text)
                return F.struct(parts.alias("parts"), F.lit(skip).alias("skip")).cast(state)

            # inside a run, a card begins like those of the networks: a row of years is none
            starts = (k % 4 == 0) | F.get(groups, k).rlike("^([3-6]|2[2-7])")
            return (
                F.when(done["skip"] > 0, F.struct(done["parts"].alias("parts"), (done["skip"] - 1).alias("skip")).cast(state))
                .when(starts & valid(window(k, 4), 16, 16), put(window(k, 4), 3))
                .when(starts & valid(window(k, 5), 17, 19), put(window(k, 5), 4))
                .otherwise(put(F.get(groups, k), 0))
            )

        none = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("skip")).cast(state)
        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), none, step, lambda done: done["parts"])

    fours = m.rlike("^[0-9]{4}(?:[ -][0-9]{4}){3,}+(?:[ -][0-9]{1,3})?$")
    return F.when(fours, _bind(groups, among)).otherwise(F.array(m))


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with pseudonyms in ``text``, and ``n_private``, the number of values replaced.

    Emails, hexadecimal secrets, IBANs, IPv4 addresses, dates, social security
    numbers, phone numbers and payment cards are replaced if valid; everything
    else stays to the letter. A card in a written form (4-4-4-4, 4-6-5, 4-6-4,
    undivided, digit by digit) is found beside other numbers, in other groups
    only if no number stands next to it. An IBAN ends at its country's length,
    so other words and numbers may follow; one of a country or length not listed
    is found if neither follows. A phone with a country code has 8 to 15 digits,
    ten behind +1, and ends before a date, an address or a social security
    number; a further group of digits within the 15 counts as a part of it. The
    permutation of each kind is bijective on its
    domain, except that a slashed date is read month first where that is
    possible, so two differently written dates can meet.

    Null text stays null with 0 replaced. Repeated rows give equal rows; an
    empty table gives an empty table. A column of ``docs`` named n_private
    comes back beside the new one, which stands last.
    """
    own = Guarded(docs)
    body = own.col(text)
    likely = body.rlike(LIKELY)
    candidates = own.df.withColumns(
        {
            "pieces": F.when(likely, F.split(body, PATTERN, -1)),
            "found": F.when(likely, F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0))),
        }
    )
    parted = candidates.withColumn("found", F.transform("found", _parts))
    changed = parted.withColumn("names", F.transform("found", lambda parts: F.transform(parts, lambda m: pseudonym(m, key))))
    named = lambda names, parts: F.array_join(F.zip_with(names, parts, lambda p, m: F.coalesce(p, m)), "")
    values = F.concat(F.zip_with("names", "found", named), F.array(F.lit("")))
    joined = F.array_join(F.flatten(F.zip_with("pieces", values, lambda a, b: F.array(a, b))), "")
    count = F.size(F.filter(F.flatten("names"), lambda p: p.isNotNull()))
    return changed.select(
        *own.with_text(text, F.when(F.size("found") > 0, joined).otherwise(body)),
        F.when(F.col("names").isNotNull(), count).otherwise(0).cast("long").alias("n_private"),
    )
