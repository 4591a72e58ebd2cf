"""Operator 10: format-preserving Feistel pseudonyms for personal data.

Card numbers, phone numbers, IPv4 addresses, social security numbers, IBANs,
dates and e-mail addresses are found by pattern and validated (Luhn, number
plan, octets, mod 97, calendar). A validated value is a number in the finite domain of
its format; a keyed Feistel network over two mixed-radix halves permutes that
domain, check digits are computed anew, and the digits go back between the
signs they came from. Local parts of e-mail addresses are permuted letter by
letter within their classes, also by a Feistel network. Each is a bijection under
the key: equal values stay equal in all documents and different values stay
different. All of it is SQL expressions inside the row; nothing is shuffled.

Results by case: a null text stays null, a text without validated values is
unchanged; values that fail validation stay as they are; dates outside 1900 to
2099 stay too. Slash dates are read month first and, where that is no date, day
first. An IBAN ends where its country's length says, so what follows it can't
spoil it. Repeated rows get equal results. ``protect`` replaces columns named
n_pii and pii_kinds and keeps the others whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bind, quoted

ROUNDS = 8
#: For tests and examples only; real runs pass a secret key.
KEY = "not a secret"

#: The length of an IBAN by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}


def _iban_pattern() -> str:
    """One alternative for each length; blanks may stand before every fourth character."""
    ways = []
    for n, countries in IBAN_LENGTHS.items():
        full, rest = divmod(n - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        ways.append(f"(?:{'|'.join(countries.split())})\\d{{2}}(?: ?[A-Z0-9]{{4}}){{{full}}}{tail}")
    return f"\\b(?=[A-Z]{{2}}\\d{{2}})(?:{'|'.join(ways)})(?![A-Za-z0-9])"


#: Fixed patterns, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,254}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){1,126}",  # bounded: long runs stay linear
    "iban": _iban_pattern(),
    "date": r"(?<![\d.])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{3})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\d-])",
    "phone": r"(?<![\d])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "intl": r"(?<![\d+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\d)",
}
ANY = "|".join(PATTERNS.values())


def div(x: Column, by: int) -> Column:
    """Whole-number division; ``/`` would go through doubles, which are exact only below 2^53."""
    return F.call_function("div", x, F.lit(by))


def _keyed(key: str, *parts: Column) -> Column:
    """52 pseudo-random bits from the key and the parts."""
    mixed = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(mixed, 256), 1, 13), 16, 10).cast("long")


def permute(x: Column, left: int, right: int, key: str, label: str | Column) -> Column:
    """A keyed permutation of 0 .. left * right - 1: an alternating Feistel network over both radices."""
    tag = F.lit(label) if isinstance(label, str) else label
    halves = F.struct(div(x, right).alias("l"), F.pmod(x, F.lit(right)).cast("long").alias("r"))
    done = F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        halves,
        lambda s, i: F.when(
            i % 2 == 0, F.struct(((s["l"] + _keyed(key, tag, i, s["r"])) % left).alias("l"), s["r"].alias("r"))
        ).otherwise(F.struct(s["l"].alias("l"), ((s["r"] + _keyed(key, tag, i, s["l"])) % right).alias("r"))),
    )
    return bind(done, lambda s: s["l"] * right + s["r"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _padded(x: Column, width: int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def put_back(template: Column, new: Column) -> Column:
    """``template`` with its digits replaced in order by those of ``new``."""
    char = lambda i: F.substring(template, i, F.lit(1))
    place = lambda i: F.length(digits(F.substring(template, F.lit(1), i)))
    each = lambda i: F.when(char(i).rlike("[0-9]"), F.substring(new, place(i), F.lit(1))).otherwise(char(i))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(template)), each), "")


def luhn_sum(number: Column) -> Column:
    """The Luhn sum of a digit string, its last digit counted once."""
    places = F.sequence(F.lit(1), F.length(number))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(places, F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    def body(number: Column) -> Column:
        # The first digit names the network and stays; the last is the check digit.
        width = F.length(number) - 2
        inner = F.substring(number, F.lit(2), width).cast("long")
        half = {n: (10 ** ((n - 1) // 2), 10 ** ((n - 2) // 2)) for n in range(13, 20)}
        made = None
        for n, (a, b) in half.items():
            one = _padded(permute(inner, a, b, key, F.concat(F.lit(f"card{n}:"), F.substring(number, 1, 1))), n - 2)
            made = F.when(F.length(number) == n, one) if made is None else made.when(F.length(number) == n, one)
        return bind(
            F.concat(F.substring(number, 1, 1), made),
            lambda head: F.concat(head, F.pmod(10 - luhn_sum(F.concat(head, F.lit("0"))) % 10, F.lit(10)).cast("string")),
        )

    return bind(bind(digits(value), body), lambda new: put_back(value, new))


def _phone(value: Column, key: str) -> Column:
    def body(number: Column) -> Column:
        # The last ten digits; area and exchange that start with 2-9 form the number plan, others a class of their own.
        head = F.substring(number, F.lit(1), F.length(number) - 10)
        tail = F.substring(number, F.length(number) - 9, F.lit(10))
        first, second = F.substring(tail, 1, 1), F.substring(tail, 4, 1)
        planned = first.between("2", "9") & second.between("2", "9")
        area = F.substring(tail, 1, 3).cast("long") - 200
        rest = F.substring(tail, 4, 7).cast("long") - 2000000
        inside = bind(
            permute(area * 8000000 + rest, 800, 8000000, key, F.concat(F.lit("phone:"), head)),
            lambda x: F.concat((div(x, 8000000) + 200).cast("string"), (x % 8000000 + 2000000).cast("string")),
        )
        free = F.concat(F.substring(tail, 2, 2), F.substring(tail, 5, 6)).cast("long")
        outside = bind(
            _padded(permute(free, 10000, 10000, key, F.concat(F.lit("phone:"), head, F.lit(":"), first, second)), 8),
            lambda x: F.concat(first, F.substring(x, 1, 2), second, F.substring(x, 3, 6)),
        )
        return F.concat(head, F.when(planned, inside).otherwise(outside))

    return bind(bind(digits(value), body), lambda new: put_back(value, new))


def _intl(value: Column, key: str) -> Column:
    """International numbers: the country code stays, the digits after it are permuted among all of their count."""
    code = F.regexp_extract(value, r"^\+(\d{1,3})", 1)

    def body(number: Column) -> Column:
        head = F.substring(number, F.lit(1), F.length(code))
        rest = F.substring(number, F.length(code) + 1, F.lit(15))
        made = None
        for n in range(5, 15):
            one = _padded(permute(rest.cast("long"), 10 ** (n // 2), 10 ** (n - n // 2), key, F.concat(F.lit(f"intl{n}:"), head)), n)
            made = F.when(F.length(rest) == n, one) if made is None else made.when(F.length(rest) == n, one)
        return F.concat(head, made)

    return bind(bind(digits(value), body), lambda new: put_back(value, new))


def _ip(value: Column, key: str) -> Column:
    def body(parts: Column) -> Column:
        x = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n * 256 + p.cast("long"))
        return bind(
            permute(x, 65536, 65536, key, "ip"),
            lambda y: F.concat_ws(".", *[F.shiftright(y, 24 - 8 * i).bitwiseAND(255).cast("string") for i in range(4)]),
        )

    return bind(F.split(value, r"\."), body)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    x = (area - F.when(area > 666, 2).otherwise(1)) * 989901 + (group - 1) * 9999 + serial - 1

    def body(y: Column) -> Column:
        top = div(y, 989901) + 1
        low = y % 989901
        return F.concat_ws(
            "-", _padded(top + F.when(top >= 666, 1).otherwise(0), 3),
            _padded(div(low, 9999) + 1, 2), _padded(low % 9999 + 1, 4),
        )

    return bind(permute(x, 898, 989901, key, "ssn"), body)


FIRST_DAY, DAYS = "1900-01-01", 73049
FORMATS = (("-", "yyyy-MM-dd"), ("/", "MM/dd/yyyy"), (".", "dd.MM.yyyy"))


def _as_day(value: Column, day_at: int, month_at: int) -> Column:
    return F.try_to_date(F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, month_at, 2), F.substring(value, day_at, 2)), "yyyy-MM-dd")


def _day(value: Column) -> Column:
    """The date a value names, null where the calendar has none."""
    dotted = _as_day(value, 1, 4)
    slashed = F.coalesce(_as_day(value, 4, 1), dotted)
    return F.when(value.contains("-"), F.try_to_date(value, "yyyy-MM-dd")).when(value.contains("/"), slashed).otherwise(dotted)


def _date(value: Column, key: str) -> Column:
    # 319 * 229 days: all from 1900 to 2099.
    offset = F.datediff(_day(value), F.lit(FIRST_DAY).cast("date")).cast("long")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), permute(offset, 319, 229, key, "date").cast("int"))
    shown = [(value.contains(sign), F.date_format(new, shape)) for sign, shape in FORMATS]
    day_first = value.contains("/") & _as_day(value, 4, 1).isNull()
    return F.when(day_first, _day_first(value, key)).when(*shown[0]).when(*shown[1]).otherwise(shown[2][1])


LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)


def _day_first(value: Column, key: str) -> Column:
    """A slash date that only reads day first: permuted among such dates, by whether its month need have that day."""
    day, month, year = (F.substring(value, a, n).cast("long") for a, n in ((1, 2), (4, 2), (7, 4)))
    y = year - 1900
    at = F.array_position(F.array(*[F.lit(m) for m in LONG_MONTHS]), month.cast("int")) - 1

    def shown(d: Column, m: Column, years: Column) -> Column:
        return F.concat_ws("/", _padded(d, 2), _padded(m, 2), (years + 1900).cast("string"))

    common = bind(
        permute((y * 12 + month - 1) * 16 + day - 13, 2400, 16, key, "day<29"),
        lambda x: shown(x % 16 + 13, div(x, 16) % 12 + 1, div(x, 192)),
    )
    # Eleven months, all but February, have a 29th and 30th in every year.
    late = bind(
        permute(y * 22 + F.when(month == 1, 0).otherwise(month - 2) * 2 + day - 29, 200, 22, key, "day<31"),
        lambda x: bind(div(x, 2) % 11, lambda m: shown(x % 2 + 29, F.when(m == 0, 1).otherwise(m + 2), div(x, 22))),
    )
    last = bind(
        permute(y * 7 + at, 200, 7, key, "day31"),
        lambda x: shown(F.lit(31), F.get(F.array(*[F.lit(m) for m in LONG_MONTHS]), (x % 7).cast("int")), div(x, 7)),
    )
    # The 49 leap years from 1904 to 2096.
    leap = bind(permute(div(year - 1904, 4), 7, 7, key, "leap"), lambda x: shown(F.lit(29), F.lit(2), x * 4 + 4))
    return F.when(day < 29, common).when(day == 31, last).when(month == 2, leap).otherwise(late)


ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def permute_chars(value: Column, key: str, label: Column) -> Column:
    """A keyed permutation of strings that keeps each character's class and all other signs.

    Each round shifts the characters of one half within their alphabets by
    amounts that depend on the other half.
    """
    cut_at = F.ceil(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut_at).alias("a"), F.substring(value, cut_at + 1, F.length(value)).alias("b"))

    def shifted(half: Column, other: Column, turn: Column) -> Column:
        def each(i: Column) -> Column:
            char = F.substring(half, i, F.lit(1))
            by = _keyed(key, label, turn, i, F.length(half), other)
            moved = char
            for letters in ALPHABETS:
                at = F.instr(F.lit(letters), char)
                new = F.substring(F.lit(letters), ((at - 1 + by) % len(letters) + 1).cast("int"), F.lit(1))
                moved = F.when(at > 0, new).otherwise(moved)
            return moved

        return F.when(F.length(half) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), each), "")).otherwise("")

    done = F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        start,
        lambda s, i: F.when(i % 2 == 0, F.struct(shifted(s["a"], s["b"], i).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), shifted(s["b"], s["a"], i).alias("b"))
        ),
    )
    return bind(done, lambda s: F.concat(s["a"], s["b"]))


def _email(value: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(permute_chars(local, key, F.concat(F.lit("email:"), F.lower(domain))), F.lit("@"), domain)


def _mod97(value: Column) -> Column:
    """An IBAN's remainder, its first four characters moved to the end and letters read as 10 to 35."""
    turned = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))

    def add(n: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (n * 10 + code - 48) % 97).otherwise((n * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    def body(plain: Column) -> Column:
        country = F.substring(plain, 1, 2)
        account = permute_chars(F.substring(plain, F.lit(5), F.length(plain)), key, F.concat(F.lit("iban:"), country))
        made = bind(
            F.concat(country, F.lit("00"), account),
            lambda x: F.concat(country, _padded(98 - _mod97(x), 2), F.substring(x, F.lit(5), F.length(x))),
        )
        return bind(
            made,
            lambda new: F.array_join(
                F.transform(
                    F.sequence(F.lit(1), F.length(value)),
                    lambda i: F.when(F.substring(value, i, F.lit(1)) == " ", " ").otherwise(
                        F.substring(new, F.length(F.replace(F.substring(value, F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1))
                    ),
                ),
                "",
            ),
        )

    return bind(F.replace(value, F.lit(" "), F.lit("")), body)


def kind_of(value: Column) -> Column:
    """The kind of a match that passes validation, or null."""
    whole = {name: value.rlike(f"^(?:{pattern})$") for name, pattern in PATTERNS.items()}
    area, group, serial = (F.substring(value, a, n) for a, n in ((1, 3), (5, 2), (8, 4)))
    return (
        F.when(whole["email"], "email")
        .when(whole["iban"] & (_mod97(F.replace(value, F.lit(" "), F.lit(""))) == 1), "iban")
        .when(whole["date"] & F.year(_day(value)).between(1900, 2099), "date")
        .when(whole["ip"] & F.forall(F.split(value, r"\."), lambda p: p.cast("int") <= 255), "ip")
        .when(whole["ssn"] & (area != "000") & (area != "666") & (area < "900") & (group != "00") & (serial != "0000"), "ssn")
        .when(whole["card"] & (luhn_sum(digits(value)) % 10 == 0), "card")
        .when(whole["phone"], "phone")
        .when(whole["intl"] & F.length(digits(value)).between(8, 15) & (F.length(digits(value)) - F.length(F.regexp_extract(value, r"^\+(\d{1,3})", 1)) >= 5), "intl")
    )


def pseudonym(value: Column, kind: Column, key: str = KEY) -> Column:
    """The pseudonym of a validated value, the value itself where the kind is null."""
    made = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "card": _card, "phone": _phone, "intl": _intl}
    chosen = F.when(F.lit(False), value)
    for name, maker in made.items():
        chosen = chosen.when(kind == name, maker(value, key))
    return chosen.otherwise(value)


def protect(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of ``docs``, personal data in ``text`` replaced, with n_pii and pii_kinds, the kinds in text order."""
    names = [c for c in docs.columns if c not in ("n_pii", "pii_kinds")]
    rest = F.struct(*[F.col(quoted(c)) for c in names if c != "text"]) if len(names) > 1 else F.lit(None)
    # Only texts with a candidate pay for more than one pass.
    some = F.col("text").rlike(ANY)
    found = F.when(some, F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(0)))
    made = F.transform(found, lambda v: bind(kind_of(v), lambda k: F.struct(k.alias("kind"), pseudonym(v, k, key).alias("new"))))
    marked = docs.select(rest.alias("rest"), "text", made.alias("made"))
    pieces = F.split("text", f"(?:{ANY})")
    joined = F.array_join(F.zip_with(pieces, "made", lambda piece, x: F.concat(piece, F.coalesce(x["new"], F.lit("")))), "")
    kinds = F.filter(F.transform("made", lambda x: x["kind"]), lambda k: k.isNotNull())
    text = F.when(F.col("made").isNull(), F.col("text")).otherwise(joined)
    listed = F.coalesce(kinds, F.array().cast("array<string>"))
    columns = [text if c == "text" else F.col(f"rest.{quoted(c)}") for c in names]
    return marked.select(*columns, F.size(listed).cast("long"), F.array_join(listed, ",")).toDF(*names, "n_pii", "pii_kinds")
