"""Personal data: format-preserving Feistel pseudonyms (DataFrame operations only).

Candidates are found by one pattern, told apart by kind and validated (card
numbers by their check digit, dates by the calendar, addresses by their octets,
social security numbers by the ranges of their groups, telephone numbers by
their layout); what
does not validate stays as it is.  A valid value is replaced by its image under
a keyed permutation of all valid values of the same format: separators, length
and kind stay, check digits are right, and equal values get equal pseudonyms in
every document, so they stay linked.  Who has the key can invert it.  Secrets
keep each character's class (upper case, lower case, digit), each class permuted
in its places; mail names are linked without regard to case and keep theirs.
Dates of 1900 to 2099 stay among themselves, as do those of other years from 0001
to 9999.  A telephone number has a country code, an area in brackets or marks
between its groups; three groups between spaces count only with a proper area and
exchange, since other numbers look like that.

The permutation is an alternating Feistel network over the two halves of a
string of digits of any radix; the round function is a keyed SHA-256.  Where a
format has invalid strings, the permutation is repeated until the image is
valid (cycle walking), which is a permutation of the valid ones.  Strings of
more than 20 digits are permuted piece by piece, each under the pieces before.

Scale: a narrow transformation.  No shuffle, no state; texts without a digit
or an ``@`` are passed through at the price of one scan.

Defined results: a null text stays null and has no findings; an empty text
stays empty; repeated rows are treated alike; an empty table gives an empty
result; further columns are kept, and findings come in columns of fresh names
given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
PIECE = 20
WALK = 64
FIRST_DAY, DAYS = "1900-01-01", 73049        # to 2099-12-31
EARLIEST, BEFORE, OTHER_DAYS = "0001-01-01", 693595, 3579010     # days before these, and all others to 9999

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
_DATE = (r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)")
_PHONE = r"(?<![\dA-Za-z])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\dA-Za-z])"
_SSN = r"(?<![\dA-Za-z-])\d{3}-\d{2}-\d{4}(?![\dA-Za-z-])"
_CARD = r"(?<![\dA-Za-z])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])"
_SECRET = r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|(?:password|passwd|token|secret|api_key) ?[=:] ?\"?[0-9A-Za-z]{8,})"
#: kind -> pattern, in the order in which they are tried
KINDS = {"email": _EMAIL, "ip": _IP, "date": _DATE, "ssn": _SSN, "phone": _PHONE, "card": _CARD,
         "secret": _SECRET}
PATTERN = "|".join(KINDS.values())

_LETTERS, _BASE26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"
_CAPITALS, _DIGITS = _LETTERS.upper(), "0123456789"

Perm = Callable[[Column], Column]


def _power(radix: int, n: Column) -> Column:
    return F.pow(F.lit(float(radix)), n).cast("decimal(38,0)")


def _feistel(s: Column, radix: int, key: str, tweak: Column) -> Column:
    """The image of a string of at most 20 digits (lower case for letters)."""
    left, right = F.floor(F.length(s) / 2), F.length(s) - F.floor(F.length(s) / 2)
    first, second = F.substring(s, F.lit(1), left), F.substring(s, left + 1, right)

    def number(x: Column) -> Column:
        return F.coalesce(F.conv(F.when(x == "", "0").otherwise(x), radix, 10), F.lit("0")).cast("decimal(38,0)")

    def step(st: Column, i: Column) -> Column:
        width = F.when(i % 2 == 0, left).otherwise(right)
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, F.length(s).cast("string"),
                                    i.cast("string"), st["b"].cast("string")).cast("binary"), 256)
        f = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
        mixed = F.pmod(st["a"] + f, _power(radix, width)).cast("decimal(38,0)")
        return F.struct(st["b"].alias("a"), mixed.alias("b"))

    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                      F.struct(number(first).alias("a"), number(second).alias("b")), step)

    def text(x: Column, width: Column) -> Column:
        digits = F.lower(F.conv(x.cast("string"), 10, radix))
        return F.when(width == 0, "").otherwise(F.lpad(digits, width.cast("int"), "0"))

    # evaluated once: both halves are read from one struct
    return F.element_at(F.transform(F.array(end), lambda e: F.concat(
        text(e["a"], left), text(e["b"], right))), 1)


def permuted(s: Column, radix: int, key: str, tweak: str | Column) -> Column:
    """The keyed permutation of the strings of one length over the first
    ``radix`` of 0-9a-z."""
    tweak = F.lit(tweak) if isinstance(tweak, str) else tweak
    pieces = F.sequence(F.lit(0), F.floor((F.length(s) - 1) / PIECE).cast("int"))
    return F.when(F.length(s) == 0, s).otherwise(F.array_join(F.transform(
        pieces, lambda i: _feistel(F.substring(s, i * PIECE + 1, F.lit(PIECE)), radix, key,
                                   F.concat(tweak, F.lit("|"), F.substring(s, F.lit(1), i * PIECE)))), ""))


def _walk(s: Column, step: Perm, valid: Callable[[Column], Column]) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(s),
                       lambda x, _: F.when(valid(x), x).otherwise(step(x)))


def _only(s: Column, kept: str) -> Column:
    return F.regexp_replace(s, f"[^{kept}]", "")


def _refill(form: Column, digits: Column, kept: str) -> Column:
    """``form`` with its characters of class ``kept`` replaced in turn."""
    chars = F.split(form, "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike(f"^[{kept}]$"),
        F.substring(digits, F.length(_only(F.substring(form, F.lit(1), i + 1), kept)), F.lit(1))
    ).otherwise(c)), "")


def _luhn_sum(digits: Column) -> Column:
    """Of a number whose last digit is yet to come: doubles from the right."""
    n = F.length(digits)
    return F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda a, i: a + F.element_at(
            F.transform(F.array(F.substring(digits, i, F.lit(1)).cast("int")), lambda d: F.when(
                (n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)), 1))


def _check_digit(digits: Column) -> Column:
    return F.pmod(10 - _luhn_sum(digits) % 10, F.lit(10)).cast("string")


def _card(m: Column, key: str) -> Column:
    d = _only(m, "0-9")
    body = F.substring(d, F.lit(2), F.length(d) - 2)
    new = F.concat(F.substring(d, 1, 1), permuted(body, 10, key, "card"))
    ok = _check_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, -1, 1)
    return F.when(ok, F.element_at(F.transform(
        F.array(new), lambda x: _refill(m, F.concat(x, _check_digit(x)), "0-9")), 1))


def _phone(m: Column, key: str) -> Column:
    d = _only(m, "0-9")
    national = F.substring(d, -10, 10)
    # numbers with and without a proper area and exchange keep to themselves
    proper = lambda x: x.rlike("^[2-9][0-9]{2}[2-9]")
    country = F.substring(d, F.lit(1), F.length(d) - 10)
    new = _walk(national, lambda x: permuted(x, 10, key, "phone"), lambda x: proper(x) == proper(national))
    laid_out = m.rlike(r"[+(]|\d[.-]\d{3}[.-]\d") | proper(national)
    return F.when(laid_out, _refill(m, F.concat(country, new), "0-9"))


def _ssn(m: Column, key: str) -> Column:
    valid = lambda x: x.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$")
    d = _only(m, "0-9")
    return F.when(valid(d), _refill(m, _walk(d, lambda x: permuted(x, 10, key, "ssn"), valid), "0-9"))


def _ip(m: Column, key: str) -> Column:
    parts = F.split(m, r"\.")
    ok = F.forall(parts, lambda p: p.cast("int") < 256)
    as_hex = F.array_join(F.transform(parts, lambda p: F.lower(F.lpad(F.hex(p.cast("int")), 2, "0"))), "")
    return F.when(ok, F.element_at(F.transform(F.array(permuted(as_hex, 16, key, "ip")), lambda x: F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(3)),
                    lambda i: F.conv(F.substring(x, 2 * i + 1, F.lit(2)), 16, 10)), ".")), 1))


def _date(m: Column, key: str) -> Column:
    def image(day: Column) -> Column:
        n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        usual = (n >= 0) & (n < DAYS)
        # the other years as one row of days, with these left out
        m = F.datediff(day, F.lit(EARLIEST).cast("date"))
        m = F.when(m < BEFORE, m).otherwise(m - DAYS)

        def among(x: Column, width: int, many: int, tweak: str) -> Column:
            return _walk(F.lpad(x.cast("string"), width, "0"), lambda y: permuted(y, 10, key, tweak),
                         lambda y: y.cast("int") < many).cast("int")

        other = F.element_at(F.transform(F.array(among(m, 7, OTHER_DAYS, "other date")), lambda x: F.date_add(
            F.lit(EARLIEST).cast("date"), F.when(x < BEFORE, x).otherwise(x + DAYS))), 1)
        return F.when(usual, F.date_add(F.lit(FIRST_DAY).cast("date"), among(n, 5, DAYS, "date"))).otherwise(
            F.when((m >= 0) & (m < OTHER_DAYS), other))

    def like(layouts: list[str]) -> Column:
        out = None
        for layout in layouts:
            day = F.to_date(F.try_to_timestamp(m, F.lit(layout)))
            new = F.date_format(image(day), layout)
            out = F.coalesce(out, new) if out is not None else new
        return out

    padded = m.rlike(r"^\d\d[./]\d\d[./]")
    return (F.when(m.contains("-"), like(["yyyy-MM-dd"]))
            .when(m.contains("/") & padded, like(["MM/dd/yyyy", "dd/MM/yyyy"]))
            .when(m.contains("/"), like(["M/d/yyyy", "d/M/yyyy"]))
            .when(padded, like(["dd.MM.yyyy"])).otherwise(like(["d.M.yyyy"])))


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    domain = F.substring(m, F.length(name) + 1, F.length(m))
    letters = permuted(F.translate(_only(F.lower(name), "a-z"), _LETTERS, _BASE26), 26, key, "email")
    digits = permuted(_only(name, "0-9"), 10, key, "email")
    new = _refill(_refill(name, F.translate(letters, _BASE26, _LETTERS), "A-Za-z"), digits, "0-9")
    cased = F.array_join(F.zip_with(F.split(new, ""), F.split(name, ""), lambda c, old: F.when(
        old.rlike("^[A-Z]$"), F.upper(c)).otherwise(c)), "")
    return F.concat(cased, domain)


def _secret(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"^(AKIA|[a-z_]+ ?[=:] ?\"?)", 1)
    value = F.substring(m, F.length(head) + 1, F.length(m))
    is_hex = value.rlike("^[0-9a-f]+$")
    # which places hold which class; each class is permuted in its places
    form = F.translate(value, _DIGITS + _LETTERS + _CAPITALS, "0" * 10 + "a" * 26 + "A" * 26)
    lower = F.translate(permuted(F.translate(_only(value, "a-z"), _LETTERS, _BASE26), 26, key,
                                 F.concat(F.lit("lower|"), form)), _BASE26, _LETTERS)
    upper = F.translate(permuted(F.translate(_only(value, "A-Z"), _CAPITALS, _BASE26), 26, key,
                                 F.concat(F.lit("upper|"), form)), _BASE26, _CAPITALS)
    digits = permuted(_only(value, "0-9"), 10, key, F.concat(F.lit("digit|"), form))
    mixed = _refill(_refill(_refill(value, lower, "a-z"), upper, "A-Z"), digits, "0-9")
    return F.concat(head, F.when(is_hex, permuted(value, 16, key, "hex")).otherwise(mixed))


_IMAGES = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
           "secret": _secret}


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a candidate; null if it does not validate."""
    out = None
    for kind, pattern in KINDS.items():
        whole = m.rlike(f"^(?:{pattern})$")
        image = _IMAGES[kind](m, key)
        out = F.when(whole, image) if out is None else out.when(whole, image)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str = "n_private") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and a column
    ``found`` with the number of values replaced."""
    if found.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {found!r} already")
    t = F.col(f"`{text}`")
    empty = F.array().cast("array<struct<old:string,new:string>>")
    marks = F.when(t.rlike("[0-9@]|AKIA|[=:]"), F.transform(
        F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)),
        lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))).otherwise(empty)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = docs.select(row.alias("row"), marks.alias("marks"))
    t = F.col(f"row.`{text}`")
    between = F.split(t, PATTERN)
    new = F.array_join(F.zip_with(between, "marks", lambda gap, m: F.concat(
        gap, F.coalesce(m["new"], m["old"], F.lit("")))), "")
    return df.select(
        *[F.when(F.size("marks") > 0, new).otherwise(t).alias(c) if c == text
          else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
        F.size(F.filter("marks", lambda m: m["new"].isNotNull())).cast("long").alias(found))
