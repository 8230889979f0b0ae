"""Format-preserving pseudonyms for personal data, with built-in functions only.

Values are found by their form and validated: card numbers by the Luhn digit and a length of
13 to 19, IPv4 addresses by their octets, dates by the calendar (1900 to 2099), telephone
numbers with a country code by their layout, secrets as 32 and more hexadecimal digits
holding both letters and figures. A valid value is replaced by a keyed
permutation of its format's value space, an unbalanced Feistel network whose round function
is SHA-256 over key, round and half. Being a permutation, it maps equal values alike in every
document and never two values of a format to one; the layout (separators, brackets, case,
check digit) stays. A date with slashes may be meant day first or month first, so the strings
of a layout are permuted among themselves: all that can be read both ways, and days 13 to 28,
29 to 31 and 29 February apart, each of which is a product of sizes. Mail addresses have no numeric form: the part before the ``@`` becomes a
keyed digest, the domain stays.

A text is cut at the matches of one pattern, the matches are transformed as an array and the
parts are joined again, so a text of any length is treated whole. Texts without a figure and
without ``@`` skip all of it. Numbers that fail validation stay as they are.

Defined cases: a null text stays null, an empty one empty; every row is treated alike and
kept; equal rows give equal rows; other columns go along untouched, except ``n_chars``, which
follows the text where it is present. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "corpus-pseudonym-1"
ROUNDS = 8

#: What each kind looks like. Possessive quantifiers and look-behinds keep the search linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])\+[0-9]{1,3} ?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
        r"(?![0-9]|[./-][0-9])")
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])"
CARD = (r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}+|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
ANY = "|".join((EMAIL, PHONE, IP, DATE, SECRET, CARD))
YEARS = (1900, 2099)
#: The days from the 29th on of all months but February, as month * 100 + day.
LATE = [m * 100 + d for m in range(1, 13) for d in (29, 30, 31) if m != 2 and (d < 31 or m not in (4, 6, 9, 11))]


def digest(key: str, kind: str, rnd: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), rnd.cast("string"), value.cast("string")), 256)


def number(hexes: Column) -> Column:
    """52 bits of a digest as a long."""
    return F.conv(F.substring(hexes, 1, 13), 16, 10).cast("long")


def rounds(start: Column, step) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, kind: str, key: str) -> Column:
    """A permutation of pairs below the two sizes, as ``struct(l, r)``."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        left_turn = F.struct(F.pmod(s["l"] + number(digest(key, kind, i, s["r"])), left_size).cast("long").alias("l"),
                             s["r"].alias("r"))
        right_turn = F.struct(s["l"].alias("l"),
                              F.pmod(s["r"] + number(digest(key, kind, i, s["l"])), right_size).cast("long").alias("r"))
        return F.when(i % 2 == 1, left_turn).otherwise(right_turn)

    return rounds(start, step)


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """A permutation of the strings of 2 to 18 figures of one length."""
    n = F.length(digits)
    u = (n + 1) / 2
    u = F.floor(u).cast("int")
    pair = feistel(F.substr(digits, F.lit(1), u), F.substr(digits, u + 1), F.pow(F.lit(10), u).cast("long"),
                   F.pow(F.lit(10), n - u).cast("long"), kind, key)
    # one evaluation of the network: the pair goes through a one-element array
    return F.transform(F.array(pair), lambda p: F.concat(
        F.lpad(p["l"].cast("string"), u, F.lit("0")), F.lpad(p["r"].cast("string"), n - u, F.lit("0"))))[0]


def in_place(shape: Column, digits: Column) -> Column:
    """The figures of ``shape`` replaced by ``digits`` in order; other characters stay."""
    start = F.struct(F.lit("").alias("out"), digits.alias("rest"))

    def step(s: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substring(s["rest"], 1, 1)).alias("out"),
                                                   F.substr(s["rest"], F.lit(2)).alias("rest"))
                      ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["rest"].alias("rest")))

    return F.aggregate(F.split(shape, ""), start, step)["out"]


def figures(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def card(value: Column, key: str) -> Column:
    digits = figures(value)
    body = permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), "card", key)
    with_check = F.transform(F.array(body), lambda b: F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(b, d.cast("string"))), luhn)[0])[0]
    return F.when(luhn(digits), in_place(value, with_check)).otherwise(value)


def phone(value: Column, key: str) -> Column:
    digits = figures(value)
    n = F.length(digits)
    return in_place(value, F.concat(F.substr(digits, F.lit(1), n - 10), permuted_digits(
        F.substr(digits, n - 9), "phone", key)))


def ip(value: Column, key: str) -> Column:
    o = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), "ip", key)
    new = F.transform(F.array(pair), lambda p: F.concat_ws(
        ".", *(F.floor(x).cast("string") for s in "lr" for x in (p[s] / 256, p[s] % 256))))[0]
    return F.when(F.forall(o, lambda x: x < 256), new).otherwise(value)


def date(value: Column, key: str) -> Column:
    iso, slashes = value.rlike("^[0-9]{4}-"), value.contains("/")
    parts = F.transform(F.split(value, "[-/.]"), lambda x: x.cast("int"))
    year, one, two = F.when(iso, parts[0]).otherwise(parts[2]), F.when(iso, parts[2]).otherwise(parts[0]), parts[1]
    month_first = slashes & (one <= 12) & (two > 12)
    day, month = F.when(month_first, two).otherwise(one), F.when(month_first, one).otherwise(two)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    length = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = year.between(*YEARS) & month.between(1, 12) & day.between(1, length)
    late = F.array(*map(F.lit, LATE))
    early, middle, odd = day <= 12, day <= 28, month == 2
    since, leaps = year - YEARS[0], F.floor((year - YEARS[0] - 4) / 4)
    years = F.lit(YEARS[1] - YEARS[0] + 1)

    def of_class(*values: Column) -> Column:
        return F.when(early, values[0]).when(middle, values[1]).when(odd, values[2]).otherwise(values[3])

    left = of_class((day - 1) * 12 + month - 1, (month - 1) * 16 + day - 13, F.floor(leaps / 7), F.array_position(late, month * 100 + day) - 1)
    pair = feistel(left, of_class(since, since, leaps % 7, since), of_class(*map(F.lit, (144, 192, 7, len(LATE)))),
                   of_class(years, years, F.lit(7), years), "date", key)

    def written(p: Column) -> Column:
        at = F.get(late, p["l"].cast("int"))
        d = of_class(F.floor(p["l"] / 12) + 1, p["l"] % 16 + 13, F.lit(29), at % 100)
        m = of_class(p["l"] % 12 + 1, F.floor(p["l"] / 16) + 1, F.lit(2), F.floor(at / 100))
        y = of_class(p["r"], p["r"], (p["l"] * 7 + p["r"] + 1) * 4, p["r"]) + YEARS[0]
        yyyy, mm, dd = (F.lpad(x.cast("int").cast("string"), n, F.lit("0")) for x, n in ((y, 4), (m, 2), (d, 2)))
        return F.when(iso, F.concat_ws("-", yyyy, mm, dd)).when(month_first, F.concat_ws("/", mm, dd, yyyy)).when(
            slashes, F.concat_ws("/", dd, mm, yyyy)).otherwise(F.concat_ws(".", dd, mm, yyyy))

    return F.when(valid, F.transform(F.array(pair), written)[0]).otherwise(value)


def secret(value: Column, key: str) -> Column:
    """Halves of hexadecimal digits; a round adds digits of a digest to one half, digit by digit."""
    n = F.length(value)
    u = F.floor(n / 2).cast("int")
    low = F.lower(value)
    start = F.struct(F.substr(low, F.lit(1), u).alias("l"), F.substr(low, u + 1).alias("r"))

    def nibble(c: Column) -> Column:
        return F.instr(F.lit("0123456789abcdef"), c) - 1

    def added(half: Column, rnd: Column, by: Column) -> Column:
        # as many digests as the half is long
        keys = F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(half) - 1) / 64).cast("int")),
                                        lambda j: digest(key, "secret", F.concat_ws(".", rnd.cast("string"), j.cast("string")), by)), "")
        return F.array_join(F.zip_with(
            F.split(half, ""), F.split(F.substr(keys, F.lit(1), F.length(half)), ""),
            lambda a, b: F.lower(F.hex((nibble(a) + nibble(b)) % 16))), "")

    def step(s: Column, i: Column) -> Column:
        return (F.when(i % 2 == 1, F.struct(added(s["l"], i, s["r"]).alias("l"), s["r"].alias("r")))
                .otherwise(F.struct(s["l"].alias("l"), added(s["r"], i, s["l"]).alias("r"))))

    new = F.transform(F.array(rounds(start, step)), lambda p: F.concat(p["l"], p["r"]))[0]
    new = F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new)
    return F.when(low.rlike("[a-f]") & value.rlike("[0-9]"), new).otherwise(value)


def email(value: Column, key: str) -> Column:
    at = F.instr(value, "@")
    local = F.lower(F.substr(value, F.lit(1), at - 1))
    return F.concat(F.lit("u"), F.substring(digest(key, "email", F.lit(0), local), 1, 16), F.substr(value, at))


def pseudonym(value: Column, key: str) -> Column:
    return (F.when(value.contains("@"), email(value, key))
            .when(value.startswith("+"), phone(value, key))
            .when(value.rlike(r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$"), ip(value, key))
            .when(value.rlike(rf"^(?:{DATE})$"), date(value, key))
            .when(value.rlike("^[0-9 -]+$") & F.length(figures(value)).between(13, 19), card(value, key))
            .when(value.rlike("^[0-9A-Fa-f]{32,}$"), secret(value, key))
            .otherwise(value))


def pseudonymize(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` with pseudonyms in ``text``."""
    own = F.col(text)
    found = F.regexp_extract_all(own, F.lit(ANY), F.lit(0))
    new = F.transform(found, lambda v: pseudonym(v, key))
    joined = F.array_join(F.flatten(F.zip_with(
        F.split(own, ANY, -1), new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    out = docs.withColumn(text, F.when(own.rlike("[0-9@]"), F.when(own.rlike(ANY), joined).otherwise(own)).otherwise(own))
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
