"""Operator 5: format-preserving pseudonyms for personal data by a keyed Feistel network.

Card numbers (13 to 19 digits with a valid check digit), bank account numbers in the
international form (valid check digits), North American telephone numbers, social
security numbers in the usual grouping, dates (that exist), IPv4 addresses and e-mail
addresses are found by one pattern, validated, and permuted within their format:

* symbols: the digits (letters, octets) of a value are split into two halves; in each
  of ``ROUNDS`` rounds one half is shifted, symbol by symbol and modulo the symbol's own
  radix, by a SHA-256 stream of (key, kind, round, other half). Each round can be
  undone, so unlike values have unlike pseudonyms, equal ones equal pseudonyms in all
  documents, and separators don't matter: ``4111 1111 ...`` and ``4111-1111-...`` stay
  linked. Check digits are computed anew, so valid numbers stay valid.
* dates: the day's number within 1900-01-01 .. 2099-12-31 goes through a numeric
  Feistel network over a slightly larger square, again and again until it falls within
  the range (cycle walking).
* social security numbers walk likewise until area, group and serial number are valid.

``invert=True`` takes pseudonyms back. All of it is built-in column functions: texts
are cut at the matches, the matches are rewritten, and the parts are joined again.

Edge cases: a null text stays null, an empty one empty; values that fail validation stay
as they are; repeated rows are rewritten alike; a long text costs in proportion; all
other columns pass through. The key is a parameter; whoever has it can invert.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
DAYS, SIDE = 73_049, 271  # 1900-01-01 .. 2099-12-31; SIDE * SIDE >= DAYS
WALK = 48

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: kind -> pattern; the first that matches a value names its kind.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ip": rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}",
    "date": r"(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[1-9]|[12][0-9]|3[01])[./](?:0[1-9]|1[0-2])[./](?:19|20)[0-9]{2}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
#: Not within a longer number or word, nor one part of a dotted number.
ANY = r"(?<![A-Za-z0-9+])(?<![0-9][.-])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + r")(?![A-Za-z0-9])(?![.-][0-9])"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _stream(key: str, kind: str, number: int, half: Column) -> Column:
    """64 hexadecimal digits of a key, a kind, a round and a half."""
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|{number}|"), F.array_join(F.transform(half, lambda x: x.cast("string")), ",")), 256)


def _shift(digits: Column, i: Column) -> Column:
    """A number below 2**24 for place ``i`` from the digest of its block."""
    return F.conv(F.substring(digits, (i % 10) * 6 + 1, F.lit(6)), 16, 10).cast("int")


def feistel(symbols: Column, radix: Column, key: str, kind: str, invert: bool = False) -> Column:
    """Symbols (array of int, each below its ``radix``) permuted; their number and radices decide the domain.

    Halves of up to 10 symbols take one digest a round, longer ones one for every 10.
    """
    n = F.size(symbols)
    middle = (n / 2).cast("int")

    def moved(number: int, left: Column, right: Column, radix_left: Column) -> Column:
        """``left`` shifted by a stream of ``right``."""

        def place(x: Column, i: Column, seed: Column) -> Column:
            by = _shift(F.sha2(F.concat(seed, (i / 10).cast("int").cast("string")), 256), i)
            return F.pmod(x - by if invert else x + by, F.get(radix_left, i))

        return _let(
            _stream(key, kind, number, right), lambda seed: F.transform(left, lambda x, i: place(x, i, seed))
        )

    def turn(number: int) -> Callable[[Column], Column]:
        ahead = number % 2 == 0

        def step(s: Column) -> Column:
            new = moved(number, s["a"], s["b"], s["ra"]) if ahead else moved(number, s["b"], s["a"], s["rb"])
            return F.struct(
                (new if ahead else s["a"]).alias("a"),
                (s["b"] if ahead else new).alias("b"),
                s["ra"].alias("ra"),
                s["rb"].alias("rb"),
            )

        return step

    def body(state: Column) -> Column:
        for number in reversed(range(ROUNDS)) if invert else range(ROUNDS):
            state = _let(state, turn(number))
        return state

    start = F.struct(
        F.slice(symbols, F.lit(1), middle).alias("a"),
        F.slice(symbols, middle + 1, n - middle).alias("b"),
        F.slice(radix, F.lit(1), middle).alias("ra"),
        F.slice(radix, middle + 1, n - middle).alias("rb"),
    )
    return _let(body(start), lambda s: F.concat(s["a"], s["b"]))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits(text: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("int"))


def _put_back(text: Column, symbols: Column, pattern: str) -> Column:
    """``text`` with its characters of ``pattern`` replaced in turn by ``symbols`` (strings)."""
    chars = _chars(text)
    place = F.aggregate(
        chars,
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("i")),
        lambda acc, c: F.when(
            c.rlike(pattern),
            F.struct(F.concat(acc["out"], F.array(F.get(symbols, acc["i"]))).alias("out"), (acc["i"] + 1).alias("i")),
        ).otherwise(F.struct(F.concat(acc["out"], F.array(c)).alias("out"), acc["i"].alias("i"))),
        lambda acc: F.array_join(acc["out"], ""),
    )
    return place


def luhn(digits: Column) -> Column:
    """The sum whose last digit is 0 for a valid card number."""
    n = F.size(digits)

    def value(x: Column, i: Column) -> Column:
        double = 2 * x
        return F.when((n - i) % 2 == 0, F.when(double > 9, double - 9).otherwise(double)).otherwise(x)

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, x: a + x)


def _constant(like: Column, value: int) -> Column:
    return F.transform(like, lambda _: F.lit(value))


def _as_text(symbols: Column) -> Column:
    return F.transform(symbols, lambda x: x.cast("string"))


def _card(value: Column, key: str, invert: bool) -> Column:
    def new(digits: Column) -> Column:
        body = F.slice(digits, F.lit(1), F.size(digits) - 1)
        permuted = feistel(body, _constant(body, 10), key, "card", invert)
        return _let(permuted, lambda p: _let(
            F.pmod(-luhn(F.concat(p, F.array(F.lit(0)))), F.lit(10)),
            lambda check: _put_back(value, _as_text(F.concat(p, F.array(check))), "[0-9]"),
        ))

    return _let(_digits(value), lambda d: F.when(luhn(d) % 10 == 0, new(d)).otherwise(value))


def _walk(start: Column, once: Callable[[Column], Column], inside: Callable[[Column], Column]) -> Column:
    """Cycle walking: ``once``, and again while the outcome is not ``inside``."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), start, lambda x, i: F.when((i == 0) | ~inside(x), once(x)).otherwise(x))


def _plain(value: Column, key: str, kind: str, invert: bool, keep: int = 0, least: dict[int, int] | None = None) -> Column:
    """All digits after the first ``keep``; ``least``: places whose digit is no smaller."""
    least = least or {}

    def new(digits: Column) -> Column:
        body = F.slice(digits, keep + 1, F.size(digits))
        low = F.transform(body, lambda _, i: F.get(F.array(*(F.lit(least.get(p, 0)) for p in range(10))), i))
        shifted = F.zip_with(body, low, lambda x, lo: x - lo)
        permuted = feistel(shifted, F.transform(low, lambda lo: 10 - lo), key, kind, invert)
        whole = F.concat(F.slice(digits, F.lit(1), F.lit(keep)) if keep else F.array().cast("array<int>"), F.zip_with(permuted, low, lambda x, lo: x + lo))
        return _put_back(value, _as_text(whole), "[0-9]")

    return _let(_digits(value), new)


def _phone(value: Column, key: str, invert: bool) -> Column:
    """Area and exchange codes keep beginning with 2 to 9, a country code stays."""
    codes = {0: 2, 3: 2}
    return F.when(value.startswith("+1"), _plain(value, key, "phone", invert, 1, codes)).otherwise(
        _plain(value, key, "phone", invert, 0, codes)
    )


def _ssn(value: Column, key: str, invert: bool) -> Column:
    """Area (neither 000, 666 nor from 900 on), group (not 00) and serial number (not 0000); others are no numbers."""

    def valid(d: Column) -> Column:
        at = lambda i: F.get(d, F.lit(i))
        area = at(0) * 100 + at(1) * 10 + at(2)
        return (area > 0) & (area != 666) & (area < 900) & (at(3) + at(4) > 0) & (at(5) + at(6) + at(7) + at(8) > 0)

    def new(d: Column) -> Column:
        walked = _walk(d, lambda x: feistel(x, _constant(x, 10), key, "ssn", invert), valid)
        return F.when(valid(d), _put_back(value, _as_text(walked), "[0-9]")).otherwise(value)

    return _let(_digits(value), new)


def _ip(value: Column, key: str, invert: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    return F.array_join(_as_text(feistel(octets, _constant(octets, 256), key, "ip", invert)), ".")


_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _alphanumeric(chars: Column, key: str, kind: str, invert: bool) -> Column:
    """Characters permuted within their own class: digits, upper case, lower case."""
    base = F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 0).when(c.rlike("[A-Z]"), 10).otherwise(36))
    radix = F.transform(base, lambda b: F.when(b == 0, 10).otherwise(26))
    symbols = F.zip_with(chars, base, lambda c, b: F.instr(F.lit(_ALPHABET), c) - 1 - b)
    permuted = feistel(symbols, radix, key, kind, invert)
    return F.zip_with(permuted, base, lambda x, b: F.substring(F.lit(_ALPHABET), x + b + 1, F.lit(1)))


def _email(value: Column, key: str, invert: bool) -> Column:
    """The part before the sign; the domain stays."""
    name = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    chars = _chars(F.regexp_replace(name, "[^A-Za-z0-9]", ""))
    return F.concat(_put_back(name, _alphanumeric(chars, key, "email", invert), "[A-Za-z0-9]"), F.lit("@"), domain)


def _iban_rest(country_and_body: Column) -> Column:
    """Remainder by 97 of the number form, letters as 10 to 35."""
    return F.aggregate(
        country_and_body,
        F.lit(0),
        lambda acc, c: _let(
            F.instr(F.lit(_ALPHABET), c) - 1, lambda v: F.when(v < 10, (acc * 10 + v) % 97).otherwise((acc * 100 + v) % 97)
        ),
    )


def _iban(value: Column, key: str, invert: bool) -> Column:
    """Country kept, account permuted, check digits computed anew."""

    def new(chars: Column) -> Column:
        body, country = F.slice(chars, F.lit(5), F.size(chars)), F.slice(chars, F.lit(1), F.lit(2))
        permuted = _alphanumeric(body, key, "iban", invert)

        def checked(p: Column) -> Column:
            rest = _iban_rest(F.concat(p, country, F.array(F.lit("0"), F.lit("0"))))
            check = F.lpad((98 - rest).cast("string"), 2, "0")
            return _put_back(value, F.concat(country, _chars(check), p), "[A-Z0-9]")

        valid = _iban_rest(F.concat(body, F.slice(chars, F.lit(1), F.lit(4)))) == 1
        return F.when(valid, _let(permuted, checked)).otherwise(value)

    return _let(_chars(F.regexp_replace(value, " ", "")), new)


def _day(number: Column, key: str, invert: bool) -> Column:
    """A day's number permuted within 0 .. DAYS - 1 by cycle walking."""

    def shift(half: Column, i: int) -> Column:
        return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{key}|date|{i}|"), half.cast("string")), 256), 1, 12), 16, 10).cast("long") % SIDE

    def turn(i: int) -> Callable[[Column], Column]:
        def forth(s: Column) -> Column:
            return F.struct(s["b"].alias("a"), F.pmod(s["a"] + shift(s["b"], i), F.lit(SIDE)).cast("int").alias("b"))

        def back(s: Column) -> Column:
            return F.struct(F.pmod(s["b"] - shift(s["a"], i), F.lit(SIDE)).cast("int").alias("a"), s["a"].alias("b"))

        return back if invert else forth

    def once(x: Column) -> Column:
        out = F.struct((x / SIDE).cast("int").alias("a"), (x % SIDE).cast("int").alias("b"))
        for i in reversed(range(ROUNDS)) if invert else range(ROUNDS):
            out = _let(out, turn(i))
        return _let(out, lambda s: s["a"] * SIDE + s["b"])

    # SIDE ** 2 - DAYS = 392 numbers lie outside, so a step leaves the range with a chance of 0.5 %
    return _walk(number, once, lambda x: x < DAYS)


def _date(value: Column, key: str, invert: bool) -> Column:
    """Dates that exist, in the order and with the separators they have."""
    iso = value.rlike("^[0-9]{4}")
    mark = F.substring(value, 3, 1)
    text = F.when(iso, value).otherwise(F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
    day = F.datediff(F.try_to_date(text, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))
    new = F.date_add(F.lit("1900-01-01").cast("date"), _day(day, key, invert))
    return _let(
        F.date_format(new, "yyyy-MM-dd"),
        lambda d: F.when(d.isNull(), value)
        .when(iso, d)
        .otherwise(F.concat(F.substring(d, 9, 2), mark, F.substring(d, 6, 2), mark, F.substring(d, 1, 4))),
    )


def pseudonym(value: Column, key: str, invert: bool = False) -> Column:
    """The pseudonym of one matched value, or the value if it is not valid."""
    kinds = {
        "email": _email,
        "iban": _iban,
        "ip": _ip,
        "date": _date,
        "ssn": _ssn,
        "phone": _phone,
        "card": _card,
    }
    out = value
    for kind in reversed(PATTERNS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), kinds[kind](value, key, invert)).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, invert: bool = False) -> DataFrame:
    """``docs`` with ``text`` pseudonymised, and ``n_values``, how many values were replaced.

    ``n_values`` takes the place of a column of that name; a value that fails its checks is
    left alone and not counted (nor is one of the rare that stand for themselves).
    """
    found = "found"
    while found in docs.columns:
        found += "_"
    text = docs["text"]
    value = lambda v: F.struct(v.alias("old"), pseudonym(v, key, invert).alias("new"))
    # a column of its own, so that each pseudonym is made once for both results
    with_values = docs.withColumn(found, F.when(text.rlike(ANY), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), value)))
    parts = F.zip_with(F.split("text", ANY, -1), found, lambda gap, v: F.concat(gap, F.coalesce(v["new"], F.lit(""))))
    changed = F.size(F.filter(found, lambda v: v["new"] != v["old"]))
    return with_values.withColumns(
        {"n_values": F.when(F.col(found).isNull(), 0).otherwise(changed).cast("long"), "text": F.when(F.col(found).isNull(), F.col("text")).otherwise(F.array_join(parts, ""))}
    ).drop(found)
