"""Format-preserving pseudonyms for private values.

Numbers and dates that pass their kind's validation are permuted by a keyed
Feistel network over exactly the values of their format: digits stay digits,
separators stay, check digits are valid again, dates stay dates. Two halves of
sizes ``A`` and ``B`` take turns, each adding a keyed hash of the other, so the
map is a bijection of ``A * B`` values and the same value has the same pseudonym
in every document. Mail names and secrets, which are not numbers, are replaced
by a keyed hash in their own alphabet.

Everything runs as DataFrame expressions: a text is cut where candidates start,
also inside each other. The first one that is valid is replaced, a rejected one
hides nothing that starts inside it, and the pieces are joined again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.tables import free_name

ROUNDS = 10

_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CARD = r"[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}"
#: One pattern for each kind of candidate, in the order in which they are tried.
PATTERNS = {
    # From the start of a name, however long, or from where a value before it may end, 64 characters before the sign
    # at most. Every character is looked at a bounded number of times, and nothing is given back, so no address is
    # too long. Where the name of the host ends is found by its maker.
    "mail": rf"(?:(?<!{_LOCAL}){_LOCAL}++|(?<=[0-9A-Za-z])(?=[._%+-]){_LOCAL}{{1,64}}+)@{_LABEL}++(?:\.{_LABEL}++)++",
    "key": rf"{_EDGE}(?:AKIA|ASIA)[0-9A-Z]{{15,16}}{_END}",
    "hex": rf"{_EDGE}(?=[0-9]{{0,63}}[a-fA-F])[0-9a-fA-F]{{32,64}}{_END}",
    "iban": rf"{_EDGE}[A-Z]{{2}}[0-9]{{2}}(?:[0-9A-Z]{{11,30}}|(?: [0-9A-Z]{{4}}){{2,7}}(?: [0-9A-Z]{{1,3}})?){_END}",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "iso": rf"{_EDGE}[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_END}",
    "slash": rf"{_EDGE}[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}{_END}",
    "dot": rf"{_EDGE}[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}{_END}",
    "ssn": rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9A-Za-z]|-[0-9])",
    "card": rf"{_EDGE}(?:{_CARD}|[0-9]{{4}}(?: [0-9]{{4}}){{3}}){_END}",
}
_LOCAL_PHONE = rf"(?<![0-9A-Za-z+])(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[.-])[0-9]{{3}}[.-][0-9]{{4}}{_END}"
#: Behind a sign, 7 to 15 digits up to here; Java looks behind for nested options, but not for repeated groups.
_MORE = r"[ .()-]{0,2}[0-9]"
_ENOUGH = rf"(?<=\+[0-9]{_MORE * 6}{f'(?:{_MORE}' * 8}{')?' * 8})"
#: A number that is long enough does not go on, behind a space, into a value of another form. Cards in groups of
#: four begin where the groups up to the end of their row are whole cards.
_CARDS = rf"(?:{_CARD}|[0-9]{{4}}(?: [0-9]{{4}}){{3}}(?:(?: [0-9]{{4}}){{4}})*(?! [0-9]{{4}}(?![0-9A-Za-z-]))){_END}"
_NEXT_VALUE = "|".join(f"(?:{p})" for p in (*(PATTERNS | {"card": _CARDS}).values(), _LOCAL_PHONE))
PATTERNS["phone"] = (
    r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}"
    rf"(?:(?!{_ENOUGH} (?:{_NEXT_VALUE}))[ .-]?[0-9]{{2,4}}){{1,4}}{_ENOUGH}){_END}|{_LOCAL_PHONE}"
)
#: No kind starts inside a word; this is tested first.
ANY = rf"(?:{_EDGE}|(?=[._%+-]))(?:{'|'.join(f'(?:{p})' for p in PATTERNS.values())})"
#: Candidates that are worked on in one go.
SLICE = 256

#: Lengths of account numbers by country.
_IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
        31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}

#: Days of one full cycle of the calendar, 1800 to 2199: 146097 = 189 * 773.
_FIRST_DAY, _DAYS_A, _DAYS_B = "1800-01-01", 189, 773
_FORMATS = {"iso": ("yyyy-MM-dd",), "slash": ("dd/MM/yyyy", "MM/dd/yyyy"), "dot": ("dd.MM.yyyy",)}


def _hash(key: str, tweak: Column, value: Column) -> Column:
    """60 keyed bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column) -> Column:
    """Struct ``a, b``: a keyed permutation of the pairs with 0 <= a < size_a and 0 <= b < size_b.

    Sizes are at most 10^15. Each round adds to one half a hash of the other, which undoing subtracts.
    """

    def turn(state: Column, i: Column) -> Column:
        seed = F.concat_ws(".", tweak, i.cast("string"))
        left = F.pmod(state["a"] + _hash(key, seed, state["b"]), size_a)
        right = F.pmod(state["b"] + _hash(key, seed, state["a"]), size_b)
        return F.when(i % 2 == 0, F.struct(left.alias("a"), state["b"].alias("b"))).otherwise(
            F.struct(state["a"].alias("a"), right.alias("b"))
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of the same length (at most 30) by a keyed permutation."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    head, tail = F.substring(digits, F.lit(1), left), F.substring(digits, left + 1, n)
    number = lambda s: F.coalesce(F.nullif(s, F.lit("")), F.lit("0")).cast("long")
    tweak = F.concat_ws("/", F.lit(kind), n.cast("string"))
    out = feistel(number(head), number(tail), _power(left), _power(n - left), key, tweak)
    wide = F.lit("0" * 30)
    pad = lambda v, k: F.right(F.concat(wide, v.cast("string")), k)
    return F.when(n > 0, F.concat(pad(out["a"], left), pad(out["b"], n - left))).otherwise(digits)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by ``digits``."""

    def put(state: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substring(state["rest"], 1, 1)).otherwise(c)).alias("out"),
            F.when(is_digit, F.substring(state["rest"], F.lit(2), F.length(state["rest"])))
            .otherwise(state["rest"])
            .alias("rest"),
        )

    start = F.struct(F.lit("").alias("out"), digits.alias("rest"))
    return F.aggregate(F.split(form, ""), start, put)["out"]


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows a digit string."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    """Remainder of an account number in which letters count as 10 to 35."""

    def add(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    digits = digits_of(m)
    n = F.length(digits)
    payload, last = F.substring(digits, F.lit(1), n - 1), F.right(digits, F.lit(1))
    rest = permute_digits(F.substring(digits, F.lit(2), n - 2), key, "card")
    new = F.concat(F.left(digits, F.lit(1)), rest)
    return F.when(luhn_digit(payload) == last, refill(m, F.concat(new, luhn_digit(new))))


def _iban(m: Column, key: str) -> Column:
    """Pseudonym of a whole account number."""
    packed = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.left(packed, F.lit(2)), F.substring(packed, F.lit(5), F.length(packed))
    valid = (_mod97(F.concat(body, F.left(packed, F.lit(4)))) == 1) & F.length(packed).between(15, 34)
    new = refill(body, permute_digits(digits_of(body), key, "iban"))
    check = F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    spaced = F.when(m.contains(" "), F.trim(F.regexp_replace(F.concat(country, check, new), "(.{4})", "$1 ")))
    return F.when(valid, F.coalesce(spaced, F.concat(country, check, new)))


def _iban_tries(m: Column) -> Column:
    """An account number in groups may run into groups behind it: the length of its country, then all, longest first."""
    groups = F.split(m, " ")
    heads = F.transform(F.sequence(F.size(groups), F.least(F.size(groups), F.lit(3)), F.lit(-1)), lambda n: F.array_join(F.slice(groups, 1, n), " "))
    known = F.create_map(*(F.lit(x) for pair in _IBAN_LENGTHS.items() for x in pair))
    size = F.try_element_at(known, F.left(m, F.lit(2)))
    return F.concat(F.filter(heads, lambda h: F.length(F.replace(h, F.lit(" "), F.lit(""))) == size), heads)


def _ip(m: Column, key: str) -> Column:
    part = lambda i: F.split(m, r"\.")[i].cast("long")
    half, size = F.lit(256), F.lit(65536)
    out = feistel(part(0) * half + part(1), part(2) * half + part(3), size, size, key, F.lit("ip"))
    octets = [F.floor(out[h] / half) if first else out[h] % half for h in "ab" for first in (True, False)]
    return F.concat_ws(".", *(o.cast("string") for o in octets))


def _date(m: Column, key: str, formats: tuple[str, ...]) -> Column:
    found = None
    for form in formats:
        day = F.try_to_timestamp(m, F.lit(form)).cast("date")
        index = F.date_diff(day, F.lit(_FIRST_DAY).cast("date"))
        a, b = F.floor(index / _DAYS_B), index % _DAYS_B
        out = feistel(a, b, F.lit(_DAYS_A), F.lit(_DAYS_B), key, F.lit("date"))
        moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), (out["a"] * _DAYS_B + out["b"]).cast("int"))
        new = F.when(index.between(0, _DAYS_A * _DAYS_B - 1), F.date_format(moved, form))
        found = new if found is None else F.coalesce(found, new)
    return found


def _ssn(m: Column, key: str) -> Column:
    part = lambda i: F.split(m, "-")[i].cast("long")
    area, group, serial = part(0), part(1), part(2)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - F.when(area > 666, 2).otherwise(1)  # 898 areas
    out = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"))
    new_area = out["a"] + F.when(out["a"] >= 665, 2).otherwise(1)
    pieces = ((new_area, 3), (F.floor(out["b"] / 9999) + 1, 2), (out["b"] % 9999 + 1, 4))
    return F.when(valid, F.concat_ws("-", *(F.lpad(v.cast("string"), n, "0") for v, n in pieces)))


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    digits = digits_of(rest)
    valid = F.length(digits_of(m)).between(7, 15)
    return F.when(valid, F.concat(country, refill(rest, permute_digits(digits, key, "phone"))))


def _hashed_digits(value: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)


def _mail_tries(m: Column) -> Column:
    """An address ends with the last label that begins with two letters or more, behind these letters."""
    whole = F.regexp_extract(m, r"^[^@]*+@.*\.[A-Za-z]{2,}", 0)
    return F.filter(F.array(whole), lambda t: t != "")


def _mail(m: Column, key: str) -> Column:
    name = F.concat(F.lit("user-"), F.substring(_hashed_digits(F.lower(m), key, "mail"), 1, 16))
    return F.concat(name, F.regexp_extract(m, "@.*$", 0))


def _hex(m: Column, key: str) -> Column:
    new = F.substring(_hashed_digits(F.lower(m), key, "hex"), F.lit(1), F.length(m))
    return F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


def _secret_key(m: Column, key: str) -> Column:
    new = F.upper(_hashed_digits(m, key, "key"))
    return F.concat(F.left(m, F.lit(4)), F.substring(new, F.lit(1), F.length(m) - 4))


_MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "mail": _mail,
    "key": _secret_key,
    "hex": _hex,
    "iban": _iban,
    "ip": _ip,
    **{kind: (lambda m, key, f=f: _date(m, key, f)) for kind, f in _FORMATS.items()},
    "ssn": _ssn,
    "card": _card,
    "phone": _phone,
}

#: Kinds of which a part of the candidate may be the value: what to try, in order.
_TRIES = {"iban": _iban_tries, "mail": _mail_tries}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pseudonym(m: Column, key: str) -> Column:
    """Struct ``size, new``: pseudonym of the first characters of a candidate, by the first kind whose form it has and
    whose validation it passes; else null. Only addresses and account numbers in groups may be shorter than the candidate."""

    def made(old: Column, new: Column) -> Column:
        return F.when(new.isNotNull(), F.struct(F.length(old).alias("size"), new.alias("new")))

    def one(kind: str, make: Callable[[Column, str], Column]) -> Column:
        if kind not in _TRIES:
            return _let(make(m, key), lambda new: made(m, new))
        tries = F.transform(_TRIES[kind](m), lambda t: _let(make(t, key), lambda new: made(t, new)))
        return F.get(F.filter(tries, lambda t: t.isNotNull()), F.lit(0))

    return F.coalesce(*(F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), one(kind, make)) for kind, make in _MAKERS.items()))


def _replaced(whole: Column, found: Column, key: str) -> Column:
    """Struct ``text, n`` of a text with the candidates ``found``, one for each place where one starts."""
    cut = F.split(whole, f"(?={ANY})", -1)
    start = F.struct(F.lit(0).alias("over"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("out"))

    def put(state: Column, c: Column) -> Column:
        """``over``: how far the last value that was replaced reaches into the pieces behind it."""
        taken = (state["over"] == 0) & c["hit"].isNotNull()
        gone = F.when(taken, c["hit"]["size"]).otherwise(state["over"])
        rest = F.substring(c["piece"], gone + 1, F.length(c["piece"]))
        return F.struct(
            F.greatest(F.lit(0), gone - F.length(c["piece"])).alias("over"),
            (state["n"] + taken.cast("int")).alias("n"),
            F.concat(state["out"], F.array(F.when(taken, F.concat(c["hit"]["new"], rest)).otherwise(rest))).alias("out"),
        )

    def put_slice(state: Column, part: Column) -> Column:
        empty = F.struct(state["over"].alias("over"), state["n"].alias("n"), F.array().cast("array<string>").alias("out"))
        joined = lambda s: F.concat(state["out"], F.array(F.array_join(s["out"], "")))
        return F.aggregate(part, empty, put, lambda s: F.struct(s["over"], s["n"], joined(s).alias("out")))

    def build(pieces: Column) -> Column:
        hits = F.transform(found, lambda m, i: F.struct(pseudonym(m, key).alias("hit"), F.get(pieces, i + 1).alias("piece")))
        slices = lambda c: F.transform(
            F.sequence(F.lit(1), F.size(c), F.lit(SLICE)), lambda i: F.slice(c, i, F.lit(SLICE))
        )
        done = _let(hits, lambda c: F.aggregate(slices(c), start, put_slice))
        return _let(
            done,
            lambda s: F.struct(F.concat(F.get(pieces, F.lit(0)), F.array_join(s["out"], "")).alias("text"), s["n"].alias("n")),
        )

    # A candidate at the very start has no piece before it.
    return _let(cut, lambda p: _let(F.when(F.size(p) == F.size(found), F.concat(F.array(F.lit("")), p)).otherwise(p), build))


def pseudonymise(df: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with private values in ``text`` replaced, and their number in ``count`` if named.

    * Candidates that fail validation (a card's check digit, an account's checksum, a date that does not
      exist) stay as they are, but valid values that start inside them are replaced. Everything else of the
      text is kept, white space included.
    * Null stays null with a count of 0; empty texts and texts without candidates are unchanged.
    * Equal values have equal pseudonyms under one key, in all rows and documents.
    """
    whole = F.col(text)
    found = F.regexp_extract_all(whole, F.lit(f"(?=({ANY}))"), F.lit(1))
    same = F.struct(whole.alias("text"), F.lit(0).alias("n"))
    (made,) = free_name(df, "pseudonymised")
    done = df.withColumn(made, _let(found, lambda f: F.when(F.size(f) > 0, _replaced(whole, f, key)).otherwise(same)))
    out = {text: F.col(made)["text"]}
    if count is not None:
        out[count] = F.col(made)["n"]
    return done.withColumns(out).drop(made)
