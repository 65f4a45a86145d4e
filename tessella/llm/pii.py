"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

A value that passes its validation is permuted under a key within its format:
digits stay digits, separators stay where they are, card numbers keep a valid
Luhn digit and IBANs valid check digits, phones their country code, dates stay
dates. Each kind is a Feistel network over the value's halves with a keyed
SHA-512 round function, so it is a bijection: equal values get equal pseudonyms
in every document, and different ones different. Values that fail validation
are left alone.

Numbers are read before they are permuted: a phone with a country code and the
same one in national form, or with other separators, stay linked, and so do
the ways to write a date. Days up to the 12th and days beyond it are permuted
among themselves, so that a pseudonym is read in the order in which the date
was written, and two dates never become one text.

All of it is column expressions over one scan: the text is cut wherever a
candidate can begin; at each place the kinds are tried at every length, the
longest first, until one is valid; the valid ones that do not overlap, taken
from the left, are replaced, and the pieces are joined again. No expression
backtracks over more than a candidate, so the time grows with the text's length.

Defined results: a null text stays null with counts of 0, an empty one stays
empty; a text is read whole, however long (names of e-mail addresses up to 256
characters, four times what mail allows); of candidates that begin at one place
the first kind in the order of KINDS wins, and of its lengths the longest; rows
are independent, so repeated rows and a null doc_id are fine; an empty table
gives an empty result; other columns are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
ROUNDS = 8
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Candidates of each kind; what validation rejects stays as it is.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-])[A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})(?![0-9A-Za-z/-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.])(?<![^0-9]-)[2-6](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
_ANY = "|".join(PATTERNS.values())
#: Where a candidate can begin; a number inside the name of an e-mail address is part of it.
_MAIL_START = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]"
#: How such a piece begins; it may be cut again behind its first sign or behind an @.
_MAIL_PIECE = r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]|$)"
_START = rf"[0-9]|[+(](?:[0-9]|$)|[A-Z]{{2}}[0-9]{{2}}|{_MAIL_PIECE}"
_CUT = rf"(?<![A-Za-z0-9])(?=[+(]?[0-9]|[A-Z]{{2}}[0-9]{{2}})(?![A-Za-z0-9._%+-]{{1,256}}+@[A-Za-z0-9-])|(?<![A-Za-z0-9._%+-])(?={_MAIL_START})"
#: Characters that hold the longest candidate but an e-mail, and pieces that hold the longest e-mail.
_WINDOW, _MAIL_PIECES = 64, 256
#: Years that dates may take; how many of their days come after the 12th of a month, and a rectangle that holds those.
_FIRST_YEAR, _YEARS = 1900, 200
_LATE_DAYS, _ROWS, _COLUMNS = 44_249, 210, 211
#: Lengths of IBANs by country, and country calling codes of two digits (1 and 7 have one, all others three).
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 "
    "HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 "
    "QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)
CALLING_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value's expression written once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]), 512)


def _letters(key: str, kind: str, value: Column) -> Column:
    """A string permuted character by character: digits among digits, letters among letters of their case."""

    def shifted(half: Column, other: Column, turn: Column) -> Column:
        def one(c: Column, at: Column) -> Column:
            # Four hexadecimal digits of the round function for each character.
            by = _number(F.substring(_digest(key, kind, turn, other, F.floor(at / 32)), F.pmod(at, F.lit(32)) * 4 + 1, F.lit(4)))
            base = F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65)
            return F.coalesce(F.char(base + F.pmod(F.ascii(c) - base + by, F.when(base == 48, 10).otherwise(26))), c)

        return F.array_join(F.transform(F.split(half, ""), one), "")

    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))

    # The halves change places after each round, and an even number of rounds brings them back.
    turn = lambda s, i: F.struct(s["r"].alias("l"), shifted(s["l"], s["r"], i).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _rectangle(key: str, kind: str, left: Column, right: Column, rows: int | Column, columns: int | Column, done: Callable[[Column], Column], *tweak: Column) -> Column:
    """A pair of numbers below rows and columns, permuted in a way that depends on tweak; done makes the result of the pair."""
    size = lambda n: n if isinstance(n, Column) else F.lit(n)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        by = lambda other: _number(F.substring(_digest(key, kind, i, other, *tweak), F.lit(1), F.lit(12)))
        return F.struct(F.when(even, F.pmod(s["l"] + by(s["r"]), size(rows))).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(F.pmod(s["r"] + by(s["l"]), size(columns))).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, done)


def _only(value: Column, kept: str = "0-9") -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def _refill(value: Column, fresh: Column, kept: str = "[0-9]") -> Column:
    """value with its characters of a class replaced by those of fresh, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def one(s: Column, c: Column) -> Column:
        hit = c.rlike(f"^{kept}$")
        return F.struct(F.concat(s["out"], F.when(hit, F.substring(fresh, s["at"], F.lit(1))).otherwise(c)).alias("out"), (s["at"] + hit.cast("int")).alias("at"))

    return F.aggregate(F.split(value, ""), start, one, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits that end with the check digit."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).when(i % 2 == 0, F.ascii(c) - 48).otherwise((F.ascii(c) - 48) * 2 - F.when(F.ascii(c) >= 53, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _remainder(text: Column) -> Column:
    """The remainder by 97 of characters read as numbers, letters as 10 to 35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _email(key: str, m: Column) -> tuple[Column, Column]:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.lit(True), F.concat(_letters(key, "email", local), F.lit("@"), domain)


def _iban(key: str, m: Column) -> tuple[Column, Column]:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    check = lambda fresh: F.lpad((98 - _remainder(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0")
    whole = _let(_letters(key, "iban", body), lambda fresh: F.concat(country, check(fresh), fresh))
    wanted = F.element_at(F.create_map(*[F.lit(x) for c in IBAN_LENGTHS.split() for x in (c[:2], int(c[2:]))]), country)
    sound = (F.length(plain) == F.coalesce(wanted, F.length(plain))) & (_remainder(F.concat(body, country, F.substring(plain, 3, 2))) == 1)
    return sound, _let(whole, lambda w: _refill(m, w, "[0-9A-Z]"))


def _ip(key: str, m: Column) -> tuple[Column, Column]:
    part = lambda i: F.element_at(F.split(m, r"\."), i).cast("long")
    join = lambda s: F.concat_ws(".", *[x.cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)])
    return F.lit(True), _rectangle(key, "ip", part(1) * 256 + part(2), part(3) * 256 + part(4), 65536, 65536, join)


def _early(key: str, d: Column) -> Column:
    """A date (year, month, day) up to the 12th, permuted among those."""
    number = ((d[0] - _FIRST_YEAR) * 12 + d[1] - 1) * 12 + d[2] - 1
    done = lambda s: _let(s["l"] * 180 + s["r"], lambda n: F.make_date((F.floor(n / 144) + _FIRST_YEAR).cast("int"), (F.floor(n / 12) % 12 + 1).cast("int"), (n % 12 + 1).cast("int")))
    return _rectangle(key, "early date", F.floor(number / 180), number % 180, _YEARS * 144 // 180, 180, done)


def _late(key: str, d: Column) -> Column:
    """A date (year, month, day) after the 12th, permuted among those."""
    origin = F.lit(f"{_FIRST_YEAR}-01-01").cast("date")
    month = lambda i: F.add_months(origin, i.cast("int"))
    # Such days in front of a month.
    before = lambda i: F.datediff(month(i), origin) - 12 * i
    number = _let((d[0] - _FIRST_YEAR) * 12 + d[1] - 1, lambda i: before(i) + d[2] - 13)
    # The rectangle is a little larger than the days; a place outside of them moves on until it is a day.
    step = lambda x: _rectangle(key, "late date", F.floor(x / _COLUMNS), x % _COLUMNS, _ROWS, _COLUMNS, lambda s: s["l"] * _COLUMNS + s["r"])
    walked = F.aggregate(F.sequence(F.lit(0), F.lit(_ROWS * _COLUMNS - _LATE_DAYS)), -number.cast("long") - 1, lambda a, _: F.when((a >= 0) & (a < _LATE_DAYS), a).otherwise(step(F.when(a < 0, -a - 1).otherwise(a))))

    def day(n: Column) -> Column:
        near = F.floor(n * (12 * _YEARS) / _LATE_DAYS)
        of = F.array_max(F.filter(F.sequence(F.greatest(near - 2, F.lit(0)), F.least(near + 2, F.lit(12 * _YEARS - 1))), lambda i: before(i) <= n))
        return _let(of, lambda i: F.date_add(month(i), (n - before(i) + 12).cast("int")))

    return _let(walked, day)


def _date(key: str, m: Column) -> tuple[Column, Column]:
    iso = m.contains("-")

    def read(p: Column) -> Column:
        """Year, month, day of three numbers as they stand; a day comes before the month where it can."""
        swapped = ~iso & (p[1] > 12)
        return F.array(F.when(iso, p[0]).otherwise(p[2]), F.when(swapped, p[0]).otherwise(p[1]), F.when(iso, p[2]).when(swapped, p[1]).otherwise(p[0]))

    numbers = F.transform(F.split(m, r"[./-]"), lambda x: x.cast("int"))
    exists = lambda d: F.when(d[1].between(1, 12) & (d[2] >= 1), d[2] <= F.dayofmonth(F.last_day(F.make_date(d[0], d[1], F.lit(1))))).otherwise(False)
    sound = _let(numbers, lambda p: _let(read(p), exists))

    def written(to: Column) -> Column:
        like = lambda x, i: F.lpad(x.cast("string"), F.greatest(F.length(x.cast("string")), F.length(F.get(F.split(m, r"[./-]"), i))), F.lit("0"))
        swapped = F.get(F.split(m, r"[./-]"), 1).cast("int") > 12
        dot = lambda i: F.regexp_extract(m, r"^[0-9]+([./-])[0-9]+([./-])", i)
        day, month = F.dayofmonth(to), F.month(to)
        return F.when(iso, F.date_format(to, "yyyy-MM-dd")).otherwise(F.concat(like(F.when(swapped, month).otherwise(day), 0), dot(1), like(F.when(swapped, day).otherwise(month), 1), dot(2), F.year(to).cast("string")))

    return sound, _let(numbers, lambda p: _let(read(p), lambda d: _let(F.when(d[2] <= 12, _early(key, d)).otherwise(_late(key, d)), written)))


def _ssn(key: str, m: Column) -> tuple[Column, Column]:
    part = lambda i: F.element_at(F.split(m, "-"), i).cast("long")
    area, group, serial = part(1), part(2), part(3)
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1

    def done(s: Column) -> Column:
        a = F.floor(s["l"] / 99) + 1
        pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
        return F.concat_ws("-", pad(F.when(a >= 666, a + 1).otherwise(a), 3), pad(s["l"] % 99 + 1, 2), pad(s["r"] + 1, 4))

    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), _rectangle(key, "ssn", left, serial - 1, 898 * 99, 9999, done)


def _phone(key: str, m: Column) -> tuple[Column, Column]:
    """A number without country code is one of the North American plan; a trunk zero in brackets is no part of the number."""
    plus = m.startswith("+")
    bare = F.replace(m, F.lit("(0)"), F.lit("()"))
    full = F.concat(F.when(plus, F.lit("")).otherwise(F.lit("1")), _only(bare))
    size = lambda f: F.when(F.substring(f, 1, 1).isin("1", "7"), 1).when(F.substring(f, 1, 2).isin(CALLING_CODES.split()), 2).otherwise(3)

    def fresh(f: Column) -> Column:
        code = F.substring(f, F.lit(1), size(f))
        own = F.substring(f, size(f) + 1, F.length(f))
        # The first half keeps its length, so it does not begin with 0 unless it did; North American areas begin with 2 to 9.
        half = F.when((code == "1") & (F.length(own) == 10), 3).otherwise(F.floor(F.length(own) / 2)).cast("int")
        power = lambda n: F.pow(F.lit(10), n).cast("long")
        low = F.when(own.startswith("0"), F.lit(0)).otherwise(power(half - 1) * F.when((code == "1") & (F.length(own) == 10) & (F.substring(own, 1, 1) != "1"), 2).otherwise(1))
        high = F.when(own.startswith("0"), power(half - 1)).when((code == "1") & (F.length(own) == 10) & own.startswith("1"), 2 * power(half - 1)).otherwise(power(half))
        left, right = F.substring(own, F.lit(1), half).cast("long"), F.substring(own, half + 1, F.length(own)).cast("long")
        done = lambda s: F.concat(F.when(plus, code).otherwise(F.lit("")), F.lpad((s["l"] + low).cast("string"), half, F.lit("0")), F.lpad(s["r"].cast("string"), F.length(own) - half, F.lit("0")))
        return _rectangle(key, "phone", left - low, right, high - low, power(F.length(own) - half), done, code, F.length(own))

    shown = _let(full, lambda f: _let(fresh(f), lambda w: F.replace(_refill(bare, w), F.lit("()"), F.lit("(0)"))))
    return F.length(_only(m)).between(8, 15) & _let(full, lambda f: F.length(f) - size(f) >= 4), shown


def _card(key: str, m: Column) -> tuple[Column, Column]:
    digits = _only(m)
    head = lambda d: F.concat(F.substring(d, 1, 1), _letters(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
    checked = lambda h: F.concat(h, F.pmod(10 - _luhn(F.concat(h, F.lit("0"))) % 10, F.lit(10)).cast("string"))
    fresh = _let(digits, lambda d: _let(head(d), lambda h: _let(checked(h), lambda w: _refill(m, w))))
    return F.length(digits).between(13, 19) & (_luhn(digits) % 10 == 0), fresh


_RULES = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def _forms(kind: str) -> list[str]:
    """A kind's pattern by length, the longest first, so that a shorter candidate at the same place is tried too."""
    if kind == "iban":
        body = lambda n, r: r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){%d}" % n + (r" ?[A-Z0-9]{%d}" % r if r else "") + r"(?![A-Za-z0-9])"
        return [body(n, r) for n in range(7, 1, -1) for r in (3, 2, 1, 0)]
    if kind == "card":
        return [PATTERNS["card"].replace("{12,18}", "{%d}" % n) for n in range(18, 11, -1)]
    if kind == "phone":
        # An end inside a longer hyphenated or dotted number comes after all others.
        by = [PATTERNS["phone"].replace("{1,4}|", "{%d}|" % n) for n in range(4, 0, -1)]
        return [f"{x}(?![.-][0-9])" for x in by] + by
    return [PATTERNS[kind]]


def _candidate(key: str, w: Column) -> Column:
    """Kind and text of the first valid candidate that begins after the two characters of context, else null."""
    out = F.lit(None).cast("struct<kind:string,text:string>")
    for name in reversed(KINDS):
        out = F.coalesce(F.when(w.rlike(f"(?s)^..(?:{PATTERNS[name]})"), _first(key, name, w)), out)
    return out


def _first(key: str, name: str, w: Column) -> Column:
    shapes = F.array(*[F.regexp_extract(w, f"(?s)^..({x})", 1) for x in _forms(name)])
    fits = F.filter(shapes, lambda m: (m != "") & _RULES[name](key, m)[0])
    return _let(fits, lambda f: F.when(F.size(f) > 0, F.struct(F.lit(name).alias("kind"), F.get(f, F.lit(0)).alias("text"))))


def _fresh(key: str, kind: Column, m: Column) -> Column:
    """A candidate's pseudonym; itself without a kind."""
    out = m
    for name in KINDS:
        out = F.when(kind == name, _RULES[name](key, m)[1]).otherwise(out)
    return out


def _claims(key: str, pieces: Column) -> Column:
    """Valid candidates from left to right that do not overlap: first piece, pieces touched, kind, text, what is left of the last piece."""

    def of(p: Column, i: Column) -> Column:
        follows = lambda n: F.array_join(F.slice(pieces, i + 1, F.lit(n)), "")
        before = F.lpad(F.right(F.when(i > 0, F.array_join(F.slice(pieces, F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), "")).otherwise(F.lit("")), F.lit(2)), 2, "\n")
        window = F.when(p.rlike(f"^(?:{_MAIL_PIECE})"), follows(_MAIL_PIECES)).when(F.length(p) >= _WINDOW, F.substring(p, 1, _WINDOW)).otherwise(F.substring(follows(_WINDOW), 1, _WINDOW))

        def touched(c: Column) -> Column:
            start = F.struct(F.length(c["text"]).alias("left"), F.lit(0).alias("n"))
            step = lambda s, x: F.when(s["left"] > 0, F.struct((s["left"] - F.length(x)).alias("left"), (s["n"] + 1).alias("n"))).otherwise(s)
            ends = F.aggregate(F.slice(pieces, i + 1, F.lit(_MAIL_PIECES)), start, step)
            last = lambda e: F.right(F.get(pieces, i + e["n"] - 1), -e["left"])
            return _let(ends, lambda e: F.struct(i.alias("at"), e["n"].alias("n"), c["kind"].alias("kind"), c["text"].alias("text"), F.when(e["left"] < 0, last(e)).otherwise(F.lit("")).alias("tail")))

        return F.when(p.rlike(f"^(?:{_START})"), _let(_candidate(key, F.concat(before, window)), lambda c: F.when(c.isNotNull(), touched(c))))

    def apart(found: Column) -> Column:
        start = F.struct(F.slice(found, 1, 0).alias("out"), F.lit(0).alias("free"))
        add = lambda s, c: F.when(c["at"] >= s["free"], F.struct(F.concat(s["out"], F.array(c)).alias("out"), (c["at"] + c["n"]).alias("free"))).otherwise(s)
        return F.aggregate(found, start, add, lambda s: s["out"])

    return _let(F.filter(F.transform(pieces, of), lambda c: c.isNotNull()), apart)


def pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_found, and n_<kind> for each kind."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("some", F.coalesce(F.col("text").rlike(_ANY), F.lit(False)))
    rows = rows.withColumn("pieces", F.when(F.col("some"), F.split("text", _CUT)))
    rows = rows.withColumn("claims", F.when(F.col("some"), _claims(key, F.col("pieces"))))

    def gap(j: Column) -> Column:
        """The text before claim j, or after the last one."""
        last = F.get(F.col("claims"), j - 1)
        begin = F.coalesce(last["at"] + last["n"], F.lit(0))
        end = F.coalesce(F.get(F.col("claims"), j)["at"], F.size("pieces"))
        return F.concat(F.coalesce(last["tail"], F.lit("")), F.array_join(F.slice("pieces", begin + 1, end - begin), ""))

    gaps = F.transform(F.sequence(F.lit(0), F.size("claims")), lambda j: gap(j))
    rows = rows.withColumn("gaps", F.when(F.col("some"), gaps))
    # An e-mail name can begin in the middle of a run, right after a claim.
    mails = lambda g: F.regexp_extract_all(g, F.lit(PATTERNS["email"]), 0)
    renamed = lambda g: F.when(g.contains("@"), F.array_join(F.zip_with(F.split(g, PATTERNS["email"]), mails(g), lambda a, m: F.concat(a, F.coalesce(_email(key, m)[1], F.lit("")))), "")).otherwise(g)
    fresh = F.transform("claims", lambda x: _fresh(key, x["kind"], x["text"]))
    joined = F.array_join(F.zip_with(F.transform("gaps", renamed), fresh, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    text = F.when(F.col("some"), joined).otherwise(F.col("text"))
    late = F.aggregate("gaps", F.lit(0), lambda n, g: n + F.when(g.contains("@"), F.size(mails(g))).otherwise(0))
    count = lambda c: F.coalesce(F.when(F.col("some"), c), F.lit(0)).cast("long")
    of = lambda k: F.size(F.filter("claims", lambda x: x["kind"] == k))
    counts = [count(of(k) + (late if k == "email" else 0)).alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", text.alias("text"), count(F.size("claims") + late).alias("n_found"), *counts)
