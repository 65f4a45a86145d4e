"""Pseudonyms against a plain scan, character by character, with Feistel networks in Python."""

import datetime
import hashlib
import re
import time

import numpy as np

from tessella.llm import pii

KEY = "test key"
COUNTRIES = {c[:2]: int(c[2:]) for c in pii.IBAN_LENGTHS.split()}
FORMS = {k: [re.compile(f) for f in pii._forms(k)] for k in pii.KINDS}


def digest(key, kind, *parts):
    return hashlib.sha512("|".join([key, kind, *map(str, parts)]).encode()).hexdigest()


def letters(key, kind, value):
    def shifted(half, other, turn):
        out = []
        for at, c in enumerate(half):
            by = int(digest(key, kind, turn, other, at // 32)[at % 32 * 4 :][:4], 16)
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(c) - ord(first) < size:
                    c = chr(ord(first) + (ord(c) - ord(first) + by) % size)
                    break
            out.append(c)
        return "".join(out)

    a, b = value[: len(value) // 2], value[len(value) // 2 :]
    for i in range(pii.ROUNDS):
        a, b = b, shifted(a, b, i)
    return a + b


def rectangle(key, kind, a, b, rows, columns, *tweak):
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            a = (a + int(digest(key, kind, i, b, *tweak)[:12], 16)) % rows
        else:
            b = (b + int(digest(key, kind, i, a, *tweak)[:12], 16)) % columns
    return a, b


def refill(value, fresh, kept="0123456789"):
    fresh = iter(fresh)
    return "".join(next(fresh) if c in kept else c for c in value)


def digits(value):
    return "".join(c for c in value if "0" <= c <= "9")


def luhn(value):
    total = 0
    for i, c in enumerate(reversed(value)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def mod97(value):
    return int("".join(str(int(c, 36)) for c in value)) % 97


def email(key, m):
    name, _, domain = m.partition("@")
    return letters(key, "email", name) + "@" + domain


def iban(key, m):
    plain = m.replace(" ", "")
    if len(plain) != COUNTRIES.get(plain[:2], len(plain)) or mod97(plain[4:] + plain[:4]) != 1:
        return None
    fresh = letters(key, "iban", plain[4:])
    return refill(m, f"{plain[:2]}{98 - mod97(fresh + plain[:2] + '00'):02d}{fresh}", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def ip(key, m):
    a, b, c, d = map(int, m.split("."))
    x, y = rectangle(key, "ip", a * 256 + b, c * 256 + d, 65536, 65536)
    return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"


#: All dates up to the 12th of a month in order, and all others.
DAYS = [datetime.date(1900, 1, 1) + datetime.timedelta(i) for i in range(73_049)]
EARLY, LATE = [d for d in DAYS if d.day <= 12], [d for d in DAYS if d.day > 12]
PLACE = {d: i for part in (EARLY, LATE) for i, d in enumerate(part)}


def date(key, m):
    one, two, three = re.split("[./-]", m)
    if "-" in m:
        order = (one, two, three)
    else:
        order = (three, one, two) if int(two) > 12 else (three, two, one)
    try:
        day = datetime.date(*map(int, order))
    except ValueError:
        return None
    if day.day <= 12:
        a, b = rectangle(key, "early date", *divmod(PLACE[day], 180), 160, 180)
        to = EARLY[a * 180 + b]
    else:
        n = PLACE[day]
        while True:
            a, b = rectangle(key, "late date", *divmod(n, 211), 210, 211)
            n = a * 211 + b
            if n < len(LATE):
                break
        to = LATE[n]
    if "-" in m:
        return to.isoformat()
    x, y = (to.month, to.day) if int(two) > 12 else (to.day, to.month)
    return f"{x:0{len(one)}d}{m[len(one)]}{y:0{len(two)}d}{m[len(one) + 1 + len(two)]}{to.year}"


def ssn(key, m):
    area, group, serial = map(int, m.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    a, b = rectangle(key, "ssn", (area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999)
    area = a // 99 + 1
    return f"{area + (area >= 666):03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def phone(key, m):
    bare = m.replace("(0)", "()")
    full = digits(bare) if m[0] == "+" else "1" + digits(bare)
    size = 1 if full[0] in "17" else 2 if full[:2] in pii.CALLING_CODES.split() else 3
    code, own = full[:size], full[size:]
    if not 8 <= len(digits(m)) <= 15 or len(own) < 4:
        return None
    american = code == "1" and len(own) == 10
    half = 3 if american else len(own) // 2
    low, high = 10 ** (half - 1), 10**half
    if own[0] == "0":
        low, high = 0, low
    elif american and own[0] == "1":
        high = 2 * low
    elif american:
        low = 2 * low
    a, b = rectangle(key, "phone", int(own[:half]) - low, int(own[half:]), high - low, 10 ** (len(own) - half), code, len(own))
    fresh = f"{code if m[0] == '+' else ''}{a + low:0{half}d}{b:0{len(own) - half}d}"
    return refill(bare, fresh).replace("()", "(0)")


def card(key, m):
    d = digits(m)
    if not 13 <= len(d) <= 19 or luhn(d):
        return None
    head = d[0] + letters(key, "card", d[1:-1])
    return refill(m, head + str(-luhn(head + "0") % 10))


PLAIN = {"email": email, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card}


def plain(text, key):
    """The text with pseudonyms, and how many of each kind."""
    out, counts, at, after = [], dict.fromkeys(pii.KINDS, 0), 0, False
    while at < len(text):
        for kind in pii.KINDS:
            found = None
            for form in FORMS[kind]:
                # A name can begin right after a claim.
                m = form.match(text[at:]) if after and kind == "email" else form.match(text, at)
                if m and (found := PLAIN[kind](key, m[0])):
                    break
            if found:
                out.append(found)
                counts[kind] += 1
                at, after = at + len(m[0]), True
                break
        else:
            out.append(text[at])
            at, after = at + 1, False
    return "".join(out), counts


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.pseudonyms(docs, KEY).collect()}
    for i, text in enumerate(texts):
        want, counts = plain(text, KEY)
        assert got[i].text == want, (text[:300], got[i].text[:300], want[:300])
        assert {k: got[i][f"n_{k}"] for k in pii.KINDS} == counts and got[i].n_found == sum(counts.values())
    return [got[i].text for i in range(len(texts))]


def test_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text is not None]
    out = check(spark, texts)
    assert sum(a != b for a, b in zip(texts, out, strict=True)) > 20


def test_made_values(spark):
    """Values of every kind in many forms, side by side and glued to others."""
    rng = np.random.default_rng(11)
    number = lambda n: "".join(rng.choice(list("0123456789"), n))

    def made():
        kind = rng.integers(0, 12)
        if kind == 0:
            d = "4" + number(rng.integers(11, 18))
            d += str(-luhn(d + "0") % 10)
            return d if rng.random() < 0.5 else "-".join(d[i : i + 4] for i in range(0, len(d), 4))
        if kind == 1:
            country = str(rng.choice(list(COUNTRIES)))
            body = number(COUNTRIES[country] - 4)
            x = f"{country}{98 - mod97(body + country + '00'):02d}{body}"
            return x if rng.random() < 0.5 else " ".join(x[i : i + 4] for i in range(0, len(x), 4))
        if kind == 2:
            return str(rng.choice([f"{rng.integers(1, 32)}.{rng.integers(1, 14)}.{rng.integers(1900, 2100)}", f"{rng.integers(1, 13):02d}/{rng.integers(1, 32):02d}/{rng.integers(1900, 2100)}", f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 32):02d}"]))
        if kind == 3:
            return f"{number(3)}-{number(2)}-{number(4)}"
        if kind == 4:
            return "+" + str(rng.choice(["1", "44 ", "49 ", "351-", "7 "])) + str(rng.choice(["(0)", "", "(30) "])) + number(3) + str(rng.choice([" ", "-", ""])) + number(4) + str(rng.choice(["", " 123"]))
        if kind == 5:
            return f"({rng.integers(200, 999)}) {number(3)}-{number(4)}"
        if kind == 6:
            return f"{number(2)}.{number(2)}.{number(1)}.{number(3)}"
        if kind == 7:
            return f"bob.{number(3)}@mail{number(1)}.example.com"
        return str(rng.choice(["THIS", "id", "x", ",", number(3), number(9), "BIC", "é", "@", "漢", "-", "+"]))

    check(spark, ["".join(made() + str(rng.choice([" ", " ", ". ", "", "\n"])) for _ in range(rng.integers(1, 14))) for _ in range(1500)])


def test_values_beside_others(spark):
    texts = ["ES91 2100 0418 4502 0005 1332 THIS IS", "ES9121000418450200051332 CODE", "4111 1111 1111 1111 123", "+49 30 901820 2024-05-06", "x a..b@c..de f@.com", "+44 (0)20 7946 0958 and +44 20 7946 0958"]
    out = check(spark, texts)
    assert all(a != b for a, b in zip(texts, out, strict=True))
    assert "4502" not in out[0] and out[0].endswith(" THIS IS") and out[2].endswith(" 123") and "2024-05-06" not in out[3]
    one, two = out[5].split(" and ")
    assert one.replace("(0)", "") == two and two.startswith("+44 ")


def test_phones_stay_linked(spark):
    out = check(spark, ["+14155552671", "+1 415-555-2671", "(415) 555-2671", "415.555.2671"])
    assert out[0].startswith("+1") and len({digits(x)[-10:] for x in out}) == 1 and digits(out[0])[1] in "23456789"


def test_dates_are_a_bijection_as_texts(spark):
    """Every way to write the dates of one year: different texts of different dates stay different, ways of one date stay linked."""
    year = [datetime.date(2023, 1, 1) + datetime.timedelta(i) for i in range(365)]
    texts = [f"{d:%d/%m/%Y}" for d in year] + [f"{d:%m/%d/%Y}" for d in year if d.day > 12] + [d.isoformat() for d in year]
    out = check(spark, texts)
    assert len(set(out)) == len(set(texts))
    read = lambda t: datetime.date.fromisoformat(t) if "-" in t else datetime.date(int(t[6:]), *((int(t[:2]), int(t[3:5])) if int(t[3:5]) > 12 else (int(t[3:5]), int(t[:2]))))
    to = {}
    for a, b in zip(texts, out, strict=True):
        assert to.setdefault(read(a), read(b)) == read(b)
    assert len(set(to.values())) == len(to)


def test_hard_texts(spark):
    """Texts that make expressions backtrack or recurse: time grows with the length, and nothing overflows."""
    hard = ["x1@" + "a." * 2000 + "com 5", "deadbeef01" * 100_000, "a." * 50_000 + "@x.com", "1-" * 50_000, "+1 " * 30_000, "AB12" * 25_000, "x@" * 50_000, "a@a." * 20_000, "9" * 300_000]
    docs = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    begin = time.time()
    got = {r.doc_id: r.n for r in pii.pseudonyms(docs, KEY).selectExpr("doc_id", "length(text) as n").collect()}
    assert time.time() - begin < 120
    assert got[1] == len(hard[1])
