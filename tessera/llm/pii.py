"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

A pattern finds candidates and a check decides (Luhn, mod 97, octets, calendar, area codes).  What is found is read
as one number: the mixed-radix value of its free characters, or the day of a date.  A Feistel network over two
nearly equal halves, with cycle walking, permutes the numbers of that format under a key, and the result is written
back in the same format with its check digits made right.  Equal values thus get equal pseudonyms in all documents,
different values get different ones, no value keeps its own, and only the key leads back.  What a format shows stays:
lengths, separators, classes of characters, domains of e-mail addresses, country codes, a card's first digit.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

KEY = b"tessera example key"  # a parameter: production passes a secret
BLOCK = 64  # characters that are permuted together
KINDS = ("email", "secret", "iban", "card", "ssn", "phone", "ip", "date")

DIGITS, UPPER, LOWER, HEX = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"

PATTERNS = {
    "email": r"""(?<![\w.%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+""",
    "secret": r"""\bAKIA[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9_-]{20,}\b|(?<=["'\s=:])[0-9a-f]{32,64}(?=["'\s,;]|$)""",
    "iban": r"""\b[A-Z]{2}[0-9]{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?\b""",
    "ip": r"""(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])""",
    "date": r"""(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})(?![\w/-]|\.[0-9])""",
    "ssn": r"""(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])""",
    "card": r"""(?<![\w.+-])[0-9](?:[\ -]?[0-9]){12,18}(?!\w|-(?![0-9])|\.[0-9])""",
    "phone": r"""(?<![\w.-])(?:\+[0-9]{1,3}[\ .-]?)?(?:\([0-9]{2,4}\)[\ .-]?[0-9]{3,4}[\ .-]?[0-9]{3,4}|[0-9]{3}[\ .-][0-9]{3}[\ .-][0-9]{4}|(?<=[0-9][\ .-])[0-9]{2,4}(?:[\ .-]?[0-9]{2,4}){2,4})(?![\w-]|\.[0-9])""",
    "intl": r"""(?<![\w.])\+[0-9]{1,3}(?:[\ .-]?[0-9]{2,4}){2,5}(?![\w-]|\.[0-9])""",
}
FIND = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()), re.X)
ALONE = {k: re.compile(v, re.X) for k, v in PATTERNS.items()}
ANY = re.compile(r"[0-9@]|\bsk-|\bAKIA|\bgh[pousr]_")
CLEAR_PHONE = re.compile(r"[+(]|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}")
GROUP_END = re.compile(r"(?<=[A-Z0-9])(?=[ .-])")
#: Characters of an IBAN by country.
IBAN_LENGTH = {k: n for n, v in {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for k in v.split()}


def permute(x: int, size: int, key: bytes, back: bool = False, rounds: int = 8) -> int:
    """A keyed permutation of the numbers below size that leaves none alone (size > 1); its inverse, if back.

    A Feistel network gives each number a place in a secret ring, and a keyed number of steps along it is the answer.
    """
    if size < 2:
        return x
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    keyed = functools.partial(hashlib.blake2b, key=key, digest_size=32)

    def network(x: int, order: range, sign: int) -> int:
        while True:  # cycle walking: a * b may be a little more than size
            left, right = divmod(x, b)
            for r in order:
                f = sign * int.from_bytes(keyed(b"%d:%d:%d" % (size, r, left if r % 2 else right)).digest(), "big")
                if r % 2:
                    right = (right + f) % b
                else:
                    left = (left + f) % a
            x = left * b + right
            if x < size:
                return x

    steps = 1 + int.from_bytes(keyed(b"%d" % size).digest(), "big") % (size - 1)
    place = network(x, range(rounds), 1)
    return network((place - steps if back else place + steps) % size, range(rounds)[::-1], -1)


def permuted(chars: list[str], alphabets: list[str], key: bytes, back: bool) -> list[str]:
    """chars, each from its alphabet, permuted as mixed-radix numbers of BLOCK characters."""
    if len(chars) > BLOCK:
        parts = range(0, len(chars), BLOCK)
        return [c for i in parts for c in permuted(chars[i : i + BLOCK], alphabets[i : i + BLOCK], key + b"%d" % i if i else key, back)]
    x, size = 0, 1
    for c, a in zip(chars, alphabets, strict=True):
        x, size = x * len(a) + a.index(c), size * len(a)
    x = permute(x, size, hashlib.blake2b(key, digest_size=32).digest(), back)
    out = []
    for a in reversed(alphabets):
        x, r = divmod(x, len(a))
        out.append(a[r])
    return out[::-1]


def refilled(text: str, places: list[int], chars: list[str]) -> str:
    out = list(text)
    for i, c in zip(places, chars, strict=True):
        out[i] = c
    return "".join(out)


def classes(text: str, places: list[int], key: bytes, back: bool) -> str:
    """The characters at places permuted within their classes: digits, capitals, small letters."""
    alphabet = [DIGITS if text[i] in DIGITS else UPPER if text[i] in UPPER else LOWER for i in places]
    return refilled(text, places, permuted([text[i] for i in places], alphabet, key, back))


DOUBLED = [2 * d - 9 if d > 4 else 2 * d for d in range(10)]


def luhn(digits: str) -> int:
    """Sum that a valid number makes a multiple of ten."""
    plain = doubled = 0  # of what is read so far, its last digit counted once, or twice
    for d in map(int, digits):
        plain, doubled = doubled + d, plain + DOUBLED[d]
    return plain


def card_ends(text: str, start: int, end: int) -> list[int]:
    """Ends of groups, the last first, up to which a card's digits pass its check; one pass for all of them."""
    plain = doubled = n = 0
    first, varied, out = text[start], False, []
    for i in range(start, end):
        c = text[i]
        if c in " -":
            continue
        d = DIGITS.index(c)
        plain, doubled, n, varied = doubled + d, plain + DOUBLED[d], n + 1, varied or c != first
        if n > 12 and varied and plain % 10 == 0 and n < 20 and (i + 1 == end or text[i + 1] in " .-"):
            out.append(i + 1)
    return out[::-1]


def email(s: str, key: bytes, back: bool) -> str | None:
    """The local part; the domain stays readable."""
    at = s.index("@")
    places = [i for i in range(at) if s[i] in DIGITS + UPPER + LOWER]
    return classes(s, places, key, back) if places else None


def secret(s: str, key: bytes, back: bool) -> str | None:
    if s.startswith(("AKIA", "gh", "sk-")):
        head = 4 if s.startswith(("AKIA", "gh")) else 3
        return classes(s, [i for i in range(head, len(s)) if s[i] in DIGITS + UPPER + LOWER], key, back)
    if s.isdigit() or s.isalpha():
        return None
    return "".join(permuted(list(s), [HEX] * len(s), key, back))


LETTERS = {ord(c): str(int(c, 36)) for c in UPPER}


def iban(s: str, key: bytes, back: bool) -> str | None:
    flat = s.replace(" ", "")
    number = lambda t: int(t.translate(LETTERS))
    if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1:
        return None
    body = classes(flat, list(range(4, len(flat))), key, back)[4:]
    check = 98 - number(body + flat[:2] + "00") % 97
    return refilled(s, [i for i, c in enumerate(s) if c != " "], list(f"{flat[:2]}{check:02d}{body}"))


def card(s: str, key: bytes, back: bool) -> str | None:
    places = [i for i, c in enumerate(s) if c in DIGITS]
    digits = [s[i] for i in places]
    if not 13 <= len(digits) <= 19 or luhn("".join(digits)) % 10 or len(set(digits)) == 1:
        return None
    new = digits[:1] + permuted(digits[1:-1], [DIGITS] * (len(digits) - 2), key, back)
    return refilled(s, places, [*new, str(-luhn("".join(new) + "0") % 10)])


def ssn(s: str, key: bytes, back: bool) -> str | None:
    area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    x = permute(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, back)
    area, group, serial = x // (99 * 9999) + 1, x // 9999 % 99 + 1, x % 9999 + 1
    return f"{area + (area >= 666):03d}-{group:02d}-{serial:04d}"


def phone(s: str, key: bytes, back: bool) -> str | None:
    """All digits but a country code's; those that open area and exchange of ten digits stay below 2, or above 1."""
    code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]{2}", s)
    places = [i for i in range(code.end() if code else 1 * s.startswith("+"), len(s)) if s[i] in DIGITS]
    if not 7 <= len(places) <= 14 or (not code and s[0] != "+" and len(places) > 11):
        return None
    opening = lambda c: DIGITS[2:] if c > "1" else DIGITS[:2]
    return refilled(s, places, permuted([s[i] for i in places], [opening(s[i]) if len(places) == 10 and k in (0, 3) else DIGITS for k, i in enumerate(places)], key, back))


def ip(s: str, key: bytes, back: bool) -> str | None:
    """Every octet keeps its number of digits and whether it opens with a zero; the first isn't 0."""
    octets = s.split(".")
    if max(map(int, octets)) > 255 or not int(octets[0]):
        return None
    x, size, spans = 0, 1, []
    for k, o in enumerate(octets):
        low, high = (0, 10 ** (len(o) - 1)) if o[0] == "0" and len(o) > 1 else (10 ** (len(o) - 1) * (len(o) > 1), min(256, 10 ** len(o)))
        low = max(low, k == 0)
        x, size = x * (high - low) + int(o) - low, size * (high - low)
        spans.append((low, high - low, len(o)))
    x = permute(x, size, key, back)
    out = []
    for low, n, width in reversed(spans):
        x, r = divmod(x, n)
        out.append(f"{low + r:0{width}d}")
    return ".".join(reversed(out))


@functools.lru_cache(maxsize=1)
def days() -> dict[tuple[int, bool], list[int]]:
    """The days of 1900 to 2099 by what a style must keep: day below 10, to 12, above; month below 10."""
    out: dict[tuple[int, bool], list[int]] = {}
    for n in range(datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() + 1):
        out.setdefault(style(datetime.date.fromordinal(n)), []).append(n)
    return out


def style(day: datetime.date) -> tuple[int, bool]:
    return (day.day > 9) + (day.day > 12), day.month > 9


def date(s: str, key: bytes, back: bool) -> str | None:
    """A day of 1900 to 2099; month first where the text can't be read day first.

    The new day has as many digits in day and month, and its day is above 12 if the old one is.  So a text keeps
    its length and reads in the same order, and one day written in several styles becomes one day.
    """
    sep = next(c for c in s if not c.isdigit())
    parts = s.split(sep)
    if len(parts) != 3:  # two kinds of separators
        return None
    for order in [("y", "m", "d")] if len(parts[0]) == 4 else [("d", "m", "y"), ("m", "d", "y")]:
        v = dict(zip(order, map(int, parts), strict=True))
        try:
            day = datetime.date(v["y"], v["m"], v["d"])
        except ValueError:
            continue
        alike = days()[style(day)]
        i = bisect.bisect_left(alike, day.toordinal())
        if i == len(alike) or alike[i] != day.toordinal():
            return None
        new = datetime.date.fromordinal(alike[permute(i, len(alike), key + b"%d%d" % style(day), back)])
        return sep.join(f"{ {'y': new.year, 'm': new.month, 'd': new.day}[k]:0{len(p)}d}" for k, p in zip(order, parts, strict=True))
    return None


CHANGE = {"email": email, "secret": secret, "iban": iban, "card": card, "ssn": ssn, "phone": phone, "ip": ip, "date": date, "intl": phone}


def ends(kind: str, text: str, start: int, end: int) -> list[int]:
    """Where a candidate of kind at start may end: an IBAN by its country's length, then at end, then before each group."""
    if kind == "card":
        return card_ends(text, start, end)
    if kind not in ("iban", "phone", "intl"):
        return [end]
    out = [end, *sorted((start + m.start() for m in GROUP_END.finditer(text[start:end])), reverse=True)]
    if kind == "iban" and (n := IBAN_LENGTH.get(text[start : start + 2])):
        places = [i for i in range(start, end) if text[i] != " "]
        out = [places[n - 1] + 1, *out] if len(places) >= n else out
    return out


@functools.lru_cache(maxsize=64)
def key_of(kind: str, key: bytes) -> bytes:
    return hashlib.blake2b(kind.replace("intl", "phone").encode(), key=key, digest_size=24).digest()


def changed(kind: str, old: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a value, or with back the value of a pseudonym; None if the check of its kind fails."""
    return CHANGE[kind](old, key_of(kind, key), back)


def decided(m: re.Match, key: bytes, within: bool) -> tuple[str, int, str] | None:
    """Kind, end and pseudonym of what stands where m begins: the first kind, and its longest part, that passes its check.

    Mere groups of digits are no telephone number within another candidate, nor is a part of them.
    """
    text, start, first = m.string, m.start(), list(PATTERNS).index(m.lastgroup)
    for kind in list(PATTERNS)[first:]:
        bare = kind == "phone" and not CLEAR_PHONE.match(text, start)
        if (bare and (within or kind != m.lastgroup)) or (kind == "intl" and text[start] != "+"):
            continue
        found = m if kind == m.lastgroup else ALONE[kind].match(text, start)
        if not found:
            continue
        for end in [found.end()] if bare else ends(kind, text, start, found.end()):
            if end == found.end() or ALONE[kind].fullmatch(text, start, end):
                new = changed(kind, text[start:end], key)
                if new is not None:
                    return kind, end, new
    return None


def pseudonymise(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """text with pseudonyms, and how many of each kind."""
    found: dict[str, int] = {}
    if not ANY.search(text):
        return text, found
    out, done, at, reach = [], 0, 0, 0
    while m := FIND.search(text, at):
        got = decided(m, key, m.start() < reach)
        reach = max(reach, m.end())
        if got is None:  # something may begin within
            at = m.start() + 1
            continue
        kind, at, new = got
        kind = "phone" if kind == "intl" else kind
        found[kind] = found.get(kind, 0) + 1
        out += [text[done : m.start()], new]
        done = at
    return "".join([*out, text[done:]]), found


def pseudonyms(docs: DataFrame, key: bytes = KEY, counts: bool = True) -> DataFrame:
    """docs with text pseudonymised and, with counts, n_found and found (a map of kinds).

    A null text stays null and has none; texts without personal data stay as they are, byte for byte; every row is
    treated alone, so repeats agree; columns of the added names are replaced; an empty table gives none.
    """
    key = hashlib.blake2b(key, digest_size=32).digest()
    rows = docs.drop("n_found", "found") if counts else docs
    names = rows.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts, n, kinds = [], [], []
            for x in batch.column(at).to_pylist():
                new, found = (None, {}) if x is None else pseudonymise(x, key)
                texts.append(new)
                n.append(sum(found.values()))
                kinds.append(sorted(found.items()))
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            if counts:
                cols += [pa.array(n, pa.int64()), pa.array(kinds, pa.map_(pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "n_found", "found"] if counts else names)
            C.tidy()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, kinds + (", n_found long, found map<string,long>" if counts else ""))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(C.documents(spark, sf_dir).select("doc_id", "text")).withColumn("found", F.to_json("found"))
