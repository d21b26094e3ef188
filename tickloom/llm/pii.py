"""Personal data and secrets become pseudonyms of the same format.

Candidates are found by shape and kept if they are valid (Luhn and IBAN check digits, calendar dates,
address and numbering ranges). A value is then read as a number below the count of all valid values of
its format and permuted by a keyed Feistel network over exactly that range, so the pseudonym is valid
too, equal values get equal pseudonyms in every document however they are spaced, and the key alone
could undo it. Separators, letter case and positions in the text stay.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import kept

ROUNDS = 8
#: Bits from which a range's halves need more than one digest.
_WIDE = 256
#: Places of a value that are permuted together; longer values go piece by piece, each under those before.
PIECE = 512
_DAY0, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_DIGITS = "0123456789"
_HEX = "0123456789abcdef"


#: Letters and digits of an IBAN by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
        22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``range(size)``: a Feistel network over the next rectangle, walked until inside."""
    if size < 2:
        return value
    right_size = math.isqrt(size - 1) + 1
    left_size = -(-size // right_size)

    def once(x: int) -> int:
        left, right = divmod(x, right_size)
        for r in range(ROUNDS):
            side, modulus = (right, left_size) if r % 2 == 0 else (left, right_size)
            about = f"{tweak}|{size:x}|{r}|{side:x}" if size >> _WIDE else f"{tweak}|{size}|{r}|{side}"
            seal = hashlib.blake2b(about.encode(), key=key, digest_size=24).digest()
            if size >> _WIDE:  # as many bits as the half has, and 64 more
                more = range(modulus.bit_length() // 512 + 2)
                seal = b"".join(hashlib.blake2b(seal + bytes([i]), key=key, digest_size=64).digest() for i in more)
            moved = int.from_bytes(seal, "big") % modulus
            if r % 2 == 0:
                left = (left + moved) % left_size
            else:
                right = (right + moved) % right_size
        return left * right_size + right

    out = once(value)
    while out >= size:
        out = once(out)
    return out


def _mixed(letters: list[int], sizes: list[int], key: bytes, tweak: str) -> list[int]:
    """Permutes a number written in places of the given sizes."""
    value, size = 0, 1
    for digit, n in zip(letters, sizes, strict=True):
        value, size = value * n + digit, size * n
    value = permute(value, size, key, tweak)
    out = []
    for n in reversed(sizes):
        value, digit = divmod(value, n)
        out.append(digit)
    return out[::-1]


def _same_classes(text: str, key: bytes, tweak: str, alphabets: tuple[str, ...] = (_DIGITS, _LOWER, _UPPER)) -> str:
    """Each letter stays in its class; other characters stay."""
    places = [(i, a) for i, c in enumerate(text) for a in alphabets if c in a]
    out = list(text)
    before = hashlib.blake2b(key=key, digest_size=16)
    for cut in range(0, len(places), PIECE):
        piece = places[cut : cut + PIECE]
        under = f"{tweak}|{cut}|{before.hexdigest()}" if cut else tweak
        new = _mixed([a.index(text[i]) for i, a in piece], [len(a) for _, a in piece], key, under)
        for (i, a), digit in zip(piece, new, strict=True):
            out[i] = a[digit]
        before.update("".join(out[i] for i, _ in piece).encode())
    return "".join(out)


def _refill(shape: str, digits: str) -> str:
    """``digits`` at the places where ``shape`` has some."""
    it = iter(digits)
    return "".join(next(it) if c in _DIGITS else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_rest(country: str, check: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + check)) % 97


def _card(found: str, key: bytes) -> str | None:
    number = _digits(found)
    if not 13 <= len(number) <= 19 or luhn_digit(number[:-1]) != number[-1] or len(set(number)) == 1:
        return None
    # the first digit names the network and stays
    body = "".join(map(str, _mixed([int(c) for c in number[1:-1]], [10] * (len(number) - 2), key, f"card{number[0]}")))
    return _refill(found, number[0] + body + luhn_digit(number[0] + body))


def _iban(found: str, key: bytes) -> str | None:
    """The shape takes capital words behind the number too: shorter ends follow, the country's length goes first."""
    ends = [i for i in range(len(found), 0, -1) if i == len(found) or found[i] == " "]
    ends.sort(key=lambda i: len(found[:i].replace(" ", "")) != IBAN_LENGTHS.get(found[:2]))
    return next((new for i in ends if (new := _whole_iban(found[:i], key))), None)


def _whole_iban(found: str, key: bytes) -> str | None:
    compact = found.replace(" ", "")
    country, check, body = compact[:2], compact[2:4], compact[4:]
    if not 11 <= len(body) <= 30 or _iban_rest(country, check, body) != 1:
        return None
    body = _same_classes(body, key, f"iban{country}")
    it = iter(country + f"{98 - _iban_rest(country, '00', body):02d}" + body)
    return "".join(c if c == " " else next(it) for c in found)


def _phone(found: str, key: bytes) -> str | None:
    number = _digits(found)
    if not 8 <= len(number) <= 15:
        return None
    if number[0] == "1" and len(number) == 11:
        # the North American plan: whether area and exchange begin with 2 to 9, as given ones do, stays
        lows = [(2 if c >= "2" else 0) if i in (0, 3) else 0 for i, c in enumerate(number[1:])]
        sizes = [(8 if low else 2) if i in (0, 3) else 10 for i, low in enumerate(lows)]
        new = _mixed([int(c) - low for c, low in zip(number[1:], lows, strict=True)], sizes, key, f"phone1{lows[0]}{lows[3]}")
        return _refill(found, "1" + "".join(str(d + low) for d, low in zip(new, lows, strict=True)))
    lead = len(re.match(r"\+\d{1,2}", found)[0]) - 1
    new = _mixed([int(c) for c in number[lead:]], [10] * (len(number) - lead), key, f"phone{number[:lead]}")
    return _refill(found, number[:lead] + "".join(map(str, new)))


def _ipv4(found: str, key: bytes) -> str | None:
    parts = found.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts) or parts[0] == "0":
        return None
    # numbers keep their length
    lows = [(1 if i == 0 else 0, 10, 100)[len(p) - 1] for i, p in enumerate(parts)]
    tops = [(10, 100, 256)[len(p) - 1] for p in parts]
    sizes = [t - low for t, low in zip(tops, lows, strict=True)]
    shape = "".join(str(len(p)) for p in parts)
    new = _mixed([int(p) - low for p, low in zip(parts, lows, strict=True)], sizes, key, f"ipv4{shape}")
    return ".".join(str(d + low) for d, low in zip(new, lows, strict=True))


def _ssn(found: str, key: bytes) -> str | None:
    area, group, serial = (int(p) for p in re.split(r"\D", found))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    new = _mixed([areas.index(area), group - 1, serial - 1], [898, 99, 9999], key, "ssn")
    return _refill(found, f"{areas[new[0]]:03d}{new[1] + 1:02d}{new[2] + 1:04d}")


def _date(found: str, key: bytes) -> str | None:
    parts = re.split(r"\D", found)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 0, 1) if "/" in found else (2, 1, 0)
    swapped = False
    day = _day(parts, order)
    if day is None and order[0]:  # only the other order of day and month makes a date
        order, swapped = (2, order[2], order[1]), True
        day = _day(parts, order)
    if day is None or not 0 <= day < _DAYS:
        return None
    while True:
        day = permute(day, _DAYS, key, "date")
        new = datetime.date.fromordinal(_DAY0 + day)
        if not swapped or new.day > 12:  # such dates stay among themselves, so that the pseudonym reads in one order
            break
    values = dict(zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"), strict=True))
    marks = re.findall(r"\D", found)
    return f"{values[0]}{marks[0]}{values[1]}{marks[1]}{values[2]}"


def _day(parts: list[str], order: tuple[int, int, int]) -> int | None:
    try:
        return datetime.date(*(int(parts[i]) for i in order)).toordinal() - _DAY0
    except ValueError:
        return None


def _email(found: str, key: bytes) -> str | None:
    local, host = found.rsplit("@", 1)
    name, _, top = host.rpartition(".")
    return f"{_same_classes(local, key, 'email')}@{_same_classes(name.lower(), key, 'host')}.{top}"


def _plain_secret(found: str, key: bytes) -> str | None:
    return _same_classes(found, key, "secret")


def _hex_secret(found: str, key: bytes) -> str | None:
    return _same_classes(found, key, "hex", (_HEX,)) if found == found.lower() else _same_classes(found, key, "hex", (_HEX.upper(),))


def _assigned(found: str, key: bytes) -> str | None:
    return _hex_secret(found, key) if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", found) else _plain_secret(found, key)


#: kind, shape (its group ``v``, if any, is the value), what makes its pseudonym or None if it is not valid.
KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", r"(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9_%+-])){0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])", _email),
    ("access_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<v_access_key>[A-Z0-9]{16})(?![A-Za-z0-9])", _plain_secret),
    ("secret", r"""(?i:(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))["']?[ \t]{0,3}[=:][ \t]{0,3}["']?(?P<v_secret>[A-Za-z0-9+/_.~-]{6,})""", _assigned),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)", _phone),
    ("phone_local", r"(?<![\w.+-])\(?[2-9]\d{2}\)?[ .-][2-9]\d{2}[.-]\d{4}(?![\d-])", lambda found, key: _phone_local(found, key)),
    ("date", r"(?<![\d.,/-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-])", _date),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    ("card", r"(?<![\w.-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-])", _card),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _ipv4),
]


def _phone_local(found: str, key: bytes) -> str | None:
    """A North American number without its country: the same pseudonym as with it."""
    whole = _phone("+1" + _digits(found), key)
    return whole and _refill(found, whole[2:])


_shapes = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape, _ in KINDS))
_makers = {kind: maker for kind, _, maker in KINDS}
#: Without one of these a text holds no candidate.
_maybe = re.compile(r"[0-9@]|AKIA|ASIA|(?i:passw|pwd|secret|token|key)")


def pseudonyms(text: str | None, key: bytes) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what they replace, in code points of the input."""
    if not text or not _maybe.search(text):
        return text, []
    out, spans, done, at = [], [], 0, 0
    while found := _shapes.search(text, at):
        kind = found.lastgroup if found.lastgroup in _makers else next(k for k in _makers if found[k] is not None)
        group = f"v_{kind}" if f"v_{kind}" in _shapes.groupindex else kind
        start, end = found.span(group)
        new = _makers[kind](found[group], key)
        if new is None:  # not valid: other kinds may begin inside
            at = found.start() + 1
            retry = _valid_here(text, found.start(), kind, key)
            if retry is None:
                continue
            kind, start, end, new = retry
        if kind == "iban":
            end = start + len(new)
        out += [text[done:start], new]
        spans.append((kind, start, end))
        done = at = end
    out.append(text[done:])
    return "".join(out), spans


_single = {kind: re.compile(shape) for kind, shape, _ in KINDS}


def _valid_here(text: str, at: int, not_kind: str, key: bytes) -> tuple[str, int, int, str] | None:
    """A later kind that has a valid value at the same place."""
    kinds = list(_makers)
    for kind in kinds[kinds.index(not_kind) + 1 :]:
        if found := _single[kind].match(text, at):
            group = f"v_{kind}" if f"v_{kind}" in _single[kind].groupindex else 0
            new = _makers[kind](found[group], key)
            if new is not None:
                return kind, *found.span(group), new
    return None


_SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a column ``pii``: kind, start and end of what was replaced.

    Every other column and row stays, nulls and repeated rows among them; null and empty texts stay as
    they are with an empty ``pii`` (a column of that name is replaced). No shuffle.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key has 16 to 64 bytes")
    names = [c for c in docs.columns if c != "pii"]
    at = names.index("text")
    slim = docs.select([F.col(f"`{c}`") for c in names]).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*slim.schema.fields, T.StructField("pii", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("pii", lambda: None)  # an earlier operator's tables make room
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            done = [pseudonyms(t, key) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([d[0] for d in done], pa.string())
            spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in d[1]] for d in done], kind)
            yield pa.RecordBatch.from_arrays([*columns, spans], names=[*names, "pii"])

    return slim.mapInArrow(run, schema)
