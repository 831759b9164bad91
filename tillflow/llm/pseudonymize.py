"""Format-preserving pseudonyms for personal data and secrets.

Numbers, dates, addresses and secrets are found by pattern, validated (check digits,
calendar, ranges), and replaced by a keyed permutation within their format: digits
stay digits, check digits stay valid, separators stay where they are.  The permutation
is a Feistel network over mixed radices; where not every string of the format is valid
it walks on until it meets a valid one.  As it is a permutation under one key, equal
values get equal pseudonyms in all documents, however they are written (a card with or
without blanks, a date in any of its notations, a phone number with +, with 00 or as it is
written inside the United States, with separators or without), and different values
different ones.  Who holds the key can turn them back.  A phone number keeps its country's
calling code, an address of mail its domain.  National numbers of other countries are not
found: nothing in the text says which country is meant.

How it runs: one pass over the texts, no shuffle; text without a digit, @ or keyword is
passed over at once.

Defined cases: a null or empty text holds nothing and stays as it is; strings that fail
validation stay as they are; of formats that begin at one place the first in ``FORMATS``
counts; repeated rows are answered alike; an empty table gives an empty one; a text of any
length is read line by line; extra columns are kept.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import col, unused

ROUNDS = 10
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
HEX = "0123456789abcdef"
FIRST_DAY = dt.date(1900, 1, 1)
DAYS = (dt.date(2100, 1, 1) - FIRST_DAY).days


# -- the permutation -------------------------------------------------------------

def _round(key: bytes, tweak: bytes, number: int, value: int, size: int) -> int:
    data = b"%d|%d|" % (number, value) + tweak
    wide = hashlib.blake2b(data, key=key, digest_size=32).digest()
    # 64 bits more than the size: as good as even
    more = -(-size.bit_length() // 8) + 8
    while len(wide) < more:
        wide += hashlib.blake2b(wide, key=key, digest_size=32).digest()
    return int.from_bytes(wide[:more], "big") % size


def permuted(value: int, a: int, b: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of the numbers below a * b."""
    if a == 1:  # no second half to mix with: one cycle through all numbers, in a keyed order
        cycle = sorted(range(b), key=lambda v: _round(key, tweak, v, 0, 1 << 64))
        return cycle[(cycle.index(value) + (-1 if back else 1)) % b]
    left, right = divmod(value, b)
    rounds = range(ROUNDS)
    sign = -1 if back else 1
    for r in (reversed(rounds) if back else rounds):
        if r % 2:
            left = (left + sign * _round(key, tweak, r, right, a)) % a
        else:
            right = (right + sign * _round(key, tweak, r, left, b)) % b
    return left * b + right


def permuted_string(text: str, alphabets: list[str], key: bytes, tweak: bytes, back: bool = False) -> str:
    """``text``, whose characters are of the alphabets given for each place, permuted
    among such strings."""
    half = len(text) // 2
    a = b = 1
    for k, s in enumerate(alphabets):
        a, b = (a * len(s), b) if k < half else (a, b * len(s))
    value = 0
    for ch, s in zip(text, alphabets):
        value = value * len(s) + s.index(ch)
    value = permuted(value, a, b, key, tweak, back)
    out = []
    for s in reversed(alphabets):
        value, k = divmod(value, len(s))
        out.append(s[k])
    return "".join(reversed(out))


def _walk(start, step: Callable, valid: Callable):
    """Steps until a valid value: a permutation of the valid ones."""
    value = step(start)
    while not valid(value):
        value = step(value)
    return value


def _digits(digits: str, key: bytes, tweak: bytes, back: bool, valid=lambda d: True) -> str:
    step = lambda d: permuted_string(d, [DIGITS] * len(d), key, tweak, back)
    return _walk(digits, step, valid)


def _refilled(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, in order."""
    it = iter(digits)
    return "".join(next(it) if ch in DIGITS else ch for ch in shape)


def _only_digits(text: str) -> str:
    return "".join(ch for ch in text if ch in DIGITS)


# -- the formats: found text -> pseudonym, or None if it doesn't validate ------------

def luhn_digit(digits: str) -> str:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 if k % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _card(found: str, key: bytes, back: bool) -> str | None:
    d = _only_digits(found)
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = d[0] + _digits(d[1:-1], key, b"card" + d[0].encode(), back, lambda x: len(set(x)) > 1)
    return _refilled(found, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(ch, 36)) for ch in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(found: str, key: bytes, back: bool) -> str | None:
    plain = found.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if _iban_check(country, rest) != check:
        return None
    kinds = [DIGITS if ch in DIGITS else UPPER for ch in rest]
    new = permuted_string(rest, kinds, key, b"iban" + country.encode(), back)
    it = iter(country + _iban_check(country, new) + new)
    return "".join(ch if ch == " " else next(it) for ch in found)


def _valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(found: str, key: bytes, back: bool) -> str | None:
    d = _only_digits(found)
    return _refilled(found, _digits(d, key, b"ssn", back, _valid_ssn)) if _valid_ssn(d) else None


#: Calling codes of one and of two digits; all others have three.
_SHORT_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()


def calling_code(digits: str) -> str:
    """The country's code that an international number begins with: no code begins another."""
    return next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3])


def _phone(found: str, key: bytes, back: bool) -> str | None:
    plain = found.replace("(0)", "\0")  # dialled inside the country only: not of the number
    d = _only_digits(plain)
    prefix = "00" if d.startswith("00") and not found.startswith("+") else ""
    d = d[len(prefix):]
    if not 8 <= len(d) <= 15:
        return None
    # Without a code it is a number of country 1: ten digits, or a 1 before them.
    shown = calling_code(d) if found[0] == "+" or prefix or len(d) == 11 else ""
    code, own = shown or "1", d[len(shown):]
    if len(own) < 4:
        return None
    national = lambda x: len(x) != 10 or x[0] not in "01"  # noqa: E731  an area code
    keep = national if national(own) else lambda x: not national(x)
    new = _digits(own, key, b"phone" + code.encode(), back, keep)
    return _refilled(plain, prefix + shown + new).replace("\0", "(0)")


def _octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(int(p) <= 255 and (p == "0" or p[0] != "0") for p in parts)


def _ip(found: str, key: bytes, back: bool) -> str | None:
    if not _octets(found):
        return None
    sizes = [len(p) for p in found.split(".")]
    tweak = b"ip" + bytes(sizes)

    def step(text):
        return _refilled(found, permuted_string(_only_digits(text), [DIGITS] * sum(sizes), key, tweak, back))

    return _walk(found, step, _octets)


#: Notations of a date: pattern, and the places of year, month and day in it.  Day first
#: is read where month first is no date.
_DATES = ((re.compile(r"(\d{4})([-/.])(\d{2})\2(\d{2})"), (1, 3, 4)),
          (re.compile(r"(\d{1,2})(\.)(\d{1,2})\2(\d{4})"), (4, 3, 1)),
          (re.compile(r"(\d{1,2})([/-])(\d{1,2})\2(\d{4})"), (4, 1, 3)),
          (re.compile(r"(\d{1,2})([/-])(\d{1,2})\2(\d{4})"), (4, 3, 1)))


def _date(found: str, key: bytes, back: bool) -> str | None:
    for pattern, (y, m, d) in _DATES:
        got = pattern.fullmatch(found)
        if not got:
            continue
        try:
            old = dt.date(int(got[y]), int(got[m]), int(got[d]))
        except ValueError:
            continue
        day = (old - FIRST_DAY).days
        if not 0 <= day < DAYS:
            return None
        side = 271  # two halves of about equal size: 270 * 271 > DAYS
        # Days that could be months stay among themselves: the notation is read back alike.
        new = FIRST_DAY + dt.timedelta(days=_walk(
            day, lambda v: permuted(v, side, side, key, b"date", back),
            lambda v: v < DAYS and ((FIRST_DAY + dt.timedelta(days=v)).day > 12) == (old.day > 12)))
        parts = {y: f"{new.year:04d}", m: f"{new.month:02d}", d: f"{new.day:02d}"}
        return parts[1] + got[2] + parts[3] + got[2] + parts[4]
    return None


def _email(found: str, key: bytes, back: bool) -> str | None:
    name, _, domain = found.rpartition("@")
    kinds = [DIGITS if ch in DIGITS else LOWER for ch in name.lower() if ch in DIGITS + LOWER]
    own = "".join(ch for ch in name.lower() if ch in DIGITS + LOWER)
    it = iter(permuted_string(own, kinds, key, b"mail" + domain.lower().encode(), back))
    return "".join(ch if ch not in DIGITS + LOWER + UPPER else next(it).upper() if ch in UPPER else next(it)
                   for ch in name) + "@" + domain


def _hexadecimal(text: str) -> bool:
    """Whether of hexadecimal digits with a letter, all letters of one case."""
    return not text.isdigit() and text in (text.lower(), text.upper()) and all(ch in HEX for ch in text.lower())


def _git_token(found: str, key: bytes, back: bool) -> str:
    kinds = [DIGITS if ch in DIGITS else LOWER if ch in LOWER else UPPER for ch in found[4:]]
    return found[:4] + permuted_string(found[4:], kinds, key, b"git", back)


def _secret(found: str, key: bytes, back: bool) -> str | None:
    git = re.fullmatch(f"({_GIT})([^A-Za-z0-9]*)", found)
    if git:  # the same value as without a keyword
        return _git_token(git[1], key, back) + git[2]
    own = "".join(ch for ch in found if ch.isascii() and ch.isalnum())
    if len(own) < 8:
        return None
    if _hexadecimal(own):  # one value in either case
        new = _walk(own.lower(), lambda x: permuted_string(x, [HEX] * len(x), key, b"secret", back), _hexadecimal)
        it = iter(new.upper() if own == own.upper() else new)
    else:
        kinds = [DIGITS if ch in DIGITS else LOWER if ch in LOWER else UPPER for ch in own]
        it = iter(_walk(own, lambda x: permuted_string(x, kinds, key, b"secret", back), lambda x: not _hexadecimal(x)))
    return "".join(next(it) if ch.isascii() and ch.isalnum() else ch for ch in found)


def _access_key(found: str, key: bytes, back: bool) -> str | None:
    kinds = [DIGITS if ch in DIGITS else UPPER for ch in found[4:]]
    return found[:4] + permuted_string(found[4:], kinds, key, b"access", back)


#: Words before a secret, and what stands between: = or : (no comparison, no scope), in
#: free white space, and quotes.
_KEYWORDS = r"(?i:password|passwd|token|secret|api_key)"
_ACCESS = r"(?:AKIA|ASIA)"
#: Tokens of hosted repositories.
_GIT = r"gh[opsu]_[A-Za-z0-9]{36}"
_BEFORE = {"secret": _KEYWORDS + r"[\"']?[ \t]*(?::?=(?![=])>?|:(?![:=]))[ \t]*[\"']?"}

FORMATS: dict[str, tuple[str, Callable]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*[A-Za-z0-9][._%+-]*"
              r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "access_key": (r"(?<![A-Za-z0-9])" + _ACCESS + r"[0-9A-Z]{16}(?![A-Za-z0-9])", _access_key),
    "git_token": (r"(?<![A-Za-z0-9_])" + _GIT + r"(?![A-Za-z0-9_])", _git_token),
    "secret": (r"(?<=[\"'])[^\s\"']{8,}|(?<![\"'])[^\s\"'<>&;,]{8,}", _secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "phone": (r"(?<![\w+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
              r"|\+[2-9]\d{0,2}(?:[ .-]?\(0\))?[ .-]?(?:\(?\d{2,4}\)?|\d)(?:[ .-]?\(?\d{2,4}\)?){1,4}(?!\d)|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
              r"|(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?!\d)|1[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
              r"|00[2-9]\d{0,2}[ .-](?:\(0\)[ .-]?)?(?:\(?\d{2,4}\)?|\d)(?:[ .-]?\(?\d{2,4}\)?){1,4}(?!\d)"
              r"|001[ .-]\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d))", _phone),
    "card": (r"(?<![\w.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w])", _card),
    "ssn": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    "date": (r"(?<![\w./-])(?:\d{4}([-/.])\d{2}\3\d{2}|\d{1,2}([./-])\d{1,2}\4\d{4})(?![\w/-]|\.\d)", _date),
    "ip": (r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)", _ip),
}


def _pattern() -> re.Pattern:
    """All formats as one pattern, a group by name for each; the separators that a
    format repeats are named s1, s2, ... in order."""
    number = 0
    out = []
    for kind, (pattern, _) in FORMATS.items():
        def separator(m):
            nonlocal number
            number += 1
            return f"(?P<s{number}>{m[1]})"
        pattern = re.sub(r"\((\[[^\]?]+\])\)", separator, pattern)
        out.append(f"{_BEFORE.get(kind, '')}(?P<{kind}>" + re.sub(r"\\([1-9])", r"(?P=s\1)", pattern) + ")")
    return re.compile("|".join(out), re.ASCII)


_FOUND = _pattern()
#: Every format holds a digit, an @ or one of its words.
_HINT = re.compile(rf"[0-9@]|{_ACCESS}|gh[opsu]_|{_KEYWORDS}")


def pseudonymized(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, begin, end) of each, in the old text."""
    if not text or not _HINT.search(text):
        return text, []
    out, spans, at = [], [], 0
    hint = _HINT.search(text)
    while hint:  # only lines that hold a hint; no format goes over a line's end
        begin = text.rfind("\n", 0, hint.start()) + 1
        end = text.find("\n", hint.end())
        end = len(text) if end < 0 else end
        for m in _FOUND.finditer(text, begin, end):
            kind = next(k for k in FORMATS if m[k] is not None)
            new = FORMATS[kind][1](m[kind], key, back)
            if new is not None:
                out += [text[at:m.start(kind)], new]
                spans.append((kind, m.start(kind), m.end()))
                at = m.end()
        hint = _HINT.search(text, end)
    return "".join(out) + text[at:], spans


def with_pseudonyms(docs: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the texts replaced, and as last column a struct ``pseudonyms`` (with
    _ added if there is such a column): kinds, begins and ends (in characters of the old
    text) of what was replaced."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    names = docs.columns
    at = names.index(text)
    added = unused(docs, "pseudonyms")

    def replace(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            got = [pseudonymized(x.as_py(), secret) for x in part.column(at)]
            columns = list(part.columns)
            columns[at] = pa.array([t for t, _ in got], part.column(at).type)
            extra = pa.StructArray.from_arrays(
                [pa.array([[s[k] for s in spans] for _, spans in got], pa.list_(kind))
                 for k, kind in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))],
                names=["kinds", "begins", "ends"])
            yield pa.RecordBatch.from_arrays([*columns, extra], names=[*part.schema.names, added])

    extra = T.StructType([T.StructField("kinds", T.ArrayType(T.StringType())),
                          T.StructField("begins", T.ArrayType(T.LongType())),
                          T.StructField("ends", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(replace, T.StructType([*docs.schema.fields, T.StructField(added, extra)]))


def pseudonym_report(docs: DataFrame, key: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_found, kinds, begins, ends and the new text per document."""
    own = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    return with_pseudonyms(own, key).select(
        "doc_id", F.size("pseudonyms.kinds").cast("bigint").alias("n_found"), "pseudonyms.kinds",
        "pseudonyms.begins", "pseudonyms.ends", "text")
