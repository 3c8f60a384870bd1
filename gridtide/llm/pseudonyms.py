"""Personal data replaced by keyed pseudonyms of the same format.

Numbers are found by their form and then validated: card numbers by their check digit, account numbers (IBAN) by their remainder, phone, social
security and network addresses by the ranges of their parts, dates by the calendar. What is valid is a whole number in a domain; a Feistel network
under a key permutes the domain, and the result is written in the format of the original, with its own check digits. So a pseudonym is
valid again, different values have different pseudonyms, and equal values have equal ones in all documents, however they are punctuated. Names in
mail addresses, access keys and passwords are permuted in the same way, letter for letter and digit for digit.

Whoever has the key can undo it (``Keyed.permute`` with ``back``); without it, the pseudonyms say nothing but the format.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ship

ROUNDS = 8
#: characters of a mail name or a secret that are permuted as one number
PART = 64
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


class Keyed:
    """Permutations of 0 .. size-1 under a key, one for each kind and size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, size: int, number: int, half: int) -> int:
        data = b"%s|%d|%d|%d" % (kind.encode(), size, number, half)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def permute(self, kind: str, size: int, value: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """A Feistel network on pairs (left, right) that hold all values; steps that leave the domain, or what is valid, are repeated."""
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if n % 2:
                    right = (right + sign * self._round(kind, size, n, left)) % b
                else:
                    left = (left + sign * self._round(kind, size, n, right)) % a
            value = left * b + right
            if value < size and (valid is None or valid(value)):
                return value


# kinds: each gives the pseudonym of a match, or None if it is not valid


def luhn(digits: str) -> int:
    """The sum that is a multiple of ten for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(keyed: Keyed, text: str) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn(digits) % 10 or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = f"{keyed.permute('card', 10**n, int(digits[:-1])):0{n}d}"
    return _refill(text, body + str(-luhn(body + "0") % 10))


def _nanp(number: int) -> bool:
    """A North American number: neither area nor exchange begins with 0 or 1."""
    s = f"{number:010d}"
    return s[0] > "1" and s[3] > "1"


def phone(keyed: Keyed, text: str) -> str | None:
    """With a country code, any number of its length; without, a North American one. Those with code 1 are the same numbers."""
    digits = _digits(text)
    abroad = text.startswith("+")
    if not abroad or digits[0] == "1":
        national = digits[1:] if abroad and len(digits) == 11 else digits
        if len(national) != 10 or not (abroad or _nanp(int(national))):
            return None
        kind = _nanp(int(national))
        new = f"{keyed.permute('phone', 10**10, int(national), lambda v: _nanp(v) == kind):010d}"
        return _refill(text, digits[: len(digits) - 10] + new)
    if not 8 <= len(digits) <= 15 or digits[0] == "0":
        return None
    # the country code, of unknown length, is kept with two digits
    n = len(digits) - 2
    return _refill(text, digits[:2] + f"{keyed.permute('phone' + digits[:2], 10**n, int(digits[2:])):0{n}d}")


def _ssn(number: int) -> bool:
    area, group, serial = number // 10**6, number // 10**4 % 100, number % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(keyed: Keyed, text: str) -> str | None:
    number = int(_digits(text))
    return _refill(text, f"{keyed.permute('ssn', 10**9, number, _ssn):09d}") if _ssn(number) else None


def address(keyed: Keyed, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = keyed.permute("address", 1 << 32, sum(int(p) << 8 * (3 - i) for i, p in enumerate(parts)))
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _letters(keyed: Keyed, kind: str, text: str) -> str:
    """Permuted letter for letter and digit for digit, what is neither is kept. ASCII."""
    places = [(ord("0"), 10) if c.isdigit() else (ord("a"), 26) if c.islower() else (ord("A"), 26) if c.isupper() else (0, 1) for c in text]
    size, value = 1, 0
    for c, (base, n) in zip(text, places, strict=True):
        if n > 1:
            size, value = size * n, value * n + ord(c) - base
    shape = "".join("9" if n == 10 else "a" if n == 26 else c for c, (_, n) in zip(text, places, strict=True))
    value, out = keyed.permute(kind + shape, size, value), []
    for c, (base, n) in zip(reversed(text), reversed(places), strict=True):
        if n > 1:
            value, d = divmod(value, n)
            c = chr(base + d)
        out.append(c)
    return "".join(reversed(out))


def _in_parts(keyed: Keyed, kind: str, text: str) -> str:
    """As ``_letters``; long texts are permuted part by part, in time that grows with their length."""
    return "".join(_letters(keyed, kind, text[at : at + PART]) for at in range(0, len(text), PART))


def iban(keyed: Keyed, text: str) -> str | None:
    flat = text.replace(" ", "")

    def rest(s: str) -> int:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97

    if not 15 <= len(flat) <= 34 or rest(flat) != 1:
        return None
    body = _letters(keyed, "iban" + flat[:2], flat[4:])
    out = iter(flat[:2] + f"{98 - rest(flat[:2] + '00' + body):02d}" + body)
    return "".join(c if c == " " else next(out) for c in text)


_ISO, _DAY_FIRST = re.compile(r"(\d{4})([-/.])(\d\d)\2(\d\d)"), re.compile(r"(\d\d?)([-/.])(\d\d?)\2(\d{4})")


def date(keyed: Keyed, text: str) -> str | None:
    """Year first; else day first, or month first where that is no date. Between 1900 and 2099."""
    iso = _ISO.fullmatch(text)
    m = iso or _DAY_FIRST.fullmatch(text)
    if not m:
        return None
    numbers, mark = [int(m[1]), int(m[3]), int(m[4])], m[2]
    for order in ("ymd",) if iso else ("dmy", "mdy"):
        part = dict(zip(order, numbers, strict=True))
        try:
            day = dt.date(part["y"], part["m"], part["d"]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # a date is written in the order that it is read in, so that reading it again gives the same day
        fits = None if order != "mdy" else lambda v: dt.date.fromordinal(FIRST_DAY + v).day > 12
        new = dt.date.fromordinal(FIRST_DAY + keyed.permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY, fits))
        shown = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        wide = iso or len(m[1]) == 2 and len(m[3]) == 2
        return mark.join(shown[k] if wide else str(int(shown[k])) for k in order)
    return None


def mail(keyed: Keyed, text: str) -> str | None:
    name, _, domain = text.rpartition("@")
    return f"{_in_parts(keyed, 'mail', name)}@{domain}"


def access_key(keyed: Keyed, text: str) -> str | None:
    return text[:4] + _letters(keyed, "key", text[4:])


def secret(keyed: Keyed, text: str) -> str | None:
    head = re.match(r"[A-Za-z_]+\s*[=:]\s*[\"']?", text)[0]
    return head + _in_parts(keyed, "secret", text[len(head) :])


#: in the order in which they are tried where a match may begin
KINDS: tuple[tuple[str, str, Callable[[Keyed, str], str | None]], ...] = (
    ("mail", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", mail),
    ("access_key", r"A[KS]IA[A-Z0-9]{16}(?![A-Z0-9])", access_key),
    ("secret", r"(?i:password|passwd|pwd|token|secret|api_key|apikey)\s?[=:]\s?[\"']?[A-Za-z0-9!#$%&*+./?@^_~-]{5,}[A-Za-z0-9]", secret),
    ("iban", r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("date", r"\d{4}([-/.])\d\d\1\d\d(?!\d)", date),
    ("date", r"\d\d?([-/.])\d\d?\1\d{4}(?!\d)", date),
    ("address", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)", address),
    ("ssn", r"\d{3}-\d\d-\d{4}(?![-\d])", ssn),
    ("card", r"\d(?:[ -]?\d){12,18}(?!\d)", card),
    ("phone", r"(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", phone),
    ("phone", r"\+1(?:[ .()-]{0,2}\d){10}(?!\d)", phone),
    ("phone", r"\+[1-9](?:[ .()-]{0,2}\d){7,14}(?!\d)", phone),
)
#: fixed values: characters of an account number by country
IBAN_LENGTHS = {
    c[:2]: int(c[2:])
    for c in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18"
        " GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15"
        " PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}


def _iban_form(length: int) -> str:
    fours, rest = divmod(length - 4, 4)
    return rf"[A-Z]{{2}}\d\d(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![A-Za-z0-9])"


#: the forms of one length each: what follows a number may look like more of it
_CARD_ENDS = [re.compile(rf"\d(?:[ -]?\d){{{n - 1}}}(?!\d)", re.ASCII) for n in range(19, 12, -1)]
_IBAN_ENDS = {n: re.compile(_iban_form(n), re.ASCII) for n in range(34, 14, -1)}


def _ends(kind: str, m: re.Match) -> Iterator[str]:
    """What may be meant where a form matches: all ends of a group, the longest first; of account numbers the country's length before."""
    if kind not in ("card", "iban"):
        yield m[0]
        return
    forms = _CARD_ENDS if kind == "card" else _IBAN_ENDS.values()
    usual = _IBAN_ENDS.get(IBAN_LENGTHS.get(m[0][:2])) if kind == "iban" else None
    for form in [usual, *forms] if usual else forms:
        found = form.match(m.string, m.start())
        if found:
            yield found[0]


_COMPILED = [(kind, re.compile(form, re.ASCII), make) for kind, form, make in KINDS]
_ANY = re.compile(r"[0-9@]|(?i:password|passwd|pwd|token|secret|api_?key)\s?[=:]")


def pseudonymise(text: str, keyed: Keyed) -> tuple[str, list[tuple[str, int, int]]]:
    """(text with pseudonyms, what was replaced: kind, start and end in code points of the text as it was)."""
    out, spans, done = [], [], 0
    if _ANY.search(text):
        for start in _starts(text):
            if start < done:
                continue
            for kind, form, make in _COMPILED:
                m = form.match(text, start)
                old, new = next(((t, n) for t in _ends(kind, m) if (n := make(keyed, t)) is not None), ("", None)) if m else ("", None)
                if new is not None:
                    out += [text[done:start], new]
                    done = start + len(old)
                    spans.append((kind, start, done))
                    break
    return ("".join([*out, text[done:]]), spans) if spans else (text, spans)


_NUMBER = re.compile(r"(?<![A-Za-z0-9.+@])(?:\+(?=\d)|\((?=\d{3}\))|(?=\d))|(?<![A-Za-z0-9])(?=[A-Z]{2}\d\d|A[KS]IA)", re.ASCII)
_WORD = re.compile(r"(?i:password|passwd|pwd|token|secret|api_key|apikey)\s?[=:]")
#: what stands before an at sign, from its first letter or digit on
_BEFORE_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[._%+-]*+(?=([A-Za-z0-9][A-Za-z0-9._%+-]*+)@)")


def _starts(text: str) -> list[int]:
    """Places where something may begin, in order."""
    found = {m.start() for m in _NUMBER.finditer(text)}
    found |= {m.start() for m in _WORD.finditer(text) if not (m.start() and text[m.start() - 1].isalpha())}
    if "@" in text:
        found |= {m.start(1) for m in _BEFORE_AT.finditer(text)}
    return sorted(found)


def with_pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_values, spans): one row for each row of ``docs``, its whole text with what is personal replaced.

    ``spans`` tells kind, start and end (code points of the text as it was). A null text stays null and has no spans; an empty one
    is empty; bytes that are not UTF-8 are read as U+FFFD. A very long text is read once, from end to end. Digits are ASCII digits. Each row is handled by itself, so repeated rows give equal results; an empty table gives no rows. Other columns are not looked at.
    The key is the caller's to keep: it goes to tasks in the function, and into no result.
    """

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = Keyed(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = [(None, []) if t is None else pseudonymise(t, keyed) for t in batch.column(1).to_pylist()]
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in found] for _, found in rows]
            yield pa.record_batch(
                [batch.column(0), pa.array([t for t, _ in rows], pa.string()), pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, kind)],
                ["doc_id", "text", "n_values", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.make_valid_utf8(F.col(text_col).cast("string")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string, n_values long, spans array<struct<kind:string,start:int,end:int>>")
