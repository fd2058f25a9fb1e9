"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its format, validated (check digits, number ranges, calendar), turned into a number below the count of
valid values of its format, permuted there by a keyed Feistel network and written back in the same format: a valid card
number becomes a valid card number, a date a date, with separators and letter case as they were. The permutation
is one to one and depends on the key and the kind alone, so equal values stay equal in all documents, different ones stay
different, and `back` undoes it with the key (a date without leading zeros may come back with them). Texts without a valid value are returned unchanged.

Kinds: payment cards (Luhn), IBANs (modulo 97), IPv4 addresses, North American and international phone numbers with a plus
sign, US social security numbers, calendar dates 1900 to 2099, mail addresses (letters and digits of the local part).
A North American number is valid by its numbering rule only: area code and exchange begin with 2 to 9. Others stay in
clear, like every value that is not valid: in the table sf0.1 33 of the 159 strings of the form +1 (ddd) ddd-dddd.

Each row stands alone: no shuffle, no state. Defined cases: null and empty texts have no values (null stays null); repeated
rows get the same result; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("card", "iban", "ip", "phone", "ssn", "date", "mail")
ROUNDS = 8
FIRST, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days

_DIGITS = re.compile(r"\d[\d ().\-/]*")
_VALUE = re.compile(
    r"(?<![\w+])(?:"
    r"(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})"
    r"|(?P<date>\d{4}-\d{2}-\d{2}|\d{1,2}([./])\d{1,2}\3\d{4})"
    r"|(?P<ip>\d{1,3}(?:\.\d{1,3}){3})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<phone>\+1[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}|\+[2-9]\d{0,2}(?:[ .\-]?\(?\d{1,4}\)?){2,5}|\(?[2-9]\d{2}\)?[ .\-][2-9]\d{2}[.\-]\d{4})"
    r"|(?P<card>\d(?:[ \-]?\d){12,18})"
    r")(?!\w|[.\-]\d)",
    re.ASCII,
)
_MAIL = re.compile(r"(?P<local>[A-Za-z0-9._%+\-]+)@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}", re.ASCII)


class Feistel:
    """Keyed permutations of 0 .. size - 1 for any size: a balanced network over enough bits, walked until in range."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()

    def _round(self, kind: str, size: int, turn: int, half: int, mask: int) -> int:
        text = f"{kind}|{size}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "little") & mask

    def permute(self, kind: str, value: int, size: int, back: bool = False) -> int:
        width = max(1, -(-(size - 1).bit_length() // 2))
        mask = (1 << width) - 1
        while True:
            left, right = value >> width, value & mask
            for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    left, right = right ^ self._round(kind, size, turn, left, mask), left
                else:
                    left, right = right, left ^ self._round(kind, size, turn, right, mask)
            value = left << width | right
            if value < size:
                return value


def luhn(digits: str) -> int:
    """Check digit that belongs behind `digits`."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def refill(shape: str, characters: str) -> str:
    """Put letters and digits into the places that the shape has for them."""
    fresh = iter(characters)
    return "".join(next(fresh) if c.isalnum() else c for c in shape)


def bases(text: str) -> list[int]:
    return [10 if c.isdigit() else 26 for c in text]


def to_number(text: str) -> tuple[int, int]:
    """Value and count of the strings with letters and digits at the same places (letter case apart)."""
    value, size = 0, 1
    for c, b in zip(text, bases(text)):
        value, size = value * b + (int(c) if b == 10 else ord(c.lower()) - 97), size * b
    return value, size


def to_text(value: int, like: str) -> str:
    out = []
    for c, b in zip(reversed(like), reversed(bases(like))):
        value, d = divmod(value, b)
        out.append(str(d) if b == 10 else chr((97 if c.islower() else 65) + d))
    return "".join(reversed(out))


class Pseudonymiser:
    """Replaces valid values in a text; `back` undoes it with the same key."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back

    def _number(self, kind: str, value: int, size: int) -> int:
        return self.feistel.permute(kind, value, size, self.back)

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        body = to_text(self._number(f"card{len(digits)}", *to_number(digits[:-1])), digits[:-1])
        return refill(found, body + str(luhn(body)))

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "")
        if not 15 <= len(plain) <= 34 or mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = to_text(self._number(f"iban{plain[:2]}", *to_number(plain[4:])), plain[4:])
        return refill(found, f"{plain[:2]}{98 - mod97(body + plain[:2] + '00'):02d}{body}")

    def ip(self, found: str) -> str | None:
        parts = [int(x) for x in found.split(".")]
        if max(parts) > 255 or any(x != str(n) for x, n in zip(found.split("."), parts)):
            return None
        value = self._number("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def ssn(self, found: str) -> str | None:
        area, group, serial = (int(x) for x in found.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        rank = area - 1 - (area > 666)
        value = self._number("ssn", (rank * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
        value, serial = divmod(value, 9999)
        rank, group = divmod(value, 99)
        return f"{rank + 1 + (rank >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        national = digits[1:] if found[0] == "+" and digits[0] == "1" else digits if found[0] != "+" else ""
        if len(national) == 10:
            if national[0] in "01" or national[3] in "01":
                return None
            value = (int(national[:3]) - 200) * 800 + int(national[3:6]) - 200
            value = self._number("phone", value * 10_000 + int(national[6:]), 800 * 800 * 10_000)
            value, line = divmod(value, 10_000)
            return refill(found, digits[: len(digits) - 10] + f"{value // 800 + 200}{value % 800 + 200}{line:04d}")
        if found[0] != "+" or digits[0] in "01" or not 8 <= len(digits) <= 15:
            return None
        tail = digits[2:]
        return refill(found, digits[:2] + to_text(self._number(f"phone{digits[:2]}", *to_number(tail)), tail))

    def date(self, found: str) -> str | None:
        mark = found[4] if found[4] == "-" else re.search(r"[./]", found)[0]
        parts = [int(x) for x in found.split(mark)]
        order = (0, 1, 2) if mark == "-" else (2, 1, 0) if parts[1] <= 12 else (2, 0, 1)
        try:
            day = date(*(parts[i] for i in order))
        except ValueError:
            return None
        value = (day - FIRST).days
        if not 0 <= value < DAYS:
            return None
        # Day and month of a date that reads either way keep their order: day first, as it was read.
        new = FIRST + timedelta(days=self._dated(value, order))
        fields = dict(zip(order, (new.year, new.month, new.day)))
        return mark.join(str(fields[i]).zfill(len(x)) for i, x in enumerate(found.split(mark)))

    def _dated(self, value: int, order: tuple[int, ...]) -> int:
        """Month-first dates are those with a day above 12, so they are walked on until the new one has such a day, too."""
        while True:
            value = self._number("date", value, DAYS)
            if order != (2, 0, 1) or (FIRST + timedelta(days=value)).day > 12:
                return value

    def mail(self, found: str) -> str | None:
        local, _, domain = found.rpartition("@")
        core = "".join(c for c in local if c.isalnum())
        if not core:
            return None
        value, size = to_number(core)
        return refill(local, to_text(self._number("mail", value, size), core)) + "@" + domain

    def _longest(self, kind: str, found: str) -> tuple[str | None, int]:
        """Replacement and length of the longest valid value that `found` begins with; groups behind it may be other numbers."""
        while True:
            new = getattr(self, kind)(found)
            if new is not None or kind not in ("card", "iban") or " " not in found:
                return new, len(found)
            found = found[: found.rindex(" ")]
            again = _VALUE.fullmatch(found)
            if again is None or again.lastgroup != kind:
                return None, 0

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with its valid values replaced, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)
        spans: list[tuple[int, int, str]] = []
        done = 0
        for run in _DIGITS.finditer(text):
            if run.end() <= done:
                continue
            at = max(done, run.start() - 4)
            while (found := _VALUE.search(text, at, min(len(text), run.end() + 40))) and found.start() < run.end():
                kind = found.lastgroup or next(k for k, v in found.groupdict().items() if v)
                new, end = self._longest(kind, found[0])
                if new is None:
                    at = found.start() + 1
                    continue
                spans.append((found.start(), found.start() + end, new))
                counts[kind] += 1
                at = done = found.start() + end
        if "@" in text:
            for found in _MAIL.finditer(text):
                new = self.mail(found[0])
                if new is not None and not any(a < found.end() and found.start() < b for a, b, _ in spans):
                    spans.append((found.start(), found.end(), new))
                    counts["mail"] += 1
        if not spans:
            return text, counts
        out, last = [], 0
        for a, b, new in sorted(spans):
            out += [text[last:a], new]
            last = b
        return "".join([*out, text[last:]]), counts


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False, prefix: str = "n_") -> DataFrame:
    """`docs` with the text column replaced and a count per kind (`n_card`, ...) after its own columns."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        work = Pseudonymiser(key, back)
        for batch in batches:
            done = [work.replace(x.as_py()) if x.is_valid else (None, dict.fromkeys(KINDS, 0)) for x in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            columns += [pa.array([c[k] for _, c in done], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)]
    fields += [f"c{len(names) + i} bigint" for i in range(len(KINDS))]
    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, ", ".join(fields)).toDF(*names, *[prefix + k for k in KINDS])
