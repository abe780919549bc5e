"""Personal data replaced by format-preserving pseudonyms from keyed Feistel networks.

Candidates are found by pattern and must validate: card numbers by their check digit, bank
accounts by their remainder, social security numbers by their ranges, dates by the calendar,
addresses by their octets. A validated value is ranked within the set of all values of its
format, permuted there by a keyed Feistel network (with cycle walking where the set is no
product) and written back in the layout it was found in, check digits made right again. The
permutation depends on key and format only, so equal values get equal pseudonyms in every
document, different values of a format different ones, and the key holder can invert it.
Card and account numbers are also found where what stands before or after them (a security
code, an expiry date, a currency) could belong to the pattern: shorter ends at group borders
and later starts are tried.

Defined results: a null text counts as empty in the counts and stays null; what does not
validate stays as it is; rows are handled one by one, so repeated rows repeat their result; an
empty table gives no rows; other columns are ignored by ``pseudonymise`` and kept by
``protect``. Texts are scanned whole.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import load, query
from fleetlens.llm.textvec import slices

KEY = b"replace this key in production"
ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "date", "ip", "phone")

PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "date": re.compile(r"(?<![\w./-])(?:\d{4}([-/.])\d{2}\1\d{2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d)"),
    "ip": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    "phone": re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])"),
}
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
#: Length of an account number by country; others are tried at every border, longest first.
IBAN_LENGTHS = {k: int(n) for n, ks in (line.split(":") for line in (
    "15:NO", "16:BE", "18:DK FI FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV", "22:BG BH CR DE GB GE IE ME RS VA",
    "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM",
    "28:AL AZ BY CY DO GT HU LB NI PL SV", "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU")) for k in ks.split()}
CARD_LAYOUT = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5}")


def card_ends(found: str, start: int, later: bool) -> list[int]:
    """Where a card number may end in a match: before a separator or at its end, known layouts first, longest first.

    From a ``later`` start, inside a match that failed, known layouts only: any row of numbers has some run with a right check digit.
    """
    borders = [i for i in range(13, len(found) + 1) if i == len(found) or not found[i].isdigit() and found[i - 1].isdigit()]
    sized = [(not CARD_LAYOUT.fullmatch(found, 0, i), -i) for i in borders if 13 <= sum(c.isdigit() for c in found[:i]) <= 19]
    return [start - i for odd, i in sorted(sized) if not (odd and later)]


def iban_ends(found: str, start: int, later: bool) -> list[int]:
    """Where an account number may end in a match: before a space or at its end, the country's length first, longest first."""
    borders = [i for i in range(15, len(found) + 1) if i == len(found) or found[i] == " "]
    usual = IBAN_LENGTHS.get(found[:2])
    return [start - i for _, i in sorted((i - found.count(" ", 0, i) != usual, -i) for i in borders)]


INNER = {"card": card_ends, "iban": iban_ends}


class Feistel:
    """Keyed permutation of 0..size-1 for any size, one per format name."""

    def __init__(self, key: bytes, format_: str, size: int):
        self.size = size
        self.a = max(1, int(size ** 0.5))
        while self.a * self.a < size:
            self.a += 1
        self.b = -(-size // self.a)
        self.key = hashlib.blake2b(f"{format_}:{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, x: int, modulus: int) -> int:
        h = hashlib.blake2b(i.to_bytes(1, "big") + x.to_bytes((x.bit_length() + 7) // 8 or 1, "big"), key=self.key, digest_size=32)
        return int.from_bytes(h.digest(), "big") % modulus

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + self._round(i, right, self.a)) % self.a
            else:
                right = (right + self._round(i, left, self.b)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(ROUNDS)):
            if i % 2 == 0:
                left = (left - self._round(i, right, self.a)) % self.a
            else:
                right = (right - self._round(i, left, self.b)) % self.b
        return left * self.b + right

    def _walk(self, x: int, step) -> int:
        x = step(x)
        while x >= self.size:  # the network permutes a * b >= size values: walk on until inside
            x = step(x)
        return x

    def __call__(self, x: int) -> int:
        return x if self.size < 2 else self._walk(x, self._once)

    def inverse(self, x: int) -> int:
        return x if self.size < 2 else self._walk(x, self._back)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


_RADIX = {**{c: "0123456789" for c in "0123456789"}, **{c: "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz"},
          **{c: "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}}


class Pseudonyms:
    """Finds, validates and replaces values; ``inverse`` restores them with the same key."""

    def __init__(self, key: bytes = KEY, kinds: tuple[str, ...] = KINDS, inverse: bool = False):
        self.key, self.kinds, self.inverse = key, kinds, inverse
        self.networks: dict[tuple[str, int], Feistel] = {}

    def _permuted(self, format_: str, size: int, x: int) -> int:
        net = self.networks.get((format_, size))
        if net is None:
            net = self.networks[format_, size] = Feistel(self.key, format_, size)
        return net.inverse(x) if self.inverse else net(x)

    def _characters(self, format_: str, text: str) -> str:
        """Letters and digits permuted as one number, each within its own alphabet."""
        signs = [_RADIX[c] for c in text if c in _RADIX]
        size, x = 1, 0
        for alphabet, c in zip(signs, (c for c in text if c in _RADIX)):
            size *= len(alphabet)
            x = x * len(alphabet) + alphabet.index(c)
        shape = "".join("9" if c.isdigit() else "a" if c.islower() else "A" for c in text if c in _RADIX)
        x = self._permuted(f"{format_}:{shape}", size, x)
        out = []
        for alphabet in reversed(signs):
            x, k = divmod(x, len(alphabet))
            out.append(alphabet[k])
        new = iter(reversed(out))
        return "".join(next(new) if c in _RADIX else c for c in text)

    @staticmethod
    def _relaid(found: str, digits: str) -> str:
        new = iter(digits)
        return "".join(next(new) if c.isdigit() else c for c in found)

    def replace(self, kind: str, found: str) -> str | None:
        """The pseudonym of ``found``, or None if it is no valid value of its kind."""
        digits = "".join(c for c in found if c.isdigit())
        if kind == "email":
            local, _, domain = found.rpartition("@")
            return self._characters("email", local) + "@" + domain
        if kind == "card":
            if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
                return None
            payload = self._characters(f"card{len(digits)}", digits[:-1])
            return self._relaid(found, payload + luhn_digit(payload))
        if kind == "iban":
            plain = found.replace(" ", "")
            if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
                return None
            account = self._characters(f"iban{plain[:2]}", plain[4:])
            new = iter(plain[:2] + iban_check(plain[:2], account) + account)
            return "".join(" " if c == " " else next(new) for c in found)
        if kind == "ssn":
            area, group, serial = (int(x) for x in found.split("-"))
            if not (0 < area < 900 and area != 666 and group and serial):
                return None
            areas = area - 1 - (area > 666)
            x = self._permuted("ssn", 898 * 99 * 9999, (areas * 99 + group - 1) * 9999 + serial - 1)
            x, serial = divmod(x, 9999)
            area, group = divmod(x, 99)
            return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
        if kind == "date":
            return self._date(found)
        if kind == "ip":
            octets = found.split(".")
            if any(int(o) > 255 or o != str(int(o)) for o in octets):
                return None
            x = self._permuted("ip", 1 << 32, int.from_bytes(bytes(map(int, octets)), "big"))
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "phone":
            prefix = re.match(r"\+\d{1,3}(?=[ .(-])", found)
            code = prefix.group()[1:] if prefix else ""
            own = digits[len(code):]
            if not (8 if prefix else 9) <= len(own) + len(code) <= 15 or len(set(own)) == 1:
                return None
            return self._relaid(found, code + self._characters(f"phone{code}", own))
        raise ValueError(kind)

    def _date(self, found: str) -> str | None:
        mark = next(c for c in found if not c.isdigit())
        parts = found.split(mark)
        year_first = len(parts[0]) == 4
        numbers = [int(p) for p in parts]
        # day before month with a dot or where the second number can be no month, else month first
        day_first = not year_first and (mark == "." or numbers[1] <= 12 < numbers[0] or (mark == "-" and numbers[1] <= 12))
        try:
            y, m, d = numbers if year_first else (numbers[2], numbers[1], numbers[0]) if day_first else (numbers[2], numbers[0], numbers[1])
            x = dt.date(y, m, d).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= x < DAYS:
            return None
        new = dt.date.fromordinal(FIRST_DAY + self._permuted("date", DAYS, x))
        if year_first:
            return f"{new.year:04d}{mark}{new.month:02d}{mark}{new.day:02d}"
        one, two = (new.day, new.month) if day_first else (new.month, new.day)
        if mark != "." and mark != "-" and day_first:  # keep the order readable: only days over 12 tell it
            one, two = (new.day, new.month) if new.day > 12 else (new.month, new.day)
        return f"{one:02d}{mark}{two:02d}{mark}{new.year:04d}"

    def found(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of every valid value, in order; earlier kinds win overlaps."""
        out: list[tuple[int, int, str, str]] = []
        for kind in self.kinds:
            if kind == "email" and "@" not in text:
                continue
            m, reach = PATTERNS[kind].search(text), 0
            while m:
                s, at = m.start(), m.end()
                ends = [at]
                if kind in INNER:  # the longest match may run into what follows, or start in what comes before
                    ends, at, reach = INNER[kind](m.group(), s, s < reach), s + 1, max(reach, m.end())
                for e in ends:
                    if any(a < e and s < b for a, b, _, _ in out):
                        continue
                    new = self.replace(kind, text[s:e])
                    if new is not None:
                        out.append((s, e, kind, new))
                        at = reach = e
                        break
                m = PATTERNS[kind].search(text, at)
        return sorted(out)

    def applied(self, text: str, found: list[tuple[int, int, str, str]]) -> str:
        out, at = [], 0
        for s, e, _, new in found:
            out += [text[at:s], new]
            at = e
        return "".join(out) + text[at:]


def pseudonymise(docs: DataFrame, key: bytes = KEY, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Per row: doc_id, the new text, the number of values of each kind and their spans in the old text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text", *[f"n_{k}" for k in KINDS], "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_of = Pseudonyms(key, kinds)
        for batch in slices(batches):
            texts, counts, spans = [], [], []
            for text in batch.column("text").to_pylist():
                found = names_of.found(text) if text else []
                texts.append(names_of.applied(text, found) if found else text)
                counts.append([sum(k == kind for _, _, k, _ in found) for kind in KINDS])
                spans.append(",".join(f"{k}:{s}:{e}" for s, e, k, _ in found))
            cols = [batch.column("doc_id"), pa.array(texts, pa.string()), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))],
                    pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, text string, {', '.join(f'n_{k} long' for k in KINDS)}, spans string")


def protect(docs: DataFrame, key: bytes = KEY, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, all columns kept."""
    names_of = Pseudonyms(key, kinds)

    @F.pandas_udf("string")
    def replaced(texts):
        return texts.map(lambda t: names_of.applied(t, names_of.found(t)) if t else t)

    return docs.withColumn("text", replaced("text"))


@query("op9_feistel_pseudonyms")
def op9_feistel_pseudonyms(spark, sf_dir):
    """Personal data of every whole text of ``documents`` replaced by linked pseudonyms."""
    return pseudonymise(load(spark, sf_dir, "documents"))
