"""Format-preserving pseudonyms for personal numbers and dates.

Card numbers (Luhn), IBANs (mod 97), social security numbers, phone numbers, IPv4 and IPv6 addresses, e-mail
addresses (name and domain, in any script) and dates of the years 1000 to 2999 are found by pattern, validated (at
shorter lengths too, where a match takes in what follows the value), and replaced by a keyed permutation of their
own format (a Feistel network over digits or letters; other marks stay).  The same value
gives the same pseudonym in every document, whatever its separators, and never itself; check digits are made right
again and dates stay dates within 200 years.  ``Feistel.invert`` undoes a permutation with the key.

Rows are handled one by one in parallel; nothing is shuffled or collected.
"""
from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import ipaddress
import re
from functools import lru_cache
from math import gcd

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from airnet.llm.common import arrow, id_text, rows

ROUNDS = 8
ERA = 200                  # years within which a date moves; 1900 to 2099 is one of them
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LETTERS.upper()

SPAN = StructType([StructField("kind", StringType(), False), StructField("start", IntegerType(), False),
                   StructField("end", IntegerType(), False), StructField("pseudonym", StringType(), False)])
PII_SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("n_found", LongType(), False), StructField("spans", ArrayType(SPAN, False), False)])

PATTERNS = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]++@(?:[\w-]+\.)+[^\W\d_]{2,}(?!\w)")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b")),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")),
    ("ipv6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")),
    ("date", re.compile(r"(?<![\d-])(?:[12]\d{3}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.][12]\d{3})(?![\d-])")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d|\(\d|0\d|\d{3}[-. ]\d{3}[-. ]\d{4})[\d ()./-]{0,20}(?<=\d)(?!\w)")),
)


#: What a text must hold for a kind to occur; the others need a digit.
NEEDS = {"email": "@", "ipv6": ":"}
_DIGIT = re.compile("[0-9]")

#: Kinds whose pattern takes in what follows a value; their shorter lengths are tried too.
SHORTER = ("iban", "card", "phone")
_NEXT = re.compile(r"(?<=[ /])(?:\+\d|\(\d|0\d)")


def _ends(kind: str, text: str, cut: int) -> bool:
    """Whether a value may end at ``cut``: not inside a word or number."""
    return cut == len(text) or not (text[cut].isalnum() or kind != "iban" and text[cut] == "-" and text[cut + 1:cut + 2].isdigit())


def _odd(kind: str, s: str) -> bool:
    """Whether a part of a longer match is no card by its groups: chance finds one in ten lists of numbers."""
    return kind == "card" and any(len(g) < 4 for g in re.split("[ -]", s)[:-1])


@lru_cache(maxsize=256)
def script_alphabet(block: int) -> str:
    """Lower-case letters and digits of 64 code points beyond ASCII."""
    return "".join(c for c in map(chr, range(block * 64, block * 64 + 64)) if c.isalnum() and c.lower() == c)


class Feistel:
    """Keyed permutation, without fixed points, of the strings of one length over an alphabet.

    A string goes through the rounds, moves on by a keyed distance among all strings of its length,
    and goes back through the rounds: one cycle, so that no string is its own pseudonym, also
    when a caller walks on to the next valid one.
    """

    def __init__(self, key: bytes, kind: str, alphabet: str = DIGITS):
        self.key, self.kind, self.alphabet = key, kind.encode(), alphabet
        self.value = {c: i for i, c in enumerate(alphabet)}

    def _round(self, i: int, other: int, n: int) -> int:
        data = b"%s|%d|%d|%d" % (self.kind, n, i, other)
        return int.from_bytes(hashlib.blake2b(data, key=self.key[:64], digest_size=32).digest(), "big")

    def _numbers(self, s: str) -> tuple[int, int, int, int]:
        base, cut = len(self.alphabet), (len(s) + 1) // 2
        a = b = 0
        for c in s[:cut]:
            a = a * base + self.value[c]
        for c in s[cut:]:
            b = b * base + self.value[c]
        return a, b, base ** cut, base ** (len(s) - cut)

    def _text(self, a: int, b: int, n: int) -> str:
        out, base, cut = [], len(self.alphabet), (n + 1) // 2
        for value, size in ((b, n - cut), (a, cut)):
            for _ in range(size):
                out.append(self.alphabet[value % base])
                value //= base
        return "".join(reversed(out))

    def _shifted(self, s: str, sign: int) -> str:
        n = len(s)
        a, b, p, q = self._numbers(s)
        for i in range(ROUNDS):
            if i % 2:
                b = (b + self._round(i, a, n)) % q
            else:
                a = (a + self._round(i, b, n)) % p
        size = p * q
        step = 1 + self._round(ROUNDS, 0, n) % (size - 1) if size > 2 else size - 1
        while gcd(step, size) != 1:     # a distance that visits every string
            step = step % (size - 1) + 1
        a, b = divmod((a * q + b + sign * step) % size, q)
        for i in reversed(range(ROUNDS)):
            if i % 2:
                b = (b - self._round(i, a, n)) % q
            else:
                a = (a - self._round(i, b, n)) % p
        return self._text(a, b, n)

    def apply(self, s: str) -> str:
        return self._shifted(s, 1)

    def invert(self, s: str) -> str:
        return self._shifted(s, -1)


def luhn(payload: str) -> str:
    """Check digit of the digits before it."""
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


#: Characters of an IBAN by country; those of other countries have any length, and digits only.
IBAN_LENGTH = {k: int(n) for n, ks in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FK,FI,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
    "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
    "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV "
    "29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for k in ks.split(",")}


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country) + "00"
    return f"{98 - int(number) % 97:02d}"


def _refill(shape: str, new: str, alphabet: str) -> str:
    """``new`` in the places of ``shape`` that hold characters of the alphabet."""
    it = iter(new)
    return "".join(next(it) if c in alphabet else c for c in shape)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key

    def of(self, kind: str, s: str) -> str | None:
        """Pseudonym of a found string, or None if it is not valid."""
        return getattr(self, f"_{kind}")(s)

    def _feistel(self, kind: str, alphabet: str = DIGITS) -> Feistel:
        return Feistel(self.key, kind, alphabet)

    def _card(self, s):
        d = re.sub(r"\D", "", s)
        if luhn(d[:-1]) != d[-1] or len(set(d)) == 1:
            return None
        new = self._feistel("card").apply(d[:-1])
        return _refill(s, new + luhn(new), DIGITS)

    def _iban(self, s):
        d = s.replace(" ", "")
        if d[:2] in IBAN_LENGTH and IBAN_LENGTH[d[:2]] != len(d) or d[:2] not in IBAN_LENGTH and not d[4:].isdigit():
            return None
        if iban_check(d[:2], d[4:]) != d[2:4]:
            return None
        account, new = d[4:], d[4:]
        for kind, alphabet in (("iban" + d[:2], DIGITS), ("iban letters" + d[:2], UPPER)):  # letters stay letters
            part = "".join(c for c in account if c in alphabet)
            if part:
                new = _refill(new, self._feistel(kind, alphabet).apply(part), alphabet)
        return s[:2] + _refill(s[2:], iban_check(d[:2], new) + new, DIGITS + UPPER)

    def _ssn(self, s):
        if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000":
            return None
        f, d = self._feistel("ssn"), s.replace("-", "")
        while True:  # walk the cycle until the result is valid again
            d = f.apply(d)
            if not (d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000"):
                return _refill(s, d, DIGITS)

    def _phone(self, s):
        d = re.sub(r"\D", "", s)
        if not 9 <= len(d) <= 15:
            return None
        keep = 2 if s[0] == "+" else 1
        return _refill(s, d[:keep] + self._feistel("phone").apply(d[keep:]), DIGITS)

    def _ip(self, s):
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255:
            return None
        f, x = self._feistel("ip", "0123456789abcdef"), "".join(f"{p:02x}" for p in parts)
        x = f.apply(x)
        return ".".join(str(int(x[i:i + 2], 16)) for i in range(0, 8, 2))

    def _ipv6(self, s):
        try:
            address = ipaddress.IPv6Address(s)
        except ValueError:
            return None
        if sum(g != "" for g in s.split(":")) < 2 or not _DIGIT.search(s):
            return None                                    # "::" and the like mark names in program text
        new = self._feistel("ipv6", "0123456789abcdef").apply(f"{int(address):032x}")
        return str(ipaddress.IPv6Address(int(new, 16)))

    def _date(self, s):
        x, y, z = parts = re.split("[-/.]", s)
        # month first only where day first is no date
        orders = ((0, 1, 2),) if len(x) == 4 else ((2, 1, 0), (2, 0, 1))
        for order in orders:
            try:
                day = dt.date(*[int(parts[i]) for i in order])
                break
            except ValueError:
                continue
        else:
            return None
        era = (day.year - 100) // ERA * ERA + 100
        first, last = dt.date(max(era, 1000), 1, 1).toordinal(), dt.date(min(era + ERA, 3000), 1, 1).toordinal()
        f, d = self._feistel(f"date{era}"), f"{day.toordinal() - first:05d}"
        while True:  # walk the cycle until the result is a day of the era
            d = f.apply(d)
            if int(d) < last - first:
                break
        new = dt.date.fromordinal(first + int(d))
        two = "" if 1 in map(len, parts) else "02"         # one-digit days and months stay without a zero
        places = [""] * 3
        for i, v in zip(order, (str(new.year), format(new.month, two), format(new.day, two))):
            places[i] = v
        seps = re.findall("[-/.]", s)
        return places[0] + seps[0] + places[1] + seps[1] + places[2]

    def _word(self, kind: str, s: str) -> str:
        """``s`` with its letters and digits permuted: ASCII ones, and those of each block beyond, among themselves."""
        new = s
        blocks = sorted({ord(c) >> 6 for c in s if c > "\x7f" and c.isalnum()})
        for name, alphabet in [(kind, LETTERS + DIGITS)] + [(f"{kind}{b}", script_alphabet(b)) for b in blocks]:
            part = "".join(c for c in s if c in alphabet)
            if part and len(alphabet) > 1:
                new = _refill(new, self._feistel(name, alphabet).apply(part), alphabet)
        return new

    def _email(self, s):
        name, _, domain = s.lower().rpartition("@")
        if not any(c.isalnum() for c in name):
            return None
        *labels, top = domain.split(".")
        return f"{self._word('email', name)}@{'.'.join(self._word('domain', x) for x in labels)}.{top}"

    def _longest(self, kind: str, pattern: re.Pattern, text: str, start: int, end: int, inside: bool) -> tuple[int, str] | None:
        """End and pseudonym of the longest valid value that begins at ``start`` (``inside`` a failed match)."""
        m = pattern.match(text, start, end)
        if m is None:
            return None
        if kind == "phone":  # where another number begins, this one ends
            for cut in range(m.end() - 1, start, -1):
                if (_NEXT.match(text, cut) and (head := pattern.fullmatch(text, start, cut - 1))
                        and (other := pattern.match(text, cut)) and self.of(kind, head[0]) and self.of(kind, other[0])):
                    return cut - 1, self.of(kind, head[0])
        if (kind not in SHORTER or _ends(kind, text, m.end())) and not (inside and _odd(kind, m[0])) and (new := self.of(kind, m[0])) is not None:
            return m.end(), new
        if kind in SHORTER:
            for cut in range(m.end() - 1, start, -1):  # the pattern again, on all that is shorter
                if (text[cut - 1].isalnum() and _ends(kind, text, cut) and (shorter := pattern.fullmatch(text, start, cut))
                        and not _odd(kind, shorter[0]) and (new := self.of(kind, shorter[0])) is not None):
                    return cut, new
        return None

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """Text with pseudonyms, and the spans (in the original text); the first kind that fits wins.

        A match that is no valid value is tried at its shorter lengths, and the search goes on one
        character behind its start.  Spans taken before bound a match.
        """
        found: list[tuple[int, int, str, str]] = []
        digits = _DIGIT.search(text)
        for kind, pattern in PATTERNS:
            if not (NEEDS[kind] in text if kind in NEEDS else digits):
                continue
            at = failed = 0
            while m := pattern.search(text, at):
                start, end = m.span()
                i = bisect.bisect_right(found, (start, len(text) + 1))   # spans never overlap, so the neighbours tell
                if i and found[i - 1][1] > start:
                    at = found[i - 1][1]
                    continue
                bound = found[i][0] if i < len(found) and found[i][0] < end else len(text)
                hit = self._longest(kind, pattern, text, start, bound, start < failed)
                if hit is None:
                    at, failed = start + 1, max(failed, end)
                else:
                    found.insert(i, (start, hit[0], kind, hit[1]))
                    at = hit[0]
        out, at = [], 0
        for a, b, _, new in found:
            out += [text[at:a], new]
            at = b
        return "".join(out) + text[at:], [{"kind": k, "start": a, "end": b, "pseudonym": n} for a, b, k, n in found]


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_found, spans`` of every row of ``docs`` (doc_id, text).

    NULL text stays NULL with no spans; NULL ids and repeated rows are kept.  Only ``doc_id`` and
    ``text`` are read, so other columns may have any name; an empty table gives no rows.  Texts of any
    length are searched whole, in time that grows with their length.  Of kinds that fit at one
    place the first of ``PATTERNS`` wins.
    """
    schema = arrow(PII_SCHEMA)

    def run(batches):
        p = Pseudonyms(key)
        for batch in batches:
            out = []
            for doc_id, text in rows(batch, "doc_id", "text"):
                new, spans = (None, []) if text is None else p.replace(text)
                out.append((doc_id, new, len(spans), spans))
            cols = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return id_text(docs).mapInArrow(run, PII_SCHEMA)
