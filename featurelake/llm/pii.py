"""Format-preserving pseudonyms for numbers, dates and addresses in text.

What looks like personal data is validated (check digits, octets, calendar), read as an integer of its format's domain,
and mapped by a keyed Feistel permutation of that domain; the result is written back with the same separators, letter
cases and length. Equal values therefore get equal pseudonyms in every document and run of the same key, different
values never share one, and check digits are computed again so that pseudonyms are valid themselves.

Kinds: payment cards (13 to 19 digits, Luhn), IBAN (mod 97; in lower case of known countries only), international phone
numbers (after +, or after 00 if the country's code stands apart and no digits go before), IPv4 addresses, social
security numbers, dates (ISO, and day or month first with a four-digit year), and the local part of e-mail addresses.
An IBAN in lower case is linked with the one in capitals, and a number after 00 with the one after +.

A shape may run on into the next number or word. Cards and IBANs end where they are valid: cards at an edge of their
digit groups, a run without separators first, then one kind of separator, then mixed ones, longest first each; IBANs at
their country's length (of unknown countries, at any edge). Phone numbers have no check digits: they end at their
country's length where that is fixed, or else before a blank that follows a run or a sign other than a blank, if 10 digits
came before. Blanks throughout are taken as one number, so that no digits of it stay.

NULL and empty texts stay as they are; NULL ids and all other columns are carried; repeated rows are treated each.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
KINDS = ("email", "iban", "date", "ipv4", "ssn", "phone", "card")

# The shapes of the kinds. Each is validated before it is replaced.
EMAIL = r"(?P<email>(?<![\w.+%-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
IBAN = (
    r"(?P<iban>(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|"
    r"[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9]))"
)
DATE = (
    r"(?P<date>(?<![\d./-])(?:\d{4}(?P<iso>[./-])\d{1,2}(?P=iso)\d{1,2}|"
    r"\d{1,2}(?P<day>[./-])\d{1,2}(?P=day)\d{4})(?![\d/-])(?!\.\d))"
)
IPV4 = r"(?P<ipv4>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d])(?!\.\d))"
SSN = r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
#: Country codes of two digits; +1 and +7 have one, all others three.
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CODE = rf"(?:[17]|{'|'.join(sorted(TWO_DIGIT_CODES))}|(?!{'|'.join(sorted(TWO_DIGIT_CODES))})[2-9]\d\d)"
PHONE = (
    rf"(?P<phone>(?:(?<![\d+])\+\d{{1,3}}[ .-]?|(?<![\w+.,/-])(?<!\d[ ])00{CODE}[ .-])"
    r"(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d))"
)
CARD = r"(?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))"
SHAPES = re.compile("|".join((EMAIL, IBAN, DATE, IPV4, SSN, PHONE, CARD)), re.ASCII)

#: Characters of the IBANs of a country.
IBAN_LENGTHS = {
    c: int(n) for n, names in (part.split(":") for part in (
        "15:NO;16:BE;18:DK FI FK FO GL NL SD;19:MK SI;20:AT BA EE KZ LT LU MN XK;21:CH HR LI LV;22:BG BH CR DE GB GE IE ME RS VA;"
        "23:AE GI IL IQ OM SO TL;24:AD CZ ES MD PK RO SA SE SK TN VG;25:LY PT ST;26:IS TR;27:BI DJ FR GR IT MC MR SM;"
        "28:AL AZ BY CY DO GT HU LB NI PL SV;29:BR EG PS QA UA;30:JO KW MU;31:MT SC;32:LC;33:RU").split(";"))
    for c in names.split()}
#: Digits of the phone numbers of a country, its code among them.
PHONE_LENGTHS = {"1": 11, "7": 11}
#: A phone number of unknown length has at least so many digits before it can end within its shape.
LEAST_PHONE = 10


def edges(text: str) -> list[int]:
    """Where the groups of a match end, longest first."""
    return [len(text), *(m.start() for m in reversed(list(re.finditer(r"(?<=[A-Za-z0-9])[^A-Za-z0-9]", text))))]


def card_ends(text: str) -> list[int]:
    return sorted((e for e in edges(text) if sum(map(str.isdigit, text[:e])) >= 13), key=lambda e: (len(set(re.sub(r"\d", "", text[:e]))), -e))


def iban_ends(text: str) -> list[int]:
    known = IBAN_LENGTHS.get(text[:2].upper())
    if known is None:
        return edges(text) if text[:2].isupper() else []
    return [*(e for e in edges(text)[1:] if len(text[:e].replace(" ", "")) == known), len(text)]


def phone_ends(text: str) -> list[int]:
    """The end of the number, then of the whole match."""
    fixed, found = PHONE_LENGTHS.get(phone_code(text)), []
    for e in reversed(edges(text)[1:]):
        digits = len(phone_digits(text[:e]))
        *_, sign, run = ["", *re.split(r"(\D)", text[:e])]
        if digits == fixed if fixed else text[e] == " " and digits >= LEAST_PHONE and (len(run) > 4 or sign in ".-+"):
            found.append(e)
    return [*found, len(text)]


def phone_digits(text: str) -> str:
    """The digits from the country code on."""
    return re.sub(r"\D", "", text.removeprefix("00"))


def phone_code(text: str) -> str:
    """The country code, by the digits alone: it does not depend on how a number is parted."""
    digits = phone_digits(text)
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


ENDS = {"card": card_ends, "iban": iban_ends, "phone": phone_ends}


class Permutation:
    """A keyed bijection of the integers below any given size."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def __call__(self, value: int, size: int, tweak: str) -> int:
        """Balanced Feistel over the next even number of bits, walked until it falls below ``size`` again."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        low = (1 << half) - 1
        while True:
            left, right = value >> half, value & low
            for r in range(ROUNDS):
                seed = f"{tweak}|{size}|{r}|{right}".encode()
                left, right = right, left ^ (int.from_bytes(hashlib.blake2b(seed, key=self.key, digest_size=32).digest(), "big") & low)
            value = left << half | right
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The digit that completes a number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_rest(country: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country)) * 100


def refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.permute = Permutation(key)
        self.of = lru_cache(maxsize=1 << 16)(self._of)

    def _of(self, kind: str, text: str) -> str | None:
        """The pseudonym of a match, or None if it is not valid."""
        return getattr(self, kind)(text)

    def digits(self, text: str, tweak: str) -> str:
        return str(self.permute(int(text), 10 ** len(text), tweak)).zfill(len(text))

    def characters(self, text: str, tweak: str) -> str:
        """Letters become letters of the same case and digits digits, all positions permuted as one number."""
        sizes = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in text]
        base = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in text]
        value, size = 0, 1
        for c, n, b in zip(text, sizes, base, strict=True):
            value, size = value * n + ord(c) - ord(b), size * n
        value, out = self.permute(value, size, f"{tweak}|{''.join(base)}"), []
        for n, b in zip(reversed(sizes), reversed(base), strict=True):
            value, rest = divmod(value, n)
            out.append(chr(ord(b) + rest))
        return "".join(reversed(out))

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self.digits(digits[:-1], "card")
        return refill(text, body + luhn_digit(body))

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "").upper()
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if (iban_rest(country, account) + int(check)) % 97 != 1:
            return None
        account = self.characters(account, f"iban|{country}")
        left = iter(f"{country}{98 - iban_rest(country, account) % 97:02d}{account}")
        made = "".join(c if c == " " else next(left) for c in text)
        return made.lower() if text[:2].islower() else made

    def phone(self, text: str) -> str | None:
        digits = phone_digits(text)
        if not 8 <= len(digits) <= 15:
            return None
        code = phone_code(text)
        return refill(text, "00" * text.startswith("00") + code + self.digits(digits[len(code):], f"phone|{code}"))

    def ipv4(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        value = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ipv4")
        return ".".join(map(str, value.to_bytes(4, "big")))

    def ssn(self, text: str) -> str | None:
        """Areas 1 to 899 without 666, groups from 1, serials from 1."""
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.permute(value, 898 * 99 * 9999, "ssn"), 9999)
        area, group = divmod(value, 99)
        area += 1
        return f"{area + (area > 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        """Within the days from 1900 to 2099; the order of the fields is kept, and which one led where both could."""
        sign = next(c for c in text if not c.isdigit())
        parts = text.split(sign)
        for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
            try:
                day = datetime.date(*(int(parts[order.index(c)]) for c in "ymd"))
            except ValueError:
                continue
            if not FIRST_DAY <= day <= LAST_DAY:
                return None
            days = (LAST_DAY - FIRST_DAY).days + 1
            new = FIRST_DAY + datetime.timedelta(self.permute((day - FIRST_DAY).days, days, "date"))
            padded = all(len(p) > 1 for p in parts)
            field = {"y": f"{new.year:04d}", "m": f"{new.month:02d}" if padded else str(new.month), "d": f"{new.day:02d}" if padded else str(new.day)}
            return sign.join(field[c] for c in order)
        return None

    def email(self, text: str) -> str | None:
        """The name is permuted in lower case, and gets the capitals of the one it stands for."""
        local, _, domain = text.partition("@")
        made = self.characters(local.lower(), f"email|{domain.lower()}")
        return f"{''.join(n.upper() if c.isupper() else n for c, n in zip(local, made, strict=True))}@{domain}"

    def replaced(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of what was replaced in the given text."""
        out, spans, at, pos = [], [], 0, 0
        while m := SHAPES.search(text, pos):
            kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m.group(k))
            new = None
            for length in ENDS.get(kind, lambda t: [len(t)])(m.group()):
                new = self.of(kind, m.group()[:length])
                if new is not None:
                    break
            if new is None:  # another kind may begin inside
                pos = m.start() + 1
                while pos < m.end() and text[pos - 1].isalnum() and text[pos].isalnum():
                    pos += 1
                continue
            out += [text[at:m.start()], new]
            at = pos = m.start() + length
            spans.append((kind, m.start(), at))
        return "".join([*out, text[at:]]), spans


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """All rows and columns with pseudonyms in ``text``, and a column of what was replaced (kind, start, end in the given text).

    A column already named like ``spans`` is replaced.
    """
    docs = docs.drop(spans)
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        names = Pseudonyms(key)
        for b in batches:
            at = b.schema.get_field_index(text)
            made = [names.replaced(t) if t else (t, []) for t in b.column(at).to_pylist()]
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in found] for _, found in made]
            b = b.set_column(at, b.schema.field(at), pa.array([t for t, _ in made], b.schema.field(at).type))
            yield b.append_column(spans, pa.array(found, kinds))

    schema = docs.withColumn(spans, F.lit(None).cast("array<struct<kind:string,start:int,end:int>>")).schema
    return docs.mapInArrow(run, schema)
