"""Format-preserving Feistel pseudonyms for validated personal numbers, dates and addresses.

What is found is validated first (check digits, octets, calendar), so look-alikes stay as they are. Its digits or letters are
then permuted within their format by a keyed Feistel network: a card number becomes another valid card number with the same
separators, a date another date, an address another address. The permutation depends on the key and the kind alone, so
equal values stay equal, and linked, across all documents, and whoever has the key can undo it.

Kinds: payment card (13 to 19 digits, Luhn), phone (+ country code, or a national number with its area code), social security number (its valid areas), IBAN
(mod 97), IPv4, dates from 1900 to 2099 (year-month-day, also before a time, day.month.year, day/month/year or month/day/year), e-mail,
hexadecimal secrets of 32 digits or more.

Defined results: a null text stays null, an empty one empty; a text without a match is returned unchanged; rows are
treated one by one, so repeated rows stay alike; other columns are not touched; an empty table gives no rows.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "secret", "iban", "ipv4", "date", "phone", "ssn", "card")
ROUNDS = 8
MAYBE = r"[0-9@]"

NAME = r"\w\u0300-\u036f\u0900-\u0dff\u0e00-\u0eff+%-"  # with the marks that stand on letters; they stay
FIND = re.compile(
    rf"(?P<email>(?<![{NAME}.])[{NAME}]+(?:\.[{NAME}]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})"
    r"|(?P<secret>(?<![\w])[0-9a-fA-F]{32,}(?!\w))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ipv4>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)(?![A-Za-z_]))"
    r"|(?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/-])(?!\.\d)"
    r"|(?<![\w/.-])\d{4}-\d{2}-\d{2}(?=[Tt]\d{2}|Z\b))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)"
    r"|(?<![\w+.(-])(?:1[ .-])?(?:\(\d{2,5}\) ?|\d{3}(?P<dash>[ .-]))\d{3}(?(dash)(?P=dash)|[ .-])\d{4}(?![\w-])(?!\.\d)"
    r"|(?<![\w+.(-])\(0\d{1,4}\) ?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?![\w-])(?!\.\d)"
    r"|(?<![\w+./-])0\d{1,4}[ /-]\d{3,4}(?:[ -]?\d{2,4}){1,2}(?![\w/-])(?!\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<six>[ -])\d{6}(?P=six)\d{4,5}"
    r"|\d{6}[ -]\d{7,13}|\d{13,19})(?!\w))"
)
ACCENTS = "".join(chr(c) for c in range(0xE0, 0x100) if chr(c).isalpha())


def beyond(c: str) -> bool:
    """A letter or digit of no other alphabet."""
    return c.isalnum() and not c.lower().isascii() and c.lower() not in ACCENTS


@functools.cache
def block_of(c: str) -> int:
    """Letters beyond Latin-1 are permuted among the letters, or the digits, of one kind of case in their 256 code points; CJK and Hangul among all."""
    point, kind = ord(c), 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3
    first = next((a for a, b in ((0x4E00, 0x9FFF), (0xAC00, 0xD7A3)) if a <= point <= b), point & ~0xFF)
    return first * 4 + kind


@functools.cache
def letters_of(block: int) -> str:
    first = block // 4
    size = {0x4E00: 0x5200, 0xAC00: 0x2BA4}.get(first, 0x100)
    return "".join(c for c in map(chr, range(first, first + size)) if beyond(c) and block_of(c) == block)


class Feistel:
    """A keyed permutation of the numbers below any bound, by balanced halves and cycle walking."""

    def __init__(self, key: bytes):
        self.key = key

    def permute(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """``value`` is below ``size``; so is the result."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        low = (1 << half) - 1
        while True:
            left, right = value >> half, value & low
            for k in range(ROUNDS)[:: -1 if back else 1]:
                seed = f"{tweak}:{size}:{k}:{left if back else right}".encode()
                mix = int.from_bytes(hashlib.blake2b(seed, key=self.key, digest_size=(half + 7) // 8).digest(), "big") & low
                left, right = (right ^ mix, left) if back else (right, left ^ mix)
            value = (left << half) | right
            if value < size:
                return value

    def letters(self, text: str, alphabet: str, tweak: str, back: bool = False) -> str:
        """The characters of an alphabet, permuted as one number of fixed length."""
        number = 0
        for c in text:
            number = number * len(alphabet) + alphabet.index(c)
        number = self.permute(number, len(alphabet) ** len(text), tweak, back)
        out = []
        for _ in text:
            number, digit = divmod(number, len(alphabet))
            out.append(alphabet[digit])
        return "".join(reversed(out))


DIGITS, HEX, SMALL = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"


def luhn_digit(payload: str) -> str:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(payload)))
    return str(-total % 10)


def refill(shape: str, chars: str, keep: str) -> str:
    """``shape`` with its characters of ``keep`` replaced, in order; upper case stays upper case."""
    new = iter(chars)
    return "".join((next(new).upper() if c.isupper() else next(new)) if c.lower() in keep else c for c in shape)


class Pseudonyms:
    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back

    def _mixed(self, value: str, kind: str, alphabets: tuple[str, ...]) -> str:
        """Every alphabet's characters permuted among themselves."""
        for alphabet in alphabets:
            chars = "".join(c.lower() for c in value if c.lower() in alphabet)
            if chars:
                value = refill(value, self.feistel.letters(chars, alphabet, f"{kind}{alphabet[0]}", self.back), alphabet)
        return value

    def email(self, value: str) -> str | None:
        local, _, domain = value.rpartition("@")
        new = self._mixed(local, "email", (SMALL, DIGITS, ACCENTS))
        for block in sorted({block_of(c) for c in new if beyond(c)}):
            alphabet = letters_of(block)
            at = [i for i, c in enumerate(new) if beyond(c) and block_of(c) == block]
            mixed = iter(self.feistel.letters("".join(new[i] for i in at), alphabet, f"email{block}", self.back))
            new = "".join(next(mixed) if i in at else c for i, c in enumerate(new))
        return new + "@" + domain if any(c.isalnum() for c in local) else None

    def secret(self, value: str) -> str:
        return self._mixed(value, "secret", (HEX,))

    def phone(self, value: str) -> str | None:
        head = re.match(r"\+\d{1,3}|(?:1[ .-])?\(?\d", value)[0]  # the first digit of an area code tells its form
        rest = value[len(head):]
        return head + self._mixed(rest, "phone", (DIGITS,)) if 6 <= sum(c.isdigit() for c in rest) <= 12 else None

    def ssn(self, value: str) -> str | None:
        area, group, serial = (int(p) for p in value.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        number = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        number, serial = divmod(self.feistel.permute(number, 898 * 99 * 9999, "ssn", self.back), 9999)
        area, group = divmod(number, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def card(self, value: str) -> str | None:
        digits = "".join(c for c in value if c.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        payload = self.feistel.letters(digits[:-1], DIGITS, "card", self.back)
        return refill(value, payload + luhn_digit(payload), DIGITS)

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        rest = lambda body, check: int("".join(str(int(c, 36)) for c in body + plain[:2] + check)) % 97
        if not 15 <= len(plain) <= 34 or rest(plain[4:], plain[2:4]) != 1:
            return None
        body = self._mixed(plain[4:], "iban", (DIGITS, SMALL))
        new = iter(plain[:2] + f"{98 - rest(body, '00'):02d}" + body)
        return "".join(c if c == " " else next(new) for c in value)

    def ipv4(self, value: str) -> str | None:
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        number = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, self.feistel.permute(number, 1 << 32, "ipv4", self.back).to_bytes(4, "big")))

    def date(self, value: str) -> str | None:
        a, b, c = (int(p) for p in re.split(r"[-/.]", value))
        order = "ymd" if value[4:5] == "-" else "dmy"
        if value.count("/") and b > 12:
            order = "mdy"
        parts = dict(zip(order, (a, b, c), strict=True))
        try:
            day = datetime.date(parts["y"], parts["m"], parts["d"])
        except ValueError:
            return None
        first, end = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()
        if not first <= day.toordinal() < end:
            return None
        pool = self._pool(order, first, end)
        new = datetime.date.fromordinal(pool[self.feistel.permute(pool.index(day.toordinal()), len(pool), "date" + order, self.back)])
        fields = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        sep = re.search(r"[-/.]", value)[0]
        return sep.join(fields[f] for f in order)

    def _pool(self, order: str, first: int, end: int) -> list[int]:
        """The days that a date of this order can become: month first only for days above 12, as it is read."""
        if order not in self.__dict__.setdefault("pools", {}):
            days = range(first, end)
            self.pools[order] = [d for d in days if order != "mdy" or datetime.date.fromordinal(d).day > 12]
        return self.pools[order]

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        found: dict[str, int] = {}

        def one(match: re.Match) -> str:
            kind = match.lastgroup
            new = getattr(self, kind)(match[0])
            if new is None:
                return match[0]
            found[kind] = found.get(kind, 0) + 1
            return new

        return FIND.sub(one, text), found


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", found: str = "pii_found") -> DataFrame:
    """All columns, with ``text`` rewritten, and a map column of how many of each kind were found.

    Only texts with a digit or an at sign go to Python's matcher.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("found", T.MapType(T.StringType(), T.IntegerType()))])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = Pseudonyms(secret)
        for batch in batches:
            pairs = [(None, None) if v is None else names.text(v) for v in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()),
                 pa.array([None if p[1] is None else list(p[1].items()) for p in pairs], pa.map_(pa.string(), pa.int32()))],
                ["text", "found"],
            )

    rewrite = F.arrow_udf(run, kind, F.ArrowUDFType.SCALAR_ITER)
    rewritten = rewrite(F.when(F.col(text).rlike(MAYBE), F.col(text)))
    done = docs.withColumn("pii_result", rewritten)
    none = F.create_map().cast("map<string,int>")
    return done.select(
        *[F.coalesce("pii_result.text", F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce("pii_result.found", none).alias(found),
    )
