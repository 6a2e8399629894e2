"""Secret scans: keyword prefilter, anchored patterns near hits, embedded checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds the places of keywords.
Patterns are tried at hits only, anchored there, from left to right and not inside an earlier
match of the same kind, which gives what a leftmost non-overlapping search would.

Base kinds
    ``assign``  a word such as ``password`` with ``:`` or ``=`` and a value of 6 or more
    ``access``  ``AKIA`` and what follows, 20 characters or more
    ``hex``     24 or more hexadecimal digits; its keywords are all runs of four such digits

Kinds that carry their own checksum, found only if it holds
    ``github``  ``ghp_ gho_ ghu_ ghs_ ghr_``, 30 characters and their CRC-32 in base 62
    ``npm``     ``npm_``, the same
    ``age``     ``AGE-SECRET-KEY-1``, bech32
    ``nostr``   ``nsec1``, bech32
    ``xprv``    an extended private key, base58 with a double SHA-256
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm.common import map_rows

KINDS = ("assign", "access", "hex", "github", "npm", "age", "nostr", "xprv")
BASE_KINDS = ("assign", "access", "hex")

# Keywords in lower case and the kinds they stand for.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "api_key": "assign", "apikey": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "age-secret-key-1": "age", "nsec1": "nostr", "xprv": "xprv",
}
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "age": re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Z0-9])"),
    "nostr": re.compile(r"nsec1[02-9ac-hj-np-z]{58}(?![a-z0-9])"),
    "xprv": re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_holds(token: str) -> bool:
    """The last six characters are the CRC-32, in base 62, of those after the underscore."""
    body, given = token.split("_", 1)[1][:-6], token[-6:]
    crc, digits = zlib.crc32(body.encode()), ""
    while crc:
        crc, digit = divmod(crc, 62)
        digits = BASE62[digit] + digits
    return given == digits.rjust(6, "0")


def bech32_holds(token: str) -> bool:
    prefix, _, data = token.lower().rpartition("1")
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    values += [BECH32.index(c) for c in data]
    check = 1
    for value in values:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            check ^= step if top >> bit & 1 else 0
    return check == 1


def base58_holds(token: str) -> bool:
    number = 0
    for c in token:
        number = number * 58 + BASE58.index(c)
    try:
        raw = number.to_bytes(82, "big")
    except OverflowError:
        return False
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


CHECKS: dict[str, Callable[[str], bool]] = {
    "github": crc_holds,
    "npm": crc_holds,
    "age": bech32_holds,
    "nostr": bech32_holds,
    "xprv": base58_holds,
}


def build_automaton():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    # The kinds of a keyword, and how far before its last character it starts.
    for digits in map("".join, itertools.product("0123456789abcdef", repeat=4)):
        automaton.add_word(digits, ("hex", 3))
    for keyword, kind in KEYWORDS.items():
        automaton.add_word(keyword, (kind, len(keyword) - 1))
    automaton.make_automaton()
    return automaton


def _lowered(text: str) -> str:
    """Lower case, every character in its place."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text)
    return lower


def find_secrets(text: str | None, automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all secrets, by start and then by kind."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    ends = dict.fromkeys(KINDS, 0)
    for last, (kind, back) in automaton.iter(_lowered(text)):
        at = last - back
        if at < ends[kind]:
            continue
        match = PATTERNS[kind].match(text, at)
        if not match:
            continue
        ends[kind] = match.end()
        if kind == "assign":
            good = match.end(2) - match.start(2) >= 6
        elif kind == "access":
            good = match.end() - at >= 20
        elif kind == "hex":
            good = match.end() - at >= 24
        else:
            good = CHECKS[kind](match.group())
        if good:
            found.append((at, KINDS.index(kind), match.end()))
    found.sort()
    return [(KINDS[k], start, end) for start, k, end in found]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, secrets`` of every row: an array of ``kind, start, end`` in code points.

    A null or empty text has none.  Other columns are not looked at, repeated rows come out
    repeatedly.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        automaton = build_automaton()

        def apply(batch: pa.RecordBatch) -> dict:
            return {
                id_col: batch.column(0),
                "secrets": [
                    [{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t, automaton)]
                    for t in texts(batch.column(1))
                ],
            }

        return apply

    def texts(column: pa.Array) -> Iterator[str | None]:
        return (value.as_py() for value in column)

    frame = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = frame.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, secrets array<struct<kind:string,start:int,end:int>>"
    return map_rows(frame, make, schema, "_text")


def secret_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``"""

    def joined(secrets):
        return F.array_join(
            F.transform(
                secrets,
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return scan(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
