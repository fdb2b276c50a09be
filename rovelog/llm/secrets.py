"""Secret scan: keywords found by an Aho-Corasick automaton, anchored patterns only at the hits.

The automaton runs once over a text and says where a secret can begin.  A pattern is tried at
those places alone, and what it matches is checked by the checksum the secret carries, where its
kind has one.  Runs of hexadecimal digits have no keyword; one plain scan finds them.

Base kinds (no checksum, reported as they stand): ``assign``, ``access``, ``hex``.
Kinds with a checksum: ``github`` and ``npm`` (the last six of the 36 characters after the prefix
are the base-62 CRC32 of the first thirty), ``card`` (Luhn, with a card word before it), ``iban``
(remainder 1 modulo 97) and ``jwt`` (the first part decodes to a JSON object that names its
algorithm).
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import small_batches, table

KINDS = ("assign", "access", "hex", "github", "npm", "card", "iban", "jwt")
BASE = KINDS[:3]

# Keywords (lower case), and the pattern that is tried where a keyword starts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
CARD = re.compile(r"card\D{0,20}((?:\d[ -]?){12,18}\d)(?!\d)", re.IGNORECASE | re.ASCII)
IBAN = re.compile(r"iban[^A-Za-z0-9]{0,5}([A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])", re.IGNORECASE | re.ASCII)
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]*")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
    "ghs_": "github", "ghr_": "github", "npm_": "npm", "card": "card", "iban": "iban", "eyj": "jwt",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_in_tail(body: str) -> bool:
    """The last six characters are the CRC32 of the others in base 62, padded with zeros."""
    value, digits = binascii.crc32(body[:-6].encode()), ""
    while value:
        value, at = divmod(value, 62)
        digits = BASE62[at] + digits
    return digits.rjust(6, "0") == body[-6:]


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def names_algorithm(head: str) -> bool:
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and isinstance(found.get("alg"), str)


#: Kind: its pattern, and from a match the span to report, or None if a check fails.
RULES = {
    "assign": (ASSIGN, lambda m: m.span() if len(m[2]) >= 8 else None),
    "access": (ACCESS, lambda m: m.span() if len(m[0]) >= 16 else None),
    "github": (GITHUB, lambda m: m.span() if crc_in_tail(m[1]) else None),
    "npm": (NPM, lambda m: m.span() if crc_in_tail(m[1]) else None),
    "card": (CARD, lambda m: m.span(1) if luhn(re.sub(r"\D", "", m[1])) else None),
    "iban": (IBAN, lambda m: m.span(1) if mod97(m[1].replace(" ", "").upper()) else None),
    "jwt": (JWT, lambda m: m.span() if names_algorithm(m[1]) else None),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def scan(text: str, words: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every secret, in that order; code points, end exclusive.

    Matches of a kind do not overlap: a place inside the last match of its kind, valid or not, is passed over.
    A token that fails has failed for all places in its first part, which end where it does; so
    these are passed over too, and the work is linear in the text.
    """
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow when lower-cased
        lower = text.translate(_TO_LOWER)
    starts: list[tuple[int, str]] = [(end + 1 - size, kind) for end, (kind, size) in words.iter(lower)]
    starts.sort()
    found, free = [], dict.fromkeys(RULES, 0)
    for start, kind in starts:
        if start < free[kind]:
            continue
        pattern, span_of = RULES[kind]
        match = pattern.match(text, start)
        if match:
            free[kind] = match.end()
            span = span_of(match)
            if span:
                found.append((span[0], KINDS.index(kind), span[1]))
        elif kind == "jwt" and text.startswith("eyJ", start):
            free[kind] = JWT_RUN.match(text, start).end()
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(set(found))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: ``key`` and ``secrets``, an array of (kind, start, end).

    The array is in order of start, then of KINDS; it is empty for a null or empty text.  Other
    columns of ``docs`` are not read.  A text is scanned whole in one task, whatever its length.
    """
    small_batches(docs.sparkSession)
    key_type = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = automaton()
        for batch in batches:
            out = [[(KINDS[k], s, e) for s, k, e in scan(t, words)] if t else [] for t in batch["_text"]]
            yield pd.DataFrame({"_key": batch["_key"], "secrets": out})

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found = rows.mapInPandas(run, f"_key {key_type}, secrets array<struct<kind:string,start:int,end:int>>")
    return found.withColumnRenamed("_key", key)


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of the base kinds, and all spans, from ``secrets``."""
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.withColumns({f"n_{kind}": of(kind) for kind in BASE}).withColumns(
        {"base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col("secrets"))}
    ).drop("secrets")


def sha256_of(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(listed([s for s in spans if s[1] < len(BASE)]).encode()).hexdigest()


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf_dir, "documents")))
