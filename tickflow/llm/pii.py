"""Personal data and secrets by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, plus signs, digits, URL schemes, words
that announce an account, a password or a key, prefixes of key formats) in one pass over
a text whose ASCII letters are folded to lower case; a deterministic parser at each
anchor expands and validates the boundaries of what it announces, in the text as it is.
Of a run of digits the first one is the anchor.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base kinds, in the order in which they are listed, then the added ones.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:")
CUES = (
    *("iban", "account number", "account no", "acct", "routing number"),
    *("kontonummer", "numéro de compte", "número de cuenta"),
    *("ssn", "social security number"),
)

#: Names of values that are secret where a sign and a value follow.
NAMES = (
    *("password", "passwd", "passphrase", "pwd", "secret", "token", "bearer"),
    *("api key", "api_key", "api-key", "apikey", "access key", "access_key", "access-key"),
    *("private key", "private_key", "client_secret", "passwort", "kennwort"),
    *("mot de passe", "contraseña"),
)
#: Key formats by their prefix: what the whole key looks like.
KEY_FORMATS = {
    "akia": r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "asia": r"ASIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "aiza": r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])",
    "ghp_": r"ghp_[A-Za-z0-9]{36,}",
    "gho_": r"gho_[A-Za-z0-9]{36,}",
    "ghs_": r"ghs_[A-Za-z0-9]{36,}",
    "github_pat_": r"github_pat_[A-Za-z0-9_]{22,}",
    "glpat-": r"glpat-[A-Za-z0-9_-]{20,}",
    "xoxb-": r"xoxb-[A-Za-z0-9-]{10,}",
    "xoxp-": r"xoxp-[A-Za-z0-9-]{10,}",
    "sk_live_": r"sk_live_[A-Za-z0-9]{16,}",
    "sk-": r"sk-[A-Za-z0-9_-]{20,}",
    "eyj": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*",
    "-----begin ": r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY( BLOCK)?-----"
    r"(?:[A-Za-z0-9+/=:,.\s-]*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----)?",
}
_FORMATS = {prefix: re.compile(pattern) for prefix, pattern in KEY_FORMATS.items()}
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_VALUE = re.compile(r"[\"']?(?:\s{0,3}(?:[:=]|=>|is)\s{0,3}|\s)[\"']?([^\s\"'<>,;]{6,200})")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USER_HOST = re.compile(
    r"[^\s/?#@\x00-\x20\"<>]+@[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:[/?#][^\s\"<>]*)?"
)
_MAIL_TO = re.compile(r"[^\s@\"<>]+@[A-Za-z0-9.-]+")
_GAP = re.compile(r"[\s:#.=]{0,4}(?:no|nr|is)?[\s:#.=]{0,3}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,19}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")

Span = tuple[int, int, int]


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "+"):
        found.add_word(mark, (mark, mark))
    for digit in string.digits:
        found.add_word(digit, ("0", digit))
    for what, words in (("scheme", SCHEMES), ("cue", CUES), ("name", NAMES), ("key", KEY_FORMATS)):
        for word in words:
            found.add_word(word, (what, word))
    found.make_automaton()
    return found


def _emails(text: str, at_signs: list[int]) -> Iterator[Span]:
    last = 0
    for at in at_signs:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield 0, start, last


def _runs(pattern: re.Pattern, text: str, runs: list[int]) -> Iterator[re.Match]:
    """Matches from the first digits of runs on, leftmost and without overlaps.

    No match can start inside a run whose first digit starts none.
    """
    last = 0
    for at in runs:
        if at >= last and (match := pattern.match(text, at)):
            last = match.end()
            yield match


def _ips(text: str, runs: list[int]) -> Iterator[Span]:
    for match in _runs(_IP, text, runs):
        parts = [p.lstrip("0") for p in match[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield 1, match.start(), match.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str, runs: list[int]) -> Iterator[Span]:
    for match in _runs(_CARD, text, runs):
        if match.end() - match.start() >= 12:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield 2, match.start(), match.end()


def _phones(text: str, pluses: list[int]) -> Iterator[Span]:
    last = 0
    for at in pluses:
        if at >= last and (match := _PHONE.match(text, at)):
            last = match.end()
            if 9 <= sum(c.isdecimal() for c in match[0]) <= 15:
                yield 3, at, last


def _iban_valid(written: str) -> bool:
    plain = written.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _address(text: str, scheme: str, at: int) -> Span | None:
    """A URL that names a user, or a mailto address, from its scheme on."""
    match = (_MAIL_TO if scheme == "mailto:" else _USER_HOST).match(text, at)
    if match and "." in match[0].rpartition("@")[2]:
        return 4, at - len(scheme), match.start() + len(match[0].rstrip(".,;:!?"))
    return None


def _account(text: str, cue: str, at: int) -> Span | None:
    """What an account cue announces, if it parses as such a number."""
    start = _GAP.match(text, at).end()
    if cue.startswith(("ssn", "social")):
        match = _SSN.match(text, start)
    elif match := _IBAN.match(text, start):
        # The longest valid number; a word after it may look like a part of it.
        end = match.end()
        while end > start and not _iban_valid(text[start:end]):
            end -= 1
        return (5, start, end) if end > start else None
    else:
        match = _NUMBER.match(text, start)
    return (5, match.start(), match.end()) if match else None


def _named(text: str, name: str, at: int) -> Span | None:
    """The value that a secret's name announces: no mere word, but with a digit or a sign."""
    match = _VALUE.match(text, at)
    if not match:
        return None
    value = match[1].rstrip(".!?)]}")
    plain = name == "bearer" or any(c in ":=" for c in text[at : match.start(1)])
    odd = sum(not c.isalpha() for c in value)
    if len(value) < 6 or not odd or (not plain and (len(value) < 12 or odd < 2)):
        return None
    return 6, match.start(1), match.start(1) + len(value)


def _key(text: str, prefix: str, at: int) -> Span | None:
    match = _FORMATS[prefix].match(text, at - len(prefix))
    return (6, match.start(), match.end()) if match else None


_PARSERS = {"scheme": _address, "cue": _account, "name": _named, "key": _key}


def spans_of(text: str) -> list[Span]:
    """(kind number, start, end) in code points, by start, then kind, then end."""
    marks: dict[str, list[int]] = {"@": [], "+": [], "0": []}
    found: set[Span] = set()
    before = -2
    folded = text.lower() if text.isascii() else text.translate(_FOLD)
    for end, (what, word) in _anchors().iter(folded):
        if what == "0":
            if end != before + 1:
                marks["0"].append(end)
            before = end
        elif what in marks:
            marks[what].append(end)
        else:
            begin = end + 1 - len(word)
            if begin and text[begin - 1].isalnum() and word[0].isalnum():
                continue
            if span := _PARSERS[what](text, word, end + 1):
                found.add(span)
    found.update(_emails(text, marks["@"]))
    found.update(_phones(text, marks["+"]))
    found.update(_ips(text, marks["0"]))
    found.update(_cards(text, marks["0"]))
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and ``spans``, an array of (kind, start, end).

    Offsets count code points, the end is exclusive; spans go by start, then kind as
    listed. Spans of one base kind don't overlap; other spans may, also with those. Null and
    empty texts have none. Repeated rows are scanned alike; an empty table gives an empty
    result; other columns are not read.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans_of(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, type=pa.list_(kind))], names=["doc_id", "spans"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col))
    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        scan, f"doc_id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    )
