"""Secret scan: keyword automaton first, anchored patterns near its hits, checksums last.

One Aho-Corasick pass over the ASCII-lowered text finds the keywords of all
kinds; a kind's pattern is then tried only where one of its keywords starts.
Hex runs have no keyword of their own: there the automaton's part is a
search for sixteen hex characters in the text mapped to character classes.
Kinds beyond the base ones are kept only if what they embed holds: the CRC-32 of
an access token, the check digits of an account number (mod 97) or of a card
number (Luhn), the JSON header of a signed web token.

Each scan sees a whole text; positions are code points, ends exclusive.  Null
and empty texts have no spans; repeated rows have each their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The base kinds' patterns and least lengths, in listed order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
# Token formats with an embedded CRC-32 in base 62 (six last characters).
CHECKED = re.compile(r"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
CHECKED_KEYWORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
ACCOUNT = re.compile(r"""iban["']?\x20*[:=]?\x20*["']?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])""",
                     re.IGNORECASE | re.ASCII)
CARD = re.compile(r"""card(?:\x20?(?:number|no\.?))?["']?\x20*[:=]?\x20*["']?([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])""",
                  re.IGNORECASE | re.ASCII)
KINDS = ("assign", "access", "hex", "checked", "signed", "account", "card")
BASE_KINDS = KINDS[:3]

_AS_CLASS = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x2E for b in range(256))
_automaton = None


def automaton() -> ahocorasick.Automaton:
    """keyword -> (kind, length), built once per worker process."""
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        for kind, words in (("assign", ASSIGN_KEYWORDS), ("access", ("akia",)), ("checked", CHECKED_KEYWORDS),
                            ("signed", ("eyj",)), ("account", ("iban",)), ("card", ("card",))):
            for w in words:
                a.add_word(w, (kind, len(w)))
        a.make_automaton()
        _automaton = a
    return _automaton


def checksum_holds(token: str) -> bool:
    """The last six characters are the base-62 CRC-32 of the random part."""
    body = token.split("_", 1)[1]
    n, out = zlib.crc32(body[:-6].encode()), ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(6, "0") == body[-6:]


def signed_header(part: str) -> bool:
    """The base64url part is a JSON object that names its algorithm."""
    try:
        header = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def account_length(number: str) -> int:
    """Characters of the longest leading groups whose check digits hold, or 0."""
    end = len(number)
    while end > 0:
        plain = number[:end].replace(" ", "").upper()
        if len(plain) < 15:
            return 0
        if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return end
        end = number.rfind(" ", 0, end)
    return 0


def luhn_holds(number: str) -> bool:
    digits = [int(c) for c in number if c.isdigit()]
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return any(digits) and (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _span(kind: str, m: re.Match) -> tuple[int, int] | None:
    """Where the secret of a match lies, if it is one."""
    start, end = m.span()
    if kind in ("account", "card"):
        start, end = m.span(1)
    if kind == "account":
        end = start + account_length(m[1])
    holds = {"assign": lambda: len(m[2]) >= ASSIGN_LEAST, "access": lambda: end - start >= ACCESS_LEAST,
             "checked": lambda: checksum_holds(m[0]), "signed": lambda: signed_header(m[1]),
             "account": lambda: end > start, "card": lambda: luhn_holds(m[1])}
    return (start, end) if holds[kind]() else None


_PATTERN = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED, "signed": SIGNED, "account": ACCOUNT, "card": CARD}


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of every span, in result order."""
    if not text:
        return []
    ascii_only = text.isascii()
    raw = text.encode("utf-8", "replace")
    lowered = text.lower() if ascii_only else raw.lower().decode("utf-8")  # bytes.lower touches A-Z only
    starts: dict[str, set[int]] = {}
    for end, (kind, n) in automaton().iter(lowered):
        starts.setdefault(kind, set()).add(end - n + 1)
    spans = []
    for kind, found in starts.items():
        done = 0
        for s in sorted(found):
            # A pattern's match starts at a keyword, so trying keyword starts
            # in order is the leftmost non-overlapping search.
            if s >= done and (m := _PATTERN[kind].match(text, s)):
                done = m.end()
                if where := _span(kind, m):
                    spans.append((where[0], KINDS.index(kind), where[1]))
    classes, run, at = raw.translate(_AS_CLASS), b"h" * HEX_LEAST, 0
    while (at := classes.find(run, at)) >= 0:
        start = classes.rfind(b".", 0, at) + 1
        end = classes.find(b".", at)
        end = len(classes) if end < 0 else end
        before = start if ascii_only else len(raw[:start].decode("utf-8"))
        spans.append((before, KINDS.index("hex"), before + end - start))
        at = end
    return sorted(spans)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _report(text: str | None) -> tuple:
    spans = scan(text)
    base = [x for x in spans if KINDS[x[1]] in BASE_KINDS]
    count = [sum(k == i for _, k, _ in base) for i in range(3)]
    return (*count, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))


def report(text: Column) -> Column:
    """Struct ``(n_assign, n_access, n_hex, base_sha256, spans)`` of a text column."""
    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_report(t) for t in texts],
                            columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run(text)


def mask(text: str | None, mark: str = "[SECRET]") -> str | None:
    """``text`` with every (merged) span replaced by ``mark``."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def masked(text: Column) -> Column:
    """The text column with its secrets masked; nulls stay null."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(mask)

    return run(text)
