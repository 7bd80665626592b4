"""Personal data in texts, by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text: at-signs (and their written forms), a plus before a digit, digits
that stand side by side or around a dot, schemes, and cues such as ``IBAN`` or ``account no``. Each anchor has a local
parser that expands from it to the boundaries of an address, a number or an account, and validates what it finds; a
parser never looks at text that isn't next to its anchor, and text that one has used up is not parsed by it again.

The base kinds are email, ip, card and phone. The method adds:

* ``link``: a link with a user's name in it, or to a bare host number (``scheme://user@host``, ``scheme://10.0.0.1``);
* ``iban``: an international bank account number of its country's length whose remainder is 1 modulo 97;
* ``account``: 6 to 18 digits after a cue for an account;
* ``ssn``: a US social security number of three valid groups after a cue;
* ``mail``: an address with its at-sign or dots written out (``name [at] host [dot] org``).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.llm.pieces import text_blocks
from pyrocell.llm.secret_scan import SPANS, merged

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "link", "iban", "account", "ssn", "mail"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AUTHORITY = re.compile(r"(?:(?P<user>[A-Za-z0-9._~%!$&'()*+,;=:-]+)@)?(?P<host>[A-Za-z0-9.-]+)(?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9])+")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([\x20-])(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9-])")
AFTER_CUE = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|num\.?|#))?\x20?[:=#]?\x20?", re.I)
WRITTEN_DOMAIN = re.compile(r"\x20?(?P<first>[A-Za-z0-9-]+)(?P<rest>(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]+)+)", re.I)

#: Lengths of international bank account numbers by country (fixed values of ISO 13616).
IBAN_LENGTH = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}
ACCOUNT_CUES = ["account", "acct", "konto", "kontonummer", "cuenta", "compte"]
SSN_CUES = ["ssn", "social security"]
AT_CUES = ["[at]", "(at)", "{at}"]


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """All anchors with their parser and length, made once for each worker."""
    out = ahocorasick.Automaton()
    anchors = [("email", "@"), ("link", "://")]
    anchors += [("phone", f"+{d}") for d in range(10)]
    anchors += [("ip", f"{a}.{b}") for a in range(10) for b in range(10)]
    anchors += [("card", f"{a}{sep}{b}") for a in range(10) for b in range(10) for sep in ("", " ", "-")]
    anchors += [("iban", f"{country}{d}") for country in IBAN_LENGTH for d in range(10)]
    for kind, cues in (("account", ACCOUNT_CUES), ("ssn", SSN_CUES), ("mail", AT_CUES)):
        anchors += [(kind, form) for cue in cues for form in {cue, cue.capitalize(), cue.upper()}]
    for kind, anchor in anchors:
        out.add_word(anchor, (kind, len(anchor)))
    out.make_automaton()
    return out


def email_at(text: str, at: int, _: int, floor: int):
    """Expands an at-sign to both sides: (start, end, valid), or None where there is no address."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else None


def ip_at(text: str, at: int, _: int, floor: int):
    """Four numbers from the one that holds the anchor's first digit; each must be 255 at most."""
    start = at
    while start > floor and text[start - 1] in DIGITS:
        start -= 1
    m = IP.match(text, start)
    return m and (start, m.end(), all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m.group().split("."))))


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = sum(int(d) for d in digits[::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def card_at(text: str, at: int, _: int, floor: int):
    """A chain of digits from its first one; 12 to 19 of them with a right check digit."""
    m = CARD.match(text, at)
    digits = m.group().replace(" ", "").replace("-", "")
    return at, m.end(), 12 <= len(digits) <= 19 and luhn(digits)


def phone_at(text: str, at: int, _: int, floor: int):
    """From a plus to the last digit of what may stand in a number; 9 to 15 digits."""
    m = PHONE.match(text, at)
    return m and (at, m.end(), 9 <= sum(c in DIGITS for c in m.group()) <= 15)


def link_at(text: str, at: int, size: int, floor: int):
    """A scheme's letters to the left, host and path to the right; personal where it names a user or a bare address."""
    start = at
    while start > floor and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    m = AUTHORITY.match(text, at + size) if start < at else None
    return m and (start, m.end(), m["user"] is not None or IP.fullmatch(m["host"]) is not None)


def iban_at(text: str, at: int, size: int, floor: int):
    """A country's code and as many letters and digits as it has, in groups or not; the number modulo 97 must be 1."""
    m = IBAN.match(text, at) if at == 0 or not text[at - 1].isalnum() else None
    if not m:
        return None
    want, seen, end = IBAN_LENGTH[text[at : at + 2]], 0, at
    while end < m.end() and seen < want:
        seen += text[end] != " "
        end += 1
    body = text[at:end].replace(" ", "")
    whole = seen == want and not text[end : end + 1].isalnum()
    return (at, end, int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1) if whole else None


def account_at(text: str, at: int, size: int, floor: int):
    """Digits after a cue; 6 to 18 of them."""
    if at and text[at - 1].isalnum():
        return None
    m = NUMBER.match(text, AFTER_CUE.match(text, at + size).end())
    return m and (m.start(), m.end(), 6 <= sum(c in DIGITS for c in m.group()) <= 18)


def ssn_at(text: str, at: int, size: int, floor: int):
    """Three groups of digits after a cue."""
    if at and text[at - 1].isalnum():
        return None
    m = SSN.match(text, AFTER_CUE.match(text, at + size).end())
    return m and (m.start(), m.end(), True)


def mail_at(text: str, at: int, size: int, floor: int):
    """A written at-sign, expanded as an address is."""
    start = stop = at - (at > floor and text[at - 1] == " ")
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    m = WRITTEN_DOMAIN.match(text, at + size) if start < stop else None
    return m and (start, m.end(), True)


PARSERS = {"email": email_at, "ip": ip_at, "card": card_at, "phone": phone_at, "link": link_at, "iban": iban_at, "account": account_at, "ssn": ssn_at, "mail": mail_at}


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind as listed. Those of one kind don't overlap."""
    used = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (kind, size) in automaton().iter(text):
        at = last + 1 - size
        if at < used[kind]:
            continue
        found = PARSERS[kind](text, at, size, used[kind])
        if found:
            start, used[kind], valid = found
            if valid:
                spans.append((kind, start, used[kind]))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id and ``spans`` in order of start.

    A null or empty text has none; repeated rows and null ids are kept row by row; an empty table gives an empty result;
    other columns aren't read. Whole texts are scanned, however long, in one pass without a shuffle; a worker holds one
    block of texts (or one text) at a time.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first, stop, texts in text_blocks(batch.column(1)):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts]
                yield pa.record_batch([batch.column(0).slice(first, stop - first), pa.array(spans, kind)], names=["id", "spans"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, all columns kept, with every span of the text replaced by its kind in brackets, such as ``[EMAIL]``;
    spans that overlap become one, of the first one's kind. Null texts stay null."""
    names = df.columns
    where = names.index(text_col)

    def masked(text: str) -> str:
        out, at = [], 0
        for kind, a, b in merged(find(text)):
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        return "".join([*out, text[at:]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first, stop, texts in text_blocks(batch.column(where)):
                arrays = list(batch.slice(first, stop - first).columns)
                empty = arrays[where].is_null().to_numpy(zero_copy_only=False)
                arrays[where] = pa.array([None if n else masked(t) for t, n in zip(texts, empty, strict=True)], pa.string())
                yield pa.record_batch(arrays, names=names)

    return df.mapInArrow(run, df.schema)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of all kinds, the SHA-256 of the base kinds' spans as text, and all spans as text."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return scanned.select(id_col, *map(n, BASE), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), *map(n, KINDS[len(BASE) :]))
