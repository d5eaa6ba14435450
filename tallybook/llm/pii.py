"""Operator 2: personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, schemes, digit pairs and
the cue words of identifiers. At each anchor a small deterministic parser expands the span to its
boundaries and checks it. The kinds, in the order in which they are listed:

- email, ip, card, phone: the base kinds. Their spans are those of a leftmost, non-overlapping scan
  with the patterns of `BASE`, of which the ones that fail their check (parts, digits, Luhn) go.
- url: from a scheme to the next white space, quote or angle bracket, less closing punctuation.
- account: an IBAN with right check digits, or 6 to 34 letters and digits, three digits at least,
  after a cue such as "account number".
- secret: a value after "password", "token", "api_key" or "secret" and "=" or ":", or an access key id.

Positions are code points, the end exclusive. Defined cases: null is an empty text; an empty text
has no spans; very long texts take time and memory in proportion to their length; repeated rows
give repeated results, and so do rows that share an id; of ties at one place the parsers run in
alphabetic order, each kind for itself; an empty table gives an empty one; extra columns are left out of the spans table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import map_rows, table

#: The patterns of the base kinds.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*BASE, "url", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
ACCOUNT_CUES = ("iban", "account number", "account no", "account", "acct", "konto", "cuenta", "compte")
SECRET_CUES = ("password", "passwd", "token", "api_key", "apikey", "secret")

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(BASE["phone"])
URL = re.compile(r"[^\s\"'<>]+")
NUMBER = re.compile(r"[\s:#.=-]{1,4}([A-Z]{0,4}[0-9][A-Z0-9]{1,33}(?: [A-Z0-9]{2,4}){0,8})")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SIGN = re.compile(r"\s{0,3}[=:]\s{0,3}[\"']?")
VALUE = re.compile(r"[^\s\"',;]{6,}")
KEY_ID = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (v * 2 if v < 5 else v * 2 - 9)
    return total % 10 == 0


def iban_ok(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def anchors():
    """The automaton; each pattern carries the parsers that start at it and its length."""
    import ahocorasick

    found: dict[str, set[str]] = {}

    def put(pattern: str, parser: str) -> None:
        found.setdefault(pattern, set()).add(parser)

    put("@", "email")
    put("+", "phone")
    put("AKIA", "key")
    for a in DIGITS:
        for b in DIGITS:
            put(f"{a}.{b}", "ip")
            for gap in ("", " ", "-"):
                put(f"{a}{gap}{b}", "card")
    for parser, words in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for word in words:
            for form in (word, word.capitalize(), word.upper()):
                put(form, parser)
    automaton = ahocorasick.Automaton()
    for pattern, parsers in found.items():
        automaton.add_word(pattern, (len(pattern), tuple(sorted(parsers))))
    automaton.make_automaton()
    return automaton


class Scanner:
    """The parsers over one text. `free` is where the next span of a kind may start."""

    def __init__(self, automaton):
        self.automaton = automaton

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        self.text = text
        self.free = dict.fromkeys(KINDS, 0)
        self.found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        for last, (length, parsers) in self.automaton.iter(text):
            start = last - length + 1
            for parser in parsers:
                getattr(self, parser)(start, last + 1)
        return [(k, a, b) for k in KINDS for a, b in sorted(self.found[k])]

    def keep(self, kind: str, start: int, end: int, ok: bool = True) -> None:
        if ok:
            self.found[kind].append((start, end))
        self.free[kind] = end

    def email(self, at: int, _: int) -> None:
        text, start, free = self.text, at, self.free["email"]
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            self.keep("email", start, domain.end())

    def ip(self, start: int, _: int) -> None:
        text, free = self.text, self.free["ip"]
        if start < free:
            return
        while start > free and text[start - 1] in DIGITS:
            start -= 1
        quad = QUAD.match(text, start)
        if not quad:
            self.free["ip"] = DOTTED.match(text, start).end()
            return
        parts = [p.lstrip("0") for p in quad[0].split(".")]
        self.keep("ip", start, quad.end(), all(len(p) <= 3 and int(p or "0") <= 255 for p in parts))

    def card(self, start: int, _: int) -> None:
        if start < self.free["card"]:
            return
        run = CARD.match(self.text, start)
        digits = run[0].replace(" ", "").replace("-", "")
        self.keep("card", start, run.end(), 13 <= len(digits) <= 19 and luhn(digits))

    def phone(self, start: int, _: int) -> None:
        run = PHONE.match(self.text, start)
        if run:
            self.keep("phone", start, run.end(), 9 <= sum(c in DIGITS for c in run[0]) <= 15)

    def url(self, start: int, end: int) -> None:
        if start < self.free["url"]:
            return  # inside a span: looking at the rest of its run again would take quadratic time
        rest = URL.match(self.text, end)
        if rest:
            stop = end + len(rest[0].rstrip(".,;:!?)]}"))
            if stop > end:
                self.keep("url", start, stop)

    def account(self, start: int, end: int) -> None:
        number = NUMBER.match(self.text, end)
        if number and number.start(1) >= self.free["account"] and sum(c in DIGITS for c in number[1]) >= 3:
            code = IBAN.match(self.text, number.start(1))
            stop = code.end() if code and iban_ok(code[0]) else number.start(1) + len(number[1].split(" ")[0])
            if stop - number.start(1) >= 6:
                self.keep("account", number.start(1), stop)

    def secret(self, start: int, end: int) -> None:
        gap = SIGN.match(self.text, end)
        if gap and gap.end() >= self.free["secret"]:
            value = VALUE.match(self.text, gap.end())
            if value:
                self.keep("secret", value.start(), value.end())

    def key(self, start: int, _: int) -> None:
        code = KEY_ID.match(self.text, start)
        if code and start >= self.free["secret"]:
            self.keep("secret", start, code.end())


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and `found`: an array of (kind, start, end) in the order of the kinds, then start."""

    def make():
        scanner = Scanner(anchors())

        def work(_, texts):
            every = [scanner.spans(t or "") for t in texts]
            return [[[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in every]]

        return work

    return map_rows(docs, ["doc_id", "text"], make, "found array<struct<kind:string,start:int,end:int>>")


def redacted(text: str | None, spans) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents' ids with `redacted_text`."""

    def make():
        scanner = Scanner(anchors())
        return lambda _, texts: [[redacted(t, scanner.spans(t or "")) for t in texts]]

    return map_rows(docs, ["doc_id", "text"], make, "redacted_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    found = find_spans(table(spark, sf_dir, "documents"))
    joined = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    base = ", ".join(f"'{k}'" for k in BASE)
    counts = [
        F.expr(f"CAST(size(filter(found, x -> x.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.expr(f"sha2({joined.format(f'filter(found, x -> x.kind IN ({base}))')}, 256)").alias("base_sha256"),
        F.expr(joined.format("found")).alias("spans"),
    )
