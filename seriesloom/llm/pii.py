"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, a plus before a digit, digits, digits around
a point, ``://`` and identifier cues. At each anchor a small parser widens to the boundary of the item
and validates it. Text without anchors costs nothing beyond the pass.

Base kinds are e-mail, IP address, card and phone number, found leftmost and without overlap per kind.
Added kinds are login addresses (a URL with user and password), IBANs, account numbers behind a cue,
street addresses and secrets behind a cue.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seriesloom.llm.common import batches, ship

ship(__name__)

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account", "address", "secret")
BATCH_BYTES = 1 << 22

# The contract's patterns, cut at their anchors, and the cues of the added kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:[^\s/@]+@[A-Za-z0-9.-]+(?::[0-9]+)?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
ACCOUNT = re.compile(r"[^\S\n]*(?:number|no\.?|nr\.?|#)?[^\S\n]*[:=]?[^\S\n]*([0-9]{8,17})(?![0-9])", re.IGNORECASE)
ADDRESS = re.compile(r"[0-9]{1,5}[A-Za-z]?(?:\x20[A-Z][a-z]+){1,3}\x20(?:Street|Avenue|Road|Boulevard|Lane|Drive)(?![A-Za-z])")
SECRET = re.compile(r"[\"']?[^\S\n]*[:=][^\S\n]*[\"']?([A-Za-z0-9+/_=-]{16,})")
ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct")
IBAN_CUES = ("IBAN", "Iban", "iban")
ADDRESS_CUES = (" Street", " Avenue", " Road", " Boulevard", " Lane", " Drive")
SECRET_CUES = ("token", "Token", "TOKEN", "secret", "SECRET", "password", "PASSWORD", "api_key", "API_KEY", "apikey")


def luhn(digits: str) -> bool:
    """Whether the digits end in their Luhn check digit."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """Whether an IBAN's remainder is 1."""
    packed = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1


def anchors():
    """The automaton; a hit tells the parser to try."""
    import ahocorasick

    found = ahocorasick.Automaton()
    words = {"@": "email", "://": "login"}
    words |= {str(d): "digit" for d in range(10)} | {f"+{d}": "phone" for d in range(10)}
    words |= {f"{a}.{b}": "ip" for a in range(10) for b in range(10)}
    for kind, cues in (("iban", IBAN_CUES), ("account", ACCOUNT_CUES), ("address", ADDRESS_CUES), ("secret", SECRET_CUES)):
        words |= dict.fromkeys(cues, kind)
    for word, kind in words.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _word_before(text: str, at: int) -> bool:
    return at > 0 and (text[at - 1].isalnum() or text[at - 1] == "_")


def find_spans(text: str, automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every item, in order of start and kind; ends are exclusive.

    Per kind ``done`` is where the last match ended, kept or dropped; nothing starts before it.
    """
    out: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)

    def add(kind: str, start: int, end: int) -> None:
        out.append((start, KINDS.index(kind), end))

    for last, (hit, size) in automaton.iter(text):
        at = last - size + 1
        if hit == "digit":
            if at >= done["card"]:
                m = DIGITS.match(text, at)
                done["card"] = m.end() if m else at + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
        elif hit == "email":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                add("email", start, m.end())
                done["email"] = m.end()
        elif hit == "ip":
            if at >= done["ip"]:
                start = at
                while start > done["ip"] and "0" <= text[start - 1] <= "9":
                    start -= 1
                if m := QUAD.match(text, start):
                    done["ip"] = m.end()
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                        add("ip", start, m.end())
        elif hit == "phone":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    add("phone", at, m.end())
        elif hit == "login":
            start = at
            while start > done["login"] and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            if m := LOGIN.match(text, start):
                add("login", start, m.end())
                done["login"] = m.end()
        elif hit == "iban":
            if at >= done["iban"] and not _word_before(text, at):
                start = last + 1
                while start < len(text) and text[start] in " :=#\t":
                    start += 1
                m = IBAN.match(text, start)
                # The run may take in words behind the number; the longest valid head is the IBAN.
                for end in range(m.end(), m.start() + 14, -1) if m else ():
                    if text[end - 1] != " " and iban_valid(text[m.start() : end]):
                        add("iban", m.start(), end)
                        done["iban"] = end
                        break
        elif hit == "address":
            # The longest form is a number of five digits, a letter and three names before the cue.
            start, words = at, 0
            while start > done["address"] and words < 4 and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] == " "):
                start -= 1
                words += text[start] == " "
                if text[start].isdigit() and (start == 0 or not text[start - 1].isalnum()) and (m := ADDRESS.match(text, start)):
                    add("address", start, m.end())
                    done["address"] = m.end()
                    break
        elif at >= done[hit] and not _word_before(text, at):
            m = (ACCOUNT if hit == "account" else SECRET).match(text, last + 1)
            if m:
                add(hit, *m.span(1))
                done[hit] = m.end(1)
    out.sort()
    return out


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in capitals; overlapping ones become one."""
    kept, end, name = [], 0, ""
    at = 0
    for start, kind, stop in [*spans, (len(text) + 1, 0, 0)]:
        if start >= end:
            if end:
                kept += [text[at : at_start], f"[{name}]"]
                at = end
            at_start, end, name = start, stop, KINDS[kind].upper()
        else:
            end = max(end, stop)
    return "".join([*kept, text[at:]])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


COUNTS = [f"n_{k}" for k in BASE]


def personal_data(docs: DataFrame, key: str, text: str, redacted: bool = True) -> DataFrame:
    """``key``, counts and digest of the base kinds, all spans and, if ``redacted``, the cleaned text.

    One row per input row, whole texts, other columns left out. A null text counts as empty and has
    no spans; its cleaned text stays null. Repeated rows give equal rows; an empty table gives none.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in tables:
            table = pa.table([batch.column(0), batch.column(1)], names=["key", "text"])
            for a, b in batches(table, BATCH_BYTES, "text"):
                some = table.slice(a, b - a)
                counts, digests, spans, cleaned = [[] for _ in BASE], [], [], []
                for value in some.column("text").to_pylist():
                    found = find_spans(value or "", automaton)
                    base = [s for s in found if s[1] < len(BASE)]
                    for i, column in enumerate(counts):
                        column.append(sum(s[1] == i for s in base))
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    spans.append(joined(found))
                    if redacted:
                        cleaned.append(redact(value, found) if found else value)
                columns = [some.column("key").combine_chunks(), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans, pa.string())]
                if redacted:
                    columns.append(pa.array(cleaned, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, *COUNTS, "base_sha256", "spans", "cleaned"][: len(columns)])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_sha256 string, spans string" + ", cleaned string" * redacted
    return docs.select(key, text).mapInArrow(run, schema)


@F.pandas_udf(StringType())
def redacted_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Each text with its personal data replaced by their kinds; null stays null."""
    automaton = anchors()
    for some in texts:
        yield pd.Series([t if t is None or not (found := find_spans(t, automaton)) else redact(t, found) for t in some], dtype=object)


def redacted_rows(docs: DataFrame, text: str, n_chars: str) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted anew where it was."""
    rows = docs.select(F.struct("*").alias("doc"), redacted_text(F.col(text)).alias("clean"))
    changed = ~F.col("clean").eqNullSafe(F.col("doc").getField(text))
    given = {c: F.col("doc").getField(c).alias(c) for c in docs.columns}
    given[text] = F.col("clean").alias(text)
    given[n_chars] = F.when(changed, F.length("clean").cast("long")).otherwise(F.col("doc").getField(n_chars)).alias(n_chars)
    return rows.select(*given.values())
