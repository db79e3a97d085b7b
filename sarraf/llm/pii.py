"""Personal data: anchors found with Aho-Corasick, expanded and checked by local parsers.

One pass of an automaton over the whole text finds at-signs, ``://`` of schemes
and cues of identifiers (account, IBAN, passport, password, street and the like).
A deterministic parser then reads outwards from each anchor to the boundaries
of the address, account or secret, and checks it: label structure, mod-97,
number ranges.  Digits and plus signs are their own anchors: numbers are read
where they stand and checked (parts of an IP address, Luhn, number of digits).

Spans are code points, end exclusive, over the whole text.  The base kinds
email, ip, card and phone are found leftmost and without overlap per kind; a
failed check drops the match.  Kinds may overlap each other.

Nulls and empty texts have no spans; repeated rows are read alike; empty tables
give empty results; other columns are carried along.  Time is linear in the
length of a text, also in runs without end of digits, brackets or letters.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from sarraf.llm.common import frugal, table

BASE_KINDS = ("email", "ip", "card", "phone")
#: All kinds, in the order of spans that start together.
KINDS = (*BASE_KINDS, "login", "iban", "account", "ssn", "passport", "secret", "address")
_RANK = {k: i for i, k in enumerate(KINDS)}

# Cues and the parser that reads from them.
CUES = {
    "iban": "iban",
    "account": "account", "acct": "account", "konto": "account", "compte": "account", "cuenta": "account",
    "ssn": "ssn", "social security": "ssn",
    "passport": "passport", "reisepass": "passport", "passeport": "passport", "pasaporte": "passport",
    "password": "secret", "passwd": "secret", "pwd": "secret", "token": "secret", "secret": "secret",
    "api_key": "secret", "api key": "secret", "apikey": "secret",
    "akia": "key", "asia": "key",
    "street": "address", "avenue": "address", "road": "address", "lane": "address", "boulevard": "address",
    "straße": "address_de", "strasse": "address_de",
    "rue": "address_fr", "calle": "address_es",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}$")
_LOGIN = re.compile(r"[^\s/@:?#]{1,128}:[^\s/@?#]{1,128}(?=@)")
_IBAN = re.compile(r"[\x20:=#-]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\x20?(?:no|number|nr|num|n°|nummer)\b)?[.:#=\x20]{1,3}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])", re.I)
_SSN = re.compile(r"(?:\x20?(?:no|number)\b)?[.:#=\x20]{1,3}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])", re.I)
_PASSPORT = re.compile(r"(?:\x20?(?:no|number|nr|nummer)\b)?[.:#=\x20]{1,3}((?=[A-Z0-9]{0,8}[0-9])[A-Z0-9]{6,9})(?![A-Za-z0-9])")
_SECRET = re.compile(r"\x20?[=:]\x20?([\"']?)((?=[^\s\"']*[0-9])[^\s\"',;]{8,256})\1")
_KEY = re.compile(r"A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])")
_HOUSE = re.compile(r"(?<![0-9])[0-9]{1,5}[A-Za-z]?,?\x20(?:[A-ZÀ-Ý][\w.'-]{0,30}\x20){1,4}$")
_NUMBER = re.compile(r"\x20[0-9]{1,4}[a-z]?\b")
_CAPITAL = re.compile(r"\b[A-ZÀ-Ý][\w-]{0,40}$")
_BEFORE = re.compile(r"(?<![0-9])[0-9]{1,4}(?:\x20?bis)?,?\x20$")
_NAMES = re.compile(r"(?:\x20(?:d[eu]s?|la|le|les|l'|del|los|las)\b)*(?:\x20[A-ZÀ-Ý][\w'-]{1,30}){1,4}")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("://", ("scheme", 3))
    for cue, parser in CUES.items():
        for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
            if parser != "key" or form.isupper():
                found.add_word(form, (parser, len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _numbers(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _IP.finditer(text):
        # A part of over three digits other than leading zeros is above 255.
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = m.group() if m.group().isdigit() else _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield "phone", m.start(), m.end()


def _address(parser: str, text: str, at: int, end: int) -> tuple[int, int] | None:
    near = text[max(0, at - 160) : at]
    if parser == "address":
        if m := _HOUSE.search(near):
            return at - len(near) + m.start(), end
    elif parser == "address_de":
        number = _NUMBER.match(text, end)
        if number and (m := _CAPITAL.search(near + text[at:end])):
            return at - len(near) + m.start(), number.end()
    else:
        names = _NAMES.match(text, end)
        if names and parser == "address_fr" and (m := _BEFORE.search(near)):
            return at - len(near) + m.start(), names.end()
        if names and parser == "address_es" and (m := _NUMBER.match(text, names.end())):
            return at, m.end()
    return None


_AFTER = {"account": _ACCOUNT, "ssn": _SSN, "passport": _PASSPORT, "iban": _IBAN}


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a whole text, by start, then kind."""
    if not text:
        return []
    spans = []
    if _DIGIT.search(text):
        spans.extend(_numbers(text))
    mail_end = 0
    ends = dict.fromkeys(KINDS, 0)
    for last, (parser, length) in _automaton().iter(text):
        at, end = last + 1 - length, last + 1
        if parser == "@":
            start = at
            while start > mail_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, end)):
                mail_end = m.end()
                spans.append(("email", start, mail_end))
            continue
        if parser == "scheme":
            m = _LOGIN.match(text, end) if _SCHEME.search(text[max(0, at - 17) : at]) else None
            found = m and ("login", m.start(), m.end())
        elif at and text[at - 1].isalnum() and parser != "address_de":
            continue
        elif parser == "key":
            m = _KEY.match(text, at)
            found = m and ("secret", at, m.end())
        elif parser == "secret":
            m = _SECRET.match(text, end)
            found = m and ("secret", m.start(2), m.end(2))
        elif parser.startswith("address"):
            place = _address(parser, text, at, end)
            found = place and ("address", *place)
        else:
            m = _AFTER[parser].match(text, end)
            found = m and (parser != "iban" or _mod97(m.group(1))) and (parser, m.start(1), m.end(1))
        if found and found[1] >= ends[found[0]]:
            ends[found[0]] = found[2]
            spans.append(found)
    spans.sort(key=lambda s: (s[1], _RANK[s[0]]))
    return spans


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans as the first kind in brackets."""
    parts, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


SPANS = "array<struct<kind:string,start:int,end:int>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in batch.column("text").to_pylist()
        ]
        columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW_SPANS)], [*names, "pii_spans"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and pii_spans of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_find, f"doc_id {kind}, pii_spans {SPANS}")


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t if t is None else redacted(t, find_spans(t)) for t in batch.column("text").to_pylist()]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind; all other columns stay, ``n_chars`` follows the text."""
    fields = [StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    out = docs.mapInArrow(frugal(_redact), StructType(fields))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op5_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii_spans")).alias("spans"),
    )
