"""Personal data in texts: patterns propose spans, checksums confirm them,
nearby words adjust a score.

Defined results: a null text counts as empty (no spans); repeated rows are
scanned each by themselves; ties cannot occur (spans of a kind do not
overlap); an empty table gives an empty table; of the input only the two named
columns are read, so other columns never clash; texts are scanned whole,
whatever their length, in time linear in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import slices

#: kinds in the order in which spans are listed: the base kinds, then the added ones
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

#: score of a span that passed its checksum, and what a context word adds
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "e-mail"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"), "ssn": ("ssn", "social", "security"),
}
CONTEXT_CHARS, CONTEXT_GAIN = 40, 0.3
#: added kinds below this score are not reported; base kinds always are
THRESHOLD = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(ch, 36)) for ch in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            begin = at
            while begin > done and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                yield begin, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        yield from (("email", a, b) for a, b in _emails(text))
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind as listed, then start."""
    found = []
    for kind, a, b in _proposed(text or ""):
        near = text[max(0, a - CONTEXT_CHARS):b + CONTEXT_CHARS].lower()
        words = re.findall(r"[a-z-]+", near)
        score = min(1.0, PRIOR[kind] + CONTEXT_GAIN * any(w in CONTEXT[kind] for w in words))
        if kind in BASE or score >= THRESHOLD:
            found.append((kind, a, b, score))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def mask_text(text: str | None, spans) -> str | None:
    """The text with each run of overlapping spans replaced by ``[KIND]`` of its first span."""
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < done:
            if b > done:
                done = b
            continue
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join([*out, text[done:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii_spans`` (array of kind, start, end, score) and
    ``pii_masked`` (the text with the spans replaced)."""
    kept = [c for c in df.columns if c not in ("pii_spans", "pii_masked")]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                                   StructType)
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()),
                       StructField("end", LongType()), StructField("score", DoubleType())])
    schema = StructType([*df.schema.fields, StructField("pii_spans", ArrayType(span)),
                         StructField("pii_masked", StringType())])

    def run(batches):
        for b in slices(batches, text):
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            spans = [find_spans(t) for t in texts]
            masked = [mask_text(t, s) for t, s in zip(texts, spans)]
            rows = [[dict(zip(("kind", "start", "end", "score"), s)) for s in x] for x in spans]
            cols = [*b.columns, pa.array(rows, pa.list_(_SPAN)), pa.array(masked, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, "pii_spans", "pii_masked"])

    return df.mapInArrow(run, schema)


def digest(df: DataFrame) -> DataFrame:
    """One row per document of (doc_id, text): counts and span strings."""
    found = scan(df.select("doc_id", "text")).select("doc_id", "pii_spans")

    def line(kinds):
        listed = F.filter("pii_spans", lambda s: s["kind"].isin(*kinds)) if kinds else F.col("pii_spans")
        return F.array_join(F.transform(listed, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(line(BASE), 256).alias("base_sha256"), line(None).alias("spans"))


def masked_documents(df: DataFrame) -> DataFrame:
    """Documents with their personal data masked and ``n_chars`` brought up to date."""
    out = scan(df)
    cols = []
    for c in df.columns:
        if c == "text":
            cols.append(F.col("pii_masked").alias("text"))
        elif c == "n_chars":
            cols.append(F.char_length("pii_masked").cast(df.schema["n_chars"].dataType).alias("n_chars"))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)


