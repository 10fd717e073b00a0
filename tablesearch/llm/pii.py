"""Personal data: patterns propose spans, checksums confirm them, and words nearby adjust their score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import text_chunks

#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Further kinds: account numbers (mod 97), and local phone and social security numbers, which need a word nearby.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])")
SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")

KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "ssn")
BASE = KINDS[:4]
#: The score of a span of each kind by itself, the words that raise it within WINDOW characters before or half as many
#: after, those that lower it just before, and by how much.
PRIOR = {"email": 0.95, "ip": 0.7, "card": 0.85, "phone": 0.8, "iban": 0.95, "local_phone": 0.35, "ssn": 0.35}
CONTEXT = {
    "email": ("mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "contact"),
    "iban": ("iban", "account", "bank"),
    "local_phone": ("phone", "call", "tel", "mobile", "contact", "fax"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = ("version", "order", "invoice", "serial", "isbn", "build")
WINDOW, RAISE, LOWER, KEEP = 40, 0.3, 0.3, 0.5
#: What IP matches, each run of digits read once: a match always starts where a run of digits does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What EMAIL.finditer gives; only places around an at sign are looked at, so long words cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            yield m.span()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the base kinds, by start, then kind as listed."""
    spans = [(s, e, 0) for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            spans += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() <= 37 and 12 <= len(digits := "".join(_DIGITS.findall(m[0]))) <= 19 and luhn(digits):
                spans.append((*m.span(), 2))
        if "+" in text:
            spans += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return [(s, e, BASE[k]) for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1]))]


def score(text: str, start: int, end: int, kind: str) -> float:
    near = _WORD.findall(text[max(0, start - WINDOW) : start].lower() + " " + text[end : end + WINDOW // 2].lower())
    just_before = _WORD.findall(text[max(0, start - WINDOW // 2) : start].lower())
    value = PRIOR[kind] + RAISE * any(w.startswith(CONTEXT[kind]) for w in near) - LOWER * any(w.startswith(AGAINST) for w in just_before)
    return max(0.0, min(1.0, value))


def find_spans(text: str, keep: float = KEEP) -> list[tuple[int, int, str, float]]:
    """All spans with their scores, by start, then kind. Base spans stay whatever their score; others need keep or more."""
    found = [(s, e, k, score(text, s, e, k)) for s, e, k in base_spans(text)]
    if _DIGITS.search(text):
        more = [(*m.span(), "iban") for m in IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
        more += [(*m.span(), "local_phone") for m in LOCAL_PHONE.finditer(text)]
        more += [(*m.span(), "ssn") for m in SSN.finditer(text)]
        found += [(*m, x) for m in more if (x := score(text, *m)) >= keep]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def redact(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first, in brackets."""
    out, done, last = [], 0, 0
    for start, end, kind, _ in spans:
        if start >= last:
            out += [text[done:start], f"[{kind.upper()}]"]
            done = last = end
        else:
            done = last = max(last, end)
    return "".join([*out, text[done:]])


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k, *_ in spans)


_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))


def _find(details: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            found = [find_spans(t) for t in texts]
            base = [[x for x in f if x[2] in BASE] for f in found]
            out = {"id": batch.column("id")}
            for k in BASE:
                out[f"n_{k}"] = pa.array([sum(x[2] == k for x in b) for b in base], pa.int64())
            out["base_sha256"] = pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base])
            out["spans"] = pa.array([_joined(f) for f in found])
            if details:
                out["found"] = pa.array([[{"start": s, "end": e, "kind": k, "score": x} for s, e, k, x in f] for f in found], _FOUND)
                out["redacted"] = pa.array([redact(t, f) if f else t for t, f in zip(texts, found, strict=True)])
            yield pa.RecordBatch.from_arrays([*out.values()], [*out])

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", details: bool = True) -> DataFrame:
    """Personal data in each whole text: id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end,...) and, with
    details, found (array of start, end, kind, score) and redacted (the text with spans replaced by [KIND]).

    The four base kinds count as matched and validated (ip parts, Luhn, digit counts), whatever stands around them.
    iban spans need mod 97; local_phone and ssn spans a score of KEEP, so a word nearby. Offsets are code points, the end
    exclusive. A null text counts as empty: no spans, an empty redacted text. Each input row gives one row, whatever its
    id; other columns are ignored; an empty table gives an empty table. The time grows in proportion to a text's length.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    more = ", found array<struct<start:long,end:long,kind:string,score:double>>, redacted string" if details else ""
    return base.mapInArrow(_find(details), f"id {kind}, {counts}, base_sha256 string, spans string{more}").withColumnRenamed("id", id_col)


def _redact_rows(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, text_col):
            i = batch.schema.get_field_index(text_col)
            new = [redact(t, f) if (f := find_spans(t)) else t for t in texts]
            valid = batch.column(i).is_valid().to_pylist()
            yield batch.set_column(i, batch.schema.field(i), pa.array([n if v else None for n, v in zip(new, valid, strict=True)], batch.schema.field(i).type))

    return run


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span of find_pii replaced in text_col; a null text stays null; all columns and rows are kept."""
    return docs.mapInArrow(_redact_rows(text_col), docs.schema)
