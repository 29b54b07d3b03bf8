"""Secret scan with multipart credential linking.

Base kinds (always reported): ``assign`` (a key word, a separator and a value),
``access`` (cloud access identifiers) and ``hex`` (long hexadecimal runs).

Weak candidates say little alone: an identifier beside a user or client key
word, an unlabelled secret (a run of ``LEAST_SECRET`` key characters or more, of
mixed classes or high entropy), an endpoint; none has an upper length.  They are reported only
where complementary parts meet: the text is cut into scopes (runs of lines
without an empty line between them, in windows of at most ``SCOPE`` characters
around a part), the parts of a scope are interval-joined, and

* an identifier (weak or ``access``) and a secret (weak, ``assign`` or ``hex``)
  confirm each other;
* an endpoint is reported where such a confirmed pair stands in its scope, and
  it confirms a weak secret or identifier that stands with a base span.

The join is a sweep over the parts sorted by position: each part asks for the
nearest part of the wanted kind on either side, so a text with many parts costs
a sort, never all pairs.  One row is one document; nothing is shuffled.

Defined results: a null text is an empty text, without spans; repeated rows are
scanned each; an empty table gives an empty result; only the named columns are
read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from math import log2

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import texts

SCOPE = 400                      # characters between two parts of one credential, at most
KINDS = ["assign", "access", "hex", "ident", "secret", "endpoint"]   # order of kinds at one start

# The base patterns, and the least length of what they find.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

IDENT = re.compile(r"""\b(?:access_?key_?id|client_?id|account|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
                   re.IGNORECASE | re.ASCII)
LEAST_SECRET, ENTROPY = 32, 4.2     # bits a character that letters of one case and digits need
SECRET = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{{{LEAST_SECRET},}}+={{0,2}}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|s3)://[^\s\"'<>]{4,}", re.ASCII)
EMPTY_LINE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, failing ones dropped."""
    lower = text.lower() if not text.isascii() else text.casefold()
    out: list[Span] = []
    if any(w in lower for w in WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def secret_like(run: str) -> bool:
    """Upper and lower case letters and digits, or digits and letters of one
    case in the disorder of a random key."""
    upper, lower, digit = (re.search(c, run) for c in ("[A-Z]", "[a-z]", "[0-9]"))
    if not digit or not (upper or lower):
        return False
    return bool(upper and lower) or -sum(n / len(run) * log2(n / len(run)) for n in Counter(run).values()) >= ENTROPY


def weak_parts(text: str) -> list[Span]:
    out = [("ident", m.start(), m.end()) for m in IDENT.finditer(text)] if ":" in text or "=" in text else []
    out += [("secret", m.start(), m.end()) for m in SECRET.finditer(text) if secret_like(m[0])]
    if "://" in text:
        out += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    return out


class Near:
    """The parts of some kinds by position, for "is one in my scope?"."""

    def __init__(self, parts: list[Span], breaks: list[int], scope: int):
        self.parts, self.breaks, self.scope = sorted(parts, key=lambda p: (p[1], p[2])), breaks, scope
        self.starts, self.ends = [p[1] for p in self.parts], sorted(p[2] for p in self.parts)

    def beside(self, part: Span) -> bool:
        """A part other than and apart from ``part`` stands within the scope's
        characters of it and in the same run of lines."""
        _, start, end = part
        run = bisect_right(self.breaks, start)
        low = max(start - self.scope, self.breaks[run - 1] if run else 0)
        high = min(end + self.scope, self.breaks[run] if run < len(self.breaks) else end + self.scope)
        # the nearest following start and the nearest preceding end decide
        i = bisect_left(self.starts, end)
        if i < len(self.parts) and self.parts[i][1] < high:
            return True
        i = bisect_right(self.ends, start) - 1
        return i >= 0 and self.ends[i] >= low


def linked(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak candidates that complementary parts in their scope confirm."""
    weak = weak_parts(text)
    if not weak:
        return []
    breaks = [m.end() for m in EMPTY_LINE.finditer(text)]
    of = {k: [p for p in [*base, *weak] if p[0] == k] for k in KINDS}
    # a weak part that a base span covers adds nothing
    covered = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in covered]
    reach, most = [], 0
    for _, e in covered:
        reach.append(most := max(most, e))

    def overlaps(p: Span) -> bool:
        i = bisect_left(starts, p[2]) - 1
        return i >= 0 and reach[i] > p[1]

    ids, secrets = [*of["ident"], *of["access"]], [*of["secret"], *of["assign"], *of["hex"]]
    near_ids, near_secrets = Near(ids, breaks, scope), Near(secrets, breaks, scope)
    near_base, near_ends = Near(base, breaks, scope), Near(of["endpoint"], breaks, scope)

    def confirmed(p: Span, others: Near) -> bool:
        return others.beside(p) or near_ends.beside(p) and near_base.beside(p)

    found = [p for p in of["ident"] if confirmed(p, near_secrets)] + [p for p in of["secret"] if confirmed(p, near_ids)]
    good_ids = Near([p for p in ids if near_secrets.beside(p)], breaks, scope)
    good_secrets = Near([p for p in secrets if near_ids.beside(p)], breaks, scope)
    found += [p for p in of["endpoint"] if good_ids.beside(p) and good_secrets.beside(p)]
    return [p for p in found if not overlaps(p)]


def scan(text: str, scope: int = SCOPE) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and then kind."""
    def order(p: Span):
        return p[1], KINDS.index(p[0]), p[2]
    base = sorted(base_spans(text), key=order)
    return base, sorted([*base, *linked(text, base, scope)], key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, scope: int = SCOPE) -> str:
    """The text with every found span (overlapping ones together) replaced."""
    out, at = [], 0
    merged: list[list] = []
    for kind, s, e in scan(text, scope)[1]:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"[{kind} removed]"]
        at = e
    return "".join([*out, text[at:]])


def scan_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row."""
    def run(batches):
        for b in batches:
            rows = []
            for text in texts(b.column(1)):
                base, every = scan(text, scope)
                n = [sum(p[0] == k for p in base) for k in KINDS[:3]]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with the found spans replaced in ``text`` and ``n_chars`` counted
    anew where it exists; all columns stay, a null text stays null."""
    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        return text.map(lambda t: redact(t, scope), na_action="ignore")

    out = docs.withColumn("text", clean(F.col("text").cast("string")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
