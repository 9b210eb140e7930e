"""Secrets in texts: named forms, and strings of high entropy.

The named forms (assignments, access keys, long hexadecimal words) come from expressions. The method adds
strings without a known form: in every candidate (a stretch of one character class) a window slides over
the characters; their counts, and with them the window's Shannon entropy, are updated by the character
that enters and the one that leaves. Stretches covered by windows at or above the class's threshold are
reported, unless an allow-list knows the candidate as harmless or a span already covers them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The expressions of the contract (the first in either case); a match fails if the group is
# shorter than the number. Long hexadecimal words are asked for by length at once: no other match is there.
FORMS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WINDOW = 20  # characters
#: Character classes: kind, characters of a candidate, least entropy of a window in bits a character.
CLASSES = (("entropy_hex", "0-9A-Fa-f", 2.8), ("entropy_base64", "A-Za-z0-9+/_=-", 3.7))
#: Candidates that match one of these whole are harmless: words and paths, numbers and dates, UUIDs,
#: integrity digests (their label is part of the candidate).
ALLOWED = (
    r"[A-Za-z]+([/_=+-]+[A-Za-z]+)*[/_=+-]*",
    r"[0-9]+([/_=+-]+[0-9]+)*",
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"(md5|sha1|sha256|sha384|sha512)[=-][A-Za-z0-9+/_=-]+",
)
#: Candidates that hold one of these are listings of an alphabet.
LISTINGS = ("0123456789", "abcdefghijklm", "nopqrstuvwxyz", "ABCDEFGHIJKLM", "NOPQRSTUVWXYZ")
KINDS = (*(f[0] for f in FORMS), *(c[0] for c in CLASSES))
UNIT = 1 << 20  # of the entropy sums: they are integers, hence the same whatever the order of additions
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,match:string>>"


def weights(window: int) -> list[int]:
    """c log2 c in units, for counts up to ``window``."""
    return [round(UNIT * c * math.log2(c)) if c else 0 for c in range(window + 1)]


def limit(window: int, least: float) -> int:
    """A window's entropy is ``least`` or more if the weights of its counts add up to at most this."""
    return math.floor(UNIT * window * (math.log2(window) - least))


def _named(text: str, forms) -> Iterator[tuple[str, int, int]]:
    for kind, expression, group, least in forms:
        for m in expression.finditer(text):
            if len(m[group]) >= least:
                yield kind, m.start(), m.end()


def hot_spans(candidate: str, window: int, most: int, w: list[int]) -> list[tuple[int, int]]:
    """Stretches (start, end) of ``candidate`` that windows with a sum of at most ``most`` cover."""
    counts: dict[str, int] = {}
    total, out = 0, []
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += w[n + 1] - w[n]
        if i >= window:
            gone = candidate[i - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += w[n - 1] - w[n]
        if i + 1 >= window and total <= most:
            start = i + 1 - window
            if out and out[-1][1] >= start:
                out[-1] = out[-1][0], i + 1
            else:
                out.append((start, i + 1))
    return out


class Scanner:
    def __init__(self, window: int, classes, allowed, listings, known):
        self.forms = [(k, re.compile(e, re.ASCII | (re.IGNORECASE if k == "assign" else 0)), g, n)
                      for k, e, g, n in FORMS]
        self.classes = [(k, re.compile(rf"[{chars}]{{{window},}}"), limit(window, least))
                        for k, chars, least in classes]
        self.window, self.weights = window, weights(window)
        self.allowed = re.compile("|".join(f"(?:{a})" for a in allowed)) if allowed else None
        self.listings, self.known = listings, known

    def harmless(self, candidate: str) -> bool:
        return bool(candidate in self.known or self.allowed and self.allowed.fullmatch(candidate)
                    or any(x in candidate for x in self.listings))

    def spans(self, text: str) -> list[tuple[str, int, int, bool]]:
        out = [(*s, True) for s in _named(text, self.forms)]
        for kind, expression, most in self.classes:
            for m in expression.finditer(text):
                hot = hot_spans(m[0], self.window, most, self.weights)
                if hot and not self.harmless(m[0]):
                    own = [(m.start() + a, m.start() + b) for a, b in hot]
                    out += [(kind, a, b, False) for a, b in own
                            if not any(s <= a and b <= e for _, s, e, _ in out)]
        order = {k: i for i, k in enumerate((*(f[0] for f in FORMS), *(c[0] for c in self.classes)))}
        return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                 window: int = WINDOW, classes=CLASSES, allowed=ALLOWED, listings=LISTINGS,
                 known: frozenset[str] = frozenset()) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` as they are and ``spans`` (kind, start and end in code
    points, whether it is of a named form, and the string), by start, then kind.

    ``known`` are candidates that are no secrets in this corpus. A null or empty text has no spans.
    Repeated rows are returned as often, with equal results. The work is linear in a text's length, however
    long. Other columns, whatever their names, are not read.
    """
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("t"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_()), ("match", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(window, classes, allowed, listings, known)
        for batch in batches:
            rows = [[{"kind": k, "start": s, "end": e, "base": b, "match": t[s:e]}
                     for k, s, e, b in scanner.spans(t)] if t else []
                    for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)],
                                             names=[*(f"k{i}" for i in range(len(keep))), "spans"])

    schema = ", ".join([*(f"k{i} {source.schema[i].dataType.simpleString()}" for i in range(len(keep))),
                        f"spans {SPANS}"])
    return source.mapInArrow(scan, schema).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "spans")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end, comma-joined) of the
    result of ``find_secrets``."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k, *_ in FORMS],
                        F.sha2(text(F.filter("spans", lambda s: s["base"])).cast("binary"), 256)
                        .alias("base_sha256"), text(F.col("spans")).alias("spans"))
