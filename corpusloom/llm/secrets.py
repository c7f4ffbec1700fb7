"""Secret scans with multipart credential linking.

Strong patterns (assignments, access identifiers, long hexadecimal runs) are
reported wherever they stand. Weak candidates (mixed 40-character keys, endpoints,
account names) are common in clean text, so each is reported only when the parts
that complete it lie in the same scope: intervals of ``reach`` code points around
the candidate are joined with the sorted intervals of the other parts.

The join is within one text, by binary search over its sorted parts, so it runs
in the task that reads the row and nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KEY40 = re.compile(r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:/[A-Za-z0-9_./-]*)?")
ACCOUNT = re.compile(
    r"(?:user(?:name)?|login|account|client_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]{3,})",
    re.IGNORECASE | re.ASCII,
)
HINTS = re.compile(r"passw|secret|token|api_?key|akia", re.IGNORECASE | re.ASCII)

#: Kinds in the order that breaks ties between spans with one start. The first three are strong.
KINDS = ("assign", "access", "hex", "key40", "endpoint", "account")
REACH = 400
SPANS = "array<struct<kind:string,start:int,end:int,linked:boolean>>"


def strong_parts(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each strong kind that are long enough; spans are whole matches."""
    out = []
    if HINTS.search(text):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return out


class _Near:
    """Whether a part of some kind starts or ends within reach of an interval."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]

    def any(self, start: int, end: int, reach: int) -> bool:
        # Spans of one kind don't overlap, so their ends are sorted as well: only
        # the first span from `start - reach` on, and the one before it, can decide.
        i = bisect_left(self.starts, start - reach)
        if i < len(self.spans) and self.spans[i][0] <= end + reach:
            return True
        return i > 0 and self.spans[i - 1][1] >= start - reach


def find(text: str | None, reach: int = REACH) -> list[tuple[int, int, str, bool]]:
    """Spans ``(start, end, kind, linked)`` of a text, by start and then kind.

    A mixed 40-character key is reported near an access identifier or account
    name; an endpoint or account name near a secret (an assignment or a reported
    key) and, for endpoints, an identifier or account name as well. Null and empty: no spans. A
    text of any length is scanned whole, and parts further apart have no say.
    """
    if not text:
        return []
    strong = strong_parts(text)
    out = [(*s, False) for s in strong]
    keys = [
        m.span()
        for m in KEY40.finditer(text)
        if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])
    ]
    # Every link has a key in it or an assignment.
    if keys or any(kind == "assign" for _, _, kind in strong):
        of = lambda kind: [(s, e) for s, e, k in strong if k == kind]
        access, assign = _Near(of("access")), _Near(of("assign"))
        accounts = [m.span() for m in ACCOUNT.finditer(text)]
        account = _Near(accounts)
        keys = [s for s in keys if access.any(*s, reach) or account.any(*s, reach)]
        key = _Near(keys)
        secret = lambda s: assign.any(*s, reach) or key.any(*s, reach)
        accounts = [s for s in accounts if secret(s)]
        endpoints = [
            m.span()
            for m in ENDPOINT.finditer(text)
            if secret(m.span()) and (access.any(*m.span(), reach) or account.any(*m.span(), reach))
        ]
        for kind, spans in (("key40", keys), ("endpoint", endpoints), ("account", accounts)):
            out += [(*s, kind, True) for s in spans]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_spans(text: Column, reach: int = REACH) -> Column:
    """Column of spans (code points, end exclusive); an empty array where there are none."""

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        rows = [
            [{"kind": k, "start": s, "end": e, "linked": linked} for s, e, k, linked in find(t.as_py(), reach)]
            for t in texts
        ]
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("linked", pa.bool_())])
        )
        return pa.array(rows, kind)

    return scan(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; of overlapping spans, the first start wins."""
    piece = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(text.isNotNull(), piece)


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
