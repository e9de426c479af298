"""Matches of a pattern with their places, by built-in functions only.

``split`` gives the text between the leftmost non-overlapping matches and
``regexp_extract_all`` the matches; running sums of their lengths are the
places, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Matches per chunk of the running sum: appending to an array copies it, so
# one chunk per match list would take quadratic time.
CHUNK = 128
CONTEXT = 32

_SPAN = "array<struct<start:bigint,end:bigint,m:string,g:string,l:string,r:string>>"


def literal(pattern: str) -> str:
    """A pattern as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find_spans(text: str, pattern: str, group: int = 0, context: int = CONTEXT) -> Column:
    """Array of ``(start, end, m, g, l, r)`` for the matches of ``pattern``, end exclusive.

    ``m`` is the match, ``g`` its ``group``, ``l`` and ``r`` up to
    ``context`` code points before and after it, ending at a neighbouring
    match.  Empty for a null text.
    """
    p = literal(pattern)
    return F.expr(f"""case when {text} rlike {p} then
      element_at(transform(array(named_struct(
        'p', split({text}, {p}, -1), 'm', regexp_extract_all({text}, {p}, 0),
        'g', regexp_extract_all({text}, {p}, {group}))), x ->
      element_at(transform(array(transform(sequence(0, cast((size(x.m) - 1) div {CHUNK} as int)), k ->
          transform(sequence(k * {CHUNK}, least(size(x.m), (k + 1) * {CHUNK}) - 1), i -> named_struct(
            'gap', cast(length(x.p[i]) as bigint), 'len', cast(length(x.m[i]) as bigint), 'i', i)))),
      chunks -> flatten(zip_with(chunks,
        aggregate(chunks, named_struct('at', 0L, 'out', cast(array() as array<bigint>)),
          (a, c) -> named_struct('at', a.at + aggregate(c, 0L, (s, y) -> s + y.gap + y.len),
                                 'out', concat(a.out, array(a.at)))).out,
        (c, at) -> aggregate(c, named_struct('at', at, 'out', cast(array() as {_SPAN})),
          (a, y) -> named_struct('at', a.at + y.gap + y.len, 'out', concat(a.out, array(named_struct(
            'start', a.at + y.gap, 'end', a.at + y.gap + y.len, 'm', x.m[y.i], 'g', x.g[y.i],
            'l', right(x.p[y.i], {context}), 'r', left(x.p[y.i + 1], {context})))))).out))), 1)), 1)
      else cast(array() as {_SPAN}) end""")


def joined(spans: str, order: str) -> Column:
    """``kind:start:end`` of an array of spans, sorted by the fields of ``order``, comma-joined."""
    fields = ", ".join(f"s.{x}" for x in order.split())
    return F.expr(f"""concat_ws(',', transform(array_sort(transform({spans}, s -> struct({fields},
        concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string)) as text))), s -> s.text))""")
