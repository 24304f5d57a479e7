"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text; nothing is known of it but what it
returns.  Each conversation is rendered for its successive prefixes, and each output
is compared with the one before: what it adds is the span of the newest turn.  A
template whose output does not begin with the previous one rewrites its history;
that is reported, and spans that the rewrite touches are dropped.  Where a turn's own
text lies in its span is found by rendering two one-letter texts in its place.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Batches, in_arrow, kept_table, read, to_batch

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

# A turn reads "### role: text</turn>\n"; these characters are marked inside roles and texts.
_IN_ROLE, _IN_TEXT, _MARKED = re.compile(r"[\\#<:]"), re.compile(r"[\\#<]"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)

SPANS = "array<struct<turn:int,role:string,start:long,stop:long,text_start:long,text_stop:long>>"
SCHEMA = (f"conv_id long, n_turns long, formatted string, spans {SPANS}, "
          "rewrites_history boolean, first_rewrite int")


def marked_turns(turns: Sequence[Turn]) -> str:
    """The default template; control strings inside roles and texts are escaped."""
    return "".join(f"### {_IN_ROLE.sub(r'\\\g<0>', role)}: {_IN_TEXT.sub(r'\\\g<0>', text)}</turn>\n"
                   for role, text in turns)


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text)


def read_back(formatted: str) -> list[Turn]:
    """The turns that :func:`marked_turns` rendered."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


@dataclass(frozen=True)
class Rendered:
    formatted: str
    # (turn, role, start, stop, text_start, text_stop), offsets in code points; texts may be None
    spans: list[tuple]
    first_rewrite: int | None


def _text_place(template: Template, before: Sequence[Turn], role: str) -> tuple[str, str] | None:
    """What the template puts before and after the newest text; None if it does not show it once."""
    a, b = (template([*before, (role, probe)]) for probe in "ab")
    if len(a) != len(b):
        return None
    at = len(os.path.commonprefix([a, b]))
    return (a[:at], a[at + 1:]) if a[at:at + 1] == "a" and a[at + 1:] == b[at + 1:] else None


def render_stretch(turns: Sequence[Turn], template: Template, loss_roles: Iterable[str], first: int,
                   last: int) -> tuple[str, list[tuple], list[tuple[int, int]]]:
    """Render the prefixes that end with turns ``first`` up to ``last``, two outputs at a time.

    Returns the last output, a span per turn, and (turn, start) of every rewrite: the turn whose
    output differs from the one before, and where.
    """
    before, spans, rewrites = template(turns[:first]), [], []
    for k in range(first, last):
        after = template(turns[:k + 1])
        start = len(before)
        if not after.startswith(before):
            start = len(os.path.commonprefix([before, after]))
            rewrites.append((k, start))
        role, place = turns[k][0], None
        if role in loss_roles:
            place = _text_place(template, turns[:k], role)
        inside = (None, None)
        if place and after.startswith(place[0]) and after.endswith(place[1]) \
                and len(after) >= len(place[0]) + len(place[1]):
            inside = (len(place[0]), len(after) - len(place[1]))
        spans.append((k, role, start, len(after), *inside))
        before = after
    return before, spans, rewrites


def untouched(spans: Iterable[tuple], rewrites: Iterable[tuple[int, int]]) -> list[tuple]:
    """The spans that no later turn rewrote; both come in order of turns."""
    kept: list[tuple] = []
    where = dict(rewrites)
    for span in spans:
        while kept and span[0] in where and kept[-1][3] > where[span[0]]:
            kept.pop()
        kept.append(span)
    return kept


def render(turns: Sequence[Turn], template: Template, loss_roles: Iterable[str] = ()) -> Rendered:
    """Render all prefixes and locate every turn.

    ``text_start`` and ``text_stop`` are found for turns of ``loss_roles`` only.
    """
    formatted, spans, rewrites = render_stretch(turns, template, loss_roles, 0, len(turns))
    return Rendered(formatted, untouched(spans, rewrites), rewrites[0][0] if rewrites else None)


def _conversations(batches: Batches) -> Iterator[tuple[int | None, list[Turn]]]:
    """Consecutive rows of one conversation, whatever batch they came in."""
    current, turns = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for conv, role, text in zip(*columns):
            if turns and conv != current:
                yield current, turns
                turns = []
            current = conv
            turns.append((role, text))
    if turns:
        yield current, turns


_SPAN = pa.list_(pa.struct([("turn", pa.int32()), ("role", pa.string()), *(
    (n, pa.int64()) for n in ("start", "stop", "text_start", "text_stop"))]))
_SPAN_NAMES = ("turn", "role", "start", "stop", "text_start", "text_stop")
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("spans", _SPAN),
                        ("rewrites_history", pa.bool_()), ("first_rewrite", pa.int32())])


def _row(conv: int | None, n_turns: int, done: Rendered) -> tuple:
    return (conv, n_turns, done.formatted, [dict(zip(_SPAN_NAMES, s)) for s in done.spans],
            done.first_rewrite is not None, done.first_rewrite)


def _flushed(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Batches:
    """Rows in batches of about 4 MB."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += size(row)
        if held > 4 << 20 or len(out) >= 1000:
            yield to_batch(schema, *(list(c) for c in zip(*out)))
            out, held = [], 0
    if out:
        yield to_batch(schema, *(list(c) for c in zip(*out)))


def _formatted_long(turns: DataFrame, template: Template, roles: frozenset, stretch: int, stretches: int) -> DataFrame:
    """Conversations whose prefixes are rendered by several tasks, ``stretch`` turns by each.

    ``turns`` has ``conv_id, role, text``, the turn's place ``i`` and the number of turns ``n``.  A task
    holds the conversation up to its last turn; the spans are joined by turn afterwards.
    """
    part = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                      ("spans", _SPAN), ("rewrites", pa.list_(pa.struct([("turn", pa.int32()), ("start", pa.int64())])))])

    def task(batches: Batches) -> Batches:
        def rows() -> Iterator[tuple]:
            at, held, n = None, [], 0

            def done() -> tuple:
                first = at[1] * stretch
                text, spans, rewrites = render_stretch(held, template, roles, first, len(held))
                return (*at, n, text if len(held) == n else None, [dict(zip(_SPAN_NAMES, s)) for s in spans],
                        [dict(zip(("turn", "start"), r)) for r in rewrites])
            for batch in batches:
                for conv, place, size, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if at is not None and at != (conv, place):
                        yield done()
                        held = []
                    at, n = (conv, place), size
                    held.append((role, text))
            if at is not None:
                yield done()
        yield from _flushed(rows(), part, lambda r: len(r[3] or "") + 100 * len(r[4]))

    def join(batches: Batches) -> Batches:
        def rows() -> Iterator[tuple]:
            at, spans, rewrites, last = None, [], [], None
            for batch in batches:
                for row in batch.to_pylist():
                    if at is not None and at[0] != row["conv_id"]:
                        yield _row(*at, Rendered(last, untouched(spans, rewrites), rewrites[0][0] if rewrites else None))
                        spans, rewrites = [], []
                    at, last = (row["conv_id"], row["n_turns"]), row["formatted"]
                    spans += [tuple(s[c] for c in _SPAN_NAMES) for s in row["spans"]]
                    rewrites += [(r["turn"], r["start"]) for r in row["rewrites"]]
            if at is not None:
                yield _row(*at, Rendered(last, untouched(spans, rewrites), rewrites[0][0] if rewrites else None))
        yield from _flushed(rows(), _FORMATTED, lambda r: len(r[2]) + 100 * len(r[3]))

    # A turn is needed by the stretch it stands in and by all later ones.
    needed = turns.select("conv_id", F.explode(F.sequence(F.floor(F.col("i") / stretch), F.floor(
        (F.col("n") - 1) / stretch))).alias("part"), "n", "role", "text", "i")
    # The work is in the rendering, not in the bytes: a task for each stretch, up to a few thousand.
    parts = in_arrow(needed.repartition(min(stretches, 4096), "conv_id", "part").sortWithinPartitions("conv_id", "part", "i").select(
        "conv_id", "part", "n", "role", "text"), task, (
        f"conv_id long, part long, n_turns long, formatted string, spans {SPANS}, "
        "rewrites array<struct<turn:int,start:long>>"))
    return in_arrow(parts.repartition("conv_id").sortWithinPartitions("conv_id", "part"), join, SCHEMA)


def format_conversations(rows: DataFrame, template: Template = marked_turns,
                         loss_roles: Sequence[str] = ("assistant",), stretch: int = 256) -> DataFrame:
    """One row per ``conv_id``: the rendered text and the span of each turn.

    ``rows`` has ``conv_id, turn, role, text``; other columns are ignored.  Turns are
    taken in order of (turn, role, text), NULLs first; repeated rows are turns of their
    own.  A NULL role or text counts as empty, NULL ids make one conversation, an empty
    table gives no rows.  Rows are sorted by Spark and streamed: a task holds one
    conversation and two of its renderings, never a partition.  The prefixes of a conversation of
    more than ``stretch`` turns are dealt to several tasks, so many turns to each.
    """
    roles = frozenset(loss_roles)

    def task(batches: Batches) -> Batches:
        rendered = (_row(conv, len(turns), render(turns, template, roles)) for conv, turns in _conversations(batches))
        yield from _flushed(rendered, _FORMATTED, lambda r: len(r[2]))

    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    sizes = kept_table(plain.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > stretch), "long-conversations")
    short, stretches = plain, sizes.agg(F.sum(F.ceil(F.col("n") / stretch))).first()[0]
    if stretches:
        same = plain["conv_id"].eqNullSafe(sizes["conv_id"])
        short = plain.join(sizes, same, "left_anti")
    ordered = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    formatted = in_arrow(ordered.select("conv_id", "role", "text"), task, SCHEMA)
    if short is plain:
        return formatted
    # Numbering sorts a long conversation in one task, on disk if need be; a stretch needs it whole anyway.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = plain.join(sizes, same).select(plain["conv_id"], "turn", "role", "text", "n").withColumn(
        "i", F.row_number().over(order) - 1)
    return formatted.unionAll(_formatted_long(turns, template, roles, stretch, stretches))


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of what the output says: its turns, and the text under its loss mask."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("rewrites_history", pa.bool_())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_back(text)
                loss = "".join(unescape(text[s["text_start"]:s["text_stop"]])
                               for s in row["spans"] if s["text_start"] is not None)
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                out.append((row["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text), row["rewrites_history"]))
            if out:
                yield to_batch(schema, *(list(c) for c in zip(*out)))

    return in_arrow(formatted, task, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long, rewrites_history boolean")


# The conversation the contract adds: a user and an assistant both quote the control strings.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return digests(format_conversations(rows.unionByName(probe)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(14 + 2 * length(role) - length(regexp_replace(role, '[\\#<:]', '', 'g'))
      + 2 * length(text) - length(regexp_replace(text, '[\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars, false AS rewrites_history
FROM said
"""
