"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) to a string. It is called
on every prefix of a conversation; where the new output continues the old one,
the added part is the turn's span. Where it does not, the template rewrites
history: the example so far is closed, a new one begins with the new output, and
the conversation is marked. Inside a turn's span the text itself is found by
rendering the turn once more with a probe text: what both outputs share before
and after is the template's own.

The default template is reversible: it marks turns and escapes its own control
strings (and the escape sign) inside texts and roles, so that the output reads
back to the very turns it was made from.

Conversations are brought together by a hash partitioning and a sort, and
streamed: a task holds one conversation at a time (a template needs it whole).
Prefix rendering costs the square of a conversation's length; that is the price
of a black box.

Defined cases: null text and null role are empty strings; turns come by turn
(null first), ties by role and text; repeated rows are turns each; rows with a
null conv_id form one conversation; a conversation of empty texts is formatted
like any other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

Template = Callable[[list[tuple[str, str]]], str]

HEAD, GAP, TAIL, ESCAPE = "### ", ": ", "</turn>\n", "\\"
CONTROL = ("\\", "###", "</turn>", ": ")
_ESCAPABLE = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(re.escape(ESCAPE) + "(" + "|".join(map(re.escape, CONTROL)) + ")")
_NEXT = {end: re.compile(f"{_ESCAPED.pattern}|{re.escape(end)}") for end in (GAP, TAIL)}


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: ESCAPE + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def marked_turns(messages: list[tuple[str, str]]) -> str:
    """The default template."""
    return "".join([f"{HEAD}{escape(role)}{GAP}{escape(text)}{TAIL}" for role, text in messages])


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Turns of a string made by :func:`marked_turns`."""
    def until(end: str, at: int) -> tuple[str, int]:
        m = _NEXT[end].search(formatted, at)
        while m is not None and m.group() != end:
            m = _NEXT[end].search(formatted, m.end())
        if m is None:
            raise ValueError(f"no {end!r} after character {at}")
        return formatted[at:m.start()], m.end()

    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn begins at character {at}")
        role, at = until(GAP, at + len(HEAD))
        text, at = until(TAIL, at)
        out.append((unescape(role), unescape(text)))
    return out


def shared_start(a: str, b: str) -> int:
    """Length of the common beginning."""
    lo, hi = 0, min(len(a), len(b))
    step = 64
    while lo < hi and a[lo:lo + step] == b[lo:lo + step] and lo + step <= hi:
        lo, step = lo + step, step * 2
    end = min(hi, lo + step)
    while lo < end and a[lo] == b[lo]:
        lo += 1
    return lo


def text_span(template: Template, before: list[tuple[str, str]], role: str, text: str, out: str, start: int) -> tuple[int, int]:
    """Place of the turn's own text in ``out``, whose last turn begins at ``start``."""
    probe = next(c for c in "\x02\x03\x04" if not text.startswith(c) and not text.endswith(c))
    other = template([*before, (role, probe)])[start:]
    own = out[start:]
    head = shared_start(own, other)
    tail = shared_start(own[head:][::-1], other[head:][::-1])
    return start + head, len(out) - tail


def render(template: Template, turns: list[tuple[str, str]], loss_role: str) -> list[dict]:
    """Examples of one conversation: formatted string, turn spans and loss spans; one unless history is rewritten."""
    examples, out, spans, loss, first = [], "", [], [], 0
    for i, (role, text) in enumerate(turns):
        new = template(turns[:i + 1])
        start = len(out)
        if not new.startswith(out):
            examples.append({"formatted": out, "n_turns": i, "first_turn": first, "spans": spans, "loss": loss})
            start, spans, loss, first = shared_start(out, new), [], [], i
        spans.append((start, len(new)))
        if role == loss_role:
            loss.append(text_span(template, turns[:i], role, text, new, start))
        out = new
    examples.append({"formatted": out, "n_turns": len(turns), "first_turn": first, "spans": spans, "loss": loss})
    return examples


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
EXAMPLES = ("conv_id long, example int, rewrites boolean, n_turns int, first_turn int, formatted string, "
            "spans array<struct<start: bigint, end: bigint>>, loss array<struct<start: bigint, end: bigint>>")


def format_conversations(conversations: DataFrame, template: Template = marked_turns, loss_role: str = "assistant") -> DataFrame:
    """One row per example; see the module docstring."""
    C.bound_batches(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch():
            cols = {k: [r[k] for r in rows] for k in rows[0]}
            types = [pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), _SPANS, _SPANS]
            names = ["conv_id", "example", "rewrites", "n_turns", "first_turn", "formatted", "spans", "loss"]
            return pa.RecordBatch.from_arrays([pa.array(cols[n], t) for n, t in zip(names, types)], names=names)

        def close(conv, turns):
            found = render(template, turns, loss_role)
            for k, ex in enumerate(found):
                pairs = {n: [{"start": s, "end": e} for s, e in ex[n]] for n in ("spans", "loss")}
                rows.append(ex | pairs | {"conv_id": conv, "example": k, "rewrites": len(found) > 1})
            return sum(len(ex["formatted"]) for ex in found)

        now, turns = None, []
        for b in batches:
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and conv != now:
                    size += close(now, turns)
                    turns = []
                    if size > 4 << 20:
                        yield batch()
                        rows, size = [], 0
                now = conv
                turns.append((role or "", text or ""))
        if turns:
            close(now, turns)
        if rows:
            yield batch()

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, EXAMPLES)


def read_back(examples: DataFrame) -> DataFrame:
    """Digests from formatted rows of the default template: turns and all text under the loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, formatted, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                digest, turns = hashlib.sha256(), read_turns(formatted)
                for role, text in turns:
                    digest.update(f"{role}\n{text}\n".encode())
                told = "".join([unescape(formatted[s["start"]:s["end"]]) for s in loss])
                out.append((conv, len(turns), digest.hexdigest(), len(told), hashlib.sha256(told.encode()).hexdigest(), len(formatted)))
            cols = list(zip(*out)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    return examples.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def write_and_read(conversations: DataFrame) -> DataFrame:
    """Format, write to the shared folder, and read the digests back."""
    return read_back(C.materialize(format_conversations(conversations), "chat"))
