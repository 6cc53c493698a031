"""Exact substring dedup: every byte of a repeated 400-byte string goes.

Column-wise multi-document construction. A collection's texts are laid under
each other and one symbol of each is inserted per round, from the right; every
round updates the order of the suffixes (the collection's Burrows-Wheeler order,
kept per column as the texts are aligned) and the common prefixes of neighbours
by range minima over the previous round. After the round of a column, a common
prefix of 400 or more with a neighbour means that the 400-byte string starting
there starts elsewhere too.

Inserting whole documents that way takes as many passes over the collection as
the longest document has bytes, so the collections are cut first, exactly:

1. Anchors: of the 128-byte strings inside any 400-byte window, the one of least
   hash (leftmost if equal) depends on the window's content alone. So equal
   windows have equal anchors at equal places, and windows need comparing only
   within the occurrences of one anchor, aligned at it. One pass; written out.
2. Anchors that occur once are dropped. An occurrence's *piece* is the stretch of
   its windows. Equal pieces (by a hash of the piece under the anchor's hash, so
   128 bits) are repeats in full and count once from here on.
3. Anchors with several distinct pieces are the collections: their bytes are
   fetched and the rounds above run over many anchors at once, in sequential
   reads of a table sorted by anchor, in bounded batches.
4. An anchor with more than ``hot`` distinct pieces is not built in one task: its
   windows are counted by hash over the cluster instead.

Tables between the steps lie in the shared folder. A document is named by its
doc_id and a hash of its text. Defined cases: null and empty texts have nothing
to remove; texts shorter than the string length neither; repeated rows and equal
documents remove each other entirely; an empty table gives no rows; a removal may
begin or end inside a UTF-8 character (``remove_repeats`` then keeps the whole
character, so that texts stay valid); further columns are passed on there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW, GRAM = 400, 128
SLICE = 2 << 20            # bytes whose hashes are held at once (positions must fit 24 bits)
BATCH_PIECES = 20_000      # pieces the rounds run over at once
HOT = 20_000               # distinct pieces of an anchor beyond which its windows are counted instead
ANCHORS = "doc_id long, th long, pos int, lo int, hi int, ah long, ph long"


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:n] = x
    grid = pad.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def find_anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, window: int, gram: int):
    """Anchors of the texts ``data[begin:end]``: (text, pos, lo, hi, anchor hash, piece hash); places are in ``data``."""
    span, low = window - gram + 1, np.uint64((1 << 24) - 1)
    h = C.PrefixHash(data)
    at = np.arange(len(data) - gram + 1)
    grams = h.ranges(at, at + gram)
    place = (sliding_min((grams & ~low) | at.astype(np.uint64), span) & low).astype(np.int64)
    starts = end - begin - window + 1
    text = np.repeat(np.arange(len(begin)), np.maximum(starts, 0))
    first = np.concatenate([[0], np.cumsum(np.maximum(starts, 0))])
    w = np.arange(len(text)) - first[text] + begin[text]
    pos = place[w]
    new = np.ones(len(w), bool)
    new[1:] = (pos[1:] != pos[:-1]) | (text[1:] != text[:-1])
    cut = np.flatnonzero(new)
    lo, hi, pos, text = w[cut], w[np.append(cut[1:], len(w)) - 1], pos[cut], text[cut]
    piece = C.mix64(h.ranges(lo, hi + window) ^ C.mix64((pos - lo).astype(np.uint64)))
    return text, pos, lo, hi, grams[pos], piece


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Anchor occurrences of every document (doc_id, th, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = C.text_buffers(b.column("text"))
            # stretches of at most SLICE bytes; a longer text is cut with overlapping windows
            rows, begin, end = [], [], []
            for i in np.flatnonzero(np.diff(offs) >= window).tolist():
                s, e = int(offs[i]), int(offs[i + 1])
                while s + window <= e:
                    stop = min(e, s + SLICE)
                    rows.append(i)
                    begin.append(s)
                    end.append(stop)
                    s = stop - window + 1
            rows, begin, end = (np.array(x, np.int64) for x in (rows, begin, end))
            k = 0
            while k < len(rows):
                m = max(k + 1, int(np.searchsorted(end, begin[k] + SLICE, side="right")))
                m = min(m, len(rows))
                base = begin[k]
                text, pos, lo, hi, ah, ph = find_anchors(data[base:end[k:m].max()], begin[k:m] - base, end[k:m] - base, window, gram)
                row = rows[k:m][text]
                shift = base - offs[row]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("th").take(take), *[pa.array((x + shift).astype(np.int32)) for x in (pos, lo, hi)],
                     pa.array(ah.view(np.int64)), pa.array(ph.view(np.int64))], names=["doc_id", "th", "pos", "lo", "hi", "ah", "ph"])
                k = m

    return docs.select("doc_id", "th", "text").mapInArrow(run, ANCHORS)


def column_rounds(bytes_: np.ndarray, offs: np.ndarray, rel: np.ndarray, group: np.ndarray, window: int, gram: int):
    """Repeated windows of aligned pieces: (piece, first start, last start), starts relative to the anchor.

    ``rel``: bytes of a piece before its anchor; ``group``: anchor number, ascending.
    A piece takes part from its last column to its first one.
    """
    n, size = len(rel), np.diff(offs)
    right = size - rel                      # a piece has the columns -rel .. right - 1
    order, lcp = np.zeros(0, np.int64), np.zeros(0, np.int32)
    by_right = np.argsort(-right, kind="stable")
    entered, starts, hits = 0, int(rel.max()), []
    for col in range(int(right.max()) - 1, -starts - 1, -1):
        if 0 <= col < gram - 1:
            continue  # inside the anchor all symbols of a group are equal: done at its last column
        if col >= gram - 1:  # texts that end here enter, first in their group, with nothing in common
            upto = entered
            while upto < n and right[by_right[upto]] - 1 >= col:
                upto += 1
            if upto > entered:
                order = np.concatenate([by_right[entered:upto], order])
                lcp = np.concatenate([np.zeros(upto - entered, np.int32), lcp])
                entered = upto
            symbol = bytes_[offs[order] + rel[order] + col].astype(np.int64)
            stay = slice(None)
        else:  # texts that begin further right have left
            stay = np.flatnonzero(rel[order] >= -col)
            symbol = bytes_[offs[order[stay]] + rel[order[stay]] + col].astype(np.int64)
        if not len(order):
            continue
        was = np.arange(len(order))[stay]
        key = group[order[was]] * 256 + symbol
        move = np.argsort(key, kind="stable")
        was, key = was[move], key[move]
        new = np.zeros(len(was), np.int32)
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(same):
            # least common prefix met between the two old places
            bounds = np.stack([was[same - 1] + 1, was[same] + 1], axis=1).reshape(-1)
            new[same] = np.minimum.reduceat(np.append(lcp, 0), bounds)[::2] + (gram if col == gram - 1 else 1)
        order, lcp = order[was], new
        col = 0 if col == gram - 1 else col
        if col <= 0:
            far = np.flatnonzero(lcp >= window)
            if len(far):
                hit = np.unique(np.concatenate([order[far], order[far - 1]]))
                hit = hit[(rel[hit] >= -col) & (right[hit] >= col + window)]
                hits.append(np.stack([hit, np.full(len(hit), col)], axis=1))
    if not hits:
        return np.zeros((0, 3), np.int64)
    h = np.concatenate(hits)
    h = h[np.lexsort((h[:, 1], h[:, 0]))]
    cut = np.ones(len(h), bool)
    cut[1:] = (h[1:, 0] != h[:-1, 0]) | (h[1:, 1] != h[:-1, 1] + 1)
    at = np.flatnonzero(cut)
    return np.stack([h[at, 0], h[at, 1], h[np.append(at[1:], len(h)) - 1, 1]], axis=1)


PIECE = "doc_id long, th long, s int, e int"


def build_collections(pieces: DataFrame, window: int, gram: int) -> DataFrame:
    """Repeated ranges (doc_id, th, s, e) of pieces that occur once; rows: ah, n, doc_id, th, pos, lo, bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush(t: pa.Table):
            data, offs = C.text_buffers(t["bytes"])
            pos, lo = t["pos"].to_numpy(), t["lo"].to_numpy()
            ah = t["ah"].to_numpy()
            group = np.concatenate([[0], np.cumsum(ah[1:] != ah[:-1])])
            hit = column_rounds(data, offs, (pos - lo).astype(np.int64), group, window, gram)
            hit = hit[t["n"].to_numpy()[hit[:, 0]] == 1]
            take = pa.array(hit[:, 0])
            return pa.RecordBatch.from_arrays(
                [t["doc_id"].combine_chunks().take(take), t["th"].combine_chunks().take(take),
                 pa.array((pos[hit[:, 0]] + hit[:, 1]).astype(np.int32)), pa.array((pos[hit[:, 0]] + hit[:, 2] + window).astype(np.int32))],
                names=["doc_id", "th", "s", "e"])

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= BATCH_PIECES:
                t = pa.Table.from_batches(held).combine_chunks()
                ah = t["ah"].to_numpy()
                last = int(np.searchsorted(ah, ah[-1]))  # the last anchor may go on
                if last:
                    yield flush(t.slice(0, last))
                held, rows = t.slice(last).to_batches(), t.num_rows - last
        if rows:
            yield flush(pa.Table.from_batches(held).combine_chunks())

    ordered = pieces.repartition("ah").sortWithinPartitions("ah")
    return ordered.select("ah", "n", "doc_id", "th", "pos", "lo", "bytes").mapInArrow(run, PIECE)


def count_windows(pieces: DataFrame, window: int) -> DataFrame:
    """The same ranges for anchors with very many distinct pieces: windows counted by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = C.text_buffers(b.column("bytes"))
            per = np.diff(offs) - window + 1
            row = np.repeat(np.arange(len(per)), per)
            step = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
            at = offs[row] + step
            hashes = C.PrefixHash(data).ranges(at, at + window)
            rel = step - (b.column("pos").to_numpy() - b.column("lo").to_numpy())[row]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(take) for c in ("ah", "n", "doc_id", "th", "pos")],
                                              pa.array(rel.astype(np.int32)), pa.array(hashes.view(np.int64))],
                                             names=["ah", "n", "doc_id", "th", "pos", "rel", "wh"])

    w = pieces.select("ah", "n", "doc_id", "th", "pos", "lo", "bytes").mapInArrow(
        run, "ah long, n long, doc_id long, th long, pos int, rel int, wh long")
    twice = w.groupBy("ah", "rel", "wh").count().where("count > 1").select("ah", "rel", "wh")
    return w.where("n = 1").join(twice, ["ah", "rel", "wh"]).select(
        "doc_id", "th", (F.col("pos") + F.col("rel")).cast("int").alias("s"), (F.col("pos") + F.col("rel") + window).cast("int").alias("e"))


def named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, th, ranges): byte ranges [s, e) covered by repeated windows, sorted, not merged."""
    C.bound_batches(docs.sparkSession)
    source = named(docs)
    a = C.materialize(anchors(source, window, gram), "anchors")
    # written first, so that the join has exchanges of its own, whose skewed partitions Spark can split
    twice = C.materialize(a.groupBy("ah").count().where("count > 1").select("ah"), "twice")
    r = C.materialize(a.join(twice, "ah"), "repeated")
    piece = F.struct("doc_id", "th", "pos", "lo", "hi")
    p = C.materialize(r.groupBy("ah", "ph").agg(F.count("*").alias("n"), F.min(piece).alias("at")), "pieces")
    whole = r.join(p.where("n > 1").select("ah", "ph"), ["ah", "ph"]).select("doc_id", "th", F.col("lo").alias("s"), (F.col("hi") + window).alias("e"))
    distinct = C.materialize(p.groupBy("ah").agg(F.count("*").alias("pieces")).where("pieces > 1"), "distinct")
    mixed = p.join(distinct, "ah").select("ah", "n", "pieces", "at.*")
    wanted = mixed.groupBy("doc_id", "th").agg(F.collect_list(F.struct("ah", "n", "pieces", "pos", "lo", "hi")).alias("list"))
    wanted = wanted.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "list")
    texts = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    got = texts.select("doc_id", "th", F.col("text").cast("binary").alias("text"), F.explode("list").alias("x"))
    got = got.select("doc_id", "th", "x.ah", "x.n", "x.pieces", "x.pos", "x.lo",
                     F.substring("text", F.col("x.lo") + 1, F.col("x.hi") - F.col("x.lo") + window).alias("bytes"))
    got = C.materialize(got, "piece-bytes")
    part = build_collections(got.where(F.col("pieces") <= hot), window, gram)
    many = count_windows(got.where(F.col("pieces") > hot), window)
    every = whole.union(part).union(many)
    return every.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("ranges"))


def merge(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for r in ranges if ranges is not None else ():
        s, e = r["s"], r["e"]
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    r = ranges.select(F.col("doc_id").alias("__d"), F.col("th").alias("__t"), F.col("ranges").alias("__ranges"))
    return docs.join(r, F.col("doc_id").cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t")), "left").drop("__d", "__t")


def removals(docs: DataFrame, window: int = WINDOW, **params) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, ranges in zip(b.column("text"), b.column("__ranges").to_pylist()):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                spans, digest, at, gone = merge(ranges), hashlib.sha256(), 0, 0
                for s, e in spans:
                    digest.update(raw[at:s])
                    at, gone = e, gone + e - s
                digest.update(raw[at:])
                rows.append((len(raw), gone, len(spans), digest.hexdigest()))
            cols = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    ranges = repeated_ranges(docs, window, **params)
    joined = with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ranges)
    return joined.select("doc_id", "text", "__ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **params) -> DataFrame:
    """``docs`` with repeated strings taken out of ``text``; a character is removed only as a whole."""
    @F.pandas_udf("string")
    def cut(text, ranges):
        import pandas as pd

        def one(t, rs):
            raw, out, at = (t or "").encode(), [], 0
            for s, e in merge(rs):
                while s < len(raw) and raw[s] & 0xC0 == 0x80:
                    s += 1
                while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
                    e -= 1
                if s < e:
                    out.append(raw[at:s])
                    at = e
            return b"".join([*out, raw[at:]]).decode()
        return pd.Series([one(t, r) for t, r in zip(text, ranges)], dtype=object)

    names = docs.columns
    ranges = C.materialize(repeated_ranges(docs, window, **params), "ranges")
    joined = with_ranges(docs, ranges)
    new = F.when(F.col("__ranges").isNull(), F.col("text")).otherwise(cut("text", "__ranges"))
    return joined.withColumn("text", new).select(*[F.col(f"`{c}`") for c in names])
