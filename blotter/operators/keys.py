"""Row keys (X9): random UUIDs for parity, content keys for idempotent loads.

A content key is ``hash128(identity) || '-' || occurrence`` where the
occurrence number tells identical rows apart (identical incidents are
legal, e.g. two thefts on one block in one hour). The identity of a feed row
is its raw fields and its source (:func:`with_identity`), never a derived
column: a corrected lookup changes an incident, not its key, and a source's
rows have the same keys however sources are cut into batches. Re-running a load
gives the same keys, so an upsert by key replaces instead of duplicating.

Rows equal in every column are interchangeable, so they are not numbered but
counted and expanded again: one map-side-combined shuffle, lazy, and a content
that holds a large share of a table is one row until it is expanded in chunks.
Where further columns differ, the distinct rows are placed by prefix sums over
cells of a content, so no window group holds more than about 1/cells of a hot one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import content_hash128


def with_random_key(df: DataFrame, out: str = "uuid") -> DataFrame:
    """A fresh v4 UUID per row (not idempotent across re-runs)."""
    return df.withColumn(out, F.expr("uuid()"))


ID1, ID2 = "__id1", "__id2"
SOURCE = "_source"          # optional raw column: snapshot id or landed file path

# Copies of one row that one task expands.
EXPAND_CHUNK = 1 << 16


def with_identity(raw: DataFrame) -> DataFrame:
    """``raw`` plus the two hashes of its fields and its source (``_source``, if present, is used up)."""
    fields = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
              for f in raw.schema.fields]  # maps have no order, so they hash by sorted entries
    a, b = content_hash128(*fields)
    return raw.withColumns({ID1: a, ID2: b}).drop(SOURCE)


def _copies(counts: DataFrame, cols: list[str], out: str, start=None) -> DataFrame:
    """Each row of ``counts`` ``__n`` times, numbered from ``start`` in ``out``; many copies in chunks."""
    start = F.lit(0).cast("long") if start is None else start
    few = counts.where(F.col("__n") <= EXPAND_CHUNK).select(*cols, F.explode(F.sequence(start, start + F.col("__n") - 1)).alias(out))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / EXPAND_CHUNK)))
    many = counts.where(F.col("__n") > EXPAND_CHUNK).withColumn("__c", chunk)
    last = F.least((F.col("__c") + 1) * EXPAND_CHUNK, F.col("__n")) - 1
    many = many.repartition("__c", *cols).select(*cols, F.explode(F.sequence(start + F.col("__c") * EXPAND_CHUNK, start + last)).alias(out))
    return few.unionByName(many)


def counted_rows(df: DataFrame) -> DataFrame:
    """Rows equal in all columns once, with their number in ``__n``."""
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))


def numbered_rows(df: DataFrame, out: str) -> DataFrame:
    """Rows equal in all columns, numbered 0..n-1 in ``out``: counted, then expanded."""
    return _copies(counted_rows(df), [f"`{c}`" for c in df.columns], out)


def with_identity_key(df: DataFrame, out: str = "uuid") -> DataFrame:
    """Key rows that carry the identity hashes of :func:`with_identity`; the hashes are dropped."""
    return keyed_copies(counted_rows(df.drop(out)), out)


def keyed_copies(counts: DataFrame, out: str = "uuid") -> DataFrame:
    """:func:`with_identity_key` of rows that are counted already (:func:`counted_rows`)."""
    rows = _copies(counts, [f"`{c}`" for c in counts.columns if c != "__n"], "__occ")
    key = F.format_string("%016x%016x-%d", F.col(ID1), F.col(ID2), F.col("__occ"))
    return rows.withColumn(out, key).drop(ID1, ID2, "__occ")


# Cells of a content: its distinct rows fall into cells by their hash, so that a
# content holding a third of 10^12 rows is cut into window groups of ~5 * 10^6.
CELLS = 1 << 16


def with_content_key(df: DataFrame, cols: list[str] | None = None, out: str = "uuid", buckets: int = CELLS) -> DataFrame:
    """Add ``out`` = ``<32 hex digits of a 128-bit content hash>-<occurrence>``.

    If ``cols`` are all columns, equal rows are counted and expanded
    (:func:`numbered_rows`). Where further columns differ, equal rows are
    counted first too, and the distinct ones get their places by a prefix sum
    of those counts: within cells of a content by one window, and over a
    content's cells by another on their sizes, one narrow row a cell. Cell and
    order are hashes of the row's values, so both plans see the same ones
    whenever and wherever a task runs: no salt is drawn, nothing is
    checkpointed, and the numbers do not depend on the partitioning.

    The input must be deterministic, and its columns of types that can be grouped.
    """
    cols = cols or [c for c in df.columns if c != out]
    base = df.drop(out) if out in df.columns else df
    a, b = content_hash128(*cols)
    if set(cols) == set(base.columns):
        return with_identity_key(base.withColumns({ID1: a, ID2: b}), out)
    r1, r2 = content_hash128(*[f"`{c}`" for c in base.columns])
    rows = base.withColumns({ID1: a, ID2: b, "__r1": r1, "__r2": r2})
    rows = rows.withColumn("__cell", F.pmod("__r1", F.lit(buckets)))
    content = [ID1, ID2]
    plain = [f"`{c}`" for c in base.columns]
    counts = rows.groupBy(*plain, *content, "__r1", "__r2", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*content, "__cell").orderBy("__r1", "__r2").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__at", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sizes = rows.groupBy(*content, "__cell").agg(F.count(F.lit(1)).alias("__size"))
    cells = Window.partitionBy(*content).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*content, "__cell", F.sum("__size").over(cells).alias("__start")).where("__start > 0")
    placed = counts.join(starts, [*content, "__cell"], "left").withColumn("__at", F.col("__at") + F.coalesce("__start", F.lit(0)))
    numbered = _copies(placed.select(*plain, *content, "__at", "__n"), [*plain, *content, "__at"], "__occ", F.col("__at"))
    key = F.format_string("%016x%016x-%d", F.col(ID1), F.col(ID2), F.col("__occ"))
    return numbered.withColumn(out, key).drop(*content, "__at", "__occ")
