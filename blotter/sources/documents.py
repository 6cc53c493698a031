"""Records of large JSON documents, cut out by many tasks.

A JSON array, or a FeatureCollection, on one line has no line ends at which a
reader could split it. Here Spark's text reader splits it at closing braces
instead, and three steps make records of the fragments:

1. each byte range tells what it does to the state of the parse, for either
   answer to the question whether it starts inside a string: how many quotes it
   turns and how deep it leads;
2. a running sum over the ranges (one short row each) gives every range its start
   state;
3. each range cuts its records at the braces of the right depth. Records, and
   arrays of records, that cross a range are put together from the ranges' few
   loose ends.

The ranges are Spark's own file splits, so a file of any size is read by as many
tasks as its size asks for. What is held at once is a batch of fragments and the
record at hand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("|\Z)|[\[\]{}]', re.S)
REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*("|\Z)', re.S)
ESCAPED = re.compile(r"\\.", re.S)
FIRST = re.compile(r"[\[{]")

WHOLE, HEAD, TAIL, TURN = 0, 1, 2, 3     # a record; the end of one, its begin; a change of array
START = "file string, block long, turns boolean, deeper0 long, deeper1 long, first string"
PIECE = "file string, block long, kind int, wanted boolean, text string"


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): text up to each closing brace, which is left out, in order within a block."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def runs(batches: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple[tuple, list[str]]]:
    """((file, block, ...), fragments) of each stretch of one block in a batch."""
    for b in batches:
        where = pd.Series(list(zip(*[b[c] for c in ("file", "block", *columns)])), dtype=object)
        for at in (where != where.shift()).cumsum().pipe(lambda g: g.groupby(g).indices).values():
            yield where.iloc[at[0]], b["value"].iloc[at].tolist()


def state_change(text: str, inside: bool) -> tuple[bool, int]:
    """(inside a string after ``text``, depth gained) when it starts inside one or not."""
    if inside:
        m = REST_OF_STRING.match(text)
        if m.group(1) != '"':
            return True, 0
        text = text[m.end():]
    text = STRING.sub("", text)
    inside = '"' in text
    if inside:
        text = text[:text.index('"')]
    return inside, text.count("{") + text.count("[") - text.count("}") - text.count("]")


def effects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 1: a row of ``START`` for each block."""
    now, state = None, None

    def row():
        return (*now, state["quotes"] % 2 == 1, state["ends"][0][1], state["ends"][1][1], state["first"])

    for where, texts in runs(batches):
        if where != now:
            if now is not None:
                yield pd.DataFrame([row()], columns=[c.split()[0] for c in START.split(", ")])
            now, state = where, {"ends": [(False, 0), (True, 0)], "quotes": 0, "first": None}
        for value in texts:
            text = value + "}"
            state["quotes"] += ESCAPED.sub("", text).count('"')  # backslashes stand in strings alone, so this holds for either start
            for k, (inside, depth) in enumerate(state["ends"]):
                after, gained = state_change(text, inside)
                state["ends"][k] = (after, depth + gained)
            if state["first"] is None and (m := FIRST.search(text)):
                state["first"] = m.group()
    if now is not None:
        yield pd.DataFrame([row()], columns=[c.split()[0] for c in START.split(", ")])


def start_states(spark: SparkSession, path: str, key: str | None) -> DataFrame:
    """Step 2: (file, block, inside, depth, level): the state at which each block starts, and the depth of records."""
    blocks = fragments(spark, path).mapInPandas(effects, START)
    own = Window.partitionBy("file")
    order = own.orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("turns").cast("int")).over(before) % 2 == 1, F.lit(False))
    deeper = F.when(F.col("inside"), F.col("deeper1")).otherwise(F.col("deeper0"))
    first = F.first("first", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = F.lit(2) if key is not None else F.when(first == "[", 1).otherwise(0)
    return blocks.withColumn("inside", inside).select(
        "file", "block", "inside", F.coalesce(F.sum(deeper).over(before), F.lit(0)).alias("depth"), level.cast("long").alias("level"))


class Cutter:
    """Step 3 within a block: fragments in, pieces (kind, wanted, text) out."""

    def __init__(self, inside: bool, depth: int, level: int, key: str | None, first: bool):
        self.inside, self.depth, self.level, self.key = inside, depth, level, None if key is None else f'"{key}"'
        self.wanted = True if key is None else False if first else None   # None: as the blocks before have it
        self.named, self.open, self.parts, self.mark = None, depth > level, [], None
        self.headless, self.turned = self.open, False

    def feed(self, text: str) -> Iterator[tuple[int, bool | None, str]]:
        begin = at = 0
        if self.inside:
            m = REST_OF_STRING.match(text)
            self.inside, at = m.group(1) != '"', m.end()
        for m in TOKEN.finditer(text, at):
            c = text[m.start()]
            if c == '"':
                if m.group(1) != '"':
                    self.inside = True
                elif self.depth == 1 and not self.open:
                    self.named = m.group()
            elif c in "{[":
                if c == "{" and self.depth == self.level and not self.open:
                    self.open, self.headless, self.mark, begin = True, False, self.wanted, m.start()
                elif c == "[" and self.depth == 1 and self.key is not None and not self.open:
                    self.wanted, self.turned = self.named == self.key, True
                self.depth += 1
            else:
                self.depth -= 1
                if self.open and self.depth == self.level:
                    yield HEAD if self.headless else WHOLE, self.mark, "".join(self.parts) + text[begin:m.end()]
                    self.open, self.headless, self.parts = False, False, []
                elif c == "]" and self.depth == 1 and self.key is not None and not self.open:
                    self.wanted, self.turned = False, True
        if self.open:
            self.parts.append(text[begin:])

    def end(self) -> Iterator[tuple[int, bool | None, str]]:
        if self.open:  # a record that goes on; one that goes through the whole block is a head that does not close
            yield HEAD if self.headless else TAIL, self.mark, "".join(self.parts)
        if self.turned:
            yield TURN, self.wanted, ""


def cut(key: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, cutter = None, None

        def frame(rows):
            return pd.DataFrame([(*now[:2], *r) for r in rows], columns=[c.split()[0] for c in PIECE.split(", ")])

        for where, texts in runs(batches, "inside", "depth", "level"):
            if where != now:
                if now is not None:
                    yield frame(cutter.end())
                if pd.isna(where[3]):
                    raise ValueError(f"{where[0]}: the two passes split the file differently")
                now, cutter = where, Cutter(bool(where[2]), int(where[3]), int(where[4]), key, where[1] == 0)
            yield frame([p for value in texts for p in cutter.feed(value + "}")])
        if now is not None:
            yield frame(cutter.end())
    return run


def document_records(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """(value, _source): the text of every record of the JSON documents at ``path``.

    Records are the objects of a top-level array (or, without one, the top-level
    objects, so JSON lines are read too), or with ``key`` the objects of the array
    of that name in a top-level object. Commas and other elements between records
    are passed over; a record that the file breaks off is returned as far as it goes.
    """
    ensure_checkpoint_dir(spark)
    # one row for each file split: the size of the driver's own list of splits
    states = F.broadcast(start_states(spark, path, key).checkpoint(eager=True))
    frags = fragments(spark, path).join(states, ["file", "block"], "left")
    pieces = frags.select("file", "block", "value", "inside", "depth", "level").mapInPandas(cut(key), PIECE).checkpoint(eager=True)
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.where(F.col("kind") != WHOLE)
    turns = F.last(F.when(F.col("kind") == TURN, F.col("wanted")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rangeBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("wanted", F.when(F.col("kind") == TURN, F.col("wanted")).otherwise(F.coalesce("wanted", turns)))
    loose = ends.where(F.col("kind") != TURN).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = loose.groupBy("file", "record").agg(
        F.max(F.when(F.col("kind") == TAIL, F.col("wanted"))).alias("wanted"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))), lambda x: x["text"]), "").alias("value"))
    out = joined.where("wanted").select("value", F.col("file").alias("_source"))
    whole = pieces.where(F.col("kind") == WHOLE)
    if key is None:
        return whole.select(F.col("text").alias("value"), F.col("file").alias("_source")).unionByName(out)
    # records before a block's first change of array: as the last block with a change left it
    left = ends.where(F.col("kind") == TURN).groupBy("file", "block").agg(F.max("wanted").alias("left"))
    known = pieces.select("file", "block").distinct().join(left, ["file", "block"], "left")
    known = known.withColumn("inherited", F.last("left", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("file", "block", "inherited")
    whole = whole.join(F.broadcast(known), ["file", "block"]).where(F.coalesce("wanted", "inherited"))
    return whole.select(F.col("text").alias("value"), F.col("file").alias("_source")).unionByName(out)
