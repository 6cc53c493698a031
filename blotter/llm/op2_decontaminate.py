"""Benchmark decontamination by spaced-seed hashing, in native Spark expressions.

Texts are lower-cased and split into runs of letters and digits. A seed is a
fixed mask over a span of words: the words at its 1-places are hashed, the
others are ignored, so a substituted word spoils only the seeds that look at
it. Items of up to ``SHORT_WORDS`` words are sought by unbroken runs instead, as
long as the longest run that every overlap reaching the score must have (see
:func:`sure_run`), so none of theirs is missed; longer ones by the masks and by
runs of ``LEAST_RUN`` words, which can miss an overlap whose mismatches are spread
so that no run and no mask is left whole. Seeds of all document positions meet those of the benchmark items in a
hash join; around each hit the item is laid along the document on the hit's
diagonal and every word is compared. An overlap counts when its local
alignment score (match +1, other word -1) reaches ``min(min_score, ceil(
min_share * words of the item))``.

The document side is one scan: positions, seeds and the join
stay in one generated stage, and only narrow rows (document, item, diagonal) leave it. What is broadcast are rows of fixed width (seed, code
and length of the item, place; an estimated 100 bytes each when hashed), once for
items of equal words, in blocks of about ``block_seeds`` rows cut by a hash of the
row, so the broadcast has a bound in bytes however many, long or repetitive the
items are; more blocks mean more scans. The hits are reduced to one row per
document, item and diagonal; only documents with a hit are read once more for
their words, and only these diagonals meet the item's words.

Defined cases: null or empty texts and items without words match nothing; repeated
documents are each compared and reported once per doc_id; repeated items are
reported for each item_id; empty tables give no rows; further columns are
ignored (``clean_documents`` passes those of documents on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

MASKS = ("110110101111", "111011001011", "101111011011")
SHORT_WORDS, LEAST_RUN = 22, 4
BLOCK_SEEDS = 400_000


def word_codes(text: Column) -> Column:
    """One 64-bit code per word."""
    bare = F.lower(F.coalesce(text, F.lit("")))
    words = F.filter(F.split(bare, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds_at(codes: Column, at: Column, masks: tuple[str, ...]) -> Column:
    """Array with the seed of every mask at a position (null where its span runs over the end)."""
    out = []
    for m, mask in enumerate(masks):
        seen = [F.get(codes, at + j) for j, on in enumerate(mask) if on == "1"]
        out.append(F.when(at + len(mask) <= F.size(codes), F.xxhash64(F.lit(m), *seen)))
    return F.array(*out)


def alignment_score(item: Column, window: Column, lead: Column) -> Column:
    """(run, best, same): item words against ``window``, whose first word faces item word ``lead``."""
    same = F.transform(item, lambda w, j: F.coalesce(F.get(window, j - lead) == w, F.lit(False)))
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("same"))

    def step(a: Column, hit: Column) -> Column:
        run = F.greatest(F.lit(0), a["run"] + F.when(hit, 1).otherwise(-1))
        return F.struct(run.alias("run"), F.greatest(a["best"], run).alias("best"),
                        (a["same"] + hit.cast("int")).alias("same"))
    return F.aggregate(same, zero, step)


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, key, item): the items that have words, with a code of their word sequence."""
    items = items.select("item_id", word_codes(F.col("text")).alias("item")).where(F.size("item") > 0)
    return items.select("item_id", F.xxhash64("item").alias("key"), "item")


def words_needed(min_score: int, min_share: float) -> Column:
    """Score an overlap with ``item`` must reach."""
    return F.least(F.lit(min_score), F.ceil(F.lit(min_share) * F.size("item")).cast("int"))


def sure_run(need: Column) -> Column:
    """Least length of the longest run of equal words in any overlap with ``item`` that scores ``need``.

    A stretch with k other words scores ``need`` with need + k equal ones, so it
    takes need + 2k places of the item; its equal words form at most k + 1 runs.
    """
    others = F.greatest(F.lit(0), F.floor((F.size("item") - need) / 2))
    return F.greatest(F.lit(1), F.ceil((need + others) / (others + 1)).cast("int"))


def item_seeds(items: DataFrame, min_score: int = 13, min_share: float = 0.8) -> tuple[DataFrame, tuple[str, ...]]:
    """(seed, key, n, place) rows of :func:`item_words`, n the item's number of words, and the masks in use."""
    run = sure_run(words_needed(min_score, min_share))
    short = (F.size("item") <= SHORT_WORDS) | (run >= LEAST_RUN)
    once = items.select("key", "item", F.when(short, run).otherwise(LEAST_RUN).alias("run"), (~short).alias("masked")).distinct()
    # runs of at most min_score words, each a mask of its own
    kinds = once.select("run", "masked").distinct().collect()
    masks = (MASKS if any(r.masked for r in kinds) else ()) + tuple("1" * n for n in sorted({r.run for r in kinds}))
    if not masks:  # no item has words
        masks = MASKS
    seeds = once.select("key", "item", "run", "masked", F.explode(F.sequence(F.lit(0), F.size("item") - 1)).alias("place"))
    seeds = seeds.select("key", F.size("item").alias("n"), "run", "masked", "place",
                         F.posexplode(seeds_at(F.col("item"), F.col("place"), masks)).alias("mask", "seed"))
    runs = F.element_at(F.array(*[F.lit(0 if "0" in m else len(m)) for m in masks]), F.col("mask") + 1)
    wanted = F.when(runs == 0, F.col("masked")).otherwise(runs == F.col("run"))
    return seeds.where(F.col("seed").isNotNull() & wanted).select("seed", "key", "n", "place"), masks


def seed_blocks(seeds: DataFrame, block_seeds: int) -> list[DataFrame]:
    """The seeds in blocks of about ``block_seeds`` rows; those of one item, or of one seed, may stand in several."""
    blocks = max(1, -(-seeds.count() // block_seeds))
    if blocks == 1:
        return [seeds]
    seeds = C.materialize(seeds, "seeds")
    return [seeds.where(F.pmod(F.xxhash64("seed", "key", "place"), F.lit(blocks)) == b) for b in range(blocks)]


def overlaps(docs: DataFrame, items: DataFrame, min_score: int = 13, min_share: float = 0.8,
             block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """Verified overlaps: doc_id, text_hash, item_id, n_item_words, n_matched, score (best per pair)."""
    items = item_words(items)
    seeds, masks = item_seeds(items, min_score, min_share)
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_codes(F.col("text")).alias("doc"))
    at = source.select("doc_id", "text_hash", "doc", F.posexplode_outer("doc").alias("at", "code"))
    at = at.select("doc_id", "text_hash", "at", F.explode(seeds_at(F.col("doc"), F.col("at"), masks)).alias("seed"))
    need = words_needed(min_score, min_share)
    shift, found = F.col("at") - F.col("place"), None
    for block in seed_blocks(seeds, block_seeds):  # one round for any benchmark of up to ``block_seeds`` seeds
        hits = at.join(F.broadcast(block), "seed").select("doc_id", "text_hash", "key", shift.alias("shift"))
        found = hits if found is None else found.unionByName(hits)
    # one narrow row per document, item and diagonal; a document's hits are made together, so most fall together before they move
    diagonals = C.materialize(found.distinct(), "diagonals")
    # only documents that hold a seed are read for their words
    hit = C.small_side(C.materialize(diagonals.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th")).distinct(), "hit-documents"))
    picked = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    picked = picked.join(hit, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__th")), "left_semi")
    words = picked.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"), word_codes(F.col("text")).alias("doc"))  # repeated rows are scored alike
    laid = diagonals.join(items, "key").join(words, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__th")))
    laid = laid.withColumn("window", F.slice("doc", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item")))
    scored = laid.select("doc_id", "text_hash", "item_id", F.size("item").alias("n_item_words"), need.alias("need"),
                         alignment_score(F.col("item"), F.col("window"), F.greatest(-F.col("shift"), F.lit(0))).alias("a"))
    found = scored.groupBy("doc_id", "text_hash", "item_id", "need").agg(
        F.max("n_item_words").alias("n_item_words"), F.max("a.same").alias("n_matched"), F.max("a.best").alias("score"))
    return found.where("score >= need").drop("need")


def contaminated(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """One row per (doc_id, item_id) with a verified overlap."""
    found = overlaps(docs, items, **params)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_item_words").cast("long").alias("n_item_words"), F.max("n_matched").cast("long").alias("n_matched"),
        F.max("score").cast("long").alias("score"))


def clean_documents(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """The documents without a verified overlap, with all their columns."""
    bad = overlaps(docs, items, **params).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"]) == bad["__th"]), "left_anti")
