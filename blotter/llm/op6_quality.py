"""Quality rules: a learned decision list over native text statistics.

Every statistic is a built-in Spark expression over the whole text; no Python
runs on executors. The list is learned by sequential covering from labelled
rows: thresholds are class quantiles of the labelled statistics; a rule grows
one condition at a time by information gain on two thirds of the labelled rows
and is pruned back on the other third; rows it covers leave, and the next rule
is grown. Each step is one small grouped count in Spark, of which at most
(features x cut points x classes) rows reach the driver, whatever the corpus.
The result is an ordered CASE expression.

Defined cases: null, empty and white-space texts have no words, so they fail
the base rules; a document without a label is judged like any other; several
labels of one doc_id count as the lowest; rows without a usable label are not
learned from; with no labels the list is empty and only the base rules hold;
repeated rows are judged each; an empty table gives no rows; further columns
are ignored (``keep_documents`` passes them on).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper"]
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "distinct_words": ("n_distinct_words", "n_words"),
    "upper_case": ("n_upper", "word_chars"),
    "word_length": ("word_chars", "n_words"),
    "words": ("n_words", None),
}


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def bound(value: Column, use) -> Column:
    """Evaluate ``value`` once and pass it to ``use`` (a let-binding through a one-element array)."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column, windows: Column) -> Column:
    """Words inside 3-word windows (given as hashes) that occur twice or more."""
    def covered(s: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            same = lambda k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return same(j - 1) | same(j + 1)
        at = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
        return bound(at, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x))
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), bound(pairs, covered)).otherwise(F.lit(0).cast("long"))


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics columns of STATS (all long), in one struct column ``q``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = docs.withColumns({"__w": words_of(t), "__l": lines})
    grams = F.transform(F.col("__w"), lambda w, i: F.xxhash64(w, F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)))
    df = df.withColumn("__g", F.slice(grams, F.lit(1), F.greatest(F.size("__w") - 2, F.lit(0))))
    stat = {
        "n_words": F.size("__w"),
        "word_chars": F.char_length(F.array_join("__w", "")),
        "n_symbols": F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": repeat_words(F.col("__w"), F.col("__g")),
        "n_lines": F.size("__l"),
        "n_distinct_words": F.size(F.array_distinct("__w")),
        "n_upper": F.char_length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
    }
    return df.withColumn("q", F.struct(*[stat[k].cast("long").alias(k) for k in STATS])).drop("__w", "__l", "__g")


def base_failed(min_words: int, max_repeat_pct: int) -> Column:
    return (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_pct) * F.col("n_words"))


def feature(name: str) -> Column:
    over, under = FEATURES[name]
    value = F.col(over).cast("double")
    return value if under is None else F.when(F.col(under) > 0, value / F.col(under)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    """``feature <= cut`` or ``feature > cut``."""
    feature: str
    above: bool
    cut: float

    def expr(self) -> Column:
        f = feature(self.feature)
        return f > F.lit(self.cut) if self.above else f <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Ordered rejecting rules; what no rule covers is kept."""
    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self) -> Column:
        out = None
        for rule in self.rules:
            cond = _all([c.expr() for c in rule])
            out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def learn(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3, cuts: int = 16,
          min_precision: float = 0.95, min_cover: float = 0.002) -> DecisionList:
    """Learn a list from rows with the statistics columns and ``bad`` (0 or 1).

    ``min_precision``: share of bad rows a pruned rule needs among the pruning
    rows it covers. ``min_cover``: share of all bad pruning rows it must cover.
    """
    names = list(FEATURES)
    points = [(i + 0.5) / cuts for i in range(cuts)]
    quantiles = labelled.groupBy("bad").agg(*[F.percentile_approx(feature(n), points, 2000).alias(n) for n in names]).collect()
    grid = {n: _with_middles(sorted({v for r in quantiles for v in (r[n] or [])})) for n in names}
    bins = {n: F.lit(0) if not grid[n] else _bin(feature(n), grid[n]) for n in names}  # cuts below the value
    rows = C.materialize(labelled.select(
        "bad", (F.pmod(F.col("fold"), F.lit(3)) == 2).alias("prune"), *[bins[n].cast("int").alias(n) for n in names]), "labelled")
    long_form = f"stack({len(names)}, " + ", ".join(f"{i}, `{n}`" for i, n in enumerate(names)) + ") as (f, b)"

    def test(c: Condition) -> Column:
        k = grid[c.feature].index(c.cut)
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def tally(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.sum("bad").alias("p"), F.count("*").alias("n")).first()
        return r["p"] or 0, r["n"] - (r["p"] or 0)

    found, left = DecisionList(), rows
    bad_to_prune = tally(rows.where("prune"))[0]
    while len(found.rules) < max_rules:
        rule, here = [], left.where("not prune")
        p0, n0 = tally(here)
        while p0 and n0 and len(rule) < max_conditions:
            counts = here.selectExpr("bad", long_form).groupBy("f", "b", "bad").count().collect()
            best = _best(counts, names, grid, p0, n0)
            if best is None or best in rule:
                break
            rule.append(best)
            here = here.where(test(best))
            p0, n0 = tally(here)
        if not rule:
            break
        held = left.where("prune")
        scores = []
        for k in range(1, len(rule) + 1):
            p, n = tally(held.where(_all([test(c) for c in rule[:k]])))
            scores.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
        value, k, p, n = max(scores)
        if p + n == 0 or p / (p + n) < min_precision or p < max(1, min_cover * bad_to_prune):
            break
        rule = rule[:-k]
        found.rules.append(rule)
        left = left.where(~_all([test(c) for c in rule]))
    return found


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of cut points below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < value))


def _with_middles(values: list[float]) -> list[float]:
    """Cut points: the values, and the middles between neighbours."""
    return sorted({*values, *[(a + b) / 2 for a, b in zip(values, values[1:])]})


def _best(counts, names: list[str], grid: dict, p0: int, n0: int) -> Condition | None:
    """Condition of greatest information gain from counts by (feature, bin, class).

    Cuts of one feature that part the rows alike lie in a gap between them; the
    one nearest to the gap's middle stands for all, so that neither class is
    held to its very last row seen.
    """
    table = {}
    for r in counts:
        table.setdefault(r["f"], {}).setdefault(r["b"], [0, 0])[r["bad"]] += r["count"]
    before, best, gain = math.log2(p0 / (p0 + n0)), None, 1e-9
    for f, by_bin in sorted(table.items()):
        name, p, n = names[f], 0, 0
        cuts, parted = grid[names[f]], []
        for k in range(len(cuts)):
            n += by_bin.get(k, (0, 0))[0]
            p += by_bin.get(k, (0, 0))[1]
            parted.append((p, n))
        for part in dict.fromkeys(parted):
            gap = [c for c, x in zip(cuts, parted) if x == part]
            middle = (gap[0] + min([c for c in cuts if c > gap[-1]], default=gap[-1])) / 2
            cut = min(gap, key=lambda c: (abs(c - middle), c))
            for above, (pp, nn) in ((False, part), (True, (p0 - part[0], n0 - part[1]))):
                if pp:
                    g = pp * (math.log2(pp / (pp + nn)) - before)
                    if g > gain:
                        best, gain = Condition(name, above, cut), g
    return best


def learn_from(stats: DataFrame, labels: DataFrame, **params) -> DecisionList:
    """``stats``: doc_id and statistics; ``labels``: doc_id, quality (0 bad, 1 good)."""
    marks = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.min("quality") == 0).cast("int").alias("bad")))
    rows = stats.select(F.col("doc_id").alias("doc_id"), *STATS).join(marks, "doc_id")
    return learn(rows.withColumn("fold", F.xxhash64("doc_id")), **params)


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat_pct: int = 50, **params) -> DataFrame:
    """Statistics and verdicts of every document; one pass over the texts."""
    stats = C.materialize(with_stats(docs.select("doc_id", "text")).select("doc_id", "q.*"), "stats")
    rules = learn_from(stats, labels, **params)
    failed = base_failed(min_words, max_repeat_pct)
    return (stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & rules.keeps())
            .select("doc_id", *STATS[:5], "base_failed", "kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat_pct: int = 50, **params) -> DataFrame:
    """The documents that pass, with all their columns; statistics to learn from are made of the labelled ones alone."""
    known = C.small_side(C.materialize(labels.select("doc_id").where("doc_id is not null").distinct(), "labelled-ids"))
    marked = docs.select("doc_id", "text").join(known, "doc_id", "left_semi")
    rules = learn_from(C.materialize(with_stats(marked).select("doc_id", "q.*"), "labelled-stats"), labels, **params)
    names = docs.columns
    inner = with_stats(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col("text").alias("__text")), "__text")
    # the filter uses a column that is not deterministic (and never negative): else it would be pushed down,
    # with a copy of every expression for each of its uses
    judged = inner.select("__row", "q", F.monotonically_increasing_id().alias("__order")).select("__row", "q.*", "__order")
    return judged.where((F.col("__order") >= 0) & ~base_failed(min_words, max_repeat_pct) & rules.keeps()).select("__row.*")
