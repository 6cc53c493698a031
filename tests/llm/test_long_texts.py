"""Very long texts and awkward rows: each operator on single texts of over a million characters, the pipeline on nulls,
repeated rows and clashing columns."""

import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from blotter.llm import common, op1_token_counts, op2_decontaminate, op4_neardup, op7_suffix, op9_html, op10_warc


def words(seed, n):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnop"))
    return ["".join(letters[rng.integers(0, 16, k)]) for k in rng.integers(2, 9, n)]


def test_token_counts_of_a_long_text(spark):
    texts = [" ".join(words(1, 220_000)), " ".join(words(2, 1000)), "x" * 30_000]
    assert len(texts[0]) > 1_000_000
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in op1_token_counts.count_tokens(df).collect()}
    assert got == {i: (len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)) for i, t in enumerate(texts)}


def test_benchmark_passage_at_the_end_of_a_long_text(spark):
    item, long = words(3, 40), words(4, 200_000)
    near = [*item[:20], "other", *item[21:]]
    docs = spark.createDataFrame([(1, " ".join(long + near)), (2, " ".join(long)), (1, " ".join(long + near))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = [tuple(r) for r in op2_decontaminate.contaminated(docs, items).collect()]
    assert got == [(1, 7, 40, 39, 38)]
    assert [r.doc_id for r in op2_decontaminate.clean_documents(docs, items).collect()] == [2]


def test_shared_phrases_leave_narrow_rows(spark):
    """Documents and items that share six words meet without an overlap, as rows of ids alone."""
    phrase = words(5, 6)
    docs = spark.createDataFrame([(i, " ".join(words(100 + i, 40) + phrase + words(300 + i, 40))) for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(words(500 + i, 20) + phrase + words(700 + i, 20))) for i in range(50)], "item_id long, text string")
    seen = []
    write = common.materialize

    def noted(df, name):
        seen.append((name, df.dtypes))
        return write(df, name)
    old, common.materialize = common.materialize, noted
    try:
        assert op2_decontaminate.contaminated(docs, items).count() == 0
    finally:
        common.materialize = old
    assert dict(seen)["diagonals"] == [("doc_id", "bigint"), ("text_hash", "bigint"), ("key", "bigint"), ("shift", "int")]


def test_near_copies_of_a_very_large_set(spark):
    long = words(6, 120_000)
    other = [*long[:60_000], "changed", *long[60_001:]]
    rows = [(3, " ".join(long)), (1, " ".join(other)), (2, " ".join(words(7, 120_000))), (4, " ".join(long[:50_000]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: c for d, (_, c) in got.items()} == {1: 1, 2: 2, 3: 1, 4: 4}
    assert all(n > 49_000 for n, _ in got.values())


def test_repeats_in_a_long_text(spark):
    passage = " ".join(words(8, 120))[:450]
    body = " ".join(words(9, 240_000))
    text = body[:500_000] + passage + body[500_000:900_000] + passage + body[900_000:]
    docs = spark.createDataFrame([(1, text), (2, body[:300])], "doc_id long, text string")
    got = {r.doc_id: r for r in op7_suffix.removals(docs).collect()}
    kept = body
    assert (got[1].n_bytes, got[1].n_removed, got[1].n_spans) == (len(text), 900, 2)
    assert got[1].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest() and got[2].n_removed == 0


def test_a_page_of_many_megabytes_and_repeated_rows(spark):
    para = " ".join(words(10, 2000))
    page = "<html><body><div class=menu>m</div>" + "".join(f"<p>{i} {para}</p>" for i in range(300)) + "</body></html>"
    assert len(page) > 3_000_000
    rows = [(1, "http://h/a", page), (2, "http://h/b", "<p>one unmarked page</p>"), (2, "http://h/b", "<p>one unmarked page</p>"), (2, "http://h/b", "<p>one unmarked page</p>"),
            (2, "http://h/b", "<p>one unmarked page</p>")]
    got = sorted((r.page_id, r.n_chars, hashlib.sha256(r.text.encode()).hexdigest()) for r in op9_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    text = "\n\n".join(f"{i} {para}" for i in range(300))
    short = "one unmarked page"
    assert got == [(1, len(text), hashlib.sha256(text.encode()).hexdigest())] + [(2, len(short), hashlib.sha256(short.encode()).hexdigest())] * 4


def test_archives_over_several_files(spark, monkeypatch):
    monkeypatch.setattr(op10_warc, "FILE_BYTES", 2000)
    rows = [(i, f"http://h/{i}" + "p" * 3000, " ".join(words(i % 7, 300))) for i in range(20)]
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in op10_warc.write_and_read(
        spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    lead = {i % 7: i for i in range(20)}
    assert got == {i: (len(h.encode()), "response" if lead[i % 7] == i else "revisit", None if lead[i % 7] == i else lead[i % 7]) for i, _, h in rows}


def test_pipeline_with_nulls_repeats_and_clashing_columns(spark, sf_dir):
    some = common.table(spark, sf_dir, "documents")
    extra = [F.lit(1).alias("id"), F.lit("q").alias("q"), F.lit(2).alias("__row"), F.lit("x").alias("fp"), F.lit(3).alias("count"), F.lit("k").alias("key")]
    docs = some.select("*", *extra)
    awkward = docs.where("doc_id < 3").withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 100000)
    docs = docs.unionByName(docs.where("doc_id < 40")).unionByName(awkward).unionByName(
        docs.where("doc_id between 50 and 60").withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 200000))
    plain = common.materialize(some, "plain")
    got, want = docs, plain
    for name, stage in P.STAGES[:4]:
        got, want = common.materialize(stage(spark, got, sf_dir), f"a-{name}"), common.materialize(stage(spark, want, sf_dir), f"b-{name}")
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert got.where("doc_id >= 100000 and doc_id < 200000").count() == 0        # null texts fail the rules
        ids = [r.doc_id for r in got.select("doc_id").collect()]
        if name != "quality_rules":
            assert len(ids) == len(set(ids)) and {i for i in ids if i < 100000} == {r.doc_id for r in want.select("doc_id").collect()}
    packed = P.best_fit_packing(spark, got, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in got.select("doc_id").collect()}
