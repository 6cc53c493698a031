"""The corpus pipeline on the small tables: every stage against a plain version of its rule."""

import re

import corpus_pipeline as P
from blotter.llm import common, op6_quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    source = common.table(spark, sf_dir, "documents")
    docs, seen = source, {}
    for name, stage in P.STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == source.columns and docs.dtypes == source.dtypes
    judged = {r.doc_id: r.kept for r in op6_quality.judge(source, common.table(spark, sf_dir, "labels")).collect()}
    kept = {r.doc_id for r in seen["quality_rules"].collect()}
    assert kept == {d for d, k in judged.items() if k}

    def sets(df):
        out = {}
        for r in df.collect():
            w = WORDS.findall(r.text.lower())
            out[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
        return out
    before, after = sets(seen["quality_rules"]), sets(seen["minhash_near_dedup"])
    similar = lambda a, b: 100 * len(a & b) >= P.NEAR_PERCENT * len(a | b)
    ids = sorted(after)
    assert not any(similar(after[a], after[b]) for i, a in enumerate(ids) for b in ids[:i])
    for gone in set(before) - set(after):
        assert any(similar(before[gone], s) for d, s in before.items() if d != gone)

    texts = {r.doc_id: r.text for r in seen["minhash_near_dedup"].collect()}
    where = {}
    for d, t in texts.items():
        raw = t.encode()
        for i in range(len(raw) - P.REPEAT_BYTES + 1):
            where.setdefault(raw[i:i + P.REPEAT_BYTES], []).append(d)
    again = {d for ds in where.values() if len(ds) > 1 for d in ds}
    for r in seen["suffix_array_dedup"].collect():
        assert r.n_chars == len(r.text)
        assert (r.text != texts[r.doc_id]) == (r.doc_id in again)

    items = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in common.table(spark, sf_dir, "benchmark").collect()]
    for r in seen["benchmark_decontamination"].collect():
        plain = " ".join(re.findall(r"[^\W_]+", r.text.lower()))
        assert not any(i in plain for i in items)
    packed = {r.doc_id for r in seen["best_fit_packing"].select("doc_id").distinct().collect()}
    assert packed == {r.doc_id for r in seen["benchmark_decontamination"].collect()}


def test_empty_documents(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").where("false")
    for name, stage in P.STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"empty-{name}")
    assert docs.count() == 0


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
