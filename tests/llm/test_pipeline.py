"""The pipeline against its stages done by hand."""

import re
from collections import Counter

import corpus_pipeline
from test_jaccard import brute as components
from test_rows import measures
from test_scans import brute as contamination


def test_stages(spark, tmp_path, vocabulary):
    import random

    rng = random.Random(8)
    prose = lambda n: "the " + " ".join(rng.choice(vocabulary) for _ in range(n)) + " of"
    items = [(1, prose(14)), (2, prose(30))]
    rows = [(i, prose(120), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, t, "en", s, n) for i, (_, t, _, s, n) in enumerate(rows[:6])]
    rows += [(200 + i, t + " " + prose(4), "en", None, n) for i, (_, t, _, _, n) in enumerate(rows[6:9])]
    rows += [(300, prose(60) + " " + items[0][1] + " " + prose(60), "en", "s1", 1), (301, "short", "en", "s1", 1), (302, None, None, "s1", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        if name != "shards":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    texts = {r[0]: r[1] for r in rows}
    good = {d for d, t in texts.items() if measures(t)[-1]}
    assert {r.doc_id for r in kept["quality_rules"]} == good
    firsts = {d for d, _, c in components([(d, texts[d]) for d in sorted(good)]) if d == c}
    assert {r.doc_id for r in kept["near_copies"]} == firsts
    clean = {d for d, _, hit, _ in contamination([(d, texts[d]) for d in firsts], items) if not hit}
    assert {r.doc_id for r in kept["decontamination"]} == clean
    assert 300 in firsts and 300 not in clean
    copies = Counter(r.doc_id for r in kept["source_mix"])
    assert set(copies) <= clean and max(copies.values()) <= 2
    assert Counter(r.doc_id for r in kept["shards"]) == copies
    sizes = Counter(r["shard"] for r in kept["shards"])
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(24)) <= 1
    assert re.fullmatch(r"[a-z_]+", corpus_pipeline.STAGES[0][0])

