"""The pipeline's stages on a small folder of planted cases, against each stage's rule."""

import random

import corpus_pipeline
from corpreg.llm import decontam, suffix_dedup

from .test_dedup import brute_cut, brute_matches, prose


def test_pipeline_on_planted_cases(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rng = random.Random(1)
    base = docs.where("lang = 'en' and n_chars > 2000").orderBy("doc_id").first()["text"]
    near = base.split(" ")
    near[5] = "other"
    item = bench.where("text is not null").orderBy("item_id").first()["text"]
    planted = [(9000, base, "en", None, 1), (9001, " ".join(near), None, "s", None), (9002, f"{prose(rng, 3)} {item} {prose(rng, 3)}", "en", "s", 1), (9003, None, "en", "s", 0), (9004, "1234 !!", "en", "s", 0), (9000, base, "en", None, 1)]
    all_docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    all_docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    current, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = current
        out = stage(spark, current, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage{k}"))
        current = spark.read.parquet(str(tmp_path / f"stage{k}"))
        rows, prior = current.collect(), before.collect()
        sizes.append(len(rows))
        if k < 4:
            assert current.columns == docs.columns
            ids = {r["doc_id"] for r in rows}
        if name == "language":
            assert {9003, 9004} & ids == set() and {9000, 9001, 9002} <= ids and len(rows) >= len(prior) - 6
        elif name == "near_duplicates":
            assert not {9000, 9001} & ids and len({r["text"] for r in rows}) == len(rows)
        elif name == "repeated_passages":
            want = [(r[0], r[1] - r[2]) for r in brute_cut([(r["doc_id"], r["text"]) for r in prior]) if r[2] < r[1] or not r[2]]
            assert sorted(i for i, _ in want) == sorted(r["doc_id"] for r in rows)
            assert all(len(r["text"].encode()) <= dict(want)[r["doc_id"]] for r in rows)
        elif name == "decontaminate":
            hit = {m[0] for m in brute_matches([(r["doc_id"], r["text"]) for r in prior], [])}
            found = {r["doc_id"] for r in decontam.contaminated(before, bench).collect()}
            assert not hit and ids == {r["doc_id"] for r in prior} - found and 9002 not in ids
    assert current.agg({"length": "max"}).first()[0] <= 4096 and {r["doc_id"] for r in rows} == {r["doc_id"] for r in prior}
    assert suffix_dedup.LENGTH == 50 and all(sizes)
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r["doc_id"] for r in again.select("doc_id").collect()) == sorted(r["doc_id"] for r in rows)
