import corpus_pipeline as P
from skymatch.llm import decontam, mixing, near_dedup
from skymatch.llm.common import materialize
from test_near_dedup import brute_components
from test_quality import LABELS, corpus

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_and_run(spark, tmp_path):
    rows, labels = corpus(300)
    full = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in rows]
    full += [(1000 + i, *full[i][1:]) for i in range(0, 60, 3)]
    items = [(0, full[2][1]), (1, "none of these words stand anywhere at all")]
    d = str(tmp_path)
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(P.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()] if i < 4 else None
        out = materialize(stage(spark, docs, d), f"test-{i}")
        if i < 4:
            assert out.schema.names == docs.schema.names
            after = [tuple(r) for r in out.select("doc_id", "text", "source").collect()]
            assert set(after) <= set(before)
            seen.append((before, after))
        docs = out
    (b0, a0), (b1, a1), (b2, a2), (b3, a3) = seen
    good = {i for i, q, _ in labels if q == 1}
    assert len(a0) < len(b0) and len([r for r in a0 if r[0] in good]) >= 0.95 * len([r for r in b0 if r[0] in good])
    assert {r[0] for r in a1} == {c for (n, c), r in zip(brute_components(b1, 5), b1, strict=True)}
    bad = {r.doc_id for r in decontam.contaminated(spark.createDataFrame(b2, "doc_id bigint, text string, source string"), spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    assert sorted(a2) == sorted(r for r in b2 if r[0] not in bad)
    mix = mixing.report(spark.createDataFrame(b3, "doc_id bigint, text string, source string")).collect()
    words = sum(len(r[1].split()) for r in a3)
    assert abs(words - sum({(r.source_size, r.target): r.target for r in mix}.values())) < 200
    assert docs.count() == len(a3) == P.run(spark, d).count()
    assert near_dedup.deduplicate(spark.createDataFrame(b1, "doc_id bigint, text string, source string")).count() == len(a1)
