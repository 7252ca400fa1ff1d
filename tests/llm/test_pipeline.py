import cases
import corpus_pipeline
from ordertide.llm.quality_rules import quality
from ordertide.session import settle


def test_each_stage_works_on_what_is_left(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    rows = lambda d: [(r["doc_id"], r["text"]) for r in d.collect()]
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(settle(stage(spark, docs, sf)))
        assert kept[-1].columns == columns
        docs = kept[-1]
    sound, single, cut, clean = kept
    start = spark.read.parquet(f"{sf}/documents.parquet")
    assert {r["doc_id"] for r in sound.collect()} == {r["row"]["doc_id"] for r in quality(start).filter("kept").collect()}
    assert {r["doc_id"] for r in single.collect()} == {c for _, _, c in cases.near_duplicates(rows(sound))}
    digests = {d: n for d, _, n, _, _ in cases.repeats(rows(single))}
    before = dict(rows(single))
    for r in cut.collect():
        left = len(before[r["doc_id"]].encode()) - digests[r["doc_id"]]
        assert left - 6 * (digests[r["doc_id"]] > 0) * 20 <= len(r["text"].encode()) <= left and r["n_chars"] == len(r["text"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in clean.collect()} == {d for d, *_, bad in cases.contaminated(rows(cut), items) if not bad}
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in clean.collect()}
