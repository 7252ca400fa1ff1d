import math
import random

import pytest

import cases
from ordertide.llm import quality_rules, tokens
from ordertide.llm.decontamination import WINDOW, build_index, clean_documents, contamination, search
from ordertide.llm.quality_classifier import classify, fit_votes
from ordertide.llm.quality_rules import END, HashModel, ORDER, START, kept_documents, kneser_ney, ngram_counts, quality, quality_report, word_grams


def test_base_counts_equal_brute_force(spark):
    df = cases.frame(spark)
    texts = dict(enumerate(cases.texts()))
    for r in quality_report(df).collect():
        text = texts[len(texts) - 1 if r["doc_id"] is None else r["doc_id"]]
        want = cases.base(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert quality_report(cases.frame(spark, [])).count() == 0


def test_model_sums_to_one(spark):
    docs = spark.createDataFrame([("banana bandana ananas", "en"), ("bananas and bands", "en"), (None, None)], "text string, lang string")
    counts = ngram_counts(docs, order=3)
    seen = {(r["lang"], r["gram"]): r["n"] for r in counts.collect()}
    assert seen["en", START * 2 + "b"] == 4 and seen["en", "ana"] == 7
    rows = [(r["k"], r["gram"], r["v"]) for r in kneser_ney(counts, 3).filter("lang = 'en'").collect()]
    model = HashModel(rows, 3)
    letters = {g for k, g, _ in rows if k == 1}
    for context in ("an", START * 2, "na", START + "b"):
        assert math.isclose(sum(math.exp(x) for x in model.log_probabilities([context + c for c in letters])), 1, rel_tol=1e-9)
    words = {"banana", "bands"}
    for w, total in model.word_scores(words).items():
        assert math.isclose(total, model.log_probabilities(word_grams(w, 3)).sum(), rel_tol=1e-9)
    assert END not in {g[0] for g in letters if len(g) > 1} and ORDER == 5


@pytest.mark.parametrize("limit", [0, 1000])
def test_models_too_large_to_send(spark, monkeypatch, limit):
    """No size stops the job, and a join gives the scores that a sent model gives."""
    df = cases.frame(spark)
    columns = ["doc_id", "n_words", "n_repeat_words", "base_failed", "kept", "log_perplexity"]
    want = cases.plain(quality_report(df), *columns)
    monkeypatch.setattr(quality_rules, "SENT_GRAMS", limit)
    got = cases.plain(quality_report(df), *columns)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r[-1] for r in got] == [r[-1] if r[-1] is None else pytest.approx(r[-1], rel=1e-7) for r in want]
    assert kept_documents(df).columns == df.columns


def test_scores_remembered_by_all_models_together(spark, monkeypatch):
    """Many languages hold no more words than one, and what is forgotten is scored again alike."""
    rows = [(i, f"the words of language {i % 7} and text {i} of it", f"l{i % 7}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1)
    want = cases.plain(quality_report(docs), "doc_id", "kept", "log_perplexity")
    monkeypatch.setattr(quality_rules, "HELD_SCORES", 0)
    monkeypatch.setattr(quality_rules, "sliced", lambda batches, *_: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    assert cases.plain(quality_report(docs), "doc_id", "kept", "log_perplexity") == want


def test_encoders_are_forgotten():
    tokens.encoder(tokens.default_tokenizer()).encode(["some words"])
    tokens.forget()
    assert not tokens._encoders


def test_garbage_is_out_of_band(spark):
    rng = random.Random(2)
    words = ["the", "river", "runs", "under", "stone", "bridges", "towards", "green", "fields", "again", "slowly", "every", "morning"]
    good = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(60)]
    bad = ["".join(rng.choice("qxzjkvwyp#@") for _ in range(700 // 7 * 7)) for _ in range(2)]
    bad = [" ".join(b[i : i + 7] for i in range(0, 700, 7)) for b in bad]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id bigint, text string, lang string")
    assert {r["doc_id"] for r in kept_documents(docs).collect()} == set(range(60))
    assert quality(docs).filter("not kept and not base_failed").count() == 2


ITEMS = [(1, cases.PASSAGE), (20, "one"), (3, None), (4, "!!"), (None, "two words"), (5, " ".join(cases.BASE.split()[5:30])), (6, "word5X5 word6x6")]


def test_contamination_equals_brute_force(spark):
    df = cases.frame(spark)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    named = [(i, t) for i, t in ITEMS if i is not None]
    got = cases.plain(contamination(df, items.filter("item_id is not null")), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == cases.in_order(cases.contaminated(rows, named))
    assert contamination(df, items.limit(0)).filter("n_hit > 0").count() == 0
    assert contamination(cases.frame(spark, []), items).count() == 0
    clean = clean_documents(df, items)
    assert clean.columns == df.columns and clean.filter("doc_id in (3, 8, 13, 14)").count() == 0


def test_blocks_and_small_segments_change_nothing(spark):
    df = cases.frame(spark)
    items = spark.createDataFrame([i for i in ITEMS if i[0] is not None], "item_id bigint, text string")
    index = build_index(df, segment_words=50)
    spans = lambda m: {(r["segment"], r["doc_no"], s, e) for r in m.collect() for s, e in zip(r["starts"], r["ends"])}
    whole = spans(search(index, items))
    assert whole and spans(search(index, items, block_words=40)) == whole


def test_proximity(spark):
    docs = spark.createDataFrame([(0, "alpha x x beta y gamma"), (1, "gamma beta alpha"), (2, "alpha beta")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "alpha beta gamma")], "item_id bigint, text string")
    index = build_index(docs)
    found = {r["doc_no"]: list(r["starts"]) for r in search(index, items, proximity=4).collect()}
    assert list(found.values()) == [[0]] and WINDOW == 13
    assert len(search(index, items, proximity=6).collect()) == 2


@pytest.mark.parametrize("width", [3, 4, 6, 13])
def test_proximity_equals_brute_force(spark, width):
    """Spans of all documents of one segment, none of which may reach into the next document."""
    r = random.Random(width)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(14))) for _ in range(60)] + ["a x x b y c", "c b a", "", None, "a", "b c"]
    phrases = ["a b c", "c a", "h h a", "a", "d e f g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame(list(enumerate(phrases)), "item_id bigint, text string")
    want = {}
    for d, t in enumerate(texts):
        w = (t or "").split()
        for i, p in enumerate(phrases):
            terms = set(p.split())
            for s in range(len(w)):
                if w[s] in terms and terms <= set(w[s : s + width]):
                    spans, names = want.setdefault(d, (set(), set()))
                    spans.add((s, min(s + width, len(w))))
                    names.add(str(i))
    found = search(build_index(docs), items, proximity=width).collect()
    got = {r["doc_no"]: (set(zip(r["starts"], r["ends"])), set(r["items"])) for r in found}
    assert got == want


def test_votes_tell_good_from_bad():
    patterns = [([-1, -1, -1, 1], 800), ([0, -1, 0, -1], 60), ([-1, 0, 0, 0], 50), ([0, 0, -1, 0], 40), ([0, -1, -1, 1], 10)]
    share, table, posterior = fit_votes(patterns)
    assert 0.7 < share < 0.95 and posterior[-1, -1, -1, 1] > 0.9 and posterior[0, -1, 0, -1] < 0.1
    assert table[0, 0, 1] > table[0, 1, 1]


def test_held_out_accuracy(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = classify(docs).select("row.doc_id", "kept").join(labels, "doc_id")
    right = judged.filter("kept = (quality = 1)").count()
    assert right >= 0.9 * judged.count()


def test_classifier_edge_cases(spark):
    out = {(r["row"]["doc_id"], r["score"], r["kept"]) for r in classify(cases.frame(spark)).collect()}
    assert {(0, 0.0, False), (1, 0.0, False), (2, 0.0, False)} <= out
    assert classify(cases.frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_models(spark, n):
    docs = cases.frame(spark, ["only text"][:n])
    assert quality(docs).count() == docs.count()
