import random

import numpy as np
import pytest

import cases
from ordertide.llm import near_dedup, paragraph_dedup, suffix_dedup
from ordertide.llm.components import components
from ordertide.llm.near_dedup import near_duplicate_report, near_duplicates, without_near_duplicates
from ordertide.llm.paragraph_dedup import duplicate_paragraphs, paragraph_report, passages
from ordertide.llm.suffix_dedup import repeat_report, without_repeats


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_near_duplicates_equal_brute_force(spark):
    df = cases.frame(spark)
    got = cases.plain(near_duplicate_report(df), "doc_id", "n_shingles", "component_id")
    assert got == cases.in_order(cases.near_duplicates(pairs(df)))


def test_one_row_of_each_component_stays(spark):
    df = cases.frame(spark)
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    sound = near_duplicates(df).filter("n_shingles > 0")
    alone = near_duplicates(df).filter("n_shingles = 0").count()
    assert kept.count() == sound.select("component_id").distinct().count() + alone


def test_dense_groups_and_deep_nodes(spark, monkeypatch):
    """Nodes above the exhaustive size are branched, and blocks settle what is left."""
    rng = random.Random(1)
    core = [f"c{i}" for i in range(60)]
    rows = []
    for k in range(60):
        words = list(core)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    rows += [" ".join(core[:30] + [f"u{k}-{i}" for i in range(30)]) for k in range(40)]
    df = cases.frame(spark, rows)
    want = cases.in_order(cases.near_duplicates(pairs(df)))
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 8)
    assert cases.plain(near_duplicate_report(df), "doc_id", "n_shingles", "component_id") == want
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", 2)
    assert cases.plain(near_duplicate_report(df), "doc_id", "n_shingles", "component_id") == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    roots = {r["uid"]: r["root"] for r in components(links).collect()}
    assert len({roots[i] for i in range(41)}) == 1 and roots[100] == roots[101] != roots[0]


def test_repeats_equal_brute_force(spark):
    df = cases.frame(spark)
    got = cases.plain(repeat_report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == cases.in_order(cases.repeats(pairs(df)))


def test_passages_in_different_surroundings(spark):
    """Groups of every size: shared strings of 380 to 460 bytes between random ends, overlapping each other."""
    rng = random.Random(5)
    letters = "abcdefgh "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = text(1200)
    rows = []
    for _ in range(60):
        a = rng.randrange(700)
        rows.append(text(rng.randrange(300)) + shared[a : a + rng.randint(380, 500)] + text(rng.randrange(300)))
    df = cases.frame(spark, rows)
    want = cases.in_order(cases.repeats(pairs(df)))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert cases.plain(repeat_report(df), *columns) == want
    small = suffix_dedup.remove_repeats
    counted = small(df.select("doc_id", "text"), group=2)
    got = cases.in_order([(r["row"]["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"])) for r in counted.collect()])
    assert got == cases.in_order([w[:3] for w in want])


def test_suffix_sort_orders_and_extends():
    rng = np.random.default_rng(3)
    data = [bytes(rng.integers(97, 99, 30, np.uint8)) for _ in range(40)]
    c = suffix_dedup.Contexts(np.repeat([0, 1, 2], [1, 25, 14]), np.full(40, 9), np.full(40, 21), data, 21, 10)
    for way, cut in ((1, lambda d: d[9:]), (-1, lambda d: d[:9][::-1])):
        order = c.sorted(way)
        assert order.tolist() == [i for lo, hi in ((0, 1), (1, 26), (26, 40)) for i in sorted(range(lo, hi), key=lambda i: (cut(data[i]), i))]
        assert c.verified(order, c.neighbours(order, way), way)


def test_texts_without_repeats(spark):
    df = cases.frame(spark)
    out = without_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    got = {r["text"] for r in out.filter("doc_id = 15").collect()}
    assert got == {""}
    assert out.filter("doc_id = 0").head()["text"] is None


def test_paragraphs(spark):
    a, b = cases.PASSAGE, cases.PASSAGE.replace("passage3 ", "changed ")
    rows = [a + "\nshort line", "short line\n" + b, " ".join(f"z{i}" for i in range(40)), None, "", a]
    found = {(r["doc_id"], r["place"]): r["removed"] for r in duplicate_paragraphs(cases.frame(spark, rows[:-1] + [a])).filter("doc_id is not null").collect()}
    assert found == {(0, 0): False, (1, 1): True, (2, 0): False, (5, 0): True}
    assert paragraph_report(cases.frame(spark, [])).count() == 0


def clusters(units):
    """The numbers of the units that brute force removes: all but the first of each component."""
    sets = []
    for t in units:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(units)))
    for i in range(len(units)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return {i for i, r in enumerate(root) if i != r}


@pytest.mark.parametrize("ends", [True, False])
def test_planted_passages_equal_brute_force(spark, ends):
    """Repeated short lines, and passages of 50 words and more inside longer lines, with and without sentences."""
    rng = random.Random(7 + ends)
    vocabulary = [f"w{i}" for i in range(3000)]

    def text(n):
        words = rng.choices(vocabulary, k=n)
        return " ".join(w + "." if ends and rng.random() < 0.1 else w for w in words)

    pasted = [text(rng.randint(50, 90)) for _ in range(4)]
    rows = []
    for k in range(40):
        lines = [text(rng.randint(5, 20)) for _ in range(2)] + ["a line of six words here", text(60) + " " + pasted[k % 4] + " " + text(60)]
        if k % 5 == 0:
            lines.append(" ".join(lines[0].split() + ["more"]))
        rows.append("\n".join(lines))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3, "doc_id")
    got = duplicate_paragraphs(df).collect()
    lines = [(d, p, t) for d, r in enumerate(rows) for p, t in enumerate(r.split("\n"))]
    gone = clusters([t for _, _, t in lines])
    assert len(got) == len(lines) and {(r["doc_id"], r["place"]) for r in got if r["removed"]} == {lines[i][:2] for i in gone}
    parts = [(d, p, a, t[a:b]) for i, (d, p, t) in enumerate(lines) if i not in gone for a, b in passages(t) if len(t[a:b].split()) >= 5]
    inside = clusters([x[3] for x in parts])
    want = {(*parts[i][:3], len(parts[i][3])) for i in inside}
    assert {(r["doc_id"], r["place"], x["start"], x["length"]) for r in got for x in r["passages"] or ()} == want
    assert len({w[0] for w in want if w[1] == 3}) == 36


def test_short_lines_and_scripts_without_spaces(spark):
    rows = ["one two three four five", "one two three four five\nfour words are few", "\u6211\u4eec\u4eca\u5929\u53bb\u516c\u56ed", "x\n\u6211\u4eec\u4eca\u5929\u53bb\u516c\u56ed"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    assert {(r["doc_id"], r["place"]) for r in duplicate_paragraphs(df).collect() if r["removed"]} == {(1, 0), (3, 1)}


def test_paragraph_tables_hold_places(spark, monkeypatch):
    """Texts are written once; beside them only what meets is, and the tables of the lines go before the passages."""
    written, removed = {}, []
    settle, remove = paragraph_dedup.settle, paragraph_dedup.remove_scratch

    def recorded(df, name="settled"):
        out = settle(df, name)
        written.setdefault(name, []).append((set(df.columns), out.count()))
        return out

    monkeypatch.setattr(paragraph_dedup, "settle", recorded)
    monkeypatch.setattr(paragraph_dedup, "remove_scratch", lambda s, paths: removed.extend(paths) or remove(s, paths))
    words = " ".join(f"w{i}" for i in range(30))
    rows = [words, words + " more", *[" ".join(f"u{k}-{i}" for i in range(30)) for k in range(20)]]
    got = {r["doc_id"]: r["n_removed"] for r in paragraph_report(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()}
    assert got == {k: int(k == 1) for k in range(22)}
    assert [name for name, made in written.items() if any("text" in columns for columns, _ in made)] == ["texts", "meeting-texts"]
    assert len(written["texts"]) == 1 and [n for _, n in written["meeting-texts"]] == [2, 0]
    assert sum("/paragraphs-" in x for x in removed) == 1 and not any("/lines-" in x or "/passages-" in x for x in removed)


def test_texts_are_cut_and_decoded_in_one_python_step(spark):
    """A second step in the same task would keep a second Python worker with a memory of its own alive."""
    twice = "\u00e9" * 300
    df = spark.createDataFrame([(0, "a" + twice + "\u00fc x", 303), (1, "b " + twice + "\u00f6 y", 304), (2, None, 0)], "doc_id bigint, text string, n_chars bigint")
    out = without_repeats(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert {tuple(r) for r in out.collect()} == {(0, "a x", 3), (1, "b  y", 4), (2, None, 0)}


@pytest.mark.parametrize("report", [near_duplicate_report, repeat_report])
def test_empty_tables(spark, report):
    assert report(cases.frame(spark, [])).count() == 0


def test_few_classes_beside_a_large_component_are_not_branched(spark, monkeypatch):
    """A node of one large component and a few other texts is compared where it is, however large it is."""
    rng = random.Random(3)
    core = [f"c{i}" for i in range(80)]
    rows = [" ".join(core[:k] + [f"n{k}"] + core[k + 1 :]) for k in range(20, 60)]
    rows += [" ".join(core[:65] + [f"u{k}-{rng.random()}" for _ in range(15)]) for k in range(6)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    branched, branch = [], near_dedup._branched
    monkeypatch.setattr(near_dedup, "_branched", lambda e, trees=0: branched.append(trees) or branch(e, trees))
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 8)
    got = cases.plain(near_duplicate_report(df), "doc_id", "n_shingles", "component_id")
    assert got == cases.in_order(cases.near_duplicates(pairs(df))) and branched == [near_dedup.TREES]


def test_joining_links_equal_brute_force(monkeypatch):
    """A crowded block gives a link for every two roots that its pairs join, and no more than members."""
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    rng = np.random.default_rng(4)
    core = rng.integers(0, 2**63, 40, np.uint64)
    sets = []
    for _ in range(60):
        s = core.copy()
        s[rng.choice(40, rng.integers(0, 9), replace=False)] = rng.integers(0, 2**63, 1, np.uint64)
        sets.append(np.unique(s))
    sets[5] = np.empty(0, np.uint64)
    uids, roots = np.arange(60) + 100, np.repeat([1, 2, 100], [20, 3, 37]) + np.repeat([0, 0, 1], [20, 3, 37]) * np.arange(60)
    outside = roots != 1

    def joined(links):
        group = dict(zip(uids.tolist(), roots.tolist()))
        for a, b in links:
            old, new = group[a], group[b]
            group = {u: new if g == old else g for u, g in group.items()}
        return [[v for v in group if group[v] == group[u]] for u in group]

    every = []
    for i in range(60):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and 100 * both >= 75 * len(np.union1d(sets[i], sets[j])) and (outside[i] or outside[j]) and roots[i] != roots[j]:
                every.append((100 + i, 100 + j))
    got = near_dedup.joining_links(uids, roots, outside, sets, 75)
    assert set(got) <= {(b, a) for a, b in every} and len(got) < 40 < len(every) and joined(got) == joined(every)


@pytest.mark.parametrize("group", [1, 3])
def test_crowded_groups_are_split_not_listed(spark, group):
    """Many contexts of one key are split by halves of the places, and give the same spans."""
    rng = random.Random(11)
    line = " ".join(f"l{i}" for i in range(60)) + " "
    text = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    shared = text(150) + line
    rows = [text(260) + (shared if k % 3 else shared[150:]) + text(400) for k in range(24)]
    rows += [text(5) + shared + line * 3 + text(20) for _ in range(4)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    kept = {}
    halves = suffix_dedup._halves

    def counted(parts, length):
        made = halves(parts, length)
        kept[len(kept)] = made.count()
        return made

    with pytest.MonkeyPatch.context() as m:
        m.setattr(suffix_dedup, "_halves", counted)
        got = suffix_dedup.remove_repeats(df, group=group).collect()
    want = cases.in_order([w[:3] for w in cases.repeats(pairs(df))])
    assert cases.in_order([(r["row"]["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"])) for r in got]) == want
    assert kept and sum(w[2] for w in want) > 0


def test_large_nodes_meet_by_rare_shingles(spark, monkeypatch):
    """Texts of one node that are all too far apart are not compared block by block, and similar ones still meet."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 8)
    core = [f"c{i}" for i in range(30)]
    texts = [" ".join(core + [f"u{k}-{i}" for i in range(30)]) for k in range(60)]
    texts += [t + " more" for t in texts[:20]]
    frame = spark.createDataFrame(list(enumerate(texts)), "uid bigint, text string")
    with np.errstate(over="ignore"):
        sets = near_dedup.shingle_sets(texts)
        sketches = spark.createDataFrame([(k, near_dedup.sketch(s).tobytes()) for k, s in enumerate(sets)], "uid bigint, sketch binary")
    blocks, inner = [], near_dedup._in_blocks
    monkeypatch.setattr(near_dedup, "_in_blocks", lambda large: blocks.append(large.count()) or inner(large))
    one = frame.selectExpr("7L AS node", "uid")
    links = {(r["a"], r["b"]) for r in near_dedup.links_in(one, frame, sketches, 75, 1).collect()}
    assert links == {(k, 60 + k) for k in range(20)} and sum(blocks) == 0


def test_rare_shingles_bring_all_similar_texts_together(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(9)}" for _ in range(rng.randint(5, 60))]
        for _ in range(4):
            texts.append(" ".join(words))
            words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
    frame = spark.createDataFrame(list(enumerate(texts)), "uid bigint, text string")
    nodes: dict = {}
    for r in near_dedup._rare_shingles(frame, 75).collect():
        nodes.setdefault(r["uid"], set()).add(r["node"])
    with np.errstate(over="ignore"):
        sets = [set(s.tolist()) for s in near_dedup.shingle_sets(texts)]
    similar = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(similar) > 20 and all(nodes[i] & nodes[j] for i, j in similar)


def test_small_blocks_and_pairs_are_compared_together():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 20, 40)
    n, first = int(sizes.sum()), np.cumsum(sizes) - sizes
    s, uids, roots, outside = rng.integers(0, 2, (n, 64)), rng.permutation(n), rng.integers(0, 50, n), rng.random(n) < 0.5
    i, j, k = near_dedup.alike(s, uids, roots, outside, first, sizes)
    got = sorted(zip(k.tolist(), np.minimum(uids[i], uids[j]).tolist(), np.maximum(uids[i], uids[j]).tolist()))
    want = []
    for block, (x, size) in enumerate(zip(first.tolist(), sizes.tolist())):
        for p in range(x, x + size):
            for q in range(x, p):
                if roots[p] != roots[q] and (outside[p] or outside[q]) and (s[p] == s[q]).sum() >= near_dedup.MIN_EQUAL:
                    want.append((block, min(uids[p], uids[q]), max(uids[p], uids[q])))
    assert got == sorted(want) and len(got) > 100
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint64)) for _ in range(400)]
    similar = lambda a, b: 100 * len(set(a) & set(b)) >= 30 * len(set(a) | set(b))
    pairs = list(zip((x.tolist() for x in sets[:200]), (y.tolist() for y in sets[200:])))
    assert near_dedup.alike_sets(sets[:200], sets[200:], 30).tolist() == [similar(a, b) for a, b in pairs]
