import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from ordertide.llm import token_alignment as A

BOTH = A.token_pair(A.default_tokenizers())
ODD = [
    "  two  spaces ", "\nline\n\nother\r\nend\n", " \n ", "tab\there", "a▁b", "▁", "x ▁y", "<|endoftext|> <s> </s> <0x41> <unk>",
    "café é ﬁ Å 　 wide", "\x00 \x1c \x1f \x85 nul", "你好，世界。" * 30, "\U0001f600\U0001f468‍\U0001f469",
    "don't I'll we've 'tis", "12345 3.14 1,000 a1b2", "​ ﻿ ᠎ z", "word" * 3000, "    indented\n        more",
]


def brute_groups(a, b):
    """Groups by common ends and links by comparing all byte ranges."""
    ends = sorted(set(a) & set(b))
    span = lambda e: list(zip([0, *e[:-1]], e))
    links = [(i, j) for i, (s, e) in enumerate(span(a)) for j, (t, f) in enumerate(span(b)) if s < f and t < e]
    return [a.index(e) + 1 for e in ends], [b.index(e) + 1 for e in ends], links


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40), st.lists(st.integers(0, 39), max_size=6), st.data())
def test_aligned(steps, drops, data):
    common = np.cumsum(steps).tolist()
    a = [e for k, e in enumerate(common) if k not in drops or k == len(common) - 1]
    gone = data.draw(st.sets(st.integers(0, 39), max_size=12))
    b = [e for k, e in enumerate(common) if k not in gone or k == len(common) - 1]
    ga, gb, la, lb = A.aligned(a, b)
    assert (ga, gb, sorted(zip(la, lb))) == brute_groups(a, b)
    assert len(la) == len(a) + len(b) - len(ga)


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 4097])
def test_long_runs(n):
    a = list(range(1, n + 1))
    assert A.aligned(a, a) == (a, a, list(range(n)), list(range(n)))
    b = a[: n // 2] + a[n // 2 + 1 :] if n > 2 else a
    ga, gb, la, lb = A.aligned(a, b)
    assert ga[-1] == len(a) and gb[-1] == len(b) and len(ga) == len(b)
    assert A.aligned([], []) == ([], [], [], [])


def tokens(text):
    """Ids and byte ends of the whole text, or nothing if the bytes differ."""
    if not text:
        return None
    want = (" " + text).encode()
    a, b = BOTH.a.encode(" " + text, add_special_tokens=False).ids, BOTH.b.encode(text)
    x, y = [BOTH.bytes_a[i] for i in a], [BOTH.bytes_b[i] for i in b]
    if b"".join(x) != want or b"".join(y) != want:
        return None
    return a, np.cumsum([len(t) for t in x]).tolist(), b, np.cumsum([len(t) for t in y]).tolist()


def brute(rows):
    held, docs = Counter(), []
    for doc_id, t in rows:
        got = tokens(t)
        if got is None:
            docs.append((doc_id, None))
            continue
        a, ea, b, eb = got
        ga, gb, la, lb = A.aligned(ea, eb)
        cut = lambda ids, ends: [ids[s:e] for s, e in zip([0, *ends[:-1]], ends)]
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in zip(cut(a, ga), cut(b, gb)))
        links = [(a[i], b[j]) for i, j in zip(la, lb)]
        held.update(set(links))
        docs.append((doc_id, (len(a), len(b), len(ga), links, text)))
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, d in docs:
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = d
        best = sum(held[p] == highest[p[0]] for p in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_small_texts_against_all_ranges():
    for t in [*ODD[:9], "a few plain words, and Some more.", "Zwei Wörter"]:
        got = tokens(t)
        if got and len(got[0]) < 300:
            ga, gb, la, lb = A.aligned(got[1], got[3])
            assert (ga, gb, sorted(zip(la, lb))) == brute_groups(got[1], got[3])


@pytest.mark.parametrize("sent", [A.SENT_PAIRS, 3])
def test_documents(spark, sent):
    df = cases.frame(spark, cases.texts() + ODD)
    out = A.alignment_report(df.repartition(5), sent_pairs=sent)
    assert out.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert cases.plain(out, *COLUMNS) == cases.in_order(brute(rows))


def test_empty_table(spark):
    assert A.alignment_report(cases.frame(spark, [])).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"aAzZ.,'!%9 \n\t\x1c\x85\xa0　éÉßİ▁́_<|>\r", "  ", "the", " of", "<s>", "你\U0001f600"]), min_size=1, max_size=24).map("".join))
def test_segments_keep_ids(text):
    """Cut and whole texts give the same tokens, however segments are joined to be encoded."""
    assert BOTH.apart
    segments = BOTH.segments(" " + text)
    assert "".join(segments) == " " + text
    parts_a = [i for s in segments for i in BOTH.a.encode(s, add_special_tokens=False).ids]
    parts_b = [i for s in segments for i in BOTH._encode_b(s)]
    assert parts_a == BOTH.a.encode(" " + text, add_special_tokens=False).ids
    if "▁" not in text:
        assert parts_b == BOTH.b.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab.'▁é\n", " ", "  ", " the", " on"]), max_size=9).map("".join), max_size=5))
def test_parts_of_texts(texts):
    fresh = object.__new__(A.TokenPair)
    fresh.__dict__ |= BOTH.__dict__
    fresh.forget()
    made = fresh.documents(texts)
    want = brute(list(enumerate(texts)))
    assert made["figures"].tolist() == [list(w[1:4]) for w in want]
    assert made["digests"] == [w[7] for w in want]
    for k, w in enumerate(want):
        assert made["times"][made["doc"] == k].sum() == w[4]
