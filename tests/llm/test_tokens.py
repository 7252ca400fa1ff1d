import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from ordertide.llm.binary_output import pack_shard, read_token_shards, token_shards_round_trip, unpack_shard, write_token_shards
from ordertide.llm.packing import Packer, pack, pack_documents, packed_sequences, token_pieces
from ordertide.llm.tokens import default_tokenizer, encoder
from ordertide.session import scratch_path, settle


def true_ids(text):
    return encoder(default_tokenizer()).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aAzZ.,'!%9 \n\t\x1c\x85\xa0éÉßİΣςſK_<|>", "<|endoftext|>", "'s", "\u0301"]), max_size=20).map("".join))
def test_words_are_encoded_as_whole_texts(text):
    ids = true_ids(text)
    assert encoder(default_tokenizer()).encode([text])[0] == struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 65, 200])
def test_shards_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, [1, 2**16, 2**32][n % 3], n, dtype=np.uint64).astype("<u4")
    data = pack_shard(ids, 64, planes)
    assert unpack_shard(data).tolist() == ids.tolist()
    if n > 64:
        assert unpack_shard(data, range(1, 2)).tolist() == ids[64:128].tolist()


def test_token_files(spark):
    df = cases.frame(spark)
    path = scratch_path(spark, "shards")
    write_token_shards(df, path, shard_ids=3000, block=256)
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in read_token_shards(spark, path).collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r["doc_id"] for r in df.collect()], key=lambda x: (x is not None, x))
    texts, at = dict(enumerate(cases.texts())), 0
    for doc_id, start, raw in got:
        ids = true_ids(texts[len(texts) - 1 if doc_id is None else doc_id]) + [2]
        assert start == at and raw == struct.pack(f"<{len(ids)}I", *ids)
        at += len(ids)
    assert token_shards_round_trip(cases.frame(spark, [])).count() == 0


def test_packing(spark):
    df = cases.frame(spark)
    rows = pack_documents(df).collect()
    held, lengths = defaultdict(list), defaultdict(int)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        lengths[r["doc_id"]] += r["length"]
        assert r["start"] == 4096 * r["piece"] and 0 < r["length"] <= 4096
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    texts = cases.texts()
    last = len(texts) - 1
    assert lengths == {i: (len(true_ids(t)) + 1) * (2 if i == last else 1) for i, t in enumerate(texts)} | {None: len(true_ids(texts[last])) + 1}
    assert len(held) == -(-sum(lengths.values()) // 4096)
    first = next(r for r in rows if r["doc_id"] == 8)
    ids = true_ids(texts[8]) + [1]
    assert first["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    assert pack_documents(cases.frame(spark, [])).count() == 0


def test_sequences_hold_their_ids(spark):
    pieces = settle(token_pieces(cases.frame(spark), capacity=64, with_ids=True))
    packed = pack(pieces, 64, open_bins=3, sequences_per_packer=20)
    whole = packed_sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * packed.agg({"length": "sum"}).head()[0]
    assert all(len(r["ids"]) <= 256 for r in whole)


def test_fullest_bin_closes_first():
    p = Packer(10, open_bins=2)
    assert [p.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]
    assert [p.place(n) for n in (2, 3, 4)] == [(1, 7), (0, 6), (3, 0)]
