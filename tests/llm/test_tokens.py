import io
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paceline.llm import bitpack, packing
from paceline.llm.tokens import encoder

FILES = [public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json")]


def plain(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", FILES)
def test_memo_equals_library(path, documents, odd):
    texts = [r.text or "" for r in documents.select("text").collect() + odd.select("text").collect()]
    assert encoder(path).encode(texts) == plain(path, texts)


@pytest.mark.parametrize("path", FILES)
@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=list("aB z'st\n\t\r\x1c .,!1é²µªİßÄ数́H̱<|end>"), max_size=40))
def test_memo_equals_library_on_any_text(path, text):
    assert encoder(path).encode([text]) == plain(path, [text])


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 31, 32])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 640, dtype=np.uint64).astype(np.uint32)
    assert np.array_equal(bitpack.unpack(bitpack.pack(ids, bits), bits), ids)


def test_shard_random_access():
    rng, sink = np.random.default_rng(3), io.BytesIO()
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (0, 1, 5, 700_000, 63, 64, 65, 0)]
    writer = bitpack.ShardWriter(sink, 16, 64)
    for i, d in enumerate(docs):
        writer.add(i if i else None, d)
    writer.close()
    reader = bitpack.ShardReader(io.BytesIO(sink.getvalue()))
    whole = np.concatenate(docs)
    assert np.array_equal(reader.read(100, 70_001), whole[100:70_001])
    for (i, at, ids), d in zip(reader.documents(1000), docs, strict=True):
        assert np.array_equal(ids, d) and at == reader.starts[i if i > 0 else 0]
    assert abs(len(sink.getvalue()) - 2 * len(whole)) < 0.15 * len(whole)


def test_blocks_of_a_flush_are_packed_at_once(monkeypatch):
    sizes, pack, sink = [], bitpack.pack, io.BytesIO()
    monkeypatch.setattr(bitpack, "pack", lambda ids, bits: sizes.append(len(ids)) or pack(ids, bits))
    ids = np.random.default_rng(4).integers(0, 50_000, 100_000, dtype=np.uint32)
    writer = bitpack.ShardWriter(sink, 16, 64)
    for lo in range(0, len(ids), 1000):
        writer.add(lo, ids[lo : lo + 1000])
    writer.close()
    assert len(sizes) < 30 and sum(sizes) == -(-len(ids) // 64) * 64
    reader = bitpack.ShardReader(io.BytesIO(sink.getvalue()))
    assert np.array_equal(reader.read(0, len(ids)), ids) and reader.blocks.tolist() == [128 * k for k in range(-(-len(ids) // 64))]


def test_written_and_read_again(documents, odd):
    for docs in (documents, odd, odd.limit(0)):
        got = bitpack.read_shards(bitpack.write_shards(docs, FILES[0], 2)).collect()
        source = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        assert len(got) == len(source)
        want, at = defaultdict(list), 0
        for r, x in zip(source, plain(FILES[0], [r.text or "" for r in source]), strict=True):
            x += np.array([2], "<u4").tobytes()
            want[r.doc_id].append((at, len(x) // 4, zlib.crc32(x)))
            at += len(x) // 4
        have = defaultdict(list)
        for r in got:
            have[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
        assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def check_packing(rows, length):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(bins)


@pytest.mark.parametrize(("local", "fan"), [(200_000, 8), (40, 2), (7, 3)])
def test_packing(documents, odd, local, fan):
    for docs in (documents, odd, odd.limit(0)):
        rows = packing.pack_documents(docs, FILES[1], 2, 1024, local, fan).collect()
        pieces = defaultdict(int)
        texts = [r.text or "" for r in docs.collect()]
        encoded = [x + np.array([2], "<u4").tobytes() for x in plain(FILES[1], texts)]
        for r, x in zip(docs.collect(), encoded, strict=True):
            n, at, k = len(x) // 4, 0, 0
            while at < n:
                size = (n - at) % 1024 or min(1024, n - at)
                pieces[r.doc_id, k, at, size, zlib.crc32(x[4 * at : 4 * (at + size)])] += 1
                at, k = at + size, k + 1
        got = defaultdict(int)
        for r in rows:
            got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        assert got == pieces
        n = check_packing(rows, 1024)
        if docs is documents:
            floor = -(-sum(len(x) // 4 for x in encoded) // 1024)
            assert n <= floor * (1.03 if local > 100 else 1.12) + 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200))
def test_best_fit_leaves_one_bin_half_empty(sizes):
    sizes = np.array(sorted(sizes, reverse=True), np.int64)
    bins, at, fill = packing.best_fit(sizes, 100)
    assert (np.bincount(bins, sizes, len(fill)) == fill).all() if len(sizes) else len(fill) == 0
    assert (fill <= 50).sum() <= 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=list("ab \n\t\x1c\x85\u2003数"), max_size=12))
def test_single_white_space_is_found_without_splitting(text):
    assert encoder(FILES[1])._single(text) == (text.split() == text.replace("\n", " ").split(" "))


def test_larger_memos_give_the_same_ids(documents):
    texts = [r.text or "" for r in documents.select("text").collect()]
    small, large = encoder(FILES[1]).encode(texts), encoder(FILES[1], 3)
    assert large.encode(texts) == small and large.spaced.limit == 3 * encoder(FILES[1]).spaced.limit
