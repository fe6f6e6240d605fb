import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from paceline.llm import lattice_lm as lm

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARKED = "a" + lm.MARK + "b"


def all_segmentations(model, word):
    s = lm.MARK + word

    def walk(i):
        if i == len(s):
            return 1.0
        total = math.exp(sum(model.bytes_[b] for b in s[i].encode())) * walk(i + 1)
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in model.pieces:
                total += math.exp(model.pieces[s[i:j]]) * walk(j)
        return total

    return walk(0)


def test_forward_recursion_sums_over_all_segmentations():
    model = lm.piece_scores({i: (i * 7919) % 1000 for i in range(32000)}, 5, MODEL)
    total = sum(map(math.exp, [*model.pieces.values(), *model.bytes_, model.end]))
    assert abs(total - 1) < 1e-9
    for word in ("the", "hello", "ß数x", "aaaa", "unable", ""):
        assert model.word(word) == pytest.approx(math.log(all_segmentations(model, word)), rel=1e-12)


def segmentations(model, s):
    """Lists of (piece or byte, probability), one for each way to spell s."""
    if not s:
        yield []
    for j in range(1, len(s) + 1):
        if s[:j] in model.pieces:
            yield from ([(s[:j], model.pieces[s[:j]]), *rest] for rest in segmentations(model, s[j:]))
    if s:
        spelt = [(b, model.bytes_[b]) for b in s[0].encode()]
        yield from (spelt + rest for rest in segmentations(model, s[1:]))


def test_expected_counts_are_those_of_all_segmentations():
    model = lm.piece_scores({i: (i * 7919) % 1000 for i in range(32000)}, 5, MODEL)
    for word in ("the", "hello", "ß数x", "aaaa", "unable", ""):
        pieces, spelt = {}, [0.0] * 256
        model.expect(word, 3.0, pieces, spelt)
        ways = [(math.exp(sum(x for _, x in way)), way) for way in segmentations(model, lm.MARK + word)]
        whole, want = sum(x for x, _ in ways), Counter()
        for x, way in ways:
            for unit, _ in way:
                want[unit] += 3 * x / whole
        have = pieces | {b: x for b, x in enumerate(spelt) if x}
        for unit in want.keys() | have.keys():
            assert have.get(unit, 0) == pytest.approx(want[unit], rel=1e-6, abs=1e-9)


def test_words_together_are_as_words_alone():
    model = lm.piece_scores({i: (i * 7919) % 1000 for i in range(32000)}, 5, MODEL)
    rng = random.Random(5)
    words = ["".join(rng.choice("etaonis.\x00A|") for _ in range(rng.randrange(12))) for _ in range(3000)]
    words += ["the", "ß数x", "", MARKED, "a" * 64, "a" * 65, "unable" * 2000] + ["x" * 64] * 9
    weights = np.array([float(1 + k % 7) for k in range(len(words))])
    together = lm.Together(model)
    assert together.words(words) == pytest.approx([model.word(w) for w in words], rel=1e-12)
    a, b, c, d = {}, [0.0] * 256, {}, [0.0] * 256
    together.expect(words, weights, a, b)
    for w, x in zip(words, weights.tolist(), strict=True):
        model.expect(w, x, c, d)
    assert b == pytest.approx(d, rel=1e-8, abs=1e-6)
    for p in a.keys() | c.keys():
        assert a.get(p, 0) == pytest.approx(c.get(p, 0), rel=1e-8, abs=1e-6)


def trained(counts):
    """The model of counted words, None being the end: the tokenizer's own pieces first, one step of expectation after that."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Counter(p for w, c in counts.items() if w is not None for p in sp.encode(w) * c)
    first = lm.piece_scores(pieces, counts[None], MODEL)
    found, spelt = {}, [0.0] * 256
    for w, c in counts.items():
        if w is not None:
            first.expect(w, c, found, spelt)
    ids, byte_ids = lm._vocabulary(MODEL)
    expected = {ids[p]: x for p, x in found.items()} | {byte_ids[b]: x for b, x in enumerate(spelt)}
    return first, lm.piece_scores(expected, counts[None], MODEL, lm.EXTRA)


def test_step_raises_the_likelihood_of_what_it_learned_from_and_of_held_out_texts(documents):
    rows, counts, tokens = plain([(r.doc_id, r.text) for r in documents.collect()])
    first, model = trained(counts)
    for held in (False, True):
        words = Counter(w for row, ws in zip(rows, tokens, strict=True) if row[1] is held for w in ws)
        score = [sum(n * m.word(w) for w, n in words.items()) for m in (first, model)]
        assert score[1] > score[0]


def plain(rows, model=None):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, _), ws, h in zip(rows, tokens, held, strict=True):
        ws = [*ws, None]
        out.append((i, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)))
    return out, counts, tokens


@pytest.mark.parametrize("frequent", [150_000, 50, 0])
def test_base_and_score(documents, odd, frequent):
    for docs in (documents, odd):
        source = [(r.doc_id, r.text) for r in docs.collect()]
        want, counts, tokens = plain(source)
        _, model = trained(counts)
        scores = [(sum(model.word(w) for w in ws) + model.end) / math.log(10) for ws in tokens]
        key = lambda r: (str(r[0]), r[2], r[5])
        have = sorted((tuple(r) for r in lm.likelihood(docs, MODEL, max(1, frequent)).collect()), key=key)
        for a, (b, s) in zip(have, sorted(zip(want, scores, strict=True), key=lambda x: key(x[0])), strict=True):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(s, rel=1e-9)


def test_empty_table(odd):
    assert lm.likelihood(odd.limit(0), MODEL).collect() == []
