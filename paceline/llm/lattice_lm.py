"""Subword lattice likelihood: the marginal probability of a text over all its segmentations.

The vocabulary is that of a public subword tokenizer. Its unigram scores are learned here, over the training documents'
words: counts of the tokenizer's own segmentation to begin with, then one step of expectation-maximisation, in which all
segmentations of every distinct word count by their probability. A text is its words, each with a word mark in front, and an end. Its probability is the sum over all sequences of
pieces that spell it, by a forward recursion in log space over the lattice of pieces (bytes spell what no piece does). No
piece goes beyond a word, so the recursion passes through a single state at each word's end: the text's probability is
the product of its words', and each distinct word of the corpus is worked out once.

Words meet their counts and probabilities in two ways. The most frequent ones, a fixed number, go to every task; the rest
are joined by a shuffle, a row for each document and distinct word. So what is broadcast has a bound, and no word is lost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import id_and_text, materialize

#: Most frequent words that each task gets; distinct words that a task counts before it hands them on.
FREQUENT, COUNTED_AT_ONCE = 150_000, 400_000
#: What is added to expected counts, so that no piece is impossible.
EXTRA = 0.1
MARK = "▁"


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split()


@dataclass
class Pieces:
    """Natural log probabilities of pieces, of the 256 bytes and of the end."""

    pieces: dict[str, float]
    bytes_: list[float]
    end: float

    def __post_init__(self):
        self.steps: dict[str, float | None] = {}  # a piece's beginnings have None
        for p, x in self.pieces.items():
            for n in range(1, len(p)):
                self.steps.setdefault(p[:n], None)
            self.steps[p] = x

    def _forward(self, s: str, arcs: list[list] | None = None) -> tuple[list[float], list[list[float]]]:
        """alpha[i], the log probability of the first i characters over all their segmentations, and its summands: alpha where
        an arc to i begins plus the arc's log probability. arcs gets, in the same order, where each begins and its piece ("" for
        a character spelt in bytes)."""
        n, steps, low, bytes_, exp = len(s), self.steps, -math.inf, self.bytes_, math.exp
        alpha, summands = [0.0] * (n + 1), [[] for _ in range(n + 1)]
        here = 0.0
        for i in range(n):
            spelt, c = here, s[i]
            if c < "\x80":
                spelt += bytes_[ord(c)]
            else:
                for b in c.encode("utf-8", "replace"):
                    spelt += bytes_[b]
            summands[i + 1].append(spelt)
            if arcs is not None:
                arcs[i + 1].append((i, ""))
            for j in range(i + 1, n + 1):
                p = s[i:j]
                x = steps.get(p, low)
                if x is None:
                    continue
                if x == low:
                    break
                summands[j].append(here + x)
                if arcs is not None:
                    arcs[j].append((i, p))
            into = summands[i + 1]
            here = into[0]
            if len(into) > 1:
                top = max(into)
                here = top + math.log(sum([exp(x - top) for x in into]))
            alpha[i + 1] = here
        return alpha, summands

    def word(self, word: str) -> float:
        """Log probability of a word behind its mark, over all its segmentations."""
        return self._forward(MARK + word)[0][-1]

    def expect(self, word: str, weight: float, pieces: dict[str, float], bytes_: list[float]) -> None:
        """Add how often each piece and byte is expected in the word, times weight. through[j] is how often segmentations have a
        border at j; it is dealt to the arcs that end there by their shares of alpha[j]."""
        s = MARK + word
        arcs: list[list[tuple[int, str]]] = [[] for _ in range(len(s) + 1)]
        alpha, summands = self._forward(s, arcs)
        through = [0.0] * len(s) + [weight]
        least, exp = weight * 1e-12, math.exp
        for j in range(len(s), 0, -1):
            here, top = through[j], alpha[j]
            if here < least:
                continue
            for (i, p), x in zip(arcs[j], summands[j], strict=True):
                y = here * exp(x - top)
                if y < least:
                    continue
                through[i] += y
                if p:
                    pieces[p] = pieces.get(p, 0.0) + y
                else:
                    for b in s[i].encode("utf-8", "replace"):
                        bytes_[b] += y


class Together:
    """The same recursions for many words at once, over arrays: ASCII words of one length share each step. What is not ASCII,
    longer than LONGEST or alone with its length goes word by word."""

    LONGEST, FEWEST, MOST, MARKED = 64, 8, 4096, 128

    def __init__(self, scores: Pieces):
        self.scores = scores
        column = lambda c: self.MARKED if c == MARK else ord(c)
        self.names = ["", *(p for p in scores.steps if all(c == MARK or c < "\x80" for c in p))]
        number = {p: k for k, p in enumerate(self.names)}
        self.dead = len(self.names)
        self.next = np.full((self.dead + 1, self.MARKED + 1), self.dead, np.int32)
        self.value = np.full(self.dead + 1, -np.inf)
        for p, k in number.items():
            if p:
                self.next[number[p[:-1]], column(p[-1])] = k
                x = scores.steps[p]
                self.value[k] = -np.inf if x is None else x
        self.spelt = np.array([*scores.bytes_[:128], sum(scores.bytes_[b] for b in MARK.encode())])

    def _groups(self, words: list[str]) -> tuple[list[tuple[list[int], np.ndarray]], list[int]]:
        """Places of words of one length with their characters (a row for each position, the mark first); the other places."""
        by_length: dict[int, list[int]] = {}
        single = []
        for k, w in enumerate(words):
            if w.isascii() and len(w) <= self.LONGEST:
                by_length.setdefault(len(w), []).append(k)
            else:
                single.append(k)
        groups = []
        for n, places in by_length.items():
            for lo in range(0, len(places), self.MOST):
                at = places[lo : lo + self.MOST]
                if len(at) < self.FEWEST:
                    single += at
                    continue
                chars = np.frombuffer("".join([words[k] for k in at]).encode(), np.uint8).reshape(len(at), n)
                groups.append((at, np.vstack([np.full((1, len(at)), self.MARKED), chars.T]).astype(np.int64)))
        return groups, single

    def _forward(self, chars: np.ndarray, arcs: list[list] | None = None) -> np.ndarray:
        """alpha[i, word]. arcs[j] gets what ends at j: where it begins, whose it is, the nodes of its pieces, its summands."""
        n, m = chars.shape
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0.0
        everyone = np.arange(m)
        for i in range(n):
            here = alpha[i]
            spelt = here + self.spelt[chars[i]]
            alpha[i + 1] = np.logaddexp(alpha[i + 1], spelt)
            if arcs is not None:
                arcs[i + 1].append((i, everyone, None, spelt))
            node, active = self.next[0, chars[i]], everyone
            for j in range(i + 1, n + 1):
                on = node != self.dead
                node, active = node[on], active[on]
                if not len(active):
                    break
                x = self.value[node]
                ends = x > -np.inf
                who = active[ends]
                if len(who):
                    summand = here[who] + x[ends]
                    alpha[j, who] = np.logaddexp(alpha[j, who], summand)
                    if arcs is not None:
                        arcs[j].append((i, who, node[ends], summand))
                if j < n:
                    node = self.next[node, chars[j, active]]
        return alpha

    def words(self, words: list[str]) -> np.ndarray:
        """Pieces.word of each."""
        out = np.empty(len(words))
        groups, single = self._groups(words)
        for at, chars in groups:
            out[at] = self._forward(chars)[-1]
        for k in single:
            out[k] = self.scores.word(words[k])
        return out

    def expect(self, words: list[str], weights: np.ndarray, pieces: dict[str, float], bytes_: list[float]) -> None:
        """Pieces.expect of each."""
        groups, single = self._groups(words)
        found, spelt = np.zeros(self.dead), np.zeros(self.MARKED + 1)
        for at, chars in groups:
            n = len(chars)
            arcs: list[list] = [[] for _ in range(n + 1)]
            alpha = self._forward(chars, arcs)
            through = np.zeros_like(alpha)
            through[n] = weights[at]
            nodes, shares = [], []
            for j in range(n, 0, -1):
                for i, who, node, summand in arcs[j]:
                    y = through[j, who] * np.exp(summand - alpha[j, who])
                    through[i, who] += y
                    if node is None:
                        spelt += np.bincount(chars[i], y, self.MARKED + 1)
                    else:
                        nodes.append(node)
                        shares.append(y)
            if nodes:
                found += np.bincount(np.concatenate(nodes), np.concatenate(shares), self.dead)
        for k in np.flatnonzero(found).tolist():
            pieces[self.names[k]] = pieces.get(self.names[k], 0.0) + float(found[k])
        for b in range(128):
            bytes_[b] += float(spelt[b])
        for b in MARK.encode():
            bytes_[b] += float(spelt[self.MARKED])
        for k in single:
            self.scores.expect(words[k], float(weights[k]), pieces, bytes_)


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def _vocabulary(model: str) -> tuple[dict[str, int], dict[int, int]]:
    """Ids of the pieces that lie within a word, and of the bytes."""
    sp = _processor(model)
    pieces, byte_ids = {}, {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:-1], 16)] = i
        elif not sp.is_control(i) and not sp.is_unknown(i) and not sp.is_unused(i) and MARK not in p[1:]:
            pieces[p] = i
    return pieces, byte_ids


def piece_scores(counts: dict[int, float], ends: int, model: str, add: float = 1.0) -> Pieces:
    """Estimates from counts, each raised by `add`, over the vocabulary's pieces that lie within a word, its bytes, and the end."""
    pieces, byte_ids = _vocabulary(model)
    total = sum(counts.get(i, 0) for i in [*pieces.values(), *byte_ids.values()]) + ends + add * (len(pieces) + 257)
    log = lambda i: math.log((counts.get(i, 0) + add) / total)
    return Pieces({p: log(i) for p, i in pieces.items()}, [log(byte_ids.get(b, -1)) for b in range(256)], math.log((ends + add) / total))


def held_out_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out: crc32 of the id's text (null: the empty one) leaves 2 when divided by 7."""
    return id_and_text(docs).withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2)


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: every word of the corpus with its count in the training documents, pre-aggregated in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        others: set[bytes] = set()

        def emit() -> pa.RecordBatch:
            for w in others:
                counts[w] += 0
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            out = pa.record_batch([words, pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            others.clear()
            return out

        for batch in batches:
            for text, held in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
                words = words_of(text.as_py())
                if held:
                    others.update(words)
                else:
                    counts.update(words)
                if len(counts) + len(others) > COUNTED_AT_ONCE:
                    yield emit()
        if counts or others:
            yield emit()

    return docs.select("text", "held_out").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_pieces(words: DataFrame, model: str) -> dict[int, int]:
    """How often the tokenizer uses each piece for the counted words: one number for each piece of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(model)
        total = np.zeros(sp.get_piece_size(), np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            for lo in range(0, len(batch), 20_000):
                encoded = sp.encode(batch.column(0).slice(lo, 20_000).to_pylist(), num_threads=1)
                sizes = [len(x) for x in encoded]
                np.add.at(total, np.array([i for x in encoded for i in x], np.int64), np.repeat(n[lo : lo + 20_000], sizes))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["piece", "n"])

    found = words.where(F.col("n") > 0).select("word", "n").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in found.collect()}


def expected_pieces(words: DataFrame, scores: Pieces, model: str) -> dict[int, float]:
    """How often each piece is expected for the counted words over all their segmentations: one number for each piece of the
    vocabulary. Every distinct training word takes part, weighted by its count."""
    shared = words.sparkSession.sparkContext.broadcast(scores)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, bytes_, together = {}, [0.0] * 256, Together(shared.value)
        for batch in batches:
            together.expect(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64), found, bytes_)
        ids, byte_ids = _vocabulary(model)
        out = {ids[p]: x for p, x in found.items()} | {byte_ids[b]: x for b, x in enumerate(bytes_) if x and b in byte_ids}
        yield pa.record_batch([pa.array(out, pa.int64()), pa.array(out.values(), pa.float64())], ["piece", "n"])

    summed = words.where(F.col("n") > 0).select("word", "n").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in summed.collect()}


def _with_log(words: DataFrame, pieces: Pieces) -> DataFrame:
    """word, n, lp: with the log probability of each word."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = Together(shared.value)
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(together.words(batch.column(0).to_pylist()), pa.float64())], ["word", "n", "lp"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, lp double")


def _most_frequent(known: DataFrame, most: int) -> DataFrame:
    """At most `most` words, those from some count on, found from a histogram of counts in steps of a sixteenth of an octave."""
    step = F.floor(F.log2(F.col("n") + 1.0) * 16)
    left, cut = most, None
    for r in sorted(known.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):  # some hundreds
        if r.k > left:
            break
        left, cut = left - r.k, r.step
    return known.where(step >= cut) if cut is not None else known.limit(0)


def likelihood(docs: DataFrame, model: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, pieces_per_word... for each row of docs.

    Tokens are a text's words and one end. base_score: log10 of the add-one word unigram probability, with counts of the
    training documents (those not held out). score: log10 of the lattice model's probability of the text. Null texts are
    empty ones (one end); rows without an id have the id text "". Repeated rows count as often as they stand there; an
    empty table gives an empty result, and without training documents all counts are 0."""
    spark = docs.sparkSession
    rows = held_out_of(docs)
    words = materialize(count_words(rows), "words")
    ends = rows.where(~F.col("held_out")).count()
    sums = words.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    tokens, distinct = (sums.n or 0) + ends, sums.v + (1 if ends else 0)
    pieces = piece_scores(count_pieces(words, model), ends, model)
    pieces = piece_scores(expected_pieces(words, pieces, model), ends, model, EXTRA)
    known = materialize(_with_log(words, pieces), "known")
    divisor = math.log10(tokens + distinct + 1)

    top = _most_frequent(known, frequent).toPandas()
    shared = spark.sparkContext.broadcast((  # at most `frequent` words
        [w.encode() for w in top["word"]],
        np.log10(top["n"].to_numpy(np.float64) + 1) - divisor,
        top["lp"].to_numpy(np.float64),
        top["n"].to_numpy(np.int64) > 0,
    ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, base, lp, seen = shared.value
        place = {w: i for i, w in enumerate(listed)}
        base, lp, seen = np.append(base, 0.0), np.append(lp, 0.0), np.append(seen, False)
        none = len(listed)
        for batch in batches:
            ids, keys, held, texts = (batch.column(k) for k in range(4))
            for lo in range(0, len(batch), 200):
                out: list[list] = [[] for _ in range(9)]
                for doc_id, key, h, text in zip(*(c.slice(lo, 200).to_pylist() for c in (ids, keys, held)), texts.slice(lo, 200).cast(pa.binary()).to_pylist(), strict=True):
                    words = words_of(text)
                    at = np.fromiter((place.get(w, none) for w in words), np.int64, len(words))
                    rare = Counter(words[i] for i in np.flatnonzero(at == none).tolist())
                    row = (key, doc_id, h, None, len(words), int(seen[at].sum()), float(base[at].sum()), float(lp[at].sum()), True)
                    for c, x in zip(out, row, strict=True):
                        c.append(x)
                    m = len(rare)
                    for c, x in zip(out, ([key] * m, [None] * m, [None] * m, list(rare), list(rare.values()), [None] * m, [None] * m, [None] * m, [False] * m), strict=True):
                        c.extend(x)
                types = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
                arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
                arrays[3] = arrays[3].cast(pa.string())
                yield pa.record_batch(arrays, ["key", "doc_id", "held_out", "word", "n", "seen", "base", "lp", "whole"])

    keyed = rows.withColumn("key", F.monotonically_increasing_id()).select("doc_id", "key", "held_out", "text")
    parts = materialize(keyed.mapInArrow(run, "key long, doc_id long, held_out boolean, word string, n long, seen long, base double, lp double, whole boolean"), "parts")
    rare = parts.where(~F.col("whole")).select("key", "word", F.col("n").alias("tf"))
    met = rare.join(known, "word").groupBy("key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("rare_seen"),
        F.sum(F.col("tf") * (F.log10(F.col("n") + 1.0) - divisor)).alias("rare_base"),
        F.sum(F.col("tf") * F.col("lp")).alias("rare_lp"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = parts.where("whole").join(met, "key", "left")
    return out.select(
        "doc_id", "held_out",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("seen") + zero("rare_seen") + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") + (math.log10(ends + 1) - divisor)).alias("base_score"),
        ((F.col("lp") + zero("rare_lp") + pieces.end) / math.log(10)).alias("score"),
    )
