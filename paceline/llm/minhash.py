"""Near-duplicate detection with b-bit MinHash.

Each document's set of word shingles gives 128 minima. Bands of 4 minima name the buckets that candidates meet in; of each
minimum only the low 2 bits are kept, packed into four 64-bit words, from which bit counts estimate a pair's similarity,
corrected for the chance that bits agree by accident. What passes the estimate (five standard deviations below the
threshold) is confirmed on the full sets.

Equal sets count as one vertex, so copies cost nothing. Within a bucket no list of all pairs is made: first every member is
compared with the bucket's most central one (that which meets most others over all its buckets, such as the original of
many copies), and the links found merge vertices into components. Members of one component need no more comparing. Where
very many pairs from different components are left, another member of each bucket is compared with those outside its
component. The pairs left after that are compared in a join whose condition keeps, once for all bands that they share, those
that pass the estimate from a longer signature of 2048 minima.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import claim, files_for, id_and_text, materialize, only_ids, spread_join, unused
from paceline.llm.graph import components

#: Bands and minima in each; bits kept of a minimum. A pair of similarity 0.8 shares no band once in 10**7.
BANDS, ROWS, BITS = 32, 4, 2
MINIMA = BANDS * ROWS
#: Minima of the longer signature; rounds of comparing with one member of a bucket, at most; comparisons for each member of
#: an open bucket above which there is another such round.
LONG, ROUNDS, PAIRS_EACH = 2048, 4, 2000

_rng = np.random.default_rng(20)
_MUL = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """Word to 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def _claim() -> None:
    claim("minhash", _words.clear)


def shingles(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles of `width` words, as sorted 64-bit hashes. Words are what ASCII white space leaves, with A-Z in
    lower case; fewer than `width` words are one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    n = len(words) - size + 1
    s = np.full(n, size, np.uint64)
    for k in range(size):
        s += h[k : k + n] * _PLACE[k]
    return np.unique(_mix(s))


def minima(s: np.ndarray, n: int = MINIMA) -> np.ndarray:
    out = np.full(n, ~np.uint64(0))
    step = (1 << 17) // n  # what stands in a fast cache
    for lo in range(0, len(s), step):
        out = np.minimum(out, (s[lo : lo + step, None] * _MUL[:n] + _ADD[:n]).min(0))
    return out


def bands_of(m: np.ndarray) -> np.ndarray:
    rows = m.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        key = _mix(key ^ rows[:, k] * _PLACE[k])
    return key


def packed(m: np.ndarray) -> np.ndarray:
    """The low 2 bits of each minimum: words of lower bits, then as many of upper ones."""
    low = _mix(m)
    planes = [np.packbits((low >> np.uint64(b) & np.uint64(1)).astype(np.uint8)).view("<u8") for b in range(BITS)]
    return np.concatenate(planes)


def estimate(agree: float) -> float:
    """Similarity from the share of minima whose low bits agree, corrected for accidental agreement."""
    by_chance = 0.5**BITS
    return (agree - by_chance) / (1 - by_chance)


def least_agreeing(percent: int, n: int = MINIMA) -> int:
    """Agreeing minima of n that a pair at the threshold has, but for once in about 10**7."""
    p = percent / 100 + (1 - percent / 100) * 0.5**BITS
    return max(0, int(n * p - 5.2 * (n * p * (1 - p)) ** 0.5))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, lo and hi (a hash of the set), bands, w0 to w3 (packed bits) for each row; without words bands
    are empty and the rest null."""
    names = ["doc_id", "n_shingles", "lo", "hi", "bands", "w0", "w1", "w2", "w3"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim()
        for batch in batches:
            out = []
            for text in batch.column(1).cast(pa.binary()):
                s = shingles(text.as_py(), width)
                if not len(s):
                    out.append((0, None, None, [], None, None, None, None))
                    continue
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
                m = minima(s)
                out.append((len(s), *digest, bands_of(m).view(np.int64), *packed(m).view(np.int64).tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 8
            arrays = [pa.array(c, pa.list_(pa.int64()) if k == 3 else pa.int64()) for k, c in enumerate(columns)]
            yield pa.record_batch([batch.column(0), *arrays], names)

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_shingles long, lo long, hi long, bands array<long>, w0 long, w1 long, w2 long, w3 long")


def _may_link(a: str, b: str, percent: int, n: int = MINIMA) -> Column:
    """Bit counts of the packed signatures (words w0, w1, ...) pass the estimate, and the sizes alone don't rule a link out."""
    half = n // 64
    agree = F.lit(n)
    for k in range(half):
        agree = agree - F.bit_count(F.col(f"{a}.w{k}").bitwiseXOR(F.col(f"{b}.w{k}")).bitwiseOR(F.col(f"{a}.w{k + half}").bitwiseXOR(F.col(f"{b}.w{k + half}"))))
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (agree >= least_agreeing(percent, n))


def _long_signatures(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """rep, n_shingles, w0, w1, ... from LONG minima, for the rows of docs whose doc_id is among ids (doc_id)."""
    words = [f"w{k}" for k in range(LONG * BITS // 64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim()
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(1).cast(pa.binary())]
            found = np.array([packed(minima(s, LONG)) for s in sets]).reshape(len(sets), len(words)).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(found[:, k], pa.int64()) for k in range(len(words))]], ["rep", "n_shingles", *words])

    texts = only_ids(id_and_text(docs), ["doc_id"], ids).select("doc_id", "text")
    return texts.mapInArrow(run, "rep long, n_shingles long, " + ", ".join(f"{w} long" for w in words))


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int, files: int) -> DataFrame:
    """The pairs (a, b) of vertices whose full sets have 100 * intersection >= percent * union, a < b. A vertex may be in
    very many pairs as a; its set is then repeated for several tasks. files: of the pairs and of the vertices' ids."""
    pairs = materialize(pairs.select("a", "b"), "pairs", files)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim()
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                found = [shingles(t.as_py(), width).view(np.int64) for t in part.column(1).cast(pa.binary())]
                yield pa.record_batch([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["v", "s"])

    texts = only_ids(id_and_text(docs), ["doc_id"], materialize(ids, "ids", files)).select("doc_id", "text")
    full = materialize(texts.mapInArrow(run, "v long, s array<long>"), "sets")
    both = spread_join(pairs, full.select(F.col("v").alias("a"), F.col("s").alias("sa")), "a")
    both = both.join(full.select(F.col("v").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets; component_id is the least
    doc_id that links reach, kept says that it is the row's own. Rows without words, null texts among them, are linked with
    nothing. Rows that share a doc_id are one vertex. Rows without a doc_id take no part: their component_id is null and
    they are kept. An empty table gives an empty result. All pairs that share a band are decided; a pair at the threshold
    shares none once in 10**7."""
    sig = materialize(signatures(docs, width), "signatures")
    worded = sig.where(F.col("n_shingles") > 0).where(F.col("doc_id").isNotNull())
    bits = ["n_shingles", "w0", "w1", "w2", "w3"]
    sets = materialize(worded.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("doc_id", "bands", *bits), "doc_id").alias("of")), "sets")
    reps = sets.select(F.col("of.doc_id").alias("rep"), *[F.col(f"of.{c}").alias(c) for c in ("bands", *bits)])
    sets = sets.select("lo", "hi", "n", F.col("of.doc_id").alias("rep"))
    rows = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(F.min("rep").alias("c0"), F.max("rep").alias("c1"), F.count(F.lit(1)).alias("m")).where(F.col("c0") < F.col("c1"))
    shared = materialize(shared.select("bucket", "m"), "shared", files_for(sets.count()))
    files = files_for(shared.agg(F.sum("m").alias("m")).first().m or 0)  # of tables with a row for each member of a bucket
    crowds = shared.select("bucket", F.col("m").alias("n"))
    members = materialize(spread_join(rows, shared, "bucket", counts=crowds).select("bucket", "band", "rep", "m"), "members", files)
    central = materialize(members.groupBy("rep").agg(F.sum("m").alias("score")), "central", files)
    sketch = reps.select("rep", F.struct(*bits).alias("s"))
    members = materialize(members.join(central, "rep").select("bucket", "band", "rep", "score"), "scored", files)

    def linked(pivots: DataFrame, others: DataFrame) -> DataFrame:
        """Links between the pivot of each bucket and other members of it, confirmed."""
        pairs = spread_join(others, pivots, "bucket", counts=crowds).where(F.col("rep") != F.col("pivot")).select("pivot", "rep").distinct()
        near = spread_join(pairs, sketch.select(F.col("rep").alias("pivot"), F.col("s").alias("x")), "pivot").join(sketch.select("rep", F.col("s").alias("y")), "rep")
        return _confirmed(near.where(_may_link("x", "y", percent)).select(F.col("pivot").alias("a"), F.col("rep").alias("b")), docs, width, percent, files)

    most = F.struct("score", -F.col("rep"))
    links = materialize(linked(members.groupBy("bucket").agg(F.max_by("rep", most).alias("pivot")), members.select("bucket", "rep")), "links", files)
    for turn in range(ROUNDS + 1):
        found = components(links)
        placed = materialize(members.join(found, F.col("rep") == F.col("v"), "left").select("bucket", "band", "rep", "score", F.coalesce("component", "rep").alias("component")), "placed", files)
        sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
        open_ = materialize(sizes.groupBy("bucket").agg(F.sum("k").alias("m"), ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs")).where(F.col("pairs") > 0), "open", files)
        left = open_.agg(F.sum("pairs").alias("pairs"), F.sum("m").alias("m")).first()
        if not left.pairs:
            break
        unsettled = placed.join(open_.select("bucket"), "bucket")
        if left.pairs > PAIRS_EACH * left.m and turn < ROUNDS:
            chief = unsettled.groupBy("bucket").agg(F.max_by("component", most).alias("chief"))
            outside = unsettled.join(chief, "bucket").where(F.col("component") != F.col("chief"))
            pivots = outside.groupBy("bucket").agg(F.max_by(F.struct("rep", "component"), F.xxhash64("rep", F.lit(turn))).alias("p")).select("bucket", F.col("p.rep").alias("pivot"), F.col("p.component").alias("of"))
            others = unsettled.join(pivots.select("bucket", "of"), "bucket").where(F.col("component") != F.col("of")).select("bucket", "rep")
            more, last = linked(pivots.select("bucket", "pivot"), others), False
        else:
            ids = materialize(unsettled.select(F.col("rep").alias("doc_id")).distinct(), "ids", files)
            longer = materialize(_long_signatures(docs, ids, width).dropDuplicates(["rep"]), "longer")
            full = unsettled.select("bucket", "band", "rep", "component").join(longer, "rep").join(reps.select("rep", "bands").dropDuplicates(["rep"]), "rep")
            side = F.struct("band", "rep", "component", "bands", "n_shingles", *[c for c in longer.columns if c.startswith("w")])
            earlier = F.arrays_overlap(F.slice("x.bands", 1, F.col("x.band")), F.slice("y.bands", 1, F.col("x.band")))
            first = F.when(F.col("x.band") == 0, F.lit(True)).otherwise(~earlier)
            between = (F.col("x.component") < F.col("y.component")) & _may_link("x", "y", percent, LONG) & first
            pairs = spread_join(full.select("bucket", side.alias("x")), full.select("bucket", side.alias("y")), "bucket", counts=crowds).where(between)
            more, last = _confirmed(pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")), docs, width, percent, files), True
        more = materialize(more, "more", files)
        if more.limit(1).count():
            links = materialize(links.unionByName(more).distinct(), "links", files)
            if last:
                found = components(links)
        if last:
            break
    of_set = sets.join(found, F.col("rep") == F.col("v"), "left").select(F.struct("lo", "hi").alias("set"), "n", F.coalesce("component", "rep").alias("component_id"))
    of_set = materialize(of_set, "of-set")
    own = sig.select("doc_id", "n_shingles", F.when(F.col("lo").isNotNull(), F.struct("lo", "hi")).alias("set"))
    none = own.where(F.col("set").isNull()).withColumn("component_id", F.lit(None).cast("long"))
    out = spread_join(own.where(F.col("set").isNotNull()), of_set.drop("n"), "set", "left", counts=of_set.select("set", "n")).unionByName(none)
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).cast("long")
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that near_duplicates() keeps, of equal rows one; rows without a doc_id stay."""
    found = near_duplicates(docs, width, percent).where(F.col("doc_id").isNotNull())
    own = unused(docs, "own_id")
    found = materialize(found.groupBy(F.col("doc_id").alias(own)).agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "kept")
    # The ids of rows that go, and of those that may be repeated, are far fewer than all; texts stay where they are.
    out = only_ids(docs.withColumn(own, F.col("doc_id").cast("long")), [own], found.where(~F.col("kept")).select(own), "left_anti")
    several = found.where(F.col("kept") & (F.col("n") > 1)).select(own)
    if several.limit(1).count():
        once = only_ids(out, [own], several).dropDuplicates([own, "text"])
        out = only_ids(out, [own], several, "left_anti").unionByName(once)
    return out.select(*docs.columns)
