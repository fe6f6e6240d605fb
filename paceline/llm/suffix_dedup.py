"""Removal of long repeated byte strings over a whole corpus, by external suffix sorting of shards.

Which strings of `length` bytes start at two places anywhere? A corpus is too large for one suffix array, so places that
may match are dealt to the same shard first, losing none:

1. Each window of `length` bytes picks an anchor: the one of its 64-byte grams with the least hash. Equal windows pick the
   same gram at the same distance. Neighbouring windows with the same anchor are one row: the anchor's hash, where its
   windows start, and a digest of all the bytes they cover. (Rows of equal digests that follow one another, as in periodic
   text, are one row with a count.) Anchors that occur once match nothing and go.
2. Rows of an anchor with equal digests are a class; two of them stand for it. Their bytes are dealt into shards by anchor,
   or, where an anchor has one class alone, by the two texts, so that long common parts are one string. Anchors with very many classes are split by the distance from window to anchor, which is equal for equal windows, and
   beyond that by the windows' hashes.
3. In each shard induced sorting with disk-backed queues (see induced.py) tells which windows start elsewhere, too. What it
   finds for the two rows of a class is handed on to the others.

Windows found are joined by document, and a last pass removes the bytes they cover.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import id_and_text, materialize, only_ids, spread_join
from paceline.llm.induced import Shard

#: Bytes of a gram; windows of a document that are worked on at once; bytes that a shard aims at; classes of an anchor that
#: are dealt together; memory allowance of a shard's sort (its queues and arrays take a sixteenth each, the rest is on disk);
#: digests of a shard's strings that are held to know third copies by.
GRAM, SEGMENT, SHARD, TOGETHER, MEMORY, COPIES = 64, 1 << 19, 1_000_000, 4096, 1 << 26, 200_000

_rng = np.random.default_rng(31)
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = np.uint64(22)
_NO_ID = -(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes (a power of two) from each place on."""
    h, n, factor = _TABLE[data], 1, _BASE
    while n < size:
        h = h[:-n] * np.uint64(factor) + h[n:]
        factor = factor * factor % (1 << 64)
        n *= 2
    return _mixed(h)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    return np.minimum(values[: len(values) - (width - n)], values[width - n :]) if width > n else values


def gram_of(length: int) -> int:
    """The largest power of two up to GRAM that leaves a window several grams to choose from."""
    size = GRAM
    while size > 1 and size * 4 > length:
        size //= 2
    return size


def anchored(texts: list[bytes], length: int) -> list[tuple[int, int, int, int, int, int, int, int, int]]:
    """(number of the text, anchor, digest, digest, first start, starts in a row, starts covered, rows, distance) for each
    group of neighbouring windows of one anchor; distance: from the first start to the anchor."""
    gram = gram_of(length)
    out: list[tuple] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def work() -> None:
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        hashes = _grams(data, gram)
        keys = hashes >> _PLACE_BITS << _PLACE_BITS | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_least(keys, length - gram + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        view, at = memoryview(data), 0
        for number, base, x in held:
            here = anchor[at : at + len(x) - length + 1]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(here)) + 1, [len(here)]])
            named = hashes[here[cuts[:-1]]].view(np.int64).tolist()
            far = (here[cuts[:-1]] - at - cuts[:-1]).tolist()
            last = None
            for lo, hi, g, d in zip(cuts[:-1].tolist(), cuts[1:].tolist(), named, far, strict=True):
                digest = xxhash.xxh3_128_digest(view[at + lo : at + hi + length - 1])
                if last is not None and last[1] == g and last[2] == digest and last[8] == d:
                    last[5] += hi - lo
                    last[6] += 1
                    continue
                last = [number, g, digest, base + lo, hi - lo, hi - lo, 1, 0, d]
                out.append(last)
            at += len(x)
        held.clear()

    for number, text in enumerate(texts):
        for base in range(0, max(0, len(text) - length + 1), SEGMENT):
            part = text[base : base + SEGMENT + length - 1]
            if size + len(part) > (1 << 20) and held:
                work()
                size = 0
            held.append((number, base, part))
            size += len(part)
    if held:
        work()
    return [(x[0], x[1], *np.frombuffer(x[2], "<i8").tolist(), x[3], x[4], x[5], x[6], x[8]) for x in out]


def _keyed(docs: DataFrame) -> DataFrame:
    """did (null ids: the least number), dig (a hash of the text), text: rows equal in both count as equal."""
    rows = id_and_text(docs)
    return rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("did"), F.xxhash64("text").alias("dig"), "text", "doc_id")


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    names = ["did", "dig", "g", "c0", "c1", "lo", "span", "total", "n", "far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 400):
                part = batch.slice(at, 400)
                found = anchored([x.as_py() for x in part.column(2).cast(pa.binary())], length)
                if found:
                    which, *rest = (np.array(x, np.int64) for x in zip(*found, strict=True))
                    keys = [part.column(k).to_numpy(zero_copy_only=False)[which] for k in (0, 1)]
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in (*keys, *rest)], names)

    return rows.where(F.octet_length("text") >= length).select("did", "dig", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


_CLASS = ["c0", "c1", "span", "far"]
_FOUND = "did long, dig long, s long, e long, c0 long, c1 long, span long, far long, w long"


def _from_shards(bytes_of: DataFrame, length: int, memory: int) -> DataFrame:
    """did, dig, s, e: the bytes that repeated windows of a shard cover; and c0, c1, span, far, w: how many windows are
    repeated of the rows that stand for a class, for rows dealt by shard. Of equal strings the first two are sorted, and what
    holds for them holds for the others."""
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[bytes, list[int]] = {}  # digest to the number of the first text, and how many there are; bounded
        rows, of_text = [], []
        with Shard(length, memory) as shard:
            for batch in batches:
                for did, dig, lo, text, of in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                    digest = xxhash.xxh3_128_digest(text)
                    if len(copies) > COPIES:
                        copies.clear()
                    seen = copies.setdefault(digest, [len(shard.sizes), 0])
                    seen[1] += 1
                    of_text.append(shard.add(text) if seen[1] <= 2 else seen[0])
                    rows.append((did, dig, lo, of))
            found = list(shard.repeated())
        out: list[tuple] = []
        for (did, dig, lo, of), number in zip(rows, of_text, strict=True):
            starts = found[number]
            for c in of:
                w = np.searchsorted(starts, [c["at"] - lo, c["at"] - lo + c["windows"]])
                out.append((None, None, None, None, c["c0"], c["c1"], c["span"], c["far"], int(w[1] - w[0])))
            if len(starts):
                cuts = np.flatnonzero(np.diff(starts) > 1)
                for first, last in zip(starts[np.append(0, cuts + 1)].tolist(), starts[np.append(cuts, len(starts) - 1)].tolist(), strict=True):
                    out.append((did, dig, lo + first, lo + last + length, None, None, None, None, None))
            if len(out) > 20_000:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names)
                out = []
        if out:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names)

    return bytes_of.mapInArrow(run, _FOUND)


def repeated_spans(docs: DataFrame, length: int = 400, shard: int = SHARD, together: int = TOGETHER, memory: int = MEMORY) -> DataFrame:
    """did, dig, spans array<struct<s,e>>: for each text with repeated bytes the byte ranges, not yet merged."""
    rows = _keyed(docs)
    anchors = materialize(_anchors(rows, length), "anchors")
    often = anchors.groupBy("g").agg(F.sum("n").alias("m")).where(F.col("m") > 1).select("g", F.col("m").alias("n"))
    some = materialize(spread_join(anchors, often.select("g"), "g", counts=often), "repeated")

    # A class: rows of equal digests. Two of them (of one row that repeats itself, its first two) stand for it.
    row = F.struct("did", "dig", "lo", "n")
    classes = some.groupBy("g", *_CLASS).agg(F.sum("n").alias("m"), F.min(row).alias("one"), F.max(row).alias("two"))
    classes = materialize(classes, "classes")
    k = classes.groupBy("g").agg(F.count(F.lit(1)).alias("k"))
    next_ = F.struct(F.col("one.did").alias("did"), F.col("one.dig").alias("dig"), (F.col("one.lo") + F.col("span")).alias("lo"))
    place = lambda c: F.struct(*[F.col(f"{c}.{x}").alias(x) for x in ("did", "dig", "lo")])
    second = F.when(F.col("one") != F.col("two"), place("two")).when(F.col("one.n") > 1, next_)
    # Where an anchor has one class, only its two rows meet: they may go to any shard, so neighbours in the same two texts go
    # together, and their bytes, which overlap, are one string.
    pair = F.when(F.col("k") == 1, F.xxhash64("one.did", "one.dig", second["did"], second["dig"]))
    ones = spread_join(classes, k, "g", counts=k.select("g", F.col("k").alias("n")))
    ones = ones.withColumn("pair", pair).select("g", *_CLASS, "k", "m", "pair", F.posexplode(F.array(place("one"), second)).alias("which", "at")).where(F.col("at").isNotNull())
    tagged = (F.col("which") == 0) & (F.col("m") > 2)
    ones = ones.select("g", "k", *_CLASS, "at.did", "at.dig", "at.lo", "pair", tagged.alias("tagged"))
    # Windows of a row by their distance to the anchor, far - j for the j-th; anchors with many digests by parts of that.
    ones = ones.withColumn("parts", F.least(F.lit(length - gram_of(length) + 1), F.ceil(F.col("k") / together)).cast("int"))
    ones = ones.withColumn("width", F.ceil(F.lit(length - gram_of(length) + 1) / F.col("parts")).cast("long"))
    first, last = F.col("far") - F.col("span") + 1, F.col("far")
    ones = ones.withColumn("split", F.when(F.col("width") == 1, F.ceil(F.col("k") / together)).otherwise(1).cast("int"))
    ones = ones.withColumn("part", F.explode(F.sequence(F.floor(first / F.col("width")), F.floor(last / F.col("width")))))
    near, far = F.greatest(first, F.col("part") * F.col("width")), F.least(last, (F.col("part") + 1) * F.col("width") - 1)
    ones = ones.withColumns({"b": F.col("lo") + F.col("far") - far, "z": F.col("lo") + F.col("far") - near + length})
    ones = materialize(ones.select("did", "dig", "g", "part", "split", "pair", "b", "z", "tagged", *_CLASS), "windows")
    total = ones.agg(F.sum(F.col("z") - F.col("b") - F.when(F.col("pair").isNull(), 0).otherwise(length - 1)).alias("n")).first().n or 0
    shards = max(1, -(-int(total) // shard))
    goes_to = F.pmod(F.coalesce("pair", F.xxhash64("g", "part")), F.lit(shards)).alias("shard")
    places = ones.groupBy("did", "dig").agg(F.collect_list(F.struct(goes_to, "split", "pair", "b", "z", "tagged", *_CLASS)).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for did, dig, text, places in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                text = text.encode()
                for lo, hi, p, of in _strings(places, length):
                    window = text[lo:hi]
                    by_hash = xxhash.xxh3_64_intdigest(window) % p["split"] if p["split"] > 1 else 0
                    out.append((did, dig, lo, window, of, (p["shard"] + by_hash) % shards))
                if len(out) > 10_000:
                    yield _cut_batch(out)
                    out = []
            if out:
                yield _cut_batch(out)

    wanted = materialize(places, "places")
    texts = only_ids(rows, ["did", "dig"], wanted.select("did", "dig")).select("did", "dig", "text").dropDuplicates(["did", "dig"])
    bytes_of = texts.join(wanted, ["did", "dig"]).select("did", "dig", "text", "places").mapInArrow(cut, _CUT)
    dealt = bytes_of.repartitionById(shards, F.col("shard").cast("int")).drop("shard")
    found = materialize(_from_shards(dealt, length, memory), "found")

    # A class whose windows are all found repeated hands that on to its other rows.
    windows = found.where(F.col("c0").isNotNull()).groupBy(F.struct(*_CLASS).alias("class")).agg(F.sum("w").alias("w"))
    confirmed = windows.where(F.col("w") == F.col("class.span")).select("class")
    crowds = classes.where(F.col("m") > 2).select(F.struct(*_CLASS).alias("class"), F.col("m").alias("n"))
    others = spread_join(some.select(F.struct(*_CLASS).alias("class"), "did", "dig", "lo", "total"), confirmed, "class", counts=crowds)
    others = others.select("did", "dig", F.col("lo").alias("s"), (F.col("lo") + F.col("total") + length - 1).alias("e"))
    spans = found.where(F.col("s").isNotNull()).select("did", "dig", "s", "e").unionByName(others)
    return materialize(spans.groupBy("did", "dig").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")


_OF = pa.list_(pa.struct([(n, pa.int64()) for n in (*_CLASS, "at", "windows")]))
_CUT = "did long, dig long, b long, bytes binary, of array<struct<c0:long,c1:long,span:long,far:long,at:long,windows:long>>, shard long"


def _strings(places: list[dict], length: int) -> Iterator[tuple[int, int, dict, list[dict]]]:
    """The strings to be cut of a text: first byte, end, a place that it is dealt by, and the classes that it stands for.
    Places of one pair of texts whose windows follow one another are one string."""
    run: list[dict] = []
    for p in sorted(places, key=lambda p: (p["pair"] is not None, p["pair"] or 0, p["b"])):
        if run and (p["pair"] is None or p["pair"] != run[0]["pair"] or p["b"] > end - length + 1):
            yield run[0]["b"], end, run[0], _tags(run, length)
            run = []
        end = max(end, p["z"]) if run else p["z"]
        run.append(p)
    if run:
        yield run[0]["b"], end, run[0], _tags(run, length)


def _tags(run: list[dict], length: int) -> list[dict]:
    return [{c: p[c] for c in _CLASS} | {"at": p["b"], "windows": p["z"] - p["b"] - length + 1} for p in run if p["tagged"]]


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), _OF, pa.int64()]
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["did", "dig", "b", "bytes", "of", "shard"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, length: int = 400, **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats (whether bytes are removed) for each row of docs.

    Every byte covered by a string of `length` bytes that also starts anywhere else (another place of the same text, or
    another row) is removed; strings are judged on the input. Texts shorter than `length` keep all; null texts are empty
    ones; equal rows are copies of one another, so all their long texts go; rows without a doc_id take part; an empty table
    gives an empty result."""
    spans = repeated_spans(docs, length, **sizes)
    rows = _keyed(docs)
    found = spans.select("did", "dig")
    clean = only_ids(rows, ["did", "dig"], found, "left_anti")
    clean = clean.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = defaultdict(list)
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, at, gone = hashlib.sha256(), 0, merged([(x["s"], x["e"]) for x in spans])
                for s, e in gone:
                    kept.update(text[at:s])
                    at = e
                kept.update(text[at:])
                for n, x in zip(names, (doc_id, len(text), sum(e - s for s, e in gone), len(gone), kept.hexdigest()), strict=True):
                    out[n].append(x)
            if out:
                yield pa.record_batch([pa.array(out[n], pa.string() if n == "kept_sha256" else pa.int64()) for n in names], names)

    dirty = only_ids(rows, ["did", "dig"], found).join(spans, ["did", "dig"]).select("doc_id", "text", "spans")
    out = clean.unionByName(dirty.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    return out.withColumn("has_repeats", F.col("n_removed") > 0)
