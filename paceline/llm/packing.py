"""Best-fit packing of tokenised documents into sequences of fixed length, hierarchically.

Documents are encoded once; what travels after that is a row of a few integers for each piece. Partitions of a bounded
number of pieces are packed best-fit decreasing on their own. Bins that are full, or that nothing left over can enter, are
emitted; the other bins go up a tree, a few partitions to a node, and are items of the next best-fit round there. Best fit
leaves at most one bin of a partition half empty, so few bins go up, and the number going up is bounded by the number of
partitions below, whatever the data: a node keeps as many hosts as there are guests.

Documents that stand in an order to be kept (a mix of sources) are packed best-fit decreasing in windows of consecutive
places. Of two neighbouring windows one sequence may hold pieces of both: the earlier one's last documents, then any of the
later one's that fill it. Which documents these are is chosen for all windows together, for the fewest sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.common import BROADCAST_IDS, file_number, id_and_text, materialize, of_files
from paceline.llm.tokens import encoder

#: Pieces that one task packs, and nodes of the tree that meet in one node above.
LOCAL_ITEMS, FAN_IN = 200_000, 8
#: Times the usual limits of the tokenizer's memos, where tokens are all that a worker is asked for: some 400 MB at most.
MEMORY = 3
#: Documents of consecutive places whose pieces share sequences, where an order is kept.
WINDOW = 4096
#: Last pieces of a window that may stand in a sequence with the next window's; the number of that sequence in its window.
LAST, SHARED = 32, (1 << 32) - 1


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, place: str | None = None, memory: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for each piece of each row's ids plus end_id, and the row's `place` (a column
    of docs), if asked for. memory: see encoder.

    Only documents of more than `length` ids are cut: full pieces, but for the first, which takes the remainder. Null texts
    are empty ones: one piece of one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, memory)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                rows = []
                own = zip(*[c.to_pylist() for c in part.columns[2:]], strict=True) if place else [()] * len(part)
                for doc_id, x, at_place in zip(part.column(0).to_pylist(), encode.encode(part.column(1).to_pylist()), own, strict=True):
                    x = memoryview(x + end)
                    n = len(x) // 4
                    at = k = 0
                    while at < n:
                        size = (n - at) % length or min(length, n - at)
                        rows.append((doc_id, k, at, size, zlib.crc32(x[4 * at : 4 * (at + size)]), *at_place))
                        at, k = at + size, k + 1
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", *["place"] * bool(place)])

    rows = id_and_text(docs) if place is None else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col(place).cast("long").alias("place"))
    return rows.mapInArrow(run, "doc_id long, piece long, start long, length long, ids_crc32 long" + ", place long" * bool(place))


def best_fit(sizes: np.ndarray, length: int, room: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit packing of items in the order given: bin and offset of each item, and the fill of each bin. room: what is left
    in a bin that is there already, bin 0; without, there is no such bin.

    An item goes to the bin with the least room that still holds it. Open bins stand in stacks by room; the rooms in use
    are kept sorted, so an item costs a search over at most `length` numbers."""
    bins, offsets, fill = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    stacks: dict[int, list[int]] = {}
    rooms: list[int] = []
    if room:
        fill, stacks, rooms = [length - room], {room: [0]}, [room]
    for i, size in enumerate(sizes.tolist()):
        k = bisect_left(rooms, size)
        if k < len(rooms):
            room = rooms[k]
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                del stacks[room], rooms[k]
        else:
            b, room = len(fill), length
            fill.append(0)
        bins[i], offsets[i] = b, length - room
        fill[b] += size
        if room := room - size:
            if room not in stacks:
                stacks[room] = []
                insort(rooms, room)
            stacks[room].append(b)
    return bins, offsets, np.array(fill, np.int64)


def pack(items: DataFrame, length: int, local_items: int = LOCAL_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """items with sequence_id and offset: `length` is the column with an item's size, 1 to `length`. No row goes.

    Items that share all columns are told apart by nothing and may change places. An empty table stays empty."""
    columns, names = items.columns, [f.name for f in items.schema.fields]
    total = items.where(F.col("length") < length).count()
    nodes = max(1, -(-total // local_items))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields) + ", bin long, at long, fill long"

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        node = TaskContext.get().partitionId()
        kept = list(batches)
        if not kept or not sum(map(len, kept)):
            return
        rows = pd.concat(kept, ignore_index=True)
        order = ["length", *[n for n in names if n != "length"]]
        rows = rows.sort_values(order, ascending=[False] + [True] * (len(order) - 1), ignore_index=True)
        bins, at, fill = best_fit(rows["length"].to_numpy(), length)
        yield rows.assign(bin=(node << 32) + bins, at=at, fill=fill[bins])

    # Full pieces are bins of their own; a number that no node gives out comes from the piece's place in its partition.
    full = items.where(F.col("length") >= length).select(*columns, (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("bin"), F.lit(0).cast("long").alias("at"), F.col("length").cast("long").alias("fill"))
    dealt = items.where(F.col("length") < length).repartition(nodes, *[F.col(n) for n in names])
    packed = materialize(dealt.mapInPandas(local, schema).unionByName(full), "packed")
    nodes = (packed.where(F.col("length") < length).agg(F.max(F.shiftright("bin", 32)).alias("n")).first().n or 0) + 1
    if nodes == 1:
        return packed.select(*columns, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))

    # What went into which bin of a later round: child, bin, at. Only bins that may be joined go up.
    half = length // 2
    level = packed.where(F.col("fill") < length).groupBy("bin").agg(F.first("fill").alias("fill"))
    guests = level.where(F.col("fill") <= half)
    most = guests.count()  # at most one for each node
    least = guests.agg(F.min("fill").alias("m")).first().m or length
    hosts = level.where((F.col("fill") > half) & (F.col("fill") <= length - least))
    near = F.row_number().over(_by_node_and_fill())
    hosts = hosts.withColumn("node", F.shiftright("bin", 32)).withColumn("near", near).where(F.col("near") <= most).select("bin", "fill")
    moving = guests.unionByName(hosts).withColumn("node", F.shiftright("bin", 32))
    moves = None
    while True:
        nodes = -(-nodes // fan_in)

        def node_round(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["fill", "bin"], ascending=[False, True], ignore_index=True)
            bins, at, fill = best_fit(rows["fill"].to_numpy(), length)
            host = rows.groupby(bins)["bin"].transform("first").to_numpy()
            return pd.DataFrame({"bin": rows["bin"], "host": host, "at": at, "fill": fill[bins], "node": rows["node"]})

        done = materialize(moving.withColumn("node", F.expr(f"node div {fan_in}")).groupBy("node").applyInPandas(node_round, "bin long, host long, at long, fill long, node long"), "round")
        step = done.select("bin", "host", "at")
        if moves is None:
            moves = step
        else:
            moves = moves.alias("m").join(step.alias("s"), F.col("m.host") == F.col("s.bin"), "left").select("m.bin", F.coalesce("s.host", "m.host").alias("host"), (F.col("m.at") + F.coalesce("s.at", F.lit(0))).alias("at"))
        if nodes == 1:
            break
        moving = done.where(F.col("bin") == F.col("host")).where(F.col("fill") < length).select("bin", "fill", "node")
    moves = materialize(moves.where(F.col("bin") != F.col("host")), "moves")
    return packed.alias("p").join(moves.alias("m"), F.col("p.bin") == F.col("m.bin"), "left").select(*[F.col(f"p.{c}") for c in columns], F.coalesce("m.host", "p.bin").alias("sequence_id"), (F.col("p.at") + F.coalesce("m.at", F.lit(0))).alias("offset"))


def _by_node_and_fill():
    return Window.partitionBy(F.shiftright("bin", 32), "fill").orderBy("bin")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 1024, local_items: int = LOCAL_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document."""
    cut = materialize(pieces(docs, tokenizer, end_id, length, memory=MEMORY), "pieces")
    packed = pack(cut, length, local_items, fan_in)
    return packed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text and __place: the number of the row, from 0, in the order in which docs was written. What is not a table
    of files is written first; the partitions' files then stand in the order of the partitions."""
    if not of_files(docs):
        docs = materialize(docs.select("doc_id", "text"), "ordered")
    of = docs.metadataColumn("_metadata")
    rows = docs.select("doc_id", "text", of["file_path"].alias("__file"), of["row_index"].alias("__row"))
    earlier = Window.orderBy(file_number(F.col("__file")), "__file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    return rows.join(F.broadcast(files.select("__file", "__before")), "__file").select("doc_id", "text", (F.col("__before") + F.col("__row")).alias("__place"))


def best_fit_but_last(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As best_fit, decreasing, of items given in an order to be kept, with the room in the bin of the last items, if the others
    fill the fewest bins without them."""
    order = np.argsort(-sizes, kind="stable")
    total, last = int(sizes.sum()), np.cumsum(sizes[::-1])
    bins, at = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for spare in (0, length // 64, length // 8):
        k = int(np.searchsorted(last, total % length + spare)) + 1
        if total % length and k < len(sizes) and last[k - 1] <= length:
            rest = order[order < len(sizes) - k]
            found, offsets, fill = best_fit(sizes[rest], length)
            if len(fill) == total // length:
                bins[rest], at[rest] = found, offsets
                bins[-k:], at[-k:] = len(fill), np.cumsum(sizes[-k:]) - sizes[-k:]
                return bins, at, np.append(fill, last[k - 1])
    bins[order], at[order], fill = best_fit(sizes[order], length)
    return bins, at, fill


def shared_sequences(totals: list[int], lasts: list[list[int]], length: int) -> tuple[list[int], list[int]]:
    """For each window, in order, how many of its last pieces stand in the sequence shared with the next window, and the room
    that it uses in the one shared with the window before (0: none), so that all sequences are as few as sizes alone allow.

    totals: sum of a window's sizes; lasts: its last sizes, from the end. A sequence holds pieces of two windows at most. Of
    equally good choices it is the one with the fewest windows that have under length // 64 to spare."""
    tails = [np.array([0, *(x for x in np.cumsum(last[:LAST]).tolist() if x <= length)], np.int64) for last in lasts]
    cost, room, back = np.zeros(1, np.int64), np.zeros(1, np.int64), []
    for total, tail in zip(totals, tails, strict=True):
        rest = total - tail[None, :]
        own = -(-np.maximum(rest - room[:, None], 0) // length)
        tight = (own * length + room[:, None] - rest < length // 64) & (rest > 0)
        each = cost[:, None] + (own + (tail > 0)[None, :] << 32) + tight
        back.append(each.argmin(0).astype(np.int8))
        cost, room = each.min(0), np.where(tail > 0, length - tail, 0)
    counts, rooms, k = [0] * len(tails), [0] * len(tails), int(cost.argmin())
    for w in range(len(tails) - 1, -1, -1):
        counts[w], rest = k, totals[w] - int(tails[w][k])
        k = int(back[w][k])
        left = length - int(tails[w - 1][k]) if k else 0
        rooms[w] = left if -(-max(rest - left, 0) // length) < -(-rest // length) else 0
    return counts, rooms


def pack_in_order(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 1024, window: int = WINDOW) -> DataFrame:
    """As pack_documents, but a sequence holds pieces of one window of `window` consecutive rows in the order in which docs was
    written, or of two neighbours, and sequence_id rises with the windows and, within one, with the first row of a sequence.

    Two neighbours share one sequence at most, the last of the earlier window: it begins with that window's last pieces, and
    what it has room for comes from the next window, whichever pieces fit best. shared_sequences chooses these from a row of at
    most LAST + 1 numbers for each window, on the driver. The pieces of a document of several stand with its first, shorter one
    last, as that one leaves room."""
    by_row = [("place", "ascending"), ("piece", "descending")]

    def look(rows: pa.Table) -> pa.Table:
        sizes = rows.sort_by(by_row)["length"].to_numpy()
        return pa.table({"window": [rows["place"][0].as_py() // window], "total": [int(sizes.sum())], "last": pa.array([sizes[: -LAST - 1 : -1].tolist()], pa.list_(pa.int64()))})

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(by_row)
        sizes, here = rows["length"].to_numpy(), rows["window"][0].as_py()
        last, room = rows["last"][0].as_py(), rows["room"][0].as_py()
        own = len(sizes) - last
        order = np.argsort(-sizes[:own], kind="stable")
        bins, at = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        bins[order], at[order], fill = best_fit(sizes[order], length, room)
        bins[own:], at[own:] = len(fill), np.cumsum(sizes[own:]) - sizes[own:]
        first = np.full(len(fill) + 1, len(sizes), np.int64)
        np.minimum.at(first, bins, np.arange(len(sizes)))
        number = np.empty(len(first), np.int64)
        number[np.argsort(first, kind="stable")] = np.arange(len(first))
        number += here << 32
        number[-1] = (here << 32) + SHARED
        if room:
            number[0] = (here - 1 << 32) + SHARED
        out = rows.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, x in (("sequence_id", number[bins]), ("offset", at)):
            out = out.append_column(name, pa.array(x, pa.int64()))
        return out

    cut = materialize(pieces(placed(docs), tokenizer, end_id, length, "__place"), "pieces").withColumn("window", F.expr(f"place div {window}"))
    rows = cut.select("place", "piece", "length", "window").groupBy("window").applyInArrow(look, "window long, total long, last array<long>").collect()
    rows.sort(key=lambda r: r.window)
    plan = list(zip([r.window for r in rows], *shared_sequences([r.total for r in rows], [r.last for r in rows], length), strict=True))
    chosen = docs.sparkSession.createDataFrame(plan, "window long, last long, room long")
    chosen = F.broadcast(chosen) if len(plan) <= BROADCAST_IDS else chosen
    schema = "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return cut.join(chosen, "window").groupBy("window").applyInArrow(run, schema).withColumn("piece", F.col("piece").cast("int"))
