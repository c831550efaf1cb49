"""Pack token pieces into fixed-length sequences by minimum bin slack.

Which lengths go together depends only on how many pieces there are of each length, so the plan is made on the
histogram (at most `capacity` rows, whatever the table's size): the longest length left opens a bin, a subset-sum
over the other lengths, kept as one bitset, finds the fullest combination that fits, and that combination is removed
as often as the counts allow.  Spark then numbers the pieces of each length and looks up their bin and place.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import finish, raw, settle
from millrace.llm.word_bpe import default_path, word_ids

CAPACITY = 4096
END_ID = 1
SLOT_ROWS = 50_000


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of lengths whose sum is the greatest that fits `capacity`."""
    full, reach, steps = 1 << capacity, 1, []
    mask = (full << 1) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length) if length <= capacity else 0
        times = 1
        while left > 0:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach & full:
            break
    at, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + times
            at -= length * times
    return used


@dataclass
class Plan:
    """For each length the ranges of piece ranks: first rank, first bin, offset in the bin."""

    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    bins: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Minimum bin slack on a histogram of lengths between 1 and `capacity`."""
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    slots: dict[int, list[tuple[int, int, int]]] = {n: [] for n in left}
    bins = 0
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        use = fullest({n: c for n, c in others.items() if c}, capacity - longest)
        use[longest] = use.get(longest, 0) + 1
        times = min(left[n] // k for n, k in use.items())
        offset = 0
        for n in sorted(use, reverse=True):
            for _ in range(use[n]):
                slots[n].append((taken[n], bins, offset))
                taken[n] += times
                offset += n
            left[n] -= use[n] * times
            if not left[n]:
                del left[n]
        bins += times
    return Plan({n: tuple(np.array(s, np.int64).T) for n, s in slots.items()}, bins)


def token_pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """Tokenise whole texts, end each with `end_id`, and cut those over `capacity` ids into pieces:
    doc_id, piece, start, length, ids_crc32 (and `ids`, little-endian 32-bit, if asked for)."""
    path = path or default_path()

    def run(batches):
        words = word_ids(path)
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            out = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch.column("text")), strict=True):
                data = words.text_ids(text or b"") + end
                for piece, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    for name, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if ids else b"")):
                        out[name].append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(out[n], t) for n, t in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays if ids else arrays[:-1], names=list(out) if ids else list(out)[:-1])

    shape = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, shape)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces (`length` from 1 to `capacity`).

    Pieces of one length are interchangeable; they are numbered by slots of a hash, so a length that very many pieces
    share is not one task.  Repeated rows are pieces of their own.  `pieces` is read several times: store it first.
    """
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    made = plan(histogram, capacity)  # the histogram has at most `capacity` rows
    spark = pieces.sparkSession
    slots = spark.createDataFrame(
        [(n, -(-c // SLOT_ROWS)) for n, c in histogram.items()], "length long, _slots long"
    )
    slot = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_slots"))
    rows = pieces.join(F.broadcast(slots), "length").withColumn("_slot", slot).drop("_slots")
    counts = rows.groupBy("length", "_slot").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_slot").orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(counts, ["length", "_slot"])
    rows = rows.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_slot", "_before")
    shared = spark.sparkContext.broadcast(made.slots)

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                firsts, bins, offsets = shared.value[int(n)]
                mine = np.flatnonzero(length == n)
                at = np.searchsorted(firsts, rank[mine], "right") - 1
                sequence[mine] = bins[at] + rank[mine] - firsts[at]
                offset[mine] = offsets[at]
            keep = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(sequence), pa.array(offset)],
                names=[*keep, "sequence_id", "offset"],
            )

    keep = [f for f in rows.schema.fields if f.name != "_rank"]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(run, f"{shape}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    A null or empty text is its end id alone.  Null ids are kept as they are.  An empty table packs into nothing.
    """
    settle(docs.sparkSession)
    pieces = finish(token_pieces(docs, path, capacity, end_id, ids), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else []), "sequence_id", "offset"]
    return place(pieces, capacity).select(*names)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from `pack(..., ids=True)`: sequence_id, ids (little-endian 32-bit)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, part: F.concat(all_, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
