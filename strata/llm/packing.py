"""Packing of documents into sequences: dominance reduction, then best fit.

Piece lengths are whole numbers up to the capacity, so a packing instance is a
table of counts by length: at most ``capacity`` rows, however many documents
there are.  Only that table reaches the driver.  There Martello and Toth's
reduction fixes the small sets that dominate every other set holding the same
piece, many bins at a time, and best fit (decreasing) packs what is left.  The
answer is a list of runs ("pieces of length l with ranks from r fill bins from
b, q to a bin, at offset o"), whose size depends on the lengths, not on the
number of documents.  Each piece then finds its place from its length and its
rank among the pieces of that length, which Spark counts in salted groups.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_of, map_arrow, partitions, small_batches, written
from strata.llm.vocab import byte_encoder

CAPACITY = 2048

Group = tuple[int, list[tuple[int, int]]]  # bins alike: how many, and (length, copies) in each


def dominance_reduction(count: np.ndarray, capacity: int) -> list[Group]:
    """Fix dominating sets of one or two pieces; ``count`` (by length) keeps the rest.

    For the piece j: alone if nothing fits beside it; with the piece that fills
    the bin exactly; with the largest fitting piece k if only one more fits, or
    if just two more can fit and no such two together exceed k.  In each case
    any other packing can exchange pieces to hold the set, so fixing it costs no
    bin.  Passes repeat until none fixes anything.
    """
    fixed: list[Group] = []

    def fix(j: int, k: int | None) -> None:
        if k is None:
            n, row = int(count[j]), [(j, 1)]
            count[j] = 0
        elif k == j:
            n, row = int(count[j]) // 2, [(j, 2)]
            count[j] -= 2 * n
        else:
            n, row = int(min(count[j], count[k])), [(j, 1), (k, 1)]
            count[j] -= n
            count[k] -= n
        fixed.append((n, row))

    def partner(j: int) -> tuple[bool, int | None]:
        """(whether a set is fixed for j, its partner)."""
        room = capacity - j
        count[j] -= 1  # one piece of length j is the one in question
        try:
            have = np.flatnonzero(count[: room + 1])
            have = have[have > 0]
            if not len(have):
                return True, None
            if count[room]:
                return True, room
            k = int(have[-1])
            small = np.repeat(have[:3], np.minimum(count[have[:3]], 3))[:3]
            if len(small) < 2 or small[:2].sum() > room:
                return True, k
            if len(small) == 3 and small.sum() <= room:
                return False, None
            # The best two: for each a the largest b that fits (a itself needs two).
            at = np.searchsorted(have, room - have, "right") - 1
            alone = (at >= 0) & (have[at] == have) & (count[have] < 2)
            at = at - alone
            sums = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
            return int(sums.max()) <= k, k
        finally:
            count[j] += 1

    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(count)[::-1].tolist():
            while j and count[j]:
                found, k = partner(j)
                if not found:
                    break
                fix(j, k)
                changed = True
    return fixed


def best_fit(count: np.ndarray, capacity: int) -> list[Group]:
    """Best fit, longest first, for pieces counted by length; bins alike together."""
    open_: dict[int, list[Group]] = {}
    left: list[int] = []  # residuals with bins, ascending

    def put(residual: int, group: Group) -> None:
        if residual not in open_:
            open_[residual] = []
            bisect.insort(left, residual)
        open_[residual].append(group)

    for s in np.flatnonzero(count)[::-1].tolist():
        n = int(count[s])
        while s and n:
            at = bisect.bisect_left(left, s)
            if at == len(left):
                bins, row, room = -(-n // (capacity // s)), [], capacity
            else:
                room = left[at]
                bins, row = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    left.pop(at)
            q = room // s
            full = min(bins, n // q)
            if full:
                put(room - q * s, (full, [*row, (s, q)]))
                n -= full * q
                bins -= full
            if bins and n and n < q:
                put(room - n * s, (1, [*row, (s, n)]))
                n, bins = 0, bins - 1
            if bins and row:
                put(room, (bins, row))
    return [g for residual in sorted(open_) for g in open_[residual]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, copies in a bin, first bin, offset), by length and rank."""
    count = np.zeros(capacity + 1, "i8")
    for length, n in counts.items():
        count[length] = n
    groups = dominance_reduction(count, capacity) + best_fit(count, capacity)
    runs, taken, first = [], np.zeros(capacity + 1, "i8"), 0
    for bins, row in groups:
        at = 0
        for length, copies in row:
            runs.append((length, taken[length], copies, first, at))
            taken[length] += bins * copies
            at += length * copies
        first += bins
    return np.array(sorted(runs), "i8").reshape(-1, 5)


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the end id;
    longer ones cut into pieces of ``capacity``, the first taking the remainder."""

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = byte_encoder(tokenizer).encode(b.column(1))
        rows: list[tuple] = []
        end = np.array([end_id], "<u4")
        for doc_id, lo, hi in zip(b.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            own = np.concatenate((ids[lo:hi], end))
            start, piece = 0, 0
            while start < len(own):
                length = min(capacity, (len(own) - start - 1) % capacity + 1)
                rows.append((doc_id, piece, start, length, crc_of(own[start : start + length])))
                start, piece = start + length, piece + 1
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    return map_arrow(docs.select("doc_id", "text"), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    Reads ``doc_id`` and ``text``; null text is empty (one piece, the end id).
    Repeated rows are documents of their own; null ids stay null.  An empty
    table gives no rows.  Returns doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.
    """
    spark = docs.sparkSession
    pieces = written(pieces_of(docs, tokenizer, end_id, capacity), "pieces")
    # A length may hold a third of all pieces: ranks are counted in salted groups.
    salts = 4 * partitions(spark)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = plan(counts, capacity)
    key = (runs[:, 0] << 48) + runs[:, 1]

    def place(b: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = np.asarray(b.column(3)), np.asarray(b.column(5))
        run = runs[np.searchsorted(key, (length << 48) + rank, "right") - 1]
        i = rank - run[:, 1]
        bin_, offset = run[:, 3] + i // run[:, 2], run[:, 4] + i % run[:, 2] * length
        return pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(bin_), pa.array(offset)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("row", F.row_number().over(order)).join(before, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("row") - 1).alias("rank"))
    return map_arrow(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
