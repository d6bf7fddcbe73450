"""Token-id files compressed by Re-Pair grammars, with random access.

One file row is one shard: consecutive documents in ascending id order.  Its
grammar is built by rounds: count the pairs of neighbouring symbols, give the
most frequent ones nonterminals, replace them from left to right, and repeat
until no pair is used ``LEAST_USES`` times.  The
shard stores the rules, each nonterminal's expansion length, and the running
length at every ``BLOCK`` symbols, so a range of ids is found by binary search
and only the symbols that cover it are expanded.

A shard is written as one row of a Parquet table (Spark's committer then makes
retried and duplicate tasks safe on any store); ``payload`` is self-contained.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import partitions, range_bounds, range_bucket, slices, small_batches
from strata.llm.vocab import encoder

MAGIC = b"RPG1"
BLOCK = 1024
SHARD_IDS = 1_000_000
RULES_A_ROUND = 2048
LEAST_USES = 8
ENCODE_BYTES = 8 << 20  # of text encoded at a time: the more, the fewer distinct words in all
_BITS = 18
SCHEMA = "bucket int, seq int, n_docs long, n_ids long, payload binary"


def _slot(pairs: np.ndarray) -> np.ndarray:
    """The place of each pair of symbols in a table of ``2 ** _BITS``."""
    wide = 8 * pairs.itemsize
    return (pairs * pairs.dtype.type(0x9E3779B97F4A7C15 >> (64 - wide) | 1)) >> pairs.dtype.type(wide - _BITS)


def _joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as one, up to the first that reaches ``limit`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def repair(ids: np.ndarray, per_round: int = RULES_A_ROUND, least: int = LEAST_USES):
    """(base, rules, starts, sequence): symbols from ``base`` on are nonterminals;
    rule r expands to ``rules[r]``; round i's first symbol is ``starts[i]``.

    It ends when no pair is used ``least`` times, or when overlaps leave no frequent
    pair enough uses to be worth a rule; every other round makes a rule."""
    seq = ids.astype("u4")
    base = int(seq.max()) + 1 if len(seq) else 1
    rules, starts, symbol = [], [], base
    while len(seq) > 1:
        # Half the bytes to sort as long as two symbols fit.
        kind, shift = ("u4", 16) if symbol <= 1 << 16 else ("u8", 32)
        code = (seq[:-1].astype(kind) << shift) | seq[1:]
        ordered = np.sort(code)
        # A pair of u uses is equal to that ``least - 1`` places on at u - least + 1 places.
        ordered = ordered[least - 1 :][ordered[least - 1 :] == ordered[: max(0, len(ordered) - least + 1)]]
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [len(ordered) > 0])))
        uses = np.diff(edge) + least - 1
        often = np.arange(len(uses))
        if not len(often):
            break
        if len(often) > per_round:
            often = often[np.argsort(-uses[often], kind="stable")[:per_round]]
        pairs = np.sort(ordered[edge[often]])
        # Nearly all places that hold no such pair are out by one bit of a table.
        bits = np.zeros(1 << _BITS, bool)
        bits[_slot(pairs)] = True
        hit = np.flatnonzero(bits[_slot(code)])
        which = np.minimum(np.searchsorted(pairs, code[hit]), len(pairs) - 1)
        real = pairs[which] == code[hit]
        hit, which = hit[real], which[real]
        # Overlaps: in a run of neighbouring hits take every second one.
        fresh = np.concatenate(([True], np.diff(hit) != 1))
        head = hit[np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))]
        second = (hit - head) % 2 == 0
        hit, rule = hit[second], which[second]
        used = np.bincount(rule, minlength=len(pairs))
        keep = used >= 3  # else the rule costs more than it saves
        if not keep.any():
            break
        hit, rule = hit[keep[rule]], rule[keep[rule]]
        number = np.cumsum(keep) - 1
        seq[hit] = symbol + number[rule]
        stay = np.ones(len(seq), bool)
        stay[hit + 1] = False
        seq = seq[stay]
        kept = pairs[keep].astype("i8")
        starts.append(symbol)
        rules.append(np.stack((kept >> shift, kept & ((1 << shift) - 1)), 1))
        symbol += len(kept)
    return base, np.concatenate(rules) if rules else np.empty((0, 2), "i8"), np.array(starts, "i8"), seq.astype("i8")


def expand(seq: np.ndarray, base: int, rules: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of ``seq``, undoing the rounds from the last to the first."""
    seq, rules = seq.astype("u4"), rules.astype("u4")
    for start in starts[::-1].tolist():
        pair = seq >= start
        place = np.flatnonzero(pair)
        both = rules[seq[place] - base]
        seq = np.repeat(seq, 1 + pair.view("i1"))
        place += np.arange(len(place))
        seq[place], seq[place + 1] = both[:, 0], both[:, 1]
    return seq.astype("i8")


def expansion_lengths(base: int, rules: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids that each nonterminal stands for (a rule only uses earlier rounds' symbols)."""
    out = np.ones(len(rules), "i8")
    ends = [*(starts[1:] - base).tolist(), len(rules)]
    for lo, hi in zip((starts - base).tolist(), ends):
        for side in (0, 1):
            s = rules[lo:hi, side] - base
            out[lo:hi] += np.where(s >= 0, out[np.maximum(s, 0)], 1) - (side == 0)
    return out


@dataclass
class Shard:
    doc_ids: np.ndarray
    known: np.ndarray  # False: the document's id is null
    starts: np.ndarray  # of documents in the shard, and the end
    base: int
    rules: np.ndarray
    rounds: np.ndarray
    lengths: np.ndarray
    blocks: np.ndarray  # ids before every BLOCK-th symbol
    sequence: np.ndarray

    @staticmethod
    def build(doc_ids: list, n_tokens: np.ndarray, ids: np.ndarray) -> Shard:
        base, rules, rounds, seq = repair(ids)
        lengths = expansion_lengths(base, rules, rounds)
        size = np.where(seq >= base, lengths[np.maximum(seq - base, 0)] if len(rules) else 1, 1)
        before = np.cumsum(size) - size
        known = np.array([d is not None for d in doc_ids], bool)
        return Shard(np.array([d or 0 for d in doc_ids], "i8"), known, np.concatenate(([0], np.cumsum(n_tokens))), base, rules, rounds, lengths, before[::BLOCK], seq)

    def to_bytes(self) -> bytes:
        wide = "<u4" if len(self.sequence) and self.sequence.max() > 0xFFFF else "<u2"
        parts = [self.doc_ids.astype("<i8"), self.known.astype("u1"), self.starts.astype("<u8"), self.rules.astype("<u4"), self.rounds.astype("<u4"), self.lengths.astype("<u4"), self.blocks.astype("<u8"), self.sequence.astype(wide)]
        head = struct.pack("<4sIQQQQQQ", MAGIC, int(wide[2]), len(self.doc_ids), self.base, len(self.rules), len(self.rounds), len(self.blocks), len(self.sequence))
        return head + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def from_bytes(raw: bytes) -> Shard:
        magic, wide, docs, base, rules, rounds, blocks, seq = struct.unpack_from("<4sIQQQQQQ", raw)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize("<4sIQQQQQQ")
        out = []
        for n, t in ((docs, "<i8"), (docs, "u1"), (docs + 1, "<u8"), (2 * rules, "<u4"), (rounds, "<u4"), (rules, "<u4"), (blocks, "<u8"), (seq, f"<u{wide}")):
            out.append(np.frombuffer(raw, t, n, at))
            at += out[-1].nbytes
        d, k, s, r, o, n, b, q = out
        return Shard(d, k.astype(bool), s.astype("i8"), base, r.reshape(-1, 2).astype("i8"), o.astype("i8"), n.astype("i8"), b.astype("i8"), q)

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo to hi of the shard; expands only the symbols that cover them."""
        hi = int(self.starts[-1]) if hi is None else hi
        if lo >= hi:
            return np.empty(0, "i8")
        first = max(0, int(np.searchsorted(self.blocks, lo, "right")) - 1)
        last = int(np.searchsorted(self.blocks, hi, "left"))
        got = expand(self.sequence[first * BLOCK : last * BLOCK], self.base, self.rules, self.rounds)
        at = int(self.blocks[first])
        return got[lo - at : hi - at]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_ids: int = SHARD_IDS) -> None:
    """Encode whole texts (``text``; null: empty) in ascending ``doc_id`` order.

    Documents are dealt by ranges of ``doc_id`` and sorted within each range; a
    range is written as shards of about ``shard_ids`` ids, so memory is bounded
    by a shard and the largest single document.  Null ids come first; repeated
    ids stay, ordered by their text.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    n = 2 * partitions(spark)
    bounds = range_bounds(docs, "doc_id", n)
    dealt = docs.select("doc_id", "text").withColumn("bucket", range_bucket(F.col("doc_id"), bounds))
    dealt = dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "doc_id", "text")

    def shards(batches):
        held: list[tuple] = []  # (doc_ids, counts, ids) of the open shard
        bucket, seq, size = None, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([h[2] for h in held])
            names = [d for h in held for d in h[0]]
            raw = Shard.build(names, np.concatenate([h[1] for h in held]), ids).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(names)]), pa.array([len(ids)]), pa.array([raw], pa.binary())], names=["bucket", "seq", "n_docs", "n_ids", "payload"])

        for b in (part for batch in _joined(batches, ENCODE_BYTES) for part in slices(batch, 2 * ENCODE_BYTES)):
            ids, at = encoder(tokenizer, False).encode(b.column(1))
            counts = np.diff(at) + 1
            ids = np.insert(ids, at[1:], end_id)
            at = np.concatenate(([0], np.cumsum(counts)))
            names, of = b.column(0).to_pylist(), np.asarray(b.column(2))
            lo = 0
            while lo < len(names):
                if bucket != of[lo] or size >= shard_ids:
                    if held:
                        yield close()
                    seq = seq + 1 if bucket == of[lo] else 0
                    held, size, bucket = [], 0, int(of[lo])
                # Up to the end of the bucket, or where the shard is full.
                hi = int(np.searchsorted(of, bucket, "right"))
                hi = min(hi, max(lo + 1, int(np.searchsorted(at, at[lo] + shard_ids - size, "right"))))
                held.append((names[lo:hi], counts[lo:hi], ids[at[lo] : at[hi]]))
                size += int(at[hi] - at[lo])
                lo = hi
        if held:
            yield close()

    dealt.mapInArrow(shards, SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the shards' totals are
    added up by range first, so no task sees more than one range's shards.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    within = Window.partitionBy("bucket").orderBy("seq")
    ranges = files.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    ranges = ranges.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))  # a row a range
    base = files.select("bucket", "seq", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("inner")).join(ranges, "bucket")

    def decode(batches):
        for b in batches:
            for bucket, seq, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                shard = Shard.from_bytes(raw)
                ids = shard.ids().astype("<u4")
                raw_ids, n = memoryview(ids).cast("B"), len(shard.doc_ids)
                crc = [zlib.crc32(raw_ids[4 * lo : 4 * hi]) for lo, hi in zip(shard.starts[:-1].tolist(), shard.starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, bucket, "i4")), pa.array(np.full(n, seq, "i4")), pa.array(shard.doc_ids, mask=~shard.known), pa.array(shard.starts[:-1]), pa.array(np.diff(shard.starts)), pa.array(crc, pa.int64())], names=["bucket", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("bucket", "seq", "payload").mapInArrow(decode, "bucket int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(base, ["bucket", "seq"]).select("doc_id", (F.col("before") + F.col("inner") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
