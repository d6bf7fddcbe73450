"""SimHash near-duplicates by bit-sliced comparison.

A text's fingerprint has 64 bits: a bit is set if it is set in more than half of
the hashes of the text's word shingles.  Texts of equal fingerprints are one
vertex; vertices link at ``radius`` or fewer differing bits.

Candidates: the 64 bits are cut into ``parts``; two linked fingerprints are
equal in all but ``radius`` of them at least, so they share one of the keys made
of ``parts - radius`` parts.  More parts make more keys but smaller buckets;
their number follows from the count of fingerprints by estimated cost, and any
number finds every link.

Comparison: a bucket's fingerprints are stored as bit planes, 64 of them to a
word.  A fingerprint is compared with 64 others at once: eight planes at a time
are added up in carry-save counters (ones, twos, fours, and a mark once past
seven), and after each eight the words of which every lane exceeds the radius
are abandoned.

Groups: a bucket of more than ``CHUNK`` rows is dealt into chunks.  First every
chunk is compared, together with the bucket's first chunk, by a task of its own,
and returns a star for each of its components rather than pairs.  Then only
rows outside the bucket's largest component are compared with those of other
components.  So a large group of alike texts is sent twice, not once a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, map_arrow, partitions, small_batches, written

WORDS = 4
RADIUS = 4
SEED = 42
CHUNK = 2048  # rows of a bucket compared together
CELLS = 1 << 15  # (fingerprint, word of 64 others) cells compared at a time
STRETCH = 1 << 18  # shingles hashed at a time
ROWS_NS, PAIR_NS = 2000, 4  # cost of a key's row, and of a pair compared
_ONE = np.uint64(1)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority of the bits of all shingles' hashes, repeats included.

    Words are runs of anything but ASCII blanks, A-Z lower-cased; a text of
    fewer words is one shingle; one without words has fingerprint zero.
    """
    raw = np.frombuffer(text.lower(), "u1")
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    if not word.any():
        return 0
    # One blank after every word; offsets of the words in what is left.
    last = word & ~np.append(word[1:], False)
    kept = np.where(word, raw, 32)[word | np.append(False, last[:-1])].tobytes()
    end = np.cumsum(word)[last] + np.arange(int(last.sum()))
    start = np.concatenate(([0], end[:-1] + 1))
    n = max(1, len(end) - words + 1)
    lo, hi = start[:n], end[-n:]
    counts = np.zeros(64, "i8")
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, STRETCH):
        hashes = [digest(kept[a:b], SEED) for a, b in zip(lo[i : i + STRETCH].tolist(), hi[i : i + STRETCH].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view("u1"), bitorder="little").reshape(-1, 64)
        for j in range(0, len(bits), 255):
            counts += bits[j : j + 255].sum(0, dtype="u1")
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of each row; fp is the fingerprint's bits as a signed long."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = [fingerprint((t or "").encode("utf-8", "surrogatepass"), words) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fp, "u8").view("i8"))], names=["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, fp long")


def masks(parts: int, radius: int) -> list[int]:
    """The bits of each key, as signed longs: all choices of ``parts - radius`` parts."""
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    part = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    out = [sum(part[i] for i in c) for c in combinations(range(parts), parts - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def best_parts(n: int, radius: int) -> int:
    """The number of parts with the least cost for ``n`` fingerprints of even bits."""

    def cost(parts: int) -> float:
        keys = math.comb(parts, radius)
        return n * keys * ROWS_NS + n * n / 2 * keys / 2.0 ** (64 * (parts - radius) / parts) * PAIR_NS

    return min(range(radius + 1, radius + 9), key=cost)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bits in each lane."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _past(radius: int, ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray) -> np.ndarray:
    """The lanes whose counts exceed ``radius`` (at most 7)."""
    greater, equal = over, ~over
    for counter, bit in ((fours, radius & 4), (twos, radius & 2), (ones, radius & 1)):
        if bit:
            equal = equal & counter
        else:
            greater = greater | (equal & counter)
            equal = equal & ~counter
    return greater


def planes_of(fp: np.ndarray) -> np.ndarray:
    """64 rows of words: word w of row p has bit p of fingerprints 64 w to 64 w + 63."""
    bits = np.unpackbits(fp.astype("<u8").view("u1").reshape(-1, 64, 8), axis=2, bitorder="little")  # word, lane, plane
    return np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little").reshape(64, -1).view("<u8")


def near(planes: np.ndarray, fp: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, lane) of the lanes within ``radius`` of the fingerprint: cell i
    compares ``fp[i]`` with the fingerprints of word ``word[i]``, of which
    ``lanes[i]`` count."""
    cell = np.arange(len(fp))
    dead = ~lanes
    ones, twos, fours, over = (np.zeros(len(fp), "u8") for _ in range(4))
    over |= dead
    for p in range(0, 64, 8):
        d = [planes[q][word] ^ (np.uint64(0) - ((fp >> np.uint64(q)) & _ONE)) for q in range(p, p + 8)]
        ones, two_a = _add(ones, d[0], d[1])
        ones, two_b = _add(ones, d[2], d[3])
        twos, four_a = _add(twos, two_a, two_b)
        ones, two_a = _add(ones, d[4], d[5])
        ones, two_b = _add(ones, d[6], d[7])
        twos, four_b = _add(twos, two_a, two_b)
        fours, eight = _add(fours, four_a, four_b)
        over |= eight
        past = _past(radius, ones, twos, fours, over)
        alive = past != np.uint64(0xFFFFFFFFFFFFFFFF)
        if not alive.all():
            cell, word, fp, ones, twos, fours, over, past = (x[alive] for x in (cell, word, fp, ones, twos, fours, over, past))
            if not len(cell):
                break
    if not len(cell):
        return np.empty(0, "i8"), np.empty(0, "i8")
    found = np.unpackbits((~past).astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(found)
    return cell[row], lane


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all rows joined by the links (a, b) the least label among them."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        low = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label[:] = further


def _linked(fp: np.ndarray, group: np.ndarray, radius: int, part: np.ndarray | None = None, asks: np.ndarray | None = None) -> np.ndarray:
    """For each row the first row that links join it to.  ``group``: ascending
    numbers; only rows of one group are compared.  Given ``part`` (components),
    rows that ask are compared with rows of other components only."""
    n = len(fp)
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    size = np.diff(edge)
    words = -(-size // 64)
    base = np.concatenate(([0], np.cumsum(words)))  # first word of a group
    of = np.repeat(np.arange(len(size)), size)
    slot = 64 * base[of] + np.arange(n) - edge[of]
    padded, filled, row_at = np.zeros(64 * base[-1], "u8"), np.zeros(64 * base[-1], bool), np.zeros(64 * base[-1], "i8")
    padded[slot], filled[slot], row_at[slot] = fp, True, np.arange(n)
    planes = planes_of(padded)
    lanes = np.packbits(filled.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
    # Every row with the words from its own on, or all of the group's.
    rows = np.arange(n) if asks is None else np.flatnonzero(asks)
    first = base[of[rows]] if asks is not None else slot[rows] // 64
    each = base[of[rows] + 1] - first
    upto = np.concatenate(([0], np.cumsum(each)))
    label = np.arange(n)
    for lo in range(0, int(upto[-1]), CELLS):
        at = np.arange(lo, min(lo + CELLS, int(upto[-1])))
        which = np.searchsorted(upto, at, "right") - 1
        row, word = rows[which], first[which] + at - upto[which]
        cell, lane = near(planes, fp[row], word, lanes[word], radius)
        a, b = row[cell], row_at[64 * word[cell] + lane]
        real = a != b if part is None else part[a] != part[b]
        _merge(label, a[real], b[real])
    return label


_KEYS = ["combo", "key", "s", "t"]


def _compared(cells: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of the rows of each cell (combo, key, s, t, fp[, part, asks]):
    a star for each component, its centre the first of its rows."""
    wide = "part" in cells.columns
    enough = 1 << 15

    def stars(t: pa.Table) -> pa.RecordBatch:
        keys = np.stack([np.asarray(t[c].combine_chunks()).astype("i8") for c in _KEYS], 1)
        group = np.cumsum(np.concatenate(([0], (keys[1:] != keys[:-1]).any(1).astype("i8"))))
        fp = np.asarray(t["fp"].combine_chunks())
        extra = (np.asarray(t["part"].combine_chunks()), np.asarray(t["asks"].combine_chunks().to_numpy(zero_copy_only=False), bool)) if wide else (None, None)
        label = _linked(fp.view("u8"), group, radius, *extra)
        moved = fp[label] != fp
        return pa.RecordBatch.from_arrays([pa.array(fp[label[moved]]), pa.array(fp[moved])], names=["a", "b"])

    def scan(batches) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < enough:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            last = [t[c][-1].as_py() for c in _KEYS]
            same = np.ones(len(t), bool)
            for c, v in zip(_KEYS, last):
                same &= np.asarray(t[c].combine_chunks()) == v
            whole = int(np.argmax(same))  # rows before the last group, which may go on
            if whole:
                yield stars(t.slice(0, whole))
            held = t.slice(whole).combine_chunks().to_batches()
            rows = len(t) - whole
        if rows:
            yield stars(pa.Table.from_batches(held))

    dealt = cells.repartition(partitions(cells.sparkSession), *_KEYS).sortWithinPartitions(*_KEYS, "fp")
    return dealt.mapInArrow(scan, "a long, b long")


def _first_cells(keyed: DataFrame, big: DataFrame | None) -> DataFrame:
    """Small buckets whole; of large ones each chunk with the first."""
    if big is None:
        return keyed.select("combo", "key", F.lit(0).alias("s"), F.lit(0).alias("t"), "fp")
    sized = keyed.join(big, ["combo", "key"], "left")
    chunks = F.ceil(F.coalesce("size", F.lit(1)) / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    to = F.when((own > 0) | (chunks == 1), F.array(own)).otherwise(F.sequence(F.lit(1), F.greatest(chunks - 1, F.lit(1))))
    return sized.select("combo", "key", F.lit(0).alias("s"), F.explode(to).alias("t"), "fp")


def _later_cells(keyed: DataFrame, big: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Of large buckets, rows outside the largest component with all others."""
    members = keyed.join(big, ["combo", "key"]).join(groups.select(F.col("id").alias("fp"), "component"), "fp", "left")
    members = written(members.withColumn("part", F.coalesce("component", "fp")).drop("component"), "large-buckets")
    sizes = members.groupBy("combo", "key", "size", "part").agg(F.count("*").alias("rows"))
    most = sizes.groupBy("combo", "key", "size").agg(F.max(F.struct("rows", "part")).alias("most"))
    open_ = written(most.where("size > most.rows").select("combo", "key", (F.col("size") - F.col("most.rows")).alias("rest"), F.col("most.part").alias("main")), "open-buckets")
    if not open_.limit(1).count():
        return None
    placed = members.join(open_, ["combo", "key"])
    asking, other = (F.ceil(F.col(c) / CHUNK).cast("int") for c in ("rest", "size"))
    h = F.xxhash64("fp")
    asks = placed.where("part <> main").select("combo", "key", F.pmod(h, asking).cast("int").alias("s"), F.explode(F.sequence(F.lit(0), other - 1)).alias("t"), "fp", "part", F.lit(True).alias("asks"))
    others = placed.select("combo", "key", F.explode(F.sequence(F.lit(0), asking - 1)).alias("s"), F.pmod(h, other).cast("int").alias("t"), "fp", "part", F.lit(False).alias("asks"))
    return asks.unionAll(others)


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(id, component) of the fingerprints that link with another; ``distinct``
    has one row for each, column fp."""
    n = distinct.count()
    bits = masks(best_parts(n, radius), radius)
    keys = F.array(*[F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(bits)])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("k.combo", "k.key", "fp")
    big = written(keyed.groupBy("combo", "key").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK), "large")
    big = big if big.limit(1).count() else None
    links = written(_compared(_first_cells(keyed, big), radius).distinct(), "links")
    groups = connected_components(links)
    if big is None:
        return groups
    groups = written(groups, "groups")
    later = _later_cells(keyed, big, groups)
    return groups if later is None else connected_components(links.unionAll(_compared(later, radius)))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for each row of
    ``docs`` (doc_id, text).

    Rows link at ``radius`` (0 to 7) or fewer differing bits; a component is
    named by its least doc_id.  Null and empty texts and those without words
    have fingerprint zero and link like others.  Repeated rows stay; a row
    without a doc_id takes part and gets its component's least doc_id, null if
    there is none.  An empty table gives no rows.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the counters hold distances up to 7")
    small_batches(docs.sparkSession)
    signed = written(fingerprints(docs, words), "fingerprints")
    vertices = written(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "vertices")
    groups = linked_fingerprints(vertices.select("fp"), radius)
    placed = vertices.join(groups.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = written(placed, "placed")
    named = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    vertex = written(placed.join(named, "component").select("fp", "component_id"), "named")
    return signed.join(vertex, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
