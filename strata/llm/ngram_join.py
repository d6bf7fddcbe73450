"""N-gram Jaccard join: size-aware, heavy-light.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches a threshold.  Equal sets are one vertex.  Two ways find the others:

* Small sets enumerate subsets of a fixed size: for each partner size, all
  subsets as large as the overlap that a link needs.  Equal subsets of a fitting
  pair of sizes are links, without further checks.
* Large sets would have too many subsets.  They enter inverted lists of the
  first shingles of their set in an order that puts frequent shingles last (as
  many as a link cannot avoid sharing one of), and the lists are scanned.  In a
  list, sets are compared by parity sketches: every shingle flips one bit, so
  the differing bits never exceed the differing shingles, and no link is lost.
  What passes is verified on the whole sets.

The boundary is the size where enumeration begins to cost more rows than the
scan and the verification it needs (``boundary``).

A group of many alike documents must not become all its pairs: where more than
``DENSE`` pairs a row pass, a scan emits only a spanning forest of them.  Of the
pairs found, one a document is verified first.  Then those pairs, and all that
pass in the dense lists, that still lie in different components are verified.
So every link either lies within a component or is verified itself.  Long lists
are split into blocks, and every two blocks are compared by a task of their own.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, documents, map_arrow, partitions, slices, small_batches, written

FREQUENT = 500_000  # shingles whose order is by frequency; bounds the broadcast (16 bytes each)
LOCAL_USES = 4
DENSE = 4
SMALLER, LARGER, EQUAL = 0, 1, 2
BLOCK = 1024  # rows of a list compared together
SEND_IDS = 500_000  # ids sent to all executors at most; more are joined by a shuffle
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles.

    Words are runs of anything but ASCII blanks, A-Z lower-cased; a text with
    fewer words than a shingle has one, of all its words; without words, none.
    """
    if texts.offset:  # ascii_lower misreads arrays with an offset
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    pieces = pc.ascii_split_whitespace(texts)
    at = np.asarray(pieces.offsets).astype("i8")
    at = at - at[0]
    coded = pieces.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    of = np.array([xxhash.xxh64_intdigest(w) for w in names] or [0], "u8")
    code = np.array(coded.indices, "i8")
    if names and "" in names:  # around leading and trailing blanks
        real = code != names.index("")
        at = np.concatenate(([0], np.cumsum(real)))[at]
        code = code[real]
    h = of[code]
    rolled = np.zeros(max(0, len(h) - words + 1), "u8")
    for k in range(words):
        rolled = mix(rolled * _M1 + h[k : k + len(rolled)])
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= words:
            out.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            one = np.array([hi - lo], "u8")
            for k in range(lo, hi):
                one = mix(one * _M1 + h[k : k + 1])
            out.append(one)
        else:
            out.append(np.empty(0, "u8"))
    return out


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap that links sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets(n: int, percent: int, limit: int) -> list[tuple[int, int]]:
    """(partner size, subset size) that a set of n enumerates: pairs of which the
    smaller has at most ``limit`` shingles, and that aren't equal sets only."""
    sizes = [(m, needed(n, m, percent)) for m in partners(n, percent) if min(n, m) <= limit]
    return [(m, o) for m, o in sizes if o <= min(n, m) and (m != n or o < n)]


def boundary(percent: int) -> int:
    """The largest size up to which sets enumerate subsets.

    Costs in rows to shuffle: enumeration, its subsets; the scan, its entries
    and one row's bytes for each shingle, since a set to be verified is written
    and joined twice (three times 8 bytes a shingle, as much as an entry).
    """
    n = 0
    while True:
        m = n + 1
        enumerated = sum(math.comb(m, o) for _, o in subsets(m, percent, m))
        if enumerated > m - -(-percent * m // 100) + 1 + m:
            return n
        n = m


def sketch(u: np.ndarray, percent: int, fine: int = 1) -> bytes:
    """One parity bit for each of 2^b bins: half the set's size or more at 90
    hundredths, all of it at 80 (where more may differ), times ``fine``."""
    bits = 1 << max(8, (max(1, fine * len(u) * (100 - percent) // 20) - 1).bit_length())
    return np.packbits((np.bincount((u >> np.uint64(20)) & np.uint64(bits - 1), minlength=bits) & 1).astype("u1"), bitorder="little").tobytes()


def folded(raw: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the smallest's width."""
    width = min(map(len, raw)) // 8
    rows = np.empty((len(raw), width), "u8")
    for i, r in enumerate(raw):
        x = np.frombuffer(r, "u8")
        rows[i] = x if len(x) == width else np.bitwise_xor.reduce(x.reshape(-1, width), 0)
    return rows


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, their places from rare to frequent) of the shingles
    that repeat most.  Only an order is made of them, so any choice is right;
    counts are of all documents, except what a task saw fewer than
    ``LOCAL_USES`` times in a stretch of about two million shingles."""

    def count(batches):
        held, size = [], 0

        def flush():
            u, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LOCAL_USES
            return pa.RecordBatch.from_arrays([pa.array(u[often].view("i8")), pa.array(n[often].astype("i8"))], names=["h", "n"])

        for b in batches:
            for part in slices(b):
                sets = shingle_sets(part.column(0), words)
                held += sets
                size += sum(map(len, sets))
                if size >= 2_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    local = docs.select("text").mapInArrow(count, "h long, n long")
    top = local.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h = np.array(top["h"].to_numpy()).astype("i8").view("u8")
    order = np.argsort(h)
    place = np.arange(len(h), 0, -1)  # the most frequent last
    return h[order], place[order]


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """For each document: doc_id, n, the set's identity (h1, h2), its sketch,
    entries (inverted lists of a large set) and subset keys (of a small one,
    with the side of its size in the pair of sizes)."""
    hot, place = frequent_shingles(docs, words)
    shared = docs.sparkSession.sparkContext.broadcast((hot, place))
    limit = boundary(percent)
    reach = 100 * limit // percent

    def prefix(u: np.ndarray, hot: np.ndarray, place: np.ndarray) -> np.ndarray:
        keep = len(u) - -(-percent * len(u) // 100) + 1
        if len(hot):
            at = np.minimum(np.searchsorted(hot, u), len(hot) - 1)
            rank = np.where(hot[at] == u, place[at], 0)
            if rank.any():
                return u[np.argsort(rank, kind="stable")[:keep]]
        return u[:keep]

    def enumerated(u: np.ndarray) -> tuple[list[int], list[int]]:
        keys, sides, n = [], [], len(u)
        for m, o in subsets(n, percent, limit):
            tag = np.uint64((min(n, m) * 4096 + max(n, m)) * 4096 + o)
            total = u.sum(dtype="u8")
            gone = np.array([u[list(c)].sum(dtype="u8") for c in combinations(range(n), n - o)], "u8")
            keys += mix((total - gone) * _M1 + tag).view("i8").tolist()
            sides += [EQUAL if n == m else LARGER if n > m else SMALLER] * len(gone)
        return keys, sides

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        hot, place = shared.value
        out: list[tuple] = []
        for u in shingle_sets(b.column(1), words):
            n = len(u)
            keys, sides = enumerated(u) if 0 < n <= reach else ([], [])
            entries = prefix(u, hot, place).view("i8") if n > limit else []
            out.append((n, int(u.sum(dtype="u8").astype("i8")), int(mix(u * _M3).sum(dtype="u8").astype("i8")), sketch(u, percent) if n > limit else b"", entries, keys, sides))
        cols = list(zip(*out))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int8()))
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=["doc_id", "n", "h1", "h2", "sketch", "entries", "keys", "sides"])

    return map_arrow(docs, run, "doc_id long, n long, h1 long, h2 long, sketch binary, entries array<long>, keys array<long>, sides array<tinyint>")


def _blocks(ids: np.ndarray, n: np.ndarray, raw: list[bytes], percent: int, component: np.ndarray | None) -> tuple[list[tuple[int, int]], bool]:
    """(pairs of one block of a list that pass the sketch test, whether that is
    all).  Given components, all that lie in different ones; otherwise all if
    they are few, and else a spanning forest."""
    rows, out = folded(raw), []
    slack, whole = 100 - percent, 100 + percent

    def passing(i: int, others: np.ndarray) -> np.ndarray:
        apart = np.bitwise_count(rows[others] ^ rows[i]).sum(1, dtype="i8")
        fits = (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])) & (whole * apart <= slack * (n[others] + n[i]))
        return others[fits & (ids[others] != ids[i])]

    for i in range(len(ids) - 1):
        others = np.arange(i + 1, len(ids))
        if component is not None:
            others = others[component[others] != component[i]]
        out += [(int(ids[i]), int(ids[j])) for j in passing(i, others).tolist()]
        if component is None and len(out) > DENSE * len(ids):
            break
    else:
        return out, True
    out, left = [], np.arange(len(ids))
    while len(left):
        found, left = [int(left[0])], left[1:]
        while found and len(left):
            i = found.pop(0)
            near = passing(i, left)
            if len(near):
                out += [(int(ids[i]), int(ids[j])) for j in near.tolist()]
                found += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)
    return out, False


def _compare(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) from blocks of lists (key, s, t, id, n, sketch[, component]);
    a dense list's key comes back as ``a`` with a null ``b``."""
    wide = "component" in lists.columns
    keys = ["key", "s", "t"]

    def scan(batches):
        held = None

        def pairs(t: pa.Table):
            k = np.stack([np.asarray(t[c].combine_chunks()) for c in keys], 1)
            edge = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1), [True])))
            ids, n = (np.asarray(t[c].combine_chunks()) for c in ("id", "n"))
            comp = np.asarray(t["component"].combine_chunks()) if wide else None
            raw, out, dense = t["sketch"].to_pylist(), [], []
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if hi - lo > 1:
                    own, every = _blocks(ids[lo:hi], n[lo:hi], raw[lo:hi], percent, comp[lo:hi] if wide else None)
                    out += own
                    if not every:
                        dense.append(int(k[lo, 0]))
            a, b = np.array(sorted(set(out)), "i8").reshape(-1, 2).T if out else (np.empty(0, "i8"),) * 2
            low = np.concatenate((np.minimum(a, b), np.array(dense, "i8")))
            high = np.concatenate((np.maximum(a, b), np.zeros(len(dense), "i8")))
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high, mask=np.arange(len(high)) >= len(a))], names=["a", "b"])

        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            last = tuple(t[c][-1].as_py() for c in keys)
            same = pc.and_(pc.and_(pc.equal(t["key"], last[0]), pc.equal(t["s"], last[1])), pc.equal(t["t"], last[2]))
            first = pc.index(same.combine_chunks() if isinstance(same, pa.ChunkedArray) else same, True).as_py()
            held = t.slice(first)
            if first:
                yield pairs(t.slice(0, first))
        if held is not None:
            yield pairs(held)

    dealt = lists.repartition(partitions(lists.sparkSession), *keys).sortWithinPartitions(*keys, "id")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def _with_blocks(members: DataFrame) -> DataFrame:
    """A row of a list (with its length ``size``) once for every two blocks that
    its own block is compared with."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda t: F.struct(F.least(own, t).alias("s"), F.greatest(own, t).alias("t")))
    return members.withColumn("pair", F.explode(others)).select("*", "pair.s", "pair.t").drop("pair", "size")


def _sent(df: DataFrame) -> DataFrame:
    """Marked to be sent to all executors if it has at most ``SEND_IDS`` rows of ids."""
    return F.broadcast(df) if df.count() <= SEND_IDS else df


def _checked(pairs: DataFrame, docs: DataFrame, words: int, payload, passes) -> DataFrame:
    """The pairs (a, b) whose sets' payloads pass.  That of each a goes to a's
    place once, that of b once a pair."""

    def made(to: DataFrame, names: list[str]) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            out = [payload(u) for u in shingle_sets(b.column(len(names)), words)]
            return pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(out, pa.binary())], names=[*names, "u"])

        near = docs.select(F.col("doc_id").alias(names[-1]), "text").join(_sent(to), names[-1])
        return map_arrow(near.select(*names, "text"), run, ", ".join(f"{c} long" for c in names) + ", u binary")

    left = made(written(pairs.select("a").distinct(), "ids"), ["a"]).withColumnRenamed("u", "ua")

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        keep = [passes(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(made(pairs, ["a", "b"]).join(left, "a").select("a", "b", "ua", "u"), check, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets link.  Of each hash 48 bits are sent, still far
    more than two sets need to tell their shingles apart."""

    def hashes(raw: bytes) -> np.ndarray:
        out = np.zeros((len(raw) // 6, 8), "u1")
        out[:, :6] = np.frombuffer(raw, "u1").reshape(-1, 6)
        return out.view("u8").ravel()

    def passes(x: bytes, y: bytes) -> bool:
        u, v = hashes(x), hashes(y)
        common = len(np.intersect1d(u, v, assume_unique=True))
        return 100 * common >= percent * (len(u) + len(v) - common)

    return _checked(pairs, docs, words, lambda u: u.view("u1").reshape(-1, 8)[:, :6].tobytes(), passes)


def _sifted(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that pass with sketches of four bits a shingle, an eighth of the
    sets' own size, which few pairs below the threshold do."""

    def passes(x: bytes, y: bytes) -> bool:
        n = int.from_bytes(x[:4], "little") + int.from_bytes(y[:4], "little")
        rows = folded([x[4:], y[4:]])
        return (100 + percent) * int(np.bitwise_count(rows[0] ^ rows[1]).sum()) <= (100 - percent) * n

    return _checked(pairs, docs, words, lambda u: len(u).to_bytes(4, "little") + sketch(u, 80, 4), passes)


def link(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs`` (doc_id, text).

    Documents link at a Jaccard similarity of ``percent`` hundredths or more;
    a component is named by its least doc_id.  Null and empty texts, and those
    without words, link with nothing.  Rows that share a doc_id count as one
    document with several texts; rows without a doc_id link with nothing and
    have no component.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = written(signatures(docs, words, percent), "signatures")
    named = signed.where("doc_id is not null and n > 0")
    same = written(named.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")), "equal")
    # One row for each distinct set: not those of a larger doc_id than the set's least.
    extra = named.join(same, ["h1", "h2", "n"]).where("doc_id <> rep").select("doc_id", "h1", "h2").distinct()
    reps = named.join(_sent(written(extra, "extra")), ["doc_id", "h1", "h2"], "left_anti")
    if named.groupBy("doc_id", "h1", "h2").count().where("count > 1").limit(1).count():  # repeated rows
        reps = written(reps.dropDuplicates(["doc_id", "h1", "h2"]), "distinct")

    # Small sets: of a key of two sizes, each side links with all of the other;
    # of a key of one size, all link with one another.
    keyed = reps.select(F.col("doc_id").alias("id"), F.explode(F.arrays_zip("keys", "sides")).alias("k")).select("id", F.col("k.keys").alias("key"), F.col("k.sides").alias("side"))
    least = keyed.groupBy("key").agg(*[F.min(F.when(F.col("side") == i, F.col("id"))).alias(f"least{i}") for i in (SMALLER, LARGER, EQUAL)])
    other = F.when(F.col("side") == SMALLER, F.col(f"least{LARGER}")).when(F.col("side") == LARGER, F.col(f"least{SMALLER}")).otherwise(F.col(f"least{EQUAL}"))
    equal = keyed.join(least, "key").select(F.col("id").alias("a"), other.alias("b")).where("a <> b").distinct()

    # Large sets: inverted lists.
    entry = reps.select(F.col("doc_id").alias("id"), F.explode("entries").alias("key"))
    lists = entry.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("a"), F.max("id").alias("b")).where("size > 1")
    lists = written(lists, "lists")
    traits = reps.select(F.col("doc_id").alias("id"), "n", "sketch")
    members = written(entry.join(lists.where("size > 2").select("key", "size"), "key"), "members")
    twos = lists.where("size = 2 and a <> b").select("a", "b").distinct()
    found = written(_compare(_with_blocks(members).join(traits, "id"), percent), "found")
    pairs = written(found.where("b is not null").unionAll(_near(twos, traits, percent)).distinct(), "pairs")

    # One pair a document first.
    first = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    edges = written(_verified(first, docs, words, percent).unionAll(equal), "edges")
    groups = written(connected_components(edges), "components")

    # Then all that pass and still lie apart.
    def apart(df: DataFrame) -> DataFrame:
        for c in ("a", "b"):
            df = df.join(groups.select(F.col("id").alias(c), F.col("component").alias(f"in_{c}")), c, "left")
        return df.where("coalesce(in_a, a) <> coalesce(in_b, b)").select("a", "b")

    dense = members.join(found.where("b is null").select(F.col("a").alias("key")).distinct(), "key", "left_semi")
    placed = dense.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    others = _compare(_with_blocks(placed.join(mixed, "key", "left_semi")).join(traits, "id"), percent)
    more = apart(pairs.join(first, ["a", "b"], "left_anti")).unionAll(others.join(first, ["a", "b"], "left_anti")).distinct()
    more = written(_sifted(written(more, "apart"), docs, words, percent), "sifted")
    more = _verified(more, docs, words, percent)
    groups = connected_components(edges.unionAll(more))

    found = signed.join(same, ["h1", "h2", "n"], "left").join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _near(pairs: DataFrame, traits: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) from lists of two, those that pass the sketch test."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x, y, n, m = (np.asarray(b.column(i)) for i in (0, 1, 2, 3))
        keep = np.zeros(len(x), bool)
        for i, (p, q) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist())):
            r = folded([p, q])
            keep[i] = (100 + percent) * int(np.bitwise_count(r[0] ^ r[1]).sum()) <= (100 - percent) * int(n[i] + m[i])
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"]).filter(pa.array(keep))

    left = traits.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = traits.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where(F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"))
    return map_arrow(both.select("a", "b", "na", "nb", "sa", "sb"), run, "a long, b long")


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The columns of documents; of each component the document with the least
    doc_id stays.  Repeated rows of it stay once; rows without a doc_id all stay."""
    docs = documents(docs)
    kept = link(docs, words, percent).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates().unionAll(docs.where("doc_id is null"))
