"""Cross-tokenizer alignment on whitespace-token anchors.

Every text is encoded whole by two tokenizers, A (byte-level) and B (pieces).
Their tokens cut the same bytes differently; offsets where tokens of both end
are shared ends.  A shared end before a token that is space-marked in both (its
bytes begin with a space) is an anchor: anchors split a document into windows,
pairs of id tuples, and what lies in a window depends on its ids alone.  So a
window's alignment is worked out once, kept by its id tuples, and documents are
put together from windows.

A group is what lies between two neighbouring shared ends, a link any pair of an
A and a B token of one group.  How many documents hold an id pair linked is
counted over the corpus from the documents' distinct pairs.  Documents then look
up the counts of their pairs: the ``HEAVY`` pairs or fewer that most documents
hold are sent to all executors, the others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, small_batches, written
from strata.llm.vocab import BLANK, byte_encoder, byte_of

HEAVY = 500_000  # pairs sent to all executors, at most
MEMO = 300_000  # windows kept by a task; past it all are forgotten, which costs time only
PART = 1 << 18  # characters that B encodes at a time, cut before words
WIDE = 4096  # pairs of a group beyond which they are counted by distinct ids
BETWEEN = 0xFFFFFFFF  # no id
_WORD = re.compile(f"(?<=[^{BLANK}]) (?=[^{BLANK}])")


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.a = byte_encoder(byte_path, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        of, names = byte_of(), self.a.tokenizer.get_vocab()
        special = {t.content for t in self.a.tokenizer.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = name.encode() if name in special else bytes(of[c] for c in name)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        # No piece goes on past a word's end, so words may be encoded apart.
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in t], "i8") for t in (self.bytes_a, self.bytes_b))
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        ids, at = self.a.encode(pa.array([" " + t for t in texts], pa.large_string()))
        return [ids[lo:hi] for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        parts, owner = [], []
        for i, t in enumerate(texts):
            lo = 0
            while self.apart and len(t) - lo > PART and (m := _WORD.search(t, lo + PART)):
                parts.append(t[lo : m.start()])  # the blank is what B adds to the next part
                owner.append(i)
                lo = m.end()
            parts.append(t[lo:])
            owner.append(i)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids in zip(owner, self.b.encode(parts, num_threads=1)):
            out[i].append(np.array(ids, "<u4"))
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


class Windows:
    """Alignments of windows, by their id tuples (A's ids, ``BETWEEN``, B's ids)."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self.width = len(vocabularies.bytes_b)
        a, b = range(len(vocabularies.bytes_a)), range(self.width)
        self.shown = [f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b] + [str(i) for i in b]
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.text: list[str] = []
        self.groups, self.links = array("q"), array("q")
        self.pairs, self.times, self.at = array("q"), array("q"), array("q", [0])

    def learn(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, groups: np.ndarray) -> None:
        """Keep the alignments of new windows.  Window i has ``groups[i]`` groups;
        group j has the next ``n_a[j]`` and ``n_b[j]`` tokens of either side."""
        window = np.repeat(np.arange(len(groups)), groups)
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        pair, times, row = [], [], []
        wide = n_a * n_b > WIDE
        for j in np.flatnonzero(wide).tolist():  # pairs by distinct ids, however long the group
            a, b = (np.unique(ids[lo : lo + n], return_counts=True) for ids, lo, n in ((ids_a, first_a[j], n_a[j]), (ids_b, first_b[j], n_b[j])))
            pair.append((a[0].astype("i8")[:, None] * self.width + b[0][None, :]).ravel())
            times.append((a[1][:, None] * b[1][None, :]).ravel())
            row.append(np.full(len(pair[-1]), window[j]))
        each = np.where(wide, 0, n_a * n_b)
        group = np.repeat(np.arange(len(each)), each)
        place = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
        of_b = n_b[group]
        pair.append(ids_a[first_a[group] + place // of_b].astype("i8") * self.width + ids_b[first_b[group] + place % of_b])
        times.append(np.ones(len(group), "i8"))
        row.append(window[group])
        pair, times, row = summed_pairs(*(np.concatenate(x) for x in (pair, times, row)))
        upto = np.searchsorted(row, np.arange(1, len(groups) + 1)) + self.at[-1]
        self.pairs.frombytes(pair.astype("i8").tobytes())
        self.times.frombytes(times.astype("i8").tobytes())
        self.at.frombytes(upto.astype("i8").tobytes())
        last = np.cumsum(groups)
        self.groups.frombytes(groups.astype("i8").tobytes())
        self.links.frombytes(np.add.reduceat((n_a * n_b).astype("i8"), last - groups).tobytes())
        # Written out: each group's A ids, then its B ids, each with the mark that follows.
        size_a, size_b = len(self.v.bytes_a), self.width
        base = np.cumsum(n_a + n_b) - n_a - n_b
        at = np.empty(len(ids_a) + len(ids_b), "i8")
        end_a, end_b = np.zeros(len(ids_a), "i8"), np.zeros(len(ids_b), "i8")
        end_a[first_a + n_a - 1] = size_a
        end_b[first_b + n_b - 1] = size_b
        end_b[(first_b + n_b - 1)[last - 1]] = 2 * size_b
        at[np.repeat(base - first_a, n_a) + np.arange(len(ids_a))] = ids_a + end_a
        at[np.repeat(base + n_a - first_b, n_b) + np.arange(len(ids_b))] = ids_b + end_b + 2 * size_a
        marks = list(map(self.shown.__getitem__, at.tolist()))
        ends = (base + n_a + n_b)[last - 1].tolist()
        self.text += ["".join(marks[lo:hi]) for lo, hi in zip([0, *ends], ends)]


def summed_pairs(pair: np.ndarray, times: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each row, ascending, with their summed times."""
    order = np.lexsort((pair, row))
    pair, times, row = pair[order], times[order], row[order]
    first = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (row[1:] != row[:-1]))))
    return pair[first], np.add.reduceat(times, first), row[first]


def _bytes(table: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... of ``n[0]`` numbers, then those from lo[1] on, ..."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def aligned(texts: list[str | None], windows: Windows) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text; ``groups``
    is written out, ``pairs`` are the distinct linked ones, ascending, each
    ``a * size of B's vocabulary + b``, with the links of each."""
    v = windows.v
    if len(windows.text) > MEMO:
        windows.forget()
    none = (0, 0, 0, 0, "", np.empty(0, "i8"), np.empty(0, "i8"))
    out = [none] * len(texts)
    full = [i for i, t in enumerate(texts) if t]
    a, b = v.encode_a([texts[i] for i in full]), v.encode_b([texts[i] for i in full])
    same = []
    for k, i in enumerate(full):
        raw = b" " + texts[i].encode("utf-8", "surrogatepass")
        if int(v.size_a[a[k]].sum()) == len(raw) == int(v.size_b[b[k]].sum()) and _bytes(v.bytes_a, a[k]) == raw == _bytes(v.bytes_b, b[k]):
            same.append(k)
    if not same:
        return out
    a, b, full = [a[k] for k in same], [b[k] for k in same], [full[k] for k in same]
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    flat_a, flat_b = np.concatenate(a).astype("<u4"), np.concatenate(b).astype("<u4")
    end_a, end_b = np.cumsum(v.size_a[flat_a]), np.cumsum(v.size_b[flat_b])
    to = np.searchsorted(end_b, end_a)
    in_a = np.flatnonzero(end_b[to] == end_a)  # the A and the B token before each shared end
    in_b = to[in_a]
    upto = np.cumsum(na)
    marked = np.append(v.space_a[flat_a], True)[in_a + 1] & np.append(v.space_b[flat_b], True)[in_b + 1]
    marked[np.searchsorted(in_a, upto - 1)] = True  # a document's end
    stop = np.flatnonzero(marked)  # windows end there
    stop_a, stop_b = in_a[stop] + 1, in_b[stop] + 1
    of_a, of_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)  # a window's tokens
    # Each window's id tuples in a row are its key.
    ends = np.cumsum(of_a + of_b + 1)
    ids = np.full(int(ends[-1]), BETWEEN, "<u4")
    ids[_ranges(ends - of_a - of_b - 1, of_a)] = flat_a
    ids[_ranges(ends - of_b, of_b)] = flat_b
    raw, ends = ids.tobytes(), (4 * ends).tolist()
    number = windows.number
    keys = [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]
    code = np.array(list(map(number.get, keys, repeat(-1))), "i8")
    new = []
    for i in np.flatnonzero(code < 0).tolist():
        n = number.setdefault(keys[i], len(number))
        if n == len(number) - 1 and n == len(windows.text) + len(new):
            new.append(i)
        code[i] = n
    if new:
        new = np.array(new)
        groups = np.diff(stop, prepend=-1)[new]
        group = _ranges(stop[new] + 1 - groups, groups)
        n_a, n_b = np.diff(in_a, prepend=-1)[group], np.diff(in_b, prepend=-1)[group]
        windows.learn(flat_a[_ranges(in_a[group] + 1 - n_a, n_a)], flat_b[_ranges(in_b[group] + 1 - n_b, n_b)], n_a, n_b, groups)
    of = np.searchsorted(upto, stop_a - 1, "right")  # the document of each window
    at = np.frombuffer(windows.at, "i8")
    each = (at[1:] - at[:-1])[code]
    place = _ranges(at[code], each)
    pair, times, row = summed_pairs(np.frombuffer(windows.pairs, "i8")[place], np.frombuffer(windows.times, "i8")[place], np.repeat(of, each))
    edge, cut = np.searchsorted(row, np.arange(len(full) + 1)), np.searchsorted(of, np.arange(len(full) + 1))
    groups, links = (np.add.reduceat(np.frombuffer(x, "i8")[code], cut[:-1]) for x in (windows.groups, windows.links))
    shown = list(map(windows.text.__getitem__, code.tolist()))
    for k, i in enumerate(full):
        out[i] = (int(na[k]), int(nb[k]), int(groups[k]), int(links[k]), ";".join(shown[cut[k] : cut[k + 1]]), pair[edge[k] : edge[k + 1]], times[edge[k] : edge[k + 1]])
    return out


_WINDOWS: dict[tuple[str, str], Windows] = {}


def _windows(byte_path: str, piece_path: str) -> Windows:
    """One memo for each pair of files and worker process, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (byte_path, piece_path) not in _WINDOWS:
        _WINDOWS[byte_path, piece_path] = Windows(Vocabularies(byte_path, piece_path))
    return _WINDOWS[byte_path, piece_path]


def align_texts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): row (a number of its own),
    doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = aligned(b.column(2).to_pylist(), _windows(byte_path, piece_path))
        n_a, n_b, n_groups, n_links, shown, pairs, times = zip(*found)
        digest = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown]
        longs = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
        lists = [pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), *longs, pa.array(digest, pa.string()), *lists], names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(numbered, run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): how many documents hold a pair linked, and whether no
    other pair of its A id is held by more."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts, "pair-counts")
    most = counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("most"))
    return written(counts.withColumn("a", F.expr(f"pair div {width}")).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-bests")


def _heavy_from(counts: DataFrame, most: int) -> int:
    """The least count, of steps an eighth of a doubling apart, that ``most``
    pairs or fewer reach."""
    step = F.floor(F.log2("n") * 8).cast("int")
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("n")).orderBy(F.desc("step")).collect()  # eight rows a doubling
    total, least = 0, None
    for r in rows:
        total += r["pairs"]
        if total > most:
            break
        least = r["n"]
    return least if least is not None else (rows[0]["n"] + 1 if rows else 1)


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256
    for each row of ``docs`` (doc_id, text).

    Null and empty texts, and those that either tokenizer does not give back
    byte by byte, have no tokens: zeros and an empty ``groups_sha256``.  Each
    row is a document, repeated rows too; a null doc_id stays null.  An empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)
    width = Vocabularies(byte_path, piece_path).b.vocab_size()
    found = written(align_texts(docs, byte_path, piece_path), "aligned", "zstd")
    counts = pair_counts(found, width)
    least = _heavy_from(counts, HEAVY)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    heavy, light = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)

    def summed(near: DataFrame) -> DataFrame:
        return near.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))

    sums = summed(links.join(F.broadcast(heavy), "pair"))
    if light.limit(1).count():
        rest = links.join(F.broadcast(heavy.select("pair")), "pair", "left_anti")
        sums = sums.unionAll(summed(rest.join(light, "pair"))).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = found.drop("pairs", "times").join(sums, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
