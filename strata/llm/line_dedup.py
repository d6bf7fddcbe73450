"""Near-duplicate line removal by a deletion-neighbourhood join.

A line is a sequence of words (runs of anything but ASCII blanks).  Lines of
``EDIT_WORDS`` words or more are alike within ``bound`` words inserted, deleted
or replaced: one for each ``STRETCH`` words of the shorter, at least one.
Shorter lines are alike only if equal; lines under ``MIN_WORDS`` words and
``MIN_CHARS`` characters always stay.  A line goes if an earlier one (by
document, then line number, of its first occurrence) is alike.

One edit: every line emits its variants with one word left out, as hashed keys, each with
the place of the gap, and itself.  Two lines with the same variant and the same
gap differ in that word at most, so all lines of such a key are alike and only
the key's earliest is needed; a variant that equals a whole line is one deletion
away.  Thus a key shared by millions of lines costs a minimum, not its pairs.

Three exact reductions come first.  Equal lines count once.  One edit leaves
either the first or the second half of a line as it was, so only lines that
share a half with another line go on.  Likewise it leaves all of a line but one of
``PIECES`` pieces, so variants are only emitted of the pieces, in which a line may differ
from one that shares the rest.

More edits: two alike lines of ``2 * STRETCH`` words or more share a run of
``RUN`` words.  So they share the least hash of a window of ``WINDOW`` runs of
``GRAM`` words, and each edit touches ``RUN`` windows at most: lines of which
too few windows recur elsewhere are out.  Of the others, an edit touches
``GRAM`` grams at most, so that alike lines share one of their rarest
``GRAM * bound + 1`` grams, at places no further apart than the edits; passages that
many lines hold are rarely among them.
A line is compared with the earliest holder of each of these grams, and only if
that settles nothing with all earlier ones.  All pairs are verified by words.

Lines that are candidates go by one number, in the order of document and line.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SLICE_BYTES, documents, forget, map_arrow, slices, small_batches, written
from strata.llm.ngram_join import mix

MIN_WORDS = 3
MIN_CHARS = 24
EDIT_WORDS = 8
STRETCH = 16
GRAM, WINDOW = 5, 6
RUN = GRAM + WINDOW - 1  # at most (n - bound) / (bound + 1), rounded up, from 2 * STRETCH words on
PIECES = 4
PART_WORDS = 2_000_000  # of all lines, for each part that their keys are dealt into
LONG_WORD = 64  # bytes
LONG_LINE = 16 * STRETCH  # words; 128 parities tell few of those apart
MORE_BITS = 512
PART_BYTES = 6_000_000  # of lines that share windows, for each part that their grams are dealt into
PACK_KEYS = 1_000_000  # keys that a task holds before it sends them on
SEND_ROWS = 500_000  # rows sent to all executors at most; more are joined by a shuffle
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd
_INVERSE = tuple(np.uint64(pow(int(b), -1, 2**64)) for b in _BASE)
_SALT = np.uint64(0xD6E8FEB86659FD93)


def bound(words: int) -> int:
    """Edits at most between two alike lines, by the words of the shorter."""
    return max(1, words // STRETCH)


def _cuts(size: np.ndarray) -> list[np.ndarray]:
    """Where the pieces of lines of these sizes start, and where the last ends."""
    return [np.maximum(size, 0) * k // PIECES for k in range(PIECES + 1)]


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of words, eight bytes of all of them at a time (those of more than
    ``LONG_WORD`` bytes by XXH64), and their sizes in bytes."""
    lo = np.frombuffer(words.buffers()[1], "i8" if pa.types.is_large_string(words.type) else "i4")[words.offset : words.offset + len(words) + 1].astype("i8")
    size = np.diff(lo)
    data = np.zeros((int(lo[-1]) if len(words) else 0) + 8, "u1")
    if len(data) > 8:
        data[:-8] = np.frombuffer(words.buffers()[2], "u1", len(data) - 8)
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # from any byte on
    h = size.astype("u8") * _SALT
    of, start, left = slice(None), lo[:-1], size
    for k in range(0, LONG_WORD, 8):
        unused = (8 * np.clip(8 - left, 0, 7)).astype("u8")  # bits of the next words
        h[of] = mix((h[of] ^ ((eight[start] << unused) >> unused)) * _BASE[0] + _BASE[1])
        of = np.flatnonzero(size > k + 8)
        if not len(of):
            break
        start, left = lo[:-1][of] + k + 8, size[of] - k - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(data[lo[i] : lo[i + 1]].tobytes())
    return h, size


class LineWords:
    """The lines of some texts, with hashes of any run of their words in O(1)."""

    def __init__(self, texts: pa.Array):
        lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
        at = np.asarray(lines.offsets).astype("i8")
        self.of_text = at - at[0]  # text i has lines of_text[i] to of_text[i + 1]
        self.chars = np.asarray(pc.utf8_length(lines.flatten()))
        words = pc.ascii_split_whitespace(lines.flatten())
        at = np.asarray(words.offsets).astype("i8")
        h, size = word_hashes(words.flatten())
        real = size > 0  # the others are around leading and trailing blanks
        at = np.concatenate(([0], np.cumsum(real)))[at - at[0]]
        h = h[real]
        self.at = at  # line j has words at[j] to at[j + 1]
        self.size = np.diff(at)
        self.word = h
        self.sums, self.power, self.back = [], [], []
        for i, (base, inverse) in enumerate(zip(_BASE, _INVERSE)):
            steps = np.full(len(h) + 1, base, "u8")
            steps[0] = 1
            power = np.cumprod(steps, dtype="u8")
            steps[1:] = inverse
            self.power.append(power)
            self.back.append(np.cumprod(steps, dtype="u8"))
            self.sums.append(np.concatenate((np.zeros(1, "u8"), np.cumsum((h if i == 0 else mix(h ^ _SALT)) * power[:-1], dtype="u8"))))

    def run(self, lo: np.ndarray, hi: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the words lo to hi."""
        return (self.sums[which][hi] - self.sums[which][lo]) * self.back[which][lo]

    def without(self, lo: np.ndarray, hi: np.ndarray, gap: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the words lo to hi but for the one at ``gap``."""
        return self.run(lo, gap, which) + self.run(gap + 1, hi, which) * self.power[which][gap - lo]

    def halves(self) -> np.ndarray:
        """Four keys a line: its first and second half, as one of two lines of its
        length or the shorter of two, and as the longer of two."""
        out = np.zeros((len(self.size), 4), "u8")
        lo, hi = self.at[:-1], self.at[1:]
        for i, shorter in enumerate((self.size, self.size - 1)):
            half = np.maximum(shorter, 0) // 2
            tag = shorter.astype("u8") * _SALT
            out[:, 2 * i] = mix(self.run(lo, lo + half) + tag)
            out[:, 2 * i + 1] = mix(self.run(hi - (np.maximum(shorter, 0) - half), hi) + tag + np.uint64(1))
        return out

    def rests(self) -> np.ndarray:
        """Keys of a line without one of its ``PIECES`` pieces, as one of two lines of
        its length or the shorter of two, and as the longer of two."""
        out = np.zeros((len(self.size), 2 * PIECES), "u8")
        lo, hi = self.at[:-1], self.at[1:]
        for i, shorter in enumerate((self.size, self.size - 1)):
            cuts = _cuts(shorter)
            for k in range(PIECES):
                tail = mix(self.run(hi - (cuts[PIECES] - cuts[k + 1]), hi) ^ _SALT)
                out[:, i * PIECES + k] = mix(self.run(lo, lo + cuts[k]) + tail + cuts[PIECES].astype("u8") * _SALT + np.uint64(k))
        return out

    def grams(self) -> np.ndarray:
        """Hashes of the runs of ``GRAM`` words from each word on, across lines too."""
        start = np.arange(max(0, int(self.at[-1]) - GRAM + 1))
        return mix(self.run(start, start + GRAM))

    def parities(self) -> np.ndarray:
        """128 bits a line, as two numbers: whether it has an odd number of words of
        each of 128 hash values.  A word put in or taken out turns one of them."""
        bit = self.word >> np.uint64(57)
        one = np.uint64(1) << (bit & np.uint64(63))
        out = np.zeros((len(self.size), 2), "u8")
        some = np.flatnonzero(self.size)
        for k in range(2):
            if len(some):
                out[some, k] = np.bitwise_xor.reduceat(np.where(bit >> np.uint64(6) == k, one, np.uint64(0)), self.at[:-1][some])
        return out

    def more_parities(self, pick: np.ndarray) -> np.ndarray:
        """As ``parities``, ``MORE_BITS`` bits for each of some lines, by other hash bits."""
        out = np.zeros((len(pick), MORE_BITS // 64), "u8")
        line = np.repeat(np.arange(len(pick)), self.size[pick])
        first = np.cumsum(self.size[pick]) - self.size[pick]
        word = self.word[self.at[pick][line] + np.arange(len(line)) - first[line]]
        bit = (word >> np.uint64(24)) % np.uint64(MORE_BITS)
        np.bitwise_xor.at(out, (line, (bit >> np.uint64(6)).astype("i8")), np.uint64(1) << (bit & np.uint64(63)))
        return out

    def windows(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The least gram hashes of the windows of the lines of ``pick``, each with the
        count of neighbouring windows that it is least in, and their number by line."""
        g = self.grams()
        least = g[: max(0, len(g) - WINDOW + 1)].copy()
        for i in range(1, WINDOW):
            np.minimum(least, g[i : i + len(least)], out=least)
        each = np.where(pick, np.maximum(self.size - RUN + 1, 0), 0)
        line = np.repeat(np.arange(len(each)), each)
        upto = np.concatenate(([0], np.cumsum(each)))
        key = least[self.at[:-1][line] + np.arange(len(line)) - upto[line]]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(new)
        weight = np.diff(np.append(first, len(key)))
        return key[first], weight.astype("<i4"), np.diff(np.searchsorted(first, upto))[pick]


_DOC = "struct<id:long,t0:long,t1:long>"
#: Keys of a stretch's lines as arrays: hashes of the lines, how many keys each has, keys, weights.
_NEAR, _FAR = (tuple(f"{kind}_{c}" for c in ("lines", "each", "keys", "weights")) for kind in ("near", "far"))


def place(doc_id: Column, text: Column) -> Column:
    """A document's key and rank: its id, null first, then two hashes of its text,
    so that rows of one id or of none with different texts are documents of their own."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    id_ = F.coalesce(doc_id.cast("long"), F.lit(-(2**63)).cast("long"))
    return F.struct(id_.alias("id"), F.xxhash64(text).alias("t0"), F.xxhash64(F.lit(1), text).alias("t1"))


def _placed(docs: DataFrame) -> DataFrame:
    return docs.select(place(F.col("doc_id"), F.col("text")).alias("doc"), "text")


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line that may go, with its two hashes, and one for each stretch of
    text, which holds the halves and the windows of all its lines as arrays."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = LineWords(b.column(1))
        number = np.arange(len(x.size)) - np.repeat(x.of_text[:-1], np.diff(x.of_text))
        row = np.repeat(np.arange(b.num_rows), np.diff(x.of_text))
        keep = np.flatnonzero((x.size >= MIN_WORDS) | ((x.size > 0) & (x.chars >= MIN_CHARS)))
        lo, hi = x.at[:-1], x.at[1:]
        h1 = mix(x.run(lo, hi) + x.size.astype("u8"))
        near, far = x.size >= EDIT_WORDS, x.size >= 2 * STRETCH
        halves = x.halves()[near].ravel()
        window, weight, each = x.windows(far)
        arrays = [h1[near], np.full(int(near.sum()), 4, "<i4"), halves, np.ones(len(halves), "<i4"), h1[far], each.astype("<i4"), window, weight]
        last = np.arange(len(keep) + 1) == len(keep)
        cols = [np.append(c[keep], c.dtype.type(0)) for c in (number.astype("i4"), x.size.astype("i8"), h1.view("i8"), x.run(lo, hi, 1).view("i8"))]
        doc = b.column(0).take(pa.array(np.append(row[keep], 0), mask=last))
        packed = [pa.array([None] * len(keep) + [a.tobytes()], pa.binary()) for a in arrays]
        return pa.RecordBatch.from_arrays([doc, *[pa.array(c, mask=last) for c in cols], *packed], names=["doc", "line", "n", "h1", "h2", *_NEAR, *_FAR])

    # Half a slice: there are a dozen arrays of eight bytes a word.
    return map_arrow(_placed(docs), run, f"doc {_DOC}, line int, n long, h1 long, h2 long, {', '.join(f'{c} binary' for c in (*_NEAR, *_FAR))}", SLICE_BYTES // 2)


def _text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(at, words, near, far) of the wanted lines; ``words``: the line's text."""
    wanted = wanted.groupBy("doc").agg(F.collect_list(F.struct("line", "at", "near", "far")).alias("lines"))  # a document's own lines

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        own = b.column(2).flatten()
        row = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(b.column(2))))
        rows = [(t or "").split("\n") for t in b.column(1).to_pylist()]
        words = [rows[i][k] for i, k in zip(row.tolist(), own.field("line").to_pylist())]
        return pa.RecordBatch.from_arrays([own.field("at"), pa.array(words, pa.string()), own.field("near"), own.field("far")], names=["at", "words", "near", "far"])

    wanted = written(wanted, "wanted")
    send = wanted.count() <= SEND_ROWS
    chosen = _placed(docs).join(F.broadcast(wanted) if send else wanted, "doc").select("doc", "text", "lines")
    return map_arrow(chosen, run, "at long, words string, near boolean, far boolean").dropDuplicates(["at"])


def _apart(text: DataFrame) -> DataFrame:
    """(at, words, bits) of the near lines that share with another line all but one of
    their pieces; ``bits``: which, as of ``LineWords.rests``."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        keys = LineWords(b.column(1)).rests()
        each = np.repeat(np.arange(b.num_rows), 2 * PIECES)
        bit = np.tile((1 << np.arange(2 * PIECES)).astype("i4"), b.num_rows)
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view("i8")), pa.array(bit), b.column(0).take(pa.array(each))], names=["key", "bit", "at"])

    near = text.where("near").select("at", "words")
    keys = map_arrow(near, run, "key long, bit int, at long")
    same = Window.partitionBy("key")
    shared = keys.select("at", "bit", F.min("at").over(same).alias("lo"), F.max("at").over(same).alias("hi")).where("lo <> hi")
    return near.join(shared.groupBy("at").agg(F.bit_or("bit").alias("bits")), "at").select("at", "words", "bits")


def _variants(lines: DataFrame) -> DataFrame:
    """The variants of lines: gap -1 is the whole line.  ``check`` is a second
    hash of what is left."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = LineWords(b.column(1))
        each = x.size + 1
        row = np.repeat(np.arange(len(each)), each)
        gap = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) - 1
        bits = np.asarray(b.column(2))
        use = (gap < 0) & ((bits & ((1 << PIECES) - 1)) != 0)[row]
        for i, shorter in enumerate((x.size, x.size - 1)):  # the longer's gap may be just behind the piece
            cuts = _cuts(shorter)
            for k in range(PIECES):
                use |= ((bits >> (i * PIECES + k)) & 1).astype(bool)[row] & (gap >= cuts[k][row]) & (gap < cuts[k + 1][row] + i)
        row, gap = row[use], gap[use]
        lo, hi = x.at[:-1][row], x.at[1:][row]
        whole = gap < 0
        at = lo + np.maximum(gap, 0)
        key, check = (np.where(whole, x.run(lo, hi, i), x.without(lo, hi, at, i)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(key.view("i8")), pa.array(check.view("i8")), pa.array(x.size[row]), pa.array(gap), b.column(0).take(pa.array(row))], names=["key", "check", "n", "gap", "at"])

    return map_arrow(lines, run, "key long, check long, n long, gap long, at long")


#: Grams as arrays: lines, how many grams each has, then for each gram its name, uses, first
#: and last place; ``part``: where the name holds.  Rows with ``n`` hold figures of lines.
_CELLS = "to int, part int, at binary, each binary, key binary, uses binary, lo binary, hi binary, n binary, s0 binary, s1 binary, grams binary, more binary"
_EMPTY = np.zeros(0, "<u4")


def _cells(to: np.ndarray, at: np.ndarray, part: int | None, *values: np.ndarray) -> list[dict]:
    """Rows of ``_CELLS`` for key, uses, lo and hi of grams, by ``to`` and line."""
    order = np.argsort(to.astype("u2"), kind="stable") if part is None and to.max(initial=0) < 1 << 16 else np.lexsort((at, to))  # the former takes no comparisons
    to, at, values = to[order], at[order], [v[order] if len(v) else v for v in values]
    cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else _EMPTY
    rows = []
    for lo, hi in zip(cuts, [*cuts[1:], len(to)]):
        new = lo + np.flatnonzero(np.concatenate(([True], at[lo + 1 : hi] != at[lo : hi - 1])))
        row = {"to": int(to[lo]), "part": part, "at": at[new].tobytes(), "each": np.diff(np.append(new, hi)).astype("<u4").tobytes()}
        rows.append(row | {c: v[lo:hi].tobytes() for c, v in zip(("key", "uses", "lo", "hi"), values)})
    return rows


def _cell_table(rows: list[dict]) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    names = [c.split() for c in _CELLS.split(", ")]
    return pa.table({c: pa.array([r.get(c) for r in rows], kinds[k]) for c, k in names})


def _joined(t: pa.Table, **kinds: str) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x for x in t[c].to_pylist() if x), d) for c, d in kinds.items()]


def _rare(text: DataFrame) -> DataFrame:
    """(at, n, s0, s1, gram, lo, hi, more): of the rarest ``GRAM * bound + 1`` grams of each line,
    those that another line has, with the first and the last place in the line; ``more``:
    ``more_parities`` of lines of ``LONG_LINE`` words or more, empty for others.

    Grams are dealt into parts by hash and travel as arrays; in a part 32 bits name a gram
    (those taken for one another are one, for all lines).  There their uses are counted, and
    those with several go to the block of their line, where it picks its rarest.
    """
    far = text.where("far").select("at", "words")
    parts = 1 + (far.agg(F.sum(F.octet_length("words")).alias("n")).first()["n"] or 0) // PART_BYTES

    def block(at: np.ndarray) -> np.ndarray:
        return (mix(at.view("u8") * _BASE[0]) >> np.uint64(32)).astype("i8") % parts

    def own(b: pa.RecordBatch) -> tuple[tuple, tuple]:
        x = LineWords(b.column(1))
        at, n = np.array(b.column(0), "<i8"), np.maximum(x.size - GRAM + 1, 0)
        line = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
        gram = mix(x.grams()[x.at[:-1][line] + place])
        code = ((gram >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | (gram & np.uint64(2**32 - 1))
        order = np.lexsort((code, line))
        code, line, place = code[order], line[order], place[order]
        new = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (line[1:] != line[:-1])))[: len(code)])
        last = np.append(new[1:], len(code))[: len(new)] - 1
        of, code = line[new], code[new]
        grams = np.bincount(of, minlength=len(n)).astype("<u4")
        each = (code >> np.uint64(32)).astype("i8"), at[of], code.astype("<u4"), place[new].astype("<u4"), place[last].astype("<u4")
        more = np.zeros((len(n), MORE_BITS // 64), "<i8")
        long = np.flatnonzero(x.size >= LONG_LINE)
        more[long] = x.more_parities(long).view("<i8")
        return each, (at, x.size.astype("<u4"), *x.parities().view("<i8").T, grams, more)

    def sent(held: list) -> pa.RecordBatch:
        each, lines = ([np.concatenate(v) for v in zip(*half)] for half in zip(*held))
        to, at, key, lo, hi = each
        rows = _cells(to, at, None, key, _EMPTY, lo, hi)
        to = block(lines[0])
        for k in np.unique(to).tolist():
            n = lines[1][to == k]
            rows.append({"to": parts + k} | {c: v[to == k].tobytes() for c, v in zip(("at", "n", "s0", "s1", "grams"), lines)} | {"more": lines[5][to == k][n >= LONG_LINE].tobytes()})
        return _cell_table(rows).to_batches()[0]

    def deal(batches):
        held, total = [], 0
        for b in (part for whole in batches for part in slices(whole) if whole.num_rows):
            held.append(own(b))
            total += len(held[-1][0][0])
            if total >= PACK_KEYS:
                yield sent(held)
                held, total = [], 0
        if held:
            yield sent(held)

    def meet(t: pa.Table) -> pa.Table:
        part = t["to"][0].as_py()
        if part >= parts:  # figures of lines go on to their block
            return t.set_column(0, "to", pa.array([part - parts] * t.num_rows, pa.int32()))
        at, each, key, lo, hi = _joined(t, at="<i8", each="<u4", key="<u4", lo="<u4", hi="<u4")
        at, order = np.repeat(at, each), np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(new, len(key)))
        uses = np.repeat(count, count)
        order, key, uses = (v[uses > 1] for v in (order, key, uses))
        at = at[order]
        return _cell_table(_cells(block(at), at, part, key, uses.astype("<u4"), lo[order], hi[order]))

    def pick(t: pa.Table) -> pa.Table:
        lines, n, s0, s1, grams, long = _joined(t.filter(pc.is_valid(t["n"])), at="<i8", n="<u4", s0="<i8", s1="<i8", grams="<u4", more="<i8")
        more = np.zeros((len(lines), MORE_BITS // 64), "i8")
        more[n >= LONG_LINE] = long.reshape(-1, MORE_BITS // 64)
        t = t.filter(pc.is_null(t["n"]))
        at, each, key, uses, lo, hi = _joined(t, at="<i8", each="<u4", key="<u4", uses="<u4", lo="<u4", hi="<u4")
        size = np.asarray(pc.binary_length(t["key"])).astype("i8") // 4
        gram = np.repeat(np.asarray(t["part"]).astype("i8"), size) << 32 | key.astype("i8")
        order = np.argsort(lines)
        lines, n, s0, s1, grams, more = (v[order] for v in (lines, n, s0, s1, grams, more))
        line = np.searchsorted(lines, np.repeat(at, each))
        order = np.lexsort((gram, uses, line))
        line = line[order]
        several = np.bincount(line, minlength=len(lines))
        take = GRAM * (n.astype("i8") // STRETCH) + 1 - (grams.astype("i8") - several)
        rank = np.arange(len(line)) - (np.cumsum(several) - several)[line]
        order, line = (v[rank < take[line]] for v in (order, line))
        cols = [pa.array(lines[line]), pa.array(n[line].astype("i4")), pa.array(s0[line]), pa.array(s1[line]), pa.array(gram[order]), *[pa.array(v[order].astype("i4")) for v in (lo, hi)]]
        each = np.where(n[line] >= LONG_LINE, MORE_BITS // 64, 0)
        values = more[line[each > 0]].ravel()
        cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))).astype("i4")), pa.array(values)))
        return pa.Table.from_arrays(cols, names=["at", "n", "s0", "s1", "gram", "lo", "hi", "more"])

    met = far.mapInArrow(deal, _CELLS).groupBy("to").applyInArrow(meet, _CELLS)
    return written(met.groupBy("to").applyInArrow(pick, "at long, n int, s0 long, s1 long, gram long, lo int, hi int, more array<long>"), "rare")


_HELD = ("at", "n", "s0", "s1", "lo", "hi", "more")  # of a holder of a gram


def _with_earliest(rare: DataFrame) -> DataFrame:
    """(at, to): lines with the earliest holder of each of their grams."""
    first = F.min(F.struct(*_HELD)).over(Window.partitionBy("gram"))
    return _earlier(rare.select("gram", *_HELD, first.alias("first")).where("at > first.at").select(*_HELD, *[F.col(f"first.{c}").alias(f"to_{c}") for c in _HELD]))


def _with_all(rare: DataFrame, settled: DataFrame) -> DataFrame:
    """(at, to): lines not settled with all earlier holders of their grams."""
    other = rare.select("gram", *[F.col(c).alias(f"to_{c}") for c in _HELD])
    return _earlier(rare.join(settled, "at", "left_anti").join(other, "gram"))


def _earlier(pairs: DataFrame) -> DataFrame:
    """Pairs whose lengths, parities and places of the gram the edits allow: what comes
    before the gram and what comes after it differ in length by no more than those; a word
    replaced turns two parities, and one for each word of difference in length is only put in."""
    most, apart = F.floor(F.least("n", "to_n") / STRETCH), F.abs(F.col("n") - F.col("to_n"))
    near = (apart <= most) & (F.col("to_lo") <= F.col("hi") + most) & (F.col("to_hi") >= F.col("lo") - most)
    turned = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"to_{c}"))) for c in ("s0", "s1"))
    # Of lines without further parities zip_with makes nothing.
    further = F.aggregate(F.zip_with("more", "to_more", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
    both = (F.least("n", "to_n") < LONG_LINE) | (further <= 2 * most - apart)
    return pairs.where((F.col("to_at") < F.col("at")) & near & (turned <= 2 * most - apart) & both).select("at", F.col("to_at").alias("to")).distinct()


def _alike(variants: DataFrame) -> DataFrame:
    """(at, to): lines with the earliest line of each of their keys that comes before them."""
    # Dealt once: rows of a key are together for both windows.
    gap, shorter = F.col("gap") >= 0, F.col("n") - (F.col("gap") >= 0).cast("int")
    dealt = variants.repartition("key", "check").withColumn("shorter", shorter)
    same, one = Window.partitionBy("key", "check", "n", "gap"), Window.partitionBy("key", "check", "shorter")
    least = lambda which, over: F.min(F.when(which, F.col("at"))).over(over)
    met = dealt.select("at", least(gap, same).alias("replaced"), F.when(gap, least(~gap, one)).otherwise(least(gap, one)).alias("other"))
    met = met.where("replaced < at or other < at")  # other: whole, where one word more, or the other way round
    return met.select("at", F.explode(F.array("replaced", "other")).alias("to")).where("to < at").distinct()


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether one insertion, deletion or replacement at most turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def within_edits(a: list[str], b: list[str], most: int) -> bool:
    """Whether ``most`` insertions, deletions and replacements turn a into b, by the
    furthest place reached on each diagonal with so many edits."""
    m, n = len(a), len(b)
    if abs(n - m) > most:
        return False
    reach: dict[int, int] = {}
    for e in range(most + 1):
        now = {}
        left = most - e  # diagonals further from the last one are of no more use
        for d in range(max(-e, -m, n - m - left), min(e, n, n - m + left) + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1) if e else 0
            if i < 0:
                continue
            i = min(i, m, n - d)
            while i < m and i + d < n and a[i] == b[i + d]:
                i += 1
            now[d] = i
        if now.get(n - m) == m:
            return True
        reach = now
    return False


def may_be_within(a: list[str], b: list[str], most: int) -> bool:
    """False only where more than ``most`` edits are sure: each use of a word beyond
    those in the other line takes an edit of its own."""
    if abs(len(a) - len(b)) > most:
        return False
    a_words, b_words = Counter(a), Counter(b)
    return (a_words - b_words).total() <= most and (b_words - a_words).total() <= most


def may_be_within_each(a: pa.Array, b: pa.Array) -> tuple[tuple, tuple, np.ndarray]:
    """``may_be_within`` of each line of ``a`` with that of ``b`` and their bound, by
    array operations, and the words of both as (numbers, offsets)."""
    split = [pc.ascii_split_whitespace(x) for x in (a, b)]
    coded = pa.concat_arrays([x.flatten() for x in split]).dictionary_encode()
    numbers, lo, sides, sizes = np.array(coded.indices, "i8"), 0, [], []
    blank = pc.index(coded.dictionary, "").as_py()
    for x in split:
        row = np.repeat(np.arange(len(x)), np.asarray(pc.list_value_length(x)))
        code, lo = numbers[lo : lo + len(row)], lo + len(row)
        row, code = row[code != blank], code[code != blank]
        sizes.append(np.bincount(row, minlength=len(x)))
        sides.append((row, code))
    most = np.maximum(1, np.minimum(*sizes) // STRETCH)
    may = np.abs(sizes[0] - sizes[1]) <= most
    words = np.concatenate([((row << 32) | code) << 1 | k for k, (row, code) in enumerate(sides)])
    words.sort()  # np.unique takes ten times as long
    new = np.flatnonzero(np.concatenate(([True], words[1:] >> 1 != words[:-1] >> 1))[: len(words)])
    more = np.add.reduceat(1 - 2 * (words & 1), new) if len(new) else new  # uses in a less those in b
    for sign in (1, -1):
        may &= np.bincount(words[new] >> 33, np.maximum(sign * more, 0), len(a)) <= most
    out = [(code, np.concatenate(([0], np.cumsum(n)))) for (_, code), n in zip(sides, sizes)]
    return *out, may


def _verified(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs whose lines are alike, by their words."""

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        (x, x_at), (y, y_at), may = may_be_within_each(b.column(1), b.column(2))
        keep = np.zeros(b.num_rows, bool)
        for i in np.flatnonzero(may).tolist():
            one, other = x[x_at[i] : x_at[i + 1]].tolist(), y[y_at[i] : y_at[i + 1]].tolist()
            keep[i] = within_edits(one, other, bound(min(len(one), len(other))))
        return pa.RecordBatch.from_arrays([b.column(0)], names=["at"]).filter(pa.array(keep))

    text = text.select("at", "words")
    other = text.select(F.col("at").alias("to"), F.col("words").alias("to_words"))
    return map_arrow(pairs.join(text, "at").join(other, "to").select("at", "words", "to_words"), check, "at long").distinct()


def _met_elsewhere(keys: DataFrame, parts: int) -> DataFrame:
    """(h1, met) of lines (h1, keys), or of stretches of lines (``_NEAR``, ``_FAR``): the
    summed weights of their keys that a line with another h1 has too; equal lines count once.

    Keys are dealt into ``parts`` by hash and travel as arrays.  In a part 32 bits of a
    key do: keys taken for one another only add candidates.
    """

    def pack(held: list) -> pa.RecordBatch:
        key, h1, weight, row = (np.concatenate(v) for v in zip(*held))
        key = mix(key)
        code = ((key >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | (key & np.uint64(2**32 - 1))
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        new = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (row[1:] != row[:-1]))))
        weight = np.add.reduceat(weight[order], new).astype("<i4")
        code, h1 = code[new], h1[order][new]
        part, key = (code >> np.uint64(32)).astype("i4"), code.astype("<u4")
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        cols = [pa.array([x[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary()) for x in (key, h1, weight)]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), *cols], names=["part", "key", "h1", "weight"])

    def arrays(b: pa.RecordBatch):
        if b.num_columns == 4:
            for i in range(b.num_rows):
                yield tuple(np.frombuffer(c[i].as_buffer(), d) for c, d in zip(b.columns, ("<i8", "<i4", "<u8", "<i4")))
        else:
            own = b.column(1).flatten()
            yield np.asarray(b.column(0)), np.asarray(pc.list_value_length(b.column(1))), np.asarray(own.field("key")).view("u8"), np.asarray(own.field("weight"))

    def deal(batches):
        held, total, rows = [], 0, 0
        for h1, each, key, weight in (x for b in batches for x in arrays(b)):
            if not len(key):
                continue
            row = np.repeat(np.arange(len(h1)), each)
            held.append((key, h1[row], weight, row + rows))
            total, rows = total + len(key), rows + len(h1)
            if total >= PACK_KEYS:
                yield pack(held)
                held, total = [], 0
        if held:
            yield pack(held)

    def meet(t: pa.Table) -> pa.Table:
        key, h1, weight = (np.frombuffer(b"".join(t[c].to_pylist()), d) for c, d in (("key", "<u4"), ("h1", "<i8"), ("weight", "<i4")))
        order = np.argsort(key)
        key, h1 = key[order], h1[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        met = np.repeat(np.minimum.reduceat(h1, new) != np.maximum.reduceat(h1, new), np.diff(np.append(new, len(key))))
        key, h1, weight = key[met], h1[met], weight[order[met]]
        order = np.lexsort((key, h1))
        key, h1 = key[order], h1[order]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])))[: len(key)])
        h1, weight = h1[new], weight[order][new]  # equal lines have equal weights
        lines = np.flatnonzero(np.concatenate(([True], h1[1:] != h1[:-1]))[: len(h1)])
        lines, sums = h1[lines], np.add.reduceat(weight.astype("i8"), lines) if len(lines) else np.zeros(0, "i8")
        return pa.table({"h1": pa.array(lines, pa.int64()), "met": pa.array(sums)})

    packed = keys.mapInArrow(deal, "part int, key binary, h1 binary, weight binary")
    return packed.groupBy("part").applyInArrow(meet, "h1 long, met long").groupBy("h1").agg(F.sum("met").alias("met"))


def _candidates(keyed: DataFrame, lines: DataFrame, first: DataFrame) -> DataFrame:
    """(doc, line, at, near, far) of the distinct lines that may be alike to another,
    near: within one edit, far: within more; ``at`` goes up with document and line."""
    words = lines.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = 1 + words // PART_WORDS
    packed = keyed.where("near_lines is not null")
    near = written(_met_elsewhere(packed.select(*_NEAR), parts), "near-lines")
    far = written(_met_elsewhere(packed.select(*_FAR), parts), "far-lines")
    both = near.select("h1", F.lit(True).alias("near"), F.lit(0).cast("long").alias("met")).unionAll(far.select("h1", F.lit(False).alias("near"), "met"))
    met = both.groupBy("h1").agg(F.max("near").alias("near"), F.max("met").alias("met"))
    is_far = (F.col("n") >= 2 * STRETCH) & (F.col("met") >= F.col("n") - RUN + 1 - RUN * F.floor(F.col("n") / STRETCH))
    found = first.select("h1", "n", "first").join(met, "h1").select("first.doc", "first.line", "near", is_far.alias("far")).where("near or far")
    found = written(found, "candidates")
    wanted = written(found.orderBy("doc", "line").withColumn("at", F.monotonically_increasing_id()), "ranked")
    forget(near, far, found)
    return wanted


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc, line) of the lines that go; doc is the ``place`` of its document."""
    keyed = written(_lines(docs), "keyed-lines")
    lines = written(keyed.where("n is not null").select("doc", "line", "n", "h1", "h2"), "lines")
    first = lines.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("uses"))
    first = written(first, "distinct-lines")
    wanted = _candidates(keyed, lines, first)
    forget(keyed)
    text = written(_text(docs, wanted), "line-text")
    rare = _rare(text)
    apart = written(_apart(text), "apart")
    variants = written(_variants(apart), "variants")
    pairs = written(_alike(variants).unionAll(_with_earliest(rare)).distinct(), "alike")
    settled = written(_verified(pairs, text), "settled")
    rest = written(_with_all(rare, settled).join(pairs, ["at", "to"], "left_anti"), "rest")
    near = written(settled.unionAll(_verified(rest, text)).distinct().join(wanted, "at").select("doc", "line"), "near")
    forget(wanted, text, rare, apart, variants, pairs, settled, rest)
    # Of equal lines all but the first go in any case, so only those that repeat are looked up.
    again = lines.join(first.where("uses > 1").select("h1", "h2", "n", "first"), ["h1", "h2", "n"])
    again = again.where(F.struct("doc", "line") != F.col("first")).select("doc", "line")
    gone = written(again.unionAll(near).distinct(), "dropped")
    forget(lines, first, near)
    return gone


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The columns of documents with alike lines removed from ``text`` (n_chars
    follows), ``n_lines`` and ``n_dropped``.

    Texts that lose no line stay as they are, null included.  Rows of the same
    doc_id and text are one document and keep the same lines; rows of one doc_id
    with different texts are documents of their own, and so are those without an
    id, which come before all others.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = documents(docs)
    going = dropped_lines(docs).groupBy("doc").agg(F.collect_list("line").alias("gone"))  # a document's own lines
    # Most documents may lose a line, so this grows with them: Spark's threshold decides on a broadcast.
    both = docs.withColumn("doc", place(F.col("doc_id"), F.col("text"))).join(going.hint("shuffle_hash"), "doc", "left").drop("doc")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, sizes, n, dropped = [], [], [], []
        for text, n_chars, gone in zip(*(b.column(i).to_pylist() for i in (1, 4, 5))):
            rows = (text or "").split("\n")
            if gone:
                away = set(gone)
                text = "\n".join(r for i, r in enumerate(rows) if i not in away)
                n_chars = len(text)
            texts.append(text)
            sizes.append(n_chars)
            n.append(len(rows))
            dropped.append(len(gone or ()))
        cols = [b.column(0), pa.array(texts, b.schema.field(1).type), b.column(2), b.column(3), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:5], "n_lines", "n_dropped"])

    return map_arrow(both, run, "doc_id long, text string, lang string, source string, n_chars long, n_lines long, n_dropped long")


def without_alike_lines(docs: DataFrame) -> DataFrame:
    """The columns of documents, deduplicated; documents of which only blanks
    are left, because lines went, go too."""
    return documents(dedup_lines(docs).where(~((F.col("n_dropped") > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == ""))))
