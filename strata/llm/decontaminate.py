"""Benchmark decontamination by a generalised suffix automaton of the test items.

Test items are normalised to words and put into one automaton (every item
starts at the root).  Document words stream through it; after each word it
holds the longest run of words, ending there, that some item contains.  Words
that no item has send it back to the root, so only stretches of known words
that could hold a whole window are streamed: an exact shortcut.

The item table is taken in blocks of at most ``BLOCK_WORDS`` words.  A block's
automaton has at most twice as many states, which bounds what is broadcast;
further blocks are further passes over the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents, forget, map_arrow, small_batches, written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
WINDOW = 10
BLOCK_WORDS = 200_000


def words_of(text: str | None) -> list[str]:
    """A-Z lower-cased; runs of digits, a-z and non-ASCII characters."""
    return WORD.findall(text.translate(LOWER)) if text else []


class SuffixAutomaton:
    """Of word sequences, with what a scan for windows needs at each state."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: dict[str, int] = {}
        self.holders: dict[int, set] = {}  # state of a window -> items with it
        self.whole: dict[int, dict[int, set]] = {}  # state -> length of short items -> items

    def _append(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:  # an earlier item has this continuation
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        new, p = len(step) - 1, last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the strings of q that continue p's."""
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        copy = len(self.step) - 1
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    @classmethod
    def build(cls, items: list[tuple], window: int = WINDOW) -> SuffixAutomaton:
        """``items``: (id, words) pairs; those without words hold no window."""
        a = cls(window)
        coded = [(i, [a.vocabulary.setdefault(w, len(a.vocabulary)) for w in words]) for i, words in items if words]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = a._append(last, w)
        for i, ws in coded:
            state = 0
            for n, w in enumerate(ws, 1):
                state = a.step[state][w]
                if n >= window:
                    a.holders.setdefault(a._suffix(state, window), set()).add(i)
            if len(ws) < window:
                a.whole.setdefault(a._suffix(state, len(ws)), {}).setdefault(len(ws), set()).add(i)
        a.least = min([window, *(len(ws) for _, ws in coded)])
        return a

    def _suffix(self, state: int, n: int) -> int:
        """The state of the last n words of a match at ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def matches(self, ids: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, longest match ending there, state) for each known word."""
        step, link, length = self.step, self.link, self.length
        state, n = 0, 0
        for at, w in enumerate(ids):
            while w not in step[state]:
                state = link[state]  # the root has every known word
                n = length[state]
            state = step[state][w]
            n += 1
            yield at, n, state

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int, int]], set]:
        """((first, end, longest match) word spans hit by windows, disjoint and
        in order; the items whose windows occur)."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), "i8", len(words))
        known = np.concatenate(([0], ids >= 0, [0])).astype("i1")
        turn = np.flatnonzero(np.diff(known))
        begin, end = turn[::2], turn[1::2]
        long_ = end - begin >= self.least
        spans: list[list[int]] = []
        items: set = set()
        for lo, hi in zip(begin[long_].tolist(), end[long_].tolist()):
            for at, n, state in self.matches(ids[lo:hi].tolist()):
                size = 0
                if n >= self.window:
                    items |= self.holders[self._suffix(state, self.window)]
                    size = self.window
                if self.whole:
                    s = state
                    while s > 0:
                        for short, own in self.whole.get(s, {}).items():
                            if short <= n:
                                items |= own
                                size = max(size, short)
                        s = self.link[s]
                if size:
                    stop = lo + at + 1
                    if spans and stop - size <= spans[-1][1]:
                        # A short item may reach back before the span it joins.
                        while spans and stop - size <= spans[-1][1]:
                            old = spans.pop()
                            first, best = min(old[0], stop - size), max(old[2], n)
                            size = stop - first
                        spans.append([first, stop, best])
                    else:
                        spans.append([stop - size, stop, n])
        return [tuple(s) for s in spans], items


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """Items as (id, words), in blocks whose words are bounded; one at a time on the driver."""
    block, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        words = words_of(r["text"])
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r["item_id"], words))
        size += len(words)
    yield block


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("longest", pa.int64())]))
_FOUND = "n_words long, spans array<struct<first:long,stop:long,longest:long>>, items array<string>"


def joined(spans: list[tuple]) -> list[tuple]:
    """Ordered, with those that touch or overlap as one."""
    out: list[tuple] = []
    for first, stop, longest in sorted(spans):
        if out and first <= out[-1][1]:
            first, stop, longest = out[-1][0], max(stop, out[-1][1]), max(longest, out.pop()[2])
        out.append((first, stop, longest))
    return out


def _scanned(docs: DataFrame, items: DataFrame, window: int, block_words: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, spans and items; a pass for each block,
    written before the next, so that however many items there are no task holds
    more than one automaton."""
    small_batches(docs.sparkSession)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    width = len(docs.columns)
    before = None
    for i, block in enumerate(item_blocks(items, block_words)):
        if i:  # a task holds one block's automaton at a time
            docs, last = written(docs, "spans"), before
            if last is not None:
                forget(last)
            before = docs
        shared = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton.build(block, window))

        def scan(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            automaton, out = shared.value, []
            earlier = zip(*(b.column(width + i).to_pylist() for i in (1, 2))) if b.num_columns > width else ((None, None) for _ in range(b.num_rows))
            for text, (spans, found) in zip(b.column(1).to_pylist(), earlier):
                words = words_of(text)
                own, now = automaton.scan(words)
                if spans:
                    own = joined(own + [(s["first"], s["stop"], s["longest"]) for s in spans])
                now = {*(str(x) for x in now if x is not None), *(found or ())}
                out.append((len(words), [{"first": a, "stop": z, "longest": n} for a, z, n in own], sorted(now)))
            n, spans, found = zip(*out)
            return pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(n, pa.int64()), pa.array(spans, _SPANS), pa.array(found, pa.list_(pa.string()))], names=[*b.schema.names[:width], "n_words", "spans", "items"])

        docs = map_arrow(docs, scan, f"{schema}, {_FOUND}")
    return docs


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where windows of ``items`` (item_id, text) occur in ``docs`` (doc_id, text).

    A window is ``window`` consecutive words of an item, or all words of an
    item that has fewer (but some).  Returns a row for each row of ``docs``:
    doc_id, n_words, n_hit (words inside any occurrence), items (sorted ids as
    strings) and spans (first, stop: word positions; longest: longest match in
    it).  Null and empty texts have no words; an empty item table hits nothing.
    An item without an id hits like others but is not listed; rows of ``docs``
    without an id come back without one; no documents, no rows.
    """
    found = _scanned(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), items, window, block_words)
    return found.select("doc_id", "n_words", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.first)").alias("n_hit"), "items", "spans")


def remove_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (the columns of documents) without the items' passages.

    Spans hit by windows are cut out of the text together with the characters
    up to the next word; n_chars follows.  A document goes as a whole if more
    than ``max_coverage`` of its words are hit.  Others keep their text as is.
    """
    docs = documents(docs)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")

    def clean(b: pa.RecordBatch) -> pa.RecordBatch:
        keep, texts, sizes = [], [], []
        for text, n_chars, n_words, spans in zip(*(b.column(i).to_pylist() for i in (1, 4, 5, 6))):
            hit = sum(s["stop"] - s["first"] for s in spans)
            keep.append(hit <= max_coverage * n_words)
            if spans and keep[-1]:
                at = [m.span() for m in WORD.finditer(text.translate(LOWER))]
                pieces, last = [], 0
                for s in spans:
                    pieces.append(text[last : at[s["first"]][0]])
                    last = at[s["stop"]][0] if s["stop"] < len(at) else len(text)
                text = "".join([*pieces, text[last:]])
                n_chars = len(text)
            texts.append(text)
            sizes.append(n_chars)
        cols = [b.column(0), pa.array(texts, b.schema.field(1).type), b.column(2), b.column(3), pa.array(sizes, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=b.schema.names[:5]).filter(pa.array(keep))

    return map_arrow(_scanned(docs, items, window, block_words), clean, "doc_id long, text string, lang string, source string, n_chars long")
