"""Token counts by a compiled finite-state transducer, without encoding.

The byte-level BPE vocabulary is compiled into a deterministic transducer over
bytes.  Its state after a prefix holds, for each place where a token may still
be under way, the trie node reached from there, the last token of the prefix's
encoding up to there, and that prefix's token count relative to now.  A
transition by a byte carries the change of the token count, so the counts along
a path add up to the text's.  States and transitions are made when first met
(subset construction on demand) and kept by the worker.

Which token ends a prefix is decided exactly: a token may follow another only
if no merge crosses their border, which the merge ranks along the left token's
right spine and the right token's left spine tell.

Long texts are cut into chunks.  The pieces of the vocabulary's splitting
pattern cannot run across the start of a blank run, so every state goes to the
start state there.  A chunk's state map is therefore its head (up to the first
such place, to be read from whatever state enters), the count of its settled
middle, and its tail's state; maps compose associatively and are combined by a
prefix scan.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, small_batches
from strata.llm.vocab import BLANK, SPACE_RUN

#: The published splitting pattern of this vocabulary family (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_CHARS = 1 << 16
_CUT = re.compile(f"(?<=[^{BLANK}])(?=[ \\n\\t\\r])")


def byte_alphabet() -> dict[str, int]:
    """The vocabulary file's character for each byte: printable Latin-1 stands
    for itself, the others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Counts the tokens of byte strings that the splitting pattern leaves whole."""

    def __init__(self, path: str, max_states: int = 250_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_alphabet()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        raw = lambda s: bytes(of[c] for c in s)
        # Tokens are numbered by merge rank: bytes first, then each merge's product.
        number = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        known = spec["model"]["vocab"]
        for left, right in merges:
            if left + right not in known:
                continue
            a, b, both = number.get(raw(left)), number.get(raw(right)), raw(left) + raw(right)
            if a is None or b is None:
                continue
            new = len(self.parts)
            self.rank.setdefault((a, b), new)
            if both not in number:
                number[both] = new
                self.parts.append((a, b))
            else:
                self.parts.append(None)  # a second way to a known token keeps its rank
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for s, t in number.items():
            node = 0
            for c in s:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = self.child[node][c]
            self.token[node] = t
        self.max_states = max_states
        self._borders: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((0, -1, 0),)
        self.states: list[tuple] = [start]
        self.numbered = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _spine(self, t: int, side: int) -> list[int]:
        """Symbols at one edge of token t as its merges go on, the token last."""
        out = [t]
        while self.parts[t] is not None:
            t = self.parts[t][side]
            out.append(t)
        return out[::-1]

    def _border(self, s: int, t: int) -> bool:
        """Whether no merge crosses the border between tokens s and t."""
        left, right = self._spine(s, 1), self._spine(t, 0)
        i = j = 0
        while True:
            ends_left = left[i + 1] if i + 1 < len(left) else 1 << 60
            ends_right = right[j + 1] if j + 1 < len(right) else 1 << 60
            # A number is a rank: the crossing merge happens if it comes before
            # the symbols are merged within their tokens; of equal merges the
            # leftmost comes first.
            cross = self.rank.get((left[i], right[j]))
            if cross is not None and cross < ends_left and cross <= ends_right:
                return False
            if ends_left == ends_right == 1 << 60:
                return True
            if ends_left <= ends_right:
                i += 1
            else:
                j += 1

    def _follows(self, s: int, t: int) -> bool:
        if t not in self._whole:  # a token may itself be unreachable by merges
            p = self.parts[t]
            self._whole[t] = p is None or (self._follows(-1, p[0]) and self._follows(-1, p[1]) and self._reached(t))
        if not self._whole[t] or s < 0:
            return self._whole[t]
        if (s, t) not in self._borders:
            if len(self._borders) > 2_000_000:
                self._borders.clear()
            self._borders[s, t] = self._border(s, t)
        return self._borders[s, t]

    def _reached(self, t: int) -> bool:
        """Whether merging the bytes of t by rank gives t."""
        symbols, stack = [], [t]
        while stack:
            x = stack.pop()
            if self.parts[x] is None:
                symbols.append(x)
            else:
                stack += [self.parts[x][1], self.parts[x][0]]
        while len(symbols) > 1:
            at = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            r = self.rank.get((symbols[at], symbols[at + 1]))
            if r is None:
                return False
            symbols[at : at + 2] = [r]
        return symbols[0] == t

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        live, found = [], None
        for node, last, behind in self.states[state]:
            to = self.child[node].get(byte)
            if to is None:
                continue
            live.append((to, last, behind))
            t = self.token[to]
            if found is None and t >= 0 and self._follows(last, t):
                found = (t, behind + 1)  # the one encoding of the longer prefix
        t, change = found
        key = (*((node, last, behind - change) for node, last, behind in live if self.child[node]), (0, t, 0))
        to = self.numbered.get(key)
        if to is None:
            to = self.numbered[key] = len(self.states)
            self.states.append(key)
        return to, change

    def run(self, data: bytes, state: int = 0) -> tuple[int, int]:
        """(end state, tokens emitted) of reading ``data`` from ``state``."""
        moves, total = self.moves, 0
        for byte in data:
            got = moves.get(state << 8 | byte)
            if got is None:
                got = moves[state << 8 | byte] = self._move(state, byte)
            state = got[0]
            total += got[1]
        return state, total

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.max_states:
            self._reset()
        return self.run(piece)[1]


@dataclass(frozen=True)
class StateMap:
    """What a chunk does to the text around it: ``head`` and ``tail`` are still
    open (they may join with a neighbour's); ``settled`` tokens are not.  Without
    a reset inside, the chunk is all head and ``tail`` is None."""

    head: str
    settled: int = 0
    tail: str | None = None


class TokenCounter:
    """Tokens of whole texts as the ``tokenizers`` library counts them."""

    def __init__(self, path: str, memo: int = 300_000):
        self.transducer = Transducer(path)
        self.split = regex.compile(PATTERN)
        self.special = re.compile("|".join(map(re.escape, self.transducer.specials))) if self.transducer.specials else None
        self.limit, self.memo, self.older = memo, {}, {}

    def _piece(self, text: str) -> int:
        """Tokens of a stretch between resets."""
        if self.special and (cut := self.special.search(text)):
            return self._piece(text[: cut.start()]) + 1 + self._piece(text[cut.end() :])
        return sum(self.transducer.count(p.encode("utf-8", "surrogatepass")) for p in self.split.findall(text))

    def stretch(self, text: str) -> int:
        n = self.memo.get(text)
        if n is None:
            if len(self.memo) > self.limit:  # the words met lately stay, as the older generation
                self.memo, self.older = {}, self.memo
            n = self.older.get(text)
            n = self.memo[text] = self._piece(text) if n is None else n
        return n

    def settled(self, text: str) -> int:
        """Tokens of a text that starts and ends at resets."""
        return sum(map(self.stretch, _CUT.split(text))) if text else 0

    def state_map(self, chunk: str) -> StateMap:
        cuts = [m.start() for m in _CUT.finditer(chunk)]
        if not cuts:
            return StateMap(chunk)
        return StateMap(chunk[: cuts[0]], self.settled(chunk[cuts[0] : cuts[-1]]), chunk[cuts[-1] :])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None and b.tail is None:
            return self.state_map(a.head + b.head)  # a reset may lie at their border
        if a.tail is None:
            both = self.state_map(a.head + b.head)
            if both.tail is None:
                return StateMap(both.head, b.settled, b.tail)
            return StateMap(both.head, both.settled + self.stretch(both.tail) + b.settled, b.tail)
        between = self.state_map(a.tail + b.head)
        if b.tail is None:
            if between.tail is None:
                return StateMap(a.head, a.settled, between.head)
            return StateMap(a.head, a.settled + self.stretch(between.head) + between.settled, between.tail)
        inner = self.stretch(between.head) + (0 if between.tail is None else between.settled + self.stretch(between.tail))
        return StateMap(a.head, a.settled + inner + b.settled, b.tail)

    def total(self, m: StateMap) -> int:
        if not m.head and m.tail is None:
            return 0
        return (self.stretch(m.head) if m.head else 0) + m.settled + (self.stretch(m.tail) if m.tail else 0)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Inclusive prefix scan by doubling: every round composes neighbours
        that are 1, 2, 4, ... chunks apart, independently of one another."""
        step = 1
        while step < len(maps):
            maps = [maps[i] if i < step else self.compose(maps[i - step], maps[i]) for i in range(len(maps))]
            step *= 2
        return maps

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        if len(text) <= chunk_chars:
            return self.settled(text)
        return self.total(self.scan([self.state_map(text[i : i + chunk_chars]) for i in range(0, len(text), chunk_chars)])[-1])

    def counts(self, texts: pa.Array, chunk_chars: int = CHUNK_CHARS) -> np.ndarray:
        """Of a column of texts (null: 0), distinct stretches of a batch together."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        out = np.zeros(len(texts), "i8")
        if not len(texts):
            return out
        # The cut of _CUT at single spaces, done by Arrow: exact where no other
        # blank touches a space.  Other texts and long ones go one by one.
        plain = np.asarray(pc.invert(pc.or_(pc.match_substring_regex(texts, SPACE_RUN), pc.greater(pc.utf8_length(texts), chunk_chars))).to_numpy(zero_copy_only=False), bool)
        for i, t in zip(np.flatnonzero(~plain).tolist(), texts.filter(pa.array(~plain)).to_pylist()):
            out[i] = self.count(t, chunk_chars)
        pieces = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        ends = np.asarray(pieces.offsets).astype("i8")
        coded = pieces.flatten().dictionary_encode()
        words, code = coded.dictionary.to_pylist(), np.array(coded.indices, "i8")
        if len(code):
            spaced = np.array([self.settled(" " + w) for w in words], "i8")[code]
            first = ends[:-1] - ends[0]
            spaced[first] = [self.settled(words[c]) for c in code[first].tolist()]
            out[plain] = np.add.reduceat(spaced, first)
        return out


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One for each vocabulary and worker process, kept between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of ``docs``.

    Reads doc_id and text.  Null text is empty: no bytes and no tokens.  Rows
    are independent: repeated ones repeat, an empty table gives no rows.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counter(tokenizer).counts(b.column(2)))], names=["doc_id", "n_bytes", "n_tokens"])

    small_batches(docs.sparkSession, 2000)
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    got = map_arrow(docs.select(F.col("doc_id").cast("long"), size.alias("n_bytes"), "text"), run, "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
