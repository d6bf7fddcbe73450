"""Exact whole-text encoding with the ``tokenizers`` library, word by word.

Both vocabularies split a text before merging, and a blank that follows a
non-blank always starts a new piece.  So a text's ids are the ids of its
space-separated words one after the other (for the byte-level vocabulary each
word but the first with its leading space).  Words repeat, so each batch
encodes only its distinct words that the task has not met, and the ids are put
together with numpy.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Everything that any of the libraries' \s may match.
BLANK = "\t-\r\x1c-\x20\x85\xa0  -     　"
_NEXT_TO_SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE_RUN = f" {_NEXT_TO_SPACE}|{_NEXT_TO_SPACE} "
_CUT = re.compile(f"(?<=[^{BLANK}])(?=[ \\n\\t\\r])")
# A word that starts with a blank, has no other space and ends in no blank.
_SPACED = re.compile(f" [^{BLANK}](?:[^ ]*[^{BLANK}])?")
# One run of letters that no normal form joins or splits, and a mark: two pieces at most.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-į]+[,.;:!?]?")
_AT_ONCE = 2000  # words encoded together


# Letters whose lower case has one UTF-8 byte, or two that start with C3, and signs
# after them: a piece of its own, whatever the signs are.
_SIMPLE = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+[!-/:-@\[-`{-~]*\z"
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class LetterRanks:
    """Ids of lower-case words of ``_SIMPLE`` letters by tiktoken, for files that end
    a word with ``</w>`` and whose ids go up in the order of their merges.

    tiktoken merges bytes, and a letter that ends a word is another symbol than
    the same one inside it.  So each symbol is written as one ASCII character:
    a to z as they are, at an end as A to Z, the bytes of the other letters as
    characters that are no letters.  A word ends where an end symbol stands.
    """

    def __init__(self, file: dict):
        import tiktoken

        char = {b: c for c, b in byte_of().items()}
        spare = iter([c for c in map(chr, range(128)) if not c.isalpha()])
        letters = [chr(b) for b in range(ord("a"), ord("z") + 1)]
        inner = {c: c for c in letters} | {char[0xC3]: next(spare)}
        ends = {c: c.upper() for c in letters}
        others = [chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha()]
        for c in others:
            second = char[c.encode()[1]]
            inner[second], ends[second] = next(spare), next(spare)
        # Byte by byte, inside a word and at its end.
        self.inside, self.final = np.zeros(256, "u1"), np.zeros(256, "u1")
        for c in letters:
            self.inside[ord(c)], self.final[ord(c)] = ord(c), ord(ends[c])
        self.inside[0xC3] = ord(inner[char[0xC3]])
        for second in (c.encode()[1] for c in others):
            self.inside[second], self.final[second] = ord(inner[char[second]]), ord(ends[char[second]])
        ranks, last = {}, []
        for name, i in file["model"]["vocab"].items():
            whole = name.endswith("</w>")
            body, tail = (name[:-5], name[-5:-4]) if whole else (name, "")
            if all(c in inner for c in body) and (not whole or tail in ends):
                ranks["".join(inner[c] for c in body).encode() + (ends[tail].encode() if whole else b"")] = i
                last += [i] * whole
        close = "".join(f"\\x{{{ord(c):02x}}}" for c in ends.values())
        self.ranked = tiktoken.Encoding("letters", pat_str=f"[^{close}]*[{close}]", mergeable_ranks=ranks, special_tokens={})
        self.edge = np.zeros(max(ranks.values()) + 1, bool)
        self.edge[last] = True

    @staticmethod
    def fits(file: dict) -> bool:
        """Whether the merges' ids follow their order, after 512 single symbols."""
        model = file["model"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        return model.get("end_of_word_suffix") == "</w>" and not model.get("ignore_merges") and all(model["vocab"].get(m) == 512 + i for i, m in enumerate(merges))

    def encode(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all words, one letter or more each, and where each word's end."""
        words = pa.concat_arrays([pc.utf8_lower(words)])
        at = np.frombuffer(words.buffers()[1], "i8")[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2] or b"", "u1")[at[0] : at[-1]]
        last = at[1:] - at[0] - 1
        text = self.inside[raw]
        text[last] = self.final[raw[last]]
        ids = np.array(self.ranked.encode_ordinary(text.tobytes().decode("ascii")), "<u4")
        return ids, np.flatnonzero(self.edge[ids]) + 1


class WordEncoder:
    """Ids of whole texts by a ``tokenizers`` file, without special tokens added.

    ``byte_level``: blanks are part of the pieces (GPT-2 style).  Otherwise the
    vocabulary drops white space and words are separate.  Words met lately are
    kept in two generations; past ``memo`` words the older one goes, which costs
    time but changes no result.
    """

    def __init__(self, path: str, byte_level: bool, memo: int = 150_000, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = not special
        self.byte_level, self.limit, self.memo, self.older = byte_level, memo, {}, {}
        names = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(names.values()) + 1, bool)  # ids that start a word, or that end a piece
        for name, i in names.items():
            self.edge[i] = name.startswith("\u0120") if byte_level else name.endswith("</w>")
        self.letters = None
        if not byte_level:
            with open(path, encoding="utf-8") as f:
                file = json.load(f)
            if LetterRanks.fits(file):
                self.letters = LetterRanks(file)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words.  Words whose ids can be told apart in a text of many
        words are encoded as one text, which is the library's fastest way; the
        others, and any text where the count of words does not come out, apart."""
        apart = []
        whole = (_SPACED if self.byte_level else _LETTERS).fullmatch
        joined = [w for w in words if whole(w) or apart.append(w)]
        for i in range(0, len(joined), _AT_ONCE):
            part = joined[i : i + _AT_ONCE]
            text = ("" if self.byte_level else " ").join(part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.edge[ids])
            if self.byte_level:
                ends, found = np.append(at[1:], len(ids)), len(at)
            else:  # a mark is a piece of its own
                pieces = np.cumsum([1 if w[-1].isalpha() else 2 for w in part])
                found = len(part) if len(at) == pieces[-1] else -1
                ends = at[pieces - 1] + 1 if found > 0 else at
            if found != len(part):
                apart += part
                continue
            raw, lo = ids.tobytes(), 0
            for w, hi in zip(part, (4 * ends).tolist()):
                self.memo[w] = raw[lo:hi]
                lo = hi
        for i in range(0, len(apart), _AT_ONCE):
            part = apart[i : i + _AT_ONCE]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, at = np.array(got.ids, "<u4"), np.array(got.word_ids, "i8")
            ends = np.searchsorted(at, np.arange(1, len(part) + 1))
            raw, lo = ids.tobytes(), 0
            for w, hi in zip(part, (4 * ends).tolist()):
                self.memo[w] = raw[lo:hi]
                lo = hi

    def _ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``keys`` in a row, and each key's count."""
        if len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        memo, older, new = self.memo, self.older, []
        for k in dict.fromkeys(keys):
            if k not in memo:
                if k in older:
                    memo[k] = older[k]
                else:
                    new.append(k)
        self._learn(new)
        got = [memo[k] for k in keys]
        return np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), "i8", len(got)) // 4

    def _distinct(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, counts): word i has ``counts[i]`` ids from ``ids[starts[i]]`` on.
        Words of simple letters, and signs after them, come by merge ranks where the
        file allows: nothing is kept of them, and no step is taken word by word."""
        simple = np.zeros(len(words), bool)
        if self.letters is not None and len(words):
            simple = pc.match_substring_regex(words, _SIMPLE).to_numpy(zero_copy_only=False)
        rest, n = self._ids(words.filter(pa.array(~simple)).to_pylist())
        if not simple.any():
            return rest, np.cumsum(n) - n, n
        part = words.filter(pa.array(simple))
        stems = pc.utf8_rtrim(part, characters=_SIGNS)
        ids, ends = self.letters.encode(stems)
        count = np.diff(ends, prepend=0)
        # What follows the letters is one of few runs of signs.
        length = pc.binary_length(stems).to_numpy(zero_copy_only=False)
        signed = np.flatnonzero(pc.binary_length(part).to_numpy(zero_copy_only=False) > length)
        tails = pc.replace_substring_regex(part.take(pa.array(signed)), r"\A[^!-/:-@\[-`{-~]+", "").dictionary_encode()
        more, size = self._ids(tails.dictionary.to_pylist())
        code = np.array(tails.indices, "i8")
        each, at = size[code], (np.cumsum(size) - size)[code]
        upto = np.cumsum(each)
        take = np.repeat(at - (upto - each), each) + np.arange(len(code) and upto[-1])
        ids = np.insert(ids, np.repeat(ends[signed], each), more[take])
        count[signed] += each
        starts, counts = np.empty(len(words), "i8"), np.empty(len(words), "i8")
        starts[simple], counts[simple] = np.cumsum(count) - count, count
        starts[~simple], counts[~simple] = len(ids) + np.cumsum(n) - n, n
        return np.concatenate((ids, rest)), starts, counts

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.byte_level:  # white space of any kind parts words and is dropped
            texts = pc.replace_substring(texts, "\n", " ")
        pieces = pc.split_pattern(texts, " ")
        pieces = pieces.combine_chunks() if isinstance(pieces, pa.ChunkedArray) else pieces
        ends = np.asarray(pieces.offsets).astype("i8")
        ends -= ends[0]
        coded = pieces.flatten().dictionary_encode()
        code = np.array(coded.indices, "i8")
        if self.byte_level:
            words = coded.dictionary.to_pylist()
            first = ends[:-1]
            heads = [words[c] for c in code[first].tolist()]
            words = [" " + w for w in words] + heads
            code[first] = np.arange(len(words) - len(heads), len(words))
            ids, n = self._ids(words)
            at = np.cumsum(n) - n
        else:
            ids, at, n = self._distinct(coded.dictionary)
        each = n[code]
        upto = np.concatenate(([0], np.cumsum(each)))
        out = ids[np.repeat(at[code] - upto[:-1], each) + np.arange(upto[-1])]
        return out, upto[ends]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ``ids[offsets[i]:offsets[i + 1]]``; null is empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.empty(0, "<u4"), np.zeros(1, "i8")
        odd = np.asarray(pc.match_substring_regex(texts, SPACE_RUN).to_numpy(zero_copy_only=False), bool) if self.byte_level else np.zeros(len(texts), bool)
        if not odd.any():
            return self._words(texts)
        plain, upto = self._words(texts.filter(pa.array(~odd)))
        # Runs of blanks: cut only where a run starts, which is exact for every run.
        cuts = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        flat, n = self._ids([w for c in cuts for w in c])
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([0, *map(len, cuts)])]
        size = np.empty(len(texts), "i8")
        size[~odd], size[odd] = np.diff(upto), np.diff(ends)
        offsets = np.concatenate(([0], np.cumsum(size)))
        out, a, b = np.empty(offsets[-1], "<u4"), 0, 0
        for i, is_odd in enumerate(odd.tolist()):
            if is_odd:
                out[offsets[i] : offsets[i + 1]] = flat[ends[b] : ends[b + 1]]
                b += 1
            else:
                out[offsets[i] : offsets[i + 1]] = plain[upto[a] : upto[a + 1]]
                a += 1
        return out, offsets


#: How byte-level vocabularies of this kind cut a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_BLANK = re.compile(r"\s{10000}")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself
    if printable, otherwise 256 and on, in the bytes' order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankedEncoder:
    """``WordEncoder`` for byte-level files whose ids are the ranks of their
    merges: the ids of the ``tokenizers`` library, for every text, at a fraction
    of its time.  Texts with very long runs of blanks go to the library."""

    def __init__(self, path: str, file: dict, special: bool = True):
        import tiktoken

        self.library = WordEncoder(path, True, special=special)
        self.tokenizer = self.library.tokenizer
        of, named = byte_of(), {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(of[c] for c in name): i for name, i in file["model"]["vocab"].items() if name not in named}
        self.ranked = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=named)
        self.allowed = set(named) if special else set()

    @staticmethod
    def fits(file: dict) -> bool:
        """Whether the file's ids are the ranks of its merges, and all it does to
        a text before merging is to cut it by ``PATTERN``."""
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in file["model"]["merges"]]
        step, names = file.get("pre_tokenizer") or {}, file["model"]["vocab"]
        plain = file.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        whole = all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in file["added_tokens"])
        return bool(plain and whole and not file["model"].get("ignore_merges") and all(names.get(m) == 256 + i for i, m in enumerate(merges)))

    def _ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if _LONG_BLANK.search(text):
            return self.library.encode(pa.array([text], pa.large_string()))[0]
        return self.ranked.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``WordEncoder.encode``."""
        found = [self._ids(t) for t in texts.to_pylist()]
        offsets = np.concatenate((np.zeros(1, "i8"), np.cumsum([len(x) for x in found], dtype="i8")))
        return (np.concatenate(found).astype("<u4") if found else np.empty(0, "<u4")), offsets


_ENCODERS: dict[tuple, WordEncoder | RankedEncoder] = {}


def encoder(path: str, byte_level: bool, special: bool = True) -> WordEncoder:
    """One encoder for each file and worker process, kept between tasks.  Without
    ``special``, strings of special tokens inside texts are ordinary text."""
    key = path, byte_level, special
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, byte_level, special=special)
    return _ENCODERS[key]


def byte_encoder(path: str, special: bool = True) -> RankedEncoder | WordEncoder:
    """The encoder of a byte-level file that its contents allow, kept likewise."""
    key = path, "bytes", special
    if key not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        _ENCODERS[key] = RankedEncoder(path, file, special) if RankedEncoder.fits(file) else encoder(path, True, special)
    return _ENCODERS[key]
