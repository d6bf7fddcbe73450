"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import align, centroids, queries, simhash
from strata.llm.vocab import RankedEncoder, WordEncoder, byte_encoder, byte_of

SF = "/root/testdata/sf0.001"
BYTE, PIECE = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")
DOCS = "doc_id long, text string"


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


# --- 11: alignment


def align_brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_tokens, b_tokens = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_tokens.encode_special_tokens = True
    of, names = byte_of(), {i: n for n, i in a_tokens.get_vocab().items()}

    def bytes_a(i):
        return names[i].encode() if i == 50256 else bytes(of[c] for c in names[i])

    def bytes_b(i):
        piece = b_tokens.id_to_piece(i)
        m = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        a, b, groups = [], [], []
        if text:
            a, b, raw = a_tokens.encode(" " + text, add_special_tokens=False).ids, b_tokens.encode(text), (" " + text).encode()
            if b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
                a, b = [], []
            ends = [np.cumsum([len(f(i)) for i in ids]) for f, ids in ((bytes_a, a), (bytes_b, b))]
            place = [0, 0]
            for e in sorted(set(ends[0].tolist()) & set(ends[1].tolist())):
                upto = [int(np.searchsorted(at, e)) + 1 for at in ends]
                groups.append([ids[p:q] for ids, p, q in zip((a, b), place, upto)])
                place = upto
        docs.append((doc_id, a, b, groups))
    count = Counter()
    for *_, groups in docs:
        count.update({(x, y) for xs, ys in groups for x in xs for y in ys})
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, a, b, groups in docs:
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(count[k] == best[k[0]] for k in links), sum(count[k] for k in links), digest))
    return by_text(out)


ODD_TEXTS = [
    (1, "Hello <|endoftext|> wörld\n\n  tabs\tand <s> 漢字 x"),
    (2, "Hello <|endoftext|> wörld\n\n  tabs\tand <s> 漢字 ▁ x"),  # B gives a space back
    (None, "a a a b"),
    (3, None),
    (3, ""),
    (4, "<0x41> 😀😀 ﬁ é é"),
    (5, "a" * 5000 + " b" + " " * 30 + "c"),
    (5, "a" * 5000 + " b" + " " * 30 + "c"),
    (6, "日本語" * 300 + " x\r\ny"),
    (7, " lead"),
    (8, "trail "),
    (9, "x y " * 2000),
]


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(align, "PART", 500)  # long texts are encoded in parts
    docs = spark.createDataFrame(ODD_TEXTS, DOCS).withColumn("pairs", F.lit(1)).withColumn("row", F.lit("x"))
    got = by_text(align.align(docs, BYTE, PIECE).collect())
    assert got == align_brute(ODD_TEXTS)
    assert [r[1:4] for r in got if r[0] == 2] == [(0, 0, 0)]
    assert align.align(docs.limit(0), BYTE, PIECE).collect() == []


def test_alignment_of_whole_table(spark, monkeypatch):
    """With all, some and no pairs sent to all executors."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = align_brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    for heavy in (500_000, 300, 0):
        monkeypatch.setattr(align, "HEAVY", heavy)
        assert by_text(queries.op11_token_windows(spark, SF).collect()) == want


def test_window_memo_forgets_without_changing_results():
    v = align.Vocabularies(BYTE, PIECE)
    texts = [f"word{i} other{i} shared words, and more" for i in range(200)]
    fresh, small = align.Windows(v), align.Windows(v)
    whole = align.aligned(texts, fresh)
    parts = []
    for i in range(0, 200, 10):
        small.forget()
        parts += align.aligned(texts[i : i + 10], small)
    key = lambda r: (*r[:5], r[5].tolist(), r[6].tolist())
    assert [key(r) for r in whole] == [key(r) for r in parts]
    assert len(fresh.text) < sum(len(t.split()) for t in texts)


@pytest.mark.parametrize("special", [True, False])
def test_ranked_encoder_has_the_library_ids_at_every_code_point(special):
    """Every code point beside letters, digits, quotes, blanks and itself, and long runs."""
    encoder = byte_encoder(BYTE, special)
    assert isinstance(encoder, RankedEncoder)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1{c}{c}'{c}  {c}x" for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    texts += [" " * 30_000 + "x", "\n" * 9_000 + "y", "a" * 50_000, "<|endoftext|> it's <|endoftext|>x", "x \n\n  y\t ", "a <|endoftext|><|endoftext|>", "", None]
    library = encoder.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    ids, at = encoder.encode(pa.array(texts))
    for i, theirs in enumerate(library):
        assert ids[at[i] : at[i + 1]].tolist() == theirs.ids


def test_other_files_are_left_to_the_library():
    assert isinstance(byte_encoder(queries.vocabulary("byte_bpe_50k.json")), RankedEncoder)
    with open(queries.vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        assert not RankedEncoder.fits(json.load(f))


def test_long_groups_are_counted_by_distinct_ids(monkeypatch):
    v = align.Vocabularies(BYTE, PIECE)
    texts = ["日本語漢字仮名交 aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa word, word", "plain words and 日本語"]
    want = align.aligned(texts, align.Windows(v))
    monkeypatch.setattr(align, "WIDE", 1)
    got = align.aligned(texts, align.Windows(v))
    key = lambda r: (*r[:5], r[5].tolist(), r[6].tolist())
    assert [key(r) for r in got] == [key(r) for r in want]


def test_a_long_text_in_parts_has_the_ids_of_the_whole():
    v = align.Vocabularies(BYTE, PIECE)
    text = "wörd  two\n three, " * 60_000  # over a million characters
    assert v.apart
    assert v.encode_b([text])[0].tolist() == v.b.encode(text)
    assert v.encode_a([text])[0].tolist() == v.a.tokenizer.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("special", [True, False])
def test_words_encoded_together_have_the_library_ids(spark, name, byte_level, special):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["x <|endoftext|>y <|endoftext|> z", "a\n b  c\td \n", "", " ", " x", "y ", "İstanbul ǅ naïve é don't 3.5 Ä, I'll", "  a  b　c", "a\nb c\nd \x1c e\x1c f", "<|startoftext|>q w<|endoftext|>"]
    encoder = WordEncoder(queries.vocabulary(name), byte_level, special=special)
    ids, at = encoder.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t[:50]


# --- 12: bit-sliced SimHash


def fingerprint_brute(text: str) -> int:
    raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode())
    words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_linked(fp: np.ndarray, radius: int) -> np.ndarray:
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    label = np.arange(len(fp))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new[new]


def simhash_brute(rows):
    fps = [fingerprint_brute(t or "") for _, t in rows]
    label = least_linked(np.array(fps, "u8"), 4)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(least.get(label[i], doc_id), doc_id)
    return by_text((d, f"{fps[i]:016x}", least.get(label[i])) for i, (d, _) in enumerate(rows))


def test_fingerprint_equals_brute_force(monkeypatch):
    monkeypatch.setattr(simhash, "STRETCH", 7)
    for t in ["", " \n", "a", "A b  c", " x y z w v\n", "a b c d e f g h " * 50, "é Ü A\x0bB ß\x00 q r s t"]:
        assert simhash.fingerprint(t.encode()) == fingerprint_brute(t), t


def test_spark_hash_is_the_same(spark):
    words = "a b c d"
    want = spark.range(1).select(F.xxhash64(F.lit(words))).first()[0]
    assert xxhash.xxh64_intdigest(words, 42) == want % 2**64


@pytest.mark.parametrize("radius", range(8))
def test_bit_slices_equal_pairwise_distances(radius):
    rng = np.random.default_rng(radius)
    fp = rng.integers(0, 2**64 - 1, 300, dtype="u8")
    for i in range(1, 200):  # near the first, at 0 to 9 flips
        for b in rng.integers(0, 64, rng.integers(0, 10)):
            fp[i] = (fp[0] if not i % 3 else fp[i]) ^ np.uint64(1 << int(b))
    assert (simhash._linked(fp, np.zeros(300, "i8"), radius) == least_linked(fp, radius)).all()
    group = np.repeat([0, 1, 2], [65, 3, 232])
    want = np.concatenate([lo + least_linked(fp[lo:hi], radius) for lo, hi in ((0, 65), (65, 68), (68, 300))])
    assert (simhash._linked(fp, group, radius) == want).all()


def test_keys_lose_no_link():
    """Any ``radius`` flipped bits leave one key's bits as they are."""
    rng = np.random.default_rng(5)
    for parts in range(5, 13):
        bits = [m % 2**64 for m in simhash.masks(parts, 4)]
        assert len(bits) == math.comb(parts, 4)
        for _ in range(200):
            flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not m & flipped for m in bits)


@pytest.mark.parametrize("chunk,parts", [(2048, None), (16, None), (16, 6)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, chunk, parts):
    """Also with large buckets dealt into chunks, and with more parts."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    if parts:
        monkeypatch.setattr(simhash, "best_parts", lambda n, radius: parts)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(1000 + i, " ".join(f"w{j}" for j in range(60)) + (f" x{i}" if i % 3 else "")) for i in range(150)]
    rows += [(None, "q q q"), (None, None), (5000, ""), (7000, "q q q"), (7000, "q q q"), (None, "alone with nobody else at all")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("x")).withColumn("key", F.lit(1))
    assert by_text(simhash.near_duplicates(docs).collect()) == simhash_brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_a_long_text_is_hashed_in_stretches():
    text = "one two three four five six " * 100_000  # 600,000 words, over two stretches
    few = fingerprint_brute("one two three four five six " * 40)
    assert simhash.fingerprint(text.encode()) == few  # the same six shingles, the same majority


# --- 13: centroids


def clusters_brute(rows, k, rounds=3, width=64):
    kept = [(i, [math.floor(64 * x) if abs(x) < 2**50 else int(x) * 64 for x in v]) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    at = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        at = [[sum(c) // len(c) for c in zip(*[v for (_, v), o in zip(kept, of) if o == j])] or old for j, old in enumerate(at)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    fits = lambda n: n if n < 2**63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return by_text((i, j, fits(d), fits(inertia[j]), fits(sum(inertia.values())), sha[j]) for i, d, j in found)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [round(float(x), 2) for x in rng.normal(i % 3, 1, 64)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 64) for i in range(5)]  # equal vectors, ties
    rows += [(None, [0.25] * 64), (1, [0.1] * 63), (2, None), (3, [float("nan")] * 64), (4, [None] * 64), (5, [float("inf")] * 64), (6, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit(9)).withColumn("v", F.lit("x"))
    for k in (1, 5, 16):
        assert by_text(centroids.cluster(docs, k).collect()) == clusters_brute(rows, k)
    assert centroids.cluster(docs.limit(0)).collect() == []
    few = docs.where("vec_id < 2 and size(embedding) = 64")
    assert {r["cluster"] for r in centroids.cluster(few).collect()} <= {0, 1}


def test_zero_favours_the_smaller_number():
    x = np.array([[0.0] * 64, [3.0] * 64, [1.0] * 64])
    planes = centroids.Bisectors([[2] * 64, [-2] * 64, [2] * 64, [4] * 64])
    best, apart = planes.nearest(x)
    assert best.tolist() == [0, 0, 0] and apart.tolist() == [256.0, 64.0, 64.0]
    assert planes.nearest(x.astype("i8").astype(object))[0].tolist() == [0, 0, 0]


def test_huge_components_are_exact(spark):
    """Components whose squares pass doubles and longs: clusters by exact integers."""
    rows = [(i, [float(1 << 40) + (i % 2) * 0.25] * 64) for i in range(10)] + [(20 + i, [(1e300 if i % 2 else -3.5)] * 64) for i in range(6)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (2, 4):
        got = by_text(centroids.cluster(docs, k).collect())
        want = clusters_brute(rows, k)
        assert [r[:3] + r[5:] for r in got] == [r[:3] + r[5:] for r in want]


def test_clusters_equal_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op13_bisector_tournament(spark, SF)
    want = con.execute(queries.ORACLE["op13_bisector_tournament"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert by_text(got.select(*names).collect()) == by_text(want.fetchall())
