"""The training-text operators against brute force, round trips and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import decontaminate, fingerprint, license_scan, line_dedup, ngram_join, packing, quality_crf, tokencount, tokenfile, toxicity
from strata.llm.common import connected_components, scratch, slices, table
from strata.llm.queries import QUERIES, vocabulary
from strata.llm.vocab import WordEncoder

DOC = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [None, "", " ", "a", "a b", "A\tb", "é ü\n\nß", "  two  blanks ", "x\x00y \x1c z", "word " * 3000, "<|endoftext|> tail<|endoftext|>", "한국어 텍스트 😀", "tie tie tie", "tie tie tie"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOC)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, repeated rows, and columns whose names the operators use inside."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(AWKWARD)] + [(3, "a", "en", "s", 1), (None, "no id here", None, None, None), (None, None, None, None, None)]
    extra = ("key", "id", "n", "range", "salt", "gap", "u", "spans", "score", "sketch", "component")
    return spark.createDataFrame(rows, DOC).withColumns({c: F.lit("x") for c in extra})


LABELS = "doc_id long, toxic int, quality int"


def runs(spark):
    """Every operator as a function of documents."""
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(14)] + [(None, 1, 1), (2, None, None)], LABELS)
    items = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, "tie tie")], "item_id long, text string")

    def files(docs):
        path = scratch(spark, "t")
        tokenfile.write_token_files(docs, path, vocabulary("word_bpe_49k.json"))
        return tokenfile.read_token_files(spark, path)

    return {
        "op1": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "op2": files,
        "op3": lambda d: decontaminate.find_items(d, items),
        "op4": lambda d: packing.pack(d, vocabulary("byte_bpe_50k.json")),
        "op5": line_dedup.dedup_lines,
        "op6": fingerprint.edited_fingerprints,
        "op7": lambda d: tokencount.count_tokens(d, vocabulary("byte_bpe_50k.json")),
        "op8": license_scan.scan_licenses,
        "op9": ngram_join.link,
        "op10": lambda d: quality_crf.score(d, quality_crf.fit(d, labels)),
        "stage1": lambda d: toxicity.without_toxic(d, labels),
        "stage2": line_dedup.without_alike_lines,
        "stage3": ngram_join.without_near_copies,
        "stage4": lambda d: decontaminate.remove_items(d, items),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "stage1", "stage2", "stage3", "stage4"])
def test_awkward_rows_and_empty_tables(spark, awkward, name):
    run = runs(spark)[name]
    rows = run(awkward).collect()
    if name.startswith("op"):
        assert len(rows) == awkward.count() or name == "op4"
        assert Counter(r["doc_id"] for r in rows if name != "op4" or r["piece"] == 0) == Counter(r["doc_id"] for r in awkward.select("doc_id").collect())
    assert run(awkward.limit(0)).count() == 0


def brute_links(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 50)])
def test_join_components_match_brute_force(spark, monkeypatch, words, percent):
    rng = random.Random(3)
    rows = []
    for i in range(250):
        base = random.Random(rng.randint(0, 12))
        w = [base.choice("abcdefghijklmn") + base.choice("abcdefgh") for _ in range(base.randint(1, 60))]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            k = rng.randrange(len(w))
            w = w[:k] + [rng.choice("xyz")] * rng.randint(0, 1) + w[k + 1 :] or ["q"]
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "BLOCK", 8)  # several blocks and dense lists
    monkeypatch.setattr(ngram_join, "DENSE", 1)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()}
    assert got == brute_links(rows, words, percent)


def test_boundary_is_where_enumeration_gets_dearer():
    assert ngram_join.boundary(90) == 18 and ngram_join.boundary(80) == 8


def test_sketch_differences_never_exceed_set_differences():
    rng = np.random.default_rng(1)
    for n in (5, 300, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype("u8"))
        b = np.unique(np.concatenate((a[n // 7 :], rng.integers(0, 2**63, n // 9).astype("u8"))))
        rows = ngram_join.folded([ngram_join.sketch(a, 90), ngram_join.sketch(b, 90)])
        assert int(np.bitwise_count(rows[0] ^ rows[1]).sum()) <= len(np.setxor1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_slices_bound_bytes_and_lose_no_row():
    texts = ["Ünïcode " * k for k in (1, 500, 3, 0, 9000, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "t"])
    parts = list(slices(batch, 5000))
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts and len(parts) > 2


def test_shingles_of_a_sliced_column_equal_those_of_a_copy():
    texts = ["Éa ÇB c d", "one two three FOUR", "ß à é"] * 50
    whole = ngram_join.shingle_sets(pa.array(texts), 2)
    part = ngram_join.shingle_sets(pa.array(texts).slice(31, 40), 2)
    assert all((x == y).all() for x, y in zip(part, whole[31:71]))


@pytest.mark.parametrize("file,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_word_encoder_equals_the_library(file, byte_level):
    rng = random.Random(1)
    parts = ["a", " ", "  ", "\n", " \n", "\t", "é", "é", "<|endoftext|>", "12", "'s", "!", " ", "\x1c", "\x85", "中", "ing", "　", "Σ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(600)] + [None, ""]
    own = WordEncoder(vocabulary(file), byte_level, memo=50)
    for lo in range(0, len(texts), 100):
        ids, at = own.encode(pa.array(texts[lo : lo + 100]))
        for i, t in enumerate(texts[lo : lo + 100]):
            assert ids[at[i] : at[i + 1]].tolist() == own.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_transducer_counts_and_chunk_maps_equal_the_library():
    rng = random.Random(4)
    parts = ["a", " ", "  ", "\n", "\t", "é", "<|endoftext|>", "12", "'s", "!", " ", "\x1c", "The", "ing", "aaaa", "####", "😀", "   "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(500)] + ["a" * n for n in range(30)]
    library, own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), tokencount.TokenCounter(vocabulary("byte_bpe_50k.json"))
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.counts(pa.array(texts)).tolist() == want
    for chunk in (1, 3, 8):
        assert [own.count(t, chunk) for t in texts] == want


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    for ids in (np.empty(0, "u4"), np.zeros(999, "u4"), rng.integers(0, 50, 30_000).astype("u4"), rng.integers(0, 49_000, 5000).astype("u4")):
        cut = np.array([len(ids) // 3, len(ids) - len(ids) // 3])
        shard = tokenfile.Shard.from_bytes(tokenfile.Shard.build([5, None], cut, ids).to_bytes())
        assert (shard.ids() == ids).all() and (shard.document(1) == ids[cut[0] :]).all()
        for lo, hi in ((0, 1), (17, 400), (len(ids) // 2, len(ids))):
            assert (shard.ids(min(lo, len(ids)), min(hi, len(ids))) == ids[lo:hi]).all()
    assert len(tokenfile.repair(np.tile(np.arange(8), 4000))[3]) < 32_000 / 8


def test_token_files_start_where_earlier_documents_end(spark):
    texts = [f"some words {i} " * (i % 7) for i in range(60)] + [None]
    path = scratch(spark, "t")
    tokenfile.write_token_files(frame(spark, texts), path, vocabulary("word_bpe_49k.json"), shard_ids=50)
    rows = sorted(tokenfile.read_token_files(spark, path).collect())
    library, at = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0
    for r, t in zip(rows, texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert tuple(r) == (r.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def best_fit_bins(items, capacity):
    left = []
    for s in sorted(items, reverse=True):
        fits = [i for i, x in enumerate(left) if x >= s]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= s
        else:
            left.append(capacity - s)
    return len(left)


def test_plan_places_all_within_capacity_and_no_worse_than_best_fit():
    rng = random.Random(5)
    for _ in range(120):
        capacity = rng.choice([10, 30, 100])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 50))]
        runs_, bins = packing.plan(Counter(items), capacity).tolist(), defaultdict(list)
        for length, n in Counter(items).items():
            for rank in range(n):
                r = max((x for x in runs_ if x[0] == length and x[1] <= rank), key=lambda x: x[1])
                bins[r[3] + (rank - r[1]) // r[2]].append((r[4] + (rank - r[1]) % r[2] * length, length))
        for placed in bins.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= capacity
        assert -(-sum(items) // capacity) <= len(bins) <= best_fit_bins(items, capacity)


def optimal_bins(items, capacity):
    best = [len(items)]

    def place(i, left):
        if len(left) >= best[0]:
            return
        if i == len(items):
            best[0] = len(left)
            return
        for k in range(len(left)):
            if left[k] >= items[i]:
                place(i + 1, left[:k] + [left[k] - items[i]] + left[k + 1 :])
        place(i + 1, [*left, capacity - items[i]])

    place(0, [])
    return best[0]


def test_fixed_sets_cost_no_bin():
    rng = random.Random(6)
    for _ in range(60):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 7))), reverse=True)
        count = np.bincount(items, minlength=13)
        fixed = sum(n for n, _ in packing.dominance_reduction(count, 12))
        rest = np.repeat(np.arange(13), count)[::-1].tolist()
        assert fixed + (optimal_bins(rest, 12) if rest else 0) == optimal_bins(items, 12)


def test_packed_sequences_are_gapless(spark):
    rows = packing.pack(frame(spark, ["word " * n for n in (0, 1, 5, 900, 2047, 2048, 5000)] + [None]), vocabulary("byte_bpe_50k.json")).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
        assert r.length == 2048 or r.piece == 0
    for placed in by.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))] and sum(n for _, n in placed) <= 2048


def test_automaton_windows_match_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        window, letters = rng.choice([2, 3, 4]), "abc"[: rng.randint(1, 3)]
        items = [(i, [rng.choice(letters) for _ in range(rng.randint(0, 8))]) for i in range(rng.randint(0, 6))]
        doc = [rng.choice(letters + "x") for _ in range(rng.randint(0, 25))]
        hit, found = set(), set()
        for i, x in items:
            for q in [x[j : j + window] for j in range(len(x) - window + 1)] if len(x) >= window else [x] * bool(x):
                for j in range(len(doc) - len(q) + 1):
                    if doc[j : j + len(q)] == q:
                        hit |= set(range(j, j + len(q)))
                        found.add(i)
        spans, got = decontaminate.SuffixAutomaton.build(items, window).scan(doc)
        assert got == found and [k for a, z, _ in spans for k in range(a, z)] == sorted(hit)


def test_blocks_of_items_give_one_answer(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{(i * 3 + k) % 40}" for k in range(12))) for i in range(10)], "item_id long, text string")
    docs = frame(spark, [" ".join(f"w{k % 40}" for k in range(s, s + 60)) + " other words" for s in range(8)] + ["clean text"])
    one, many = (sorted(map(str, decontaminate.find_items(docs, items, block_words=n).collect())) for n in (10**6, 20))
    assert one == many
    kept = {r.doc_id: r.text for r in decontaminate.remove_items(docs, items, max_coverage=1.0, block_words=20).collect()}
    assert kept[8] == "clean text" and all(re.fullmatch(r"(w\d+ )?other words", kept[i].strip()) for i in range(8))


def test_lines_match_brute_force(spark):
    rng, rows = random.Random(5), []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 8)):
            base = random.Random(rng.randint(0, 25))
            w = [base.choice("abcdefgh") for _ in range(base.randint(0, 14))]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w = w[:k] + [rng.choice("xyz")] * rng.randint(0, 1) + w[k + rng.randint(0, 1) :]
            lines.append(rng.choice(["", " "]) + " ".join(w))
        rows.append("\n".join(lines))
    first = {}
    for i, t in enumerate(rows):
        for k, line in enumerate(t.split("\n")):
            if len(w := tuple(line.split())) >= line_dedup.MIN_WORDS:
                first.setdefault(w, (i, k))
    long_ = [w for w in first if len(w) >= line_dedup.EDIT_WORDS]
    near = {w for w in long_ if any(first[v] < first[w] and line_dedup.within_one_edit(list(v), list(w)) for v in long_)}
    for r in line_dedup.dedup_lines(frame(spark, rows)).collect():
        lines = rows[r.doc_id].split("\n")
        kept = [x for k, x in enumerate(lines) if len(w := tuple(x.split())) < line_dedup.MIN_WORDS or (w not in near and first[w] == (r.doc_id, k))]
        assert (r.text.split("\n") if r.n_dropped < r.n_lines else []) == kept


def test_lines_of_documents_that_share_an_id_or_have_none(spark):
    same, pad = "one line that both texts have", [f"filler number {i} of one long text" for i in range(6)]
    for i in (None, 7):
        texts = ["\n".join([same, f"only text {k} has this"] + pad * (k == 1)) for k in range(2)]
        texts += [f"nothing else says this {k}\nnor that {k} is so" for k in range(2)]
        rows = [(i, t, "en", "s", len(t)) for t in texts]
        kept = [r.text.split("\n") for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOC)).collect()]
        assert Counter(x for t in kept for x in t) == Counter({x: 1 for t in texts for x in t.split("\n")})
    rows = [(None, "only one line and it repeats", "en", "s", 1)] * 2
    assert [r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOC)).collect()] == [0, 0]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_long_lines_within_a_bound_that_grows(spark):
    rng, lines = random.Random(11), []
    passage = [f"p{i}" for i in range(25)]
    for base in range(14):
        own = random.Random(base)
        w = [f"w{own.randrange(400)}" for _ in range(own.randint(28, 110))] if base % 4 else passage + [f"w{own.randrange(400)}" for _ in range(own.randint(8, 30))]
        for _ in range(12):
            v = list(w)
            for _ in range(rng.randint(0, len(w) // 16 + 2)):
                k = rng.randrange(len(v))
                v = v[:k] + [f"e{rng.randrange(50)}"] * rng.randint(0, 1) + v[k + rng.randint(0, 1) :]
            lines.append(v)
    lines += [["same"] * 40, ["same"] * 42, ["same"] * 43, ["a", "b"] * 20, ["a", "b"] * 21]
    rng.shuffle(lines)
    distances = [min([distance(v, w) - max(1, min(len(v), len(w)) // 16) for v in lines[:i]], default=1) for i, w in enumerate(lines)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(frame(spark, [" ".join(w) for w in lines])).collect()}
    assert [got[i] for i in range(len(lines))] == [int(d <= 0) for d in distances]
    for _ in range(500):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in "ab")
        assert [line_dedup.within_edits(a, b, k) for k in range(10)] == [distance(a, b) <= k for k in range(10)]


def test_equal_long_lines_without_blanks(spark):
    texts = ["一" * 30, "short one", "一" * 30, "short one", " " * 40, " " * 40]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert [got[i] for i in range(6)] == [0, 0, 1, 0, 0, 0]


def test_fingerprints_next_and_edited_texts(spark):
    texts = [f"alpha beta {i} gamma delta {i % 3} epsilon zeta eta theta " * (i % 5) for i in range(40)]
    rows = {r.doc_id: r for r in fingerprint.edited_fingerprints(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        half, following = len(t) // 2, texts[i - 1]
        assert rows[i].edited == t[: len(t) - half] + following[:half]
        assert rows[i].next_sketch == rows[(i - 1) % 40].sketch


def test_sketch_estimates_and_merging(spark):
    a, b = [f"a{i}" for i in range(1500)], [f"a{i}" for i in range(500, 2200)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "x string, y string")
    s = df.select(*[fingerprint.sketch(F.col(c)).alias(c) for c in "xy"])
    r = s.select(fingerprint.resemblance(F.col("x"), F.col("y")), fingerprint.containment(F.col("x"), F.col("y")), fingerprint.distinct_count(F.col("x"))).first()
    assert abs(r[0] - 996 / 2188) < 0.15 and abs(r[1] - 996 / 1496) < 0.2 and abs(r[2] / 1496 - 1) < 0.3
    parts = s.select(F.explode(F.array("x", "y")).alias("sketch"), F.lit(1).alias("g"))
    whole = s.select(fingerprint.merged(F.col("x"), F.col("y")).alias("m")).first().m
    assert fingerprint.merge_sketches(parts, ["g"], "sketch").first().sketch == whole


def test_fingerprint_query_is_native(spark):
    sf = "/root/testdata/sf0.001"
    plan = QUERIES["op6_bottom_k"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_patience_alignment():
    rng = random.Random(1)
    for _ in range(200):
        values = rng.sample(range(20), rng.randint(0, 8))
        longest = max(bin(m).count("1") for m in range(1 << len(values)) if (s := [v for i, v in enumerate(values) if m >> i & 1]) == sorted(s))
        assert len(license_scan.increasing(values)) == longest
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randint(0, 15))] for _ in "ab")
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_licenses_twice_noisy_and_absent():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    once = "x y Released under the MIT License. z"
    assert [x[0] for x in scanner.scan(once)] == ["mit"] and scanner.scan(once)[0][2:] == (2, 7)
    assert [x[0] for x in scanner.scan(once + "\n" + once)] == ["mit"]
    assert [x[0] for x in scanner.scan("License words License " + once)] == ["mit"]
    assert scanner.scan("the license was released") == []


def test_license_look_alikes_and_every_place(spark):
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    names = lambda text: [x[0] for x in scanner.scan(text)]
    assert names("Released under the BSD License.") == ["bsd"] and names("Released under the Foo License.") == []
    assert names("Licensed under CC BY-SA 4.0.") == ["cc-by-sa-4.0"] and names("Licensed under CC BY 4.0.") == ["cc-by-4.0-short"]
    assert names("Licensed under CC BY-NC 3.0.") == [] and names("Licensed under the Apache License, Version 1.1.") == []
    assert names("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == ["cc-by-sa-4.0-notice"]
    assert names("This work is licensed under the GNU Lesser General Public License, version 3.") == ["lgpl-3.0"]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["gpl-2.0"]
    for name, text in license_scan.TEMPLATES.items():
        found = dict((x[0], x[1]) for x in scanner.scan(f"some words {text} and more"))
        assert found[name] == 1.0 and all(n in (name, "apache-2.0", "mit-notice", "bsd-notice") for n in found), (name, found)
    line = "x y Released under the MIT License. z\n"
    rows = license_scan.scan_licenses(frame(spark, [line * 3, license_scan.TEMPLATES["bsd-3-clause-text"]])).orderBy("doc_id").collect()
    assert [(x.name, x.first, x.stop) for x in rows[0].licenses] == [("mit", 2, 7), ("mit", 10, 15), ("mit", 18, 23)]
    assert {x.name for x in rows[1].licenses} == {"bsd-3-clause-text", "bsd-notice"}


@pytest.mark.parametrize("name,label,limit", [("op1_convolution", "toxic", 0.5), ("op10_line_crf", "quality", 0.3)])
def test_classifiers_on_held_out_rows(spark, name, label, limit):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES[name](spark, sf).join(table(spark, sf, "labels").select("doc_id", label), "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= limit) for r in scored)
    assert sum(r.predicted == r[label] for r in held) / len(held) > 0.95


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    unary, move = rng.normal(size=9), rng.normal(size=(2, 2))
    p, _, log_z = quality_crf.forward_backward(unary, np.array([0, 4, 5, 9]), move)
    total = 0.0
    for lo, hi in ((0, 4), (4, 5), (5, 9)):
        paths = [[m >> i & 1 for i in range(hi - lo)] for m in range(1 << (hi - lo))]
        weight = np.exp([sum(unary[lo + i] * y for i, y in enumerate(x)) + sum(move[a, b] for a, b in zip(x, x[1:])) for x in paths])
        assert np.allclose(p[lo:hi], [(weight * [x[i] for x in paths]).sum() / weight.sum() for i in range(hi - lo)])
        total += np.log(weight.sum())
    assert np.isclose(log_z, total)


def test_decontamination_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    windows = defaultdict(set)
    for r in table(spark, sf, "benchmark").collect():
        w = decontaminate.words_of(r.text)
        for j in range(max(1, len(w) - 9)):
            windows[tuple(w[j : j + 10])].add(r.item_id)
    got = {r.doc_id: r for r in QUERIES["op3_suffix_automaton"](spark, sf).collect()}
    for d in table(spark, sf, "documents").collect():
        w, hit, items = decontaminate.words_of(d.text), set(), set()
        for j in range(len(w) - 9):
            if own := windows.get(tuple(w[j : j + 10])):
                hit |= set(range(j, j + 10))
                items |= own
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(items), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def test_items_without_an_id_hit_but_are_not_listed(spark):
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "d e f"), (None, "a b c"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c"), (5, "d e f"), (6, "a b c y"), (7, None), (8, "")], "item_id long, text string")
    for block_words in (3, 1000):  # several blocks, each written, and one
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_items(docs, items, block_words=block_words).collect()}
        assert got == {1: (5, 4, ["6"]), 2: (3, 3, ["5"]), None: (3, 3, []), 3: (0, 0, [])}
    assert decontaminate.find_items(docs.limit(0), items).collect() == []


def test_sample_takes_one_row_of_an_id(spark):
    from strata.llm.common import labelled_sample

    docs = spark.createDataFrame([(1, f"text {i}", "en") for i in range(500)] + [(i, "t", "en") for i in range(2, 60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] * 2, "doc_id long, toxic int")
    sample, counts = labelled_sample(docs, labels, "toxic", 10, 1000)
    rows = sample.collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 20 and sum(counts.values()) > 20
    again, _ = labelled_sample(docs.repartition(7), labels, "toxic", 10, 1000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_pipeline_end_to_end(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        path = scratch(spark, "t")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    ids = {r.doc_id for r in docs.collect()}
    assert 0.5 * 200 < len(ids) < 200
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == ids


def test_letter_words_by_ranks_equal_the_library():
    """Words of simple letters, upper case, accents, marks, single letters and long
    words: the ids that the library gives each; other words go the other way."""
    import random

    encoder = WordEncoder(vocabulary("word_bpe_49k.json"), False)
    assert encoder.letters is not None
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZ" + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())
    words = list(letters) + ["a" * 3000, "ßß", "Ärger!", "ÿ", "naïve,", "I", "x;", "ĂĐ", "it's", "a1", "end.\nNext", "don't.", "<|endoftext|>", "é", "é"]
    words += ["".join(rng.choices(letters, k=rng.randint(1, 20))) + rng.choice(["", ",", ".", "?", "!!"]) for _ in range(3000)]
    words += ["".join(rng.choices(["th", "he", "ing", "ion", "é", "ü", "s"], k=rng.randint(1, 8))) for _ in range(3000)]
    ids, at = encoder.encode(pa.array(words))
    for i, w in enumerate(words):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(w, add_special_tokens=False).ids, w
    lines = ["one\ntwo  three\n\nFour", "\n", "tab\tand\r\nbreak", " \n lead"]
    ids, at = encoder.encode(pa.array(lines))
    for i, t in enumerate(lines):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_repair_ends_only_when_no_pair_is_frequent():
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, 40, 3000), np.tile(np.arange(40), 900), np.zeros(5000, "i8")])
    base, rules, starts, seq = tokenfile.repair(ids, per_round=3)
    assert len(starts) > 6
    assert (tokenfile.expand(seq, base, rules, starts) == ids).all()
    pairs, uses = np.unique((seq[:-1] << 32) | seq[1:], return_counts=True)
    apart = uses[(pairs >> 32) != (pairs & 0xFFFFFFFF)]  # runs of one symbol overlap
    assert apart.max(initial=0) < tokenfile.LEAST_USES


def test_unshared_words_rule_out_only_lines_that_are_too_far_apart():
    rng = random.Random(5)
    ruled_out = 0
    for _ in range(3000):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b[(i := rng.randint(0, len(b))) : i + rng.randint(0, 1)] = [rng.choice("abcdxyz")] * rng.randint(0, 2)
        most = rng.randint(0, 3)
        if not line_dedup.may_be_within(a, b, most):
            ruled_out += 1
            assert not line_dedup.within_edits(a, b, most)
    assert ruled_out
    assert not line_dedup.may_be_within(["a", "b", "c"], ["a", "x", "y"], 1)


def test_letter_words_with_signs_are_not_learned_one_by_one():
    rng = random.Random(7)
    encoder = WordEncoder(vocabulary("word_bpe_49k.json"), False)
    stems = ["".join(rng.choices("abcdefgéàÉ", k=rng.randint(1, 9))) for _ in range(900)]
    words = [w + s for w, s in zip(stems, ["", ".", "***", "&&&", "'", "'\"", "_", "...)", "$"] * 100)]
    words += ["a*b", "***", "a***é", "l'an***", "x'", "'s", "a's'"]
    ids, at = encoder.encode(pa.array(words))
    for i, w in enumerate(words):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(w, add_special_tokens=False).ids, w
    assert len(encoder.memo) < 20
    ids, at = encoder.encode(pa.array(["", None, "a", " ", "b!!"]))
    assert np.diff(at).tolist() == [0, 0, 1, 0, 2]


def test_repair_with_symbols_past_two_bytes():
    rng = np.random.default_rng(6)
    for low in (65_400, 70_000):  # the first passes two bytes as rules are added
        ids = low + rng.integers(0, 30, 40_000)
        base, rules, starts, seq = tokenfile.repair(ids, per_round=300)
        assert base + len(rules) > 1 << 16 and len(seq) < len(ids)
        assert (tokenfile.expand(seq, base, rules, starts) == ids).all()
        pairs, uses = np.unique((seq[:-1] << 32) | seq[1:], return_counts=True)
        assert uses[(pairs >> 32) != (pairs & 0xFFFFFFFF)].max(initial=0) < tokenfile.LEAST_USES


def test_lines_ruled_out_by_arrays_are_those_ruled_out_one_by_one():
    rng = random.Random(8)
    pairs = [("", ""), ("  ", "a"), ("a b", "a b")]
    for _ in range(1500):
        a = [rng.choice("abcdefghijklmnop") * rng.randint(1, 2) for _ in range(rng.randint(1, 50))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            b[(i := rng.randint(0, len(b))) : i + rng.randint(0, 1)] = [rng.choice("qrstabc")] * rng.randint(0, 2)
        pairs.append((rng.choice(["", " "]) + "  ".join(a), " ".join(b) + rng.choice(["", "\t"])))
    (x, x_at), (y, y_at), may = line_dedup.may_be_within_each(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    for i, (a, b) in enumerate(pairs):
        a, b = a.split(), b.split()
        most = line_dedup.bound(min(len(a), len(b)))
        assert bool(may[i]) == line_dedup.may_be_within(a, b, most)
        one, other = x[x_at[i] : x_at[i + 1]].tolist(), y[y_at[i] : y_at[i + 1]].tolist()
        assert line_dedup.within_edits(one, other, most) == line_dedup.within_edits(a, b, most)
    assert 0 < may.sum() < len(may)


def test_variants_are_emitted_only_of_pieces_in_which_lines_differ(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(40)]
    lines = [base]
    for k in range(0, 40, 3):  # replaced, deleted and inserted, at any place
        lines += [[*base[:k], f"x{k}", *base[k + 1 :]], [*base[:k], *base[k + 1 :]], [*base[:k], f"y{k}", *base[k:]]]
    lines += [base[:20] + [f"z{rng.random()}" for _ in range(20)] for _ in range(50)]  # share a half only
    text = spark.createDataFrame([(i, " ".join(w), True, False) for i, w in enumerate(lines)], "at long, words string, near boolean, far boolean")
    variants = line_dedup._variants(line_dedup._apart(text))
    got = {(r.at, r.to) for r in line_dedup._alike(variants).collect()}
    near = {a for a, w in enumerate(lines) if any(line_dedup.within_one_edit(lines[b], w) for b in range(a))}
    assert {a for a, _ in got} == near and all(line_dedup.within_one_edit(lines[a], lines[b]) for a, b in got)
    assert variants.where("at >= 43").count() == 0
    halves = [base, base[:5] + ["x"] + base[5:20] + ["y"] + base[20:]]
    assert line_dedup._apart(spark.createDataFrame([(i, " ".join(w), True, False) for i, w in enumerate(halves)], text.schema)).count() == 0


def test_toxicity_learns_in_a_task_not_in_the_driver(spark, monkeypatch):
    docs = frame(spark, [f"{'vile nasty' if i % 2 else 'kind nice'} word{i} and more" for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)

    def here(*args, **kwargs):
        raise AssertionError("trained in the driver")

    monkeypatch.setattr(toxicity, "train", here)
    model = toxicity.fit(docs, labels, least=2)
    assert len(model.rows) > 0
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(scores[i] for i in scores if i % 2) > max(scores[i] for i in scores if i % 2 == 0)
    empty = toxicity.fit(docs.limit(0), labels)
    assert not empty.rows and not toxicity.fit(docs, labels.limit(0)).rows


def test_line_keys_met_elsewhere(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PACK_KEYS", 7)
    rng = random.Random(11)
    lines = [(h, [(rng.randrange(-(2**62), 2**62, 2**57), rng.randint(1, 3)) for _ in range(rng.randint(0, 5))]) for h in range(-20, 20)]
    lines += lines[:9]  # equal lines count once
    frame_ = spark.createDataFrame(lines, "h1 long, keys array<struct<key:long,weight:int>>").repartition(3)
    holders = {}
    for h, keys in lines:
        for key, _ in keys:
            holders.setdefault(key, set()).add(h)
    want = {h: sum(w for k, w in keys if len(holders[k]) > 1) for h, keys in lines}
    for parts in (1, 3, 50):
        assert {r.h1: r.met for r in line_dedup._met_elsewhere(frame_, parts).collect()} == {h: n for h, n in want.items() if n}
    assert line_dedup._met_elsewhere(frame_.limit(0), 2).count() == 0


def test_lines_of_one_passage_are_compared_only_where_their_words_allow(spark):
    base = [f"w{i}" for i in range(48)]
    lines = [base[:]]
    for i in range(40):  # three words replaced: six apart from each other, more than three edits
        lines.append([f"x{i}y{k}" if k in (5 + i % 5, 20 + i % 7, 38 + i % 6) else w for k, w in enumerate(base)])
    lines += [lines[k][:9] + ["new"] + lines[k][9:] for k in (3, 8)] + [lines[k][1:] for k in (5, 7)]
    lines = lines[1:] + lines[:1]
    text = spark.createDataFrame([(i, " ".join(w), False, True) for i, w in enumerate(lines)], "at long, words string, near boolean, far boolean")
    rare = line_dedup._rare(text)
    none = spark.createDataFrame([], "at long")
    got = {(r.at, r.to) for r in line_dedup._with_all(rare, none).collect()}
    every = [(i, k) for i in range(len(lines)) for k in range(i)]
    alike = {(i, k) for i, k in every if line_dedup.within_edits(lines[i], lines[k], line_dedup.bound(min(len(lines[i]), len(lines[k]))))}
    assert alike and alike <= got and len(got) < len(every) / 4
    x = line_dedup.LineWords(pa.array([" ".join(w) for w in lines]))
    bits = [int(a) | int(b) << 64 for a, b in x.parities()]
    for i, k in alike:
        apart = abs(len(lines[i]) - len(lines[k]))
        assert (bits[i] ^ bits[k]).bit_count() <= 2 * line_dedup.bound(min(len(lines[i]), len(lines[k]))) - apart


def test_word_hashes_tell_words_apart():
    words = ["", "a", "b", "aa", "é", "abcdefgh", "abcdefghi", "bcdefghi", "abcdefgh" * 8, "abcdefgh" * 8 + "i", "bcdefgh" * 40, "", "a"]
    hashes, sizes = line_dedup.word_hashes(pa.array(words, pa.large_string()))
    assert sizes.tolist() == [len(w.encode()) for w in words] and len(set(hashes.tolist())) == len(set(words))
    assert hashes[0] == hashes[11] and hashes[1] == hashes[12]
    assert (line_dedup.word_hashes(pa.array(["x", *words]).slice(3))[0] == hashes[2:]).all()  # what stands around a word has no part
    assert not len(line_dedup.word_hashes(pa.array([], pa.string()))[0])


def test_keys_of_stretches_of_lines_met_elsewhere(spark):
    rng = random.Random(12)
    lines = [(h, [(rng.randrange(2**62), rng.randint(1, 3)) for _ in range(rng.randint(0, 3))]) for h in range(30)]
    lines = [(h, keys + ([lines[h % 7][1][0]] if h > 6 and lines[h % 7][1] else [])) for h, keys in lines]
    lines += lines[-5:]  # equal lines count once
    flat = [(h, key, weight) for h, keys in lines for key, weight in keys]
    holders = {}
    for h, key, _ in flat:
        holders.setdefault(key, set()).add(h)
    want = {h: n for h, keys in lines if (n := sum(w for k, w in keys if len(holders[k]) > 1))}
    rows = []
    for lo in range(0, len(lines), 8):
        some = lines[lo : lo + 8]
        arrays = ([h for h, _ in some], "<i8"), ([len(k) for _, k in some], "<i4"), ([k for _, own in some for k, _ in own], "<u8"), ([w for _, own in some for _, w in own], "<i4")
        rows.append(tuple(bytearray(np.array(v, d).tobytes()) for v, d in arrays))
    packed = spark.createDataFrame(rows, "lines binary, each binary, keys binary, weights binary").repartition(2)
    for parts in (1, 5):
        assert {r.h1: r.met for r in line_dedup._met_elsewhere(packed, parts).collect()} == want


def test_rarest_grams_whatever_parts_and_blocks_they_are_dealt_into(spark, monkeypatch):
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(20)]
    lines = [passage[rng.randrange(9) :] + [f"w{rng.randrange(60)}" for _ in range(rng.randint(20, 45))] for _ in range(40)] + [["same"] * 40, ["same"] * 43]
    lines += [w[:9] + ["new"] + w[9:] for w in lines[:12]]
    text = spark.createDataFrame([(i, " ".join(w), False, True) for i, w in enumerate(lines)], "at long, words string, near boolean, far boolean").repartition(3)
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in lines]
    uses = Counter(g for own in grams for g in own)
    want = {}
    for i, (w, own) in enumerate(zip(lines, grams)):
        several = sorted(uses[g] for g in own if uses[g] > 1)
        want[i] = several[: max(0, 5 * (len(w) // 16) + 1 - (len(own) - len(several)))]
    none = spark.createDataFrame([], "at long")
    for part_bytes, pack_keys in ((line_dedup.PART_BYTES, line_dedup.PACK_KEYS), (1500, 300)):
        monkeypatch.setattr(line_dedup, "PART_BYTES", part_bytes)
        monkeypatch.setattr(line_dedup, "PACK_KEYS", pack_keys)
        rare = line_dedup._rare(text)
        got = rare.collect()
        assert Counter(r.at for r in got) == Counter({i: len(v) for i, v in want.items() if v})
        assert all(r.n == len(lines[r.at]) and 0 <= r.lo <= r.hi <= r.n - 5 for r in got)
        assert all(lines[r.at][r.lo : r.lo + 5] == lines[r.at][r.hi : r.hi + 5] for r in got)
        assert len({(r.gram, tuple(lines[r.at][r.lo : r.lo + 5])) for r in got}) == len({r.gram for r in got})
        alike = {(i, k) for i, w in enumerate(lines) for k in range(i) if line_dedup.within_edits(w, lines[k], line_dedup.bound(min(len(w), len(lines[k]))))}
        assert alike and alike <= {(r.at, r.to) for r in line_dedup._with_all(rare, none).collect()}
    assert line_dedup._rare(text.limit(0)).count() == 0


def test_line_keys_are_dealt_once(spark):
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    variants = spark.createDataFrame([(i % 2, 0, 9, i % 3, i) for i in range(9)], "key long, check long, n long, gap long, at long")
    assert exchanges(line_dedup._alike(variants)) == 2  # by key, and equal pairs
    rare = spark.createDataFrame([(i, 40, i, i, i % 2, i, i, []) for i in range(9)], "at long, n int, s0 long, s1 long, gram long, lo int, hi int, more array<long>")
    assert exchanges(line_dedup._with_earliest(rare)) == 2


def test_only_lines_that_repeat_are_looked_up_again(spark):
    texts = ["one line that two texts hold\nand one of its own here", "one line that two texts hold\none line that two texts hold", "a line that nobody else has at all"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(1, texts[1], "en", "s", 5)]
    got = sorted((r.doc_id, r.n_dropped, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOC)).collect())
    assert got == [(0, 0, texts[0]), (1, 2, ""), (1, 2, ""), (2, 0, texts[2])]


def test_long_lines_of_one_passage_are_told_apart_by_more_parities(spark):
    rng = random.Random(14)
    base = [f"w{i}" for i in range(640)]
    lines = [base]
    for i in range(30):  # 36 words replaced: about 70 apart from each other, more than 40 edits
        w = list(base)
        for k in rng.sample(range(640), 36):
            w[k] = f"x{i}y{k}"
        lines.append(w)
    lines += [lines[3][:200] + lines[3][220:], lines[4][:50] + ["new"] * 12 + lines[4][50:], base[:250], base[:262]]
    lines = lines[1:] + lines[:1]
    text = spark.createDataFrame([(i, " ".join(w), False, True) for i, w in enumerate(lines)], "at long, words string, near boolean, far boolean")
    got = {(r.at, r.to) for r in line_dedup._with_all(line_dedup._rare(text), spark.createDataFrame([], "at long")).collect()}
    every = [(i, k) for i in range(len(lines)) for k in range(i)]
    alike = {(i, k) for i, k in every if line_dedup.within_edits(lines[i], lines[k], line_dedup.bound(min(len(lines[i]), len(lines[k]))))}
    assert len(alike) > 30 and alike <= got and len(got) < len(every) / 4
    a, b = (["a"] * 3 + ["b"] * 3 + [f"c{i}" for i in range(9)] for _ in "ab")
    b[:6] = ["a"] + ["b"] * 5  # no word is alone, but two uses are
    assert not line_dedup.may_be_within(a, b, 1) and line_dedup.may_be_within(a, b, 2)
