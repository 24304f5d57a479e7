"""Operators on documents: brute force, and the edge cases their docstrings define."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacancylens.llm import bpe, exact_dedup, language_id, mixing, simhash, substring_dedup

FOLDER = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, fp long, "
          "part int, component_id long, text_sha256 string, score double, copies long")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
WORDS = re.compile("[^\x20\x09-\x0d]+")
ROWS = [
    (1, "the same text", "en", "a"), (2, "the  same\ttext", "en", None), (3, None, None, "a"), (4, "", "en", "b"),
    (5, " \n", "de", "b"), (6, LONG, "en", "a"), (7, LONG, "en", "a"), (7, LONG, "en", "a"), (None, "the same text", "en", "c"),
    (None, None, None, None), (8, "12345 !!", "en", "b"), (9, "Straße und Grüße an alle", "de", ""), (10, "ok", "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, True, 1, 1, 1, 1, "x", 0.5, 9) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_text(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


# Exact dedup

def test_exact_dedup_on_edge_cases(docs, nothing):
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(ROWS) and exact_dedup.exact_dedup(nothing).count() == 0
    by_text = {}
    for doc, text, *_ in ROWS:
        by_text.setdefault(plain_text(text), []).append((-len(text or ""), doc is None, doc or 0))
    for row in got:
        owners = next(v for k, v in by_text.items() if hashlib.sha256(k.encode()).hexdigest() == row.text_sha256)
        best = min(owners)
        assert row.keep_id == (None if best[1] else best[2]) and row.group_size == len(owners)
    assert sum(r.kept for r in got) == len(by_text)
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns and kept.count() == len(by_text)


def test_exact_dedup_with_a_tiny_trie(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole, spilled = (sorted(map(tuple, exact_dedup.exact_dedup(rows, budget=b).collect())) for b in (12 << 20, 1))
    assert whole == spilled


@given(st.lists(st.binary(max_size=6), max_size=40))
@settings(max_examples=200, deadline=None)
def test_trie_is_a_multiset_of_its_strings(keys):
    trie = exact_dedup.Trie(lambda a, b: a + b)
    for k in keys:
        trie.add(k, 1)
    found = {}
    while trie.sizes:
        found.update(trie.take(trie.largest()))
    assert found == {k: keys.count(k) for k in keys} and trie.bytes == 0


# Substring dedup

def _brute_repeats(rows):
    first, words = {}, {d: WORDS.findall(t or "") for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - 49):
            k = tuple(w[i:i + 50])
            first[k] = min(d, first.get(k, d))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = [True] * 50
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def test_substring_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(137)]
    rows = []
    for d in range(60):
        own = [f"w{x}" for x in rng.integers(0, 50_000, rng.integers(0, 200))]
        at, a = rng.integers(0, len(own) + 1), rng.integers(0, 80)
        cut = passage[a:a + rng.integers(40, 100)]
        rows.append((int(d), " ".join(own[:at] + cut + own[at:] + (cut if d % 7 == 0 else []))))
    want = _brute_repeats(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in
           substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_substring_dedup_on_edge_cases(docs, nothing):
    got = substring_dedup.substring_dedup(docs).collect()
    assert len(got) == len(ROWS) and substring_dedup.substring_dedup(nothing).count() == 0
    removed = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got if r.n_words > 50)
    assert removed == [(6, 30_000, 29_000 + 977 + 23)[:2] + (removed[0][2],), (7, 30_000, 30_000), (7, 30_000, 30_000)]
    assert removed[0][2] == 0  # a document's own repeats stay
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)


# SimHash

def _brute_components(fps):
    label = {f: f for f in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                label[find(b)] = find(a)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("crowded", [2048, 3])
def test_simhash_links_equal_brute_force(spark, crowded):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 20, np.int64)]
    fps = {b ^ sum(1 << int(k) for k in rng.integers(0, 64, rng.integers(0, 6))) for b in base for _ in range(12)}
    fps = {f - (1 << 64) if f >> 63 else f for f in fps}
    links = simhash.near_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long"), crowded)
    from vacancylens.llm.components import components
    roots = {r.node: r.root for r in components(links).collect()}
    want = _brute_components({f & (2**64 - 1) for f in fps})
    groups = {}
    for f in fps:
        groups.setdefault(want[f & (2**64 - 1)], set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_on_edge_cases(docs, nothing):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_dedup(docs).collect()}
    empty = "0" * 16
    assert {g for g in got if g[1] == empty} == {(None, empty, 3), (3, empty, 3), (4, empty, 3), (5, empty, 3)}
    assert simhash.simhash_dedup(docs).count() == len(ROWS) and simhash.simhash_dedup(nothing).count() == 0
    import xxhash
    assert simhash.fingerprint("Ok") == xxhash.xxh64_intdigest(b"ok", 42)
    assert simhash.fingerprint("É a B") == xxhash.xxh64_intdigest("É a b".encode(), 42)


# Language identification

def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.filter(~language_id.held_out()).select("text", "lang"))
    rows = language_id.predict(docs, model, ["lang"]).join(
        docs.filter(language_id.held_out()).select("doc_id"), "doc_id").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_language_id_on_edge_cases(docs, nothing):
    model = language_id.train(docs.select("text", "lang"))
    assert model.languages == ("de", "en")
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(ROWS) and language_id.predict(nothing, model).count() == 0
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {3, 4, 5, 8, None}
    assert all((r.score == 0 and r.ambiguous) if r.lang_pred == "und" else 0 <= r.score <= 1 for r in got)
    kept = language_id.keep_identified(docs)  # whose columns include "score"
    assert kept.schema.names == docs.schema.names and not {r.doc_id for r in kept.collect()} & {3, 4, 5, 8}
    untaught = language_id.predict(docs, language_id.train(nothing.select("text", "lang")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


@pytest.mark.parametrize("k", range(1, 40))
def test_codewords_differ(k):
    code = language_id.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1.0, 1.0}
    for i in range(k):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 2 - 1)


# Mixing

def _brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, rest, open_ = {}, 1.5 * sum(sizes.values()), list(order)
    while open_:
        part = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        full = [s for s in open_ if part[s] > 2 * sizes[s]]
        if not full:
            out.update(part)
            break
        for s in full:
            out[s] = 2 * sizes[s]
            rest -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("group", [4096, 20])
def test_mix_meets_its_targets(spark, group):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes, largest = {}, {}
    for r in docs.collect():
        n = len(WORDS.findall(r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    want, taken = _brute_targets(sizes), {}
    got = mixing.mix(docs, group=group).collect()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(got) == docs.count()
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in want)
    again = mixing.mix(docs.repartition(5), group=group)
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_on_edge_cases(docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and mixing.mix(nothing).count() == 0
    assert {r.source for r in got} == {None, "", "a", "b", "c"}
    assert mixing.mixed_documents(docs).columns == docs.columns


@given(st.lists(st.tuples(st.integers(0, 50), st.floats(0, 1)), max_size=60))
@settings(max_examples=100, deadline=None)
def test_flight_keeps_both_totals(rows):
    sizes, chances = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = mixing.flight(sizes, chances, np.random.default_rng(3).random(len(rows)))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - chances.sum()) < 1e-5 and abs((out * sizes).sum() - (chances * sizes).sum()) < 1e-4


# BPE

@pytest.fixture(scope="module")
def library():
    return bpe.Encoder(bpe.default_vocabulary()).library


ALPHABET = ["a", "b", "the", "é", "é", "中", "가", "가", "'s", "'", " ", "  ", "\n", "1", "23", "!!", "!'s",
            "😀", "<|endoftext|>", "<|endof", "İ", "Σ", "ß", "ing", "tion", "́", "\x1f", "\x85", "‍", "A", "x'll",
            "|", "Ⅷ", "²"]


@pytest.mark.parametrize("leaf", [3, 8, 40])
def test_tree_concatenation_equals_the_library(library, leaf):
    encoder = bpe.Encoder(bpe.default_vocabulary(), leaf)

    @given(st.lists(st.sampled_from(ALPHABET), max_size=80).map("".join))
    @settings(max_examples=300, deadline=None)
    def check(text):
        assert encoder.ids(text) == library.encode(text, add_special_tokens=False).ids
    check()


@given(st.lists(st.sampled_from(ALPHABET), min_size=1, max_size=150).map("".join))
@settings(max_examples=150, deadline=None)
def test_joined_pieces_equal_the_library(text):
    encoder = ENCODERS.setdefault(9, bpe.Encoder(bpe.default_vocabulary(), 9))
    stops = encoder.cuts(text, 12)
    parts = [text[a:b] for a, b in zip([0, *stops], stops)]
    ids = encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.joined([(p, encoder.segments(p)) for p in parts])[1] == " ".join(map(str, ids))


ENCODERS = {}


@pytest.mark.parametrize("text", ["a" * 20_000, "!'" * 5000, "́" * 5000, "中文字符" * 3000, LONG])
def test_long_unsplit_texts(library, text):
    assert bpe.Encoder(bpe.default_vocabulary(), 512).ids(text) == library.encode(text, add_special_tokens=False).ids


def test_encoding_equals_the_library(spark, library, docs, nothing):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(
        docs.select("doc_id", "text"))
    want = []
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    for long in (bpe.LONG, 700):  # the second splits most texts over tasks
        got = [(r.doc_id or 0, *r[1:]) for r in bpe.token_digests(rows, long=long, leaf=200 if long == 700 else bpe.LEAF)
               .collect()]
        assert sorted(got) == sorted(want)
    assert bpe.token_digests(nothing).count() == 0
    whole = bpe.encode_texts(docs).collect()
    assert {(r.doc_id, tuple(r.ids), r.decoded) for r in whole if r.doc_id == 10} == {
        (10, tuple(library.encode("ok").ids), library.decode(library.encode("ok").ids))}


# Pipeline

def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, FOLDER).cache()
        assert kept.columns == docs.columns
        had = {r.doc_id: r.text for r in before.collect()}
        have = [r.doc_id for r in kept.collect()]
        assert set(have) <= set(had)
        if name == "language_id":
            gone = set(had) - set(have)
            assert len(gone) <= 3 and all(len(had[d]) < 50 for d in gone)
        elif name == "exact_dedup":
            best = {}
            for d, t in had.items():
                best[plain_text(t)] = min(best.get(plain_text(t), (1, 0)), (-len(t), d))
            assert sorted(have) == sorted(d for _, d in best.values())
        elif name == "simhash_dedup":
            roots = _brute_components({simhash.fingerprint(t) for t in had.values()})
            least = {}
            for d, t in had.items():
                root = roots[simhash.fingerprint(t)]
                least[root] = min(d, least.get(root, d))
            assert sorted(have) == sorted(least.values())
        else:
            taken = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert sorted(have) == sorted(d for d, n in taken.items() for _ in range(n))
    last = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in kept.collect())
    assert kept.select(F.countDistinct("doc_id")).first()[0] > 50
