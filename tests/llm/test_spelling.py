"""Spelling variants against a plain version that compares words by what deletions leave."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from vacancylens.llm import spelling as q
from vacancylens.llm.common import read

FOLDER = "/root/testdata/sf0.01"


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def plain_near(words):
    near, same = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1:]
            same[i, shorter].add(w)
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain(rows):
    n = plain_counts(rows)
    near = plain_near(n)
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def taken(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_equals_a_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, FOLDER, "documents").collect()]
    got = taken(q.op13_spelling_variants(spark, FOLDER))
    assert got == plain(rows) and sum(v[0] is not None for v in got.values()) > 100


def test_chains_of_forms_and_ties(spark):
    steps = [("abcdefgh", 3000), ("abcdefghi", 300), ("abcdefghij", 30), ("abcdefghijk", 3), ("abcdefgz", 3000),
             ("zbcdefgh", 2), ("öäüßéàç", 50), ("öäüßéàx", 4), ("unrelated", 9)]
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(steps)]
    docs = spark.createDataFrame(rows + [(None, None), (1, ""), (None, "Repeated repeated REPEATED"), (2, "once only here")],
                                 "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "2 AS root")
    rows += [(None, "Repeated repeated REPEATED"), (2, "once only here")]
    got = taken(q.spelling_variants(docs))
    assert got == plain(rows)
    if not any(zlib.crc32(f"{i}:{w}".encode()) % 31 == 0 for i, (w, _) in enumerate(steps)):
        assert got["abcdefghijk"][:2] == ("abcdefghij", "abcdefgh")


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, "1234567 -- !")], [(1, "short words do not count")]):
        assert q.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def words_of(kind, rng):
    if kind == "hot":  # a third of the words begin alike, another third end alike
        base = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(900)]
        return ({"prefixation" + b for b in base[:300]} | {b + "suffixation" for b in base[300:600]} |
                {b + b for b in base[600:] if len(b) > 3})
    if kind == "runs":
        return {"a" * n for n in range(7, 60)} | {"a" * n + "b" + "a" * m for n in range(8) for m in range(8)
                                                  if n + m > 5} | {"a" * 5000, "a" * 5001, "a" * 2500 + "b" + "a" * 2499}
    alphabet = "aé" if kind == "few letters" else "abcdefghijklmnopqrstuvwxyzàéü"
    seeds = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10))) for _ in range(150)]
    out = set(seeds)
    for s in seeds:
        for _ in range(4):
            i = rng.randrange(len(s))
            out |= {s[:i] + s[i + 1:], s[:i] + rng.choice(alphabet) + s[i:], s[:i] + rng.choice(alphabet) + s[i + 1:]}
    return {w for w in out if len(w) >= 7}


@pytest.mark.parametrize("kind", ["mixed", "few letters", "hot", "runs"])
@pytest.mark.parametrize("block", [7, 16_384])
def test_near_words_across_blocks(spark, kind, block):
    rng = random.Random(5)
    words = {w: rng.randint(2, 9) for w in sorted(words_of(kind, rng)) if len(w) >= 7}
    near = plain_near(words)
    want = {w: (len(near[w]), *min((-words[x], x) for x in near[w])) for w in words if near[w]}
    got = q.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), block).collect()
    assert {r["word"]: (r["n_near"], -r["near_n"], r["near"]) for r in got} == want


def test_rows_of_shared_prefixes_are_reused_and_dead_ranges_skipped():
    class Counted(str):
        looked = 0

        def __getitem__(self, i):
            Counted.looked += isinstance(i, int)
            return str.__getitem__(self, i)
    words = sorted({f"stemming{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"})
    shared = [0] + [len(q.commonprefix(p)) for p in zip(words, words[1:])]
    found = list(q.scan([Counted(w) for w in words], shared, "stemmingabc", 5, 0))
    assert len(found) == 21
    assert Counted.looked < 300  # of 512 words with 6 letters after the prefix
