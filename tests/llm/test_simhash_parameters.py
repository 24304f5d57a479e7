"""Distance and shingle of the near-copy search are the caller's."""

import pytest

from vacancylens.llm import simhash


def test_distance_and_shingle(spark):
    words = [f"word{i}" for i in range(300)]
    other = [*words[:150], "changed", *words[151:]]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    for shingle in (1, 3):
        a, b = (simhash.fingerprint(" ".join(w), shingle) for w in (words, other))
        for distance in (0, 3):
            rows = simhash.simhash_dedup(docs, distance=distance, shingle=shingle).collect()
            assert len({r.component_id for r in rows}) == (1 if (a ^ b).bit_count() <= distance else 2)
    with pytest.raises(ValueError):
        simhash.simhash_dedup(docs, distance=4)
