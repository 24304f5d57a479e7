"""Conversations whose prefixes are rendered by several tasks: the same as one task's."""

import random

import pytest

from vacancylens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def forgetful():
    """Shows thoughts of the newest turn only, so that every turn rewrites the one before it."""
    return lambda turns: "".join(f"[{role}]{text if i + 1 == len(turns) else text.split('|')[-1]}\n"
                                 for i, (role, text) in enumerate(turns))


def counting():
    """Says how many turns there are before anything else."""
    return lambda turns: f"{len(turns)} turns\n" + chat.marked_turns(turns)


def marked():
    return chat.marked_turns


def conversations():
    rng = random.Random(8)
    rows = []
    for conv, n in ((1, 3), (2, 40), (3, 41), (None, 97), (4, 0), (5, 20), (6, 1)):
        rows += [(conv, i // 2, ("user", "assistant")[i % 2], " ".join(rng.choice(["hm|", "yes", "###", "\\", "</turn>"])
                                                                      for _ in range(rng.randint(0, 5)))) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("template", [marked, forgetful, counting])
def test_stretches_equal_one_task(spark, template):
    rows = spark.createDataFrame(conversations(), SCHEMA).repartition(4)
    whole, *split = (sorted(map(str, chat.format_conversations(rows, template(), stretch=n).collect())) for n in (1000, 20, 7))
    assert len(whole) == 6 and all(part == whole for part in split)


def test_digests_of_long_conversations(spark):
    rows = spark.createDataFrame(conversations(), SCHEMA)
    whole, split = (sorted(map(str, chat.digests(chat.format_conversations(rows, stretch=n)).collect())) for n in (1000, 7))
    assert whole == split


def test_rewrites_drop_what_they_touch():
    spans = [(0, "u", 0, 5, None, None), (1, "a", 5, 9, None, None), (2, "u", 3, 12, None, None), (3, "a", 12, 15, None, None)]
    assert [s[0] for s in chat.untouched(spans, [(2, 3)])] == [2, 3]
    assert [s[0] for s in chat.untouched(spans[:2] + [(2, "u", 5, 12, None, None)], [(2, 5)])] == [0, 2]
    assert chat.untouched(spans, []) == spans
