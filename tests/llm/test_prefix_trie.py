"""The prefix trie against a plain trie in Python: rebuilt or not, long, hot, tied and odd conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.llm import prefix_trie
from tests.llm.conftest import rows as sorted_rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(table, rebuild):
    convs = defaultdict(list)
    for c, turn, role, text in table:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    original = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    paths = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = (original.get(c - c % 5, [])[:h] + own[h:]) if rebuild else own
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        kids = children[node]
        totals[node] = (sum(totals[k][0] for k in kids) if kids else 1, saved + sum(totals[k][1] for k in kids))
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(paths[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
                    *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, table, rebuild, partitions=3):
    df = spark.createDataFrame(table, SCHEMA).repartition(partitions)
    assert sorted_rows(prefix_trie.prefix_trie(df, rebuild=rebuild)) == plain(table, rebuild)


def random_table(seed, convs, longest, kinds):
    rng = random.Random(seed)
    return [(c, t, "user" if t % 2 == 0 else "assistant", f"text é {rng.randrange(kinds)}")
            for c in range(convs) for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("kinds", [1, 2, 40])
def test_equals_a_plain_trie(spark, rebuild, kinds):
    check(spark, random_table(kinds, 60, 14, kinds), rebuild)


def test_long_and_hot_conversations(spark, monkeypatch):
    """Chunks of a few turns, a third of the rows in one conversation, many copies of one and a third of all turns equal."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    long = [(7, t, "user", "x" if t % 3 else f"y{t}") for t in range(150)]
    copies = [(100 + c, t, "user", f"t{t}") for c in range(30) for t in range(5)]
    others = random_table(9, 30, 9, 2)
    fork = [(1000 + c, t, "user", "x" if t % 3 else f"y{t}") for c in range(2) for t in range(40 + 9 * c)]
    for rebuild in (False, True):
        check(spark, long + copies + [(c + 300, *r) for c, *r in others] + fork, rebuild, 5)


def test_odd_rows(spark):
    table = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (2, 0, "", "a"), (2, 1, "u", ""),
             (None, 0, "user", "lost"), (-4, 0, "user", "a"), (-4, 1, "user", "z" * 50_000), (6, 3, "user", "a"),
             (11, 0, "user", "a"), (10, 5, "user", "q"), (10, 4, "user", "a")]
    for rebuild in (False, True):
        check(spark, table, rebuild)
    df = spark.createDataFrame(table, SCHEMA).withColumns({c: F.lit("x") for c in (
        "c", "pos", "sha", "bytes", "len", "at", "blk", "turns", "id", "parent", "n", "conv", "block")})
    assert sorted_rows(prefix_trie.prefix_trie(df, rebuild=True)) == plain(table, True)


def test_role_and_text_are_kept_apart(spark):
    check(spark, [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, None, "abc")], False)


def test_turnless_conversations_are_members_of_the_root(spark):
    """A conversation without head whose turns all come before its h has none left."""
    lonely = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:4]
    check(spark, [(c, t, "user", f"{c}") for c in lonely for t in range(2)], True)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(df, rebuild=True).collect() == []
