"""The Merkle manifest against a plain tree built in Python, proofs against tampered rows, and odd rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.llm import manifest
from tests.llm.conftest import DOC_SCHEMA, prose


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def climb(digests):
    """Per leaf: top digest and the siblings (before, after) of every level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for leaf_no, i in enumerate(at):
            run = i // 16 * 16
            paths[leaf_no].append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        level = [h(*level[i:i + 16]) for i in range(0, len(level), 16)]
        at = [i // 16 for i in at]
    return level[0], paths


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, found = [], []
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = climb([leaf(r) for r in members])
        tops.append(top)
        found.append((members, paths))
    root, upper = climb(tops)
    out = []
    for top, above, (members, paths) in zip(tops, upper, found):
        for row, path in zip(members, paths):
            whole = path + above
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                shown = (row[0], lower(row[1]), *row[2:])
            folded = leaf(shown)
            for before, after in whole:
                folded = h(before, folded, after)
            out.append((row[0], leaf(row), top, root, h(*[b + a for b, a in whole]), folded, folded == root))
    return sorted(out, key=repr)


def contract(docs):
    rows = manifest.manifest(manifest.leaves_of(docs, changed=manifest.tampered(F.col("doc_id"))))
    got = rows.select("doc_id", "digest", "subroot", "root", manifest.proof(F.col("path")).alias("proof"),
                      manifest.fold(F.col("shown"), F.col("path")).alias("folded"))
    return sorted((tuple(r) + (r.folded == r.root,) for r in got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, None: 17, "é": 1}, {"a": 300, "b": 2, "": 33},
                                   {f"s{i:02}": 1 + i % 3 for i in range(40)}])
def test_equals_a_plain_tree(spark, sizes):
    rows = [(i * 7 % 1000 + 1000 * k, ("Capital " if i % 2 else "small ") + prose(i, 5), "en", s, i)
            for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    assert contract(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)) == plain_manifest(rows)


def test_odd_rows(spark, odd_docs, odd_rows):
    assert contract(odd_docs) == plain_manifest(odd_rows)


def test_clashing_columns_are_ignored(spark, clashing, odd_rows):
    assert contract(clashing.withColumns({c: F.lit("x") for c in ("g", "lo", "hi", "digest", "shown", "subroot")})) \
        == plain_manifest(odd_rows)


def test_empty_table(spark, no_docs):
    assert contract(no_docs) == []


def test_a_third_of_the_rows_equal(spark):
    rows = [(5, "Same Text", "en", "a", 1)] * 200 + [(100 + i, prose(i, 6), "en", "ab"[i % 2], i) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    assert contract(docs) == plain_manifest(rows)


def test_only_changed_rows_fail(spark):
    rows = [(i, "Text " + prose(i, 4) if i % 2 else "text", "en", "a", i) for i in range(100)]
    for row in contract(spark.createDataFrame(rows, DOC_SCHEMA)):
        assert row[-1] == (not (row[0] % 2 and zlib.crc32(str(row[0]).encode()) % 5 == 0))
