"""Property tests: latest-per-key and key numbering against brute force on random data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlake.operators.dedupe import latest_per_key, latest_state, merge_states, unpack_state
from orderlake.operators.keys import dense_rank_distinct

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 3)),
              st.sampled_from(["x", "y", None]), st.integers(-2, 2)),
    min_size=0, max_size=25)
SCHEMA = "k string, d int, s string, v int"
FAST = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _nulls_low(values):
    # NULL sorts lowest: compare (is-not-null, value) pairs field by field
    return tuple((0, "") if x is None else (1, x) for x in values)


def _brute(rows):
    best = {}
    for r in rows:
        key = _nulls_low(r[1:])
        if r[0] not in best or key > best[r[0]][0]:
            best[r[0]] = (key, r)
    return _norm(v[1] for v in best.values())


def _norm(rows):
    return sorted((tuple(r) for r in rows), key=_nulls_low)


@FAST
@given(ROWS)
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert _norm(latest_per_key(df, ["k"], ["d"]).collect()) == _brute(rows)


@FAST
@given(ROWS, ROWS)
def test_merged_states_equal_state_of_union(spark, a, b):
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    merged = unpack_state(merge_states([latest_state(da, ["k"], ["d"]), latest_state(db, ["k"], ["d"])], ["k"]),
                          ["k"], da.columns)
    assert _norm(merged.collect()) == _norm(latest_per_key(da.unionByName(db), ["k"], ["d"]).collect())


@FAST
@given(st.lists(st.text(alphabet="abcXYZ019", min_size=0, max_size=4), max_size=40))
def test_dense_keys_number_sorted_distinct_values(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(4)
    got = dict(tuple(r) for r in dense_rank_distinct(df, "k", "id", base=3, single_task_limit=0).collect())
    want = {k: i + 3 for i, k in enumerate(sorted(set(keys), key=lambda s: s.encode()))}
    assert got == want
