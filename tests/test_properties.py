"""Property tests of the invariants in SURVEY §5, checked against a plain
Python model of the reference semantics (dict keyed upsert)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchstar.operators.numbering import number_rows
from pitchstar.operators.upsert import upsert, upsert_counts, upsert_newest

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows_st = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 9), st.integers(0, 50)),
                   min_size=0, max_size=25)


def df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, t int")


def model_upsert(base, new):
    """Dict semantics: stored keys unique; batch rows applied in t order."""
    state = {}
    for k, v, t in base:
        state[k] = (k, v, t)
    ins = upd = 0
    for k, v, t in sorted(new, key=lambda r: (r[2], r[1], r[0])):
        if k in state:
            upd += 1
        else:
            ins += 1
        state[k] = (k, v, t)
    return sorted(state.values()), ins, upd


@settings(**SETTINGS)
@given(base=rows_st, new=rows_st)
def test_upsert_matches_dict_model(spark, base, new):
    base = list({r[0]: r for r in base}.values())          # stored keys are unique
    got = sorted(tuple(r) for r in upsert(df(spark, base), df(spark, new), ["k"], ["t"]).collect())
    want, ins, upd = model_upsert(base, new)
    assert got == want
    c = upsert_counts(df(spark, base), df(spark, new), ["k"]).first()
    assert (c.inserted, c.updated) == (ins, upd)


@settings(**SETTINGS)
@given(base=rows_st, new=rows_st)
def test_upsert_idempotent(spark, base, new):
    base = list({r[0]: r for r in base}.values())
    once = upsert(df(spark, base), df(spark, new), ["k"], ["t"])
    twice = upsert(once, df(spark, new), ["k"], ["t"])
    assert sorted(once.collect()) == sorted(twice.collect())


@settings(**SETTINGS)
@given(base=rows_st, new=rows_st, cut=st.integers(0, 25))
def test_newest_merge_split_invariant(spark, base, new, cut):
    base = [(k, v, t) for k, v, t in {r[0]: r for r in base}.values()]
    b = df(spark, base)
    whole = upsert_newest(b, df(spark, new), ["k"], ["t"])
    a, c = new[:cut], new[cut:]
    parts = upsert_newest(upsert_newest(b, df(spark, c), ["k"], ["t"]), df(spark, a), ["k"], ["t"])
    assert sorted(whole.collect()) == sorted(parts.collect())


@settings(**SETTINGS)
@given(names=st.sets(st.text(alphabet="abcxyz ", min_size=1, max_size=6), min_size=1, max_size=40),
       parts=st.integers(1, 7))
def test_numbering_is_dense_and_ordered(spark, names, parts):
    d = spark.createDataFrame([(n,) for n in names], "name string")
    got = number_rows(d, ["name"], "id", num_partitions=parts)
    pairs = sorted((r.id, r.name) for r in got.collect())
    assert [i for i, _ in pairs] == list(range(1, len(names) + 1))
    assert [n for _, n in pairs] == sorted(names, key=lambda s: s.encode())
