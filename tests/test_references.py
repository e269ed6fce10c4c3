import datetime

from cairnflow.operators import references as R

T = lambda h: datetime.datetime(2025, 1, 1) + datetime.timedelta(hours=h)
SCHEMA = "id string, ref string, is_deleted boolean, loaded_at timestamp, at string, key string"
TARGETS = {"a": {"ref": "b"}}


def orphans(spark, a, b):
    layers = {n: spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA) for n, rows in (("a", a), ("b", b))}
    return sorted((r.id, r.ref_id, r["at"].hour) for r in R.orphan_references(layers, TARGETS).collect())


def test_order_of_loading(spark):
    b = [("k1", None, False, T(2)), ("k1", None, True, T(4)), ("K1 ", None, False, T(6))]
    a = [(f"f{h}", " k1", False, T(h)) for h in range(1, 8)]
    assert orphans(spark, a, b) == [("F1", "K1", 1), ("F4", "K1", 4), ("F5", "K1", 5)]


def test_lists_placeholders_and_deleted_rows(spark):
    a = [("f", "x1, X1;none|0,-1 ,NaN\tx2", False, T(1)), ("g", "x3", True, T(1)), ("h", None, False, T(1)), ("i", "", None, None)]
    assert orphans(spark, a, [("X2", None, None, None)]) == [("F", "X1", 1)]


def test_days_carry_and_copies(spark):
    b = [("k", None, False, T(0)), ("k", None, False, T(0)), ("k", None, True, T(30)), ("k", None, False, T(30))]
    a = [("f", "k", False, T(h)) for h in (5, 29, 80)]
    assert orphans(spark, a, b) == []
    assert orphans(spark, a, b[:1] + [("k", None, True, T(30))]) == [("F", "K", 8)]


def test_empty_tables(spark):
    assert orphans(spark, [], []) == []
    assert orphans(spark, [("f", "k", False, T(0))], []) == [("F", "K", 0)]


def test_signed_counts_sum_to_the_state(spark):
    b = [("k", None, False, T(1)), ("k", None, False, T(2)), ("k", None, True, T(30)), ("k", None, True, T(31))]
    layers = {"a": spark.createDataFrame([("f", "k", False, T(40), "", "")] * 2, SCHEMA), "b": spark.createDataFrame([(*r, "", "") for r in b], SCHEMA)}
    rows = R.signed_counts(layers, TARGETS).where("target = 'b'").orderBy("at").collect()
    assert [r.delta for r in rows] == [1, 0, -1, 0, 0]
    assert [r.existence for r in rows] == [1, 1, 0, 0, 0]
    assert sum(r.refs for r in rows) == 2


def test_states_are_maintained_in_any_order(spark):
    """Batches of deliveries, put onto stored states in any order, give what all of them give at once."""
    import datetime
    import itertools

    at = lambda d: datetime.datetime(2025, 1, d)
    schema = "id string, pre_id string, is_deleted boolean, loaded_at timestamp"
    batches = [[("a", "b,c", False, at(1)), ("b", None, False, at(2))], [("b", None, True, at(4)), ("a", "B", False, at(3)), (None, "b", None, None)], [("c", "x", False, at(5)), ("b", "a", True, at(2))], []]
    frames = [spark.createDataFrame(b, schema) for b in batches]
    targets = {"l": {"pre_id": "l"}}
    whole = spark.createDataFrame([r for b in batches for r in b], schema)
    rows = lambda df: sorted((r.target, r.key, r.state, r.state_at, r.refs) for r in df.collect())
    want = rows(R.key_states({"l": whole}, targets))
    assert {(r.key, r.refs) for r in R.current_orphans(R.key_states({"l": whole}, targets)).collect()} == {("B", 3), ("X", 1)}
    for order in itertools.islice(itertools.permutations(frames), 0, 24, 7):
        states = R.key_states({"l": order[0]}, targets)
        for batch in order[1:]:
            states = R.maintain(states, R.key_states({"l": batch}, targets))
        assert rows(states) == want
