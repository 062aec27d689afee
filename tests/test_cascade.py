"""J5 over a schema with several levels, several parents and a table that refers to itself."""

import random

import pytest

from sliceflow.operators import history as H


def test_cascade(spark):
    rng = random.Random(1)
    a = [(i,) for i in range(20)]
    b = [(i, rng.choice([None, *range(20)])) for i in range(60)]
    c = [(i, rng.choice([None, *range(60)]), rng.choice([None, *range(20)]), i - 1 if i % 7 else None) for i in range(120)]
    tables = {"c": spark.createDataFrame(c, "c_id int, b_ref int, a_ref int, up int"), "a": spark.createDataFrame(a, "a_id int"), "b": spark.createDataFrame(b, "b_id int, a_ref int")}
    links = [("b", "a_ref", "a"), ("c", "b_ref", "b"), ("c", "a_ref", "a"), ("c", "up", "c")]
    got = H.cascade(tables, {"a": "a_id", "b": "b_id", "c": "c_id"}, links, {"a": tables["a"].where("a_id in (3, 4)"), "c": tables["c"].where("c_id = 71")})
    gone_a = {3, 4}
    gone_b = {i for i, p in b if p in gone_a}
    gone_c = {71}
    for i, pb, pa, up in c * 8:
        if pb in gone_b or pa in gone_a or up in gone_c:
            gone_c.add(i)
    assert [sorted(r[0] for r in got[t].collect()) for t in "abc"] == [sorted(x) for x in (gone_a, gone_b, gone_c)]
    with pytest.raises(ValueError, match="circle"):
        H.cascade(tables, {"a": "a_id", "b": "b_id", "c": "c_id"}, [("a", "a_id", "b"), ("b", "a_ref", "a")], {})
