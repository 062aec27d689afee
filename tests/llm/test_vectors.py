"""Operators 3 and 6 against brute force."""

import numpy as np
import pytest

from conftest import SF0001, SF001
from sliceflow.llm import itq_dedup, permutation_index as index

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def _rows():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((150, 16))
    rows = [(i, v.tolist(), i % 3, "n") for i, v in enumerate(x)]
    for i in range(60):  # near copies
        y = x[5] + 0.08 * rng.standard_normal(16)
        rows.append((1000 + i, y.tolist(), 2, "n"))
    rows += [(2000 + i, x[7].tolist(), 1, "n") for i in range(30)]  # copies
    rows += [(2100, (2 * x[7]).tolist(), 1, "n"), (2101, x[7].tolist(), None, "n"), (2102, x[7].tolist(), 0, "n")]
    rows += [(3000, None, 1, "n"), (3001, [0.0] * 16, 1, "n"), (3002, [float("nan")] * 16, 1, "n"), (3003, [None] * 16, 1, "n"), (3004, [1.0, 2.0], 1, "n"),
             (3005, [], 1, "n"), (3006, [float("inf")] + [1.0] * 15, 1, "n"), (None, x[9].tolist(), 0, "n"), (100, x[100].tolist(), 1, "n")]
    return rows


def _vectors(rows):
    good = [(r[0], np.array(r[1], dtype=np.float32).astype(float), r[2]) for r in rows if r[1] is not None and len(r[1]) == 16 and None not in r[1]]
    return [g for g in good if np.isfinite(g[1]).all() and g[1].any()]


def test_links_are_those_of_brute_force(spark):
    rows = _rows()
    got = itq_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    good = [g for g in _vectors(rows) if g[2] is not None]
    x = np.array([g[1] / np.linalg.norm(g[1]) for g in good])
    link = (x @ x.T >= 0.98) & (np.array([g[2] for g in good])[:, None] == np.array([g[2] for g in good])[None])
    np.fill_diagonal(link, False)
    root = np.arange(len(good))
    for _ in range(len(good)):
        new = np.array([min(root[i], *(root[link[i]] if link[i].any() else [root[i]])) for i in range(len(good))])
        if (new == root).all():
            break
        root = new
    ids = [g[0] for g in good]
    least = {r: min(i for i, q in zip(ids, root) if q == r and i is not None) for r in set(root) if any(i is not None for i, q in zip(ids, root) if q == r)}
    want = sorted((str(i), int(link[k].sum()), str(least.get(root[k]))) for k, i in enumerate(ids))
    rest = [r[0] for r in rows]
    for i in ids:
        rest.remove(i)
    want = sorted(want + [(str(i), 0, str(i)) for i in rest])
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), SCHEMA)
    key = lambda t: sorted(tuple(map(str, r)) for r in t.collect())
    want = key(itq_dedup.near_vectors(df))
    monkeypatch.setattr(itq_dedup, "BLOCK", 7)
    assert key(itq_dedup.near_vectors(df)) == want


def test_no_vectors(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    assert itq_dedup.near_vectors(df.where("false")).count() == 0
    assert [tuple(r) for r in itq_dedup.near_vectors(df.where("vec_id = 3001")).collect()] == [(3001, 0, 3001, True)]
    assert index.nearest(df.where("false"), df).count() == 0
    assert index.nearest(df, df.where("false")).count() == 0


def _near(rows, queries, k):
    good = [g for g in _vectors(rows) if g[0] is not None]
    good = list({(i, v.tobytes()): (i, v) for i, v, _ in good}.values())
    ids, x = np.array([g[0] for g in good]), np.array([g[1] for g in good])
    out = {}
    for i in queries:
        for a, v in good:
            if a == i:
                d = np.sqrt(((x - v) ** 2).sum(1))
                out.setdefault(i, []).append([(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != i][:k])
    return out


def test_nearest_few_rows(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    asked = [0, 7, 1003, 2000, 2005, 3001]
    got = index.nearest(df, df.where(f"vec_id in ({','.join(map(str, asked))})"), 10).collect()
    want, hits, total = _near(rows, asked, 10), 0, 0
    assert {r["query_id"] for r in got} == set(want)
    for q, (near,) in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in mine] == list(range(1, 11))
        true = dict(_near(rows, [q], 10 ** 6)[q][0])
        assert all(abs(true[v] - s) < 1e-9 for _, v, s in mine)
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        hits, total = hits + len({v for _, v, _ in mine} & {v for v, _ in near}), total + 10
    assert hits / total >= 0.9


def test_all_candidates_if_there_are_fewer(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 0, "n") for i in range(6)], SCHEMA)
    got = index.nearest(df, df.where("vec_id = 2"), 10).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 1.0), (2, 3, 1.0), (3, 0, 2.0), (4, 4, 2.0), (5, 5, 3.0)]


def test_cells_change_nothing(spark, monkeypatch):
    df = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    key = lambda t: sorted(map(tuple, t.collect()))
    want = key(index.nearest(df, df.where("vec_id % 10 = 0")))
    monkeypatch.setattr(index, "BLOCK", 5)
    monkeypatch.setattr(index, "QUERIES", 2)
    assert key(index.nearest(df, df.where("vec_id % 10 = 0"))) == want


@pytest.mark.parametrize("sf", [SF001])
def test_recall(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.toPandas()
    x = np.array(rows["embedding"].tolist(), dtype=float)
    ids = rows["vec_id"].to_numpy()
    got = index.nearest(df, df.where("vec_id % 20 = 0")).toPandas()
    hits = total = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        true = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        hits, total = hits + len(set(true) & set(g["vec_id"])), total + 10
    assert total == 10 * int((ids % 20 == 0).sum()) and hits / total >= 0.9


def test_footrule_is_that_of_the_definition():
    rng = np.random.default_rng(1)
    order = index.orders(rng.standard_normal((50, 4)), rng.standard_normal((12, 4)), 6)
    place = index.places(order, 12)
    for o in order[:10]:
        mine = index.places(o[None], 12)[0]
        assert (index.footrule(place, o) == np.abs(place - mine).sum(1)).all()


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(n).tolist(), 0, "n") for n in (1, 2, 3, 8) for i in range(n * 100, n * 100 + 14)]
    rows += [(900, [1.0, 2.0], 1, "n"), (901, [1.0, 2.0], 1, "n"), (902, [2.0, 4.0], 1, "n"), (903, [1.0, 2.0, 0.0], 1, "n"), (904, [5.0], 1, "n"), (905, [7.0], 1, "n"), (906, [-7.0], 1, "n")]
    df = spark.createDataFrame(rows, SCHEMA)
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in itq_dedup.near_vectors(df).collect()}
    vec = {r[0]: (np.array(r[1], dtype=np.float32).astype(float), r[2]) for r in rows}
    for i, (x, label) in vec.items():
        same = [j for j, (y, other) in vec.items() if j != i and len(y) == len(x) and other == label and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98]
        assert links[i][0] == len(same), i
    assert [links[i][1] for i in range(900, 907)] == [900, 900, 900, 903, 904, 904, 906]
    got = index.nearest(df, df.where("vec_id in (105, 203, 805, 900)"), 4).collect()
    for q in (105, 203, 805, 900):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        near = sorted((float(np.sqrt(((y - vec[q][0]) ** 2).sum())), j) for j, (y, _) in vec.items() if j != q and len(y) == len(vec[q][0]))
        assert len(mine) == 4 and {v for _, v, _ in mine} <= {j for _, j in near}
        assert q != 900 or [v for _, v, _ in mine] == [j for _, j in near[:4]]
