"""Operator 5 against a priority queue and iterated resharing."""

import heapq
import random
import re

from sliceflow.llm.mixing import mix, mixed_documents, sainte_lague, targets


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w, free, left, out = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), float(sum(sizes.values())), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > 3 * sizes[s] * (1 + 1e-12)]
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            free.remove(s)
            left -= out[s]
    return out


def test_targets(spark):
    rng = random.Random(4)
    for n in (1, 2, 5, 40):
        sizes = {f"s{i}": rng.choice([0, 1, rng.randint(1, 50), rng.randint(1, 5000)]) for i in range(n)} | {None: 17, "é": 3, "Z": 900}
        got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = _targets(sizes)
        assert all(abs(r["target"] - want[r["source"]]) < 1e-6 for r in got) and len(got) == len(sizes)


def _queue(units, seats):
    won, heap = {k: 0 for k, _ in units}, [(-e / 0.5, k, e) for k, e in units if e > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, k, e = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-e / (won[k] + 0.5), k, e))
    return won


def test_apportionment_is_that_of_a_queue(spark):
    rng, rows, want = random.Random(6), [], {}
    for g in range(60):
        units = [(k, float(rng.choice([0, 1, 7, rng.randint(1, 100), rng.randint(1, 10 ** 6)]))) for k in range(rng.randint(1, 30))]
        seats = rng.choice([0, 1, 3, rng.randint(0, 2000)])
        rows += [(g, k, e, seats) for k, e in units]
        want |= {(g, k): n for k, n in _queue(units, seats).items()}
    got = sainte_lague(spark.createDataFrame(rows, "g int, k int, e double, seats long"), ["g"], ["k"], "e", "seats", "quota").collect()
    assert {(r["g"], r["k"]): r["quota"] for r in got} == want


def _docs(spark, n=400):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 200])) + "\n", rng.choice(["hot"] * 6 + ["a", "b", "é", None]), i) for i in range(n)]
    rows += [(7, None, "a", 1), (7, "same id", "a", 2), (None, "no id at all", "b", 3), (8, rows[8][1], rows[8][2], 8), (9000, "x " * 50_000, "long", 4)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size long")


def test_mix_meets_targets(spark):
    rows, docs = _docs(spark)
    got = mix(docs, shard=1500).collect()
    assert len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    want, taken = _targets(sizes), {}
    for r in got:
        assert r["size"] == count(r["text"]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 16 for s in want), (taken, want)
    again = mix(docs.repartition(7), shard=1500).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows(spark):
    _, docs = _docs(spark)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {}
    for r in mix(docs).collect():
        k = (r["doc_id"], r["text"], r["source"])
        taken[k] = taken.get(k, 0) + (int(r["taken"] / r["size"] + 0.5) if r["size"] else 0)
    got = {}
    for r in out.collect():
        k = (r["doc_id"], r["text"], r["source"])
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in taken.items() if n}


def test_no_documents(spark):
    _, docs = _docs(spark)
    assert mix(docs.where("false")).count() == 0
    assert mix(docs.where("text is null")).first()["taken"] == 0
