"""Operators 8 and 9 and the pipeline."""

import random
import signal
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF0001, SF001
from sliceflow.llm import shingle_join as join, toxicity
from sliceflow.llm.common import connected_components, shingle_set, word_hashes

# ------------------------------------------------------------------ shingles


def _components(rows, k, percent):
    """(n_shingles, component) of each row, by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and i is not None and j is not None:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)]


def _texts():
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400))
    rows, n = [(0, None), (1, ""), (2, "one"), (3, "ONE\t"), (4, "one two"), (5, " \n "), (6, "Él\xa0x"), (None, "one")], 10
    passage = " ".join(word() for _ in range(60))
    for size in (3, 4, 9, 11, 20, 21, 40, 100, 150, 400, 1500):
        base = [word() for _ in range(size)]
        for _ in range(14):
            x = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, size // 20, size // 12])):
                if rng.random() < 0.5:
                    x[rng.randrange(len(x))] = word()
                elif len(x) > 1:
                    del x[rng.randrange(len(x))]
            rows.append((n, " ".join(x)))
            n += 1
    rows += [(n + i, " ".join(word() for _ in range(rng.randint(20, 90))) + "\n" + passage) for i in range(30)]
    rows += [(12, rows[40][1]), (12, "another text of the same id"), (500, "another text of the same id"), (501, rows[41][1])]
    return rows


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, k, percent):
    rows = _texts()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int").repartition(5)
    got = join.similar_documents(df, k, percent)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, _components(rows, k, percent)))


def test_blocks_change_nothing(spark, monkeypatch):
    rows = _texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name, n in (("SMALL", 3), ("BLOCK", 4), ("BLOCK_SHINGLES", 2000)):
        monkeypatch.setattr(join, name, n)
    assert sorted(map(str, map(tuple, join.similar_documents(df, 3, 90).collect()))) == sorted(map(str, _components(rows, 3, 90)))


def test_no_documents_to_join(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert join.similar_documents(df, 3, 90).count() == 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n, percent = int(rng.integers(1, 300)), int(rng.choice([80, 90]))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        d = (100 - percent) * 2 * len(a) // (100 + percent)
        drop = int(rng.integers(0, d + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 62, max(0, d - drop)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
            assert len(np.intersect1d(join.part_keys(a, percent), join.part_keys(b, percent)))
            far = len(a) + len(b) - 2 * both
            x, y = join.bit_sketch(a), join.bit_sketch(b)
            assert len(x) != len(y) or np.bitwise_count(x ^ y).sum() <= far


def test_sets_two_bands_apart_share_a_key():
    rng = np.random.default_rng(4)
    for percent in (50, 55, 60, 66):
        for n in (1, 2, 3, 5, 10, 17, 40, 200):
            b = np.unique(rng.integers(0, 1 << 62, n * 100 // percent).astype(np.uint64))
            a = np.sort(rng.permutation(b)[:n])
            assert len(np.intersect1d(join.part_keys(a, percent), join.part_keys(b, percent))), (percent, n)
    assert [b for b, _ in join.bands(10, 50)] == [5, 6, 7] and len(join.bands(10, 90)) == 1


def test_parts_of_all_bands_are_found():
    def late(*_):
        raise TimeoutError
    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(20)
    try:
        for percent in range(50, 100):
            for band in range(50):
                parts, spare = join._parts(band, percent)
                need = (100 - percent) * 2 * (join._border(band + 1) - 1) // (100 + percent) + 1
                assert parts == need + spare and join.MARGIN <= spare <= join.MARGIN + need
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)


def test_long_sets_that_have_nothing_in_common_do_not_meet():
    rng = np.random.default_rng(6)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, n))) for n in (1200, 1300, 1500, 2900, 3000, 3200) for _ in range(10)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts), pa.array(range(60))], names=["id", "text", "hash"])
    rows = pa.Table.from_batches(join._first_pass(5, 80)(iter([docs]))).to_pylist()
    keys = Counter(r["key"] for r in rows if r["kind"] == 1)
    assert len(keys) > 5000 and max(keys.values()) <= 2
    sets = [r for r in rows if r["kind"] == 2]
    node, size, short = np.array([r["node"] for r in sets]), np.array([r["size"] for r in sets]), [np.frombuffer(r["short"], np.uint64) for r in sets]
    assert len(sets) == 60 and join._cell(node, size, short, None, 80) == []
    assert {tuple(sorted(e)) for e in join._cell(node[[0, 0]] + [0, 1], size[[0, 0]], [short[0]] * 2, None, 80)} == {(node[0], node[0] + 1)}


def test_words_and_shingles():
    data = b" one\ttwo\n\x0bone \xc3\xa9 " + b"x" * 3_000_000 + b" one"
    h, start = word_hashes(data)
    assert len(h) == 6 and h[0] == h[2] == h[5] and len(set(h.tolist())) == 4 and start[0] == 1
    assert len(shingle_set(h[:0], 3)) == 0 and len(shingle_set(h[:2], 3)) == 1 and len(shingle_set(h, 3)) == 4


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(5, i) for i in range(1000, 1300)] + [(-7, 5), (50, 50), (1200, 1201)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {i: 100 for i in range(100, 401)} | {i: -7 for i in range(1000, 1300)} | {-7: -7, 5: -7}


# ------------------------------------------------------------------ toxicity


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.character_model(spark.read.parquet(f"{SF001}/documents.parquet"))


def test_disguised_words_are_restored(model):
    for said, meant in (("1d10t", "idiot"), ("st00pid", ("stoopid", "stopid")), ("l0ser", "loser"), ("tr4sh!", "trash"), ("m0r0n", "moron"), ("looooser", None), ("p@thet1c", "pathetic"),
                        ("i.d.i.o.t", "idiot"), ("t r a s h", "trash"), ("plain", "plain"), ("2024", "2024")):
        got = toxicity.restored_words(said, model)
        assert meant is None or set([meant] if isinstance(meant, str) else meant) & set(got) or got == [] and meant == "2024", (said, got)
    assert toxicity.restored_words("looooser", model)[0] in ("loser", "looser")
    assert "s c u m" in toxicity.tokens("You S c u m here") and toxicity.tokens("") == set()


def test_no_disguise_passes_the_gate(model):
    for said, meant in (("i d i o t.", "idiot"), ("t r a s h!", "trash"), ("s c u m.", "scum"), ('"i d i o t"', "idiot"), ("(i d i o t)", "idiot"), ("t r @ s h", "trash"), ("i.d.1.0.t", "idiot"),
                        ("m-0-r-0-n", "moron"), ("$ c u m", "scum"), ("i,d,i,o,t", "idiot"), ("i/d/i/o/t", "idiot"), ("a s s", "ass"), ("losser", "loser"), ("(1d10t)", "idiot"), ("1d10t.***", "idiot")):
        got = {w for t in toxicity.tokens(f"You {said} here") for w in toxicity.restored_words(t, model)}
        assert meant in got, (said, got)
    assert toxicity.tokens("s c u m bag") == {"s", "c", "u", "m", "bag", "s c u m"}
    assert toxicity.restored_words("$2,024.50", model) == toxicity.restored_words("555-5699!!", model) == []


def test_only_near_copies_teach_once(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    # unrelated texts, all with the same long word of the smallest hash
    long = [word() for _ in range(4000)]
    smallest = spark.createDataFrame([(w,) for w in long], "w string").orderBy(F.xxhash64("w")).first()[0]
    rows = [(i, i % 2, sorted({smallest, *rng.sample(long, 60)})) for i in range(40)]
    base = [word() for _ in range(100)]
    copies = [(100 + i, 1, sorted({*base[i:], word()})) for i in range(5)] + [(200, 1, rows[1][2]), (201, 0, sorted(base))]
    got = toxicity.teaching_rows(spark.createDataFrame(rows + copies, "id long, label int, words array<string>").repartition(3)).collect()
    want = rows + [copies[0], copies[-1]]
    assert sorted((r["label"], r["words"]) for r in got) == sorted((x, w) for _, x, w in want)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_documents(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    both = got.merge(labels.toPandas(), on="doc_id")
    both = both[both["held_out"] & both["toxic"].notna()]
    right = (both["predicted"] == both["toxic"])
    assert right.mean() >= 0.95 and right[both["toxic"] == 1].mean() >= 0.8


def test_held_out_labels_teach_nothing(spark, model):
    docs, labels = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("toxic", __import__("pyspark").sql.functions.expr("CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END"))
    assert toxicity.fit(docs, labels, model) == toxicity.fit(docs, other, model)


def test_edge_rows_are_scored(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (3, "idiot " * 60_000, "x"), (3, "idiot " * 60_000, "x"), (4, "fine words", "x")] + [
        (100 + i, ("idiot and more of it " if i % 4 == 0 else "calm words are here ") + "abcdefghij"[i % 10] * 2 + "klmnopqrstuvwxyzabcd"[i // 10] * 3, "x") for i in range(200)]
    labels = [(i, int(i % 4 == 0)) for i in range(100, 300)] + [(100, 1), (101, None), (None, 1), (10 ** 9, 1)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[3]["predicted"] == by[None]["predicted"] == 1 and by[1]["score"] == by[2]["score"] and by[4]["predicted"] == by[2]["predicted"] == 0
    assert by[None]["held_out"] is False
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2, 4}
    assert toxicity.score_documents(docs.where("false"), labels).count() == 0
    assert {r["score"] for r in toxicity.score_documents(docs, labels.where("false")).collect()} == {0.5}


# ------------------------------------------------------------------ pipeline


def test_ids_are_names_only(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, one, "x"), (1, two, "x"), (2, two + " end", "x"), (None, one, "x"), (None, three, "z"), (None, three, "y"), (3, one, "x"), (4, None, "x"), (5, "", "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = corpus_pipeline.near_duplicates(spark, docs, SF0001)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, one, "x"), (1, two, "x"), (None, three, "y"), (4, None, "x"), (5, "", "x")]))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    at, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        before, at = at, stage(spark, at, SF0001)
        seen.append(name)
        if name != "packing":
            assert at.columns == docs.columns
        rows = at.collect()
        if name == "near_duplicates":
            texts = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert sorted(r["doc_id"] for r in rows) == sorted({c for i, _, c in _components(texts, 5, 80)})
        if name == "toxicity":
            want = toxicity.score_documents(docs, spark.read.parquet(f"{SF0001}/labels.parquet")).where("predicted = 0")
            assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in want.collect())
        at = spark.createDataFrame(rows, at.schema)
    assert seen == ["toxicity", "near_duplicates", "mixing", "packing"] and {"doc_id", "piece", "sequence_id", "offset"} <= set(at.columns)
