"""Operator 11 against a plain-Python scorer, and its accuracy on held-out texts."""

import math
import re
import zlib
from collections import Counter, defaultdict

from conftest import SF001
from sliceflow.llm.language_id import LONGEST, PENALTY, identify, learn, with_language

WORD = re.compile(r"[^\W\d_]+")
TAUGHT = [(1, "The cat and the dog saw the bird", "en", 0), (2, "the end of the day. The START", "en", 0), (3, "der Hund und die Katze, der Vogel", "de", 0),
          (4, "das Ende des Tages und der Anfang", "de", 0), (5, "le chat et le chien", "fr", 0), (6, None, "fr", 0), (7, "ohne Namen", None, 0), (8, "", "en", 0),
          (3, "der Hund und die Katze, der Vogel", "de", 0), (None, "sin id", "es", 0)]
ASKED = ["the cat", "die Katze", "le chien et la fin", "CATS", "Hunde und Hündinnen", "123 456 _", "", None, "日本語", "qqq zzz", "x", "the " * 5000 + "der", "ohne", "İstanbul"]


def _brute(taught, text):
    count = defaultdict(lambda: defaultdict(Counter))
    for _, t, lang, _ in taught:
        for w in WORD.findall(t.lower()):
            count[0][lang][w] += 1
            for n in range(1, LONGEST + 1):
                count[n][lang].update((f" {w} ")[i:i + n] for i in range(len(w) + 3 - n))
    langs = sorted({r[2] for r in taught if count[0][r[2]]})

    def cost(kind, x):
        if not any(count[kind][g][x] for g in langs):
            return None
        return [min(PENALTY, -math.log10(count[kind][g][x] / sum(count[kind][g].values()))) if count[kind][g][x] else PENALTY for g in langs]

    found = []
    words = WORD.findall((text or "").lower())
    for w in words:
        c = cost(0, w)
        for n in range(LONGEST, 0, -1):
            if c:
                break
            grams = [y for y in (cost(n, f" {w} "[i:i + n]) for i in range(len(w) + 3 - n)) if y]
            c = [sum(y[k] for y in grams) / len(grams) for k in range(len(langs))] if grams else None
        if c:
            found.append(c)
    if not words:
        return "und", 0.0
    mean = [sum(c[k] for c in found) / len(found) if found else 0.0 for k in range(len(langs))]
    share = [10 ** (min(mean) - m) for m in mean]
    return langs[mean.index(min(mean))], max(share) / sum(share)


def test_scores(spark):
    docs = spark.createDataFrame(TAUGHT, "doc_id long, text string, lang string, score int")
    model = learn(docs)
    asked = spark.createDataFrame([(i, t, "zz", 3) for i, t in enumerate(ASKED)], "k int, text string, Lang string, predicted2 int")
    got = with_language(asked, model)
    assert got.columns == ["k", "text", "Lang", "predicted2", "lang_pred", "score"]
    taught = [r for r in TAUGHT if r[1] is not None and r[2] is not None]
    for r in got.collect():
        lang, score = _brute(taught, r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-4, r


def test_a_bounded_sample_of_each_language(spark):
    rows = [(i, f"word{chr(97 + i % 26)} eins", "en" if i % 3 else "de") for i in range(400)]
    model = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7), limit=10)
    assert model.names == ["de", "en"]
    again = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), limit=10)
    assert all((x == y).all() for a, b in zip(model.tables, again.tables) for x, y in zip(a, b))


def test_nothing_learned_and_empty(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in identify(docs).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert identify(docs.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r["doc_id"]: r for r in identify(docs).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert len(got) == len(rows)
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows if got[r["doc_id"]]["held_out"]]
    assert len(right) > 200 and sum(right) / len(right) >= 0.98
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in got.values())
