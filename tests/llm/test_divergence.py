"""Operator 13 against sums over all terms in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sliceflow.llm.divergence import divergences

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, min_docs, top):
    n, df = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        n[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, k in df[lang].items() if k >= min_docs)
        total = Counter({t: sum(n[lang, s][t] for s in sources) for t in kept})

        def p(counts):
            d = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // d for t in kept}

        def f(x, y):
            return (x - y) ** 2 // (x + y)
        of, whole = {s: p(n[lang, s]) for s in sources}, p(total)
        for s in sources:
            for part, items in (("pair", [(sum(f(of[s][t], of[o][t]) for t in kept), o) for o in sources - {s}]),
                                ("term", [(f(of[s][t], whole[t]), t) for t in kept if n[lang, s][t] and of[s][t] > whole[t]])):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def _rows():
    rng = random.Random(4)
    words = ["The", "the", "cat", "Ärger", "ärger", "x1y", "日本", "don't", "a_b", "[z]", "é"] + ["w" + chr(97 + i) for i in range(20)]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s1", "s2", "S2", None, "s5", "é"]))
            for _ in range(200)]
    return rows + [(None, "en", "quiet"), ("", "fr", "a"), ("rare", "fr", "b"), ("12 34", "one", "only"), *[("the the cat", "en", "s0")] * 5]


@pytest.mark.parametrize("min_docs,group_block,term_block", [(2, 32, 4096), (3, 2, 5), (1, 1, 3)])
def test_divergences(spark, min_docs, group_block, term_block):
    rows = _rows()
    docs = spark.createDataFrame([(i, *r, 7, "x") for i, r in enumerate(rows)], "doc_id int, text string, lang string, source string, n int, term string").repartition(5)
    got = divergences(docs, min_docs, 3, group_block, term_block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _brute(rows, min_docs, 3)


def test_counts_beyond_nine_digits():
    import numpy as np
    from sliceflow.llm.divergence import _probabilities

    n, d = [0, 7, 10**12, 8 * 10**12], [10**3, 10**15, 3 * 10**15, 8 * 10**15]
    assert _probabilities(np.array(n), np.array(d)).tolist() == [1 + 10**9 * (x + 2) // y for x, y in zip(n, d)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergences(docs).collect() == []
