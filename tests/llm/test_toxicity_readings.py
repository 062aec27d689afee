"""Operator 8: Viterbi against all readings, and the short way for plain words."""

import itertools
import random

import numpy as np

from sliceflow.llm import toxicity as T

TOKENS = ["1d10t", "tr@sh", "s.c.u.m", "m0r0n", "scuumm", "looose", "a1!", "$cum", "1337", "b-a-d", "xx", "o0o", "éé1", "t r a", "((", "aaaa", "a", "ßß0"]


def _model(seed):
    p = np.random.default_rng(seed).dirichlet(np.ones(T._SIZE) * 0.3, (T._SIZE, T._SIZE)) + 1e-6
    return np.log(p).astype(np.float32)


def _best(token, model):
    places, at = [], 0
    for m in T._CHOICE.finditer(token):
        places += [[(c, 0.0)] for c in token[at:m.start()]] + [T._options(token[m.start()], m.end() - m.start())]
        at = m.end()
    places += [[(c, 0.0)] for c in token[at:] + " "]
    found = []
    for reading in itertools.product(*places):
        text, cost, a, b = "".join(t for t, _ in reading), sum(p for _, p in reading), 0, 0
        for c in text:
            z = T._ID.get(c, 0)
            cost, a, b = cost - float(model[a, b, z]), b, z
        found.append((cost, text.strip()))
    return min(found)[1]


def test_decode_finds_the_cheapest_of_all_readings():
    rng = random.Random(2)
    signs = "abcl01@$.- e3"
    for seed in range(4):
        model = _model(seed)
        for token in TOKENS + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 8))) for _ in range(60)]:
            assert T.decode(token, model) == _best(token, model), token


def test_plain_words_without_a_weight_are_known_at_once():
    rng, model = random.Random(5), _model(9)
    weights = {"=trash": 2.0, "^idio": 1.0, "=loose": 0.7, "^aabb": 0.4, "=ass": 3.0, "=été": 1.0}
    hits = T._Hits(model, weights)
    tokens = ["trash", "trash.", "ttrash", "trrash,", "idiotic", "iddiot", "loose", "loooose", "lose", "aabbc", "abbc", "aaabbbcc", "ass", "asss", "aas", "étééé", "x", "", ".", "..", "a.b", "cat", "caat,"]
    tokens += ["".join(rng.choice("aabbloset") * rng.randint(1, 3) for _ in range(rng.randint(1, 6))) + rng.choice(["", ".", ",", ",."]) for _ in range(3000)]
    for t in tokens:
        want = tuple((w, x) for w in T.restored_words(t, model) if len(w) > 2 and (x := T.word_weight(w, weights)) > 0)
        assert hits[t] == want, t
    assert sum(map(bool, hits.values())) > 20 and any(hits._without(t) for t in tokens)


def test_near_copies_teach_once(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(400)]
    base = rng.sample(words, 80)
    rows = [(1, 1, sorted(base)), (2, 1, sorted(base)), (3, 1, sorted(base[:-1])), (4, 0, sorted(base)), (5, 1, sorted(base[:40] + rng.sample(words, 40)))]
    rows += [(10 + i, i % 2, sorted(rng.sample(words, 60))) for i in range(30)] + [(90, 1, [])]
    got = T.teaching_rows(spark.createDataFrame(rows, "id long, label int, words array<string>")).collect()
    # of the copies (1, 2) and the near copy (3) one of a label teaches; what shares half of its words does too
    want = [r for r in rows if r[0] not in (2, 3)]
    assert sorted((r["label"], r["words"]) for r in got) == sorted((label, w) for _, label, w in want)
