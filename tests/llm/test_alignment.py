"""Operator 12 against whole-text tokenising and a comparison of all token pairs."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from sliceflow.llm import alignment, common
from sliceflow.llm.alignment import align_documents, pair_counts, write_alignments
from sliceflow.llm.tokenizing import encoder, piece_encoder

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = [" ", "\n", "word", "Word.", "'s", "  ", "\t", "\r", "!?", "é", "́", "12", "\xa0", "　", "<|endoftext|>", "</s>", "<0x41>", "ß", "ﬁ", "中文",
         "\U0001f600", "unbelievably", "Donaudampfschiff", "a,", "<unk>", "\x00", "\x7f"]


def _texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_ids_are_those_of_the_whole_text():
    texts = _texts(3000) + ["", " ", "  ", "\n", " \n ", "x\n\ny", "\nx", " x ", "a  b   c"]
    e = piece_encoder(B)
    assert e.by_word
    want = [e.model.encode(t) for t in texts]
    for t, got, ids in zip(texts, e.ids(texts), want):
        same = b"".join(e.bytes[i] for i in ids) == b" " + t.encode()
        assert t == "" or (got.tolist() == ids if same else got is None), repr(t)
    assert e.ids(["a▁b", "ab"])[0] is None
    plain = encoder(A, plain=True)
    assert [x.tolist() for x in plain.ids([" " + t for t in texts])] == [plain.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert 50256 not in plain.ids(["x <|endoftext|>"])[0]


def _brute(texts):
    """Per text (n_a, n_b, groups text, links)."""
    a_tok, b_tok = encoder(A, plain=True).tokenizer, piece_encoder(B)
    with open(A, encoding="utf-8") as f:
        vocabulary = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    out = []
    for t in texts:
        a = a_tok.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_tok.model.encode(t or "")
        lengths = [len(vocabulary[i]) for i in a], [len(b_tok.bytes[i]) for i in b]
        if not t or b"".join(b_tok.bytes[i] for i in b) != b" " + t.encode() or sum(lengths[0]) != sum(lengths[1]):
            out.append((0, 0, "", []))
            continue
        spans = [[(sum(n[:k]), sum(n[:k + 1])) for k in range(len(n))] for n in lengths]
        links = [(a[i], b[j]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, at = [], 0
        for e in shared:
            side = [[i for i, s in zip(ids, sp) if at < s[1] <= e] for ids, sp in zip((a, b), spans)]
            groups.append("|".join(",".join(map(str, x)) for x in side))
            at = e
        out.append((len(a), len(b), ";".join(groups), links))
    return out


@pytest.mark.parametrize("slices", [1, 4])
def test_alignments(spark, slices, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_SLICES", slices)
    monkeypatch.setattr(common, "SLICE_CHARS", 300)
    texts = [*_texts(60, 8), None, "", "a▁b", "one two", "one two", "Lorem ipsum dolor sit amet, " * 30]
    rows = [(i % 50 if i % 9 else None, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, Text2 int").repartition(3)
    got = align_documents(docs, A, B, with_groups=True).collect()
    brute = _brute(texts)
    n = Counter(x for *_, links in brute for x in links)
    most = defaultdict(int)
    for (_, b), k in n.items():
        most[b] = max(most[b], k)
    want = []
    for (doc, t, *_), (n_a, n_b, groups, links) in zip(rows, brute):
        want.append((doc, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links),
                     hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r[3] for r in want) and any(r[1] == 0 and t for r, t in zip(want, texts))
    counts = pair_counts(write_alignments(docs, A, B)).collect()
    assert {(r["a"], r["b"]): r["n"] for r in counts} == dict(n)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_documents(docs, A, B).collect() == []
