"""Operators 1 and 2: tokenizing, token files, packing."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from sliceflow.llm.common import shared_folder, text_slices
from sliceflow.llm.packing import TightestFit, pack, pack_documents, plan_best_fit, sequences, token_pieces
from sliceflow.llm.token_files import BATCH, TokenFile, read_token_files, write_token_files
from sliceflow.llm.tokenizing import encoder

LONG = "Lorem ipsum dolor, sit amet. " * 12_000
DOCS = [(5, "one two", "a", 1), (3, None, "b", 2), (3, "", "c", 3), (9, LONG, None, 4), (4, "  tabs\tand\n\n\nlines <|endoftext|> x", "e", 5),
        (5, "one two", "a", 1), (None, "no id", "f", 6), (-2, "é ß 中文 \U0001f600", "g", 7)]
SCHEMA = "doc_id long, text string, ids string, start long"


def test_cached_ids_are_those_of_the_library():
    rng = random.Random(5)
    parts = [" ", "\n", "word", "Word.", "'s", "  ", "\t", "\r", "!?", "é", "\u0301", "12", "\xa0", "\u3000", "<|endoftext|>", "\x1c", "ß", "İ", "a,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + [LONG[:5000]]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.json"):
        e = encoder(P.path(name))
        assert [x.tolist() for x in e.ids(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_slices_cover_everything():
    texts = ["a" * n for n in (0, 5, 900, 3, 1, 1, 2000, 0)] + [None]
    cuts = list(text_slices(texts, 1000))
    assert [x for i, j in cuts for x in texts[i:j]] == texts and len(cuts) > 2


def _ids(name, text, end):
    return [*encoder(P.path(name)).tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("shards", [1, 3])
def test_token_files(spark, shards):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    m = write_token_files(docs, shared_folder(spark, "t"), P.path("byte_bpe_50k.json"), 2, length=64, shards=shards)
    got = sorted(map(tuple, read_token_files(m).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    rows = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for d, t, *_ in rows:
        x = _ids("byte_bpe_50k.json", t, 2)
        want.append((d, at, len(x), _crc(x)))
        at += len(x)
    assert got == want
    # random access gives views of the mapped file, and masks that cover the tokens
    row = max(m.collect(), key=lambda r: r["n_tokens"])
    file = TokenFile(row["tokens_uri"])
    assert len(file) == row["n_sequences"] > BATCH
    data = [file.ids(i) for i in range(len(file))]
    assert all(len(x) == 64 and not x.flags.owndata for x in data) and data[0].dtype == np.uint16
    assert sum(int(file.mask(i).sum()) for i in range(len(file))) == row["n_tokens"]
    base = file.source.size()
    assert base >= row["n_tokens"] * 2
    with pytest.raises(IndexError):
        file.ids(len(file) + BATCH)


def test_token_files_of_nothing(spark):
    m = write_token_files(spark.createDataFrame([], SCHEMA), shared_folder(spark, "t"), P.path("byte_bpe_50k.json"), 2)
    assert m.count() == 0 and read_token_files(m).count() == 0


def _best_fit(lengths, capacity):
    """Best-fit decreasing, piece by piece: remaining room of each sequence."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([1, 7, 32, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, ranks = {}, {n: set() for n in counts}
        for n, rank, k, first, offset in plan_best_fit(counts, capacity):
            for i in range(k):
                assert used.get(first + i, 0) == offset  # gapless
                used[first + i] = offset + n
                ranks[n].add(rank + i)
        assert all(ranks[n] == set(range(c)) for n, c in counts.items())
        assert sorted(capacity - x for x in used.values()) == _best_fit(lengths, capacity)


def test_segment_tree_finds_the_tightest():
    rng, tree, rooms = random.Random(2), TightestFit(50), []
    for _ in range(500):
        r = rng.randint(0, 50)
        tree.add(r, 1)
        rooms.append(r)
        need = rng.randint(0, 50)
        assert tree.find(need) == min((x for x in rooms if x >= need), default=None)
        if len(rooms) > 20:
            gone = rooms.pop(rng.randrange(len(rooms)))
            tree.add(gone, -1)


def test_packing_keeps_every_token(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    got = pack_documents(docs, capacity=128).collect()
    want = []
    for d, t, *_ in DOCS:
        x = _ids("word_bpe_49k.json", t, 0)
        want += [(d, k, i, len(x[i: i + 128]), _crc(x[i: i + 128])) for k, i in enumerate(range(0, len(x), 128))]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for x in bins.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 128
    assert len(bins) == len(_best_fit([w[3] for w in want], 128))
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 40)) for i in range(120)], "doc_id long, text string").repartition(4)
    pieces = token_pieces(docs, P.path("word_bpe_49k.json"), 0, 32, with_ids=True)
    rows = sequences(pack(pieces, 32)).collect()
    assert all(sum(r["lengths"]) == len(r["input_ids"]) <= 32 for r in rows)
    assert sum(len(r["input_ids"]) for r in rows) == sum(i % 40 + 1 for i in range(120))


def test_lengths_beyond_the_capacity_are_refused(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(5, 0, 0)], "length long, part int, rank long"), 4)
