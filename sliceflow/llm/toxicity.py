"""Operator 8: toxicity of whole texts after noisy-channel deobfuscation.

1. A character trigram model is counted over all documents.
2. Tokens with more than one reading (letters mixed with digits, signs or
   separators, repeated letters, runs of single letters and signs) become
   lattices: each position lists what it may stand for and what that costs in
   the channel. Viterbi decoding under the character
   model picks the text that is restored.
3. Words of the restored text and their beginnings carry weights learned from
   labelled documents; a document's score is the probability that they add up to.

Labels, language, source and id are not inputs of a score.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sliceflow.llm.common import hash_sample, only, per_process, spill, text_slices, worker

#: what characters stand for in disguised words (fixed values)
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = set(".-_*~·,'`:;/\\ ")
#: channel costs: a sign read as a letter, kept as it is, a separator dropped or
#: kept, a run of letters read as one or as two, a double letter read as one
SWAP, KEEP, DROP, STAY, ONE, TWO, SINGLE = 0.5, 14.0, 0.2, 4.0, 0.7, 0.7, 3.0
#: labelled documents that the weights are learned from, at most
TRAIN_DOCS = 20_000
#: tokens whose weights a worker keeps; changes speed only
KEPT = 400_000
THRESHOLD = 0.7
#: near copies agree in so many of their min-hashes; bands of four find them
HASHES, ALIKE = 64, 52

_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœšž"
_SIZE = 64
_ID = {c: i + 1 for i, c in enumerate(_LETTERS)}
_TABLE = np.zeros(0x180, dtype=np.uint32)
for _c, _i in _ID.items():
    _TABLE[ord(_c)] = _i
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = "".join(c for c in LEET if not c.isdigit())
#: letters, none of them twice in a row: nothing but itself
_PLAIN = re.compile(r"(?:([^\W\d_])(?!\1))*\Z")
#: digits and separators, perhaps with a currency or a plus: a number
_NUMBER = re.compile(r"[$€£+]?[\d.\-_*~·,'`:;/\\]*[$€£+]?\Z")
#: single letters, digits and signs from the start of a token on, also beyond spaces
_SPACED = re.compile(r"(?<!\S)(?=\S)(?:[^\W_](?![^\W_])|[^\w\s]|[_ ])++")
_UNIT = re.compile(rf"[^\W_]|[{re.escape(_SIGNS)}]")
#: what stands around a token: no letter, digit or sign, or a sign that ends a sentence
_BEFORE, _AFTER = re.compile(rf"(?:(?![{re.escape(_SIGNS)}])[\W_])*"), re.compile(rf"(?:(?![{re.escape(_SIGNS.replace('!', ''))}])[\W_])*")
#: places of a token with more than one reading
_CHOICE = re.compile(rf"([{re.escape(''.join(LEET) + ''.join(sorted(SEPARATORS)))}])\1*|(.)\2+", re.S)


# ---------------------------------------------------------------- language model


@worker
def _trigrams(batches):
    total = np.zeros(_SIZE ** 3, dtype=np.int64)
    for b in batches:
        texts = b.column(0).to_pylist()
        for i, j in text_slices(texts):
            code = np.frombuffer("\n\n".join(["", *(t or "" for t in texts[i:j]), ""]).lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
            x = _TABLE[np.where(code < len(_TABLE), code, 0)]
            total += np.bincount((x[:-2] * _SIZE + x[1:-1]) * _SIZE + x[2:], minlength=_SIZE ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities [a, b, c] of letter c after a and b, counted over all
    texts; 0 stands for anything that is no letter. At most 64 ** 3 counts,
    whatever the data, come to the driver."""
    rows = (docs.select(F.col(text_col).cast("string")).mapInArrow(_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros(_SIZE ** 3)
    n[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=float)
    three = n.reshape(_SIZE, _SIZE, _SIZE)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + _SIZE)
    p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
    p3 = (three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def _options(c: str, n: int) -> list[tuple[str, float]]:
    """What ``c``, written ``n`` times, may stand for."""
    if c in SEPARATORS:
        return [("", DROP), (" ", STAY)]
    if c in LEET:
        return [(x * k, SWAP + (k < n) * ONE) for x in LEET[c] for k in range(1, min(n, 2) + 1)] + [(c * n, KEEP)]
    return [(c, ONE), (c * 2, TWO)] if n >= 3 else [(c * 2, 0.0), (c, SINGLE)]


def decode(token: str, model: np.ndarray) -> str:
    """The cheapest reading of a disguised token: Viterbi over its lattice, with
    the last two letters as state. Between two choices a single state is left
    after two letters, and what follows costs every reading the same."""
    price_of = memoryview(np.ascontiguousarray(model).reshape(-1))
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}

    def step(options):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in states.items():
            for text, price in options:
                x, y, total = a, b, cost + price
                for c in text:
                    z = _ID.get(c, 0)
                    total -= price_of[(x * _SIZE + y) * _SIZE + z]
                    x, y = y, z
                old = after.get((x, y))
                if old is None or total < old[0]:
                    after[x, y] = total, (path, text)
        return after

    at = 0
    for m in chain(_CHOICE.finditer(token), [None]):
        plain = token[at:m.start()] if m else token[at:] + " "
        i = 0
        while i < len(plain) and len(states) > 1:
            states, i = step([(plain[i], 0.0)]), i + 1
        if i < len(plain):
            ((_, b), (_, path)), rest = next(iter(states.items())), plain[i:]
            states = {(_ID.get(rest[-2], 0) if len(rest) > 1 else b, _ID.get(rest[-1], 0)): (0.0, (path, rest))}
        if m:
            at = m.end()
            states = step(_options(token[m.start()], at - m.start()))
    path, parts = min(states.values(), key=lambda s: s[0])[1], []
    while path:
        path, text = path
        parts.append(text)
    return "".join(reversed(parts)).strip()


def _core(token: str) -> str:
    """A token without what stands around it."""
    token = token[_BEFORE.match(token).end():]
    return token[:len(token) - _AFTER.match(token[::-1]).end()]


def tokens(text: str) -> set[str]:
    """Distinct tokens of a text, lower-cased; runs of three or more single
    letters, digits and signs are one, without what stands around them."""
    text = text.lower()
    found = set(text.split())
    for m in _SPACED.finditer(text):
        run = m[0]
        if m.end() < len(text) and not text[m.end()].isspace():
            run = run[:max(run.rfind(" "), 0)]  # the last token goes on
        if " " in run and " " in (run := _core(run)) and len(_UNIT.findall(run)) >= 3:
            found.add(run)
    return found


def restored_words(token: str, model: np.ndarray) -> list[str]:
    """The words that a token restores to, and those it shows as it is. Only
    tokens with a single reading, and numbers, are not decoded."""
    plain = _WORD.findall(token)
    core = _core(token)
    if _PLAIN.match(core) or " " not in core and _NUMBER.match(core):
        return plain
    # a bracket or mark before a token is a letter or is none
    inner = core.lstrip("(<¡!|+")
    read = [decode(x, model) for x in ((core, inner) if inner != core else (core,))]
    return list(dict.fromkeys([*(w for r in read for w in _WORD.findall(r)), *plain]))


class _Words(dict):
    """Token -> its words of three letters or more."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, token: str) -> list[str]:
        self[token] = found = [w for w in restored_words(token, self.model) if len(w) > 2]
        return found


# ---------------------------------------------------------------- weights


def _prefixes(word: str) -> list[str]:
    return [word[:n] for n in (6, 5, 4) if len(word) > n]


_MIX = np.random.default_rng(8).integers(1, 1 << 63, (2, HASHES, 1), dtype=np.uint64) | np.uint64(1)


def _sketch(words: list[str]) -> tuple[list[int], list[int]]:
    """Keys of the bands of the words' min-hashes, and a byte of each min-hash."""
    if not len(words):
        return [], []
    x = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    least = ((_MIX[0] * x + _MIX[1]) >> np.uint64(32)).min(axis=1)
    keys = [hash((i, *band)) for i, band in enumerate(least.reshape(-1, 4).tolist())]  # of integers: the same in every process
    return keys, (least & np.uint64(127)).tolist()


def teaching_rows(rows: DataFrame) -> DataFrame:
    """(label, words) of (id, label, words) without near copies: a row goes if it
    has the set of words of another row of its label, or if the first row of one of its
    bands has that label and agrees in ``ALIKE`` of ``HASHES`` min-hashes (about 0.8 of
    both sets' words). All other rows stay."""
    @F.pandas_udf("keys array<long>, bytes array<byte>")
    def sketch(words):
        return pd.DataFrame([_sketch(w) for w in words], columns=["keys", "bytes"])

    rows = spill(rows.groupBy(F.xxhash64("words").alias("fp"), "label").agg(F.min_by("words", "id").alias("words"), F.min("id").alias("id")), "teaching")
    each = (rows.select("label", F.struct("id", "fp").alias("row"), sketch("words").alias("s"))
            .select("label", "row", F.col("s.bytes").alias("bytes"), F.explode("s.keys").alias("key")))
    # bounded by the sample: at most HASHES / 8 a row
    first = (each.groupBy("key", "label").agg(F.min(F.struct("row", "bytes")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    same = F.size(F.filter(F.zip_with("bytes", "first.bytes", lambda a, b: a == b), lambda x: x))
    copies = (each.join(F.broadcast(first), ["key", "label"]).where(F.col("first.row") < F.col("row")).where(same >= ALIKE)
              .select("label", F.col("row.fp").alias("fp")).distinct())
    return rows.join(F.broadcast(copies), ["fp", "label"], "left_anti").select("label", "words")


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, folds: tuple[int, ...] = (0, 2), limit: int = TRAIN_DOCS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Weights of words and beginnings, from labelled rows whose
    ``crc32(id as text) mod 3`` is in ``folds``: the ``limit`` ids of the
    smallest hash. Rows without a label, id or text teach nothing; an id with several labels
    counts as toxic if one says so. Near copies of one text (``teaching_rows``) teach once.
    Without any labelled row every score is 0.5.
    """
    spark = docs.sparkSession
    taught = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .where(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)).isin(*folds))
              .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              )
    chosen = hash_sample(taught, F.xxhash64("id"), limit)  # bounded, so it may be broadcast
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("array<string>")
    def words(text):
        known = _Words(shared.value)
        return text.map(lambda t: sorted({w for x in tokens(t) for w in known[x]}))

    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
            .join(F.broadcast(chosen), "id").select("id", "label", words("text").alias("words")))
    once = teaching_rows(rows)
    toxic, clean = F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    n = once.agg(toxic, clean).first()
    if not n["toxic"] or not n["clean"]:
        return {"base": (40.0 if n["toxic"] else -40.0) if n["toxic"] or n["clean"] else 0.0, "weights": {}}
    each = spill(once.select("label", F.explode("words").alias("word")).groupBy("word").agg(toxic, clean).where("toxic > 0 or clean > 0"), "words")
    base = math.log(n["toxic"] / n["clean"])
    heads = (each.where(F.length("word") > 4)
             .select("toxic", "clean", F.explode(F.filter(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in (4, 5, 6)]), lambda x: x.isNotNull())).alias("x"))
             .groupBy("x").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.max("toxic").alias("top"), F.count_if(F.col("toxic") > 0).alias("words"))
             # a beginning counts if it is that of many words, not of one
             .where("words >= 3 and top * 2 <= toxic").select(F.concat(F.lit("^"), "x").alias("x"), "toxic", "clean"))
    both = each.select(F.concat(F.lit("="), "word").alias("x"), "toxic", "clean").unionByName(heads)
    m, p, z = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean")), 1.64
    low = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    kept = (both.where("toxic >= 5").select("x", low.alias("low")).where("low >= 0.5").collect())
    return {"base": base, "weights": {r["x"]: min(math.log(r["low"] / (1 - r["low"])) - base, 9.0) for r in kept}}


def word_weight(word: str, weights: dict[str, float]) -> float:
    """The largest weight of a word and its beginnings; 0 if it has none."""
    return max((weights.get(x, 0.0) for x in ("=" + word, *("^" + p for p in _prefixes(word)))), default=0.0)


_RUN = re.compile(r"(.)\1+", re.S)


class _Hits(dict):
    """Token -> ((word, weight), ...) for its words that have a weight."""

    def __init__(self, model, weights):
        self.model, self.weights = model, weights
        #: how weighted words begin; all of them have three letters at least
        self.starts = {x[1:4] for x in weights}

    def _without(self, token: str) -> bool:
        """Whether it is plain that no word of a token has a weight: it is a word, perhaps
        with a point or comma after it, and none of its readings begins like one that has. Letters
        may be read as one or two, so readings of a word begin with its first three different
        letters, or with two of them of which one is double."""
        word = token.rstrip(".,")
        if not word.isalpha():
            return False
        if word[:3] in self.starts:
            return False
        if not _RUN.search(word):
            return True
        a, b, c = (_RUN.sub(r"\1", word[:64]) + "   ")[:3]
        return len(word) < 64 and not {a + b + c, a + a + b, a + b + b, a + a + a, a + a, a + b}.intersection(self.starts)

    def __missing__(self, token: str) -> tuple:
        if len(self) > KEPT:
            self.clear()
        if self._without(token):
            self[token] = ()
            return ()
        found = ((w, word_weight(w, self.weights)) for w in restored_words(token, self.model) if len(w) > 2)
        self[token] = hits = tuple(x for x in found if x[1] > 0)
        return hits


def text_score(text: str | None, hits: _Hits, base: float) -> float:
    total = base
    if text:
        total += sum(w for _, w in set(chain.from_iterable(map(hits.__getitem__, tokens(text)))))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, total))))


def with_score(docs: DataFrame, model: np.ndarray, fitted: dict, name: str = "score", text_col: str = "text") -> DataFrame:
    """Adds the score of every row's whole text; null and empty texts have the
    share of toxic documents. A column of that name is replaced, others are
    kept; repeated rows are scored each."""
    shared = docs.sparkSession.sparkContext.broadcast((model, fitted["weights"]))
    base, own = fitted["base"], uuid.uuid4().hex

    @worker
    def scores(series):
        hits = per_process(("toxicity", own), lambda: _Hits(*shared.value))
        for text in series:
            yield pd.Series([text_score(t, hits, base) for t in text], dtype="float64")

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return scores(series)
    return docs.withColumn(name, score(F.col(text_col).cast("string")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. A null id is held out
    of nothing."""
    model = character_model(docs)
    fitted = fit(docs, labels, model)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    return (with_score(docs.select("doc_id", "text"), model, fitted)
            .select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose texts score below the threshold, with their own columns, of any name."""
    known = only(docs, doc_id="doc_id", text="text")
    model = character_model(known)
    fitted = fit(known, labels, model)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the names are
    scored = with_score(plain, model, fitted, "score", f"c{docs.columns.index('text')}")
    return scored.where(F.col("score") < threshold).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_toxicity(spark, sf_dir):
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
