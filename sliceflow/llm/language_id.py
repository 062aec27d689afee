"""Operator 11: language of whole texts, by words first and n-grams of letters after.

A word (a run of letters, lower-cased) that some language is known to have scores
``-log10`` of its relative frequency in each language. An unseen word falls back to its
n-grams with a blank at both ends, the longest first: the first length of which
some n-gram is known gives the mean over the known ones. Where a language lacks what
another one has, it pays ``PENALTY``. A text scores the mean over its words; the language
of the smallest mean is predicted.

Frequencies are counted by Spark over a sample of labelled rows, at most ``TRAIN_DOCS``
of each language; all of their words count, none is cut off. Label, source and id are not
inputs of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sliceflow.llm.common import mix64, only, spill, text_slices, word_hashes, worker

#: labelled rows of each language that frequencies are counted over, at most
TRAIN_DOCS = 2_000
#: longest n-gram
LONGEST = 5
#: what a language pays for a word or n-gram that it lacks: a frequency of 10^-7
PENALTY = 7.0
#: floats of word scores that a worker keeps; changes speed only
KEPT = 4_000_000

_WORD = re.compile(r"[^\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def hashes_of(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; words hold no blanks."""
    return word_hashes(" ".join(words).encode("utf-8", "surrogatepass"))[0]


def grams_of(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the words with a blank at both ends, and which word each is of."""
    code = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    length = np.array([len(w) + 2 for w in words], dtype=np.int64)
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(words)), length)
    if len(code) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(len(code) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = h * _STEP + code[i: len(code) - n + 1 + i]
    at = np.arange(len(h))
    inside = at + n <= (start + length)[owner[: len(h)]]
    return mix64(h[inside]), owner[: len(h)][inside]


@dataclass
class Languages:
    """Names, and for each length of n-grams (0: whole words) sorted hashes with the
    entries (language, cost) of each."""

    names: list[str]
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def costs(self, kind: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known or not, cost in each language) of hashes of one kind."""
        keys, first, lang, cost = self.tables[kind]
        out = np.full((len(hashes), len(self.names)), PENALTY, dtype=np.float32)
        if not len(keys):
            return np.zeros(len(hashes), dtype=bool), out
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[at] == hashes
        rows, n = np.flatnonzero(known), (first[1:] - first[:-1])[at[known]]
        to = np.repeat(rows, n)
        from_ = np.repeat(first[at[known]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[to, lang[from_]] = cost[from_]
        return known, out

    def score(self, words: list[str]) -> np.ndarray:
        """Cost of each word in each language; NaN where not even a letter is known."""
        out = np.full((len(words), len(self.names)), np.nan, dtype=np.float32)
        known, cost = self.costs(0, hashes_of(words))
        out[known] = cost[known]
        left = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            hashes, owner = grams_of([words[i] for i in left], n)
            known, cost = self.costs(n, hashes)
            times = np.bincount(owner[known], minlength=len(left))
            total = np.zeros((len(left), len(self.names)), dtype=np.float64)
            np.add.at(total, owner[known], cost[known])
            out[left[times > 0]] = total[times > 0] / times[times > 0, None]
            left = left[times == 0]
        return out


@worker
def _frequencies(batches):
    """(lang, kind, hash, n) of the words and n-grams of a task's texts."""
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for i, j in text_slices(texts):
            for lang in dict.fromkeys(langs[i:j]):
                words = [w for x, t in zip(langs[i:j], texts[i:j]) if x == lang for w in words_of(t)]
                if not words:
                    continue
                for kind in range(LONGEST + 1):
                    keys, n = np.unique(hashes_of(words) if kind == 0 else grams_of(words, kind)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "kind", "hash", "n"])


def learn(docs: DataFrame, limit: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Frequencies of at most ``limit`` rows of each language, those of the smallest
    hash of id and text. Rows without text or language teach nothing. What reaches the
    driver is bounded by the words of these rows."""
    rows = (only(docs, id=id_col, text=text_col, lang=lang_col).where("text is not null and lang is not null")
            .select(F.xxhash64("id", "text").alias("h"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    # a row for each language, of which the model holds frequencies
    share = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("all")))
    # a hash of twice the wanted share of rows first, so that texts of the sample alone are sent
    near = rows.join(share, "lang").where(F.pmod("h", F.greatest(F.lit(1), F.floor(F.col("all") / (2 * limit)))) == 0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = near.select("lang", "h", "text").withColumn("place", place).where(F.col("place") <= limit).select("lang", "text")
    counted = spill(sample.repartition("lang", F.xxhash64("text")).mapInArrow(_frequencies, "lang string, kind int, hash long, n long")
                    .groupBy("lang", "kind", "hash").agg(F.sum("n").alias("n")), "frequencies")
    names = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    packed = counted.mapInArrow(_pack(names), "kind binary, lang binary, hash binary, n binary").collect()
    kinds, langs, hashes, n = (np.frombuffer(b"".join([r[i] for r in packed]), dtype=t) for i, t in enumerate((np.int8, np.int32, np.uint64, np.int64)))
    tables = []
    for kind in range(LONGEST + 1):
        at = kinds == kind
        lang, key, times = langs[at], hashes[at], n[at].astype(np.float64)
        all_of = np.bincount(lang, weights=times, minlength=len(names))
        order = np.lexsort((lang, key))
        keys, first = np.unique(key[order], return_index=True)
        cost = np.minimum(-np.log10(times / all_of[lang]), PENALTY).astype(np.float32)
        tables.append((keys, np.append(first, len(key)).astype(np.int64), lang[order], cost[order]))
    return Languages(names, tables)


def _pack(names: list[str]):
    """Rows of a batch as arrays of bytes, which are small to collect."""
    number = {x: i for i, x in enumerate(names)}

    def run(batches):
        for b in batches:
            lang, kind, key, n = b.columns
            values = (kind.to_numpy().astype(np.int8), np.array([number[x] for x in lang.to_pylist()], dtype=np.int32), key.to_numpy(), n.to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in values], names=["kind", "lang", "hash", "n"])
    return worker(run)


def _predict(model: Languages, texts: list[str | None], rows: dict[str, int], held: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text. ``rows`` and ``held`` keep scores of words."""
    found = [words_of(t) if t else [] for t in texts]
    if held and len(held[0]) * max(1, len(model.names)) > KEPT:
        rows.clear()
        held.clear()
    new = [w for w in dict.fromkeys(w for x in found for w in x) if w not in rows]
    if new or not held:
        scores = model.score(new) if new else np.empty((0, len(model.names)), np.float32)
        at = len(held[0]) if held else 0
        rows.update(zip(new, range(at, at + len(new))))
        held[:] = [np.concatenate([held[0], scores]) if held else scores]
    names, best = [], np.zeros(len(texts))
    for k, (text, words) in enumerate(zip(texts, found)):
        if not words or not model.names:
            names.append("und")
            continue
        cost = held[0][np.fromiter(map(rows.__getitem__, words), np.int64, len(words))]
        cost = cost[~np.isnan(cost[:, 0])]
        mean = cost.mean(axis=0, dtype=np.float64) if len(cost) else np.zeros(len(model.names))
        share = 10.0 ** (mean.min() - mean)
        names.append(model.names[int(mean.argmin())])
        best[k] = share.max() / share.sum()
    return names, best


def with_language(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to rows whose texts stand in a column of that name:
    the score is the share that the predicted language has in the likelihoods of a
    word on average. Null texts and texts without a letter are ``und`` with score 0; a text
    none of whose letters is known gets the first language, as do ties. Every other
    column is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows, held = {}, []
        for texts in batches:
            texts = texts.tolist()
            parts = [_predict(shared.value, texts[i:j], rows, held) for i, j in text_slices(texts)]
            yield pd.DataFrame({"lang_pred": pd.Series([x for p in parts for x in p[0]], dtype="object"), "score": np.concatenate([p[1] for p in parts]) if parts else []})

    return docs.withColumn("predicted", predict(F.col(text_col).cast("string"))).select(*docs.columns, "predicted.lang_pred", "predicted.score")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; languages are learned from rows
    that are not held out. A null id is neither held out nor learned from; repeated rows
    are predicted each, an empty table gives no rows, other columns are ignored."""
    rows = only(docs, doc_id="doc_id", text="text", lang="lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = learn(rows.where(fold != 2))
    return with_language(rows.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "text"), model).drop("text")


def op11_language_id(spark, sf_dir):
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
