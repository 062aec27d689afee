"""Operator 13: how much the sources of a language differ in their words.

A group is a (lang, source); each language keeps the terms that stand in enough of its
documents. The divergence of two groups is a sum over all kept terms, also those that
neither holds, so it is no join on terms. The space (group, group, term) of a language is
cut into cells, each of two blocks of groups and one block of terms. A task that owns a
cell gets the slice of counts of each of its two blocks (a slice is replicated to all cells
that need it), adds up every pair of groups over its terms, and the partial sums are
reduced along the term axis. A cell holds at most a block of terms for two blocks
of groups, so its memory is bounded, however frequent a term or large a source is.

Arithmetic is in integers: exact while a term occurs below 9e12 times and a language
has below 9e15 terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sliceflow.llm.common import only, spill, worker

#: groups and terms on a side of a cell, on average
GROUP_BLOCK, TERM_BLOCK = 32, 4096
#: documents of a language that a kept term stands in, at least
MIN_DOCS = 10
#: ranks of terms that are listed for a group
TOP_TERMS = 10
#: terms that a task counts before it hands counts over; changes speed only
HELD = 500_000

#: bytes of terms, A-Z lower-cased; all others are blanks
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


@worker
def _count(batches):
    """Terms of a task: one row per group and term, handed over when ``HELD`` are held."""
    def rows(held):
        for (lang, source), (n, docs) in held.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang]).take(pa.array(np.zeros(k, np.int32))), pa.array([source]).take(pa.array(np.zeros(k, np.int32))),
                pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array(list(map(docs.__getitem__, n)), pa.int64())], schema=_COUNTS)

    held, size = defaultdict(lambda: (Counter(), Counter())), 0
    for b in batches:
        lang, source, text = b.columns
        for i in range(b.num_rows):
            terms = text[i].as_py().translate(_TERM_BYTES).split(b" ")
            if not any(terms):
                continue
            n, docs = held[lang[i].as_py(), source[i].as_py()]
            before = len(n)
            n.update(terms)
            n.pop(b"", None)
            docs.update(set(terms))
            size += len(n) - before
            if size > HELD:
                yield from rows(held)
                held.clear()
                size = 0
    yield from rows(held)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n occurrences, docs that hold it) of all whole texts. Tasks
    add up first, and Spark once more before the shuffle of the sums."""
    rows = (only(docs, lang=lang_col, source=source_col, text=text_col)
            .select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    sums = rows.mapInArrow(_count, "lang string, source string, term binary, n long, docs long").groupBy("lang", "source", "term")
    return sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn("term", F.col("term").cast("string"))


def _probability(n: str, d: str) -> Column:
    """1 + floor(10^9 (n + 2) / d) of two long columns, by long division: a third
    of the digits comes from the remainder, so nothing overflows."""
    return F.expr(f"1L + (({n} + 2L) * 1000000L div {d}) * 1000L + (({n} + 2L) * 1000000L % {d}) * 1000L div {d}")


def _probabilities(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    millions = (n + 2) * 1_000_000
    return 1 + millions // d * 1000 + millions % d * 1000 // d


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of a cell. Rows with ``d`` name a group of one of the two
    blocks, rows without are counts."""
    names = table.filter(pc.is_valid(table["d"]))
    counts = table.filter(pc.is_null(table["d"]))
    groups = names["source"].to_pylist()
    order = sorted(range(len(groups)), key=groups.__getitem__)
    row = {groups[i]: k for k, i in enumerate(order)}
    block, d = names["block"].to_numpy()[order], names["d"].to_numpy()[order]
    terms = counts["term"].combine_chunks().dictionary_encode()
    n = np.zeros((len(row), len(terms.dictionary) + 1), dtype=np.int64)  # the last column: a term that no group here holds
    sources = counts["source"].combine_chunks().dictionary_encode()
    at = np.array([row[x] for x in sources.dictionary.to_pylist()], dtype=np.int64)
    if len(terms):
        n[at[sources.indices.to_numpy()], terms.indices.to_numpy()] = counts["n"].to_numpy()
    p = _probabilities(n, np.maximum(d, 1)[:, None])
    times = np.ones(n.shape[1], dtype=np.int64)
    times[-1] = names["terms"][0].as_py() - len(terms.dictionary)
    a, b = table["a"][0].as_py(), table["b"][0].as_py()
    one, other, value = [], [], []
    for i in range(len(row)):
        with_ = np.flatnonzero(block == b)
        with_ = with_[with_ > i] if a == b else with_
        if block[i] == a and len(with_):
            one += [i] * len(with_)
            other += with_.tolist()
            value.append((_distance(p[i], p[with_]) * times).sum(axis=1))
    named = pa.array([groups[i] for i in order], pa.string())
    return pa.table({"lang": table["lang"].slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(one), np.int32))),
                     "one": named.take(pa.array(one, pa.int32())), "other": named.take(pa.array(other, pa.int32())),
                     "value": pa.array(np.concatenate(value) if value else [], pa.int64())})


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK,
                lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of every group from each
    other of its language (part ``pair``), and the ``top`` terms that set a group apart
    from its language (part ``term``).

    Null text, lang and source are ''. A group without terms is a group. A language
    that keeps no term has pairs of value 0, one with a single group has no pairs. Rows
    that repeat count each, ties go by name, an empty table gives no rows, other columns
    are ignored.
    """
    each = spill(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    kept = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= min_docs).drop("docs")
    rows = spill(each.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
    words = rows.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    vocabulary = rows.select("lang", "term", "total").distinct()
    lang = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_words"))
    occurring = only(docs, lang=lang_col, source=source_col).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("long")
    groups = (occurring.join(words, ["lang", "source"], "left").join(lang, "lang", "left")
              .select("lang", "source", F.coalesce("v", zero).alias("v"), (F.coalesce("words", zero) + 2 * F.coalesce("v", zero)).alias("d"),
                      (F.coalesce("lang_words", zero) + 2 * F.coalesce("v", zero)).alias("lang_d")))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / group_block).cast("int").alias("blocks"),
                                       F.greatest(F.lit(1), F.ceil(F.max("v") / term_block)).cast("int").alias("term_blocks"))
    groups = spill(groups.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")), "groups")

    # slices, one copy for each cell that needs it
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to")
    cell = ["lang", F.least("block", "to").alias("a"), F.greatest("block", "to").alias("b"), "t", "block", "source"]
    term_slot = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t")
    counts = (rows.join(groups.select("lang", "source", "block", "blocks", "term_blocks"), ["lang", "source"])
              .select("lang", "block", "source", "term", "n", term_slot, other)
              .select(*cell, F.lit(None).cast("long").alias("d"), F.lit(None).cast("long").alias("terms"), "term", "n"))
    in_block = (vocabulary.join(sizes, "lang").select("lang", term_slot).groupBy("lang", "t").agg(F.count("*").alias("terms")))
    slots = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("t")).join(in_block, ["lang", "t"], "left")
    names = (groups.join(slots, "lang").select("lang", "block", "source", "d", "t", F.coalesce("terms", zero).alias("terms"), other)
             .select(*cell, "d", "terms", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n")))
    partial = (names.unionByName(counts).groupBy("lang", "a", "b", "t")
               .applyInArrow(_cell, "lang string, one string, other string, value long"))
    pairs = spill(partial.groupBy("lang", "one", "other").agg(F.sum("value").alias("value")), "divergences")
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                                                  F.struct(F.col("other").alias("source"), F.col("one").alias("item")))).alias("x"), "value").select("lang", "x.*", "value")

    apart = (rows.join(groups.select("lang", "source", "d", "lang_d"), ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"), _probability("n", "d").alias("p"), _probability("total", "lang_d").alias("q"))
             .where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (both.withColumn("part", F.lit("pair")).withColumn("rank", rank).select(*columns)
            .unionByName(apart.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= top).select(*columns)))


def op13_source_divergence(spark, sf_dir):
    return divergences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: the same from dense sums over all kept terms
ORACLE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM documents),
c AS (SELECT lang, source, term, sum(k)::BIGINT AS n, count(*) AS docs
      FROM (SELECT lang, source, r, term, count(*) AS k
            FROM (SELECT lang, source, r, unnest(terms) AS term FROM (SELECT *, row_number() OVER () AS r FROM d)) GROUP BY ALL) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS total FROM c GROUP BY ALL HAVING sum(docs) >= 10),
l AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS words FROM kept GROUP BY lang),
g AS (SELECT o.lang, o.source, coalesce(l.v, 0) AS v, coalesce(l.words, 0) AS lang_words, coalesce(w.words, 0) AS words
      FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN l USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS words FROM c JOIN kept USING (lang, term) GROUP BY ALL) w USING (lang, source)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.words + 2 * g.v) AS p, 1 + (1000000000::HUGEINT * (kept.total + 2)) // (g.lang_words + 2 * g.v) AS q
      FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source AS one, y.source AS two, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
                     FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.one = a.source AND s.two = b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
           UNION ALL
           SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
