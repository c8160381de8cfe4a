"""Divergence of sources within a language, from counts in which every distinct text is cut into terms once.

1. Equal texts of a language collapse: a task hands on a text once with how often each source has it, then copies from all
   tasks meet in digest order, so a text is tokenised once whatever number of rows holds it.
2. Term counts and document frequencies are added with these multiplicities, in the task first, then by Spark per (lang, source, term).
3. Terms in fewer than ``LEAST_DOCS`` documents of the language go.
4. Pairs of sources are evaluated sparsely. With z the share of an absent term, A and B the terms that occur in the two sources,
   ``sum f = sum over A of f(p, z_b) + sum over B of f(z_a, q) + (V - |A| - |B|) f(z_a, z_b) + sum over A and B of
   (f(p, q) - f(p, z_b) - f(z_a, q) + f(z_a, z_b))``: the first two come from a histogram of each source's counts, only
   the last looks at terms, and only at those that both sources have. Its sums stay in the task, no pair is emitted per term.

All arithmetic is on whole numbers (128-bit decimals where 64 bits could overflow).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.text import FOLD, hashes, row_of, runs, slices
from postings.operators.sizing import measured_small
from postings.sources.warehouse import stored

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Bytes of text that a task looks at for copies before it hands them on.
WINDOW_BYTES = 32 << 20
#: Counts held in a task before they are handed on.
FLUSH = 2_000_000
PAIRS = 1 << 21

LETTER = np.ones(256, bool)
LETTER[:0x80] = False
LETTER[ord("A"):ord("Z") + 1] = True
LETTER[ord("a"):ord("z") + 1] = True


# --- equal texts collapse ------------------------------------------------------------------

def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, digest, source, n, text): the text only beside the first row of its digest in a window of rows."""
    names = ["lang", "digest", "source", "n", "text"]
    counts: dict = {}
    texts: dict = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        sent, rows = set(), []
        for (lang, digest, source), n in counts.items():
            rows.append((lang, digest, source, n, None if (lang, digest) in sent else texts[lang, digest]))
            sent.add((lang, digest))
        for k in range(0, len(rows), 2000):
            columns = zip(*rows[k:k + 2000])
            types = (pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for b in batches:
        for lang, source, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            data = text.encode()
            digest = xxhash.xxh3_128_digest(data)
            key = (lang, digest, source)
            counts[key] = counts.get(key, 0) + 1
            if (lang, digest) not in texts:
                texts[lang, digest] = text
                held += len(data)
        if held > WINDOW_BYTES:
            yield from out()
            counts, texts, held = {}, {}, 0
    if counts:
        yield from out()


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, list[tuple[str, int]]]]:
    """(lang, text, [(source, copies)]) of each distinct text, from rows in the order of language and digest, texts before NULLs."""
    now, text, copies = None, None, {}
    for b in batches:
        for lang, digest, source, n, body in zip(*(b.column(k).to_pylist() for k in range(5))):
            if (lang, digest) != now:
                if now is not None:
                    yield now[0], text, list(copies.items())
                now, text, copies = (lang, digest), body, {}
            copies[source] = copies.get(source, 0) + n
    if now is not None:
        yield now[0], text, list(copies.items())


# --- terms -------------------------------------------------------------------------------------

class _Counts:
    """Occurrences and documents per (group, term) of one task; terms are told apart by their hash until they are handed on."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.names: dict[int, bytes] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, lang: list[str], texts: list[str], copies: list[list[tuple[str, int]]]) -> None:
        for first, data, offsets in slices(pa.array(texts, pa.large_string())):
            data = FOLD[data]
            starts, ends = runs(LETTER[data].astype(np.int8), offsets)
            if not len(starts):
                continue
            term, row = hashes(data, starts, ends), row_of(starts, offsets)
            _, at = np.unique(term, return_index=True)
            for h, a, z in zip(term[at].tolist(), starts[at].tolist(), ends[at].tolist()):
                if h not in self.names:
                    self.names[h] = data[a:z].tobytes()
            order = np.lexsort((term, row))
            term, row = term[order], row[order]
            new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (row[1:] != row[:-1])])
            times = np.diff(np.append(new, len(term)))
            term, row = term[new], row[new]
            # Each text's terms once per source that has it.
            n_sources = np.array([len(copies[first + k]) for k in range(len(offsets) - 1)])
            group = np.array([self.groups.setdefault((lang[first + k], s), len(self.groups)) for k in range(len(offsets) - 1) for s, _ in copies[first + k]])
            weight = np.array([n for k in range(len(offsets) - 1) for _, n in copies[first + k]])
            begin = np.cumsum(n_sources) - n_sources
            repeat = n_sources[row]
            which = np.repeat(begin[row] - (np.cumsum(repeat) - repeat), repeat) + np.arange(repeat.sum())
            term, times = np.repeat(term, repeat), np.repeat(times, repeat)
            self._put(group[which], term, times * weight[which], weight[which])

    def _put(self, *columns: np.ndarray) -> None:
        group, term, count, docs = columns
        order = np.lexsort((term, group))
        group, term = group[order], term[order]
        new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (group[1:] != group[:-1])])
        self.parts.append((group[new], term[new], np.add.reduceat(count[order], new), np.add.reduceat(docs[order], new)))
        self.size += len(new)
        if self.size > FLUSH and len(self.parts) > 1:
            columns = [np.concatenate(c) for c in zip(*self.parts)]
            self.parts, self.size = [], 0
            self._put(*columns)

    def full(self) -> bool:
        return self.size > FLUSH // 2

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.size = [], 0
        self._put(*columns)
        group, term, count, docs = self.parts[0]
        label = list(self.groups)
        langs, sources = pa.array([g[0] for g in label]), pa.array([g[1] for g in label])
        for k in range(0, len(term), 50_000):
            part = slice(k, k + 50_000)
            g = pa.array(group[part])
            words = pa.array([self.names[h] for h in term[part].tolist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([langs.take(g), sources.take(g), words, pa.array(count[part]), pa.array(docs[part])], ["lang", "source", "term", "count", "docs"])
        self.__init__()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held, size = _Counts(), [], 0
    for row in _collapsed(batches):
        held.append(row)
        size += len(row[1])
        if size > 1 << 20:
            counts.add(*map(list, zip(*held)))
            held, size = [], 0
            if counts.full():
                yield from counts.out()
    if held:
        counts.add(*map(list, zip(*held)))
    yield from counts.out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term in a source of a language, and documents that hold it.

    Terms are runs of ASCII letters and of characters beyond ASCII, with only A-Z lower-cased. NULL lang, source and text are empty text.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = rows.mapInArrow(_folded, "lang string, digest binary, source string, n long, text string")
    met = parts.repartition("lang", "digest").sortWithinPartitions("lang", "digest", F.col("text").isNull())
    found = met.mapInArrow(_counted, "lang string, source string, term string, count long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


# --- shares and their distance -----------------------------------------------------------------

def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exactly; NULL without terms."""
    part = F.expr("CAST(1000000000 AS DECIMAL(38, 0))") * (count + 2).cast("decimal(20,0)")
    whole = (total + 2 * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", part.cast("decimal(38,0)"), F.nullif(whole, F.lit(0).cast("decimal(20,0)")).cast("decimal(38,0)"))


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value): over the terms that two sources share, what their sparse parts lack; from rows in the order of lang and term."""
    names: dict[tuple[str, str], int] = {}
    sums: dict[tuple[int, int], int] = {}
    keys, values, size = [], [], 0

    def settle() -> None:
        nonlocal keys, values, size
        if keys:
            pair, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(pair), np.int64)
            np.add.at(total, inverse, np.concatenate(values))
            for k, v in zip(pair.tolist(), total.tolist()):
                sums[k] = sums.get(k, 0) + v
        keys, values, size = [], [], 0

    def out() -> pa.RecordBatch:
        settle()
        label = list(names)
        rows = [(label[k >> 32], label[k & 0xFFFFFFFF], v) for k, v in sums.items()]
        sums.clear()
        return pa.RecordBatch.from_arrays([
            pa.array([a[0] for a, _, _ in rows], pa.string()), pa.array([a[1] for a, _, _ in rows], pa.string()),
            pa.array([b[1] for _, b, _ in rows], pa.string()), pa.array([v for *_, v in rows], pa.int64())], ["lang", "a", "b", "value"])

    def evaluate(part: pa.RecordBatch) -> None:
        nonlocal size
        lang, source, term = (part.column(k) for k in range(3))
        p, z = np.asarray(part.column(3)), np.asarray(part.column(4))
        s = np.array([names.setdefault(g, len(names)) for g in zip(lang.to_pylist(), source.to_pylist())], np.int64)
        group = _groups(lang, term)
        i = np.arange(len(p))
        for d in range(1, len(p)):
            i = i[i + d < len(p)]
            i = i[group[i] == group[i + d]]
            if not len(i):
                break
            a, b = i, i + d
            value = _f(p[a], p[b]) - _f(p[a], z[b]) - _f(z[a], p[b]) + _f(z[a], z[b])
            low, high = np.minimum(s[a], s[b]), np.maximum(s[a], s[b])
            keys.append(low << 32 | high)
            values.append(value)
            size += len(value)
            if size > PAIRS:
                settle()

    left: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        # The last term of a batch may go on in the next one.
        b = pa.Table.from_batches([*left, b]).combine_chunks().to_batches()[0] if left else b
        last = int(np.searchsorted(_groups(b.column(0), b.column(2)), _groups(b.column(0), b.column(2))[-1], "left"))
        if last:
            evaluate(b.slice(0, last))
        left = [b.slice(last)]
        if len(sums) > FLUSH:
            yield out()
    if left:
        evaluate(left[0])
    yield out()


def _groups(lang: pa.Array, term: pa.Array) -> np.ndarray:
    """A number for each run of equal (lang, term)."""
    n = len(term)
    if n < 2:
        return np.zeros(n, np.int64)
    new = pc.or_(pc.not_equal(term.slice(1), term.slice(0, n - 1)), pc.not_equal(lang.slice(1), lang.slice(0, n - 1)))
    return np.concatenate(([0], np.cumsum(new.to_numpy(zero_copy_only=False).astype(np.int64))))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of a language.

    Part ``pair`` ranks the other sources of the language by their distance, part ``term`` the ``top`` terms that the
    source has more often than its language. NULL lang, source and text are empty text and form groups of their own;
    a source without a kept term has equal shares for all terms; without kept terms distances are 0. Empty input
    gives no rows. Other columns, whatever their names, are not read.
    """
    counts = stored(term_counts(docs))
    total = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("in_lang")).where(F.col("docs") >= least_docs)
    kept = stored(counts.select("lang", "source", "term", "count").join(total.select("lang", "term", "in_lang"), ["lang", "term"]))
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("n_terms"))
    langs = total.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count("*").alias("v"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "n_terms", "lang_total", "v"])
    # At most one row per source of a language.
    groups = stored(groups.withColumn("zero", _share(F.lit(0), F.col("total"), F.col("v"))))
    small = measured_small(groups)

    shared = kept.join(small, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("count"), F.col("total"), F.col("v")).alias("p"), "zero",
        _share(F.col("in_lang"), F.col("lang_total"), F.col("v")).alias("q"))
    by_term = shared.select("lang", "source", "term", "p", "zero").repartition("lang", "term").sortWithinPartitions("lang", "term")
    both = by_term.mapInArrow(_overlaps, "lang string, a string, b string, value long")
    other = small.select("lang", F.col("source").alias("b"), F.col("zero").alias("other_zero"))
    steps = kept.groupBy("lang", "source", "count").agg(F.count("*").alias("n")).join(small, ["lang", "source"])
    steps = steps.select("lang", F.col("source").alias("a"), "n", _share(F.col("count"), F.col("total"), F.col("v")).alias("p"))
    alone = steps.join(other, "lang").where("a <> b").select("lang", "a", "b", (F.col("n") * _distance(F.col("p"), F.col("other_zero"))).alias("value"))
    absent = groups.select("lang", F.col("source").alias("a"), F.col("n_terms").alias("n_a"), "v", "zero").join(
        small.select("lang", F.col("source").alias("b"), F.col("n_terms").alias("n_b"), F.col("zero").alias("other_zero")), "lang").where("a <> b")
    rest = F.col("v") - F.col("n_a") - F.col("n_b")
    absent = absent.select("lang", "a", "b", F.when(F.col("v") > 0, rest * _distance(F.col("zero"), F.col("other_zero"))).otherwise(0).alias("value"))
    # Every part counts for both directions; the absent one is there in both already.
    parts = both.union(alone)
    parts = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    parts = parts.union(parts.select("lang", F.col("b"), F.col("a"), "value")).union(absent)
    pairs = parts.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    terms = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top)
    return pairs.union(terms)


#: Dense: every source of a language against every kept term.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(words) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), groups AS (
  SELECT DISTINCT lang, source FROM d
), cells AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) c USING (lang, source, term)
), shares AS (
  SELECT *, 1 + (1000000000 * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g)::HUGEINT AS p,
         1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) OVER g + 2 * count(*) OVER g)::HUGEINT AS q
  FROM cells WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
