"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature is ``CHUNKS * WIDTH`` minima of its shingle set under as many hash functions, each cut to 16 bits. Two sets of
Jaccard similarity J differ at each place with probability 1 - J, so the distance of two signatures, the number of places
where they differ, tells J. By the pigeonhole principle signatures at most ``CHUNKS * (ERRORS + 1) - 1`` apart have a chunk with at
most ``ERRORS`` differences. All ways to leave ``ERRORS`` places of a chunk out are enumerated: each is a key, and two documents with
that distance share one, without exception. Sets at 0.85 differ in more than half of all places with a probability of about
10^-6, and share none of the keys with one of 2 * 10^-9, which is what a link can be missed by.

Documents with equal sets are one node. Links are found in two steps, so that no key's group is paired with itself:

1. Every node meets the leader that it shares most keys with; of a key's nodes that one leads which meets most others over all its keys.
2. Of each key whose nodes are then in several components, the nodes outside the largest one meet all others of the key.

Nodes meet in tiles of about ``TILE`` rows against a stream of others: first by the distance of signatures, then those that pass by the
exact overlap of their full sets, which alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.components import components
from postings.llm.jaccard_join import _arrays, _dealt, _grams, _tiles
from postings.llm.text import FOLD, mix, shingle_sets, slices
from postings.sources.warehouse import intermediates, stored

SIZE = 5
CHUNKS, WIDTH, ERRORS = 9, 4, 1
PLACES = CHUNKS * WIDTH
#: Signatures up to this distance are guaranteed to meet.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
_U = np.uint64
_FACTOR = np.random.default_rng(20260913).integers(1, 2**63, PLACES, dtype=np.uint64) * _U(2) + _U(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit minima for each set, none of them empty."""
    members = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), PLACES), np.uint16)
    for k, factor in enumerate(_FACTOR):
        h = members * factor
        h ^= h >> _U(32)
        h *= _U(0x9E3779B97F4A7C15)
        out[:, k] = mix(np.minimum.reduceat(h, starts)) >> _U(48)
    return out


def keys(signature: np.ndarray) -> np.ndarray:
    """Per signature a hash of every chunk with every choice of ``ERRORS`` places left out."""
    found = []
    for chunk in range(CHUNKS):
        for places in combinations(range(WIDTH), WIDTH - ERRORS):
            h = np.full(len(signature), len(found) + 1, np.uint64)
            for p in places:
                h = mix(h * _U(0xD1342543DE82EF95) + signature[:, chunk * WIDTH + p].astype(np.uint64))
            found.append(h)
    return np.stack(found, 1)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature) per document; the last two are NULL where the set is empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, signed = [], [], []
            for _, data, offsets in slices(b.column(1)):
                sets = shingle_sets(FOLD[data], offsets, size)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full)) if full else iter(())
                for s in sets:
                    sizes.append(len(s))
                    # The number by which the full sets are made again.
                    nodes.append(int((mix(s ^ _U(0x5851F42D4C957F2D)).sum() ^ _U(len(s))).astype(np.int64)) if len(s) else None)
                    signed.append(next(rows).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "node", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, node long, signature binary")


def _keyed(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = keys(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, PLACES))
                node = np.repeat(np.asarray(b.column(0)), found.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(node)], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def _near(tile: int, rows: pa.RecordBatch, others: pa.RecordBatch) -> pa.RecordBatch:
    """Which nodes of both roles are in a pair across components whose signatures are at most ``DISTANCE`` apart."""
    (x, cx, px), (y, cy, py) = _arrays(rows), _arrays(others)
    left, right = (np.frombuffer(b"".join(p), np.uint16).reshape(-1, PLACES) for p in (px, py))
    keep_x, keep_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    step = max(1, (1 << 18) // max(1, len(x)))
    for a in range(0, len(y), step):
        same = np.zeros((len(x), len(y[a:a + step])), np.int16)
        for k in range(PLACES):
            same += left[:, k][:, None] == right[a:a + step, k][None]
        good = (same >= PLACES - DISTANCE) & (cx[:, None] != cy[a:a + step][None])
        keep_x |= good.any(1)
        keep_y[a:a + step] |= good.any(0)
    nodes = np.concatenate((x[keep_x], y[keep_y]))
    roles = np.repeat([0, 1], [keep_x.sum(), keep_y.sum()])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), tile)), pa.array(roles, pa.int32()), pa.array(nodes)], ["tile", "role", "node"])


class _Linked:
    """Links across components by the overlap of full sets, at least 85 of 100 of the union.

    A tile's links only matter by what they join, so one is told only if it joins two parts that no earlier link of
    the tile does: fewer links than the tile has nodes, however alike they are.
    """

    def __init__(self) -> None:
        self.tile, self.head = None, {}

    def __call__(self, tile: int, rows: pa.RecordBatch, others: pa.RecordBatch) -> pa.RecordBatch:
        if tile != self.tile:
            self.tile, self.head = tile, {}
        (x, cx, px), (y, cy, py) = _arrays(rows), _arrays(others)
        sets = [np.frombuffer(v, np.uint64) for v in px]
        size = np.array([len(s) for s in sets])
        member, owner = np.concatenate(sets), np.repeat(np.arange(len(x)), size)
        order = np.argsort(member, kind="stable")
        member, owner = member[order], owner[order]
        out = []
        for j, v in enumerate(py):
            s = np.frombuffer(v, np.uint64)
            a = np.searchsorted(member, s, "left")
            length = np.searchsorted(member, s, "right") - a
            a, length = a[length > 0], length[length > 0]
            at = np.repeat(a - (np.cumsum(length) - length), length) + np.arange(length.sum())
            overlap = np.bincount(owner[at], minlength=len(x))
            good = np.flatnonzero((100 * overlap >= 85 * (size + len(s) - overlap)) & (cx != cy[j]))
            for i in good[np.unique(cx[good], return_index=True)[1]]:
                if self._joins(int(cx[i]), int(cy[j])):
                    out.append((int(x[i]), int(y[j])))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    def _joins(self, a: int, b: int) -> bool:
        a, b = self._root(a), self._root(b)
        self.head[a] = b
        return a != b

    def _root(self, a: int) -> int:
        while (up := self.head.get(a, a)) != a:
            self.head[a] = a = self.head.get(up, up)
        return a


def _links(rows: DataFrame, others: DataFrame, signed: DataFrame, labels: DataFrame | None, docs: DataFrame, size: int) -> DataFrame:
    near = stored(_tiles(rows, others, signed, labels, _near, "tile long, role int, node long").distinct())
    sets = _grams(docs, near, size)
    return stored(_tiles(near.where("role = 0").drop("role"), near.where("role = 1").drop("role"), sets, labels, _Linked(), "a long, b long"))


def join(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the smallest doc_id reachable over links of similarity 0.85 or more, and whether it is the own one.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text with fewer words than ``size`` has its whole word sequence as
    one shingle; NULL or wordless text has none and is alone. Equal texts are one class whatever their number. A NULL
    doc_id takes part, but is no one's smallest id unless it stands alone; rows that share their smallest id are all kept.
    Empty input gives no rows. Columns beyond ``doc_id`` and ``text`` are not read.
    """
    with intermediates() as made:
        found = stored(_signed(docs, size))
        members = found.select("doc_id", "n_shingles", "node")
        nodes = stored(found.where("node IS NOT NULL").groupBy("node").agg(F.first("signature").alias("payload")))
        entries = _keyed(nodes.select("node", F.col("payload").alias("signature")))
        shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        entries = stored(entries.join(shared, "key"))

        # Step 1: each node with the leader that it shares most keys with; the node that meets most others leads a key.
        central = entries.groupBy("node").agg(F.sum("n").alias("met"))
        lead = entries.select("key", "node").join(central, "node").groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("lead"))
        entries = stored(entries.select("key", "node").join(lead, "key"))
        shared = entries.where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("n"))
        best = stored(shared.groupBy("node").agg(F.max(F.struct("n", "lead"))["lead"].alias("lead")))
        homes = stored(_dealt(best.select(F.col("lead").alias("node"), F.col("lead").alias("home")).distinct()).select("node", "tile"))
        others = best.join(homes.select(F.col("node").alias("lead"), "tile"), "lead").select("tile", "node").distinct()
        links = _links(homes.select("tile", "node"), others, nodes, None, docs, size)
        labels = stored(components(links))

        # Step 2: what is outside each key's largest component against all of the key.
        sizes = labels.groupBy("component").agg(F.count("*").alias("members"))
        known = entries.select("key", "node").join(labels.join(sizes, "component"), "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component"), F.coalesce("members", F.lit(1)).alias("members"))
        largest = known.groupBy("key").agg(
            F.max(F.struct("members", "component")).alias("main"), F.min("component").alias("low"), F.max("component").alias("high"),
        ).where("low < high").select("key", F.col("main.component").alias("main"), F.col("main.members").alias("main_members"))
        mixed = stored(known.join(largest, "key").select("key", "node", "component", "main", "main_members"))
        outside = mixed.where("component <> main")
        # What is outside the same component shares tiles, so that component meets few of them.
        nearest = outside.groupBy("node").agg(F.max(F.struct("main_members", "main"))["main"].alias("home"))
        outside = stored(outside.join(_dealt(nearest).select("node", "tile"), "node").select("key", "node", "tile"))
        met = mixed.select("key", "node").join(outside.select("key", "tile").distinct(), "key").select("tile", "node").distinct()
        more = _links(outside.select("tile", "node").distinct(), met, nodes, labels, docs, size)
        graph = stored(components(links.union(more)))

        smallest = members.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
        classes = smallest.join(graph, "node", "left").withColumn("component", F.coalesce("component", "node"))
        heads = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        named = stored(classes.join(heads, "component").select("node", "component_id"))
        made.drop(found, named)
        component = F.coalesce("component_id", "doc_id").alias("component_id")
        result = members.join(named, "node", "left").select("doc_id", "n_shingles", component)
        return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: All links by the shingles that two sets share; classes by their closure.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM d
), c AS (
  SELECT min(doc_id) AS node, s, len(s) AS n FROM g WHERE len(s) > 0 GROUP BY s
), e AS (
  SELECT node, n, unnest(s) AS shingle FROM c
), l AS (
  SELECT a.node AS a, b.node AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.node <> b.node
  GROUP BY a.node, b.node HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
), least AS (
  SELECT c.s, least(c.node, coalesce(min(r.b), c.node)) AS component_id FROM c LEFT JOIN reach r ON r.a = c.node GROUP BY c.s, c.node
)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, coalesce(m.component_id, g.doc_id) AS component_id,
       coalesce(m.component_id, g.doc_id) = g.doc_id AS kept
FROM g LEFT JOIN least m ON len(g.s) > 0 AND g.s = m.s
"""
