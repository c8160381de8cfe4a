"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents with equal shingle sets are one node. The product is never formed
whole: nodes are rows, shingles are columns, and size bounds decide which entries
can matter.

1. Columns are ordered: shingles that occur in many nodes last, the rest by hash.
   Two sets that reach the threshold share a shingle among the first
   ``n - ceil(t n) + 1`` of each, so only those entries are kept, and only columns
   with two entries or more.
2. A first product takes one row per column against the others and links what it can.
3. The second takes, per column, every node outside the column's largest component
   against all others of the column: no pair inside a component matters any more, and none
   across components is left out. A group of near copies thus costs its size times the few nodes left out.
4. Rows meet in tiles: about ``TILE`` nodes that share their lowest shingle, or that lie outside the same component, against a stream of other nodes.
   Pairs whose sizes or bit maps (two bits or more per shingle) bound the overlap below the threshold are discarded; for the rest
   the overlap is accumulated over the full sets, exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.components import components
from postings.llm.text import FOLD, mix, shingle_sets, slices
from postings.sources.warehouse import intermediates, stored

SIZE = 5
#: A column met in more nodes than this counts as frequent; where those are more than ``MOST_FREQUENT``, the bar is raised until they are not.
FREQUENT = 20
MOST_FREQUENT = 1_000_000
#: Nodes of a frequent column that go to one block.
SHARE = 500
TILE = 512
FLUSH = 4_000_000
FILTER_BITS = 24
_U = np.uint64


def _nodes(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """The shingle set of every text, and the number that stands for it (0 where empty)."""
    for _, data, offsets in slices(texts):
        for s in shingle_sets(FOLD[data], offsets, size):
            yield s, int((mix(s ^ _U(0x5851F42D4C957F2D)).sum() ^ _U(len(s))).astype(np.int64)) if len(s) else 0


def _least_overlap(a, b):
    """The overlap from which intersection / union reaches 80 / 100."""
    return (4 * (a + b) + 8) // 9


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, node, map) per document, and (gram, count) of shingles met in several nodes of a task."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met, n = [], set(), 0
        names = ["doc_id", "n_shingles", "node", "map", "gram", "count"]

        def counts(id_type: pa.DataType) -> pa.RecordBatch:
            gram, times = np.unique(np.concatenate(held), return_counts=True)
            gram, times = gram[times > 1].view(np.int64), times[times > 1]
            empty = [pa.nulls(len(gram), t) for t in (id_type, pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*empty, pa.array(gram), pa.array(times)], names)

        for b in batches:
            sizes, nodes, maps = [], [], []
            for s, node in _nodes(b.column(1), size):
                sizes.append(len(s))
                maps.append(_map(s) if len(s) else None)
                nodes.append(node if len(s) else None)
                if len(s) and node not in met:
                    met.add(node)
                    held.append(s)
                    n += len(s)
            empty = [pa.nulls(b.num_rows, pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(maps, pa.binary()), *empty], names)
            if n >= FLUSH:
                yield counts(b.column(0).type)
                held, met, n = [], set(), 0
        if held:
            yield counts(b.column(0).type)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, node long, map binary, gram long, count long")


def _entries(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], size: int) -> DataFrame:
    """(gram, node, n) of the columns that hold two nodes or more, from each node's first shingles."""
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(frequent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = shared.value
        grams, owners, sizes, met, n = [], [], [], set(), 0

        def blobs() -> pa.RecordBatch:
            gram, owner, count = np.concatenate(grams), np.concatenate(owners), np.concatenate(sizes)
            # A frequent column is spread by node, so that no block holds it whole.
            salt = np.zeros(len(gram), np.uint64)
            if len(often):
                at = np.minimum(np.searchsorted(often, gram), len(often) - 1)
                split = np.where(often[at] == gram, times[at] // SHARE + 1, 1).astype(np.uint64)
                salt = np.where(split > 1, mix(owner + _U(1)) % split, 0).astype(np.uint64)
            block = (mix(gram + salt * _U(0x9E3779B97F4A7C15)) % _U(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            rows = [(k, b"".join(x[order[a:b]].tobytes() for x in (gram, owner, count))) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"])

        for b in batches:
            for s, node in _nodes(b.column(0), size):
                if not len(s) or node in met:
                    continue
                met.add(node)
                first = len(s) - (4 * len(s) + 4) // 5 + 1
                head = s[:first]
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    rank = np.where(often[at] == s, times[at], 0)
                    head = s[np.argsort(rank, kind="stable")[:first]]
                grams.append(head)
                owners.append(np.full(len(head), node, np.int64).view(np.uint64))
                sizes.append(np.full(len(head), len(s), np.int32))
                n += len(head)
            if n >= FLUSH // 4:
                yield blobs()
                grams, owners, sizes, met, n = [], [], [], set(), 0
        if grams:
            yield blobs()

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, _ = shared.value
        parts = [x.as_py() for b in batches for x in b.column("data")]
        if not parts:
            return
        counts = [len(p) // 20 for p in parts]
        gram = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(parts, counts)])
        node = np.concatenate([np.frombuffer(p, np.uint64, n, 8 * n) for p, n in zip(parts, counts)])
        size_of = np.concatenate([np.frombuffer(p, np.int32, n, 16 * n) for p, n in zip(parts, counts)])
        del parts
        order = np.lexsort((node, gram))
        gram, node, size_of = gram[order], node[order], size_of[order]
        again = np.zeros(len(gram), bool)
        again[1:] = (gram[1:] == gram[:-1]) & (node[1:] == node[:-1])
        gram, node, size_of = gram[~again], node[~again], size_of[~again]
        same = gram[1:] == gram[:-1]
        many = np.append(same, False) | np.insert(same, 0, False)
        if len(often):
            many |= often[np.minimum(np.searchsorted(often, gram), len(often) - 1)] == gram
        for k in range(0, int(many.sum()), 100_000):
            at = np.flatnonzero(many)[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(gram[at].view(np.int64)), pa.array(node[at].view(np.int64)), pa.array(size_of[at])], ["gram", "node", "n"])

    sent = docs.select("text").mapInArrow(send, "block int, data binary").repartitionById(blocks, "block")
    return sent.mapInArrow(receive, "gram long, node long, n int")


def _grams(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, payload) with the sets of the wanted nodes and of few others: a fixed-size bit filter of the wanted ones goes to every task."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            bits[mix(np.asarray(b.column(0)).view(np.uint64)) >> _U(64 - FILTER_BITS)] = True
        yield pa.RecordBatch.from_pydict({"bits": [np.packbits(bits).tobytes()]})

    wanted = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in nodes.select("node").coalesce(8).mapInArrow(mark, "bits binary").toLocalIterator():
        wanted |= np.frombuffer(row.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, met = np.unpackbits(shared.value).astype(bool), set()
        for b in batches:
            out = []
            for s, node in _nodes(b.column(0), size):
                if len(s) and node not in met and bits[int(mix(np.array([node], np.int64).view(np.uint64))[0] >> _U(64 - FILTER_BITS))]:
                    met.add(node)
                    out.append((node, s.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.binary()))], ["node", "payload"])

    return docs.select("text").mapInArrow(run, "node long, payload binary").groupBy("node").agg(F.first("payload").alias("payload"))


def _map(s: np.ndarray) -> bytes:
    """A bit per shingle; the number of bits is a power of two, so the map of a larger set folds onto a smaller map."""
    size = max(256, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(s % _U(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _dealt(homes: DataFrame) -> DataFrame:
    """Nodes of one home in tiles of about ``TILE``."""
    split = homes.groupBy("home").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    return homes.join(split, "home").withColumn("tile", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("parts"))))


def _tiles(rows: DataFrame, others: DataFrame, payload: DataFrame, labels: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run`` over each tile: its rows (role 0) first, then the other nodes (role 1) as they stream in."""
    d = rows.select("tile", F.lit(0).alias("role"), "node").union(others.select("tile", F.lit(1), "node"))
    d = d.join(payload, "node")
    if labels is None:
        d = d.withColumn("component", F.col("node"))
    else:
        d = d.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    d = d.select("tile", "role", "node", "component", "payload").repartition("tile").sortWithinPartitions("tile", "role")
    return d.mapInArrow(lambda batches: _streamed(batches, run), schema)


def _streamed(batches: Iterator[pa.RecordBatch], run: Callable) -> Iterator[pa.RecordBatch]:
    """Cut sorted rows into (tile, its rows, a batch of others); a tile's rows are few, the others may go on over many batches."""
    now, held = None, []
    for b in batches:
        tile, role = np.asarray(b.column("tile")), np.asarray(b.column("role"))
        edges = np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]) | (role[1:] != role[:-1])])
        for a, z in zip(edges, np.append(edges[1:], len(tile))):
            if tile[a] != now:
                now, held = tile[a], []
            part = b.slice(int(a), int(z - a))
            if role[a] == 0:
                held.append(part)
            elif held:
                held = [pa.Table.from_batches(held).combine_chunks().to_batches()[0]] if len(held) > 1 else held
                found = run(now, held[0], part)
                if found is not None and found.num_rows:
                    yield found


def _arrays(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return np.asarray(part.column("node")), np.asarray(part.column("component")), [v.as_py() for v in part.column("payload")]


def _by_map(tile: int, rows: pa.RecordBatch, others: pa.RecordBatch) -> pa.RecordBatch | None:
    """Which nodes of both roles are in a pair that size and bit map do not rule out; a payload is the size, then the map."""
    (x, cx, px), (y, cy, py) = _arrays(rows), _arrays(others)
    nx, ny = (np.array([int.from_bytes(v[:4], "little") for v in p]) for p in (px, py))
    wx, wy = (np.array([(len(v) - 4) // 8 for v in p]) for p in (px, py))
    keep_x, keep_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    for words in np.unique(np.concatenate((wx, wy))):
        # Sizes that fit have maps of equal length or of one and its double.
        sides = [np.flatnonzero((w == words) | (w == 2 * words)) for w in (wx, wy)]
        if not len(sides[0]) or not len(sides[1]):
            continue
        left, right = (np.stack([_folded(p[i], words) for i in side]) for p, side in zip((px, py), sides))
        step = max(1, (1 << 22) // (8 * int(words)))
        for a in range(0, len(sides[1]), 256):
            xs, ys = sides[0], sides[1][a:a + 256]
            fits = _least_overlap(nx[xs][:, None], ny[ys][None]) <= np.minimum(nx[xs][:, None], ny[ys][None])
            fits &= (cx[xs][:, None] != cy[ys][None]) & (np.minimum(wx[xs][:, None], wy[ys][None]) == words)
            i, j = np.nonzero(fits)
            for c in range(0, len(i), step):
                p, q = i[c:c + step], j[c:c + step]
                l, r = left[p], right[q + a]
                most = np.minimum(nx[xs[p]] - np.bitwise_count(l & ~r).sum(1, dtype=np.int64), ny[ys[q]] - np.bitwise_count(r & ~l).sum(1, dtype=np.int64))
                good = most >= _least_overlap(nx[xs[p]], ny[ys[q]])
                keep_x[xs[p[good]]] = True
                keep_y[ys[q[good]]] = True
    nodes = np.concatenate((x[keep_x], y[keep_y]))
    roles = np.repeat([0, 1], [keep_x.sum(), keep_y.sum()])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), tile)), pa.array(roles, pa.int32()), pa.array(nodes)], ["tile", "role", "node"])


def _folded(payload: bytes, words: int) -> np.ndarray:
    bits = np.frombuffer(payload, np.uint64, offset=4)
    return bits if len(bits) == words else bits[:words] | bits[words:]


def _by_overlap(tile: int, rows: pa.RecordBatch, others: pa.RecordBatch) -> pa.RecordBatch:
    """Links across components: the overlap of every row with every other node, accumulated shingle by shingle."""
    (x, cx, px), (y, cy, py) = _arrays(rows), _arrays(others)
    nx, ny = (np.array([len(v) // 8 for v in p]) for p in (px, py))
    column = np.concatenate([np.frombuffer(v, np.uint64) for v in px])
    owner = np.repeat(np.arange(len(x)), nx)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = []
    for j, v in enumerate(py):
        s = np.frombuffer(v, np.uint64)
        a, b = np.searchsorted(column, s, "left"), np.searchsorted(column, s, "right")
        hit = b > a
        a, length = a[hit], (b - a)[hit]
        if not len(a):
            continue
        at = np.repeat(a - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
        overlap = np.bincount(owner[at], minlength=len(x))
        good = np.flatnonzero((overlap >= _least_overlap(nx, ny[j])) & (cx != cy[j]))
        if len(good):
            # One link to a component says all.
            good = good[np.unique(cx[good], return_index=True)[1]]
            out += [(int(x[i]), int(y[j])) for i in good]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def _links(rows: DataFrame, others: DataFrame, maps: DataFrame, labels: DataFrame | None, docs: DataFrame, size: int) -> DataFrame:
    """Links between the rows and the other nodes of each tile; only sets whose maps pass are made again from their texts."""
    left = stored(_tiles(rows, others, maps, labels, _by_map, "tile long, role int, node long").distinct())
    grams = _grams(docs, left, size)
    return stored(_tiles(left.where("role = 0"), left.where("role = 1"), grams, labels, _by_overlap, "a long, b long"))


def join(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable over links of Jaccard similarity 0.8 or more.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text with fewer words than ``size`` has its whole word
    sequence as one shingle; NULL or wordless text has none and is alone. Equal texts are one class whatever their
    number. A NULL doc_id takes part, but is no one's smallest id unless it stands alone. Empty input gives no rows.
    """
    with intermediates() as made:
        found = stored(_sets(docs, size))
        members = found.where("gram IS NULL").select("doc_id", "n_shingles", "node")
        counted = stored(found.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("count").alias("count")).where(F.col("count") > FREQUENT))
        # The bar comes from how many columns have each count; counts beyond ten thousand are one step.
        steps = sorted(counted.groupBy(F.least("count", F.lit(10_000)).alias("count")).agg(F.count("*").alias("n")).collect(), reverse=True)
        bar, n = FREQUENT, 0
        for step in steps:
            n += step.n
            if n > MOST_FREQUENT:
                bar = step["count"]
                break
        often = counted.where(F.col("count") > bar).limit(MOST_FREQUENT).toArrow()
        gram = np.asarray(often["gram"]).astype(np.int64).view(np.uint64)
        order = np.argsort(gram)
        entries = stored(_entries(docs, (gram[order], np.asarray(often["count"]).astype(np.int64)[order]), size))

        homes = entries.groupBy("node").agg(F.first("n").alias("n"), F.min("gram").alias("home"))
        nodes = stored(_dealt(homes).select("node", "n", "tile"))
        # A map goes with its set's size in front, four bytes.
        of_node = found.where("node IS NOT NULL").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("map").alias("map"))
        size_bytes = F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright("n", 8 * k).bitwiseAND(255)), 2, "0") for k in range(4)]))
        maps = stored(of_node.join(nodes.select("node"), "node", "left_semi").select("node", F.concat(size_bytes, F.col("map")).alias("payload")))

        # First product: each column's first node against the others of the column.
        def fits(n, m):
            return (F.col(n) * 5 >= F.col(m) * 4) & (F.col(m) * 5 >= F.col(n) * 4)

        lead = entries.groupBy("gram").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("x")).select("gram", F.col("x.node").alias("x"), F.col("x.n").alias("m"))
        pairs = stored(entries.join(lead, "gram").where((F.col("x") != F.col("node")) & fits("n", "m")).select("x", F.col("node")).distinct())
        tiles = nodes.select(F.col("node").alias("x"), "tile")
        first = pairs.join(tiles, "x").select("tile", "x", "node")
        links = _links(first.select("tile", F.col("x").alias("node")).distinct(), first.select("tile", "node").distinct(), maps, None, docs, size)
        labels = stored(components(links))

        # Second product: what is outside each column's largest component against all of the column.
        sizes = labels.groupBy("component").agg(F.count("*").alias("members"))
        known = entries.join(labels.join(sizes, "component"), "node", "left").select(
            "gram", "node", "n", F.coalesce("component", "node").alias("component"), F.coalesce("members", F.lit(1)).alias("members"))
        largest = known.groupBy("gram").agg(
            F.max(F.struct("members", "component")).alias("main"), F.min("component").alias("low"), F.max("component").alias("high"),
        ).where("low < high").select("gram", F.col("main.component").alias("main"), F.col("main.members").alias("main_members"))
        open_entries = stored(known.join(largest, "gram").select("gram", "node", "n", "component", "main", "main_members"))
        # What is outside the same component shares tiles, so that component meets few of them.
        outside = open_entries.where("component <> main")
        nearest = outside.groupBy("node").agg(F.max(F.struct("main_members", "main"))["main"].alias("home"))
        outside = stored(outside.join(_dealt(nearest).select("node", "tile"), "node").select("gram", "node", "n", "tile"))
        # A tile meets a node only if some outside node of the tile fits its size: sizes that fit are a step apart at most.
        step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.26)))
        seekers = outside.select("gram", "tile", F.explode(F.array(step - 1, step, step + 1)).alias("step")).distinct().groupBy("gram", "step").agg(F.collect_list("tile").alias("tiles"))
        met = open_entries.withColumn("step", step).join(seekers, ["gram", "step"]).select("node", "tiles")

        def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each (tile, node) once per batch, before the rows are dealt out."""
            for b in batches:
                tiles_of = b.column("tiles")
                tile_ = np.asarray(tiles_of.flatten())
                node_ = np.repeat(np.asarray(b.column("node")), np.asarray(tiles_of.value_lengths()))
                order_ = np.lexsort((node_, tile_))
                tile_, node_ = tile_[order_], node_[order_]
                new = np.ones(len(tile_), bool)
                new[1:] = (tile_[1:] != tile_[:-1]) | (node_[1:] != node_[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(tile_[new]), pa.array(node_[new])], ["tile", "node"])

        others = met.mapInArrow(once, "tile long, node long").distinct()
        more = _links(outside.select("tile", "node").distinct(), others, maps, labels, docs, size)
        graph = stored(components(links.union(more)))

        smallest = members.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
        classes = smallest.join(graph, "node", "left").withColumn("component", F.coalesce("component", "node"))
        heads = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        named = stored(classes.join(heads, "component").select("node", "component_id"))
        made.drop(found, named)
        return members.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
