"""SentencePiece encoding as a relational lattice, and decoding.

A text is a space-marked string; no piece runs over a line end or from another
character to a space, so a run of spaces and the word after it are segmented apart. Neither does any run over two characters
that stand side by side in no piece, so every path goes through the place between them and a word is cut there into parts, each distinct part
once. Its substrings up to the longest piece are exploded and equi-joined to the piece table; the matches,
grouped by part, are the edges of its lattice, and a higher-order aggregate folds
them into the cheapest path. A character without a piece takes its UTF-8 bytes' pieces.

A text is cut into words once. A chunk of documents is then the numbers of their words and of the words' parts; it is
dealt out once. The parts of a chunk go to the part's block and their pieces come back in the order of their numbers, each packed, so that what
moves is a fraction of the text and a document's pieces are put together by number.

A pair-encoding model file has merge ranks, no log-probabilities. A piece's cost is then the logarithm of its rank plus
two (word frequencies fall about as one over the rank), and the path of least total cost wins; of equal ways to a place
the one with the smaller last id.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from postings.llm.workers import let_go, letting_go

CHUNK_BYTES = 6 << 20
MARK = "\u2581"
#: Stands for a space mark of the text's own inside the lattice; a private-use character, so no piece holds it.
OWN = "\ue000"
#: Costs are whole numbers, ten thousand to one.
SCALE = 10_000
_UNKNOWN = 50 * SCALE
_LENGTH_BITS, _ID_BITS = 4, 22
#: Of an edge: a cost is at most _UNKNOWN, which has 19 bits; above them there is room for a place in a word of LONGEST_WORD.
_EDGE_BITS = 45
_NO_PIECE = 1 << 21
#: Longer words are cut on their cheapest path into parts of at most so many characters, so that a cost fits its bits.
LONGEST_WORD = 1 << 16
#: Words whose edges are grouped in memory at once, some kilobytes each; a task has fewer.
GROUPED_WORDS = 100_000
#: Pieces put together at once.
SLICE_PIECES = 1 << 16
#: Words cut into parts at once.
SLICE_WORDS = 1 << 14


_WORDS = re.compile(r" *[^ \n]+| +|\n")


@cache
def _model(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


def piece_table(path: str) -> list[tuple[str, int, int]]:
    """(piece, id, cost) of every piece that may stand in a word: no control or byte piece; space marks stand in front."""
    m = _model(path)
    out = []
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        if m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i):
            continue
        if MARK in p.lstrip(MARK) or "\n" in p:
            raise ValueError(f"piece {i} runs over the end of a word")
        # A run of space marks has no rank in a pair-encoding model; its number stands for one.
        rank = i if m.get_score(i) < -1e8 else max(0.0, -m.get_score(i))
        out.append((p, i, round(SCALE * math.log(2 + rank))))
    return out


def byte_ids(path: str) -> list[int]:
    """The ids of the 256 byte pieces."""
    m = _model(path)
    return [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def words_of(text: str, edges: dict[str, int] | None = None) -> list[str]:
    """The words of a text, the spaces before each in front as in the marked string; line ends stay in them or are words of their own.

    With ``edges``, of ``packed_edges``, longer words than ``LONGEST_WORD`` are in parts.
    """
    marked = " " + text
    if "  " not in marked and len(text) < LONGEST_WORD:
        return [" " + w for w in text.split(" ")]
    out = _WORDS.findall(marked)
    if edges is not None and len(text) >= LONGEST_WORD:
        out = [x for w in out for x in ([w] if len(w) <= LONGEST_WORD else _parts(w, edges))]
    return out


def neighbours(edges: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every code point, 0 if it has no neighbour in any piece, and whether two numbers stand side by side in one.

    Of texts as they are: a space is the mark of the pieces, and the mark itself is in no piece.
    """
    pairs = {(a, b) for p in edges for a, b in zip(p, p[1:])}
    at = {c: k for k, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
    number, beside = np.zeros(0x110000, np.uint16), np.zeros((len(at) + 1, len(at) + 1), bool)
    for c, k in at.items():
        number[ord(" " if c == MARK else c)] = k
    for a, b in pairs:
        beside[at[a], at[b]] = True
    return number, beside


def parts_of(words: list[str], number: np.ndarray, beside: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The words cut where no piece runs over, one after another, and how many parts each has."""
    joined = "".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    k = number[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    cut = np.ones(len(k), bool)
    cut[:-1] = ~beside[k[:-1], k[1:]]
    cut[ends - 1] = True
    at = np.flatnonzero(cut) + 1
    stops = at.tolist()
    return [joined[a:b] for a, b in zip([0, *stops], stops)], np.diff(np.searchsorted(at, ends, "right"), prepend=0)


def packed_edges(table: list[tuple[str, int, int]]) -> dict[str, int]:
    """Cost and id of each piece as one number, the length left open."""
    return {p: _packed_edge(c, i) for p, i, c in table}


def _parts(word: str, edges: dict[str, int]) -> list[str]:
    """A long word cut at places of its cheapest path, so that its parts' cheapest paths make up the whole one."""
    marked, longest = word.replace(MARK, OWN).replace(" ", MARK), max(map(len, edges))
    id_mask = (1 << _LENGTH_BITS + _ID_BITS) - 1
    costs, back = [0] * longest, bytearray(len(word) + 1)
    for e in range(1, len(marked) + 1):
        best, length = None, 1
        for n in range(1, min(longest, e) + 1):
            edge = edges.get(marked[e - n:e])
            if edge is None:
                if n > 1:
                    continue
                c = marked[e - 1]
                edge = _packed_edge(_UNKNOWN, _NO_PIECE) + (ord(MARK if c == OWN else c) << _LENGTH_BITS)
            way = (costs[(e - n) % longest] << _LENGTH_BITS + _ID_BITS) + edge + n - 1
            if best is None or way < best:
                best, length = way, n
        costs[e % longest], back[e] = (best & ~id_mask) >> _LENGTH_BITS + _ID_BITS, length
    cuts, e = [len(word)], len(word)
    while e:
        before = e - back[e]
        if cuts[-1] - before > LONGEST_WORD:
            cuts.append(e)
        e = before
    cuts = [0, *reversed(cuts)]
    return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _chunks(docs: DataFrame, shared: Broadcast, blocks: int) -> DataFrame:
    """(chunk, data, asked): documents by the megabyte as numbers of words and parts, and their distinct parts by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, number, beside = shared.value
        part, seq = TaskContext.get().partitionId(), 0
        ids, places, size, seen = [], [], 0, _numbering()

        def out() -> pa.RecordBatch:
            held = [_squeezed(np.fromiter(map(len, places), np.int32, len(places)))]
            place, words = np.concatenate(places), list(seen)
            places.clear()
            seen.clear()
            # Common words get small numbers, which take less room.
            order = np.argsort(-np.bincount(place), kind="stable").astype(np.int32)
            number_of = np.empty_like(order)
            number_of[order] = np.arange(len(order), dtype=np.int32)
            held.append(_squeezed(number_of[place]))
            del place, number_of
            known, many, parts = _numbering(), [], []
            for k in range(0, len(order), SLICE_WORDS):
                names, n = parts_of([words[i] for i in order[k:k + SLICE_WORDS].tolist()], number, beside)
                many.append(n)
                parts.append(np.fromiter(map(known.__getitem__, names), np.int32, len(names)))
            del words, names
            asked = _blocked(sorted(known), blocks)
            at = np.empty(len(known), np.int32)
            at[np.fromiter((known[x] for some in asked for x in some), np.int32, len(known))] = np.arange(len(known), dtype=np.int32)
            held += [_squeezed(np.concatenate(many)), _squeezed(at[np.concatenate(parts)])]
            data, names = pickle.dumps((ids, held), 5), pickle.dumps([(k, _listed(x)) for k, x in enumerate(asked) if x], 5)
            return pa.RecordBatch.from_arrays([pa.array([part << 24 | seq], pa.int64()), pa.array([data], pa.binary()), pa.array([names], pa.binary())], ["chunk", "data", "asked"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_py() or ""
                words = words_of(raw, edges)
                ids.append(doc)
                places.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    yield out()
                    seq, ids, size, seen = seq + 1, [], 0, _numbering()
        if ids:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(letting_go(run), "chunk long, data binary, asked binary")


def _numbering() -> defaultdict[str, int]:
    """Numbers what it is asked for, from 0."""
    return defaultdict(count().__next__)


def _squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits compressed, the first bytes of all before the second ones."""
    return zstandard.ZstdCompressor(level=3).compress(np.asarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(data: bytes) -> np.ndarray:
    """What :func:`_squeezed` was given."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _listed(names: list[str]) -> bytes:
    """Parts compressed, by line; a line end is a part of its own and stands as an empty line."""
    return zstandard.ZstdCompressor(level=3).compress("\n".join(["" if x == "\n" else x for x in names]).encode("utf-8", "surrogatepass"))


def _names(data: bytes) -> list[str]:
    """What :func:`_listed` was given."""
    return [x or "\n" for x in zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass").split("\n")]


def _blocked(words: list[str], blocks: int) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in range(blocks)]
    for w in words:
        out[zlib.crc32(w.encode("utf-8", "surrogatepass")) % blocks].append(w)
    return out


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``flat`` one after another."""
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return flat[at]


def _before(lengths: np.ndarray) -> np.ndarray:
    """Where each range begins, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def _sliced(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges (first, after the last) that hold at most ``most``, or one that holds more; ``starts`` of ``_before``."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, "right")) - 1)
        yield first, last
        first = last


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(word, ids) of distinct ``words`` by the cheapest path; a character without a piece has minus one less its code point for an id.

    ``words`` are partitioned by word, and exploding and the join with the small piece table keep that, so grouping the edges moves nothing.
    An edge, and the best way to a place, is one number: cost, id and length from the high bits to the low ones, so
    that the least number is the cheapest way. While edges are grouped the place they end at stands above.
    """
    d = words.where(F.length("word") > 0).select("word", F.translate("word", MARK + " ", OWN + MARK).alias("marked"))
    d = d.select("word", "marked", F.explode(F.sequence(F.lit(1), F.length("marked"))).alias("e"))
    d = d.select("word", "marked", "e", F.explode(F.sequence(F.greatest(F.lit(1), F.col("e") - (longest - 1)), F.col("e"))).alias("s"))
    d = d.select("word", "e", (F.col("e") - F.col("s")).alias("more"), F.expr("substring(marked, s, e - s + 1)").alias("piece"))
    d = d.join(F.broadcast(pieces), "piece", "left").where("edge IS NOT NULL OR more = 0")
    point = F.when(F.col("piece") == OWN, F.lit(ord(MARK))).otherwise(F.expr("ascii(piece)")).cast("long")
    lost = F.lit(_packed_edge(_UNKNOWN, _NO_PIECE)) + point * (1 << _LENGTH_BITS)
    d = d.select("word", (F.shiftleft(F.col("e").cast("long"), _EDGE_BITS) + F.coalesce("edge", lost) + F.col("more")).alias("edge"))
    d = d.groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    low = (1 << _LENGTH_BITS + _ID_BITS) - 1
    end, edge, more = f"cast(shiftright(x, {_EDGE_BITS}) as int)", f"(x & {(1 << _EDGE_BITS) - 1}L)", f"cast(x & {(1 << _LENGTH_BITS) - 1}L as int)"
    way = f"(if({end} - 1 - {more} = t.e, t.best, t.done[{end} - 1 - {more}]) & {~low}L) + {edge}"
    path = f"""aggregate(edges, named_struct('done', cast(array() as array<bigint>), 'e', 0, 'best', 0L),
        (t, x) -> if({end} = t.e,
            named_struct('done', t.done, 'e', t.e, 'best', least(t.best, {way})),
            named_struct('done', array_append(t.done, t.best), 'e', {end}, 'best', {way})),
        t -> array_append(t.done, t.best))"""
    d = d.select("word", F.expr(path).alias("best"))
    number = f"cast(shiftright(best[t.at], {_LENGTH_BITS}) & {(1 << _ID_BITS) - 1} as int)"
    back = f"""aggregate(sequence(2, size(best)), named_struct('at', size(best) - 1, 'ids', cast(array() as array<int>)),
        (t, k) -> if(t.at = 0, t, named_struct('at', t.at - 1 - cast(best[t.at] & {(1 << _LENGTH_BITS) - 1} as int), 'ids', array_append(t.ids, {number}))),
        t -> transform(reverse(t.ids), i -> if(i >= {_NO_PIECE}, {_NO_PIECE} - 1 - i, i)))"""
    return d.select("word", F.expr(back).alias("ids"))


def _packed_edge(cost: int, number: int) -> int:
    return (cost << _ID_BITS | number) << _LENGTH_BITS


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``: the ids of its pieces.

    NULL text counts as empty and has the one piece of a space mark; repeated rows are encoded each. A text's own space
    marks (U+2581) are written as bytes, so decoding returns every text as it was. Other columns are ignored.
    """
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = piece_table(path)
    edges = packed_edges(table)
    # A local relation: rows given as a list would pass through Python workers of their own.
    pieces = spark.createDataFrame(pa.table({"piece": pa.array(list(edges), pa.string()), "edge": pa.array(list(edges.values()), pa.int64())}))
    shared = spark.sparkContext.broadcast((edges, *neighbours(edges)))
    longest = max(len(p) for p, _, _ in table)
    if longest > 1 << _LENGTH_BITS:
        raise ValueError(f"a piece is longer than {1 << _LENGTH_BITS} characters")
    # Grouping falls back to sorting beyond so many groups; the words of a task are meant to stay below.
    limit = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    spark.conf.set(limit, str(max(int(spark.conf.get(limit)), GROUPED_WORDS)))
    bytes_of = byte_ids(path)

    chunks = _chunks(docs, shared, blocks).repartition(blocks, "chunk")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, data in zip(b.column("chunk").to_pylist(), b.column("asked")):
                rows = pickle.loads(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                    ["block", "chunk", "words"])

    asked = chunks.mapInArrow(ask, "block int, chunk long, words binary").repartition(blocks, "block")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for b in batches:
            for block, words in zip(b.column("block").to_pylist(), b.column("words")):
                found.update(dict.fromkeys(_names(words.as_py()), block))
        names = list(found)
        for k in range(0, len(names), 20_000):
            part = names[k:k + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([found[w] for w in part], pa.int32())], ["word", "block"])

    # Some twenty edges a word are grouped in memory, so words are dealt out finer than texts.
    words = asked.mapInArrow(distinct, "word string, block int").repartition(4 * blocks, "word")
    known = lattice(words.select("word"), pieces, longest)
    # A word's block follows from the word alone.
    known = known.select((F.crc32("word") % blocks).cast("int").alias("block"), "word", "ids")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words and ids of a task, one compressed row per block."""
        held: list[tuple[list[str], list[np.ndarray]]] = [([], []) for _ in range(blocks)]
        for b in batches:
            lengths = np.asarray(pc.list_value_length(b.column("ids")))
            flat, ends = np.asarray(b.column("ids").flatten(), np.int32), np.cumsum(lengths)
            for block, word, end, n in zip(b.column("block").to_pylist(), b.column("word").to_pylist(), ends.tolist(), lengths.tolist()):
                held[block][0].append(word)
                held[block][1].append(flat[end - n:end])
        rows = [(k, _listed(w), _squeezed(np.fromiter(map(len, v), np.int32, len(v))), _squeezed(np.concatenate(v))) for k, (w, v) in enumerate(held) if w]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))], ["block", "words", "lengths", "ids"])

    known = known.mapInArrow(pack, "block int, words binary, lengths binary, ids binary")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        """The ids of every asked word, chunk by chunk, in the order asked."""
        at = dict(zip((w for data in right.column("words") for w in _names(data.as_py())), count()))
        none = [np.zeros(0, np.int32)]
        lengths, flat = (np.concatenate(none + [_numbers(data.as_py()) for data in right.column(c)]) for c in ("lengths", "ids"))
        starts, out = _before(lengths), []
        for data in left.column("words"):
            names = _names(data.as_py())
            k = np.fromiter(map(at.__getitem__, names), np.int64, len(names))
            out.append((_squeezed(lengths[k]), _squeezed(_gathered(flat, starts[k], lengths[k]))))
        return pa.table({"chunk": left.column("chunk"), "block": left.column("block"), "lengths": pa.array([x for x, _ in out], pa.binary()), "ids": pa.array([x for _, x in out], pa.binary())})

    answers = asked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(answer, "chunk long, block int, lengths binary, ids binary")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        (data,) = left.column("data").to_pylist()
        ids, held = pickle.loads(data)
        n_words, words, n_parts, parts = map(_numbers, held)
        right = right.sort_by("block")
        lengths, flat = (np.concatenate([_numbers(data.as_py()) for data in right.column(c)]) for c in ("lengths", "ids"))
        flat, lengths = _spelt_out(flat, lengths, bytes_of)
        # From parts to words, then from words to documents.
        flat, lengths = _gathered(flat, _before(lengths)[parts], lengths[parts]), np.add.reduceat(lengths[parts], _before(n_parts)[:-1])
        starts, at = _before(lengths), _before(n_words)
        sizes = np.add.reduceat(lengths[words], at[:-1])
        ends = _before(sizes)
        out = np.empty(ends[-1], np.int32)
        for a, b in _sliced(ends, SLICE_PIECES):
            some = words[at[a]:at[b]]
            out[ends[a]:ends[b]] = _gathered(flat, starts[some], lengths[some])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32()))
        return pa.table({"doc_id": pa.array(ids, pa.int64() if kind == "bigint" else None), "ids": lists})

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        """A chunk's documents with the pieces of their words put in place."""
        out = joined(left, right)
        let_go()
        return out

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(whole, f"doc_id {kind}, ids array<int>")


def _spelt_out(values: np.ndarray, lengths: np.ndarray, bytes_of: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece, given as minus one less their code point, as the pieces of their bytes."""
    lost = np.flatnonzero(values < 0)
    if not len(lost):
        return values, lengths
    spelt = [[bytes_of[b] for b in chr(-1 - int(values[k])).encode("utf-8", "surrogatepass")] for k in lost]
    owner = np.searchsorted(np.cumsum(lengths), lost, "right")
    lengths = lengths.copy()
    np.add.at(lengths, owner, [len(s) - 1 for s in spelt])
    parts, last = [], 0
    for k, s in zip(lost.tolist(), spelt):
        parts += [values[last:k], s]
        last = k + 1
    return np.concatenate([*parts, values[last:]]).astype(np.int32), lengths


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text its ids spell; NULL ids give NULL."""
    m = _model(path)
    spelling = [b"" if m.is_control(i) or m.is_unknown(i) else bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i)
                else m.id_to_piece(i).replace(MARK, " ").encode() for i in range(m.get_piece_size())]
    spelt, many = np.frombuffer(b"".join(spelling), np.uint8), np.fromiter(map(len, spelling), np.int64, len(spelling))
    starts = _before(many)
    columns = [c for c in encoded.columns if c != text]
    at = columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(at)
            flat, ends = np.asarray(lists.flatten()), _before(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            for first, last in _sliced(ends, SLICE_PIECES):
                some, part = flat[ends[first]:ends[last]], b.slice(first, last - first)
                raw = _gathered(spelt, starts[some], many[some]).tobytes()
                cuts = _before(many[some])[ends[first:last + 1] - ends[first]].tolist()
                out = [raw[i:j].removeprefix(b" ").decode("utf-8", "replace") if there else None
                       for i, j, there in zip(cuts[:-1], cuts[1:], part.column(at).is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*columns, text])

    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)
    return encoded.select(*columns).mapInArrow(letting_go(run), f"{schema}, `{text}` string")


def summary(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, ids_hash, decoded_sha256) of every row, the last from the text decoded back."""
    d = decode(encode(docs, path), path)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), F.sha2("text", 256).alias("decoded_sha256"))

