"""Removes bytes that a string of ``LENGTH`` bytes covers which also starts earlier, by partly sorted suffixes.

Suffixes are compared to a depth of ``LENGTH`` only, and only where a repeat is possible:

1. Every window of ``LENGTH`` bytes has an anchor, the least-hashed string of ``ANCHOR`` bytes in it. Equal windows have
   equal anchors at equal places, so an anchor met once in all texts clears the windows it stands for.
2. The windows of repeated anchors travel as stretches of text to the task of their anchor. There their suffixes are
   sorted in the deep-shallow way: multikey quicksort on eight bytes at a time down to a shallow depth, then a blind trie
   for each group that still shares its prefix: it jumps to the next byte in which members differ, never over the
   same bytes twice. Suffixes that end in one leaf are equal to the full depth; the one that starts first stays.
3. An anchor in very many texts is spread over tasks; what is left of its windows meets once more by hash.

Exact copies of a text are settled before: all but the first are covered whole, and only one travels.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.text import _BYTE, mix, powers, slices
from postings.sources.warehouse import stored

LENGTH = 100
ANCHOR = 32
SHALLOW = 16
#: An anchor with more occurrences, and more than a millionth of all, counts as frequent; so there are at most a million.
FREQUENT = 500
PIECE = 1 << 20
_PLACE = 24
_U = np.uint64


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every anchor in a slice of texts: row, hash, its place, and the first and last window it stands for, all from the text's start."""
    found = []
    for at in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        part = data[at:at + PIECE + LENGTH - 1]
        n = len(part) - LENGTH + 1
        up, down = powers(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up, out=total[1:])
        last = len(part) - ANCHOR + 1
        h = mix((total[ANCHOR:] - total[:last]) * down[:last])
        least = (h >> _U(_PLACE) << _U(_PLACE)) | np.arange(last, dtype=np.uint64)
        width, want = 1, LENGTH - ANCHOR + 1
        while 2 * width <= want:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[:n], least[want - width:want - width + n])
        window = np.arange(at, at + n)
        row = np.searchsorted(offsets, window, "right") - 1
        whole = window + LENGTH <= offsets[row + 1]
        window, row, place = window[whole], row[whole], (least[whole] & _U((1 << _PLACE) - 1)).astype(np.int64)
        if not len(window):
            continue
        edge = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
        end = np.append(edge[1:], len(window)) - 1
        base = offsets[row[edge]]
        found.append((row[edge], h[place[edge]], place[edge] + at - base, window[edge] - base, window[end] - base))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def blind_classes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int = LENGTH, shallow: int = SHALLOW) -> np.ndarray:
    """A number for every suffix: equal for suffixes of one group that agree in their first ``depth`` bytes.

    The groups' suffixes are sorted eight bytes at a time to the shallow depth. Then a blind trie grows from each group
    of two or more, all groups at once: its members are compared with the first of them, which gives the next byte
    where any two part, and the members fall into children by that byte alone.
    """
    number = np.unique(group, return_inverse=True)[1].astype(np.int64)
    windows = sliding_window_view(data, depth)
    live = np.arange(len(starts))

    def refine(at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """New numbers for ``at`` by (number, key); returns those whose group has two members or more."""
        nonlocal following
        order = np.lexsort((key, number[at]))
        at, key = at[order], key[order]
        new = np.r_[True, (number[at][1:] != number[at][:-1]) | (key[1:] != key[:-1])]
        numbers = np.cumsum(new) - 1
        count = np.bincount(numbers)
        number[at] = numbers + following
        following += len(count)
        return at[count[numbers] > 1]

    following = int(number.max(initial=0)) + 1
    live = refine(live, np.zeros(len(live), np.uint8))
    words = sliding_window_view(data, 8)
    for k in range(0, shallow, 8):
        if len(live):
            live = refine(live, np.ascontiguousarray(words[starts[live] + k]).view(">u8")[:, 0].astype(np.uint64))
    while len(live):
        # ``live`` is sorted by group, so a group's first member heads it.
        first = np.flatnonzero(np.r_[True, number[live][1:] != number[live][:-1]])
        sizes = np.diff(np.append(first, len(live)))
        head = np.repeat(live[first], sizes)
        part = np.full(len(live), depth)
        for a in range(0, len(live), 65536):
            s = slice(a, a + 65536)
            unlike = windows[starts[live[s]]] != windows[starts[head[s]]]
            hit = unlike.any(1)
            part[s][hit] = unlike[hit].argmax(1)
        branch = np.minimum.reduceat(part, first)
        going = np.repeat(branch, sizes) < depth
        live, place = live[going], np.repeat(branch, sizes)[going]
        if len(live):
            live = refine(live, data[starts[live] + place])
    return number


def _blobs(block: np.ndarray, blocks: int, pack) -> pa.RecordBatch:
    """One row per block that has entries; ``pack`` makes its bytes from the entries' numbers."""
    order = np.argsort(block, kind="stable")
    cuts = np.searchsorted(block[order], np.arange(blocks + 1))
    rows = [(k, pickle.dumps(pack(order[a:b]), 5)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    parts = [pickle.loads(x.as_py()) for b in batches for x in b.column("data")]
    return [np.concatenate(x) for x in zip(*parts)] if parts else []


def _by_text(text: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(t, places) rows: for each text its entries as 64-bit numbers, side by side."""
    order = np.argsort(text, kind="stable")
    text, table = text[order], np.stack(values, 1).astype(np.int64)[order]
    edge = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    ends = np.append(edge[1:], len(text))
    for k in range(0, len(edge), 10_000):
        e, z = edge[k:k + 10_000], ends[k:k + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(text[e]), pa.array([table[a:b].tobytes() for a, b in zip(e, z)], pa.binary())], ["t", "places"])


def _repeated(docs: DataFrame, blocks: int) -> DataFrame:
    """(t, places) of the anchors that occur twice or more in different places of all distinct texts; with t NULL, frequent anchors and their counts."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = set(), [], 0

        def out() -> pa.RecordBatch:
            h, t, place = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, t, place = h[order], t[order], place[order]
            edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.append(edge, len(h)))
            # Of anchors repeated here the first stands for all at the receiver; the others are known already.
            known = np.repeat(count > 1, count)
            leads = np.zeros(len(h), bool)
            leads[edge] = True
            number = np.where(leads, np.repeat(count, count), 0)
            block = (mix(h + _U(3)) % _U(blocks)).astype(np.int64)
            return _blobs(block, blocks, lambda i: (h[i], t[i], place[i], number[i], known[i]))

        for b in batches:
            ids = np.asarray(b.column(0))
            for first, data, offsets in slices(b.column(1)):
                row, h, place, _, _ = anchors(data, offsets)
                t = ids[first:first + len(offsets) - 1]
                fresh = np.array([not (x in seen or seen.add(x)) for x in t.tolist()], bool)
                keep = fresh[row] if len(row) else np.zeros(0, bool)
                held.append((h[keep], t[row[keep]], place[keep]))
                n += int(keep.sum())
            if n >= 1_000_000:
                yield out()
                seen, held, n = set(), [], 0
        if n:
            yield out()

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _gathered(batches)
        if not parts:
            return
        h, t, place, number, known = parts
        lead = number > 0
        flagged = [(t[~lead], place[~lead])]
        h, t, place, number = h[lead], t[lead], place[lead], number[lead]
        order = np.lexsort((place, t, h))
        h, t, place, number = h[order], t[order], place[order], number[order]
        edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.append(edge, len(h)))
        # One text may come from several tasks: an anchor of only that text and place is no repeat.
        other = np.r_[False, (h[1:] == h[:-1]) & ((t[1:] != t[:-1]) | (place[1:] != place[:-1]))]
        twice = (np.maximum.reduceat(number, edge) > 1) | np.logical_or.reduceat(other, edge)
        yes = np.repeat(twice, size)
        flagged.append((t[yes], place[yes]))
        t_all, place_all = (np.concatenate(x) for x in zip(*flagged))
        if len(t_all):
            yield from _by_text(t_all, place_all)
        total = np.add.reduceat(number, edge)
        often = total > FREQUENT
        if often.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([np.stack((h[edge][often].view(np.int64), total[often])).tobytes()], pa.binary())], ["t", "places"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([np.array([total.sum()], np.int64).tobytes()], pa.binary())], ["t", "places"])

    sent = docs.select("t", "text").mapInArrow(send, "block int, data binary").repartitionById(blocks, "block")
    return sent.mapInArrow(receive, "t long, places binary")


def _covered(docs: DataFrame, flags: DataFrame, firsts: DataFrame, frequent: np.ndarray, blocks: int) -> DataFrame:
    """(t, places) with the runs of windows of each first text that also start earlier; with t NULL, data of frequent anchors left to compare."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row of each text per task, so that copies do not travel."""
        seen: set[int] = set()
        for b in batches:
            new = [not (x in seen or seen.add(x)) for x in b.column(0).to_pylist()]
            yield b.filter(pa.array(new, pa.bool_()))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, now, held, n = shared.value, None, [], 0

        def out() -> pa.RecordBatch:
            h, doc, t, place, first, last, texts = zip(*held)
            sizes = [len(x) for x in h]
            h, place, first, last = (np.concatenate(x) for x in (h, place, first, last))
            doc, t = np.repeat(doc, sizes), np.repeat(t, sizes)
            base = np.repeat(np.concatenate(([0], np.cumsum([len(x) for x in texts])[:-1])), sizes)
            data = np.concatenate(texts)
            order = np.lexsort((first, doc))
            # Equal stretches of one task: the first travels, the others are covered whole.
            known, copy = {}, np.zeros(len(h), bool)
            view = data.tobytes()
            for k in order.tolist():
                key = (h[k].item(), place[k] - first[k], view[base[k] + first[k]:base[k] + last[k] + LENGTH])
                copy[k] = known.setdefault(key, k) != k
            salt = np.zeros(len(h), np.uint64)
            if len(often):
                at = np.minimum(np.searchsorted(often, h), len(often) - 1)
                salt = np.where(often[at] == h, mix(doc.astype(np.uint64)) | _U(1), 0).astype(np.uint64)
            block = (mix(h + salt) % _U(blocks)).astype(np.int64)

            def pack(i: np.ndarray) -> tuple:
                length = np.where(copy[i], 0, last[i] + LENGTH - first[i])
                text = np.frombuffer(b"".join([view[base[k] + first[k]:base[k] + first[k] + m] for k, m in zip(i.tolist(), length.tolist())]), np.uint8)
                return h[i], doc[i], t[i], (place[i] - first[i]).astype(np.int16), first[i], last[i], length.astype(np.int32), text

            return _blobs(block, blocks, pack)

        for b in batches:
            for r, t in enumerate(b.column("t").to_pylist()):
                if t == now:
                    continue
                now = t
                data = np.frombuffer((b.column("text")[r].as_py() or "").encode(), np.uint8)
                _, h, place, first, last = anchors(data, np.array([0, len(data)]))
                flagged = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in b.column("places")[r].as_py()]))
                keep = np.isin(place, flagged)
                if keep.any():
                    held.append((h[keep], b.column("first")[r].as_py(), t, place[keep], first[keep], last[keep], data))
                    n += len(data)
            if n >= 16 << 20:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        parts = _gathered(batches)
        if not parts:
            return
        h, doc, t, rel, first, last, length, data = parts
        copies = length == 0
        # A text that came from two tasks is taken once.
        order = np.lexsort((first, t, h, copies))
        again = np.zeros(len(h), bool)
        again[order[1:]] = (h[order][1:] == h[order][:-1]) & (t[order][1:] == t[order][:-1]) & (first[order][1:] == first[order][:-1]) & ~copies[order][1:]
        covered = [(t[copies], first[copies], last[copies])]
        base = np.concatenate(([0], np.cumsum(length)[:-1]))
        keep = np.flatnonzero(~copies & ~again)
        # Whole anchors at a time, about a million windows.
        keep = keep[np.argsort(h[keep], kind="stable")]
        windows = last[keep] - first[keep] + 1
        step = np.cumsum(windows) // 1_000_000
        ends = np.flatnonzero(np.r_[h[keep][1:] != h[keep][:-1], True]) if len(keep) else np.zeros(0, int)
        ends = ends[np.r_[step[ends][1:] != step[ends][:-1], True]] if len(ends) else ends
        left = []
        for a, z in zip(np.r_[0, ends[:-1] + 1], ends + 1):
            i = keep[a:z]
            count = last[i] - first[i] + 1
            who = np.repeat(i, count)
            j = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
            group = mix(h[who] + mix((rel[who] - j).astype(np.int64).view(np.uint64)))
            number = blind_classes(data, base[who] + j, group)
            order = np.lexsort((first[who] + j, t[who], doc[who], number))
            leads = np.r_[True, number[order][1:] != number[order][:-1]]
            late = order[~leads]
            covered.append((t[who[late]], first[who[late]] + j[late], first[who[late]] + j[late]))
            if len(often):
                lead = order[leads]
                lead = lead[often[np.minimum(np.searchsorted(often, h[who[lead]]), len(often) - 1)] == h[who[lead]]]
                if len(lead):
                    rows = sliding_window_view(data, LENGTH)[base[who[lead]] + j[lead]]
                    left.append((_digest(rows), doc[who[lead]], t[who[lead]], first[who[lead]] + j[lead]))
        yield from _runs(covered)
        for d, doc_, t_, p in left:
            batch = _blobs((d[:, 0] % _U(blocks)).astype(np.int64), blocks, lambda i: (d[i], doc_[i], t_[i], p[i]))
            data_ = [pickle.dumps((k, v)) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(data_), pa.int64()), pa.array(data_, pa.binary())], ["t", "places"])

    texts = docs.select("t", "text").mapInArrow(once, "t long, text string")
    rows = texts.join(flags, "t").join(firsts, "t").sortWithinPartitions("t")
    return rows.mapInArrow(send, "block int, data binary").repartitionById(blocks, "block").mapInArrow(receive, "t long, places binary")


def _digest(rows: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each row of bytes."""
    out = []
    for seed in (1, 2):
        weight = mix(np.arange(rows.shape[1], dtype=np.uint64) * _U(2 * seed + 1) + _U(seed)) | _U(1)
        total = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            total += mix(_BYTE[rows[:, k]] + _U(seed)) * weight[k]
        out.append(mix(total))
    return np.stack(out, 1)


def _runs(covered: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Adjoining windows joined, as rows of _by_text."""
    t, a, b = (np.concatenate(x) for x in zip(*covered))
    if not len(t):
        return
    order = np.lexsort((a, t))
    t, a, b = t[order], a[order], b[order]
    new = np.r_[True, (t[1:] != t[:-1]) | (a[1:] > b[:-1] + 1)]
    edge = np.flatnonzero(new)
    yield from _by_text(t[edge], a[edge], np.maximum.reduceat(b, edge))


def _rest(left: DataFrame, blocks: int) -> DataFrame:
    """(t, places) among the windows of frequent anchors that no task could settle alone."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [pickle.loads(x.as_py()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _gathered(batches)
        if parts:
            d, doc, t, p = parts
            order = np.lexsort((p, t, doc, d[:, 1], d[:, 0]))
            same = (d[order][1:] == d[order][:-1]).all(1)
            late = order[1:][same]
            yield from _runs([(t[late], p[late], p[late])])

    return left.select("places").mapInArrow(unpack, "block int, data binary").repartitionById(blocks, "block").mapInArrow(receive, "t long, places binary")


def spans(n_bytes: int, places: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the given runs of windows cover."""
    out: list[list[int]] = []
    if places:
        table = np.concatenate([np.frombuffer(x, np.int64) for x in places]).reshape(-1, 2)
        for a, b in table[np.argsort(table[:, 0], kind="stable")].tolist():
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b + LENGTH)
            else:
                out.append([a, b + LENGTH])
    return [(a, b) for a, b in out]


def _frequent(counts: DataFrame, least: int) -> np.ndarray:
    """The anchors above ``least`` and a millionth of all, in order; only those come to the driver."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(int(c[0]) for c in held if len(c) == 1)], pa.int64())], ["total"])

    total = counts.mapInArrow(summed, "total long").agg(F.sum("total")).first()[0] or 0
    bar = max(least, total // 1_000_000)

    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                c = np.frombuffer(x.as_buffer(), np.int64)
                if len(c) > 1:
                    anchor, count = c.reshape(2, -1)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[count > bar])], ["anchor"])

    return np.sort(np.asarray(counts.mapInArrow(above, "anchor long").toArrow()["anchor"]).astype(np.int64).view(np.uint64))


def removals(docs: DataFrame, columns: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """(columns, _n_bytes, _spans, _kept) of every row: the removed runs of bytes and what is left of the text's bytes,
    or with ``as_text`` of its whole characters.

    NULL text counts as empty and loses nothing, nor does any text shorter than ``LENGTH`` bytes. Of equal texts the one
    with the smallest doc_id (NULL last) counts as first; rows equal in doc_id and text are one document. Different texts under one
    doc_id are taken in order of their hash. ``columns`` are kept beside whatever their names, by default doc_id alone.
    """
    columns = columns or ["doc_id"]
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(columns)], "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    big = np.iinfo(np.int64).max
    ids = stored(d.select(F.col("doc_id").alias("id"), "t", F.octet_length(F.coalesce("text", F.lit(""))).alias("size")))
    firsts = ids.groupBy("t").agg(F.coalesce(F.min("id"), F.lit(big)).cast("long").alias("first"))

    found = stored(_repeated(d, blocks))
    flags = found.where("t IS NOT NULL").groupBy("t").agg(F.collect_list("places").alias("places"))
    frequent = _frequent(found.where("t IS NULL").select("places"), FREQUENT)

    runs = stored(_covered(d, flags, firsts, frequent, blocks))
    late = _rest(runs.where("t IS NULL"), blocks)
    runs = runs.where("t IS NOT NULL").union(late).groupBy("t").agg(F.collect_list("places").alias("places"))
    # Rows that are no first copy are covered whole; the first has the runs found.
    verdict = ids.distinct().join(firsts, "t").withColumn("copy", F.coalesce("id", F.lit(big)) > F.col("first"))
    verdict = stored(verdict.join(runs, "t", "left").select("id", F.col("t").alias("vt"), "copy", F.when(~F.col("copy"), F.col("places")).alias("places")))
    rows = d.join(verdict, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t") == F.col("vt")))
    rows = rows.select(*[f"c_{i}" for i in range(len(columns))], "text", "copy", "places")

    schema = ", ".join(f"c_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, kept = [], [], []
            for text, copy, places in zip(b.column("text"), b.column("copy").to_pylist(), b.column("places").to_pylist()):
                raw = (text.as_py() or "").encode()
                gone = ([(0, len(raw))] if len(raw) >= LENGTH else []) if copy else spans(len(raw), places)
                cuts = [0, *[x for pair in gone for x in pair], len(raw)]
                sizes.append(len(raw))
                removed.append([{"a": x, "b": y} for x, y in gone])
                left = [raw[x:y] for x, y in zip(cuts[::2], cuts[1::2])]
                kept.append("".join(x.decode("utf-8", "ignore") for x in left) if as_text else b"".join(left))
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(columns))], pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.string() if as_text else pa.binary())],
                [*[f"c_{i}" for i in range(len(columns))], "_n_bytes", "_spans", "_kept"])

    done = rows.mapInArrow(cut, f"{schema}, _n_bytes long, _spans array<struct<a:long,b:long>>, _kept {'string' if as_text else 'binary'}")
    return done.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(columns)], "_n_bytes", "_spans", "_kept")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    d = removals(docs)
    return d.select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), (F.col("_n_bytes") - F.octet_length("_kept")).cast("long").alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of each text, whole characters at a time, and n_chars to match; emptied rows go.

    A character goes if any of its bytes does. Rows whose text was empty before stay as they are.
    """
    d = removals(docs, [c for c in docs.columns if c != "text"], as_text=True).withColumnRenamed("_kept", "text")
    d = d.where((F.size("_spans") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return d.select(*docs.columns)
