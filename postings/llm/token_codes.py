"""Token ids as directly addressable codes: any token is read without decoding its block.

An id is cut into chunks of the given bit widths, low chunk first. Level k holds
the k-th chunk of every id that has one, and a bitmap that says which of them go
on; the rank of a set bit is the id's place in the next level, found through a
directory of counts per 512 bits. A file row is one block of whole documents, in
ascending id order over all blocks; its image is

    b"DAC1", u8 number of levels, u8 width of each, then per level
    u64 count, the chunks, the bitmap (little bit order), u32 ones before each 512 bits

Blocks are rows of Parquet files, written and read by Spark alone, so any store that Spark reaches will do.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WIDTHS = (8, 8, 16)
END_ID = 0
BLOCK_IDS = 1 << 20
KEPT_WORDS = 600_000
_DIRECTORY = 512


def pack(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The image of a sequence of ids below 2**sum(widths)."""
    parts = [b"DAC1", bytes([len(widths), *widths])]
    rest = ids.astype(np.uint64)
    if len(rest) and int(rest.max()) >> sum(widths):
        raise ValueError("an id needs more bits than the levels have")
    for w in widths:
        higher = rest >> np.uint64(w)
        more = higher != 0
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), _DIRECTORY)) if len(more) else np.zeros(0, int)
        ahead = np.concatenate(([0], np.cumsum(ones)))[:len(ones)].astype("<u4")
        parts += [np.uint64(len(rest)).tobytes(), (rest & np.uint64((1 << w) - 1)).astype(_kind(w)).tobytes(), bits.tobytes(), ahead.tobytes()]
        rest = higher[more]
    return b"".join(parts)


def _kind(width: int) -> str:
    return "<u1" if width <= 8 else "<u2" if width <= 16 else "<u4"


class Codes:
    """Random access to an image; nothing is decoded but what is asked for."""

    def __init__(self, image: bytes):
        if image[:4] != b"DAC1":
            raise ValueError("not a code image")
        self.widths = tuple(image[5:5 + image[4]])
        self.levels, at = [], 5 + image[4]
        for w in self.widths:
            n = int(np.frombuffer(image, "<u8", 1, at)[0])
            at += 8
            parts = []
            for kind, count in ((_kind(w), n), ("<u1", -(-n // 8)), ("<u4", -(-n // _DIRECTORY))):
                parts.append(np.frombuffer(image, kind, count, at))
                at += parts[-1].nbytes
            self.levels.append(parts)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place i."""
        chunks, bits, ahead = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][0])
        block = i // _DIRECTORY
        first = block * _DIRECTORY // 8
        inside = np.unpackbits(bits[first:i // 8 + 1], bitorder="little")[:i - block * _DIRECTORY]
        return int(ahead[block]) + int(inside.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for level, w in enumerate(self.widths):
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(level, i), shift + w
        return value

    def between(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b, b excluded."""
        out = np.zeros(b - a, np.uint32)
        at, shift = np.arange(b - a), 0
        for level, w in enumerate(self.widths):
            chunks, bits, _ = self.levels[level]
            out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(shift)
            first = a // 8
            more = np.unpackbits(bits[first:-(-b // 8)], bitorder="little")[a - first * 8:b - first * 8].astype(bool)
            at = at[more]
            if not len(at):
                break
            a = self._rank(level, a)
            b, shift = a + len(at), shift + w
        return out


# The byte alphabet of byte-level pair encoding: printable bytes stand for themselves, the others follow from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: b for b in _PLAIN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
#: White space other than the space and the line end.
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_CUT = re.compile(r"(?<=\S)(?= \S)")
_MARKS = frozenset(".,!?;:")


class _Words(dict):
    """Ids, as bytes, of words after a given lead; a bounded memory of two generations before the tokenizer is asked."""

    def __init__(self, tokenizer: Tokenizer, lead: str):
        self.tokenizer, self.lead, self.older = tokenizer, lead, {}
        self.marks = {m: _whole(tokenizer, m) for m in _MARKS}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha():
                spelt = (self.lead + word).encode().decode("latin-1").translate(_ALPHABET)
                ids = _bytes([t.id for t in self.tokenizer.model.tokenize(spelt)])
            elif len(word) > 1 and word[-1] in _MARKS and word[:-1].isalpha():
                # Letters and one mark are separate for the tokenizer; with the mark only words met before are kept.
                known = word[:-1] in self
                ids = self[word[:-1]] + self.marks[word[-1]]
                if not known:
                    return ids
            else:
                ids = _whole(self.tokenizer, self.lead + word)
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


def _whole(tokenizer: Tokenizer, text: str) -> bytes:
    return _bytes(tokenizer.encode(text, add_special_tokens=False).ids)


def _bytes(ids: list[int]) -> bytes:
    """Little-endian, four bytes each."""
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class Encoder:
    """Ids of whole texts, equal to the tokenizer's own, from its ids of the words.

    A byte-level tokenizer cuts a text before each space that stands between two
    other marks, and on both sides of such a line end; ids on the two sides do
    not depend on each other. So the words of a text are encoded alone and kept,
    and texts with other white space are cut only where that is safe. Texts that
    hold an added token go to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.first, self.later = _Words(self.tokenizer, ""), _Words(self.tokenizer, " ")
        self.line_end = _whole(self.tokenizer, "\n")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return _whole(self.tokenizer, text)
        if any(c in text for c in _ODD):
            return self._safely(text)
        lines = []
        for line in text.split("\n"):
            words = line.split(" ")
            if "" in words:  # white space next to white space, or at an end
                return self._safely(text)
            lines.append(self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:])))
        return self.line_end.join(lines)

    def _safely(self, text: str) -> bytes:
        return b"".join(_whole(self.tokenizer, x) for x in _CUT.split(text)) if text else b""


@cache
def encoder(path: str) -> Encoder:
    """One per worker process, kept from task to task."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, block_ids: int = BLOCK_IDS, end_id: int = END_ID) -> DataFrame:
    """Blocks (shard, seq, doc_ids, lengths, codes) of all ids in ascending doc_id order, a shard per range of doc_id.

    A NULL text counts as empty and has the end id alone; a NULL doc_id comes first; equal doc_ids follow each other in
    text order. A text longer than a block is a block of its own. Other columns are ignored. No rows give no blocks.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, shard, seq = encoder(path), TaskContext.get().partitionId(), 0
        ids, coded, held, id_type = [], [], 0, None

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids], pa.list_(id_type)),
                pa.array([[len(x) // 4 for x in coded]], pa.list_(pa.int64())),
                pa.array([pack(np.frombuffer(b"".join(coded), "<u4"))], pa.binary()),
            ], ["shard", "seq", "doc_ids", "lengths", "codes"])

        for b in batches:
            id_type = b.schema.field(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                x = encoding.encode(text.as_py() or "") + end
                if ids and held + len(x) // 4 > block_ids:
                    yield block()
                    ids, coded, held, seq = [], [], 0, seq + 1
                ids.append(doc)
                coded.append(x)
                held += len(x) // 4
        if ids:
            yield block()

    rows = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInArrow(run, f"shard int, seq int, doc_ids array<{kind}>, lengths array<long>, codes binary")


def decode(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in blocks read back; ``start`` counts the ids of all blocks before."""
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                shard, seq, ids, lengths = (b.column(c)[r] for c in ("shard", "seq", "doc_ids", "lengths"))
                codes, counts = Codes(b.column("codes")[r].as_py()), np.asarray(lengths.values, np.int64)
                cuts = np.concatenate(([0], np.cumsum(counts)))
                sums = [zlib.crc32(codes.between(int(x), int(y)).astype("<u4").tobytes()) for x, y in zip(cuts[:-1], cuts[1:])]
                n = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), ids.values,
                    pa.array(cuts[:-1]), pa.array(counts), pa.array(sums, pa.int64()),
                ], ["shard", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = blocks.mapInArrow(run, f"shard int, seq int, doc_id {kind}, inside long, n_tokens long, ids_crc32 long")
    held = blocks.select("shard", "seq", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("held"))
    # Two steps: one row per shard passes a single task, blocks are summed inside their shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = held.groupBy("shard").agg(F.sum("held").alias("held")).select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("ahead", F.coalesce(F.sum("held").over(inside), F.lit(0))).join(shards, "shard").select("shard", "seq", (F.col("ahead") + F.col("shift")).alias("shift"))
    return rows.join(starts, ["shard", "seq"]).select("doc_id", (F.col("shift") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
