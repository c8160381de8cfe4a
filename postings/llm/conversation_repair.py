"""Repair of a conversation's structure with the cheapest audit of edits, found by a persistent dynamic program.

The roles of a repaired conversation are an optional system turn, then pairs of user and assistant, or nothing. Four states
say how far such a sequence has come; a turn is kept, given another role or deleted, and empty turns are inserted.

Per state only the cheapest audit is held, and of equally cheap ones the least. Audits are linked nodes that share
their prefixes: a node has its last edit, its ancestors 1, 2, 4, ... steps back, and a rolling hash of the whole audit. Two
audits of equal cost are compared at the end of their longest common prefix, which a binary search over the
ancestors' hashes finds. An audit determines the states it passes, so equal audits are one node: a prefix that
hashes claim equal and that is not one node is a collision, and is settled by the letters themselves.

A conversation streams through one task in the order of its turns. What is undecided is held as nodes; what all states
agree on is written off as plain letters, so memory is a byte per turn, the undecided part, and a digest per distinct turn.
Texts are only held one at a time. The turns of one conversation are edited in sequence by their nature, so they go to one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.sources.warehouse import stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"

#: What follows in each state: nothing yet, after the system turn, after a user turn, after a whole pair.
START, SYSTEM, USER, PAIR = range(4)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": PAIR}, PAIR: {"u": USER}}
ROLE = {USER: "user", PAIR: "assistant"}
LEGAL = {"su", "ua", "au"}

_MOD, _BASE = (1 << 61) - 1, 1_000_003
#: Nodes held before the part that all states share is written off.
NODES = 20_000


class Audits:
    """Audits as a tree of edits; node 0 is the empty one, or all that was written off."""

    def __init__(self, base: int = _BASE) -> None:
        self.base, self.written = base, bytearray()
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, edit: str) -> int:
        node, up, k = len(self.edit), [parent], 0
        # The ancestor 2^(k+1) back is the one 2^k back of the one 2^k back.
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(edit)) % _MOD)
        self.up.append(up)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor at ``depth``."""
        for k in reversed(range(len(self.up[node]))):
            if k < len(self.up[node]) and self.depth[node] - (1 << k) >= depth:
                node = self.up[node][k]
        return node

    def less(self, x: int, y: int) -> bool:
        """Whether the audit at ``x`` comes before the one at ``y``; one that goes on comes later than its prefix."""
        if x == y:
            return False
        depth = min(self.depth[x], self.depth[y])
        a, b = self.lifted(x, depth), self.lifted(y, depth)
        if self.hash[a] == self.hash[b]:
            return self.depth[x] < self.depth[y] if a == b else self.letters(x) < self.letters(y)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.up[a][0] != self.up[b][0]:
            return self.letters(x) < self.letters(y)
        return self.edit[a] < self.edit[b]

    def letters(self, node: int) -> str:
        """The audit since what was written off, letter by letter."""
        found = []
        while node:
            found.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(found))

    def whole(self, node: int) -> str:
        return self.written.decode() + self.letters(node)

    def settle(self, live: list[int]) -> list[int]:
        """Write off what the ``live`` audits share, forget what none of them needs, and return their new numbers."""
        shared = live[0]
        for node in live[1:]:
            depth = min(self.depth[shared], self.depth[node])
            a, b = self.lifted(shared, depth), self.lifted(node, depth)
            for k in reversed(range(len(self.up[a]))):
                if k < len(self.up[a]) and self.up[a][k] != self.up[b][k]:
                    a, b = self.up[a][k], self.up[b][k]
            shared = a if a == b else self.up[a][0]
        kept = Audits(self.base)
        kept.written = self.written + self.letters(shared).encode()
        number = {shared: 0}
        for node in live:
            path = []
            while node not in number:
                path.append(node)
                node = self.up[node][0]
            for n in reversed(path):
                number[n] = kept.add(number[self.up[n][0]], self.edit[n])
        self.__dict__.update(kept.__dict__)
        return [number[n] for n in live]


class Repair:
    """The cheapest audit of one conversation, turn by turn: per state its cost and node."""

    def __init__(self, audits: Audits | None = None) -> None:
        self.audits = audits or Audits()
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.most = NODES
        self._insert()

    def turn(self, initial: str, fault: str | None) -> None:
        """Go on with a turn by the initial of its role and its fault."""
        ways: dict[int, list[tuple[int, int, str]]] = {}
        for state, (cost, node) in self.best.items():
            ways.setdefault(state, []).append((cost + COST[DELETE], node, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            stays = cost + (TRUNCATED_COST if fault == CUT else 0)
            if initial in NEXT[state]:
                ways.setdefault(NEXT[state][initial], []).append((stays + COST[KEEP], node, KEEP))
            for other in ROLE:
                if other in NEXT[state].values():
                    ways.setdefault(other, []).append((stays + COST[REROLE], node, REROLE))
        self.best = {state: self._least(found) for state, found in ways.items()}
        self._insert()
        # Whatever follows, a whole pair does as well as these do, but for a system turn that it has to delete.
        for state, more in ((START, COST[DELETE]), (SYSTEM, 0)):
            if state in self.best and self.best[state][0] > self.best[PAIR][0] + more:
                del self.best[state]
        if len(self.audits.edit) > self.most:
            states = list(self.best)
            nodes = self.audits.settle([self.best[s][1] for s in states])
            self.best = {s: (self.best[s][0], n) for s, n in zip(states, nodes)}
            self.most = max(NODES, 2 * len(self.audits.edit))

    def _insert(self) -> None:
        """Empty turns between two turns: a user turn, then an assistant one; a third would come back to the same state dearer."""
        for state in (USER, PAIR):
            ways = [(self.best[s][0] + COST[INSERT], self.best[s][1], INSERT) for s in self.best if state in NEXT[s].values()]
            if not ways:
                continue
            least = min(w[0] for w in ways)
            if state not in self.best or least < self.best[state][0]:
                self.best[state] = self._least(ways)
            elif least == self.best[state][0]:
                cost, node = self._least(ways)
                if self.audits.less(node, self.best[state][1]):
                    self.best[state] = (cost, node)

    def _least(self, ways: list[tuple[int, int, str]]) -> tuple[int, int]:
        cost = min(w[0] for w in ways)
        first = None
        for _, node, edit in [w for w in ways if w[0] == cost]:
            node = self.audits.add(node, edit)
            if first is None or self.audits.less(node, first):
                first = node
        return cost, first

    def result(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        ends = [self.best[s] for s in (START, PAIR) if s in self.best]
        cost = min(c for c, _ in ends)
        first = None
        for _, node in [e for e in ends if e[0] == cost]:
            if first is None or self.audits.less(node, first):
                first = node
        return cost, self.audits.whole(first)


# --- the turns as Spark rows ---------------------------------------------------------------------

def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of all rows; a NULL role or text is one space."""
    return rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damaged(rows: DataFrame) -> DataFrame:
    """The rows as a fixed damage leaves them, chosen by the crc32 of ``conv_id:turn`` (NULL: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 gives it the role user.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = turns(rows).withColumn("hit", F.crc32(F.concat(text[0], F.lit(":"), text[1])) % 20).where("hit <> 0")
    changed = hit.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return changed.drop("again")


def _blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))


def _ends(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Conversations in whole, one after the other, by turn (NULL first); turns of one number by role and text."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


_SUMMARY = "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of :func:`turns`.

    A turn's first fault counts: blank, a role and text seen before, or a text that does not end a sentence. ``gaps`` are
    the numbers that lack between the least and the largest turn; ``illegal`` the neighbours whose roles may not follow
    each other. A role that starts with another letter than s, u or a, or is empty, can only be changed or deleted. Rows
    without a ``conv_id`` are one conversation. No rows give no conversations.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    marked = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", _blank(F.col("text")).alias("blank"), _ends(F.col("text")).alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        done: list[tuple] = []

        def close() -> None:
            if now is None:
                return
            conv, repair, _, found, numbers, _ = now
            low, high, distinct, _ = numbers
            done.append((conv, high - low + 1 - distinct if distinct else 0, *found.values(), *repair.result()))

        def out(id_type: pa.DataType) -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 6, pa.string()]
            names = ["conv_id", "gaps", BLANK, DUPLICATE, CUT, "illegal", "cost", "audit"]
            columns = list(zip(*done)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for b in batches:
            for conv, turn, role, text, blank, ends in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or conv != now[0]:
                    close()
                    now = [conv, Repair(), set(), {BLANK: 0, DUPLICATE: 0, CUT: 0, "illegal": 0}, [0, 0, 0, None], None]
                _, repair, seen, found, numbers, before = now
                digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
                fault = BLANK if blank else DUPLICATE if digest in seen else None if ends else CUT
                seen.add(digest)
                if fault:
                    found[fault] += 1
                initial = role[:1]
                if before is not None and before + initial not in LEGAL:
                    found["illegal"] += 1
                now[5] = initial
                if turn is not None and turn != numbers[3]:
                    now[4] = [numbers[0] if numbers[2] else turn, turn, numbers[2] + 1, turn]
                repair.turn(initial, fault)
            yield out(b.schema.field("conv_id").type)
            done = []
        if now is not None:
            close()
            yield out(b.schema.field("conv_id").type)

    return _in_order(marked).mapInArrow(run, _SUMMARY.format(kind))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the turns that are left after the edits of ``found``, in order within each task.

    A conversation's audit comes first in its task, then its turns stream past it.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))]
    d = found.select("conv_id", F.lit(0).alias("part"), "audit", *empty).union(
        rows.select("conv_id", F.lit(1), F.lit(None).cast("string"), F.col("turn").cast("long"), "role", "text"))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, at, place, state, done = None, "", 0, 0, START, []

        def put(edit: str, role: str, text: str, to: int) -> None:
            nonlocal place, state
            state = to
            done.append((now, place, edit, role, text))
            place += 1

        def insert() -> None:
            nonlocal at
            while audit[at:at + 1] == INSERT:
                to = PAIR if state == USER else USER
                put(INSERT, ROLE[to], "", to)
                at += 1

        for b in batches:
            for conv, part, letters, _, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if part == 0:
                    now, audit, at, place, state = conv, letters, 0, 0, START
                else:
                    edit = audit[at]
                    at += 1
                    if edit == KEEP:
                        put(edit, role, text, NEXT[state][role[:1]])
                    elif edit == REROLE:
                        to = PAIR if state == USER else USER
                        put(edit, ROLE[to], text, to)
                insert()
            types = [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = list(zip(*done)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "place", "edit", "role", "text"])
            done = []

    return d.mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 over ``role:text`` of each conversation's turns, joined by line ends, as they stream by."""
    kind = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for b in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                line = f"{role}:{text}".encode()
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((b.schema.field("conv_id").type, pa.string()))], ["conv_id", "repaired_sha256"])
            done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], b.schema.field("conv_id").type), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    return messages.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """The repair of every conversation after :func:`damaged`, one row per ``conv_id`` (NULL is one of them).

    A conversation that lost all its rows has zeros, an empty audit and the digest of nothing. Ties, repeated rows and NULLs are
    as in :func:`audits`; columns beyond the four are not read.
    """
    rows = stored(damaged(conversations))
    found = stored(audits(rows))
    hashed = digests(repaired(rows, found))
    names = [c for c in found.columns if c != "conv_id"]
    all_ids = conversations.select("conv_id").distinct()
    result = all_ids
    for part in (found, hashed):
        right = part.withColumnRenamed("conv_id", "other")
        result = result.join(right, result["conv_id"].eqNullSafe(right["other"]), "left").drop("other")
    return result.select(
        "conv_id", *[F.coalesce(c, F.lit("") if c == "audit" else F.lit(0).cast("long")).alias(c) for c in names],
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
