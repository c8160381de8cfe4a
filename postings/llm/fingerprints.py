"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line; a longer one is cut after a sentence end that comes 200
characters or more after the last cut. Its 64-bit digest goes to one cell in each third of the sketch; a cell
holds a count, the exclusive or of its digests, and of their check sums. Two
sketches of one size subtract cell by cell, which leaves the digests that only
one version has. A cell with one digest left gives it away; taking it out of its
other cells frees more, until all are recovered or none is left alone. Then the
sketches are made four times as large. All of it is SQL functions over arrays in the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAGRAPH = r"[^\n]{200,}?[.!?](?=\s)|[^\n]+"
#: Cells per third of a sketch, tried in this order; beyond, the digests are compared as sets.
THIRDS = (16, 64, 256, 1024, 4096, 16384)
ROUNDS = 40
BLOCK_BYTES = 8 << 20
MOST_BLOCKS = 1_000_000

_CELL = "struct<i:int,n:int,k:bigint,c:bigint>"
_EMPTY = "named_struct('i', -1, 'n', 0, 'k', 0L, 'c', 0L)"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text; NULL has none."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _zero(cell: str) -> str:
    return f"({cell}.n = 0 and {cell}.k = 0 and {cell}.c = 0)"


def _folded(entries: str) -> str:
    """Entries of the same cell added up; empty cells go."""
    return f"""aggregate(sort_array({entries}),
        named_struct('done', cast(array() as array<{_CELL}>), 'cur', {_EMPTY}),
        (s, x) -> if(s.cur.i = x.i,
            named_struct('done', s.done, 'cur', named_struct('i', x.i, 'n', s.cur.n + x.n, 'k', s.cur.k ^ x.k, 'c', s.cur.c ^ x.c)),
            named_struct('done', if({_zero('s.cur')}, s.done, array_append(s.done, s.cur)), 'cur', x)),
        s -> if({_zero('s.cur')}, s.done, array_append(s.done, s.cur)))"""


def _entries(keys: str, sign: str, third: str) -> str:
    """A digest's entry in each third of the sketch."""
    cells = ", ".join(
        f"named_struct('i', {j} * {third} + cast(pmod(xxhash64(k, {j}), {third}) as int), 'n', {sign}, 'k', k, 'c', xxhash64(k, 7))" for j in range(3))
    return f"flatten(transform({keys}, k -> array({cells})))"


def sketch(keys: str, third: int = THIRDS[0]) -> Column:
    """The cells in use, in order, of a column of digests."""
    return F.expr(_folded(_entries(keys, "1", f"{third}")))


def printed(cells: str, keys: str) -> Column:
    """A sketch as text: the number of digests, then index, count and digest sum of each cell in use."""
    return F.expr(f"concat(size({keys}), ':', array_join(transform({cells}, x -> concat(x.i, '.', x.n, '.', lower(hex(x.k)))), ' '))")


def difference(a: str, b: str) -> Column:
    """How many digests only one of two columns of digests has, recovered from their sketches."""
    alone = "filter(s.cells, x -> abs(x.n) = 1 and x.c = xxhash64(x.k, 7))"
    # A digest alone in several cells is taken once; its own sign leaves the other cells.
    taken = f"array_distinct(transform({alone}, x -> named_struct('k', x.k, 'n', x.n)))"
    cells = ", ".join(
        f"named_struct('i', {j} * third + cast(pmod(xxhash64(t.k, {j}), third) as int), 'n', -t.n, 'k', t.k, 'c', xxhash64(t.k, 7))" for j in range(3))
    step = f"""transform(array({taken}), ts -> named_struct(
        'cells', if(size(ts) = 0, s.cells, {_folded(f"concat(s.cells, flatten(transform(ts, t -> array({cells}))))")}),
        'found', s.found + size(ts), 'going', size(ts) > 0))[0]"""
    peel = f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('cells', {_folded(f"concat({_entries(a, '1', 'third')}, {_entries(b, '-1', 'third')})")}, 'found', 0, 'going', true),
        (s, r) -> if(s.going and size(s.cells) > 0, {step}, s),
        s -> if(size(s.cells) = 0, s.found, -1))"""
    tries = f"aggregate(array({', '.join(map(str, THIRDS))}), -1, (d, third) -> if(d >= 0, d, {peel}))"
    plain = f"size(array_except({a}, {b})) + size(array_except({b}, {a}))"
    return F.expr(f"transform(array({tries}), d -> if(d >= 0, d, {plain}))[0]")


def likeness(a: str, b: str) -> Column:
    """Digests in both over digests in either; two texts without any are alike."""
    both = f"(size({a}) + size({b}))"
    d = difference(a, b)
    return F.when(F.expr(f"{both} = 0"), F.lit(1.0)).otherwise((F.expr(both) - d) / (F.expr(both) + d))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, keys, next): every row with the text and digests of the next one in descending doc_id, the first after the last.

    Rows go to blocks of consecutive ids, so each text is moved once; a block's last row gets its next from one row of
    the block below, sent along with it. Equal ids follow each other by text, NULL ids come last.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = d.agg(F.sum(F.octet_length("text")), F.count("doc_id")).first()
    wanted = max(-(-(size[0] or 0) // BLOCK_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = int(max(1, min(wanted, MOST_BLOCKS, size[1])))
    shares = [k / wanted for k in range(1, wanted)] or [0.5]
    edges = sorted(set(d.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * wanted))).first()[0] or []))
    # The number of edges not above the id, by halving.
    steps = [1 << k for k in reversed(range(len(edges).bit_length()))] or [1]
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, s: F.when(
        (n + s <= len(edges)) & (F.element_at(F.col("edges"), F.least(n + s, F.lit(max(len(edges), 1)))) <= F.col("doc_id")), n + s).otherwise(n))
    block = F.when(F.col("doc_id").isNull(), -1).otherwise(below).cast("int")
    d = d.withColumn("edges", F.array(*map(F.lit, edges or [0]))).withColumn("block", block).drop("edges")

    order = Window.orderBy(F.col("block").desc())
    tops = d.groupBy("block").agg(F.max("doc_id").alias("top"))
    # One row per block passes one task: the block above receives a block's first row, and the lowest the first of all.
    lowest = F.min("block").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.withColumn("to", F.coalesce(F.lag("block").over(order), lowest)).withColumnRenamed("block", "from")
    heads = d.join(F.broadcast(tops), (F.col("block") == F.col("from")) & F.col("doc_id").eqNullSafe(F.col("top")))
    heads = heads.groupBy(F.col("to").alias("block")).agg(F.min("text").alias("text"))
    rows = d.select("block", F.lit(0).alias("sent"), "doc_id", "text").union(heads.select("block", F.lit(1), F.lit(None).cast(d.schema["doc_id"].dataType), "text"))
    rows = rows.withColumn("keys", digests(F.col("text")))
    along = Window.partitionBy("block").orderBy("sent", F.col("doc_id").desc_nulls_last(), "text")
    return rows.withColumn("next", F.lead(F.struct("text", "keys")).over(along)).where("sent = 0").drop("block", "sent")


def compare(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    The edited text has the last half of the characters replaced by as many from the start of the next text. NULL text
    counts as empty; repeated rows are rows of their own; a single row is its own next. Other columns are ignored.
    """
    d = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next.text"), F.lit(1), half))
    d = d.withColumn("edited", edited).withColumns({"edited_keys": digests(F.col("edited")), "next_keys": F.col("next.keys")})
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "keys", "edited_keys", "next_keys")
    d = d.withColumns({"cells": sketch("keys"), "edited_cells": sketch("edited_keys")})
    return d.select(
        "doc_id", "n_chars", "edited_sha256", printed("cells", "keys").alias("fingerprint"), printed("edited_cells", "edited_keys").alias("edited_fingerprint"),
        likeness("keys", "edited_keys").alias("near_edited"), likeness("keys", "next_keys").alias("near_next"))
