"""Mixing sources to target weights, cut at each source's exact budget of words.

Every document gets a hash-random key. The rows are sorted by range over
(source, key), so a source that holds a third of all rows spreads over many
tasks; running sums are taken inside each range and shifted by the totals of the
ranges before it. A source whose budget exceeds its size repeats in epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.sources.warehouse import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """Each source's target: weight times one water level, at most ``most`` times its size.

    ``sizes`` has (no_source, source_key, source_size). Sources in code-point
    order, NULL last, take ``weights`` in turn. Sources that reach their bound
    are those with the lowest bound per weight, so one sort finds the level:
    what the bounded ones leave, by weight, among the rest. Sums stay whole
    numbers until the last division. One row per source passes one task.
    """
    up, down = share
    order = Window.orderBy("no_source", "source_key")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "no_source", "source_key")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    d = (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        .withColumn("open", F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    left = F.col("total") * up - F.col("full") * down
    bounded = F.col("weight") * left >= F.col("source_size") * most * down * F.col("open")
    d = d.withColumn("bounded", bounded)
    level = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.min(F.when(~F.col("bounded"), F.struct(F.col("full"), F.col("open")))).over(level)
    level_full, level_open = first["full"], first["open"]
    target = F.when(F.col("bounded"), (F.col("source_size") * most).cast("double")).otherwise(
        (F.col("weight") * (F.col("total") * up - level_full * down)).cast("double") / (level_open * down).cast("double")
    )
    return d.select("no_source", "source_key", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, **plan) -> DataFrame:
    """(id, size, source_size, target, taken) of every row; ``taken`` is in words, repeats counted.

    ``taken`` is the whole epochs times the size plus the row's part of the last
    epoch; the row at the cut gives only the words still wanted, so a source's
    taken words equal its target rounded down. Keys are hashes of the id and ties
    go by id and size, so reruns agree; repeated equal rows are interchangeable.
    NULL or empty text has size 0 and gives nothing; NULL source is a source of
    its own, last in order; a NULL id is an ordinary key. Empty input: no rows.
    ``row_col`` names a column that tells the rows apart: it comes back as
    ``row``, and rows of one id are in order of their texts' hash, then by it.
    """
    rows = [] if row_col is None else ["text_hash", "row"]
    # The text is read once; what follows moves a few numbers per row.
    base = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source_key"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
        *([F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(row_col).alias("row")] if rows else []),
    ))
    by_source = targets(base.groupBy("no_source", "source_key").agg(F.sum("size").alias("source_size")), **plan)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["no_source", "source_key", "key", "doc_id", "size", *rows]
    ranged = stored(base.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    spans = ranged.groupBy("no_source", "source_key", "range").agg(F.sum("size").alias("span"))
    ahead = Window.partitionBy("no_source", "source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        spans.withColumn("shift", F.coalesce(F.sum("span").over(ahead), F.lit(0)))
        .join(by_source, ["no_source", "source_key"])
        .drop("span")
    )
    inside = Window.partitionBy("no_source", "source_key", "range").orderBy("key", "doc_id", "size", *rows).rowsBetween(Window.unboundedPreceding, -1)
    d = (
        ranged.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(shifts, ["no_source", "source_key", "range"])
        .withColumn("before", F.col("before") + F.col("shift"))
    )
    budget = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("before"), F.col("size")), F.lit(0))
    return d.select(
        "doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"),
        epochs.alias("epochs"), "no_source", "source_key", *rows[1:],
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: whole epochs repeat a row, the row at the cut keeps its first words.

    A text cut short ends right after its last word taken. Ids may repeat or be NULL: rows are matched to their share by a
    number of their own, written once. Rows without words are in no mix.
    """
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    shares = mix(numbered, row_col="_row").where("taken > 0").select(F.col("row").alias("_row"), F.col("size").alias("_size"), F.col("taken").alias("_taken"))
    rows = numbered.join(shares, "_row")
    words = F.least(F.col("_size"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_size"))
    cut = words < F.col("_size")
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    out = rows.withColumn("_copy", F.explode(F.expr("sequence(1, cast((_taken + _size - 1) div _size as int))")))
    columns = {"text": F.when(cut, head).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(cut, F.length(head).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])
