"""Deduplication on a natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens import session

#: A key is heavy when it holds at least this share of all rows: there are at most as many heavy keys.
HEAVY = 1024
#: Bits of a row number inside a bitmap, and words of 64 bits that hold them.
_BLOCK, _WORDS = 15, 512
#: Bytes of bitmaps that are broadcast at most (those of 500 million rows).
BITMAP_BYTES = 64 << 20
#: Numbers of rows up to which they are broadcast as they are.
FEW = 1 << 20


def heavy_hashes(narrow: DataFrame, rows: int) -> DataFrame | None:
    """(_h): ``_h`` of the at most HEAVY keys that hold at least 1 in HEAVY of the ``rows`` rows; None if there are none.

    A bounded summary of frequent values names every such hash and a few others, which are counted out.
    """
    named = narrow.stat.freqItems(["_h"], 0.5 / HEAVY).first()[0]
    if not named:
        return None
    named = F.broadcast(narrow.sparkSession.createDataFrame([(h,) for h in named], "_h long"))
    counted = narrow.select("_h").join(named, "_h", "left_semi").groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    heavy = [(r["_h"],) for r in counted.where(F.col("_n") * HEAVY >= F.lit(rows)).collect()]
    return narrow.sparkSession.createDataFrame(heavy, "_h long") if heavy else None


def first_rows(copies: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(_row) of the first of each key's rows by ``order``, then ``_tie``, aggregated before the shuffle."""
    packed = F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], "_tie", "_row")
    return copies.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(packed).alias("_first")).select(F.col("_first._row").alias("_row"))


def _later_copies(narrow: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """(_row) of every row of ``narrow`` that is not the first of its key: one exchange of (key, first order column, row number).

    That column alone settles most keys. Rows that share a key's first place by it, and they only, are settled by all order
    columns and the tie hash in a second exchange. Rows of heavy keys are kept out of both; their first rows, one a key, are an
    aggregate and come back by broadcast.
    """
    heavy = heavy_hashes(narrow, rows)
    light = narrow if heavy is None else narrow.join(F.broadcast(heavy), "_h", "left_anti")
    by_key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    one = by_key.orderBy(F.col(f"`{order[0]}`").asc_nulls_first())  # rows that tie are peers: same rank, counted together
    found = light.withColumns({"_place": F.rank().over(one), "_peers": F.count(F.lit(1)).over(one)}) \
        .where("_place > 1 OR _peers > 1").select("_row", (F.col("_place") == 1).alias("_tied"))
    if heavy is not None:
        hot = narrow.join(F.broadcast(heavy), "_h", "left_semi")
        # few keys share 64 bits with a heavy one, so these are hardly more than HEAVY rows; without a hint Spark sees their size
        found = found.unionByName(hot.select("_row").join(first_rows(hot, keys, order), "_row", "left_anti").withColumn("_tied", F.lit(False)))
    found = session.materialize(found, "later_copies")
    later, tied = [found.where(c).select("_row") for c in ("NOT _tied", "_tied")]
    if tied.isEmpty():
        return later
    every = by_key.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order], "_tie", "_row")
    settled = with_rows(narrow, tied).withColumn("_place", F.row_number().over(every)).where("_place > 1").select("_row")
    return later.unionByName(session.materialize(settled, "later_ties"))


def _bitmaps(rows: DataFrame) -> DataFrame:
    """(_block, _bits): the row numbers as bits, a row of 4 KB for each 32,768 consecutive numbers that hold any."""
    at = F.col("_row")
    words = rows.groupBy(F.shiftright(at, _BLOCK).alias("_block"), F.shiftright(at, 6).bitwiseAND(_WORDS - 1).cast("int").alias("_word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_row & 63 AS INT))")).alias("_set"))
    held = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_set"))).alias("_held"))
    return held.select("_block", F.expr(f"transform(sequence(0, {_WORDS - 1}), i -> coalesce(_held[i], 0L))").alias("_bits"))


def _numbered(base: DataFrame, rows: DataFrame, how: str, bitmap_bytes: int, few: int) -> DataFrame:
    """``base`` joined with the row numbers ``rows`` (left_semi, left_anti).

    Few numbers are broadcast as they are. More are told by a broadcast of bitmaps, an eighth of a byte a row of ``base``, so
    ``base`` is not shuffled. Where those would pass ``bitmap_bytes``, the join is shuffled and its result written once.
    """
    if rows.count() <= few:  # a hint, since their table may hold other rows and look larger
        return base.join(F.broadcast(rows), "_row", how)
    bits = session.materialize(_bitmaps(rows), "row_bits")
    if bits.count() * _WORDS * 8 > bitmap_bytes:
        return session.materialize(base.join(rows, "_row", how), "numbered_rows")
    at = base["_row"]
    marked = F.expr(f"getbit(_bits[CAST(shiftright(_row, 6) & {_WORDS - 1} AS INT)], CAST(_row & 63 AS INT)) = 1")
    return base.join(F.broadcast(bits), (F.shiftright(at, _BLOCK) == bits["_block"]) & marked, how)


def without_rows(base: DataFrame, rows: DataFrame, bitmap_bytes: int = BITMAP_BYTES, few: int = FEW) -> DataFrame:
    """``base`` (a written table with a unique ``_row``) without the rows whose numbers the written table ``rows`` holds."""
    return _numbered(base, rows, "left_anti", bitmap_bytes, few)


def with_rows(base: DataFrame, rows: DataFrame, bitmap_bytes: int = BITMAP_BYTES, few: int = FEW) -> DataFrame:
    """The rows of ``base`` (a written table with a unique ``_row``) whose numbers the written table ``rows`` holds."""
    return _numbered(base, rows, "left_semi", bitmap_bytes, few)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                     drop_order_cols: bool = False) -> DataFrame:
    """One row per key: the first by ``order_cols`` ascending (NULLs first).

    A distributed table has no file order, so every source declares the
    columns that stand for it; they are required. Rows that tie on all of them
    are settled by a hash of the remaining columns, so the result never depends
    on the partitioning. NULL keys are one key.

    The payload of a row is written once, with a row number, and fetched only for rows that stay: everything
    else runs on (key, first order column, row number), which is shuffled once by key; the other order columns of rows that tie on
    the first one follow in a second shuffle of those rows only. Rows of heavy keys are no part of that: their first rows
    are a minimum that is aggregated before its shuffle, so a key holding a third of all rows is one row per map task. What falls
    out are the numbers of the other copies, and the result is the written table without them (``without_rows``): wide
    rows are neither sorted nor shuffled, and what reads the result later reads only the columns it needs.
    """
    if not order_cols:
        raise ValueError("order_cols must name the columns that order the rows of a key")
    keys, order = list(keys), list(order_cols)
    kept = [c for c in df.columns if not (drop_order_cols and c in order and c not in keys)]
    payload = [F.col(f"`{c}`") for c in df.columns if c not in keys and c not in order]
    tie = F.xxhash64(*payload, *[c.isNull() for c in payload]) if payload else F.lit(0).cast("long")
    # pages of version 2 hold numbers and texts as differences: next to nothing for the row numbers
    base = session.materialize(df.withColumn("_row", F.monotonically_increasing_id()), "keep_first", **{"parquet.writer.version": "v2"})
    narrow = base.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *order])], tie.alias("_tie"), "_row",
                         F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_h"))
    later = _later_copies(narrow, keys, order, base.count())
    if not later.isEmpty():
        base = without_rows(base, later)
    return base.select(*[F.col(f"`{c}`") for c in kept])


def dedup_counts(before: DataFrame, key: str) -> DataFrame:
    """Rows in, rows out of a keep-first dedup on ``key``, in one pass."""
    return before.agg(F.count(F.lit(1)).alias("rows_in"),
                      F.count_distinct(F.col(key)).alias("distinct_keys"),
                      F.count_if(F.col(key).isNull()).alias("null_keys")).select(
        "rows_in",
        (F.col("distinct_keys") + F.least(F.col("null_keys"), F.lit(1))).alias("rows_out"))
