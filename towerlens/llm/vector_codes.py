"""Vector code compression: product codes learned by member-resident Lloyd rounds.

Every vector is cut into equal parts; the parts at one position share a
codebook, and a code is the index of the nearest entry at each position.

A part lives with the owner of its entry: rows are dealt by (position, entry,
salt) into a bucketed table, one owner a key. In a round every owner sums its
resident members where they lie (no exchange; only one row of sums an owner is
added up over salts), the new codebook goes to the owners, and each member is
assigned anew in place. Members that keep their entry stay in their bucket;
only members that change it go through the next shuffle, to their new owner.

``salt`` splits an entry that holds many members, all of them if need be, so an
owner has about ``OWNER_ROWS`` members at most. The driver holds the codebooks
and no row. Each round's members are a written table; a lost executor
reads it again, and the table before it is deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import bucketed, finite, forget, fresh, whole_numbers, written

#: Members an owner keeps on average if all parts of a position have one entry.
OWNER_ROWS = 50_000
#: Components are held within this bound, so that distances of parts up to 512 long fit 64 bits.
BOUND = 1 << 26

_KEYS = ("position", "home", "salt")


@dataclass
class VectorCodes:
    """``rows``: the columns asked for, ``codes`` (array of entry indexes by position) and ``error`` (squared distance);
    ``codebooks``: entries as whole numbers, by position, entry and component."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def _nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry; of equal ones the lower index."""
    far = np.zeros((len(part), len(entries)), dtype=np.int64)
    for j in range(part.shape[1]):
        step = part[:, j, None] - entries[None, :, j]
        far += step * step
    best = far.argmin(axis=1)
    return best.astype(np.int32), far[np.arange(len(part)), best]


def _parts(table, width: int) -> np.ndarray:
    column = table.column("part")
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _first_home(codebooks: np.ndarray):
    """Assignment of parts that have no owner yet, position by position of a batch."""
    def assign(batches):
        for b in batches:
            part, position = _parts(b, codebooks.shape[2]), b.column("position").to_numpy()
            home = np.zeros(len(part), dtype=np.int32)
            for p in np.unique(position):
                at = position == p
                home[at] = _nearest(part[at], codebooks[p])[0]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "position")), pa.array(home), b.column("salt"), b.column("part")],
                                             names=["row", "position", "home", "salt", "part"])
    return assign


def _reassign(codebooks: np.ndarray):
    """One owner's members against the new codebook of its position."""
    def assign(key: tuple[pa.Scalar, ...], members: pa.Table) -> pa.Table:
        home = key[1].as_py()
        entry, _ = _nearest(_parts(members, codebooks.shape[2]), codebooks[key[0].as_py()])
        return members.append_column("entry", pa.array(entry)).append_column("moved", pa.array((entry != home).astype(np.int32))) \
            .select(["row", "position", "home", "salt", "part", "entry", "moved"])
    return assign


def _measure(codebooks: np.ndarray):
    def assign(key: tuple[pa.Scalar, ...], members: pa.Table) -> pa.Table:
        entry, far = _nearest(_parts(members, codebooks.shape[2]), codebooks[key[0].as_py()])
        return pa.table({"row": members["row"], "position": members["position"], "entry": pa.array(entry), "far": pa.array(far)})
    return assign


def _updated(residents: list[DataFrame], codebooks: np.ndarray) -> np.ndarray:
    """Every entry replaced by floor(sum / count) of its members; entries without members stay. Owners sum their
    residents in their own buckets; one row an owner is then added up over salts and tables."""
    width = codebooks.shape[2]
    totals = [F.sum(F.col("part")[j].cast("long")).alias(f"s{j}") for j in range(width)]
    by_owner = None
    for r in residents:
        own = r.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n"), *totals)
        by_owner = own if by_owner is None else by_owner.unionByName(own)
    out = codebooks.copy()
    merged = by_owner.groupBy("position", "home").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)])
    for x in merged.collect():  # at most one row an entry
        out[x["position"], x["home"]] = [x[f"s{j}"] // x["n"] for j in range(width)]
    return out


def encode_vectors(vectors: DataFrame, vec: str = "embedding", key: str = "vec_id", keep: tuple[str, ...] = (), parts: int = 8,
                   entries: int = 16, rounds: int = 6, scale: int = 4096, owner_rows: int = OWNER_ROWS) -> VectorCodes:
    """Product codes of the vectors in column ``vec``: components become floor(scale * x), each of ``parts`` positions
    has ``entries`` entries, which start as the parts of the vectors with the smallest ``key``.

    Vectors that are null or hold a null or non-finite component are dropped, and so are those whose length differs from
    the first vector's (the smallest key whose length is a positive multiple of ``parts``): they have no parts to compare. Components beyond
    2**26 after scaling are held there. Null keys sort last and are coded like any; rows that share a key are rows of
    their own, and among them the smaller components come first as initial entries. Fewer vectors than ``entries``: as
    many entries as vectors. Equal initial entries: the lower index takes all members, the others stay. An empty table gives no rows and
    no codebooks. ``rows`` has ``key`` and the columns ``keep``, whatever other columns ``vectors`` has.
    """
    spark = vectors.sparkSession
    names = [key, *keep]
    kept = vectors.where(finite(vec)).select(*[F.col(f"`{c}`") for c in names], whole_numbers(vec, scale, BOUND).alias(fresh("parts", names)))
    kept = written(kept.withColumn(fresh("row", names), F.monotonically_increasing_id()), "code-vectors")
    row, values = kept.columns[-1], kept.columns[-2]
    start = kept.where((F.size(values) > 0) & (F.size(values) % parts == 0)).orderBy(F.col(f"`{key}`").asc_nulls_last(), values)
    first = start.select(F.size(values)).limit(1).collect()
    length = first[0][0] if first else 0
    kept = kept.where(F.size(values) == length) if first else kept.limit(0)
    out_type = "row long, position int, home int, salt int, part array<int>"
    if not first:
        return VectorCodes(kept.select(*[F.col(f"`{c}`") for c in names], F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")), [])
    width = length // parts
    seeds = [x[0] for x in start.where(F.size(values) == length).select(values).limit(entries).collect()]
    books = np.array([[s[p * width:(p + 1) * width] for s in seeds] for p in range(parts)], dtype=np.int64)

    salts = max(1, -(-kept.count() // owner_rows))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = kept.select(F.col(row).alias("row"), F.pmod(F.xxhash64(row), F.lit(salts)).cast("int").alias("salt"),
                      F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice(values, p * width + 1, width))).alias("position", "part"))
    placed = cut.mapInArrow(_first_home(books), out_type).repartition(buckets, *_KEYS)
    table, name = bucketed(placed, "members", buckets, *_KEYS)
    residents, held = [table], [name]
    for _ in range(rounds - 1):
        books = _updated(residents, books)
        judged, name = bucketed(_by_owner(residents, _reassign(books), out_type + ", entry int, moved int"), "members", buckets, *_KEYS, partition_by="moved")
        arrivals = judged.where("moved = 1").select("row", "position", F.col("entry").alias("home"), "salt", "part").repartition(buckets, *_KEYS)
        came, came_name = bucketed(arrivals, "arrivals", buckets, *_KEYS)
        forget(spark, *held)
        residents, held = [judged.where("moved = 0").select("row", *_KEYS, "part"), came], [name, came_name]
    if rounds:
        books = _updated(residents, books)
    measured = _by_owner(residents, _measure(books), "row long, position int, entry int, far long")
    codes = measured.groupBy("row").agg(F.array(*[F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(parts)]).alias("codes"),
                                        F.sum("far").alias("error"))
    result = kept.select(F.col(row).alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept")).join(codes, "row")
    result = written(result.select("kept.*", "codes", "error"), "codes")
    forget(spark, *held)
    return VectorCodes(result, books.tolist())


def _by_owner(residents: list[DataFrame], function, schema: str) -> DataFrame:
    """``function`` applied to the members of every owner, where they lie: each table is grouped by its bucket columns."""
    out = None
    for r in residents:
        own = r.groupBy(*_KEYS).applyInArrow(function, schema)
        out = own if out is None else out.unionByName(own)
    return out
