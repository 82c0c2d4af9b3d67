"""Helpers that several corpus operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where a local session names none, as in tests, a temporary folder is named and kept in
    the session for later calls.  On a cluster a folder of one machine would be of no use.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and returns the reread table.

    It cuts the lineage and survives the loss of executors.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Bits of a set that narrows rows down where they are.
BITS = 1 << 23


def bit_set(rows: DataFrame, hash_column: str, bits: int = BITS):
    """A bit for each hash; at most bits / 32 numbers go to the driver, however many rows there are."""
    import numpy as np

    words = rows.select(F.expr(f"CAST(pmod(`{hash_column}`, {bits}) DIV 32 AS LONG)").alias("at"), F.expr(f"shiftleft(1L, CAST(pmod(`{hash_column}`, 32) AS INT))").alias("bit"))
    out = np.zeros(bits // 32, np.uint32)
    for r in words.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():
        out[r["at"]] = r["bits"]
    return out


def in_bit_set(hashes, bits):
    """Which hashes have their bit set; none is missed, some have it by chance."""
    import numpy as np

    # pmod of the signed hash is the remainder of the unsigned one, as the number of bits divides 2^64.
    place = np.asarray(hashes).view(np.uint64) % np.uint64(32 * len(bits))
    return (bits[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def groups(batches, keys: list[str]):
    """Tables of one key each from batches that are sorted by ``keys``; only one group is held at a time."""
    import numpy as np
    import pyarrow as pa

    held: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            c = c.to_numpy(zero_copy_only=False)
            changed[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def tiles(members: DataFrame, group: list[str], size: DataFrame, per_block: int, identity: str) -> DataFrame:
    """Deals the members of each group to tiles, so that every two of them meet in exactly one tile.

    ``size`` has one row per group with ``n``, its members.  A group of up to ``per_block``
    members is one tile; a larger one is cut into blocks by a hash of ``identity``, and a
    tile joins two blocks.  Adds tile_a <= tile_b and block.
    """
    blocks = F.ceil(F.col("n") / per_block).cast("int")
    dealt = members.join(size.select(*group, blocks.alias("_blocks")), group).withColumn("block", F.pmod(F.xxhash64(F.lit(7), identity), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return dealt.select("*", other).select(*members.columns, "block", F.least("block", "_other").alias("tile_a"), F.greatest("block", "_other").alias("tile_b"))


def local_roots(n: int, left, right, ids):
    """For links (left[i], right[i]) between 0..n-1: the smallest of ``ids`` reachable from each."""
    import numpy as np

    label = np.asarray(ids).copy()
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        np.minimum.at(label, right, label[left])
        if (label == before).all():
            return label
