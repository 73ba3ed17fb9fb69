"""Packing on a stream: what fills no block is carried to the next micro-batch.

A micro-batch's tokens go on where the stream stopped: the carried tokens (fewer than a
block) come first, whole blocks are written with numbers that go on, and the rest, with
the place it begins at, is the new carry.  Blocks and carry of a micro-batch lie in
folders of its own, which a replay overwrites from the carry of the batch before, so the
blocks are those of one pass over all rows in the order of arrival (inside a batch, of
``order_cols``).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairforge.operators.features import block_pieces, ids_in_order, joined_pieces, placed_pieces
from pairforge.session import written
from pairforge.sources.corpus import read_or_empty

CARRY = "start bigint, ids array<int>, batch string"
BLOCKS = "block bigint, input_ids array<int>, batch string"


def pack_batch(batch: DataFrame, order_cols: list[str], out: str, name: str, block: int) -> None:
    """Pack one micro-batch: ``order_cols`` and ``ids array<int>``."""
    spark = batch.sparkSession
    carries = read_or_empty(spark, os.path.join(out, "carry"), CARRY).where(F.col("batch") < name)
    last = carries.orderBy(F.desc("batch")).limit(1).collect()  # fewer tokens than a block
    start, ids = (last[0].start, last[0].ids) if last else (0, [])
    rows = batch.where(F.size("ids") > 0).select(*order_cols, "ids")
    pieces = placed_pieces(rows, order_cols, "ids", start + len(ids), block)
    carried = spark.createDataFrame([(start, ids)], "start bigint, ids array<int>").select(
        block_pieces(F.col("ids"), F.col("start"), F.col("start") + F.size("ids"), block))
    pieces = written(carried.unionByName(pieces), "pieces")
    end = pieces.agg(F.max(F.col("p.at") + F.size("p.ids"))).first()[0]
    end = start if end is None else end
    whole = end // block * block
    joined_pieces(pieces.where(F.col("p.at") < whole), "block").write.mode("overwrite").parquet(
        os.path.join(out, "blocks", f"batch={name}"))
    rest = pieces.where(F.col("p.at") >= whole).select("p.*").agg(ids_in_order().alias("ids"))
    rest.select(F.lit(whole).cast("bigint").alias("start"), "ids").write.mode("overwrite").parquet(
        os.path.join(out, "carry", f"batch={name}"))  # the state, last


def pack_stream(spark: SparkSession, source_dir: str, schema: StructType, out: str, checkpoint: str,
                encode: Callable[[DataFrame], DataFrame], order_cols: list[str], block: int = 512,
                files_per_batch: int = 64, glob: str = "*.parquet") -> None:
    """Pack the files present (availableNow); ``encode`` makes ``order_cols`` and ``ids`` of the rows."""
    stream = encode(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                    .option("pathGlobFilter", glob).parquet(source_dir))

    def take(batch: DataFrame, batch_id: int) -> None:
        pack_batch(batch, order_cols, out, f"{batch_id:09d}", block)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def packed_blocks(spark: SparkSession, out: str) -> DataFrame:
    """All whole blocks so far."""
    return read_or_empty(spark, os.path.join(out, "blocks"), BLOCKS).select("block", "input_ids")


def rest(spark: SparkSession, out: str) -> DataFrame:
    """The carry after the last micro-batch, ``(start, ids)``: one row, or none before the first."""
    carries = read_or_empty(spark, os.path.join(out, "carry"), CARRY)
    return carries.orderBy(F.desc("batch")).limit(1).select("start", "ids")
