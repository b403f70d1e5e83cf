"""Sharding along a Hilbert curve.

Documents are points (language, source, size), each quantised; shards are runs of the order along the curve, so that a
shard covers few values of every dimension and readers can skip shards by any of them. The order is total: curve index,
digest of the text, doc_id. All copies of a text take the group's least language and source, so a group lies together.
Ranks come from a range sort: position in the partition plus the rows of the partitions before it. No task gets a whole
group, and only one row a partition meets in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import checkpointed, frugal, table
from meridian.llm.hilbert import hilbert_index

BITS = 5


def _placed(rows: DataFrame, order: list) -> DataFrame:
    """rows + (rank from 0, total): by a range sort, without any task that gets all rows."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = checkpointed(sorted_rows.withColumn("part", F.shiftright("at", 33)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    return placed.join(starts, "part").withColumn("rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "part", "start")


def _ranked(values: DataFrame, name: str) -> DataFrame:
    """(name) -> (name, name_q): the distinct values' ranks in code point order, nulls last, cut to 2**BITS levels."""
    ranked = _placed(values.select(name).distinct(), [F.col(name).asc_nulls_last()])
    return ranked.select(name, F.expr(f"int((rank * {1 << BITS}) div total)").alias(f"{name}_q"))


def hilbert_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, text, lang, source, ...) -> (doc_id, size, text_crc32, hilbert, shard, slot, lang, source), every row.

    The law is `rows`: shards' row counts differ by one at most. Null texts count as empty, null languages and sources
    are values of their own, and repeated rows take slots of their own. Empty input: no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = checkpointed(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("lang").cast("string"),
            F.col("source").cast("string"),
            F.octet_length(text).cast("long").alias("bytes"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        )
    )
    groups = rows.groupBy("digest").agg(F.min("lang").alias("lang"), F.min("source").alias("source"), F.min("bytes").alias("bytes"))
    langs, sources = _ranked(groups, "lang"), _ranked(groups, "source")
    log_size = F.least(F.length(F.bin(F.col("bytes") + 8)), F.lit((1 << BITS) - 1)).cast("int")
    points = (
        groups.join(langs, groups.lang.eqNullSafe(langs.lang), "left")
        .join(sources, groups.source.eqNullSafe(sources.source), "left")
        .select("digest", F.coalesce("lang_q", F.lit(0)).alias("x"), F.coalesce("source_q", F.lit(0)).alias("y"), log_size.alias("z"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            xyz = np.stack([batch.column(i).to_numpy() for i in (1, 2, 3)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hilbert_index(xyz, BITS))], ["digest", "hilbert"])

    curve = points.mapInArrow(run, "digest binary, hilbert long")
    keyed = rows.join(curve, "digest").select("doc_id", "lang", "source", "bytes", "text_crc32", "hilbert", "digest")
    placed = _placed(keyed, [F.col("hilbert"), F.col("digest"), F.col("doc_id")])
    shard = F.expr(f"(rank * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", (F.col("bytes") + 8).alias("size"), "text_crc32", "hilbert", F.col("shard").cast("int").alias("shard"), (F.col("rank") - first).alias("slot"), "lang", "source"
    )


def shard_index(found: DataFrame) -> DataFrame:
    """A row a shard: rows, and the least and greatest language, source and size, by which readers skip shards."""
    ends = [how(c).alias(f"{name}_{c}") for c in ("lang", "source", "size") for name, how in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("lang", "source")]
    return found.groupBy("shard").agg(F.count("*").alias("rows"), *ends, *nulls)


def admitted(index: DataFrame, lang: str | None = None, source: str | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """The shards that can hold rows of a language, a source and a range of sizes (ends included); None: any."""
    for name, value in (("lang", lang), ("source", source)):
        if value is not None:
            index = index.where(F.lit(value).between(F.col(f"min_{name}"), F.col(f"max_{name}")))
    if sizes is not None:
        index = index.where((F.col("max_size") >= sizes[0]) & (F.col("min_size") <= sizes[1]))
    return index.select("shard")


def op10_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law `rows`; nulls, empty texts, ties and repeats as in ``hilbert_shards``."""
    found = hilbert_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
