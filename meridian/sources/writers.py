"""Writers: idempotent stage tables, manifests, notes, outbox."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.search import inverted_index
from meridian.operators.upsert import latest, replace_edges, upsert


def write_stage(df: DataFrame, root: str, key: str, stage: str, form: str = "parquet") -> None:
    """Rows of one key and stage; writing again replaces them and nothing else. Keys may hold any character."""
    rows = df.withColumn("key", F.lit(key)).withColumn("stage", F.lit(stage))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "key")
    (writer.option("header", "true") if form == "csv" else writer).format(form).save(root)


def read_stage(spark, root: str, stage: str, key: str | None = None, form: str = "parquet") -> DataFrame:
    rows = spark.read.option("header", "true").format(form).load(root).where(F.col("stage") == stage)
    return rows if key is None else rows.where(F.col("key") == key)


def preferred_stage(files: DataFrame, order: list[str]) -> DataFrame:
    """(key, stage, format, path): the first format of ``order`` that a key's stage was written in."""
    from pyspark.sql import Window

    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("format"))
    w = Window.partitionBy("key", "stage").orderBy(place, "path")
    return files.where(place > 0).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def flat(df: DataFrame, sep: str = "|") -> DataFrame:
    """Array columns joined, for CSV."""
    return df.select(*[F.array_join(F.transform(f.name, lambda x: x.cast("string")), sep).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema])


def write_manifest(df: DataFrame, root: str) -> None:
    """Appended as JSON lines and as CSV."""
    df.write.mode("append").json(f"{root}/jsonl")
    flat(df).write.mode("append").option("header", "true").csv(f"{root}/csv")


def as_notes(df: DataFrame, key: str, title: str, props: list[str], budget: int) -> DataFrame:
    """(name, note): up to ``budget`` rows as Markdown with a property list."""
    lines = [F.concat(F.lit(f"- {p}: "), F.coalesce(F.col(p).cast("string"), F.lit(""))) for p in props]
    note = F.concat_ws("\n", F.concat(F.lit("# "), F.col(title).cast("string")), F.lit(""), *lines)
    return df.orderBy(key).limit(budget).select(F.regexp_replace(F.col(key).cast("string"), r"[^A-Za-z0-9._-]+", "_").alias("name"), note.alias("note"))


def dump(df: DataFrame, path: str, form: str) -> None:
    (df.write.mode("overwrite").option("header", "true") if form == "csv" else df.write.mode("overwrite")).format(form).save(path)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


def claim_file(spark: SparkSession, path: str, owner: str) -> bool:
    """Claims a work file by renaming it to path.owner; of several claimants one gets True."""
    fs, where = _files(spark, path)
    return fs.exists(where) and fs.rename(where, _files(spark, f"{path}.{owner}")[1])


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """The folder ``new`` takes the place of ``path``. A crash in between leaves the old one as path.old; a rerun mends that."""
    fs, to = _files(spark, path)
    old = _files(spark, f"{path}.old")[1]
    if fs.exists(to):
        fs.delete(old, True)
        fs.rename(to, old)
    fs.rename(_files(spark, new)[1], to)
    fs.delete(old, True)


def upsert_store(spark: SparkSession, path: str, delta: DataFrame, keys: list[str], form: str = "json", order: list | None = None) -> None:
    """Rows merged by key into a store of JSON lines, CSV or Parquet, which is then replaced as a whole.

    A key's last row by ``order`` counts (by all columns, where none is given). Malformed JSON lines of the store are skipped.
    """
    new = latest(delta, keys, order or [F.col(c).desc_nulls_last() for c in delta.columns])
    back = next((p for p in (path, f"{path}.old") if exists(spark, p)), None)
    if back:
        reader = spark.read.schema(delta.schema)
        reader = reader.option("mode", "DROPMALFORMED") if form == "json" else reader.option("header", "true") if form == "csv" else reader
        new = upsert(reader.format(form).load(back), new, keys)
    made = f"{path}.{uuid.uuid4().hex}"
    writer = new.write.option("header", "true") if form == "csv" else new.write
    writer.format(form).save(made)
    replace_folder(spark, made, path)


def mirrored_index(index: DataFrame, changed: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """An inverted index (term, id, tf, length) after documents changed: their entries are made anew, the others stay."""
    fresh = inverted_index(changed, id_col, text).select(*index.columns)
    return index.join(changed.select(F.col(id_col).alias("id")).distinct(), "id", "left_anti").select(*index.columns).unionByName(fresh)


def replaced_children(store: DataFrame, delta: DataFrame, parent: list[str]) -> DataFrame:
    """A parent's rows (a file's segments) are the delta's; other parents keep theirs."""
    return replace_edges(store, delta, parent)


class Outbox:
    """Intents that are written down before the write they announce, and what became of them.

    Both are append-only Parquet logs under ``root``: a crash loses none, and nothing is rewritten. Intents:
    (op_id, op_type, correlation_id, payload JSON). An op is open until it is marked done; marks of failure count its tries.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _log(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def append(self, ops: DataFrame) -> None:
        """Intents, before their write. An op_id that is written down twice is one op."""
        rows = ops.select("op_id", "op_type", "correlation_id", "payload", F.current_timestamp().alias("at"))
        rows.write.mode("append").parquet(f"{self.root}/intents")

    def mark(self, ops: DataFrame, done: bool, error: str = "") -> None:
        ops.select("op_id", F.lit(done).alias("done"), F.lit(error).alias("error"), F.current_timestamp().alias("at")).write.mode("append").parquet(f"{self.root}/marks")

    def open(self) -> DataFrame:
        """(op_id, op_type, correlation_id, payload, tries, last_error) of ops that aren't done."""
        first = F.min(F.struct("at", "op_type", "correlation_id", "payload")).alias("o")
        ops = self._log("intents", "op_id string, op_type string, correlation_id string, payload string, at timestamp").groupBy("op_id").agg(first)
        marks = self._log("marks", "op_id string, done boolean, error string, at timestamp")
        told = marks.groupBy("op_id").agg(F.max("done").alias("done"), F.count("*").alias("tries"), F.max(F.struct("at", "error")).alias("e"))
        rows = ops.join(told, "op_id", "left").where("done IS NULL OR NOT done")
        return rows.select("op_id", "o.op_type", "o.correlation_id", "o.payload", F.coalesce("tries", F.lit(0)).alias("tries"), F.coalesce("e.error", F.lit("")).alias("last_error"))

    def around(self, ops: DataFrame, write: Callable[[], None]) -> None:
        """Intents, the write, then the marks. If the write fails the ops stay open, with the error."""
        self.append(ops)
        try:
            write()
        except Exception as error:
            self.mark(ops, False, str(error)[:500])
            raise
        self.mark(ops, True)

    def replay(self, landed: DataFrame | None = None, most_tries: int = 3) -> dict[str, int]:
        """Open ops whose op_id is in ``landed`` are done; others stay. -> counts: seen, drained, kept, failed.

        Ops beyond ``most_tries`` and those whose payload isn't JSON fail once more. Without ``landed`` nothing is marked.
        """
        ops = self.open()
        bad = F.when(F.col("tries") > most_tries, "replay: too many tries").when(F.get_json_object("payload", "$").isNull(), "replay: bad payload")
        ops = ops.withColumn("bad", bad).persist()
        counts = {"seen": ops.count(), "drained": 0, "failed": ops.where("bad IS NOT NULL").count()}
        for reason in ("replay: too many tries", "replay: bad payload"):
            self.mark(ops.where(F.col("bad") == reason), False, reason)
        if landed is not None:
            arrived = ops.where("bad IS NULL").join(landed.select("op_id").distinct(), "op_id", "left_semi")
            counts["drained"] = arrived.count()
            self.mark(arrived, True)
        counts["kept"] = counts["seen"] - counts["drained"] - counts["failed"]
        ops.unpersist()
        return counts
