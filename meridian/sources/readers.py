"""Readers. Each returns a DataFrame of a fixed schema; header spellings are tolerated by alias lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.exprs import any_time, coalesce_columns, file_key, fraction, number
from meridian.session import ship

#: Kinds of files by their names.
KINDS = (
    ("rttm", r"\.rttm$"),
    ("entities", r"entit[^/]*\.csv$"),
    ("metadata", r"metadata[^/]*\.csv$"),
    ("csv", r"\.csv$"),
    ("json", r"\.json$"),
    ("text", r"\.(txt|srt|vtt|md)$"),
    ("media", r"\.(mp4|mov|mkv|avi|mp3|wav|m4a|flac|jpg|jpeg|png)$"),
)
SEGMENT = "start double, end double, text string, speaker string, words array<struct<word:string,start:double,end:double>>"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def kind_of(path: Column) -> Column:
    out = F.lit("other")
    for name, pattern in reversed(KINDS):
        out = F.when(F.lower(path).rlike(pattern), name).otherwise(out)
    return out


def scan_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, kind, key, bytes, modified) of all files under the roots; contents aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return rows.select("path", kind_of(F.col("path")).alias("kind"), file_key(F.col("path")).alias("key"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def files_by_key(files: DataFrame) -> DataFrame:
    """(key, kind, paths): a key's files of each kind, sorted."""
    return files.where("kind <> 'other'").groupBy("key", "kind").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def media_catalogue(files: DataFrame) -> DataFrame:
    """Media files with their date: from the path if it holds one, else the time of change."""
    day = F.regexp_extract("path", r"(\d{4})[-_/]?(\d{2})[-_/]?(\d{2})", 0)
    plain = F.regexp_replace(day, r"[-_/]", "")
    return files.where("kind = 'media'").withColumn("date", F.coalesce(F.try_to_timestamp(F.when(plain != "", plain), F.lit("yyyyMMdd")).cast("date"), F.to_date("modified")))


def read_transcript_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, key, text, language, started_at, segments): one row a file; four names of the start time are known."""
    kinds = f"text string, language string, segments array<struct<{SEGMENT.replace('start double', 'start:double').replace('end double', 'end:double').replace('text string', 'text:string').replace('speaker string', 'speaker:string').replace('words array', 'words:array').replace(', ', ',')}>>, started_at string, recorded_at string, timestamp string, created_at string"
    rows = spark.read.schema(kinds).option("multiLine", "true").option("mode", "PERMISSIVE").json(path).withColumn("path", F.input_file_name())
    text = F.coalesce("text", F.array_join(F.transform("segments", lambda s: s["text"]), " "))
    return rows.select("path", file_key(F.col("path")).alias("key"), text.alias("text"), "language", F.coalesce(*[any_time(F.col(c)) for c in ("started_at", "recorded_at", "timestamp", "created_at")]).alias("started_at"), "segments")


def read_segments_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, key, start, end, text, speaker) of a transcript's CSV, whatever its headers are called."""
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path).withColumn("path", F.input_file_name())
    pick = lambda *names: coalesce_columns(rows, *names)
    return rows.select("path", file_key(F.col("path")).alias("key"), number(pick("start", "start_time", "begin", "from")).alias("start"), number(pick("end", "end_time", "stop", "to")).alias("end"), pick("text", "transcript", "sentence").cast("string").alias("text"), pick("speaker", "label", "speaker_label").cast("string").alias("speaker"))


def read_entities_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = spark.read.option("header", "true").csv(path).withColumn("path", F.input_file_name())
    pick = lambda *names: coalesce_columns(rows, *names)
    return rows.select(file_key(F.col("path")).alias("key"), F.trim(pick("text", "entity", "name").cast("string")).alias("text"), pick("label", "type").cast("string").alias("label"), number(pick("score", "confidence")).alias("score"), number(pick("start")).alias("start"), number(pick("end")).alias("end")).where("text <> ''")


def read_rttm(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, key, start, end, speaker) of speaker turns: comments and empty turns go, unknown labels become UNKNOWN."""
    rows = spark.read.text(path).withColumn("path", F.input_file_name())
    p = F.split(F.trim("value"), r"\s+")
    turns = rows.where(~F.col("value").startswith("#") & (F.size(p) >= 8)).select("path", file_key(F.col("path")).alias("key"), p[3].try_cast("double").alias("start"), p[4].try_cast("double").alias("dur"), p[7].alias("speaker"))
    label = F.when(F.upper("speaker").isin("UNKNOWN", "<NA>", "NA", ""), "UNKNOWN").otherwise(F.col("speaker"))
    return turns.where("dur > 0").select("path", "key", "start", (F.col("start") + F.col("dur")).alias("end"), label.alias("speaker"))


def parse_detections(lines: DataFrame, value: str = "value") -> DataFrame:
    """(key, vehicle_id, name, confidence, xywh, xyxy, frame) from CSV text whose lists hold commas or blanks in brackets.

    A confidence that is no number while the name is one means that the two columns were swapped.
    """
    p = F.transform(F.split(value, r",(?![^\[]*\])"), lambda x: F.trim(x))
    numbers = lambda x: F.transform(F.filter(F.split(F.regexp_replace(x, r"[\[\]\"]", ""), r"[,\s]+"), lambda v: v != ""), lambda v: v.try_cast("double"))
    rows = lines.where(~F.lower(value).startswith("key,")).select(p.alias("p")).where(F.size("p") >= 7)
    conf, name = F.col("p")[2], F.col("p")[3]
    swapped = number(conf).isNull() & number(name).isNotNull()
    c, n = F.when(swapped, name).otherwise(conf), F.when(swapped, conf).otherwise(name)
    share = fraction(c)
    return rows.select(F.col("p")[0].alias("key"), F.col("p")[1].alias("vehicle_id"), n.alias("name"), F.when(share > 1, share / 100).otherwise(share).alias("confidence"), numbers(F.col("p")[4]).alias("xywh"), numbers(F.col("p")[5]).alias("xyxy"), F.col("p")[6].try_cast("long").alias("frame"))


def read_detections(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_detections(spark.read.text(path))


def read_gps_csv(spark: SparkSession, path: str | list[str], fps: float = 30.0) -> DataFrame:
    """(key, frame, sec, mph, lat, lon) of GPS metadata."""
    rows = spark.read.option("header", "true").csv(path)
    pick = lambda *names: coalesce_columns(rows, *names)
    frame = number(pick("frame", "frame_number")).cast("long")
    return rows.select(pick("key", "file").cast("string").alias("key"), frame.alias("frame"), F.floor(frame / fps).cast("int").alias("sec"), number(pick("mph", "speed")).alias("mph"), number(pick("lat", "latitude")).alias("lat"), number(pick("lon", "long", "longitude")).alias("lon"))


def read_trips_csv(spark: SparkSession, path: str | list[str], form: str = "MM/dd/yyyy hh:mm a") -> DataFrame:
    rows = spark.read.option("header", "true").csv(path)
    at = lambda *names: F.try_to_timestamp(coalesce_columns(rows, *names).cast("string"), F.lit(form))
    return rows.select(coalesce_columns(rows, "trackerName", "tracker").cast("string").alias("tracker"), at("startTime", "start").alias("start_time"), at("endTime", "end").alias("end_time"), number(coalesce_columns(rows, "tripMiles", "miles")).alias("miles"))


def read_rows(spark: SparkSession, path: str, form: str) -> DataFrame:
    """Intermediate rows: a JSON list, JSON lines (malformed ones dropped), CSV or Parquet."""
    if form == "json":
        return spark.read.option("multiLine", "true").json(path)
    if form == "jsonl":
        return spark.read.option("mode", "DROPMALFORMED").json(path)
    if form == "csv":
        return spark.read.option("header", "true").csv(path)
    return spark.read.format(form).load(path)


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """(key, title, text, content_hash) of a folder of notes: the title is the first heading, else the file name."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True).withColumn("path", F.input_file_name())
    head = F.regexp_extract("value", r"(?m)^#+\s+(.+)$", 1)
    name = F.regexp_replace(F.regexp_replace("path", "^.*/", ""), r"\.md$", "")
    return rows.select(name.alias("key"), F.when(head != "", F.trim(head)).otherwise(name).alias("title"), F.col("value").alias("text"), F.sha2("value", 256).alias("content_hash"))


def page(df: DataFrame, id_col: str, after: object, n: int) -> DataFrame:
    """Keyset page: the next n rows after an id."""
    rows = df if after is None else df.where(F.col(id_col) > F.lit(after))
    return rows.orderBy(id_col).limit(n)


def offset_page(df: DataFrame, order: list[str], skip: int, n: int | None) -> DataFrame:
    """Offset page over a total order; n None: all that follow."""
    out = df.orderBy(*order).offset(skip)
    return out if n is None else out.limit(n)


class Rules:
    """Source adapters: (name, path pattern, reader); a user's own rules come before the built-in ones."""

    def __init__(self, own: list | None = None):
        built_in = [
            ("transcript", r"\.json$", read_transcript_json),
            ("rows", r"\.jsonl$", lambda s, p: read_rows(s, p, "jsonl")),
            ("turns", r"\.rttm$", read_rttm),
            ("detections", r"(yolo|detect)[^/]*\.csv$", read_detections),
            ("segments", r"\.csv$", read_segments_csv),
            ("text", r"\.(txt|srt|vtt)$", lambda s, p: s.read.text(p, wholetext=True)),
            ("notes", r"\.md$", read_markdown),
        ]
        self.rules = [*(own or []), *built_in]

    def adapter(self, path: str) -> tuple[str, object] | None:
        import re

        return next(((name, read) for name, pattern, read in self.rules if re.search(pattern, path, re.IGNORECASE)), None)

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        found = self.adapter(path)
        if not found:
            raise ValueError(f"no adapter reads {path}")
        return found[1](spark, path)


WRITING = ("insert", "update", "delete", "merge", "create", "drop", "alter", "truncate", "replace", "set", "call", "load", "copy", "refresh", "cache", "uncache", "add", "analyze", "msck", "use")


def is_readonly(sql: str) -> bool:
    """Whether a statement is one SELECT or WITH without any writing word outside quotes and comments."""
    import re

    plain = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.DOTALL).strip().rstrip(";")
    words = re.findall(r"[a-z_]+", plain.lower())
    return bool(words) and words[0] in ("select", "with") and ";" not in plain and not set(words) & set(WRITING)
