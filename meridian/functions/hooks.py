"""Models that a user supplies: embedders and extractors by name, run over Arrow batches. The defaults need no model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructType

from meridian.operators import composites

#: texts -> vectors; a factory is called once a task, so that a model is loaded there and not sent.
Embedder = Callable[[], Callable[[list[str]], list[list[float]]]]
#: texts -> for each, (label, entity, score) triples.
Extractor = Callable[[], Callable[[list[str]], list[list[tuple[str, str, float]]]]]
EMBEDDERS: dict[str, Embedder] = {}
EXTRACTORS: dict[str, Extractor] = {}
#: texts, labels -> for each text a probability a label.
CLASSIFIERS: dict[str, Callable[[], Callable[[list[str], list[str]], list[list[float]]]]] = {}
#: texts -> texts: summaries, labels, answers in JSON.
WRITERS: dict[str, Callable[[], Callable[[list[str]], list[str]]]] = {}
#: contents of recordings -> for each, (start, end, label) triples.
SEGMENTERS: dict[str, Callable[[], Callable[[list[bytes]], list[list[tuple[float, float, str]]]]]] = {}


def _mapped(df: DataFrame, text: str, out: str, kind: str, make: Callable, batch: int) -> DataFrame:
    """df + out: ``make()`` gives a function from a list of texts, or contents, to one of values; null ones count as empty."""
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{out}` {kind}").fields])
    arrow, at = to_arrow_schema(schema).field(len(df.columns)).type, df.columns.index(text)
    empty = b"" if isinstance(df.schema[text].dataType, BinaryType) else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for rows in batches:
            for start in range(0, rows.num_rows, batch):
                part = rows.slice(start, batch)
                values = model([t or empty for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, arrow)], [*part.schema.names, out])

    return df.mapInArrow(run, schema)


def embedded(df: DataFrame, text: str, out: str = "embedding", model: str | None = None, dims: int = 64, batch: int = 32) -> DataFrame:
    """df + out array<double>: by a registered embedder (of texts, or of a binary column), else by hashed words."""
    if model is None:
        return df.withColumn(out, composites.hashed_embedding(F.col(text), dims))
    return _mapped(df, text, out, "array<double>", EMBEDDERS[model], batch)


def extracted(df: DataFrame, id_col: str, text: str, model: str | None = None, batch: int = 32) -> DataFrame:
    """(id, label, entity, n): by a registered extractor, else by patterns."""
    if model is None:
        return composites.entities(df, id_col, text)
    rows = _mapped(df.select(id_col, text), text, "__found", "array<struct<label:string,entity:string,score:double>>", EXTRACTORS[model], batch)
    flat = rows.select(id_col, F.explode("__found").alias("e"))
    return flat.groupBy(id_col, F.col("e.label").alias("label"), F.col("e.entity").alias("entity")).agg(F.count("*").alias("n"))


def classified(df: DataFrame, text: str, labels: list[str], model: str, out: str = "classes", batch: int = 16) -> DataFrame:
    """df + out map<string,double>: a probability a label, by a registered classifier."""

    chosen = CLASSIFIERS[model]

    def make():
        classify = chosen()
        return lambda texts: [list(zip(labels, p)) for p in classify(texts, labels)]

    return _mapped(df, text, out, "map<string,double>", make, batch)


def written(df: DataFrame, text: str, model: str | None = None, out: str = "summary", most: int = 400, batch: int = 8) -> DataFrame:
    """df + out: by a registered writer, else the text's first sentences, up to ``most`` signs."""
    if model is not None:
        return _mapped(df, text, out, "string", WRITERS[model], batch)
    folded = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", " "))
    whole = F.regexp_extract(F.substring(folded, 1, most), r"^(.*[.!?])(\s|$)", 1)
    return df.withColumn(out, F.when(F.length(folded) <= most, folded).when(whole != "", whole).otherwise(F.substring(folded, 1, most)))


def segmented(df: DataFrame, id_col: str, content: str, model: str, batch: int = 4) -> DataFrame:
    """(id, start, stop, label): stretches of recordings, by a registered segmenter."""
    rows = _mapped(df.select(id_col, content), content, "__found", "array<struct<start:double,stop:double,label:string>>", SEGMENTERS[model], batch)
    return rows.select(id_col, F.explode("__found").alias("s")).select(id_col, "s.start", "s.stop", "s.label")


def cached(items: DataFrame, cache: DataFrame, key: str, value: str, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(items + value, new rows for the cache): ``compute`` runs over the keys that the cache (key, value) lacks, each once."""
    missing = items.join(cache.select(key), key, "left_anti").dropDuplicates([key])
    fresh = compute(missing).select(key, value)
    return items.join(cache.select(key, value).unionByName(fresh), key, "left"), fresh
