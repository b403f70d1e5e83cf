"""Query tools for agents: described callables over a person's tables. Each returns a DataFrame of a bounded number of rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.exprs import loose_date
from meridian.operators.intervals import containment_join
from meridian.sources.readers import is_readonly


@dataclass(frozen=True)
class Tool:
    """parameters: what each argument means. run takes them, and ``limit`` where ``most`` is set."""

    name: str
    description: str
    parameters: dict[str, str]
    run: Callable[..., DataFrame]
    most: int | None = 100


@dataclass
class Toolbox:
    """Tools by name. ``help`` is one of them and lists them all."""

    tools: dict[str, Tool] = field(default_factory=dict)

    def add(self, tool: Tool) -> None:
        if tool.name in self.tools:
            raise ValueError(f"there is a tool {tool.name} already")
        self.tools[tool.name] = tool

    def describe(self) -> list[dict]:
        return [{"name": t.name, "description": t.description, "parameters": dict(t.parameters)} for t in self.tools.values()]

    def call(self, name: str, limit: int = 10, **arguments) -> DataFrame:
        """A tool's rows; texts given as arguments are trimmed and must not be empty, the limit is held to 1 and the tool's most."""
        tool = self.tools.get(name)
        if tool is None:
            raise KeyError(f"no tool {name}; there are {', '.join(sorted(self.tools))}")
        given = {k: v.strip() if isinstance(v, str) else v for k, v in arguments.items()}
        if set(given) != set(tool.parameters) or not all(v for v in given.values() if isinstance(v, str)) or "" in given.values():
            raise ValueError(f"{name} takes {tool.parameters}")
        return tool.run(**given) if tool.most is None else tool.run(**given, limit=max(1, min(int(limit), tool.most)))


def said_about(spoken: DataFrame, concepts: DataFrame, concept: str, limit: int) -> DataFrame:
    """spoken (id, text, ts), concepts (id, concept, score): utterances of concepts that hold the words, best first."""
    hits = concepts.where(F.col("concept").contains(concept))
    return hits.join(spoken, "id").select("id", "text", "ts", "concept", F.round("score", 3).alias("score")).orderBy(F.col("score").desc(), "id", "concept").limit(limit)


def said_at(spoken: DataFrame, stays: DataFrame, place: str, limit: int, window: float = 3600.0) -> DataFrame:
    """spoken (id, text, t, place or null), stays (t, place): utterances at a place, by their own place; those without one by
    the nearest stay there within the window, where no utterance names the place itself."""
    own = spoken.where(F.col("place").contains(place)).select("id", "text", "t", "place", F.lit(0.0).alias("apart"))
    near = stays.where(F.col("place").contains(place)).select("place", F.col("t").alias("at"), (F.col("t") - window).alias("lo"), (F.col("t") + window).alias("hi"))
    met = containment_join(spoken.where("place IS NULL").drop("place"), near, "t", "lo", "hi", 2 * window)
    best = met.groupBy("id", "text", "t").agg(F.min(F.struct(F.abs(F.col("t") - F.col("at")).alias("apart"), "place")).alias("m"))
    rows = own.withColumn("way", F.lit(0)).unionByName(best.select("id", "text", "t", "m.place", "m.apart", F.lit(1).alias("way")))
    first = rows.agg(F.min("way").alias("__first"))  # one row
    return rows.join(F.broadcast(first), F.col("way") == F.col("__first")).orderBy("apart", "id").limit(limit).select("id", "text", "t", "place")


def activity_on(spoken: DataFrame, written: DataFrame, day: str, limit: int) -> DataFrame:
    """What was said and written on a date, in any of the common written forms: (kind, text, ts), ``limit`` of each kind."""
    want = loose_date(F.lit(day))
    rows = lambda df, kind: df.where(F.to_date("ts") == want).orderBy("ts", "id").limit(limit).select(F.lit(kind).alias("kind"), "id", "text", "ts")
    return rows(spoken, "said").unionByName(rows(written, "wrote"))


def search_said(spoken: DataFrame, words: str, limit: int) -> DataFrame:
    return spoken.where(F.col("text").contains(words)).orderBy(F.col("ts").desc(), "id").limit(limit).select("id", "text", "ts")


def timeline(stays: DataFrame, limit: int) -> DataFrame:
    """Places by the number of stays: (place, n, first, last)."""
    sums = stays.groupBy("place").agg(F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last"))
    return sums.orderBy(F.col("n").desc(), "place").limit(limit)


def personal_toolbox(spoken: DataFrame, written: DataFrame, concepts: DataFrame, stays: DataFrame) -> Toolbox:
    """spoken (id, text, ts, t seconds, place), written (id, text, ts), concepts (id, concept, score), stays (t, place)."""
    box = Toolbox()
    spark = spoken.sparkSession
    for tool in (
        Tool("said_about", "What was said about a topic.", {"concept": "words of the topic"}, lambda concept, limit: said_about(spoken, concepts, concept, limit)),
        Tool("said_at", "What was said at a place.", {"place": "words of the place's name"}, lambda place, limit: said_at(spoken, stays, place, limit)),
        Tool("activity_on", "What was said and written on a date.", {"day": "a date such as 2026-06-14"}, lambda day, limit: activity_on(spoken, written, day, limit)),
        Tool("search_said", "Finds spoken words.", {"words": "the words as they were said"}, lambda words, limit: search_said(spoken, words, limit)),
        Tool("timeline", "Places that were visited.", {}, lambda limit: timeline(stays, limit), 200),
    ):
        box.add(tool)
    told = lambda: spark.createDataFrame([(t["name"], t["description"], t["parameters"]) for t in box.describe()], "name string, description string, parameters map<string,string>")
    box.add(Tool("help", "Lists the tools.", {}, told, None))
    return box


def query_of(text: str) -> str:
    """The statement in a model's answer: inside a code fence if there is one, up to the first semicolon."""
    fenced = re.search(r"```[a-zA-Z]*\s*(.*?)```", text, re.DOTALL)
    return (fenced.group(1) if fenced else text).strip().split(";")[0].strip()


def answered(spark: SparkSession, question: str, write: Callable[[str], str], most: int = 20) -> DataFrame:
    """Rows that answer a question: ``write`` turns it into SQL, asked once more if nothing comes; only reading is allowed.

    Raises ValueError without a statement and PermissionError for one that isn't a plain SELECT.
    """
    if not question.strip():
        raise ValueError("no question")
    sql = query_of(write(question)) or query_of(write(question))
    if not sql:
        raise ValueError("no statement was written")
    if not is_readonly(sql):
        raise PermissionError("the statement does more than read")
    return spark.sql(sql).limit(most)
