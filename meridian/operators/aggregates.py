"""Roll-ups and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """(by.., property, filled, total, percent): how many rows have each property, in one pass."""
    sums = df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count(c).alias(f"__{c}") for c in cols])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("property"), F.col(f"__{c}").alias("filled")) for c in cols])).alias("p")
    return sums.select(*by, "total", pairs).select(*by, "p.property", "p.filled", "total", F.round(100.0 * F.col("p.filled") / F.nullif(F.col("total"), F.lit(0)), 2).alias("percent"))


def dominant(df: DataFrame, by: list[str], label: str, weight: Column) -> DataFrame:
    """(by.., label, weight): the label of the largest sum of a group, ties to the smaller label."""
    sums = df.groupBy(*by, label).agg(F.sum(weight).alias("__w"))
    best = sums.groupBy(*by).agg(F.min(F.struct((-F.col("__w")).alias("w"), F.col(label).alias("l"))).alias("b"))
    return best.select(*by, F.col("b.l").alias(label), (-F.col("b.w")).alias("weight"))


def dominance(df: DataFrame, who: str, seconds: Column, file: str, day: Column) -> DataFrame:
    """(who, speech_s, file_count, active_days, dominance): seconds + 30 a day + 5 a file."""
    sums = df.groupBy(who).agg(F.sum(seconds).alias("speech_s"), F.countDistinct(file).alias("file_count"), F.countDistinct(day).alias("active_days"))
    return sums.withColumn("dominance", F.col("speech_s") + 30 * F.col("active_days") + 5 * F.col("file_count"))


def hour_shares(df: DataFrame, place: str, ts: str) -> DataFrame:
    """(place, n, weekday, business, evening): shares of Monday to Friday, of hours 9 to 18 and of hours 18 to 23, ends included."""
    h = F.hour(ts)
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return df.groupBy(place).agg(F.count("*").alias("n"), share(F.weekday(ts) < 5).alias("weekday"), share(h.between(9, 18)).alias("business"), share(h.between(18, 23)).alias("evening"))


def weighted_shares(shares: DataFrame, by: list[str]) -> DataFrame:
    """Shares of finer groups rolled up, weighted by their counts."""
    mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
    return shares.groupBy(*by).agg(mean("weekday"), mean("business"), mean("evening"), F.sum("n").alias("n"))


def place_roles(shares: DataFrame, place: str, least: int = 200, least_weekday: float = 0.15) -> DataFrame:
    """shares + role: the busiest place is home; the best work score of the others is work; rare ones are travel."""
    score = 0.5 * F.col("weekday") + 0.3 * F.col("business") + 0.2 * F.when(F.col("weekday") > 0.5, F.col("evening")).otherwise(0.0)
    rows = shares.withColumn("work_score", score)
    best = lambda df, by, out: df.orderBy(F.col(by).desc(), place).limit(1).select(F.col(place).alias(out))
    home = best(rows, "n", "__home")
    work = best(rows.join(F.broadcast(home), F.col(place) == F.col("__home"), "left_anti"), "work_score", "__work")
    rows = rows.join(F.broadcast(home), F.col(place) == F.col("__home"), "left").join(F.broadcast(work), F.col(place) == F.col("__work"), "left")
    rare = (F.col("n") < least) | (F.col("weekday") < least_weekday)
    role = F.when(F.col("__home").isNotNull(), "home").when(F.col("__work").isNotNull(), "work").when(rare, "travel").otherwise("other")
    return rows.withColumn("role", role).drop("__home", "__work")


def daily_digest(df: DataFrame, day: Column, order: str, text: str, most: int = 8, piece: int = 220, whole: int = 1800) -> DataFrame:
    """(day, n, digest): the day's first texts, cut to pieces, bulleted and cut as a whole.

    Only the first rows of a day are gathered; a day's other texts are counted, not collected.
    """
    nth = F.row_number().over(Window.partitionBy("day").orderBy(order))
    rows = df.withColumn("day", day)
    counts = rows.groupBy("day").agg(F.count("*").alias("n"))
    firsts = rows.withColumn("__n", nth).where(F.col("__n") <= most).groupBy("day").agg(F.sort_array(F.collect_list(F.struct("__n", F.substring(text, 1, piece).alias("t")))).alias("r"))
    digest = F.substring(F.array_join(F.transform("r", lambda x: F.concat(F.lit("- "), x["t"])), "\n"), 1, whole)
    return counts.join(firsts, "day").select("day", "n", digest.alias("digest"))


def second_medians(df: DataFrame, by: list[str], second: str, cols: list[str], flags: str | None = None) -> DataFrame:
    """(by.., second, cols..): medians of a second's samples; flags are joined and distinct."""
    extra = [F.sort_array(F.array_distinct(F.flatten(F.collect_list(flags)))).alias(flags)] if flags else []
    return df.groupBy(*by, second).agg(*[F.median(c).alias(c) for c in cols], *extra)


def weighted_centre(df: DataFrame, by: list[str], lat: str, lon: str, n: str, role: str) -> DataFrame:
    """(by.., lat, lon, n, cells, role): count-weighted centre of cells and the role with the largest count."""
    sums = df.groupBy(*by).agg((F.sum(F.col(lat) * F.col(n)) / F.sum(n)).alias(lat), (F.sum(F.col(lon) * F.col(n)) / F.sum(n)).alias(lon), F.sum(n).alias(n), F.count("*").alias("cells"))
    return sums.join(dominant(df, by, role, F.col(n)).drop("weight"), by)


def kpi_report(records: DataFrame, platform: str, topic: str, hook: str) -> dict[str, DataFrame]:
    """platforms, hooks, topics and error: means of views and retention, the best and worst five hooks, topics, prediction error."""
    means = lambda by: records.groupBy(by).agg(F.round(F.avg("views"), 1).alias("avg_views"), F.round(F.avg("avg_view_pct"), 1).alias("avg_retention"), F.count("*").alias("n"))
    hooks = records.groupBy(hook).agg(F.round(F.avg("avg_view_pct"), 1).alias("retention"))
    best = hooks.orderBy(F.col("retention").desc(), hook).limit(5).withColumn("side", F.lit("top"))
    worst = hooks.orderBy(F.col("retention").asc(), hook).limit(5).withColumn("side", F.lit("weak"))
    scaled = records.crossJoin(F.broadcast(records.agg(F.max("views").alias("__most"))))
    error = scaled.agg(F.round(F.avg(F.abs(100.0 * F.col("views") / F.col("__most") - F.col("pred_virality"))), 1).alias("mae"))
    return {"platforms": means(platform), "hooks": best.unionByName(worst), "topics": means(topic), "error": error}


def kpi_actions(records: DataFrame, target: str, topic: str, low_ctr: float = 2.0, high_retention: float = 60.0, low_views: float = 100.0) -> DataFrame:
    """(place, action, subject, value): re-render low click rates, promote the best retention of each target, pause weak topics."""
    render = records.where(F.col("ctr") < low_ctr).select(F.lit(0).alias("place"), F.lit("rerender").alias("action"), F.col("short_id").alias("subject"), F.col("ctr").cast("double").alias("value"))
    good = records.where(F.col("avg_view_pct") > high_retention)
    best = good.groupBy(target).agg(F.min(F.struct((-F.col("avg_view_pct")).alias("v"), F.col("short_id").alias("s"))).alias("b"))
    promote = best.select(F.lit(1).alias("place"), F.lit("promote").alias("action"), F.col("b.s").alias("subject"), (-F.col("b.v")).cast("double").alias("value"))
    weak = records.groupBy(topic).agg(F.avg("views").alias("v")).where(F.col("v") < low_views)
    pause = weak.select(F.lit(2).alias("place"), F.lit("pause").alias("action"), F.col(topic).alias("subject"), F.col("v").alias("value"))
    return render.unionByName(promote).unionByName(pause)


def lift(df: DataFrame, has: Column, value: Column) -> DataFrame:
    """(with_mean, without_mean, lift) of rows with a property over those without."""
    out = df.agg(F.avg(F.when(has, value)).alias("with_mean"), F.avg(F.when(~has, value)).alias("without_mean"))
    return out.withColumn("lift", F.col("with_mean") / F.col("without_mean"))


def graded(df: DataFrame, weights: dict[str, float], cuts: tuple = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))) -> DataFrame:
    """df + (score, grade): weighted sum of factor columns and its letter."""
    score = sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0))
    grade = None
    for least, letter in cuts:
        grade = F.when(score >= least, letter) if grade is None else grade.when(score >= least, letter)
    return df.withColumn("score", score).withColumn("grade", grade.otherwise("F"))


def label_keywords(df: DataFrame, cluster: str, words: Column, stop: list[str], top: int = 3) -> DataFrame:
    """(cluster, label): the most frequent words, letters only and three or more, joined."""
    rows = df.select(cluster, F.explode(words).alias("w")).where(F.col("w").rlike("^[a-z]{3,}$") & ~F.col("w").isin(stop))
    counts = rows.groupBy(cluster, "w").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy(cluster).orderBy(F.col("n").desc(), "w"))
    few = counts.withColumn("nth", nth).where(F.col("nth") <= top)
    return few.groupBy(cluster).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "w"))), lambda x: x["w"]), ", ").alias("label"))


def rasterised(df: DataFrame, by: list[str], box: str, width: float, height: float, rows: int, cols: int, density: bool = True) -> DataFrame:
    """(by.., cell_y, cell_x, value): boxes' shares of grid cells, summed; their overlap areas without ``density``."""
    cw, ch = width / cols, height / rows
    b = F.col(box)
    hold = lambda v, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), v.cast("int")))
    xs = F.sequence(hold(F.floor(b[0] / cw), cols), hold(F.ceil(b[2] / cw) - 1, cols))
    ys = F.sequence(hold(F.floor(b[1] / ch), rows), hold(F.ceil(b[3] / ch) - 1, rows))
    cells = df.where((b[2] > b[0]) & (b[3] > b[1])).select(*by, b.alias("__b"), F.explode(xs).alias("cell_x"), ys.alias("__ys")).select(*by, "__b", "cell_x", F.explode("__ys").alias("cell_y"))
    part = lambda lo, hi, at, size: F.greatest(F.lit(0.0), F.least(hi, (at + 1) * size) - F.greatest(lo, at * size))
    area = part(F.col("__b")[0], F.col("__b")[2], F.col("cell_x"), cw) * part(F.col("__b")[1], F.col("__b")[3], F.col("cell_y"), ch)
    whole = (F.col("__b")[2] - F.col("__b")[0]) * (F.col("__b")[3] - F.col("__b")[1])
    value = area / whole if density else area
    return cells.groupBy(*by, "cell_y", "cell_x").agg(F.sum(value).alias("value")).where("value > 0")


def health_snapshot(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row of filtered counts, in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
