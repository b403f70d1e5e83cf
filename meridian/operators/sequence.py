"""Ordered-sequence operators. Those that compare with the row before are windows; those that compare with the last
*accepted* row depend on their own decisions and run through one shared grouped operator."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from meridian.functions.exprs import EARTH_M


def next_chain(df: DataFrame, by: list[str], order: list[str], id_col: str) -> DataFrame:
    """(by.., src, dst): an edge from each row to the next of its group; with no ``by`` the chain is one, by a range sort."""
    if not by:
        from meridian.operators.ranks import followed

        rows = followed(df.withColumn("src", F.col(id_col)), [F.col(c) for c in order], "src", "dst")
        return rows.select("src", "dst").where("dst is not null")
    w = Window.partitionBy(*by).orderBy(*order)
    return df.select(*by, F.col(id_col).alias("src"), F.lead(id_col).over(w).alias("dst")).where("dst is not null")


def row_checks(df: DataFrame, by: list[str], order: list[str], lat: str, lon: str, most: float = 1.0) -> DataFrame:
    """df + problems: what is wrong with a row by itself and against the row before."""
    w = Window.partitionBy(*by).orderBy(*order)
    la, lo = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    jump = lambda v, name: F.when(F.abs(v - F.lag(v).over(w)) > most, F.lit(f"{name} jump"))
    bad = lambda v, name: F.when(v.isNull(), F.lit(f"{name} not a number"))
    return df.withColumn("problems", F.array_compact(F.array(bad(la, "lat"), bad(lo, "lon"), jump(la, "lat"), jump(lo, "lon"))))


def forward_fill(df: DataFrame, by: list[str], order: list[str], cols: list[str], valid: Callable[[Column], Column]) -> DataFrame:
    """Invalid values take the last valid one of the group; those before the first stay."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.last(F.when(valid(F.col(c)), F.col(c)), ignorenulls=True).over(w), F.col(c)))
    return df


def interpolate(df: DataFrame, by: list[str], order: list[str], value: str, out: str = "filled") -> DataFrame:
    """Nulls between known values lie on the line between them, rounded half to even; edges take the nearest; 0 without any."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.row_number().over(w)
    rows = df.withColumn("__n", n)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    v = F.col(value).cast("double")
    known = F.when(v.isNotNull(), F.col("__n"))
    rows = rows.withColumn("__pv", F.last(v, True).over(back)).withColumn("__pn", F.last(known, True).over(back)).withColumn("__nv", F.first(v, True).over(ahead)).withColumn("__nn", F.first(known, True).over(ahead))
    line = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * (F.col("__n") - F.col("__pn")) / (F.col("__nn") - F.col("__pn"))
    filled = F.when(v.isNotNull(), v).when(F.col("__pn").isNotNull() & F.col("__nn").isNotNull(), F.bround(line)).otherwise(F.coalesce("__pv", "__nv", F.lit(0.0)))
    return rows.withColumn(out, filled).drop("__n", "__pv", "__pn", "__nv", "__nn")


def every_nth(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Rows 0, n, 2n, .. of each group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w) - 1).where(F.col("__n") % n == 0).drop("__n")


def stratified_cap(df: DataFrame, by: list[str], stratum: str, order: list[Column], per_stratum: int, total: int) -> DataFrame:
    """The best rows of a group: ``per_stratum`` of each stratum at most, then ``total`` of what is left."""
    inner = F.row_number().over(Window.partitionBy(*by, stratum).orderBy(*order))
    kept = df.withColumn("__n", inner).where(F.col("__n") <= per_stratum).drop("__n")
    outer = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return kept.withColumn("nth", outer).where(F.col("nth") <= total)


def chunks_of_words(df: DataFrame, text: str, length: int = 256, shared: int = 64) -> DataFrame:
    """df + (chunk, chunk_text): windows of ``length`` words that share ``shared`` with the one before."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    step = length - shared
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("__w") - shared), F.lit(step))
    return df.withColumn("__w", words).where(F.size("__w") > 0).select("*", F.posexplode(starts).alias("chunk", "__s")).withColumn("chunk_text", F.array_join(F.slice("__w", F.col("__s"), F.lit(length)), " ")).drop("__w", "__s")


def ema(values: Column, decay: float) -> Column:
    """Exponential moving average of an ordered array; starts at the first value."""
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.element_at(values, 1).cast("double"), lambda acc, x: acc * decay + x * (1 - decay))


# Sequential decisions -----------------------------------------------------------------------------------------------


def sequential(df: DataFrame, by: list[str], order: list[str], step: Callable[[object, dict], tuple[object, object]], out: str, kind: str, needs: list[str] = (), missing: object = None) -> DataFrame:
    """df + out: rows of a group in order; step(state, row) -> (state, value). The state starts as None.

    Rows are dealt by group, sorted, and streamed: a task holds a batch and one state, whatever a group's size. A group's
    rows pass through one task, as each decision needs the one before. Rows with a null or NaN in a column of ``needs`` get
    ``missing`` and leave the state alone.
    """
    schema = StructType([*df.schema.fields, StructField(out, _parse_datatype_string(kind))])
    value_type = to_arrow_schema(StructType([schema[out]])).field(0).type
    checked = [c for c in needs if c not in by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, begun = None, None, False
        for batch in batches:
            values = []
            for row in batch.to_pylist():
                own = tuple("NaN" if row[c] != row[c] else row[c] for c in by)
                if not begun or own != key:
                    key, state, begun = own, None, True
                if any(row[c] is None or row[c] != row[c] for c in checked):
                    values.append(missing)
                    continue
                state, value = step(state, row)
                values.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, value_type)], [*batch.schema.names, out])

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def folded(df: DataFrame, by: list[str], order: list[str], step: Callable[[object, dict], tuple[object, list[tuple]]], finish: Callable[[object], list[tuple]], schema: str) -> DataFrame:
    """(by.., schema): rows that a group gives off; step(state, row) -> (state, rows), finish(state) -> rows after the last one.

    Streamed as in ``sequential``: a task holds a batch and one state.
    """
    out = StructType([*df.select(*by).schema.fields, *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                own = tuple(row[c] for c in by)
                if own != key:
                    made += [(*key, *r) for r in (finish(state) if key is not None else [])]
                    key, state = own, None
                state, rows = step(state, row)
                made += [(*own, *r) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], f.type) for i, f in enumerate(arrow)], schema=arrow)
        made = [(*key, *r) for r in (finish(state) if key is not None else [])]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, out)


def metres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(a)))


def speed_gate(df: DataFrame, by: list[str], order: list[str], t: str, lat: str, lon: str, most_mps: float) -> DataFrame:
    """df + kept: false where the speed from the last kept sample is above the limit."""

    def step(last, row):
        if last is None:
            return row, True
        dt = row[t] - last[t]
        ok = dt > 0 and metres(last[lat], last[lon], row[lat], row[lon]) / dt <= most_mps
        return (row, True) if ok else (last, False)

    return sequential(df, by, order, step, "kept", "boolean", [t, lat, lon], False)


def plausible_fixes(df: DataFrame, by: list[str], order: list[str], lat: str, lon: str, mph: str, jump_m: float = 250.0, most_mph: float = 110.0) -> DataFrame:
    """df + kept: in range, not too fast, not too far from the last kept fix."""

    def step(last, row):
        ok = -90 <= row[lat] <= 90 and -180 <= row[lon] <= 180 and 0 <= row[mph] <= most_mph
        ok = ok and (last is None or metres(last[lat], last[lon], row[lat], row[lon]) <= jump_m)
        return (row, True) if ok else (last, False)

    return sequential(df, by, order, step, "kept", "boolean", [lat, lon, mph], False)


def anchored_sessions(df: DataFrame, by: list[str], t: str, span: float, order: list[str] = ()) -> DataFrame:
    """df + session: a new one when a row lies more than ``span`` after the session's first row."""

    def step(state, row):
        if state is None or row[t] - state["t"] > span:
            state = {"t": row[t], "n": 0 if state is None else state["n"] + 1}
        return state, state["n"]

    return sequential(df, by, [t, *order], step, "session", "int", [t])


def spacing_filter(df: DataFrame, by: list[str], order: list[str], t: str, duration: float, gap: float, most: int) -> DataFrame:
    """df + kept: in the given order, a row is kept if it starts at or after the last kept end + gap; ``most`` of a group."""

    def step(state, row):
        state = state or {"n": 0, "end": None}
        if state["n"] < most and (state["end"] is None or row[t] >= state["end"] + gap):
            return {"n": state["n"] + 1, "end": row[t] + duration}, True
        return state, False

    return sequential(df, by, order, step, "kept", "boolean", [t], False)


def suppressed(df: DataFrame, by: list[str], score: str, t: str, tie: str, gap: float, most: int) -> DataFrame:
    """df + kept: best score first, dropped if within ``gap`` of any kept row on either side; ``most`` of a group."""
    return sequential(df.withColumn("__neg", -F.col(score)), by, ["__neg", tie], _far_from_all(t, gap, most), "kept", "boolean", [score, t], False).drop("__neg")


def _far_from_all(t: str, gap: float, most: int):
    def step(state, row):
        state = state or []
        if len(state) < most and all(abs(row[t] - x) >= gap for x in state):
            return [*state, row[t]], True
        return state, False

    return step


def consecutive_distinct(df: DataFrame, by: list[str], order: list[str], vec: str, threshold: float) -> DataFrame:
    """df + kept: false where the vector's cosine with the last kept one reaches the threshold."""

    def step(last, row):
        v = [float(x) for x in row[vec]]
        size = math.sqrt(sum(x * x for x in v))
        if last is not None and size > 0 and last[1] > 0 and sum(a * b for a, b in zip(v, last[0])) / size / last[1] >= threshold:
            return last, False
        return (v, size), True

    return sequential(df, by, order, step, "kept", "boolean", [vec], False)


def tracks(df: DataFrame, by: list[str], frame: str, box: str, reach: int, tie: str) -> DataFrame:
    """df + track: a box joins the first active track whose last box it overlaps, seen at most ``reach`` frames before."""

    def step(state, row):
        count, active = state or (0, {})
        at, x = row[frame], row[box]
        active = {n: seen for n, seen in active.items() if at - seen[0] <= reach}  # the others can't be joined any more
        for n, (_, y) in active.items():
            if min(x[2], y[2]) > max(x[0], y[0]) and min(x[3], y[3]) > max(x[1], y[1]):
                active[n] = (at, x)
                return (count, active), n
        active[count] = (at, x)
        return (count + 1, active), count

    return sequential(df, by, [frame, tie], step, "track", "int", [frame, box])


def trajectory(points: DataFrame, by: list[str], t: str, x: str, y: str, steps: int = 60, harmonics: int = 16) -> DataFrame:
    """(by.., embedding): a track resampled to ``steps``; magnitudes of the first harmonics of position and velocity, length 1."""
    import numpy as np

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(t, kind="mergesort")
        at = np.linspace(rows[t].iloc[0], rows[t].iloc[-1], steps)
        px, py = np.interp(at, rows[t], rows[x]), np.interp(at, rows[t], rows[y])
        parts = [np.abs(np.fft.rfft(s))[:harmonics] for s in (px, py, np.diff(px, prepend=px[0]), np.diff(py, prepend=py[0]))]
        v = np.concatenate(parts)
        n = np.sqrt(v @ v)
        return pd.DataFrame([[*rows[by].iloc[0].tolist(), (v / n if n else v).tolist()]], columns=[*by, "embedding"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.select(*by).schema)
    return points.groupBy(*by).applyInPandas(run, f"{kinds}, embedding array<double>")
