"""Keyed upserts of table states. Every function returns the new state; sinks overwrite the table or the partitions it names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rule = Callable[[Column, Column], Column]


def overwrite(old: Column, new: Column) -> Column:
    return new


def keep_old(old: Column, new: Column) -> Column:
    """The first writer wins."""
    return F.coalesce(old, new)


def fill(old: Column, new: Column) -> Column:
    """A null in the delta leaves the value as it was."""
    return F.coalesce(new, old)


def add(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], on_match: dict[str, Rule] | None = None, default: Rule = fill) -> DataFrame:
    """base with delta merged in by key: matched rows by the columns' rules, new ones as they are.

    The delta must hold a key once (see ``latest``). Columns of either side may be missing on the other. Keys compare
    null-safely. One full outer join on the keys: a single shuffle of both sides.
    """
    cols = [*base.columns, *[c for c in delta.columns if c not in base.columns]]
    b = base.select(F.lit(True).alias("__in"), *[F.col(c).alias(f"__b_{c}") for c in base.columns])
    d = delta.select(F.lit(True).alias("__new"), *[F.col(c).alias(f"__d_{c}") for c in delta.columns])
    cond = None
    for k in keys:
        one = F.col(f"__b_{k}").eqNullSafe(F.col(f"__d_{k}"))
        cond = one if cond is None else cond & one
    kinds = {f.name: f.dataType for f in [*delta.schema, *base.schema]}

    def value(c: str) -> Column:
        old = F.col(f"__b_{c}") if c in base.columns else F.lit(None).cast(kinds[c])
        new = F.col(f"__d_{c}").cast(kinds[c]) if c in delta.columns else F.lit(None).cast(kinds[c])
        if c in keys:
            return F.when(F.col("__in"), old).otherwise(new).alias(c)
        if c not in delta.columns:
            return old.alias(c)
        rule = (on_match or {}).get(c, default)
        return F.when(F.col("__new").isNull(), old).when(F.col("__in").isNull(), new).otherwise(rule(old, new)).alias(c)

    return b.join(d, cond, "full_outer").select(*[value(c) for c in cols])


def latest(delta: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the order."""
    return delta.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def insert_if_absent(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """base and the delta's rows of keys it doesn't hold, each key once."""
    new = delta.join(base.select(*keys).distinct(), keys, "left_anti").dropDuplicates(keys)
    return base.unionByName(new.select(*base.columns))


def replace_edges(base: DataFrame, delta: DataFrame, source: list[str]) -> DataFrame:
    """All edges of the sources that the delta names are its own; others stay."""
    return base.join(delta.select(*source).distinct(), source, "left_anti").unionByName(delta.select(*base.columns))


def accumulate(base: DataFrame, delta: DataFrame, keys: list[str], value: str, per: str | None = None) -> DataFrame:
    """(keys.., value) sums of base and delta. With ``per`` (a source column) a source's rows replace its earlier ones: reruns don't add up."""
    if per:
        return replace_edges(base, delta, [per]).groupBy(*keys).agg(F.sum(value).alias(value))
    return base.select(*keys, value).unionByName(delta.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))


def delete_where(base: DataFrame, pred: Column) -> DataFrame:
    """Rows for which the predicate isn't true."""
    return base.where(~F.coalesce(pred, F.lit(False)))


def retained(files: DataFrame, most_bytes: float, most_age: float, now: float, size: str = "size", mtime: str = "mtime", tie: str = "path", by: list[str] = ()) -> DataFrame:
    """Files young enough whose running size from the newest stays within the cap."""
    young = files.where(F.lit(now) - F.col(mtime) <= most_age)
    if not by:
        from meridian.operators.ranks import running_sum

        return running_sum(young, [F.col(mtime).desc(), F.col(tie)], F.col(size), "__sum").where(F.col("__sum") <= most_bytes).drop("__sum")
    w = Window.partitionBy(*by).orderBy(F.col(mtime).desc(), tie).rowsBetween(Window.unboundedPreceding, 0)
    return young.withColumn("__sum", F.sum(size).over(w)).where(F.col("__sum") <= most_bytes).drop("__sum")


def pending_intents(intents: DataFrame, landed: DataFrame, key: str, most_tries: int) -> DataFrame:
    """Outbox rows to replay: not landed, not given up."""
    return intents.join(landed.select(key).distinct(), key, "left_anti").where((F.col("status") != "done") & (F.col("tries") < most_tries))


def file_moves(files: DataFrame, existing: DataFrame, strategy: str = "skip") -> DataFrame:
    """files (id, path, dst, size, hash) + (action, final): what to do where a destination is taken.

    ``existing`` (path, size, hash) are the files that are there. Of several files with one destination the least id comes
    first. A file that lies at its destination is left ("same"), a free destination is taken ("move"). Else, by strategy:
    skip ("duplicate" if size and hash agree, a null hash counting as equal, "exists" otherwise), overwrite, fail (the row
    raises when it is read), or rename: a number before the extension, the least that gives a free name. A name that another
    file asks for isn't given away.
    """
    if strategy not in ("skip", "overwrite", "fail", "rename"):
        raise ValueError(f"unknown strategy {strategy}")
    there = existing.groupBy(F.col("path").alias("__e")).agg(F.first("size").alias("__size"), F.first("hash").alias("__hash"))
    rows = files.join(there, F.col("dst") == F.col("__e"), "left").withColumn("__same", F.col("path") == F.col("dst"))
    nth = F.row_number().over(Window.partitionBy("dst").orderBy(~F.coalesce(F.col("__same"), F.lit(False)), "id"))
    taken = F.col("__e").isNotNull() | (nth > 1)
    rows = rows.withColumn("__nth", nth).withColumn("__taken", taken)
    equal = (F.col("size") == F.col("__size")) & F.coalesce(F.col("hash") == F.col("__hash"), F.lit(True))
    clash = {
        "skip": F.when(F.coalesce(equal, F.lit(False)), "duplicate").otherwise("exists"),
        "overwrite": F.lit("overwrite"),
        "fail": F.raise_error(F.concat(F.lit("destination exists: "), F.col("dst"))).cast("string"),
        "rename": F.lit("rename"),
    }[strategy]
    rows = rows.withColumn("action", F.when(F.col("__same"), "same").when(~F.col("__taken"), "move").otherwise(clash))
    final = F.when(F.col("action").isin("move", "overwrite"), F.col("dst"))
    if strategy == "rename":
        rows = _numbered(rows, existing)
        final = F.when(F.col("action") == "rename", F.concat("__stem", F.lit("_"), F.col("__k").cast("string"), "__ext")).otherwise(final)
    return rows.withColumn("final", final).select(*files.columns, "action", "final")


def _stem(path: str) -> Column:
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")


def _numbered(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """rows + (__stem, __ext, __k): the n-th file of a destination to be renamed takes the n-th number that no name has."""
    names = existing.select(F.col("path").alias("p")).union(rows.select("dst")).distinct()
    number = F.regexp_extract(_stem("p"), r"_([1-9][0-9]*)$", 1)
    used = names.select(F.regexp_replace(_stem("p"), r"_[1-9][0-9]*$", "").alias("__s"), F.substring("p", F.length(_stem("p")) + 1, F.lit(1 << 20)).alias("__x"), number.try_cast("long").alias("n")).where("n IS NOT NULL")
    used = used.groupBy("__s", "__x").agg(F.array_sort(F.collect_set("n")).alias("__used"))
    rows = rows.withColumn("__stem", _stem("dst")).withColumn("__ext", F.substring("dst", F.length(_stem("dst")) + 1, F.lit(1 << 20)))
    order = F.row_number().over(Window.partitionBy("dst", "action").orderBy("__nth")).cast("long")
    rows = rows.withColumn("__o", order).join(used, (F.col("__stem") == F.col("__s")) & (F.col("__ext") == F.col("__x")), "left")
    return rows.withColumn("__k", F.aggregate(F.coalesce("__used", F.array().cast("array<bigint>")), F.col("__o"), lambda k, u: F.when(u <= k, k + 1).otherwise(k)))


def free_name(names: DataFrame, taken: DataFrame, name: str = "name") -> DataFrame:
    """names (id, name) + final: a taken or repeated name gets the least number that gives a free one."""
    files = names.select("*", F.lit("").alias("path"), F.col(name).alias("dst"), F.lit(0).alias("size"), F.lit("").alias("hash"))
    there = taken.select(F.col(name).alias("path"), F.lit(0).alias("size"), F.lit("").alias("hash"))
    return file_moves(files, there, "rename").select(*names.columns, "final")


def outdated(df: DataFrame, version: int, column: str = "schema_version") -> Column:
    """Rows of an older schema version, or of none."""
    return F.coalesce(F.col(column), F.lit(-1)) < version


def normalised(df: DataFrame, version: int, change: Callable[[DataFrame], DataFrame], column: str = "schema_version") -> DataFrame:
    """The table after ``change`` has run over the outdated rows alone; they get the new version, others stay as they are."""
    old = outdated(df, version, column)
    done = change(df.where(old)).withColumn(column, F.lit(version).cast(df.schema[column].dataType))
    return df.where(~old).unionByName(done.select(*df.columns))


def linked(left: DataFrame, links: DataFrame, right: DataFrame, left_id: str, right_id: str, least: float = 0.0) -> DataFrame:
    """left joined to another store's rows through a table of links (left_id, right_id, score) with at least that score."""
    good = links.where(F.col("score") >= least).select(left_id, right_id, "score")
    return left.join(good, left_id).join(right, right_id)


def sample_of(df: DataFrame, n: int, seed: int, keys: list[str]) -> DataFrame:
    """n rows without replacement, the same for the same seed whatever the partitioning: the least hashes of the keys."""
    return df.withColumn("__h", F.xxhash64(F.lit(seed), *keys)).orderBy("__h", *keys).limit(n).drop("__h")
