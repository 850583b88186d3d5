"""One-to-many joins that put sources under their objects as time-sorted nested columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.functions.nested import START, flatten, keep_fields
from skyweave.operators.alignment import CELL, allow_co_located_joins, crowded_keys, stray_keys
from skyweave.operators.numbering import number_rows
from skyweave.runtime import broadcast_checked, materialize, scratch_path

# Part of a light curve that a row holds.
PART = "_part"
# Longest nested array in one row. A longer light curve continues in further rows.
MAX_ROWS_PER_PART = 100_000
# Longest light curve that a task puts in order as one array, to cut it into shorter rows.
MAX_ROWS_HELD = 10_000


def _time_order(df: DataFrame, sort_by: str, tie_break: Sequence[str]) -> list[Column]:
    return [F.col(sort_by).isNull(), F.col(sort_by), *[F.col(c) for c in tie_break]]


def _entry(order: list[Column], fields: list[str]) -> Column:
    keys = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    return F.struct(keys.alias("key"), F.struct(*fields).alias("row"))


def _collected(rows: DataFrame, on: list[str], into: str, order: list[Column], fields: list[str]) -> DataFrame:
    """Fields of each key as one array in the given order.

    Collecting reduces nothing, so rows are shuffled as they are and grouped after, rather than
    packed into arrays on both sides of the shuffle.
    """
    ordered = F.array_sort(F.collect_list(_entry(order, fields)))
    return rows.repartition(*on).groupBy(*on).agg(F.transform(ordered, lambda e: e["row"]).alias(into))


def _long_keys(sources: DataFrame, on: str, max_rows: int) -> DataFrame:
    """``on, _parts`` of the keys that need more than one part; at most one key per max_rows rows.

    Written and read again rather than checkpointed: the table stands in one plan several times, and
    Spark 4.1 does not carry the constraints of a checkpoint over to its copies.
    """
    counts = sources.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / max_rows).cast("int").alias("_parts")
    path = scratch_path(sources.sparkSession, "long-keys")
    counts.where(F.col("_n") > max_rows).select(on, parts).write.parquet(path)
    return sources.sparkSession.read.parquet(path)


def _in_parts(rows: DataFrame, on: str, order: list[Column], long_keys: DataFrame, max_rows: int) -> DataFrame:
    """Rows with their part: 0, but for those of long keys, which are numbered in order."""
    rows = rows.where(F.col(on).isNotNull())
    keys = broadcast_checked(long_keys.select(F.col(on).alias("_long")))
    is_long = F.col(on) == F.col("_long")
    numbered = number_rows(rows.join(keys, is_long, "left_semi"), order, within=[on])
    later = numbered.withColumn(PART, F.floor(F.col("_row") / max_rows).cast("int")).drop("_row")
    return rows.join(keys, is_long, "left_anti").withColumn(PART, F.lit(0)).unionByName(later)


def object_parts(objects: DataFrame, sources: Sequence[DataFrame], on: str, max_rows: int = MAX_ROWS_PER_PART) -> DataFrame:
    """Objects, each as often as its longest light curve needs parts, with ``_part`` and ``_start``."""
    return _with_parts(objects, [_long_keys(table, on, max_rows) for table in sources], on, max_rows)


def _with_parts(objects: DataFrame, long_keys: Sequence[DataFrame], on: str, max_rows: int) -> DataFrame:
    every = long_keys[0]
    for keys in long_keys[1:]:
        every = every.unionByName(keys)
    most = every.groupBy(F.col(on).alias("_long")).agg(F.max("_parts").alias("_parts"))
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    expanded = objects.join(broadcast_checked(most), F.col(on) == F.col("_long"), "left")
    expanded = expanded.withColumn(PART, F.explode(parts)).drop("_long", "_parts")
    return expanded.withColumn(START, F.col(PART).cast("long") * max_rows)


def nest_sources(
    objects: DataFrame,
    sources: Sequence[DataFrame],
    *,
    on: str,
    into: Sequence[str],
    sort_by: str,
    tie_break: Sequence[str] = (),
    how: str = "left",
    max_rows: int = MAX_ROWS_PER_PART,
) -> DataFrame:
    """Objects with the rows of each source table nested in one column, sorted by time, nulls last.

    An object without sources gets a null array (``how="inner"`` drops objects that lack sources
    in any table). A row holds the elements ``_start`` … ``_start + max_rows - 1`` of its light
    curves; an object with more has further rows, ``_part`` 1, 2, …, which repeat the object's columns.
    No task ever holds an unbounded one: up to ``MAX_ROWS_HELD`` rows a light curve is put in order whole. All sources of an id are joined, wherever they lie.
    """
    if len(sources) != len(into):
        raise ValueError(f"{len(sources)} source tables for {len(into)} nested columns")
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r} is neither 'left' nor 'inner'")
    how_to = dict(on=on, into=into, sort_by=sort_by, tie_break=tie_break, how=how, max_rows=max_rows)
    longest = max(max_rows, MAX_ROWS_HELD)
    too_long = [_long_keys(table, on, longest).select(F.col(on).alias("_long")) for table in sources]
    every = too_long[0]
    for keys in too_long[1:]:
        every = every.unionByName(keys)
    if every.isEmpty():
        return _nest_whole(objects, sources, **how_to)
    keys = broadcast_checked(every.distinct())
    is_long = F.col(on) == F.col("_long")
    short = _nest_whole(
        objects.join(keys, is_long, "left_anti"), [t.join(keys, is_long, "left_anti") for t in sources], **how_to
    )
    by_parts = _nest_by_parts(
        objects.join(keys, is_long, "left_semi"), [t.join(keys, is_long, "left_semi") for t in sources], **how_to
    )
    return short.unionByName(by_parts)


def _nest_whole(
    objects: DataFrame,
    sources: Sequence[DataFrame],
    *,
    on: str,
    into: Sequence[str],
    sort_by: str,
    tie_break: Sequence[str],
    how: str,
    max_rows: int,
) -> DataFrame:
    """``nest_sources`` where no light curve is too long for one array: sources are shuffled once, and arrays cut in place."""
    nested = objects
    for table, column in zip(sources, into):
        order = _time_order(table, sort_by, [c for c in tie_break if c in table.columns])
        fields = [c for c in table.columns if c != on]
        rows = table.where(F.col(on).isNotNull())
        nested = nested.join(_collected(rows, [on], column, order, fields), on, how)
    if max_rows >= MAX_ROWS_HELD:
        whole = nested.withColumns({PART: F.lit(0), START: F.lit(0).cast("long")})
        return whole.select(*objects.columns, PART, START, *into)
    sizes = [F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) for c in into]
    n_parts = F.greatest(*[F.ceil(n / max_rows).cast("int") for n in sizes], F.lit(1), F.lit(1))

    def part(p: Column) -> Column:
        first = p.cast("long") * max_rows
        cut = [
            F.when(n > first, F.slice(c, first.cast("int") + 1, max_rows)).alias(c) for c, n in zip(into, sizes)
        ]
        return F.struct(p.alias(PART), first.alias(START), *cut)

    parts = F.transform(F.sequence(F.lit(0), n_parts - 1), part)
    return nested.select(*objects.columns, F.explode(parts).alias("_cut")).select(*objects.columns, "_cut.*")


def _nest_by_parts(
    objects: DataFrame,
    sources: Sequence[DataFrame],
    *,
    on: str,
    into: Sequence[str],
    sort_by: str,
    tie_break: Sequence[str],
    how: str,
    max_rows: int,
) -> DataFrame:
    """``nest_sources`` for light curves that no task may hold: their rows are numbered by a range shuffle."""
    result_columns = [*objects.columns, PART, START, *into]
    if how == "inner":
        for table in sources:
            objects = objects.join(table.select(on), on, "left_semi")
    long_keys = [_long_keys(table, on, max_rows) for table in sources]
    nested = _with_parts(objects, long_keys, on, max_rows)
    for table, column, keys in zip(sources, into, long_keys):
        order = _time_order(table, sort_by, [c for c in tie_break if c in table.columns])
        rows = _in_parts(table, on, order, keys, max_rows)
        fields = [c for c in table.columns if c != on]
        nested = nested.join(_collected(rows, [on, PART], column, order, fields), [on, PART], "left")
    return nested.select(*result_columns)


def nest_in_cells(
    objects: DataFrame,
    sources: Sequence[DataFrame],
    *,
    on: str,
    into: Sequence[str],
    sort_by: str,
    tie_break: Sequence[str] = (),
    how: str = "left",
    max_rows: int = MAX_ROWS_PER_PART,
) -> DataFrame:
    """What ``nest_sources`` gives, of tables that lie in equal buckets of the objects' cells (``Catalog.cells``).

    Sources meet their object in the task that reads both, so they are not shuffled. Only objects with
    a source in another cell, with more sources than a row holds, or with an id in several cells are
    nested by id; their keys are found from what is missing or crowded in a cell, in narrow passes.
    The result has no column of the alignment.
    """
    allow_co_located_joins(objects.sparkSession)
    # Cells may be many small files, so the narrow passes share one reading of them, and so do those by id.
    n_parts = int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places, *placed = [materialize(table.select(CELL, on).coalesce(n_parts)) for table in (objects, *sources)]
    homes = places.where(F.col(on).isNotNull()).groupBy(on).agg(F.min(CELL).alias("a"), F.max(CELL).alias("b"))
    special = homes.where("a <> b").select(on)
    for table in placed:
        special = special.unionByName(stray_keys(table, places, on)).unionByName(crowded_keys(table, on, max_rows))
    path = scratch_path(objects.sparkSession, "special-keys")
    special.distinct().write.parquet(path)
    keys = broadcast_checked(objects.sparkSession.read.parquet(path).select(F.col(on).alias("_special")))
    is_special = F.col(on) == F.col("_special")

    bare = objects.drop(CELL)
    result_columns = [*bare.columns, PART, START, *into]
    nested = objects.join(keys, is_special, "left_anti").withColumns({PART: F.lit(0), START: F.lit(0).cast("long")})
    for table, column in zip(sources, into):
        order = _time_order(table, sort_by, [c for c in tie_break if c in table.columns])
        fields = [c for c in table.columns if c not in (on, CELL)]
        ordered = F.array_sort(F.collect_list(_entry(order, fields)))
        own = table.where(F.col(on).isNotNull()).groupBy(CELL, on).agg(F.transform(ordered, lambda e: e["row"]).alias(column))
        nested = nested.join(own, [CELL, on], "left" if how == "left" else "inner")
    by_id = nest_sources(
        bare.join(keys, is_special, "left_semi"),
        [materialize(t.drop(CELL).join(keys, is_special, "left_semi").coalesce(n_parts)) for t in sources],
        on=on, into=into, sort_by=sort_by, tie_break=tie_break, how=how, max_rows=max_rows,
    )
    return nested.select(*result_columns).unionByName(by_id)


def _merged_runs(held: Column, late: Column, sort_by: str, tie_break: Sequence[str]) -> Column:
    """Two arrays in time order as one; the sort finds the two runs and merges them."""

    def keyed(e: Column) -> Column:
        keys = [e[sort_by].isNull(), e[sort_by], *[e[c] for c in tie_break]]
        return F.struct(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"), e.alias("row"))

    both = F.when(held.isNull(), late).otherwise(F.concat(held, late))
    return F.transform(F.array_sort(F.transform(both, keyed)), lambda k: k["row"])


def merge_sources(
    nested: DataFrame,
    late: Mapping[str, DataFrame],
    *,
    on: str,
    into: Sequence[str],
    sort_by: str,
    tie_break: Sequence[str] = (),
    max_rows: int = MAX_ROWS_PER_PART,
) -> DataFrame:
    """Nested rows with late sources put into their columns: what ``nest_sources`` of all sources gives.

    ``late`` holds the late rows of some of the nested columns ``into``; fields they lack are null, others
    are left out. Rows without an id, or of an id that ``nested`` lacks, are left out. A light curve that
    fits in one row gets its late rows as a second sorted run. One that does not is flattened and nested
    anew in parts; all other rows, also of long light curves without late sources, stay as they are.
    """
    unknown = set(late) - set(into)
    if unknown:
        raise ValueError(f"late sources for {sorted(unknown)}, nested are {list(into)}")
    fields = {c: nested.schema[c].dataType.elementType.fields for c in into}
    late = {
        c: rows.where(F.col(on).isNotNull()).select(
            F.col(on).cast(nested.schema[on].dataType).alias(on),
            *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields[c]],
        )
        for c, rows in late.items()
    }
    # Parts follow each other, so the last element's position counts a light curve, copies of an object or not.
    held = [F.max(F.col(START) + F.greatest(F.size(F.col(f"`{c}`.`{fields[c][0].name}`")), F.lit(0))).alias(f"_held{i}") for i, c in enumerate(into)]
    sizes = nested.groupBy(on).agg(*held)
    for i, column in enumerate(into):
        if column in late:
            sizes = sizes.join(late[column].groupBy(on).agg(F.count(F.lit(1)).alias(f"_new{i}")), on, "left")
        else:
            sizes = sizes.withColumn(f"_new{i}", F.lit(None).cast("long"))
    fresh = F.coalesce(*[F.col(f"_new{i}") for i in range(len(into))]).isNotNull()
    most = [F.col(f"_held{i}") + F.coalesce(f"_new{i}", F.lit(0)) for i in range(len(into))]
    path = scratch_path(nested.sparkSession, "long-light-curves")
    outgrown = F.greatest(*most, F.lit(0)) > max_rows
    sizes.where(fresh & outgrown).select(F.col(on).alias("_long")).write.parquet(path)
    keys = broadcast_checked(nested.sparkSession.read.parquet(path))
    is_long = F.col(on) == F.col("_long")

    merged = nested.join(keys, is_long, "left_anti")
    for column, rows in late.items():
        names = [f.name for f in fields[column]]
        ties = [c for c in tie_break if c in names]
        short = rows.join(keys, is_long, "left_anti")
        runs = _collected(short, [on], "_late", _time_order(short, sort_by, ties), names)
        merged = merged.join(runs, on, "left")
        both = F.when(F.col("_late").isNull(), F.col(column)).otherwise(_merged_runs(F.col(column), F.col("_late"), sort_by, ties))
        merged = merged.withColumn(column, both).drop("_late")

    old = nested.join(keys, is_long, "left_semi")
    flat = []
    for column in into:
        rows = flatten(old, column, [on]).dropDuplicates([on, "_pos"]).drop("_pos")
        if column in late:
            rows = rows.unionByName(late[column].join(keys, is_long, "left_semi"))
        flat.append(rows)
    objects = old.where(F.col(PART) == 0).drop(PART, START, *into)
    anew = nest_sources(objects, flat, on=on, into=into, sort_by=sort_by, tie_break=tie_break, max_rows=max_rows)
    return merged.select(*nested.columns).unionByName(anew.select(*nested.columns))


def resort_nested(
    df: DataFrame, on: str, column: str, fields: Sequence[str], sort_by: str, max_rows: int = MAX_ROWS_PER_PART
) -> DataFrame:
    """``on, _part, _start, column`` in order of one of its fields over all parts, nulls last; ties keep their order."""
    # Counted and nested: the rows are kept, or whatever made them would run for each. Of a parent that comes
    # twice, elements may share a position; they stay in the order they come in.
    flat = flatten(df, column, [on]).select(on, "_pos", *fields)
    flat = materialize(flat.withColumn("_at", F.monotonically_increasing_id()))
    keys = flat.select(on).distinct()
    sorted_rows = nest_sources(
        keys, [flat], on=on, into=[column], sort_by=sort_by, tie_break=["_pos", "_at"], how="inner", max_rows=max_rows
    )
    return sorted_rows.withColumn(column, keep_fields(sorted_rows, column, fields))


def sort_nested(column: Column, sort_by: str) -> Column:
    """One row's nested column in order of one of its fields, nulls last; equal keys keep their order."""
    keyed = F.transform(
        column, lambda e, i: F.struct(e[sort_by].isNull(), e[sort_by], i, e.alias("row"))
    )
    return F.transform(F.array_sort(keyed), lambda k: k["row"])
