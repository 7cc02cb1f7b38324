"""Graph export operators (JN-2, JN-3, FL-5, SC-20, SC-21, SO-1).

A property graph is two DataFrames: ``vertices(id, label, props)`` and
``edges(src, dst, label, props)``, ``props`` being a JSON object. A path
pattern ``(a:L1)-[e1:R1]->(b:L2)-[e2:R2]->(c:L3)`` is a chain of equi-joins;
Spark picks the join strategy (AQE re-plans on runtime sizes and splits a
skewed vertex, e.g. one customer with a third of all orders).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditpulse.functions.text import is_blank
from creditpulse.session import materialised, scratch_path



def vertices_of(df: DataFrame, label: str, id_col: str, prefix: str) -> DataFrame:
    """A vertex per row: ``id = prefix:<id_col>``, props = the row as JSON."""
    return df.select(
        F.concat(F.lit(prefix + ":"), F.col(id_col).cast("string")).alias("id"),
        F.lit(label).alias("label"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("props"),
    )


def edges_of(df: DataFrame, label: str, src: Column, dst: Column, prop_cols) -> DataFrame:
    return df.select(
        src.alias("src"),
        dst.alias("dst"),
        F.lit(label).alias("label"),
        F.to_json(F.struct(*[F.col(c) for c in prop_cols])).alias("props"),
    )


def parse_pattern(pattern: str):
    """``"a:customer-placed->b:orders"`` style pattern -> vertex and edge
    steps: ``[("a","customer"), ("e1","placed"), ("b","orders"), ...]``."""
    steps = []
    parts = pattern.replace("->", "-").split("-")
    for i, part in enumerate(parts):
        part = part.strip()
        if ":" in part:
            alias, label = part.split(":", 1)
        else:
            alias, label = f"e{i // 2 + 1}" if i % 2 else f"v{i // 2}", part
        steps.append((alias.strip(), label.strip()))
    return steps


def match(vertices: DataFrame, edges: DataFrame, pattern: str, start: DataFrame | None = None) -> DataFrame:
    """JN-3: all paths matching ``pattern``.

    Columns: ``<alias>_id`` and ``<alias>_props`` per vertex, and
    ``<alias>_props`` per edge. ``start`` optionally replaces the first
    vertex set (e.g. already filtered by a key list), so filters apply
    before the path is expanded.
    """
    steps = parse_pattern(pattern)
    a0, l0 = steps[0]
    first = start if start is not None else vertices
    out = first.where(F.col("label") == l0).select(F.col("id").alias(f"{a0}_id"), F.col("props").alias(f"{a0}_props"))
    prev = a0
    for i in range(1, len(steps), 2):
        ea, el = steps[i]
        va, vl = steps[i + 1]
        e = edges.where(F.col("label") == el).select(
            F.col("src").alias(f"_{ea}_src"), F.col("dst").alias(f"_{ea}_dst"), F.col("props").alias(f"{ea}_props")
        )
        v = vertices.where(F.col("label") == vl).select(F.col("id").alias(f"{va}_id"), F.col("props").alias(f"{va}_props"))
        out = out.join(e, F.col(f"{prev}_id") == F.col(f"_{ea}_src"))
        out = out.join(v, F.col(f"_{ea}_dst") == F.col(f"{va}_id")).drop(f"_{ea}_src", f"_{ea}_dst")
        prev = va
    return out


def filter_by_keys(df: DataFrame, keys: DataFrame, on: str, key_col: str = "key") -> DataFrame:
    """JN-2: keep rows whose ``on`` value is in the key list (semi join).

    There is no hint: adaptive execution broadcasts the list if its size at
    run time is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    k = keys.select(F.col(key_col).alias("_k")).where(~is_blank(F.col("_k")))
    return df.join(k, F.col(on) == F.col("_k"), "left_semi")


def export_filter(df: DataFrame, where: str | None = None) -> DataFrame:
    """FL-5 static predicate (SQL text); key lists go through :func:`filter_by_keys`
    and :func:`filter_by_any`."""
    return df if not where else df.where(F.expr(where))


def _with_key(values: DataFrame, keys: DataFrame) -> DataFrame:
    """``values (v)`` that are one of ``keys (key)``."""
    return keys.select(F.col("key").alias("v")).where(~is_blank(F.col("v"))).distinct()


def _with_prefix(values: DataFrame, keys: DataFrame) -> DataFrame:
    """Values that begin with a key: their prefixes of the lengths that keys have,
    as one equality join."""
    keys = keys.select("key").where(~is_blank(F.col("key"))).distinct()
    lengths = [r[0] for r in keys.select(F.length("key")).distinct().collect()]  # no more than the longest key
    if not lengths:
        return values.where("false")
    parts = F.array(*(F.substring("v", 1, n) for n in sorted(lengths)))
    return values.select("v", F.explode(parts).alias("key")).join(keys, "key").select("v").distinct()


def _in_range(values: DataFrame, keys: DataFrame, bin_width: int) -> DataFrame:
    """Values that, as whole numbers, lie in a ``low, high`` range (half-open): both
    sides are dealt to bins of ``bin_width``, an equality join on which comes
    before the comparison."""
    width = F.lit(bin_width).cast("bigint")
    bins = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    ranges = keys.select(F.col("low").cast("bigint"), F.col("high").cast("bigint")).where("low < high").distinct()
    ranges = ranges.withColumn("bin", F.explode(bins))
    numbers = values.withColumn("n", F.col("v").try_cast("bigint")).withColumn("bin", F.floor(F.col("n") / width))
    return numbers.join(ranges, "bin").where((F.col("n") >= F.col("low")) & (F.col("n") < F.col("high"))).select("v").distinct()


#: Values of a condition that are broadcast; with more, an even join is left to Spark.
FEW_VALUES = 10_000


def filter_by_any(df: DataFrame, conditions, bin_width: int = 1000) -> DataFrame:
    """FL-5, the predicate repeated with OR: rows for which one of the conditions
    holds, each row once.

    A condition is ``(column, form, keys)``: the column equals one of ``keys
    (key)`` (``"equal"``), begins with one (``"prefix"``) or is a whole number in
    one of ``keys (low, high)`` (``"range"``). Each form is worked out on the
    column's distinct values and joined back by equality, so there is no nested
    loop and no pair of row and key more than a match needs. The rows are written
    once, as each condition reads its column. A few matching values are broadcast:
    dealt out by a column of a few values, the rows would all be in a few tasks.
    """
    df = materialised(df, "any-of")
    hit, joined = F.lit(False), df
    for i, (column, form, keys) in enumerate(conditions):
        values = df.select(F.col(column).cast("string").alias("v")).distinct()
        found = {"equal": _with_key, "prefix": _with_prefix}[form](values, keys) if form != "range" else _in_range(values, keys, bin_width)
        found = materialised(found.select(F.col("v").alias(f"_v{i}")), "any-values")
        if found.count() <= FEW_VALUES:
            found = F.broadcast(found)
        joined = joined.join(found, F.col(column).cast("string") == F.col(f"_v{i}"), "left")
        hit = hit | F.col(f"_v{i}").isNotNull()
    return joined.where(hit).select(*df.columns)


def field_groups(fields):
    """SC-20 ordering: ``[("a", "id"), ("b.name", "edge"), ...]`` -> output
    groups, an alias's JSON fields grouped at its first position."""
    groups: list[tuple[str, list[str] | None]] = []
    index: dict[str, int] = {}
    for name, kind in fields:
        if kind == "vertex":
            groups.append((name, None))
        else:
            alias, prop = name.split(".", 1)
            if alias not in index:
                index[alias] = len(groups)
                groups.append((alias, []))
            groups[index[alias]][1].append(prop)
    return groups


def _parsed(df: DataFrame, alias: str, props: list[str]) -> DataFrame:
    """``df`` with the named fields of its JSON column ``<alias>_props`` in its
    place, and ``_<alias>_bad`` for what is no JSON object. One parse a row:
    it goes through a generator, below which no test on it is copied."""
    schema = ", ".join(f"`{p}` STRING" for p in props) + ", `_corrupt` STRING"
    entity = F.from_json(F.col(f"{alias}_props"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rest = [c for c in df.columns if c != f"{alias}_props"]
    rows = df.select(*rest, F.inline_outer(F.array(F.struct(entity.alias("_e")))))
    return rows.select(
        *rest, *[F.col("_e").getField(p).alias(f"{alias}_{p}") for p in props],
        (F.col("_e").isNull() | F.col("_e._corrupt").isNotNull()).alias(f"_{alias}_bad"))


def _split_bad(df: DataFrame, fields) -> tuple[DataFrame, DataFrame]:
    """Columns in configured order; rows with an entity that did not parse apart."""
    cols, bad = [], F.lit(False)
    for alias, props in field_groups(fields):
        if props is None:
            cols.append(alias.replace(".", "_"))
        else:
            bad = bad | F.col(f"_{alias}_bad")
            cols += [f"{alias}_{p}" for p in props]
    return df.where(~bad).select(*cols), df.where(bad).select(*cols)


def project_entities(df: DataFrame, fields) -> tuple[DataFrame, DataFrame]:
    """SC-20: named fields out of JSON entities, in configured order.

    ``fields`` is a list of ``(name, kind)``: kind ``vertex`` passes a
    column through; kind ``edge`` names ``alias.prop`` inside the JSON
    column ``alias_props``. Returns ``(rows, rejects)``: a row whose entity
    is not a JSON object is rejected (and kept apart) instead of failing the
    export.
    """
    for alias, props in field_groups(fields):
        if props is not None:
            df = _parsed(df, alias, props)
    return _split_bad(df, fields)


def match_fields(vertices: DataFrame, edges: DataFrame, pattern: str, fields, keys: DataFrame | None = None,
                 on: str | None = None, key_col: str = "key") -> tuple[DataFrame, DataFrame]:
    """JN-3 + SC-20 + JN-2 in one plan: :func:`match`, with each entity's JSON
    parsed before its join, so an entity is parsed once and only the named
    fields travel. ``keys`` keeps the paths whose ``on`` is in the list:
    ``<alias>_id`` (default: the first vertex) or a field ``alias.prop``; the
    filter acts on that vertex or edge set before the joins.
    """
    steps = parse_pattern(pattern)
    wanted = {alias: props for alias, props in field_groups(fields) if props is not None}
    on = on or f"{steps[0][0]}_id"
    if keys is not None and "." in on:
        alias, prop = on.split(".", 1)
        wanted.setdefault(alias, [])
        if prop not in wanted[alias]:
            wanted[alias] = [*wanted[alias], prop]
    on = on.replace(".", "_")

    def entity(df: DataFrame, alias: str, label: str, *ids) -> DataFrame:
        rows = df.where(F.col("label") == label).select(*ids, F.col("props").alias(f"{alias}_props"))
        rows = _parsed(rows, alias, wanted[alias]) if alias in wanted else rows.drop(f"{alias}_props")
        return filter_by_keys(rows, keys, on, key_col) if keys is not None and on in rows.columns else rows

    out = prev = None
    for i in range(0, len(steps), 2):
        va, vl = steps[i]
        v = entity(vertices, va, vl, F.col("id").alias(f"{va}_id"))
        if out is None:
            out, prev = v, va
            continue
        ea, el = steps[i - 1]
        e = entity(edges, ea, el, F.col("src").alias(f"_{ea}_src"), F.col("dst").alias(f"_{ea}_dst"))
        out = out.join(e, F.col(f"{prev}_id") == F.col(f"_{ea}_src"))
        out = out.join(v, F.col(f"_{ea}_dst") == F.col(f"{va}_id")).drop(f"_{ea}_src", f"_{ea}_dst")
        prev = va
    return _split_bad(out, fields)


class Pages:
    """SO-1: pages of a stable order (``skip start limit size``).

    The rows are dealt once into ranges of the order, a folder each, and counted;
    prefix sums of the counts tell which ranges a page lies in. Only these are
    read and sorted, however deep the page is.
    """

    def __init__(self, df: DataFrame, order_cols, partitions: int | None = None):
        spark = df.sparkSession
        self.order, self.columns = list(order_cols), df.columns
        n = [] if partitions is None else [partitions]
        path = scratch_path(spark, "pages")
        ranged = df.repartitionByRange(*n, *self.order).withColumn("_range", F.spark_partition_id())
        ranged.write.partitionBy("_range").parquet(path)
        self.rows = spark.read.schema(ranged.schema).parquet(path)
        counts = sorted((r["_range"], r["count"]) for r in self.rows.groupBy("_range").count().collect())  # a row a range
        self.before, total = {}, 0
        for at, count in counts:
            self.before[at] = (total, total + count)
            total += count

    def ranges(self, start: int, size: int) -> list[int]:
        """The ranges that hold rows ``start`` to ``start + size``."""
        return [at for at, (a, b) in self.before.items() if a < start + size and b > start]

    def page(self, start: int, size: int) -> DataFrame:
        at = self.ranges(start, size)
        skip = start - self.before[at[0]][0] if at else 0
        return self.rows.where(F.col("_range").isin(at)).orderBy(*self.order).offset(skip).limit(size).select(*self.columns)


def row_json(*cols, drop_empty: bool = False) -> Column:
    """SC-21: a row as JSON text; ``drop_empty`` also drops empty strings."""
    parts = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        name = c if isinstance(c, str) else None
        v = F.when(col.cast("string") == F.lit(""), F.lit(None)).otherwise(col) if drop_empty else col
        parts.append(v.alias(name) if name else v)
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true" if drop_empty else "false"})


def json_row(c, schema: str) -> Column:
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema)
