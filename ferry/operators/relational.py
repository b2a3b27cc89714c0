"""Relational operators the transfer logic needs, as DataFrame operations.

Table changes (insert-only merge, update, delete, replace) work on parquet
tables as "read -> transform -> write a new version": the transformed rows go
to a fresh path and the caller switches to it, because a parquet table cannot
be overwritten while it is read in the same job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.text import quoted


def _c(x: Column | str) -> Column:
    return F.col(quoted(x)) if isinstance(x, str) else x


def _own(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]


# ---------------------------------------------------------------- table changes

def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED BY TARGET THEN INSERT: target plus source rows with new keys.

    Keys compare with SQL equality, so a NULL key never matches and is
    inserted. The anti join is skew-safe and both inputs stay distributed;
    source rows that repeat one new key are all inserted, as MERGE would.
    """
    from ferry.operators.skew import skew_join
    new = skew_join(source, target.select(*[_c(k) for k in keys]), list(keys), "left_anti")
    return target.unionByName(new.select(*_own(target)))


def update_set(df: DataFrame, where: Column | None, **assignments: Column | object) -> DataFrame:
    """UPDATE df SET col = expr, ... [WHERE cond]: rows not matching keep their values.

    One projection over the old row: the condition and every expression see the
    values from before the update, as in SQL. Columns match by name without
    case; a name the table lacks is an error.
    """
    places = _by_name(df, assignments)
    columns = []
    for f in df.schema.fields:
        if f.name not in places:
            columns.append(F.col(quoted(f.name)))
            continue
        value = assignments[places[f.name]]
        new = value if isinstance(value, Column) else F.lit(value)
        kept = new if where is None else F.when(where, new.cast(f.dataType)).otherwise(F.col(quoted(f.name)))
        columns.append(kept.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def _by_name(df: DataFrame, names: Iterable[str]) -> dict[str, str]:
    """Table column -> given name, matched without case; raises on names the table lacks or that repeat."""
    own = {c.lower(): c for c in df.columns}
    out: dict[str, str] = {}
    for name in names:
        column = own.get(name.lower())
        if column is None:
            raise ValueError(f"no column {name!r} in the table")
        if column in out:
            raise ValueError(f"column {column!r} is given twice")
        out[column] = name
    return out


def update_from(df: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE t SET c = s.c FROM t JOIN s ON keys.

    A row that meets more than one source row fails the query, as in MERGE: which of them would win is not
    defined. Source rows that no row meets may repeat. NULL keys meet nothing.
    """
    from ferry.operators.skew import skew_join
    new = F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(columns)])
    s = source.groupBy(*[_c(k) for k in keys]).agg(F.first(new).alias("_f_new"), F.count(F.lit(1)).alias("_f_n"))
    j = skew_join(df, s, list(keys), "left")
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*[_c(k) for k in keys])))
    places = {c: i for i, c in enumerate(columns)}

    def value(c):
        got = F.when(F.col("_f_n") > 1, F.raise_error(message).cast(source.schema[c].dataType)).otherwise(F.col("_f_new").getField(f"c{places[c]}"))
        return F.when(F.col("_f_n").isNotNull(), got).otherwise(F.col(quoted(c))).alias(c)

    return j.select(*[value(c) if c in places else F.col(quoted(c)) for c in df.columns])


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE FROM df WHERE cond (rows where cond is NULL stay, as in SQL)."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def insert_values(spark: SparkSession, target: DataFrame, rows: Iterable[tuple]) -> DataFrame:
    """INSERT ... VALUES: literal rows appended, typed by the target schema."""
    lit = spark.createDataFrame(list(rows), target.schema)
    return target.unionByName(lit)


def insert_select(target: DataFrame, query: DataFrame) -> DataFrame:
    """INSERT ... SELECT by column name, without case; target columns the query lacks get NULL.

    A query column the target lacks is an error, not a silent loss.
    """
    given = _by_name(target, query.columns)
    cols = [(F.col(quoted(given[f.name])) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields]
    return target.unionByName(query.select(*cols))


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """CREATE OR REPLACE / TRUNCATE + INSERT: write ``df`` over ``path`` and return the new table."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


# ---------------------------------------------------------------- aggregates

_PREFIX = 64


def ordered_concat(df: DataFrame, group: Sequence[str], order: Column | str, text: Column | str, sep: str,
                   out: str = "concat", num_partitions: int | None = None) -> DataFrame:
    """Per group, ``text`` values joined by ``sep`` in ``order`` - without a hot task.

    Rows are range-partitioned on (group, order); each (partition, group)
    piece is sorted and joined by its own task, and a group's pieces (at most
    one per partition, already in order) are concatenated at the end. A group
    holding a third of the rows is sorted and joined by many tasks; only its
    final value (the result itself) is assembled in one place.
    """
    from ferry.operators.numbering import range_partitions
    o, t = _c(order), _c(text)
    group = [_c(g) for g in group]
    base = df.select(*group, o.alias("_f_o"), t.cast("string").alias("_f_t"))
    n = num_partitions or range_partitions(base)
    # The range key holds at most a short prefix of a text order and a hash for
    # ties, so the sample the driver collects stays small however long the texts
    # are. Pieces are sorted by the same keys that split them: values that share
    # a prefix and are longer than it all carry tie 0 and stay in one piece.
    text_order = isinstance(base.schema["_f_o"].dataType, T.StringType)
    tie = F.xxhash64("_f_t").bitwiseOR(F.lit(-2 ** 63))
    if text_order:
        base = base.withColumn("_f_p", F.substring("_f_o", 1, _PREFIX))
        tie = F.when(F.coalesce(F.length("_f_o"), F.lit(0)) <= _PREFIX, tie).otherwise(F.lit(0).cast("long"))
    base = base.withColumn("_f_h", tie)
    ranged = base.repartitionByRange(n, *group, F.col("_f_p" if text_order else "_f_o"), F.col("_f_h")) \
        .withColumn("_f_pid", F.spark_partition_id())
    pieces = ranged.groupBy("_f_pid", *group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_f_o", "_f_h", "_f_t"))), lambda x: x["_f_t"]), sep)
        .alias("_f_part"))
    whole = pieces.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_f_pid", "_f_part"))).alias("_f_a"))
    return whole.select(*group, F.array_join(F.transform("_f_a", lambda x: x["_f_part"]), sep).alias(out))


def agg_string(df: DataFrame, group: Sequence[str], value: str, sep: str = ",", out: str = "agg",
               distinct: bool = False, num_partitions: int | None = None) -> DataFrame:
    """STRING_AGG(value, sep) WITHIN GROUP (ORDER BY value) per group (see ``ordered_concat``).

    With ``distinct`` (group, value) pairs are de-duplicated first, map-side combined. Values order as their type (numbers as numbers).
    """
    base = df.select(*[_c(g) for g in group], _c(value).alias("_f_v")).where(F.col("_f_v").isNotNull())
    if distinct:
        base = base.distinct()
    return ordered_concat(base, group, "_f_v", "_f_v", sep, out, num_partitions)


def object_agg(df: DataFrame, group: Sequence[str], order_by: str, out: str = "objects",
               columns: Sequence[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """ARRAY_AGG(OBJECT_CONSTRUCT(*)) per group as a JSON array text ordered by ``order_by``.

    Rows become JSON text before any shuffle and are joined as in
    ``ordered_concat``. The result is one value per group, so it suits
    bounded groups (one object per column of a table, dimension rows per parent).
    """
    cols = list(columns or df.columns)
    staged = df.select(*[_c(g) for g in group], _c(order_by).alias("_f_ob"),
                       F.to_json(F.struct(*[_c(c) for c in cols])).alias("_f_j"))
    joined = ordered_concat(staged, group, "_f_ob", "_f_j", ",", "_f_c", num_partitions)
    return joined.select(*[_c(g) for g in group], F.concat(F.lit("["), F.col("_f_c"), F.lit("]")).alias(out))


def count_where(cond: Column, name: str) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False))).alias(name)


# ---------------------------------------------------------------- joins / apply

def outer_apply_flag(df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]], where: Column | None = None,
                     flag: str = "flag") -> DataFrame:
    """OUTER APPLY (SELECT 1 FROM other WHERE correlated AND where) as a 0/1 flag.

    Decorrelated into a left join against the *distinct* matching keys, so a
    row is never duplicated however many partners it has.
    """
    from ferry.operators.skew import skew_join
    keys = other if where is None else other.filter(where)
    rk = [r for _, r in on]
    keys = keys.select(*[_c(r).alias(f"_f_k{i}") for i, r in enumerate(rk)]).distinct().withColumn("_f_hit", F.lit(1))
    j = skew_join(df, keys, [(l, f"_f_k{i}") for i, (l, _) in enumerate(on)], "left")
    return j.select(*_own(df), F.coalesce(F.col("_f_hit"), F.lit(0)).alias(flag))


def apply_union(df: DataFrame, branches: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], str]],
                out: str) -> DataFrame:
    """OUTER APPLY over a UNION of correlated branches: a row for each distinct value, one with NULL if there is none.

    Each branch is (lookup table, [(df_col, lookup_col)], value column).
    Branches correlated by the same columns of ``df`` are united into one lookup
    of distinct (keys, value) rows and joined once, so every input is read once.
    Branches with different key columns are joined one lookup per set of
    columns, each reduced to one array of values per key, and the arrays united.
    """
    from ferry.operators.skew import skew_join
    lookups: dict[tuple[str, ...], DataFrame] = {}
    for table, on, value in branches:
        on = sorted(on)
        part = table.select(*[_c(r).alias(f"_f_k{i}") for i, (_, r) in enumerate(on)], _c(value).alias("_f_v")).dropna(
            subset=[f"_f_k{i}" for i in range(len(on))])
        keys = tuple(l for l, _ in on)
        lookups[keys] = lookups[keys].union(part) if keys in lookups else part
    if len(lookups) == 1:
        (keys, values), = lookups.items()
        joined = skew_join(df, values.distinct(), [(l, f"_f_k{i}") for i, l in enumerate(keys)], "left")
        return joined.select(*_own(df), F.col("_f_v").alias(out))
    joined, arrays = df, []
    for n, (keys, values) in enumerate(lookups.items()):
        names = [f"_f_k{i}" for i in range(len(keys))]
        one = values.groupBy(*names).agg(F.collect_set(F.struct("_f_v")).alias(f"_f_a{n}"))
        joined = skew_join(joined, one, list(zip(keys, names)), "left")
        arrays.append(F.coalesce(F.col(f"_f_a{n}"), F.array().cast(one.schema[f"_f_a{n}"].dataType)))
    return (joined.withColumn("_f_x", F.explode_outer(F.array_distinct(F.concat(*arrays))))
            .select(*_own(df), F.col("_f_x._f_v").alias(out)))


def lookup(df: DataFrame, table: DataFrame, left: str, right: str, value: str, out: str) -> DataFrame:
    """Scalar lookup function (name <-> id) as a left join; unknown keys give NULL.

    A row whose key has two different values (NULL counts as one) fails the query, as a
    scalar subquery that returns more than one row does; such keys that no row asks for do no harm.
    """
    from ferry.operators.skew import skew_join
    values = _c(value)
    unclear = (F.min(values) != F.max(values)) | ((F.count(values) != F.count(F.lit(1))) & (F.count(values) > 0))
    lk = (table.where(_c(right).isNotNull()).groupBy(_c(right).alias("_lk_k"))
          .agg(F.min(values).alias("_lk_v"), F.coalesce(unclear, F.lit(False)).alias("_lk_unclear")))
    message = F.concat(F.lit("more than one value for lookup key "), _c(left).cast("string"))
    failed = F.raise_error(message).cast(table.select(values).schema[0].dataType)
    joined = skew_join(df, lk, [(left, "_lk_k")], "left")
    return joined.select(*_own(df), F.when(F.col("_lk_unclear"), failed).otherwise(F.col("_lk_v")).alias(out))


def existing_pairs(df: DataFrame, col_a: str, list_a: Sequence[str], col_b: str, list_b: Sequence[str]) -> DataFrame:
    """List A x list B restricted to pairs that occur in ``df`` - computed from the data's
    distinct pairs (a partial aggregation), never as a cartesian product."""
    pairs = df.select(_c(col_a), _c(col_b)).distinct()
    return pairs.filter(_c(col_a).isin(*list_a) & _c(col_b).isin(*list_b))


def distinct_union(*dfs: DataFrame) -> DataFrame:
    """UNION (distinct)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.union(d)
    return out.distinct()


def case_map(c: Column | str, mapping: dict, default=None) -> Column:
    """Simple CASE x WHEN k THEN v ... ELSE default END."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def searched_case(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """Searched CASE WHEN cond THEN v ... ELSE default END."""
    expr = None
    for cond, v in branches:
        val = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)
