"""Name lists with wildcards, matched against data columns.

A pattern list is user input (bounded by what a user types), so it is turned
into *one* JVM-side predicate: literal names become an ``isin``, ``x*``, ``*x``
and ``*x*`` become prefix, suffix and substring tests, other wildcard names a
regular expression of the whole value. The scan sees the ``isin`` itself when
case matters, else tests by the first letter (both cases). No join and no
shuffle is needed to filter a table of any size by such a list.

Semantics of a list entry:
  * no wildcard character -> equality;
  * with the wildcard (default ``*``) -> LIKE match where ``*`` means any run of
    characters and ``%``, ``_`` and ``[...]`` keep their LIKE meaning;
  * comparison is case-insensitive by default (the usual server collation).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.text import quoted, split_names


def _c(x: Column | str) -> Column:
    return F.col(quoted(x)) if isinstance(x, str) else x


def as_list(names: str | Iterable[str] | None, sep: str = ",") -> list[str]:
    if names is None:
        return []
    if isinstance(names, str):
        return split_names(names, sep)
    return [n for n in names if n is not None and str(n).strip()]


def is_wildcard(name: str, wildcard: str | None = "*") -> bool:
    """Does a list entry use the wildcard character? (``wildcard=None``: wildcards off.)"""
    return wildcard is not None and wildcard in name


def like_body(pattern: str, wildcard: str = "*") -> str:
    """Regular expression, without anchors, for a LIKE pattern whose wildcard char is ``wildcard``.

    It has to match the whole value with ``.`` matching line breaks."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == wildcard or ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch == "[":
            j = pattern.find("]", i + 1)
            if j == -1:
                out.append(re.escape(ch))
            else:
                body = pattern[i + 1:j]
                neg = body.startswith("^")
                body = body[1:] if neg else body
                body = body.replace("\\", "\\\\").replace("[", "\\[")
                out.append("[" + ("^" if neg else "") + body + "]")
                i = j
        else:
            out.append(ch if ch.isalnum() else "\\" + ch)
        i += 1
    return "".join(out)


def like_to_regex(pattern: str, wildcard: str = "*", flags: str = "s") -> str:
    """The same as an anchored Java expression."""
    return rf"(?{flags})\A(?:{like_body(pattern, wildcard)})\z"


def match_any(col: Column | str, patterns: str | Iterable[str], wildcard: str = "*",
              case_sensitive: bool = False) -> Column:
    """Boolean column: does ``col`` equal a literal entry or match a wildcard entry of the list?"""
    pats = as_list(patterns)
    c = _c(col)
    literals = [p for p in pats if not is_wildcard(p, wildcard)]
    wilds = [p for p in pats if is_wildcard(p, wildcard)]
    conds = []
    if literals and case_sensitive:
        conds.append(c.isin(*literals))
    elif literals:
        same = F.lower(c).isin(*sorted({p.lower() for p in literals}))
        starts = sorted({x for p in literals for x in _first_letters(p)})
        # The test by first letter is implied by the list and reaches the scan; lower(...) does not.
        conds.append(same & _any([c.startswith(x) for x in starts]) if all(_first_letters(p) for p in literals) else same)
    conds += [_wild(c, p, wildcard, case_sensitive) for p in wilds]
    # NULL (not false) for a NULL name: filters drop it either way, and a bare
    # IN list stays visible to the parquet scan as a pushed filter.
    return _any(conds) if conds else F.lit(False)


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for x in conds[1:]:
        out = out | x
    return out


def _first_letters(text: str) -> list[str]:
    """Both cases of the first letter; none where another letter has the same lower case (k: the Kelvin sign)."""
    first = text[:1]
    return sorted({first.lower(), first.upper()}) if first.isascii() and first.lower() != "k" else []


def _wild(c: Column, pattern: str, wildcard: str, case_sensitive: bool) -> Column:
    """One wildcard entry: ``x*``, ``*x`` and ``*x*`` without regular expressions, others as one."""
    core = pattern.strip(wildcard) if len(wildcard) == 1 else pattern
    head, tail = pattern.startswith(wildcard), pattern.endswith(wildcard)
    if any(x in core for x in (wildcard, "%", "_", "[")):
        return c.rlike(like_to_regex(pattern, wildcard, "s" if case_sensitive else "siu"))
    value, text = (c, core) if case_sensitive else (F.lower(c), core.lower())
    if not core:
        return c.isNotNull()
    if head and tail:
        return value.contains(text)
    if head:
        return value.endswith(text)
    starts = value.startswith(text)
    first = [] if case_sensitive else _first_letters(core)
    return starts & _any([c.startswith(x) for x in first]) if first else starts


def wildcard_match(df: DataFrame, col: str, patterns: str | Iterable[str], **kw) -> DataFrame:
    """Rows whose ``col`` matches any entry (semi-join semantics: each row at most once)."""
    return df.filter(match_any(col, patterns, **kw))


def pattern_pairs(df: DataFrame, col: str, patterns: str | Iterable[str], out: str = "pattern",
                  wildcard: str = "*", case_sensitive: bool = False) -> DataFrame:
    """Theta join ``col LIKE pattern``: one row per (row, matching pattern).

    Each pattern becomes its own compiled predicate; matches are gathered in an
    array and exploded, so no cartesian product is materialised.
    """
    pats = as_list(patterns)
    hits = [F.when(match_any(col, [p], wildcard, case_sensitive), F.lit(p)) for p in pats]
    arr = F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")
    return df.select("*", F.explode(arr).alias(out))


def wildcard_expand(spark: SparkSession, names: DataFrame, col: str, patterns: str | Iterable[str],
                    out: str = "name", wildcard: str = "*", case_sensitive: bool = False) -> DataFrame:
    """Expand a list against the distinct values of ``names[col]``.

    Literal entries are kept as given (existence is checked separately), wildcard
    entries are replaced by the values they match; entries matching nothing vanish.
    Result is distinct.
    """
    pats = as_list(patterns)
    literals = [p for p in pats if not is_wildcard(p, wildcard)]
    wilds = [p for p in pats if is_wildcard(p, wildcard)]
    lit_df = spark.createDataFrame([(p,) for p in literals], T.StructType([T.StructField(out, T.StringType())]))
    if not wilds:
        return lit_df.distinct()
    matched = names.filter(match_any(col, wilds, wildcard, case_sensitive)).select(_c(col).cast("string").alias(out))
    return lit_df.unionByName(matched).distinct()


def select_pairs(df: DataFrame, col_a: str, list_a, col_b: str, list_b, **kw) -> DataFrame:
    """Rows whose (a, b) is a pair of list A x list B; pairs absent from the data simply select nothing."""
    return df.filter(match_any(col_a, list_a, **kw) & match_any(col_b, list_b, **kw))


def flag_exceptions(df: DataFrame, exceptions, cols: tuple[str, str], flag: str = "is_exception",
                    **kw) -> DataFrame:
    """1/0 flag per row: does (cols[0], cols[1]) match an exception pair?

    ``exceptions`` is either a list of (pattern_a, pattern_b) pairs (one
    predicate, no join) or a DataFrame of literal pairs with the same column
    names (left join to its distinct pairs; Spark sizes the join at run time).
    """
    a, b = cols
    if isinstance(exceptions, DataFrame):
        from ferry.operators.skew import skew_join
        keys = exceptions.select(_c(a), _c(b)).distinct().withColumn("_hit", F.lit(1))
        return (skew_join(df, keys, [a, b], "left")
                .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit"))
    cond = F.lit(False)
    for pa, pb in exceptions:
        cond = cond | (match_any(a, [pa], **kw) & match_any(b, [pb], **kw))
    return df.withColumn(flag, F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0))


def missing_names(requested: DataFrame, existing: DataFrame, on: str, existing_col: str | None = None,
                  case_sensitive: bool = False) -> DataFrame:
    """Requested names with no counterpart in ``existing`` (anti join, distributed)."""
    from ferry.operators.skew import skew_join
    ecol = existing_col or on
    norm = _c if case_sensitive else (lambda c: F.lower(_c(c).cast("string")))
    keys = existing.select(norm(ecol).alias("_f_k"))
    staged = requested.withColumn("_f_k", norm(on))
    return skew_join(staged, keys, ["_f_k"], "left_anti").drop("_f_k")


def missing_message(spark: SparkSession, names: str | Iterable[str], existing: DataFrame, col: str,
                    what: str = "name", sep: str = ", ") -> str | None:
    """Error text for literal entries of a *user list* that do not exist (None if all exist).

    Only the user's list travels to the driver: the data side is reduced by a
    distributed semi join to the (at most ``len(list)``) names it contains.
    """
    literals = [n for n in as_list(names) if not is_wildcard(n)]
    if not literals:
        return None
    req = spark.createDataFrame([(n, n.lower()) for n in literals], "name string, k string")
    found = {r[0] for r in req.join(existing.select(F.lower(_c(col).cast("string")).alias("k")),
                                   "k", "left_semi").select("name").collect()}
    missing = [n for n in literals if n not in found]
    if not missing:
        return None
    return f"{what}(s) not found: " + sep.join(missing)
