"""The fast delimiter-safety rule against split-and-compare and an actual round trip."""

import random

import pytest
from pyspark.sql import functions as F

from ferry.operators.checks import overlap_suffixes, split_check_predicate, unsafe_rows_predicate
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, read_delimited, write_delimited


def test_overlap_suffixes():
    assert overlap_suffixes("^|^") == ["^|"]
    assert overlap_suffixes("~|^") == []
    assert overlap_suffixes("aaa") == ["a", "aa"]
    assert overlap_suffixes("~~~\r\n") == []


def _random_rows(seed, alphabet, n=1500):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 6)))
    return [(i, word(), word(), word()) for i in range(n)]


@pytest.mark.parametrize("fmt, alphabet", [
    (FileFormat(field_delim="^|^", row_delim="~~~"), "^|~ab\r\n"),
    (FileFormat(field_delim="aa", row_delim="~", crlf=False), "a~b"),
    (FileFormat(field_delim="|", row_delim="xyx", crlf=False), "|xy"),
])
def test_fast_rule_is_exact(spark, fmt, alphabet):
    df = spark.createDataFrame(_random_rows(7, alphabet), "id int, a string, b string, c string")
    flags = df.select("id", unsafe_rows_predicate(df, fmt).alias("fast"), split_check_predicate(df, fmt).alias("split"))
    fast = {r.id for r in flags.filter("fast").collect()}
    split = {r.id for r in flags.filter("split").collect()}
    assert fast == split
    # and the rows it accepts really survive a write and read back
    safe = df.filter(~unsafe_rows_predicate(df, fmt))
    path = scratch_path(spark, "t-prop")
    stats = {}
    write_delimited(safe, path, fmt, stats=stats)
    assert stats["unsafe"] == 0
    back = read_delimited(spark, path, df.schema, fmt)
    assert sorted(back.collect()) == sorted(safe.collect())
    # the write-time count equals the separate check
    stats_all = {}
    write_delimited(df, scratch_path(spark, "t-prop-all"), fmt, stats=stats_all)
    assert stats_all["unsafe"] == len(fast) > 0
