import re

from pyspark.sql import functions as F

from support import rows
from lodeworks.functions.text import collapse_ws, split_literal, strip_ws
from lodeworks.operators import counts, filters, joins, reshape
from lodeworks.operators.counts import count_by

TEXTS = [
    "", "   ", " a  b ", "\t#x\t", "#", "a,#b #c,d", "line\r", "x" * 50_000, "　wide ",
    "in ner", "\x1cfs\x1f", "a​b ",
]


def test_strip_split_and_collapse_equal_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = df.orderBy("i").select(
        split_literal(strip_ws(F.col("t")), " ").alias("s"), collapse_ws(F.col("t")).alias("c")
    ).collect()
    for text, row in zip(TEXTS, got, strict=True):
        assert row["s"] == text.strip().split(" ")
        assert row["c"] == re.sub(r"\s+", " ", text)


def test_split_literal_escapes(frame):
    df = frame("t string", ("a|b||c|",), ("a.b",), ("a::b",))
    parts = df.select(split_literal(F.col("t"), "|"), split_literal(F.col("t"), "."), split_literal(F.col("t"), "::"))
    assert [list(map(list, r)) for r in parts.collect()] == [
        [["a", "b", "", "c", ""], ["a|b||c|"], ["a|b||c|"]],
        [["a.b"], ["a", "b"], ["a.b"]],
        [["a::b"], ["a::b"], ["a", "b"]],
    ]


def test_tokenize_keeps_empty_tokens_unless_asked(frame):
    df = frame("value string", (" a  b ",), ("",), (None,))
    assert rows(reshape.tokenize(df)) == [("",), ("",), ("a",), ("b",)]
    assert rows(reshape.tokenize(df, drop_empty=True)) == [("a",), ("b",)]


def test_tokenize_fields_strips_only_the_line(frame):
    df = frame("id int, value string", (1, " a, #b #c,d "))
    got = rows(reshape.tokenize(df, keep=["id"], field_sep=","))
    assert got == sorted([(1, "a"), (1, ""), (1, "#b"), (1, "#c"), (1, "d")], key=repr)


def test_prefix_needs_no_separator(frame):
    df = frame("value string", ("\t#x\t",), ("#",), ("a,#b #c,d",))
    tags = filters.filter_prefix(reshape.tokenize(df), "#")
    assert rows(tags) == [("#",), ("#c,d",), ("#x",)]


def test_lines_of_equals_text_scan(spark, tmp_path, frame):
    text = "one\n\ntwo\r\nthree \rfour\r\r\nfive"
    (tmp_path / "t.txt").write_bytes(text.encode())
    assert rows(reshape.lines_of(frame("t string", (text,)), "t")) == rows(spark.read.text(str(tmp_path / "t.txt")))


def test_explode_of_null_and_empty_gives_nothing(frame):
    df = frame("id int, a array<string>", (1, ["x", "y"]), (2, []), (3, None))
    assert rows(reshape.explode_items(df, "a", keep=["id"])) == [(1, "x"), (1, "y")]


def test_threshold_is_strict_and_ties_are_ordered(frame):
    tokens = frame("token string", *[(t,) for t in "bbbaaacc"])
    n = counts.count_by(tokens, "token")
    assert rows(filters.having_more(n, 2)) == [("a", 3), ("b", 3)]
    assert rows(filters.having_more(n, 3)) == []
    assert [tuple(r) for r in counts.sort_counts(n, "token").collect()] == [("a", 3), ("b", 3), ("c", 2)]
    assert [tuple(r) for r in counts.top_k(n, 1, "token").collect()] == [("a", 3)]


def test_distinct_count_and_sketch(spark):
    df = spark.range(2000).select((F.col("id") % 700).alias("x"))
    assert counts.count_distinct(df, "x").first()[0] == 700
    assert abs(counts.count_distinct(df, "x", approximate=True).first()[0] - 700) < 70


def test_filter_impact(spark):
    got = filters.filter_impact(spark.range(10), F.col("id") > 6).first()
    assert tuple(got) == (10, 3, 0.3)


def test_trend_cases(frame):
    first = frame("token string", *[(t,) for t in "aaabbcccc"])
    second = frame("token string", *[(t,) for t in "ccddddd"])
    by_join = joins.two_period_counts(first, second, "token")
    assert rows(by_join) == [("a", 3, 0), ("b", 2, 0), ("c", 4, 2)]
    trend = joins.two_period_trend(first, second, "token", min_exclusive=2)
    assert rows(trend) == [("a", 3, 0, 3), ("c", 4, 2, 6)]  # d only later, b on the bound
    assert rows(joins.two_period_trend(first, second, "token", 2, total_min=3)) == [("c", 4, 2, 6)]
    popular = filters.having_more(by_join, 2, "n_first")
    assert rows(popular) == [r[:3] for r in rows(trend)]


def test_one_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 300_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "the").otherwise(F.col("id").cast("string")).alias("w")
    )
    plan = count_by(df, "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert count_by(df, "w").where("w = 'the'").first()["n"] == 100_000
