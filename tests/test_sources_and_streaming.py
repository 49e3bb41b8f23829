import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from support import rows
from lodeworks.operators.counts import count_by
from lodeworks.operators.filters import filter_prefix
from lodeworks.operators.reshape import tokenize
from lodeworks.sources import (
    cached, format_lines, materialize, new_path, read_lines, read_table, rows_to_df, shared_dir,
    write_lines, write_table,
)
from lodeworks.streaming import latest_counts, start_prefix_counts


def test_csv_with_quotes_and_commas(spark, frame, tmp_path):
    df = frame("MovieID int, MovieTitle string", (1, 'a, "b"'), (2, "plain"), (3, None))
    path = str(tmp_path / "csv")
    write_table(df, path, "csv")
    assert rows(read_table(spark, path, "csv", schema=df.schema, escape='"')) == rows(df) or rows(
        read_table(spark, path, "csv", schema=df.schema)
    ) == rows(df)
    assert read_table(spark, path, "csv", infer=True).dtypes == [("MovieID", "int"), ("MovieTitle", "string")]
    with pytest.raises(ValueError):
        read_table(spark, path, "csv")


def test_marker_makes_an_inferred_column_text(spark, tmp_path):
    (tmp_path / "b.txt").write_text("id,bare_nuclei\n1,1\n2,?\n")
    assert dict(read_table(spark, str(tmp_path / "b.txt"), "csv", infer=True).dtypes)["bare_nuclei"] == "string"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_table_formats(spark, frame, tmp_path, fmt):
    df = frame("a long, b string", (1, "x"), (2, None))
    write_table(df, str(tmp_path / fmt), fmt)
    assert rows(read_table(spark, str(tmp_path / fmt), fmt, schema=df.schema)) == rows(df)


def test_text_sink_keeps_every_field_and_refuses_to_overwrite(spark, frame, tmp_path):
    df = frame("a int, b string, c string", (1, None, "z"), (2, "y", ""))
    path = str(tmp_path / "lines")
    write_lines(df, path, sep="|")
    assert rows(read_lines(spark, path)) == [("1||z",), ("2|y|",)]
    assert rows(format_lines(df, ["c", "a"])) == [(",2",), ("z,1",)]
    with pytest.raises(AnalysisException):
        write_lines(df, path)


def test_materialize_goes_to_the_configured_folder(spark, frame):
    df = materialize(frame("a int", (1,), (2,)))
    assert rows(df) == [(1,), (2,)]
    assert shared_dir(spark) in new_path(spark, "x")
    assert all(shared_dir(spark) in f for f in df.inputFiles())
    assert new_path(spark, "x") != new_path(spark, "x")


def test_cached_frames_are_released(frame):
    df = frame("a int", (1,))
    with cached(df) as (kept,):
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_metric_rows(spark):
    assert rows(rows_to_df(spark, [(1, 2.5)], "a int, b double")) == [(1, 2.5)]


def test_stream_equals_batch_over_several_batches(spark, tmp_path):
    texts = spark.range(300).select(F.concat(F.lit("a,#t"), (F.col("id") % 7).cast("string"), F.lit(" #all")).alias("text"))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in range(3):
        texts.where(F.expr(f"hash(text) % 3 = {part} or hash(text) % 3 = {part - 3}")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 2).parquet(source)
        start_prefix_counts(stream, "#", out, state, field_sep=",").awaitTermination()
    want = count_by(filter_prefix(tokenize(spark.read.parquet(source), "text", field_sep=","), "#"), "token")
    assert rows(latest_counts(spark.read.parquet(out))) == rows(want)
