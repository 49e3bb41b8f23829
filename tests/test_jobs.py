import random

import pytest
from pyspark.sql import functions as F

from support import rows
from lodeworks.__main__ import main, parameters
from lodeworks.plans import jobs


@pytest.fixture
def write(tmp_path):
    def put(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return str(tmp_path / name)

    return put


def test_word_and_hashtag_counts(spark, write):
    path = write("t.txt", ["to be  or", "#a not #a,#b", "", "to #b"])
    assert [tuple(r) for r in jobs.word_counts(spark, path).collect()][:2] == [("", 2), ("to", 2)]
    assert ("", 2) not in rows(jobs.word_counts(spark, path, drop_empty=True))
    assert rows(jobs.hashtag_counts(spark, path, 0)) == [("#a", 1), ("#a,#b", 1), ("#b", 1)]


def test_hashtag_trend(spark, write):
    first = write("a.csv", ["1,#x y,#z", "2,#x"])
    second = write("b.csv", ["3,#x #q"])
    assert [tuple(r) for r in jobs.hashtag_trend(spark, first, second, 1).collect()] == [("#x", 2, 1, 3)]
    assert jobs.hashtag_trend(spark, first, second, 0, top=1).count() == 1


def test_movies(spark, write):
    movies = write("m.csv", ["MovieID,MovieTitle,Genres", '1,"A, B",Adventure|Fun', "2,C,Fun", "3,D,Adventure"])
    rated = write("r.csv", ["UserID,MovieID,Rating,Timestamp"] + [f"{u},{m},{r},0" for u in range(4) for m, r in ((1, 4), (2, 5), (3, 3))])
    assert rows(jobs.genre_totals(spark, movies)) == [("Adventure", 2), ("Fun", 2)]
    top = jobs.top_movies(spark, movies, rated, min_rating=3.5, min_reviews=3)
    assert [tuple(r) for r in top.collect()] == [(1, 4.0, 4, "A, B")]


def test_recommender(spark, write):
    rated = write("r.csv", ["UserID,MovieID,Rating"] + [f"{u},{m},{1 + (u + m) % 5}" for u in range(12) for m in range(12)])
    got = jobs.tune_recommender(spark, rated, ranks=[2], regs=[0.1, 1.0], iterations=[3])
    assert got.count() == 2 and got.where("is_best").count() == 1
    best = jobs.recommend_movies(spark, rated, n=2, iters=3)
    assert best.columns == ["UserID", "rank", "MovieID", "score"] and best.count() == 24


@pytest.fixture
def scanners(write):
    rng = random.Random(3)
    lines = ["id,numports,lifetime,Packets,mirai,zmap,masscan,ports_scanned_str"]
    for i in range(200):
        ports = sorted(rng.sample(["23", "2323", "80", "443", "22", "8080"], rng.randrange(1, 5)))
        lines.append(f"{i},{len(ports)},{rng.random()},{rng.randrange(9)},{'23' in ports},False,False,{'-'.join(ports)}")
    return write("s.csv", lines)


def test_scanners(spark, scanners):
    sets = jobs.frequent_port_sets(spark, scanners, min_exclusive=10)
    assert sets.count() > 0 and sets.agg(F.min("n")).first()[0] > 10
    profile = jobs.cluster_profiles(spark, scanners, k=6, top_ports=4)
    assert profile.agg(F.sum("size")).first()[0] == 200
    assert profile.where("mirai_ratio between 0 and 1").count() == profile.count()
    assert rows(jobs.compare_cluster_counts(spark, scanners, ks=[2, 4], top_ports=4).select("k_asked")) == [(2,), (4,)]


def test_diagnosis(spark, write):
    rng = random.Random(4)
    names = ["id", *jobs.CELLS[:5], "bare_nuclei", *jobs.CELLS[5:], "class"]
    lines = [",".join(names)]
    for i in range(400):
        cell = [rng.randrange(1, 11) for _ in jobs.CELLS]
        bare = rng.choice(["?", *map(str, range(1, 11))])
        lines.append(",".join(map(str, [i, *cell[:5], bare, *cell[5:], 4 if cell[0] > 6 else 2])))
    path = write("b.txt", lines)
    depths = jobs.diagnosis_depths(spark, path, depths=[1, 2]).collect()
    assert depths[0]["f1"] == 1.0 and depths[0]["n_nodes"] == 3
    rules = jobs.diagnosis_rules(spark, path).collect()
    assert sorted(r["rule"] for r in rules) == ["clump_thickness <= 6.5", "clump_thickness > 6.5"]


def test_digits(spark, tmp_path):
    df = spark.range(80).select(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("id") % 10, 255).otherwise(0)).alias("pixels"),
        (F.col("id") % 10).cast("int").alias("label"),
    )
    df.write.parquet(str(tmp_path / "d"))
    curve = jobs.digit_curve(spark, str(tmp_path / "d"), str(tmp_path / "d"), hidden=[8], budgets=[1, 60])
    assert curve.orderBy("iters").collect()[1]["train_acc"] > 0.9


def test_command_line(spark, write, tmp_path, capsys):
    path = write("t.txt", ["b a b"])
    main(["word-counts", f"texts={path}", "--out", str(tmp_path / "o"), "--format", "text"])
    assert rows(spark.read.text(str(tmp_path / "o"))) == [("a,1",), ("b,2",)]
    main(["word-counts", f"texts={path}", "drop_empty=true"])
    assert "|b   |2  |" in capsys.readouterr().out
    assert parameters(jobs.tune_recommender, ["rated=x", "ranks=4,8", "seed=1"]) == {"rated": "x", "ranks": [4, 8], "seed": 1}
    for bad in (["nope=1"], []):
        with pytest.raises(SystemExit):
            parameters(jobs.word_counts, bad)
