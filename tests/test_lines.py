import os

import pytest
from pyspark.sql import functions as F

from tokenloom.params import Params
from tokenloom.sources import lines, sinks


@pytest.fixture
def raw(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def test_tokens_need_enough_fields(raw):
    rows = lines.parse_tokens(raw("harbour\t88\t4", "lonely", "a\t1\t2\t3", "x\t\t", "\t7")).collect()
    assert [r.token for r in rows] == ["88", "1", "7"]


def test_frequencies_need_three_fields(raw):
    got = lines.parse_frequencies(raw("harbour\t88\t4", "a\t1\t2\t3", "a\t1", "a\t1\tmany", "b\t2\t3\t\t")).collect()
    assert list(map(tuple, got)) == [("harbour", "88", 4), ("b", "2", 3)]


def test_trailing_empty_fields_do_not_count(raw):
    assert lines.parse_similar(raw("12\t")).count() == 0
    assert lines.malformed(raw("12\t", "12\tx(1)"), "similar").count() == 1


def test_windows(raw):
    got = lines.parse_windows(raw("input_3\t9,0,9", "label_3\t6", "no window", "input_12\t40,41,7", "label_12\t8"))
    assert list(map(tuple, got.collect()))[0] == ("input", "3", [9, 0, 9])
    paired = sorted(map(tuple, lines.pair_windows(got).collect()))
    assert paired == [("12", [40, 41, 7], 8), ("3", [9, 0, 9], 6)]
    with pytest.raises(Exception):
        lines.parse_windows(raw("input_0\t1,x,3")).collect()


def test_vectors(raw, spark):
    got = lines.parse_vectors(raw("oak\t[-1.5, 0.25, 3.0E-4]", "no vector")).select(
        "token", F.col("vector").cast("array<string>")
    )
    assert list(map(tuple, got.collect())) == [("oak", ["-1.5", "0.25", "3.0E-4"])]
    packed = raw("oak|[-1.5, 0.25]", "elm|[7, 0.125]", "ash\t[1]")
    assert [r.token for r in lines.parse_packed_vectors(packed).collect()] == ["oak", "elm"]
    line = raw("x").select(lines.pack_vector(F.lit("oak"), F.lit("[-1.5, 0.25]")))
    assert line.first()[0] == "oak|[-1.5, 0.25]"
    with pytest.raises(Exception):
        lines.parse_vectors(raw("t\t[1.0, oops]")).collect()


def test_similar(raw):
    got = lines.parse_similar(raw("88\telm(0.7512),ash(-0.25)", "7\t12(0.5), oops")).collect()
    assert {r.token: r.similar for r in got} == {"88": ["elm", "ash"], "7": ["12", "N/A"]}


def test_strict_raises(raw):
    with pytest.raises(Exception, match="malformed tokens line"):
        lines.parse_tokens(raw("a\t1\t2", "short"), strict=True).collect()
    with pytest.raises(Exception):
        lines.parse_frequencies(raw("a\t1\tmany"), strict=True).collect()


def test_malformed_counts(raw):
    row = lines.count_malformed(raw("a\t1\t2", "b", "c\t1\t2\t3", "d\t4\tmany"), "frequencies").first()
    assert tuple(row) == ("frequencies", 1, 3)


def test_trailing_commas_are_dropped(raw):
    assert lines.parse_windows(raw("input_0\t5,6,")).first().tokens == [5, 6]
    assert lines.parse_vectors(raw("t\t[1.5, 2,]")).first().vector == [1.5, 2.0]


def test_round_trips(spark):
    windows = spark.createDataFrame([(0, [1, 2], 3), (1, [2, 3], 4)], "pos long, input array<int>, label int")
    back = lines.pair_windows(lines.parse_windows(sinks.render_windows(windows)))
    assert sorted((int(r.idx), r.input, r.label) for r in back.collect()) == [(0, [1, 2], 3), (1, [2, 3], 4)]
    vectors = spark.createDataFrame([("t", [0.5, -1e-7])], "token string, vector array<float>")
    back = lines.parse_vectors(sinks.render_vectors(vectors))
    assert back.exceptAll(vectors).count() == 0
    similar = spark.createDataFrame([("t", 1, "u", 0.99876), ("t", 2, "v", float("nan"))], "token string, rank int, similar string, score double")
    assert sinks.render_similar(similar).first().value == "t\tu(0.9988),v(NaN)"


def test_sink_replaces_orders_and_sizes(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(100).select(F.col("id").cast("string").alias("token"), F.col("id").cast("string").alias("value"))
    sinks.write_lines(rows, path, partitions=3)
    sinks.write_lines(rows, path, partitions=1, order="token")
    files = [f for f in os.listdir(path) if f.startswith("part")]
    assert len(files) == 1
    with open(os.path.join(path, files[0])) as f:
        assert f.read().split() == sorted(str(i) for i in range(100))
    sinks.write_lines(rows, path, partitions=3)
    assert len([f for f in os.listdir(path) if f.startswith("part")]) == 3


def test_read_lines_skips_hidden_files_and_sets_split(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "_hidden").write_text("no\n")
    (tmp_path / ".dot").write_text("no\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = lines.read_lines(spark, str(tmp_path), Params(split_mb=10))
    assert sorted(r.value for r in got.collect()) == ["one", "two"]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert got.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == str(10 * 1024 * 1024)


@pytest.mark.parametrize("delimiter", ["\t", "|", "::", "."])
def test_any_literal_delimiter(raw, delimiter):
    line = delimiter.join(["a", "", "b", "", ""])
    got = raw(line, delimiter * 3, "").select(lines.fields(F.col("value"), delimiter).alias("f")).collect()
    assert [r.f for r in got] == [["a", "", "b"], [], []]


def test_no_task_reads_all_of_a_single_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_PIECE_BYTES", 1000)
    path, sc = str(tmp_path / "one"), spark.sparkContext
    rows = spark.range(3000).repartition(6).select(F.concat(F.lit("ü "), F.lpad(F.col("id").cast("string"), 5, "0")).alias("value"))
    for order in (None, "value"):
        group = f"single-{order}"
        sc.setJobGroup(group, group)
        # So few rows would be put into one partition for their size.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sinks.write_lines(rows, path, partitions=1, order=order)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        jobs = sc.statusTracker().getJobIdsForGroup(group)
        infos = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        assert infos and min(i.numTasks for i in infos if i) > 1
        files = [f for f in os.listdir(path) if not f.startswith((".", "_"))]
        assert len(files) == 1 and [p.name for p in tmp_path.iterdir()] == ["one"]
        with open(os.path.join(path, files[0]), encoding="utf-8") as f:
            got = f.read().split("\n")
        want = [f"ü {i:05d}" for i in range(3000)] + [""]
        assert got == want if order else sorted(got) == sorted(want) and got[-1] == ""
    sinks.write_lines(rows.limit(0), path, partitions=1)
    assert len([f for f in os.listdir(path) if f.startswith("part")]) == 1
    assert lines.read_lines(spark, path).count() == 0
