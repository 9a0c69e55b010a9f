import pytest
from pyspark.sql import functions as F

from passagemill.session import new_path, work_folder
from passagemill.sources.readers import (
    parse_csv_lines,
    read_binary_files,
    read_csv_file,
    read_one_file,
    read_table,
)
from passagemill.sources.writers import (
    create_table_if_absent,
    has_change_feed,
    preview,
    set_change_feed,
    write_append,
    write_evolved,
    write_files,
    write_overwrite,
)


def test_binary_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "doc1.html").write_bytes(b"one")
    (tmp_path / "deep" / "doc1.txt").write_bytes(b"three")
    (tmp_path / "deep" / "xdoc1.html").write_bytes(b"x")
    files = read_binary_files(spark, str(tmp_path))
    assert files.columns == ["path", "modificationTime", "length", "content"]
    assert files.count() == 3
    assert read_binary_files(spark, str(tmp_path), recursive=False, glob="*.html").count() == 1
    html = read_binary_files(spark, str(tmp_path), "*.html")
    assert html.count() == 2
    assert bytes(read_one_file(html, "doc1.html").first()["content"]) == b"one"
    plan = files.where("length > 3").select("path")._jdf.queryExecution().toString()
    assert "GreaterThan(length,3)" in plan
    assert "content" not in plan.split("== Physical Plan ==")[1]


LINES = [
    ('"What, exactly?","First, a. Then ""b"".",simple,TRUE', ("What, exactly?", 'First, a. Then "b".', "simple", True)),
    ("plain,3–7% for 1°C,reasoning,FALSE", ("plain", "3–7% for 1°C", "reasoning", False)),
    ('"two\nlines",x,simple,TRUE', ("two\nlines", "x", "simple", True)),
    ("short,one", ("short", "one", None, None)),
]
SCHEMA = "question string, ground_truth string, evolution_type string, episode_done boolean"


def test_csv_lines(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(LINES)], "n int, line string")
    rows = parse_csv_lines(df, "line", SCHEMA).orderBy("n").collect()
    assert [tuple(r)[1:] for r in rows] == [fields for _, fields in LINES]


def test_csv_file(spark, tmp_path):
    path = tmp_path / "eval.csv"
    path.write_text("question,ground_truth,evolution_type,episode_done\n" + "\n".join(l for l, _ in LINES[:3]))
    rows = read_csv_file(spark, str(path), SCHEMA, multi_line=True).collect()
    assert {tuple(r) for r in rows} == {fields for _, fields in LINES[:3]}


def test_overwrite_and_append(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    write_overwrite(rows, "w1")
    write_overwrite(rows.where("id = 1"), "w1")
    assert read_table(spark, "w1", ["id"]).collect() == [(1,)]
    write_append(rows, "w1")
    assert read_table(spark, "w1").count() == 3
    write_append(rows.union(spark.createDataFrame([(3, "c"), (3, "c")], rows.schema)), "w1", "id")
    assert sorted(r["id"] for r in read_table(spark, "w1").collect()) == [1, 1, 2, 3]


def test_create_table_and_change_feed(spark):
    schema = spark.createDataFrame([], "id bigint, embedding array<float>").schema
    create_table_if_absent(spark, "w2", schema)
    create_table_if_absent(spark, "w2", schema)
    assert read_table(spark, "w2").schema == schema
    assert not has_change_feed(spark, "w2")
    set_change_feed(spark, "w2")
    assert has_change_feed(spark, "w2")
    set_change_feed(spark, "w2", False)
    assert not has_change_feed(spark, "w2")


def test_evolve_own_source(spark):
    write_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "w3")
    source = read_table(spark, "w3")
    old = spark.createDataFrame([(9,)], "id int")
    after = write_evolved(source.withColumn("n", F.length("v")), "w3", old)
    assert {tuple(r) for r in after.collect()} == {(1, "a", 1), (2, "b", 1), (9, None, None)}
    assert read_table(spark, "w3").columns == ["id", "v", "n"]


def test_preview_is_a_bounded_sort(spark):
    top = preview(spark.range(1000).withColumn("k", -F.col("id")), 3, ["k"])
    assert [r["id"] for r in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().toString()


def test_work_folder(spark, monkeypatch):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")

    class Conf:
        def get(self, key, default=None):
            return "hdfs:///warehouse" if key == "spark.sql.warehouse.dir" else default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    assert work_folder(Cluster()) == "hdfs:///warehouse/_staged-app"
    Cluster.sparkContext.master = "local[2]"
    assert work_folder(Cluster()) == work_folder(Cluster())


def test_one_file_is_found_for_every_page(spark, monkeypatch):
    from checks import queries

    rows = [(n, "url", f"<p>{n}</p>") for n in (6, 7, 70)] + [(8, "url", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(queries, "_table", lambda *_: pages)
    found = queries.src_one_file(spark, "unused")
    assert {(row["page_id"], row["length"]) for row in found.collect()} == {(6, 9), (7, 9), (8, 1), (70, 10)}
    # files are opened before the rows are dealt by page
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length(content" in plan.split("Window", 1)[1]


def test_one_file_by_a_column(spark):
    files = spark.createDataFrame(
        [("/d/a.txt", "a.txt"), ("/d/ba.txt", "a.txt"), ("/d/c.txt", None)], "path string, name string"
    )
    assert [row["path"] for row in read_one_file(files, F.col("name")).collect()] == ["/d/a.txt"]
    assert [row["path"] for row in read_one_file(files, "c.txt").collect()] == ["/d/c.txt"]


def test_files_are_written_whole_and_again(spark, tmp_path):
    rows = [(1, "one"), (2, "é"), (1, "more"), (3, None), (None, "no key"), (4, "")]
    df = spark.createDataFrame(rows, "k long, line string")
    for _ in range(2):  # a second run puts the same files in place
        write_files(df, str(tmp_path / "files"), "k", "line", 3)
    files = [one for one in (tmp_path / "files").rglob("*") if one.is_file()]
    # nothing but the files: no check sums, nothing half written
    assert {one.suffix for one in files} == {".txt"} and len(files) == 5
    found = {one.parent.name: sorted(one.read_bytes().splitlines(True)) for one in files}
    assert found == {
        "k=1": [b"more\n", b"one\n"],
        "k=2": ["é\n".encode()],
        "k=3": [b"\n"],
        "k=4": [b"\n"],
        "k=__HIVE_DEFAULT_PARTITION__": [b"no key\n"],
    }
    write_files(df.limit(0), str(tmp_path / "none"), "k", "line", 3)
    assert read_binary_files(spark, str(tmp_path / "none")).count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    folders = 40 * spark.sparkContext.defaultParallelism
    write_files(spark.range(folders).withColumn("line", F.lit("x")), str(tmp_path / "many"), "id", "line", 4)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        files = read_binary_files(spark, str(tmp_path / "many"))
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("listing")]
        tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 16 * spark.sparkContext.defaultParallelism
    assert files.count() == folders and spark.conf.get(key) == before


def test_page_files_are_written_by_all_cores(spark, tmp_path):
    from pathlib import Path

    from checks.queries import _page_files, src_binary_files

    rows = [(at, f"page {at}") for at in range(40)] + [(3, "page 3")]
    pages = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    written = list(Path(_page_files(spark, str(tmp_path)).removeprefix("file:")).glob("page_id=*/*.txt"))
    # one file for each page, by more than the one task that the table gives
    assert len(written) == 40
    assert len({one.name.split("-")[1] for one in written}) > 1
    found = {row["page_id"]: row["length"] for row in src_binary_files(spark, str(tmp_path)).collect()}
    assert found == {at: (14 if at == 3 else len(f"page {at}") + 1) for at in range(40)}
