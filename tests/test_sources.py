import datetime
import os

import pytest
from pyspark.sql import functions as F

from studylake import schemas, session
from studylake.quality import audit
from studylake.sources import raw, tables


def day():
    return F.lit("2024-01-09").cast("date")


def now():
    return F.lit("2024-01-10 00:00:00").cast("timestamp")


@pytest.fixture
def folder(tmp_path):
    files = {
        "b.csv": 'k,v\n1,"x"\n2,"two\nlines"\n',
        "a.CSV": "k,v\n5,y\n",
        "empty.csv": "k,v\n",
        "notes.txt": "no\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_raw_columns_stay_text(spark, tmp_path):
    path = tmp_path / "vle.csv"
    path.write_text("id_site,code_module,code_presentation,activity_type,week_from,week_to\n"
                    "7,AAA,2013J,quiz,?,\n")
    row = raw.read_raw(spark, str(path), schemas.raw_schema("vle")).first()
    assert row["id_site"] == "7" and row["week_from"] == "?" and row["week_to"] is None
    inferred = raw.read_raw(spark, str(path), infer=True)
    assert dict(inferred.dtypes)["id_site"] == "int"
    with pytest.raises(ValueError):
        raw.read_raw(spark, str(path))


def test_discovery(spark, folder, tmp_path):
    assert [r["file_name"] for r in raw.discover(spark, folder).collect()] == [
        "a.CSV", "b.csv", "empty.csv"]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no CSV"):
        raw.discover(spark, str(tmp_path / "none"))


def test_source_counts_of_any_file_name(spark, tmp_path):
    sizes = {"a b": 2, "c%20d": 1, "e+f": 3, "\u00fcber \u00e9t\u00e9": 4, "header only": 0, "UP.CSV": 1}
    for name, n in sizes.items():
        file = tmp_path / (name if name.endswith(".CSV") else f"{name}.csv")
        file.write_text("k,v\n" + "1,x\n" * n)
    counts = raw.source_row_counts(spark, str(tmp_path), day(), now())
    assert {r["source_file"]: r["row_count"] for r in counts.collect()} == sizes


def test_source_counts(spark, folder, rows):
    counts = raw.source_row_counts(spark, folder, day(), now(), multiline=True)
    assert [(r["source_file"], r["row_count"]) for r in counts.collect()] == [
        ("a.CSV", 1), ("b", 2), ("empty", 0)]
    assert counts.first()["LoadDate"] == datetime.date(2024, 1, 9)


def test_audit_trail_is_idempotent(spark, folder, rows):
    counts = raw.source_row_counts(spark, folder, day(), now(), multiline=True)
    once = audit.record_audit(None, counts)
    assert rows(audit.record_audit(once, counts)) == rows(once)
    later = counts.withColumn("LoadDate", F.date_add("LoadDate", 1))
    report = audit.audit_report(audit.record_audit(once, later)).collect()
    assert len(report) == 6 and report[0]["LoadDate"] == datetime.date(2024, 1, 10)


def test_bronze_is_created_once(spark, tmp_path):
    lake = tables.Lake(spark, str(tmp_path / "lake"))
    first = tables.ingest_bronze(spark.range(2), now())
    assert lake.create("bronze", "t", first).count() == 2
    assert lake.create("bronze", "t", tables.ingest_bronze(spark.range(9), now())).count() == 2
    assert first.first()["ingestion_date"] == datetime.date(2024, 1, 10)
    path = str(tmp_path / "plain")
    tables.create_table(spark.range(2), path)
    tables.create_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 2


def test_versions(spark, tmp_path):
    lake = tables.Lake(spark, str(tmp_path / "lake"))
    assert lake.read("silver", "t") is None
    current = lake.write("silver", "t", spark.range(3))
    assert lake.write("silver", "t", current.union(spark.range(1))).count() == 4
    os.makedirs(tmp_path / "lake" / "silver" / "t" / "v000009")  # unfinished: no marker
    assert lake.read("silver", "t").count() == 4
    assert lake.write("silver", "t", spark.range(7)).count() == 7
    assert lake.retire("silver", "t") == [1, 2, 9] and lake.read("silver", "t").count() == 7
    assert os.listdir(tmp_path / "lake" / "silver" / "t") == ["v000010"]
    assert lake.retire("silver", "t") == [] and lake.retire("silver", "none") == []
    with pytest.raises(ValueError):
        lake.retire("silver", "t", keep=0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        spark.range(1).write.mode("error").parquet(lake.path("silver", "t", 10))


def test_scratch_tables_go_with_their_run(spark):
    with session.scratch_run(spark) as folder:
        kept = session.materialize(spark.range(3))
        assert kept.count() == 3 and session.scratch_folder(spark) == folder
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and session.scratch_folder(spark) != folder


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session())


def test_store_assignment(spark):
    frame = spark.createDataFrame([("F", "Pass  ", 5)], "g string, r string, n bigint")
    stored = tables.to_schema(frame, "g char(3), r varchar(4), n int")
    assert tuple(stored.first()) == ("F  ", "Pass", 5)
    with pytest.raises(Exception, match="exceeds 3 characters"):
        tables.to_schema(frame, "r varchar(3)").collect()
    with pytest.raises(Exception, match="OVERFLOW"):
        big = spark.createDataFrame([(2**40,)], "n bigint")
        tables.to_schema(big, "n int").collect()


def test_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), "id int", path)
    tables.overwrite_table(spark.range(2), "id int", path)
    assert spark.read.parquet(path).count() == 2
    log = str(tmp_path / "log")

    def results(table, day):
        names = [f.split(" ")[0] for f in schemas.CHECK_RESULT.split(", ")]
        known = {"layer_name": F.lit("BRONZE"), "table_name": F.lit(table), "checked_at": F.lit(day)}
        return spark.range(2).select(*[known.get(n, F.lit(None)).alias(n) for n in names])

    tables.append_results(results("a", "2024-01-01 00:00:00"), log)
    tables.append_results(results("b", "2024-01-01 00:00:00"), log)
    tables.append_results(results("a", "2024-01-01 00:00:00"), log)
    assert tables.read_results(spark, log).count() == 4
    tables.append_results(results("a", "2024-01-02 00:00:00"), log)
    found = tables.read_results(spark, log)
    assert found.count() == 6 and found.select("checked_at").distinct().count() == 2
