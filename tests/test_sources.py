"""CSV import and sinks, with files written by the test."""

from datetime import date

import pytest

from tenderlake.sources import ingest, tables
from tenderlake.storage import materialize, shared_folder
from tests.conftest import rows

HEADER = "BID_#,FISCAL,DESTINATION_NO,BID_DUE_DATE,TOTAL_QTY_TY,ROLLOVER,BID_NAME,NOTE\n"


def test_import_of_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '7,2019.0,H1,31/12/2019 10:00:00,3.5,Y,"Café, è",n\n', "utf-8")
    (tmp_path / "b.csv").write_text(HEADER + "x,2018,66061-7888,bad,oops,,Plain,\n", "utf-8")
    (tmp_path / "skip.txt").write_text("no")
    got = ingest.import_bids(spark, str(tmp_path))
    assert got.columns == ["bid_no", "fiscal", "destination_no", "bid_due_date", "total_qty_ty", "rollover", "bid_name", "note"]
    assert dict(got.dtypes)["bid_due_date"] == "date" and dict(got.dtypes)["rollover"] == "boolean"
    assert rows(got) == [
        (7, 2019, "H1", date(2019, 12, 31), 3.5, True, "Cafe, e", "n"),
        (None, 2018, "66061-7888", None, None, None, "Plain", None)]


def test_latin_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((HEADER + "1,2019,H1,,1,N,Québec,\n").encode("latin-1"))
    assert rows(ingest.import_bids(spark, str(tmp_path), "ISO-8859-1"), "bid_name") == [("Quebec",)]


def test_files_with_other_columns_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("FISCAL,BID_NO\n2019,1\n")
    (tmp_path / "b.csv").write_text("BID_NO,FISCAL\n1,2019\n")
    with pytest.raises(Exception):
        ingest.import_bids(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("sep", [",", "|"])
def test_csv_round_trip(spark, tmp_path, sep):
    df = spark.createDataFrame([(1, 'a,"b"|c', None), (2, "x", 1.5)], "i int, t string, d double")
    tables.export_csv(df, str(tmp_path / "out"), sep)
    assert rows(tables.read_csv(spark, str(tmp_path / "out"), "i int, t string, d double", sep)) == rows(df)


def test_replace_snapshot_and_publish(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        tables.replace_table(df, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 3
    tables.write_snapshot(df, str(tmp_path / "s"))
    assert tables.read_snapshot(spark, str(tmp_path / "s")).count() == 3
    where = tables.publish(df, str(tmp_path / "prod"), str(tmp_path / "dev"), "card.csv", to_prod=False)
    assert where == str(tmp_path / "dev" / "card.csv")
    assert tables.read_csv(spark, where, sep="|").count() == 3


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    name = str(tmp_path / "t")
    tables.replace_table(spark.range(3), name)
    reader = tables.read_table(spark, name)
    broken = spark.range(8).repartition(4).selectExpr("if(id = 7, raise_error('lost'), id) as id")
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, name)
    assert tables.read_table(spark, name).count() == 3
    tables.replace_table(spark.range(5), name)
    # Who began before the switch still reads what was there.
    assert reader.count() == 3 and tables.read_table(spark, name).count() == 5
    tables.replace_table(spark.range(6), name)
    assert tables.read_table(spark, name).count() == 6
    kept = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith(tables.VERSION)]
    assert len(kept) == 3  # the last two, and the unfinished one, which nothing points to


def test_plain_folders_are_tables_too(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 4
    tables.replace_table(spark.range(2), str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 2


def test_partitioned_table_has_few_files(spark, tmp_path):
    df = spark.range(1000).repartition(8).selectExpr("id", "cast(id % 2 + 2018 as int) as fiscal")
    tables.replace_table(df, str(tmp_path / "t"), ["fiscal"])
    back = tables.read_table(spark, str(tmp_path / "t"))
    assert back.count() == 1000 and dict(back.dtypes)["fiscal"] == "int"
    assert len(back.inputFiles()) == 2
    plan = back.where("fiscal >= 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscal" in plan


def test_dated_names():
    run = date(2020, 1, 15)
    assert tables.dated("bid_target", run) == "bid_target_2020_01_15"
    assert tables.scored_file_name(run, "2020-01-16-08.00.00") == "ai.2020-01-16-08.00.00.bid_scored_sheet_2020_01_15.csv"


def test_model_round_trip(spark, tmp_path):
    from tenderlake.plans import modeling

    data = spark.createDataFrame([(str(i), float(i), float(2 * i)) for i in range(20)], "key string, n double, target double")
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[modeling.preparation(data), modeling.random_forest(2, 2)]).fit(data)
    tables.save_model(model, str(tmp_path / "m"))
    again = tables.load_model(str(tmp_path / "m"))
    assert rows(again.transform(data), "key", "Predicted_price") == rows(model.transform(data), "key", "Predicted_price")


def test_written_tables_live_in_the_shared_folder(spark):
    df = materialize(spark.range(5), "probe")
    assert all(f.startswith("file://" + shared_folder(spark)) for f in df.inputFiles())
    assert df.count() == 5
