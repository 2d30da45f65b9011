import pytest

from sievework.operators import contract, quality
from sievework.sources import readers, writers
from sievework.specs import BOOKING


def test_csv_with_contract(spark, make_rows, tmp_path):
    raw = make_rows({}, {"lead_time": "x"})
    path = str(tmp_path / "csv")
    assert writers.write_csv(raw, path) == 2
    read = readers.read_csv(spark, path, BOOKING)
    assert read.columns == BOOKING.names
    assert sorted(read.collect()) == sorted(raw.collect())
    assert quality.clean_and_rejected(read, BOOKING)[0].count() == 1


def test_shuffled_header_is_refused(spark, make_rows, tmp_path):
    swapped = [BOOKING.names[1], BOOKING.names[0], *BOOKING.names[2:]]
    writers.write_csv(make_rows({}).select(swapped), str(tmp_path / "csv"))
    with pytest.raises(ValueError, match="order"):
        readers.read_csv(spark, str(tmp_path / "csv"), BOOKING)


def test_missing_path(spark, tmp_path):
    for read in (
        lambda p: readers.read_csv(spark, p, BOOKING),
        lambda p: readers.read_csv_inferred(spark, p),
    ):
        with pytest.raises(FileNotFoundError):
            read(str(tmp_path / "nothing"))


def test_written_rows_with_line_breaks_are_counted(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",), ("c",), ('d "e"',)], "t string")
    assert writers.write_csv(df, str(tmp_path / "csv")) == 3
    assert writers.write_csv(df.limit(0), str(tmp_path / "csv"), single_file=True) == 0


def test_rows_are_counted_without_the_record_of_the_write(spark, tmp_path, monkeypatch):
    """The count comes from the commit; where the session keeps no record, the files are read."""
    df = spark.range(5000).selectExpr("id", "concat('a', chr(10), id) AS t").orderBy("id")
    assert writers.committed_rows(spark, "nothing of the kind") is None
    with monkeypatch.context() as patch:
        patch.setattr(writers, "stored_rows", lambda *_: pytest.fail("the files were read"))
        assert writers.write_csv(df, str(tmp_path / "csv")) == 5000
    monkeypatch.setattr(writers, "committed_rows", lambda *_: None)
    assert writers.write_csv(df, str(tmp_path / "csv")) == 5000


def test_a_write_leaves_the_job_description_alone(spark, tmp_path):
    spark.sparkContext.setJobDescription("mine")
    writers.write_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.sparkContext.getLocalProperty("spark.job.description") == "mine"
    spark.sparkContext.setJobDescription(None)


def test_inferred_types_clean_alike(spark, make_rows, tmp_path):
    """Types inferred from the file do not change the result of the cleaning."""
    writers.write_csv(make_rows({}, {"avg_price_per_room": "0"}), str(tmp_path / "csv"))
    inferred = readers.read_csv_inferred(spark, str(tmp_path / "csv"))
    assert dict(inferred.dtypes)["lead_time"] == "int"
    clean, rejected = quality.clean_and_rejected(inferred, BOOKING)
    assert (clean.count(), rejected.count()) == (2, 0)


def test_embedded_header(spark):
    df = spark.createDataFrame([("id", "x"), ("1", "y"), (None, "z")], "id string, v string")
    assert [tuple(r) for r in readers.drop_embedded_header(df, "id").collect()] == [("1", "y")]


def test_column_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    found = [tuple(r) for r in contract.column_audit(df).orderBy("position").collect()]
    assert found == [(1, "a", "int", 1, 1, 2, 0), (2, "b", "string", 1, 1, 2, 1)]
