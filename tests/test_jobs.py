from aisleflow.jobs import main
from aisleflow.sources.tables import overwrite_table, read_table
from aisleflow.streaming.retail import raw_messages
from tests.conftest import leading_zeros, rows
from tests.test_goldens import PROFILE


def test_stream_job(spark, tmp_path):
    overwrite_table(spark.createDataFrame([(2,)], "rackId INT"), str(tmp_path / "racks"))
    categories = spark.createDataFrame([(2, 2, "cat2")], "rackId INT, categoryId INT, categoryName STRING")
    overwrite_table(categories, str(tmp_path / "category"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(leading_zeros()))
    main([
        "stream", "--once", "--messages", str(tmp_path / "in"), "--racks", str(tmp_path / "racks"),
        "--category", str(tmp_path / "category"), "--root", str(tmp_path / "out"), "--legacy",
    ], spark)
    sold = read_table(spark, str(tmp_path / "out/product")).filter("product = 'dailyCategorySaleWithCountAgg'")
    assert rows(sold, "day", "month", "year", "saleCountAgg") == [(10, 1, 123, 5), (13, 1, 123, 5)]


def test_archive_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\n\ntwo\n")
    main(["archive", "--once", "--messages", str(tmp_path / "in"), "--root", str(tmp_path / "out")], spark)
    assert sorted(r.msg for r in raw_messages(spark, str(tmp_path / "out")).collect()) == ["", "one", "two"]


def test_allergen_job_adds_nothing_the_second_time(spark, tmp_path):
    fields = "orgId STRING, storeId STRING, userId STRING, orderId STRING, Allergens STRING"
    overwrite_table(spark.createDataFrame(PROFILE, fields), str(tmp_path / "profile"))
    for _ in range(2):
        main(["allergens", "--profile", str(tmp_path / "profile"), "--output", str(tmp_path / "out")], spark)
        assert rows(read_table(spark, str(tmp_path / "out"))) == [
            ("north", "k1", "kim", a) for a in ("egg", "milk", "nuts", "soy")
        ]
