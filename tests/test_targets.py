import pytest

from fixtures import CLOSED, SHOP, write_targets
from pagetide.sources.targets import active_targets, check_targets, load_targets, read_targets, rejected_targets


def test_targets_load(spark, tmp_path):
    targets = load_targets(spark, write_targets(tmp_path))
    assert [(r["app_id"], r["active"], r["notes"]) for r in targets.orderBy("row_number").collect()] == [
        (SHOP, True, "first"), (CLOSED, False, None)
    ]
    assert [r["app_id"] for r in active_targets(targets).collect()] == [SHOP]


def test_first_bad_row_raises_with_its_number(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("notes,app_id,app_name,active\n,1,A,true\n,12a,Mixed,true\n,,Blank,\n,4,D,maybe\n,5,E,\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Row 3: app_id must be numeric"):
        load_targets(spark, str(path))
    rejected = rejected_targets(check_targets(read_targets(spark, str(path)))).orderBy("row_number").collect()
    assert [(r["row_number"], r["reject_reason"]) for r in rejected] == [
        (3, "app_id must be numeric"), (4, "app_id is required"), (5, "Invalid boolean value: maybe")
    ]
    kept = load_targets(spark, str(path), strict=False).orderBy("row_number").collect()
    assert [(r["app_id"], r["active"]) for r in kept] == [("1", True), ("5", True)]


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_targets(spark, str(tmp_path / "none.csv"))
    path = tmp_path / "short.csv"
    path.write_text("app_id,notes\n1,x\n", encoding="utf-8")
    with pytest.raises(ValueError, match="active, app_name"):
        load_targets(spark, str(path))


def test_row_numbers_are_exact_when_a_file_is_read_in_splits(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("app_id,app_name,active,notes\n" + "".join(f"{i},n{i},true,x\n" for i in range(5000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = read_targets(spark, str(path))
        assert rows.rdd.getNumPartitions() > 1
        assert rows.filter("row_number <> cast(app_id as int) + 2").count() == 0
        assert rows.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
