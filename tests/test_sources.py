from deidlake.sources.parquet import list_tables
from deidlake.sources.zones import zone_path

import pytest


def test_parquet_database_listing(spark, tmp_path):
    db = str(tmp_path / "db")
    spark.range(3).write.parquet(f"{db}/alpha.parquet")
    spark.range(2).write.parquet(f"{db}/beta.parquet")
    (tmp_path / "db" / "notes.txt").write_text("not a table")
    assert list_tables(spark, db) == ["alpha", "beta"]


def test_zone_path_keeps_schema():
    assert zone_path("/lake", "silver", "dbo.T") == "/lake/silver/dbo.T"
    assert zone_path("/lake/", "gold", "other.T") != zone_path("/lake", "gold", "dbo.T")
    with pytest.raises(ValueError):
        zone_path("/lake", "platinum", "dbo.T")
