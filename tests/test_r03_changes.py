"""Findings of round 3 on changes."""

from framecat.operators import upsert


def test_f13_changes_against_known_headers_of_equal_time(spark):
    shape = "s3_bucket string, file_path_normalized string, mtime string, file_id string, header_hash string"
    known = [("b", "p", "2024", "x", h) for h in ("1", "3", "2")]
    batch = spark.createDataFrame([("b", "p", "3")], "s3_bucket string, file_path_normalized string, header_hash string")
    for order in (known, known[::-1], known[1:] + known[:1]):
        existing = spark.createDataFrame(order, shape).coalesce(1)
        assert [r.change for r in upsert.detect_changes(existing, batch).collect()] == ["unchanged"]
