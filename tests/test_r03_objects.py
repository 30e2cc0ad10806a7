"""Findings of round 3 on objects."""

from framecat.session import scratch_path
from framecat.sources import objects


def test_f4_f7_objects_are_written_by_tasks_under_their_names(spark):
    """No commit of the driver moves objects, so none of its traces are there; texts of one key are one object."""
    path = scratch_path(spark, "put")
    rows = spark.createDataFrame([(f"p={i % 3}/{i}.txt", f"text {i}\n") for i in range(50)] + [("p=0/0.txt", "more\n")], "key string, text string")
    assert objects.put_objects(rows, path) == 50
    found = {r.path.rpartition("p=")[2]: r for r in objects.scan(spark, path, lambda b: {"head": b.decode()}, "head string", 100).collect()}
    assert len(found) == 50 and all(r.error is None for r in found.values())
    assert found["0/0.txt"].head == "more\ntext 0\n" and found["1/1.txt"].length == 7


def test_f4_f7_nothing_to_put(spark):
    assert objects.put_objects(spark.createDataFrame([], "key string, text string"), scratch_path(spark, "put")) == 0
