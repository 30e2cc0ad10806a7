"""Findings of the round on checks of payload texts."""

import io
from contextlib import redirect_stdout

from framecat.operators import quality


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def lines(spark, tmp_path):
    texts = ['{"a":{"b":1},"c":[{"d":"x"},{"d":2},null],"e":[[{"f":1.0}],[]]}', "{broken", None, '{"a":[1],"c":{"d":1},"e":[3]}']
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(str(tmp_path / "lines"))
    return spark.read.parquet(str(tmp_path / "lines"))


def test_types_are_checked_in_one_pass(spark, tmp_path):
    """Before, every list was a scan of its own that parsed all texts again."""
    told = quality.check_types(lines(spark, tmp_path), {"$.a": "object", "$.a.b": "int", "$.c": "array", "$.c[*].d": "string", "$.e[*][*].f": "float"})
    text = plan(told)
    assert text.count("FileScan") == 1 and text.count("parseJson") == 1
    assert {r.field: (r.missing, r.wrong_type, r.expected) for r in told.collect()} == {
        "$.a": (2, 1, 4), "$.a.b": (3, 0, 4), "$.c": (2, 1, 4), "$.c[*].d": (1, 1, 3), "$.e[*][*].f": (0, 0, 1),
    }


def test_undeclared_fields_are_found_in_one_pass(spark, tmp_path):
    """Before, every object and list was a scan of its own, and every object's whole schema was told to see that it is one."""
    told = quality.undeclared_fields(lines(spark, tmp_path), {"$": ["a", "c"], "$.c[*]": [], "$.a": ["x"]})
    text = plan(told)
    assert text.count("FileScan") == 1 and text.count("parseJson") == 1 and "schemaOfVariant" not in text
    assert {(r.path, r.field, r.row_count) for r in told.collect()} == {("$", "e", 2), ("$.c[*]", "d", 2), ("$.a", "b", 1)}
