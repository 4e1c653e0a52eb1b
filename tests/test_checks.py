import pytest

from tagledger.operators.checks import STAR_CHECKS, Check, run_checks
from tagledger.session import stage


@pytest.fixture
def tables(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1, 5.0), (3, -1.0), (3, None), (None, 2.0)], "parent_id int, mrp double")
    return {"parent": parent, "child": child}


@pytest.mark.parametrize(
    ("check", "failures"),
    [
        (Check("unique", "parent", "id"), 1),
        (Check("unique", "child", "mrp"), 0),
        (Check("not_null", "parent", "id"), 1),
        (Check("not_null", "child", "mrp"), 1),
        (Check("relationship", "child", "parent_id", "parent", "id"), 2),
        (Check("empty", "child", "mrp", predicate="mrp < 0"), 1),
        (Check("empty", "child", "mrp", predicate="mrp < -5"), 0),
    ],
)
def test_failures_are_counted(tables, check, failures):
    row = run_checks(tables, [check]).first()
    assert (row["failures"], row["passed"]) == (failures, failures == 0)
    assert (row["test"], row["table"], row["column"]) == (check.test, check.table, check.column)


def test_report_has_one_row_per_check(tables):
    checks = [Check("not_null", "child", c) for c in ("parent_id", "mrp")] + [Check("unique", "parent", "id")]
    assert run_checks(tables, checks).count() == 3


def test_unknown_check(tables):
    with pytest.raises(ValueError):
        run_checks(tables, [Check("odd", "parent", "id")])


def test_the_standard_set():
    kinds = [c.test for c in STAR_CHECKS]
    assert {k: kinds.count(k) for k in set(kinds)} == {"unique": 5, "not_null": 12, "relationship": 4, "empty": 1}


def test_rows_and_small_parents_take_one_scan(tables, capsys):
    stored = {name: stage(df, name) for name, df in tables.items()}
    checks = [Check("not_null", "child", c) for c in ("parent_id", "mrp")]
    checks += [Check("empty", "child", "mrp", predicate="mrp < 0"), Check("relationship", "child", "parent_id", "parent", "id")]
    report = run_checks(stored, checks)
    report.explain()
    assert capsys.readouterr().out.count("FileScan") == 2  # the child and its parent
    assert [r["failures"] for r in report.collect()] == [1, 1, 1, 2]


def test_large_parent_is_joined_by_shuffle(tables, monkeypatch):
    from tagledger.operators import checks

    monkeypatch.setattr(checks, "fits_broadcast", lambda df: False)
    assert run_checks(tables, [Check("relationship", "child", "parent_id", "parent", "id")]).first()["failures"] == 2
