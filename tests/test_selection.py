import pytest

from estate_hygiene.operators import report, selection
from estate_hygiene.sources import tables
from helpers import audit, records

T1, T11, T2 = "Tranche 1: Abandoned", "Tranche 1.1: Special", "Tranche 2: Large"


@pytest.fixture()
def sheet(spark):
    return audit(spark, {"dataset": "a", "tranche": T2}, {"dataset": "b", "tranche": T11}, {"dataset": "c", "tranche": T1})


@pytest.mark.parametrize("text,label", [("1", T1), ("1.1", T11), ("2", T2), (T2, T2), ("3", None), ("Tranche 2", None), ("x", None)])
def test_resolving_a_tranche(sheet, text, label):
    assert records(selection.resolve_tranche(sheet, text)) == ([(label,)] if label else [])


def test_an_exact_label_beats_the_shorthand(spark):
    sheet = audit(spark, {"dataset": "a", "tranche": "Tranche 7: x"}, {"dataset": "b", "tranche": "7"})
    assert records(selection.resolve_tranche(sheet, "7")) == [("7",)]


def test_the_first_of_several_matches_in_sheet_order(spark):
    sheet = audit(
        spark,
        {"dataset": "a", "tranche": "Tranche 1: small", "size_gb": 1.0},
        {"dataset": "b", "tranche": "Tranche 1: large", "size_gb": 2.0},
    )
    assert records(selection.resolve_tranche(sheet, "1")) == [("Tranche 1: large",)]


@pytest.mark.parametrize(
    "status,contains,starts",
    [("CONFIRMED: NO MODS > 1YR", True, True), ("UNCONFIRMED", True, False), ("REVIEW", False, False), ("confirmed", False, False), (None, False, False)],
)
def test_gates(spark, status, contains, starts):
    df = audit(spark, {"dataset": "d", "tranche": T1, "deletion_status": status})
    from pyspark.sql import functions as F

    got = df.select(selection.contains_confirmed(F.col("deletion_status")), selection.starts_confirmed(F.col("deletion_status")))
    assert tuple(got.first()) == (contains, starts)


def test_shorthand_reaches_exactly_one_target(spark):
    sheet = audit(
        spark,
        {"dataset": "d1", "tranche": T1},
        {"dataset": "d2", "tranche": T11},
        {"dataset": "d3", "tranche": T1, "deletion_status": "REVIEW"},
    )
    assert records(selection.select_targets(sheet, "1"), "dataset") == [("d1",)]
    assert records(selection.select_targets(sheet, "9"), "dataset") == []


def test_tranches_in_order_of_first_appearance(spark):
    deep = ["Tranche 2: Abandoned Large Prod (>1yr)", "Tranche 1: Abandoned Test/Temp (>1yr)"]
    sheet = audit(spark, *[{"dataset": str(i), "tranche": t} for i, t in enumerate([None, "Active", *deep, "Active"])])
    assert records(selection.list_tranches(sheet)) == [(deep[1],), (deep[0],), ("Active",), (None,)]


def test_notice_only_for_empty_plans(sheet):
    assert records(selection.notice_if_empty(sheet, "none")) == []
    assert records(selection.notice_if_empty(sheet.where("false"), "none")) == [("none",)]


def test_a_sheet_keeps_its_own_order(spark, tmp_path):
    rows = [("b", "Tranche 2: Large", 1.0), ("a", "Tranche 1: Abandoned", 9.0), ("b", "Tranche 1: Abandoned", 7.0)]
    text = "project,region,dataset,description,size_gb,monthly_cost,tranche\n" + "".join(f"p,eu,{d},x,{s},1.0,{t}\n" for d, t, s in rows)
    (tmp_path / "sheet.csv").write_text(text)
    sheet = tables.read_audit_csv(spark, str(tmp_path / "sheet.csv"))
    assert [r.tranche for r in selection.list_tranches(sheet).collect()] == ["Tranche 2: Large", "Tranche 1: Abandoned"]
    context = {r.key: r.size_gb for r in report.audit_context(sheet).collect()}
    assert context == {"p:a": 9.0, "p:b": 7.0}
