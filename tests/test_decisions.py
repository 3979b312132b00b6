import pytest
from pyspark.sql import functions as F

from millrace.functions.decisions import DecisionTable, changes
from millrace.operators import quality

OLD = DecisionTable("size", "1", (("big", "n > 10"), ("odd", "n % 2 = 1"), ("huge", "n > 100"), ("minus", "n < -1000")), "other")


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(n,) for n in (None, -3, 0, 1, 2, 11, 12, 101)], "n int")


def test_first_row_decides_and_null_does_not_hold(numbers):
    assert [r[0] for r in numbers.select(OLD.decide()).collect()] == ["other", "other", "other", "odd", "other", "big", "big", "big"]
    assert [r[0] for r in numbers.select(OLD.texts("+")).collect()] == ["", "", "", "odd", "", "big+odd", "big", "big+odd+huge"]


def test_coverage_names_rules_that_decide_nothing(numbers):
    got = [(r["position"], r["label"], r["held"], r["decided"], r["verdict"]) for r in OLD.coverage(numbers).orderBy("position").collect()]
    assert got == [(1, "big", 3, 3, "decides"), (2, "odd", 3, 1, "decides"), (3, "huge", 1, 0, "always covered"), (4, "minus", 0, 0, "never reached"), (5, "other", 8, 4, "decides")]
    assert [r["verdict"] for r in OLD.coverage(numbers.limit(0)).collect()] == ["never reached"] * 5


def test_changes_between_versions():
    new = DecisionTable("size", "2", (("odd", "n % 2 = 1"), ("big", "n > 20"), ("none", "n IS NULL")), "other")
    got = changes(OLD, new)
    assert ("removed", "huge", "n > 100", None) in got and ("added", "none", None, "n IS NULL") in got
    assert ("changed", "big", "n > 10", "n > 20") in got and {c[1] for c in got if c[0] == "moved"} == {"big", "odd"}
    assert changes(OLD, OLD) == []


def test_tables_are_checked():
    with pytest.raises(ValueError):
        DecisionTable("x", "1", ())
    with pytest.raises(ValueError):
        DecisionTable("x", "1", (("a", "true"), ("a", "true")))


def test_labels_of_both_state_lists():
    assert len(quality.PROGRESS_STATES.labels) == 14 and len(quality.REFINEMENT_STATES.labels) == 5
    assert set(quality.REFINEMENT_STATES.labels) < set(quality.PROGRESS_STATES.labels)


FLAGS = [*quality.CONTROL_FLAGS, *quality.MISSING_FLAGS, "flag_esiti_mancanti", "flag_wi7_report_postalizzazioni_incomplete", "flag_wi7_consolidatore", "flag_feedback_attempt_0"]


@pytest.mark.parametrize(
    "raised,final,reason,state,detail",
    [
        ([], "RECRN001C", None, "Oggetto con rendicontazione corretta in analisi Team Prodotto", "da perfezionare"),
        (["flag_feedback_attempt_0"], None, None, "Oggetto con rendicontazione corretta in analisi Team Prodotto", "bloccato al primo attempt"),
        (["controllo_causale", "assenza_inesito", "flag_esiti_mancanti"], "RECRN001C", None, "Errore rendicontazione/assenza eventi intermedi", "errore rend. causale, assenza inesito"),
        (["controllo_causale"], None, None, "Oggetto in corso di postalizzazione", ""),
        (["flag_wi7_consolidatore", "controllo_causale"], None, "M02", "Oggetto fuori sla", ""),
        ([], "RECRN001C", "M02", "Oggetto restituito al mittente (esito destinatario deceduto)", ""),
    ],
)
def test_refinement_lists(spark, raised, final, reason, state, detail):
    row = spark.range(1).select(*[F.lit(int(f in raised)).alias(f) for f in FLAGS], F.lit(final).cast("string").alias("fine_recapito_stato"), F.lit(reason).cast("string").alias("certificazione_recapito_dettagli"))
    got = row.select(quality.REFINEMENT_STATES.decide().alias("s"), quality.error_detail(quality.REFINEMENT_DETAILS).alias("d")).first()
    assert (got["s"], got["d"]) == (state, detail)
