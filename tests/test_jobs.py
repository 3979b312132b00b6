"""Whole jobs on small frames in the delivery vocabulary."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.calendar import WorkCalendar
from millrace.operators import capacity
from millrace.plans import jobs
from millrace.sources import readers

CAL = WorkCalendar.national(2023, 2026)

TIMES = """requesttimestamp affido_consolidatore_data stampa_imbustamento_con080_data materialita_pronta_con09a_data
affido_recapitista_con016_data accettazione_recapitista_con018_data tentativo_recapito_data tentativo_recapito_data_rendicontazione
messaingiacenza_recapito_data_rendicontazione certificazione_recapito_data certificazione_recapito_data_rendicontazione
fine_recapito_data fine_recapito_data_rendicontazione accettazione_23l_recag012_data accettazione_23l_recag012_data_rendicontazione
demat_23l_ar_data_rendicontazione demat_plico_data_rendicontazione demat_arcad_data_rendicontazione
causa_forza_maggiore_data causa_forza_maggiore_data_rendicontazione""".split()
TEXTS = """iun requestid prodotto senderpaid geokey recapitista recapitista_unificato lotto codice_oggetto scarto_consolidatore_stato
tentativo_recapito_stato messaingiacenza_recapito_stato certificazione_recapito_stato certificazione_recapito_dettagli fine_recapito_stato
demat_23l_ar_stato demat_plico_stato statusrequest causa_forza_maggiore_dettagli province_name region_name""".split()
NUMBERS = "costo_recapitista numero_pagine pcretry_rank prezzo_ente costo_consolidatore".split()
SCHEMA = ", ".join([f"{c} timestamp" for c in TIMES] + [f"{c} string" for c in TEXTS] + [f"{c} bigint" for c in NUMBERS])


def gold(spark, rows):
    data = [tuple(r.get(c) for c in [*TIMES, *TEXTS, *NUMBERS]) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


def d(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


def delivered(i, **other):
    """A direct delivery accepted on 7 October, attempted a week later."""
    row = dict(
        iun=f"I{i}", requestid=f"R{i}", prodotto="890", geokey="00100", recapitista="Poste", lotto="1", codice_oggetto="69001", statusrequest="ok",
        affido_recapitista_con016_data=d(10, 6), accettazione_recapitista_con018_data=d(10, 7), tentativo_recapito_data=d(10, 16),
        tentativo_recapito_data_rendicontazione=d(10, 17), certificazione_recapito_data=d(10, 16), certificazione_recapito_data_rendicontazione=d(10, 17),
        fine_recapito_data=d(10, 16), fine_recapito_data_rendicontazione=d(10, 25), tentativo_recapito_stato="RECAG001A",
        certificazione_recapito_stato="RECAG001A", fine_recapito_stato="RECAG001C", demat_23l_ar_data_rendicontazione=d(10, 18), costo_recapitista=1000,
    )
    return {**row, **other}


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([("00100", "AM", "RM", "Lazio"), ("80100", "AM", "NA", "Campania")], "cap string, area string, provincia string, regione string")


@pytest.fixture(scope="module")
def incidents(spark):
    return spark.createDataFrame([("R3", "Poste", 2)], "requestid string, recapitista_corretto string, lotto_corretto int")


def test_carrier_penalty(spark, areas, incidents):
    rows = [
        delivered(1),  # 7 working days, improved offer 4: in the standard, late by 3
        delivered(2, tentativo_recapito_data=d(10, 9)),  # 2 days: in time
        delivered(3, recapitista="FSU"),  # corrected to another carrier and lot 2
        delivered(4, fine_recapito_stato="RECAG004"),  # stolen
        delivered(5, statusrequest="PN999"),
        delivered(6, accettazione_recapitista_con018_data=d(6, 3), affido_recapitista_con016_data=d(6, 2)),  # other quarter
        delivered(7, demat_23l_ar_data_rendicontazione=None),  # receipt scan missing
        delivered(8, tentativo_recapito_data=d(10, 31)),  # 18 days: beyond the standard
        delivered(9, fine_recapito_data_rendicontazione=dt.datetime(2025, 1, 20)),  # closed more than 60 days late
    ]
    base = jobs.penalty_base(gold(spark, rows), incidents, areas, carriers=["Poste", "FSU"], year=2024, quarter=4)
    assert sorted(r["requestid"] for r in base.collect()) == ["R1", "R2", "R3", "R8"]
    rules = spark.createDataFrame(
        [(1, "1", None, "Poste", None, None, d(10, 1), d(10, 31, 23), 2, 1)],
        "rule_id int, lotto string, prodotto string, recapitista string, regione string, provincia string, start timestamp, end timestamp, sla_relax_value int, flag_giorni_lav int",
    )
    detail = {r["requestid"]: r for r in jobs.carrier_penalty(base, rules, CAL).collect()}
    one = detail["R1"]
    assert (one["tempo_recapito"], one["giorni_offerta_standard"], one["giorni_offerta_migliorativa"]) == (7, 7, 4)
    assert (one["sla_standard"], one["sla_migliorativa"], one["ritardo_recapito"]) == (True, False, 3)
    # Lot 1 holds R2, R1, R8 in this order: shares 1/3, 2/3, 1.
    assert (one["rank"], one["total"], one["fee_cents"], one["weighted_cents"]) == (2, 3, 150, 75)
    assert detail["R2"]["fee_cents"] == 0 and detail["R8"]["fee_cents"] == 0 and detail["R8"]["ritardo_recapito"] == 14
    assert detail["R3"]["lotto"] == "2" and detail["R3"]["recapitista"] == "Poste"
    # Reporting: 7 working days against 2 relaxed ones; lot 2 has no relaxation.
    assert (one["tempo_rendicontazione"], one["ritardo_rendicontazione"]) == (7, 5)
    assert (detail["R3"]["tempo_rendicontazione"], detail["R3"]["sla_finale"], detail["R3"]["ritardo_rendicontazione"]) == (9, 7, 2)
    summary = {r["lotto"]: r for r in jobs.carrier_penalty_summary(jobs.carrier_penalty(base, rules, CAL)).collect()}
    assert summary["1"]["items"] == 3 and summary["1"]["recapito_cents"] == 75 and summary["1"]["quarter"] == 4


def test_print_runs_continue(spark):
    rows = [
        dict(requestid=f"R{i:02d}", numero_pagine=60_000, requesttimestamp=d(5, 2 + i // 5, 9), stampa_imbustamento_con080_data=d(5, 10)) for i in range(10)
    ]
    first = jobs.print_schedule(gold(spark, rows[:5]), CAL)
    days = {r["requestid"]: r["data_slittamento"] for r in first.collect()}
    assert [days[f"R{i:02d}"].day for i in range(5)] == [2, 2, 2, 3, 3]
    state = capacity.last_state(first, pages="numero_pagine", day="data_slittamento", rank="ranking")
    second = jobs.print_schedule(gold(spark, rows), CAL, done=first, state=state)
    later = {r["requestid"]: (r["data_slittamento"].day, r["ranking"]) for r in second.collect()}
    # One more fits the third, then Monday and Tuesday follow.
    assert later == {"R05": (3, 6), "R06": (6, 7), "R07": (6, 8), "R08": (6, 9), "R09": (7, 10)}
    charged = {r["data_slittamento"].day: (r["late_days"], r["penalty"]) for r in jobs.print_penalty(first, CAL).collect()}
    assert charged == {2: (4, 1400), 3: (3, 900)}


def test_pickup_uses_second_choice(spark):
    ready = [None, None, d(5, 15), d(5, 16), d(5, 15)]
    rows = [dict(requestid=f"R{i}", stampa_imbustamento_con080_data=d(5, 4), materialita_pronta_con09a_data=t) for i, t in enumerate([*ready, None])]
    got = jobs.pickup_penalty(gold(spark, rows), CAL).collect()
    # Saturday counts as Monday the 6th; "not ready" is the mode, the 15th follows.
    assert [(str(r["print_day"]), str(r["pickup_day"]), r["late_days"], r["penalty"]) for r in got] == [("2024-05-06", "2024-05-15", 5, 750)]


def test_supplier_backlog(spark):
    rows = [
        dict(iun="A", requestid="R1", pcretry_rank=1, statusrequest="ok", requesttimestamp=d(5, 6)),
        dict(iun="B", requestid="R2", pcretry_rank=1, statusrequest="ok", requesttimestamp=d(5, 6), fine_recapito_stato="X"),
        dict(iun="C", requestid="R3", pcretry_rank=1, statusrequest="error", requesttimestamp=d(5, 6)),
        dict(iun="D", requestid="R4", pcretry_rank=1, statusrequest="ok", requesttimestamp=d(5, 6)),
        dict(iun="E", requestid="R5", pcretry_rank=1, statusrequest="ok", requesttimestamp=d(5, 6)),
    ]
    notified = spark.createDataFrame([("A", "OK"), ("B", "OK"), ("C", "OK"), ("D", "CANCELLED"), ("E", "OK")], "iun string, actual_status string")
    got = jobs.supplier_backlog(gold(spark, rows), notified, spark.createDataFrame([("E",)], "iun string"), CAL, dt.date(2024, 5, 14))
    assert [(r["iun"], r["stage"], r["waiting_days"], r["excess_days"]) for r in got.collect()] == [("A", "Stampa Imbustamento", 6, 4)]


def test_force_majeure_news(spark):
    rows = [
        dict(requestid="R1", codice_oggetto="R14A", causa_forza_maggiore_dettagli=" C01", causa_forza_maggiore_data_rendicontazione=d(5, 6, 9), geokey="00100"),
        dict(requestid="R2", codice_oggetto="ZZ", causa_forza_maggiore_dettagli="C99", causa_forza_maggiore_data_rendicontazione=d(5, 7, 23)),
        dict(requestid="R3", codice_oggetto="ZZ", causa_forza_maggiore_dettagli="C02", causa_forza_maggiore_data_rendicontazione=d(5, 8)),
    ]
    now = jobs.force_majeure(gold(spark, rows), dt.date(2024, 5, 6), dt.date(2024, 5, 7))
    assert {r["requestid"]: (r["recapitista"], r["causa_forza_maggiore_descrizione"]) for r in now.collect()} == {
        "R1": ("Fulmine", "Incendio"), "R2": ("NON_VALORIZZATO", "Causale non rendicontata"),
    }
    fresh, summary = jobs.force_majeure_news(now, now.filter("requestid = 'R1'"))
    assert [r["requestid"] for r in fresh.collect()] == ["R2"]
    assert [tuple(r) for r in summary.collect()] == [(dt.date(2024, 5, 7), "NON_VALORIZZATO", "NON DISPONIBILE", "NON DISPONIBILE", 1)]


def test_sender_penalties(spark):
    invoiced = spark.createDataFrame(
        [(f"I{i}", "0", "REFINEMENT", d(1, 2), d(12, 2)) for i in range(4)], "iun string, recindex string, category string, data_deposito timestamp, data_fatturazione timestamp"
    )
    rows = []
    for i, end in enumerate(["2024-02-01", "2024-05-20", "2024-06-20", "2024-07-20"]):
        rows.append((f"I{i}", "SEND_ANALOG_FEEDBACK", f"{end} 00:00:00", f"{'x' * 21}Q{i}.ATTEMPT_1"))
        rows.append((f"I{i}", "SEND_ANALOG_FEEDBACK", "2024-01-10 00:00:00", f"{'x' * 21}Q{i}.ATTEMPT_0"))
        rows.append((f"I{i}", "DIGITAL_SUCCESS_WORKFLOW", f"{end} 00:00:00", "z"))
    timeline = spark.createDataFrame(rows, "iun string, category string, timestamp string, timelineelementid string")
    items = gold(spark, [dict(requestid=f"{'y' * 24}Q0.ATTEMPT_1", pcretry_rank=1, codice_oggetto="R14", costo_recapitista=5)])
    got = {r["iun"]: r for r in jobs.sender_analogue(invoiced, timeline, items, CAL).collect()}
    assert got["I0"]["late_days"] == 0 and got["I0"]["recapitista"] == "Fulmine" and got["I1"]["recapitista"] is None
    assert [got[f"I{i}"]["rank"] for i in range(4)] == [1, 2, 3, 4]
    assert [got[f"I{i}"]["charged"] for i in range(4)] == [0, 1, 1, 0]
    digital = jobs.sender_digital(invoiced, timeline, CAL).first()
    assert (digital["items"], digital["late"]) == (4, 3) and digital["penalty"] == pytest.approx((0.75 - 0.01) * 4 * 0.2)


def test_ingestion_feeds(spark):
    lines = [
        {"eventname": "INSERT", "p_year": "2024", "p_month": "01", "p_day": "05", "dynamodb": {"newimage": {"category": {"s": c}, "pk": {"s": p}, "sk": {"s": s}}}}
        for c, p, s in [("X", "AB#1", "LEGAL#1"), ("VALIDATE_NORMALIZE_ADDRESSES_REQUEST", "CO#1", "TOS#1"), ("X", "AB#1", "OTHER")]
    ]
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in lines]))
    day = {"p_year": "2024", "p_month": "01", "p_day": "05"}

    def n(feed):
        return readers.ingestion_count(df, day, readers.feed_condition(feed)).first()[0]

    assert [n(f) for f in ("notification", "timeline", "mandate", "user_attributes", "registry")] == [3, 2, 3, 2, 3]
    assert readers.ingestion_count(df, {**day, "p_day": "06"}).first()[0] == 0


def test_progress_and_rate_matrix(spark):
    from millrace.plans.domain import item_table, rate_card, zones
    import os

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    items = jobs.progress(item_table(spark, folder))
    assert items.filter(F.col("stato_avanzamento_oggetti").isNull()).count() == 0
    matrix = jobs.rate_matrix(rate_card(spark, folder), zones(spark, folder), start="2025-01-01T00:00:00.000Z")
    assert matrix.filter("product IN ('RIS', 'RIR')").count() > 0 and matrix.filter("costo IS NULL OR costo_plico IS NULL").count() == 0
