"""Whole jobs on the delivery data model.

Each job composes operators over the wide item table (one row per mail-piece
attempt, milestones as ``*_stato``, ``*_data`` and ``*_data_rendicontazione``)
and the smaller tables beside it. Periods, calendars, tolerances and saved
states are arguments; nothing is written here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates, presets
from millrace.functions.calendar import WorkCalendar
from millrace.functions.rules import code_text, prefix_label
from millrace.functions.text import attempt_number
from millrace.operators import capacity, events, joins, penalty, quality, rates, stages
from millrace.operators.ordered import top_row
from millrace.streaming import incremental

ACCEPTED = "accettazione_recapitista_con018_data"
HANDED_OVER = "affido_recapitista_con016_data"


def carrier(code: str = "codice_oggetto", recorded: str | Column = "recapitista_unificato") -> Column:
    """Carrier from the item code, else the recorded one."""
    fallback = F.col(recorded) if isinstance(recorded, str) else recorded
    return prefix_label(code, presets.CARRIER_PREFIXES, fallback)


# -- carrier penalties --------------------------------------------------------


def penalty_base(gold: DataFrame, incidents: DataFrame, areas: DataFrame, *, carriers: Sequence[str], year: int, quarter: int, by_report: bool = False) -> DataFrame:
    """Items of a quarter that enter the penalty: corrected, complete, in time.

    The quarter is that of acceptance (hand-over plus one day without one), or
    of the final report with ``by_report``.
    """
    fixes = joins.enrich(
        gold, incidents, {"requestid": "requestid"}, {"__carrier": "recapitista_corretto", "__lot": "lotto_corretto"}
    )
    placed = joins.enrich(fixes, areas, {"geokey": "cap"}, {"area": "area", "provincia": "provincia", "regione": "regione"})
    name = F.coalesce("__carrier", "recapitista")
    split = (name == "FSU") & F.col("prodotto").isin("AR", "890", "RS")
    reports = ["tentativo_recapito", "messaingiacenza_recapito", "certificazione_recapito"]
    stamped = [f"{m}_data_rendicontazione" for m in reports]
    base = placed.withColumns(
        {
            "recapitista": F.when(split, F.concat(F.lit("FSU - "), "prodotto")).otherwise(name),
            "lotto": F.coalesce(F.col("__lot").cast("string"), "lotto"),
            ACCEPTED: dates.reference_date(ACCEPTED, HANDED_OVER),
            "prima_rendicontazione": dates.earliest(*stamped, "fine_recapito_data_rendicontazione"),
            "ultima_rendicontazione_senza_fine": dates.latest(*stamped),
            "__in": name.isin(list(carriers)),
        }
    )
    period = F.col("fine_recapito_data_rendicontazione" if by_report else ACCEPTED)
    final = F.col("fine_recapito_stato")
    kept = base.filter(
        F.col("__in")
        & F.col("fine_recapito_data_rendicontazione").isNotNull()
        & ~final.isin(presets.STOLEN_OR_UNREPORTABLE)
        & F.col("tentativo_recapito_stato").isNotNull()
        & F.col("certificazione_recapito_stato").isNotNull()
        & ~F.col("statusrequest").isin(presets.BLOCKED)
        & (F.year(period) == year)
        & (F.quarter(period) == quarter)
        & ~quality.excluded("fine_recapito_stato", quality.delivery_exclusions())
    )
    # A missing date makes the test unknown, and unknown items are dropped.
    slow_end = F.datediff("fine_recapito_data_rendicontazione", "ultima_rendicontazione_senza_fine") > 60
    slow_start = F.datediff(ACCEPTED, "prima_rendicontazione") > 60
    return kept.filter(~slow_end & ~slow_start).drop("__carrier", "__lot", "__in")


def carrier_penalty(base: DataFrame, relaxations: DataFrame, calendar: WorkCalendar, **ranking) -> DataFrame:
    """Delivery and reporting penalty per item.

    ``relaxations`` has lotto, prodotto, recapitista, regione, provincia,
    start, end, sla_relax_value, flag_giorni_lav and a rule_id; NULL in
    prodotto, regione or provincia matches anything.
    """
    where = dict(
        lot="lotto", product="prodotto", zone="area", relaxed=presets.RELAXED_OFFER, region="regione",
        date_cols={"accepted": ACCEPTED, "handed_over": HANDED_OVER, "entrusted": "affido_consolidatore_data"},
        conditioned=presets.CONDITIONED_OFFER, columns={"carrier": "recapitista", "sender": "senderpaid"},
    )
    unlimited = penalty.no_offer(presets.NO_IMPROVED_OFFER, lot="lotto", product="prodotto", zone="area")
    timed = penalty.with_delivery_days(
        base, calendar, accepted=ACCEPTED, handed_over=HANDED_OVER, attempt="tentativo_recapito_data",
        discard_state="scarto_consolidatore_stato", start="__start", days="tempo_recapito",
    ).drop("__start")
    offered = timed.withColumns(
        {
            "giorni_offerta_standard": penalty.offer_days(presets.STANDARD_OFFER, **where),
            "giorni_offerta_migliorativa": penalty.offer_days(presets.IMPROVED_OFFER, **where),
        }
    ).withColumns(
        {
            "sla_standard": penalty.within("tempo_recapito", "giorni_offerta_standard"),
            "sla_migliorativa": penalty.within("tempo_recapito", "giorni_offerta_migliorativa", unlimited),
            "ritardo_recapito": penalty.lateness("tempo_recapito", "giorni_offerta_standard", "giorni_offerta_migliorativa"),
        }
    )
    tie = ["fine_recapito_data_rendicontazione", "requestid"]
    measured = F.col("tempo_recapito").isNotNull()
    delivered = penalty.delivery_penalty(
        offered, group=["lotto", "prodotto"], tie=tie, late="ritardo_recapito", in_standard="sla_standard",
        in_improved="sla_migliorativa", cost="costo_recapitista", counted=measured, **ranking,
    )
    relaxed = joins.rule_join(
        delivered, relaxations,
        equal={"lotto": "lotto", "recapitista": "recapitista"},
        wildcard={"prodotto": "prodotto", "regione": "regione", "provincia": "provincia"},
        between=(ACCEPTED, "start", "end"), values=["sla_relax_value", "flag_giorni_lav"], rule_id="rule_id",
    ).withColumn("sla_finale", F.coalesce("sla_relax_value", penalty.reporting_allowance("lotto", "prodotto")))
    reported = penalty.with_reporting_lateness(
        penalty.with_reporting_delay(relaxed, calendar, spent="tempo_rendicontazione"), calendar,
        spent="tempo_rendicontazione", late="ritardo_rendicontazione", use_case="use_case_rendicontazione",
    )
    return penalty.reporting_penalty(
        reported, group=["lotto", "prodotto"], tie=tie, late="ritardo_rendicontazione", cost="costo_recapitista", counted=measured, **ranking
    )


def carrier_penalty_summary(detail: DataFrame, period: str = ACCEPTED) -> DataFrame:
    return penalty.penalty_summary(
        detail, ["recapitista", "lotto", "prodotto"], period=period,
        weighted={"recapito": "weighted_cents", "rendicontazione": "report_weighted_cents"},
    )


# -- sender penalties ---------------------------------------------------------


def sender_analogue(invoiced: DataFrame, timeline: DataFrame, gold: DataFrame, calendar: WorkCalendar, **ranking) -> DataFrame:
    """Analogue completion times of invoiced notifications, ranked globally.

    ``invoiced`` has iun, recindex, category, data_deposito, data_fatturazione;
    the last analogue feedback per notification gives the item.
    """
    feedback = timeline.filter(F.col("category") == "SEND_ANALOG_FEEDBACK").select(
        "iun",
        F.col("timestamp").cast("timestamp").alias("analog_feedback_tms"),
        attempt_number("timelineelementid").alias("attempt"),
        F.expr("substring(timelineelementid, 22)").alias("req_id"),
    )
    last = top_row(feedback, ["iun"], ["attempt", "analog_feedback_tms", "req_id"])
    items = gold.filter(F.col("pcretry_rank") == 1).select(
        F.expr("substring(requestid, 25)").alias("__req"), "requestid", "lotto", "prodotto", carrier().alias("recapitista"),
        "prezzo_ente", "costo_recapitista", "costo_consolidatore",
    ).distinct()
    joined = invoiced.join(last, "iun").join(items, F.col("req_id") == F.col("__req"), "left").drop("__req", "attempt")
    dated = joined.withColumns(
        {"end_date": dates.earliest("analog_feedback_tms", "data_fatturazione"), "quarter_fatturazione": dates.year_quarter("data_fatturazione")}
    )
    return penalty.sender_analogue(dated, calendar, start="data_deposito", end="end_date", tie=["iun", "recindex", "category", "requestid"], **ranking)


def sender_digital(invoiced: DataFrame, timeline: DataFrame, calendar: WorkCalendar) -> DataFrame:
    """Digital completion: late share beyond one percent, twenty cents each."""
    done = events.pivot_max(
        timeline.filter(F.col("category").isin("DIGITAL_FAILURE_WORKFLOW", "DIGITAL_SUCCESS_WORKFLOW")).withColumn(
            "tms", F.col("timestamp").cast("timestamp")
        ),
        ["iun"], "category", "tms", {"failed": "DIGITAL_FAILURE_WORKFLOW", "succeeded": "DIGITAL_SUCCESS_WORKFLOW"},
    )
    dated = invoiced.join(done, "iun").withColumn("end_date", dates.earliest(F.coalesce("failed", "succeeded"), "data_fatturazione"))
    return penalty.sender_digital_summary(dated, calendar, start="data_deposito", end="end_date")


# -- print supplier -----------------------------------------------------------


def print_schedule(
    gold: DataFrame, calendar: WorkCalendar, *, done: DataFrame | None = None, state: DataFrame | None = None, pages_per_day: int = 180_000, **options
) -> DataFrame:
    """Working day each printed item counts for, continuing earlier runs.

    ``done`` lists items assigned before and ``state`` is the saved last day.
    """
    printed = gold.filter(F.col("stampa_imbustamento_con080_data").isNotNull()).select(
        "requestid", "numero_pagine",
        dates.cut_off_date(F.coalesce("affido_consolidatore_data", "requesttimestamp")).alias("eligible"),
        F.col("stampa_imbustamento_con080_data").cast("date").alias("data_stampa_imbustamento"),
    )
    fresh = printed if done is None else joins.not_in(printed, "requestid", done, "requestid", null_aware=False)
    return capacity.assign_days(
        fresh, calendar, eligible="eligible", order=["data_stampa_imbustamento", "requestid"], pages="numero_pagine",
        capacity=pages_per_day, state=state, day="data_slittamento", rank="ranking", **options,
    ).drop("eligible")


def print_penalty(schedule: DataFrame, calendar: WorkCalendar) -> DataFrame:
    return stages.print_lateness(schedule, calendar, day="data_slittamento", printed="data_stampa_imbustamento", pages="numero_pagine")


def pickup_penalty(gold: DataFrame, calendar: WorkCalendar) -> DataFrame:
    kept = gold.filter(F.col("scarto_consolidatore_stato").isNull())
    return stages.pickup_lateness(kept, calendar, printed="stampa_imbustamento_con080_data", ready="materialita_pronta_con09a_data")


def supplier_backlog(gold: DataFrame, notifications: DataFrame, incidents: DataFrame, calendar: WorkCalendar, as_of: dt.date) -> DataFrame:
    """Items stuck at the print supplier with stage, priority and days over."""
    # Request states that are not a backlog.
    errors = [
        "PN999", "PN998", "error", "internalError", "syntaxError", "transformationError", "semanticError", "authenticationError", "duplicatedRequest", "booked",
    ]
    later = [
        ACCEPTED, "scarto_consolidatore_stato", "tentativo_recapito_stato", "messaingiacenza_recapito_stato", "certificazione_recapito_stato",
        "fine_recapito_stato", "demat_23l_ar_stato", "demat_plico_stato",
    ]
    open_items = stages.stuck_candidates(
        gold.filter(F.col("pcretry_rank") == 1), open_until=later, item="iun", incidents=incidents, incident_key="iun", state="statusrequest", states=errors
    )
    alive = notifications.filter(F.col("actual_status") != "CANCELLED").select("iun").distinct()
    started = open_items.join(alive, "iun", "left_semi").withColumn("entrusted", F.coalesce("affido_consolidatore_data", "requesttimestamp"))
    cols = {
        "entrusted": "entrusted", "printed": "stampa_imbustamento_con080_data", "ready": "materialita_pronta_con09a_data",
        "handed_over": HANDED_OVER, "accepted": ACCEPTED,
    }
    return stages.stuck_stage(started, calendar, F.lit(as_of), cols)


# -- reporting quality --------------------------------------------------------


def progress(items: DataFrame) -> DataFrame:
    """Controls, missing events, progress state and error text of each item."""
    flagged = quality.progress_state(quality.missing_events(quality.control_flags(items)))
    return flagged.withColumn("dettaglio_errore_rendicontazione", quality.error_detail())


# -- force majeure ------------------------------------------------------------


def force_majeure(gold: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Force majeure events reported from ``first`` to ``last``."""
    stamp = "causa_forza_maggiore_data_rendicontazione"
    until = last + dt.timedelta(days=1)
    return gold.filter(dates.in_period(stamp, (first, until))).select(
        "requestid",
        F.col("codice_oggetto").cast("string").alias("codice_oggetto"),
        F.col("geokey").cast("string").alias("cap"),
        F.col("province_name").alias("provincia"),
        F.col("region_name").alias("regione"),
        "prodotto",
        carrier(recorded=F.coalesce("recapitista_unificato", "recapitista", F.lit("NON_VALORIZZATO"))).alias("recapitista"),
        F.trim("causa_forza_maggiore_dettagli").alias("causa_forza_maggiore_causale"),
        code_text("causa_forza_maggiore_dettagli", presets.CAUSE_TEXTS, presets.CAUSE_DEFAULT).alias("causa_forza_maggiore_descrizione"),
        "causa_forza_maggiore_data",
        stamp,
    )


def force_majeure_news(current: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events not extracted before, their count per day, carrier and place)."""
    stamp = "causa_forza_maggiore_data_rendicontazione"
    texts = {"requestid": False, "causa_forza_maggiore_causale": True}
    fresh = incremental.new_events(current, previous, texts=texts, time=stamp, order=["codice_oggetto", "causa_forza_maggiore_data"])
    return fresh, incremental.event_summary(fresh, time=stamp, by=["recapitista", "cap", "provincia"])


# -- rate card ----------------------------------------------------------------


def rate_matrix(card: DataFrame, zones: DataFrame, *, start: str, end: str = "2999-01-01T23:59:59.999Z") -> DataFrame:
    """Delivered rate card and zones to one priced row per place, product, band."""
    return rates.price_zones(rates.card_to_long(card), zones, start=start, end=end)
