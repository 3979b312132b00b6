"""Quality control of reported outcomes: consistency flags and item states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.decisions import DecisionTable, all_of, any_of, listed
from millrace.functions.rules import any_flag, first_match, flag


def excluded(final: str, needs: Sequence[tuple[Sequence[str], str, Column | None]]) -> Column:
    """True when a final state lacks the companion event it requires.

    ``needs`` is ``[(final states, companion column, extra condition), ...]``.
    The result is never NULL, so it can be negated safely.
    """
    tests = []
    for states, companion, extra in needs:
        test = F.col(final).isin(list(states)) & F.col(companion).isNull()
        tests.append(test if extra is None else test & extra)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def delivery_exclusions() -> list[tuple[Sequence[str], str, Column | None]]:
    """Companions the delivery penalty asks for, by final state."""
    long_storage = F.datediff("fine_recapito_data", "tentativo_recapito_data") > 10
    notice = "accettazione_23l_recag012_data_rendicontazione"
    return [
        (presets.STORAGE_890_CLOSED[:3], notice, long_storage),
        (["RECAG008C"], notice, None),
        (presets.STORAGE_890_CLOSED, "demat_arcad_data_rendicontazione", None),
        (presets.PACKET_SCAN_REQUIRED, "demat_plico_data_rendicontazione", None),
        (presets.RECEIPT_SCAN_REQUIRED, "demat_23l_ar_data_rendicontazione", None),
        (presets.STORAGE_AR_RS_CLOSED + presets.STORAGE_890_CLOSED, "messaingiacenza_recapito_stato", None),
    ]


def reason_flag(code: str, reason: str, allowed=(presets.REASON_FAILED, presets.REASON_UNTRACEABLE)) -> Column:
    """1 if the reason does not belong to the certified code."""
    with_reason = [c for codes, _ in allowed for c in codes]
    rules = [(~F.col(code).isin(with_reason) & F.col(reason).isin(presets.REASONS), 1)]
    for codes, reasons in allowed:
        rules.append((F.col(code).isin(codes) & (~F.col(reason).isin(reasons) | F.col(reason).isNull()), 1))
    return first_match(rules, 0)


def attempt_flag(certified: str, attempt: str, table=presets.ATTEMPT_CODES) -> Column:
    """0 if the attempt code fits the certified code, else 1."""
    stored = [c for codes, _ in table for c in codes]
    rules = [
        (F.col(certified).isin(codes) & ((F.col(attempt) == expected) | F.col(attempt).isNull()), 0)
        for codes, expected in table
    ]
    rules.append((~F.col(certified).isin(stored) & (F.col(attempt) == F.col(certified)), 0))
    return first_match(rules, 1)


def triplet_flag(certified: str, scans: Sequence[str], final: str, triplets=presets.CODE_TRIPLETS) -> Column:
    """0 if certified, one of the scans and final code agree, else 1.

    The allowed triplets become one set of joined codes, so each scan costs one
    hash lookup instead of a branch per triplet. A missing code leaves fewer
    parts and can match nothing.
    """
    allowed = [f"{a}|{code}|{c}" for a, codes, c in triplets for code in codes]
    hits = [F.concat_ws("|", certified, scan, final).isin(allowed) for scan in scans]
    return F.when(reduce(lambda x, y: x | y, hits), 0).otherwise(1)


def triplet_join_flag(df: DataFrame, rules: DataFrame, certified: str, scan: str, final: str, out: str) -> DataFrame:
    """:func:`triplet_flag` with the triplets as a table ``(code_a, code_b, code_c)``."""
    keyed = rules.select("code_a", "code_b", "code_c").distinct().withColumn("__ok", F.lit(True))
    cond = (F.col(certified) == F.col("code_a")) & (F.col(scan) == F.col("code_b")) & (F.col(final) == F.col("code_c"))
    joined = df.join(keyed, cond, "left")
    return joined.withColumn(out, F.when(F.col("__ok"), 0).otherwise(1)).drop("__ok", "code_a", "code_b", "code_c")


def equal_dates_flag(certified: str, final: str) -> Column:
    """0 if both business times are equal, else 1 (also for NULL)."""
    return F.when(F.col(certified).cast("timestamp") == F.col(final).cast("timestamp"), 0).otherwise(1)


def short_storage_flag(code: str, certified: str, attempt: str, full_term: str = "RECRN005A", days: int = 30) -> Column:
    """1 if completed storage lasted less than ``days``."""
    return flag((F.col(code) == full_term) & (F.datediff(certified, attempt) < days))


def document_flag(product: str, document: str, expected: Mapping[str, str] | None = None) -> Column:
    """0 if the scanned document type fits the product or is missing, else 1."""
    table = expected or {"890": "23L", "AR": "AR"}
    rules = [((F.col(product) == p) & (F.col(document) == d), 0) for p, d in table.items()]
    return first_match([*rules, (F.col(document).isNull(), 0)], 1)


def missing_events(df: DataFrame) -> DataFrame:
    """The six missing-event flags and their union, on the wide item table."""
    stored = F.col("fine_recapito_stato").isin(presets.STORAGE_AR_RS_CLOSED + presets.STORAGE_890_CLOSED)
    stored_890 = (F.col("prodotto") == "890") & F.col("fine_recapito_stato").isin(presets.STORAGE_890_CLOSED)
    receipt, packet = F.col("demat_23l_ar_stato").isNull(), F.col("demat_plico_stato").isNull()
    flags = {
        "assenza_inesito": stored & F.col("tentativo_recapito_stato").isNull(),
        "assenza_messa_in_giacenza": stored & F.col("messaingiacenza_recapito_stato").isNull(),
        "assenza_pre_esito": F.col("certificazione_recapito_stato").isNull(),
        "assenza_dematerializzazione_23l_ar_plico": (
            ((F.col("fine_recapito_stato") == "RECAG008C") & (receipt | packet)) | (receipt & packet)
        ),
        "assenza_demat_arcad": stored_890 & F.col("demat_arcad_data_rendicontazione").isNull(),
        "assenza_recag012": stored_890 & F.col("accettazione_23l_recag012_data").isNull(),
    }
    return df.withColumns({name: flag(cond) for name, cond in flags.items()}).withColumn(
        "flag_esiti_mancanti", any_flag(list(flags))
    )


CONTROL_FLAGS = [
    "controllo_causale",
    "controllo_date_business",
    "controllo_tripletta",
    "controllo_tempistiche_compiuta_giacenza",
    "controllo_inesito_casi_giacenza",
    "controllo_documenttype",
]


def control_flags(df: DataFrame) -> DataFrame:
    """The six reporting controls on the wide item table."""
    scans = ["demat_23l_ar_stato", "demat_plico_stato", "demat_arcad_stato"]
    code, final = "certificazione_recapito_stato", "fine_recapito_stato"
    return df.withColumns(
        {
            "controllo_causale": reason_flag(code, "certificazione_recapito_dettagli"),
            "controllo_date_business": equal_dates_flag("certificazione_recapito_data", "fine_recapito_data"),
            "controllo_tripletta": triplet_flag(code, scans, final),
            "controllo_tempistiche_compiuta_giacenza": short_storage_flag(
                code, "certificazione_recapito_data", "tentativo_recapito_data"
            ),
            "controllo_inesito_casi_giacenza": attempt_flag(code, "tentativo_recapito_stato"),
            "controllo_documenttype": document_flag("prodotto", "documenttype"),
        }
    )


MISSING_FLAGS = [
    "assenza_inesito",
    "assenza_messa_in_giacenza",
    "assenza_pre_esito",
    "assenza_dematerializzazione_23l_ar_plico",
    "assenza_demat_arcad",
    "assenza_recag012",
]
_LATE = any_of(["flag_wi7_report_postalizzazioni_incomplete", "flag_wi7_consolidatore"])
_WRONG = any_of([*CONTROL_FLAGS, "flag_esiti_mancanti"])
_CLOSED = "fine_recapito_stato IS NOT NULL"
_DEAD = "certificazione_recapito_dettagli = 'M02'"
_CLEAN = all_of([*CONTROL_FLAGS, *MISSING_FLAGS]) + f" AND NOT coalesce({_DEAD}, false)"

# State texts in order of precedence, by report.
PROGRESS_STATES = DecisionTable(
    "progress_state",
    "weekly",
    (
        ("Oggetto perfezionato", "tms_perfezionamento_notification IS NOT NULL"),
        ("Oggetto cancellato", "tms_cancelled IS NOT NULL"),
        ("Oggetto in previsione di perfezionamento", "flag_schedule_refinement = 1"),
        (
            "Oggetto bloccato con PN998 / PN999",
            " OR ".join(listed(f"coalesce({c}, '')", presets.BLOCKED) for c in ("statusrequest", "fine_recapito_stato", "tentativo_recapito_stato", "certificazione_recapito_stato")),
        ),
        ("Oggetto scartato con P008 / P010 / P011", listed("ultimo_evento_stato", ["P008", "P010", "P011"])),
        ("Oggetto scartato dal Consolidatore", "scarto_consolidatore_stato IS NOT NULL"),
        ("Oggetto rientrante in tavolo Duplicati 23i/23l Poste", "flag_tavolo_duplicati_poste = 1"),
        ("Oggetto rientrante in tavolo Non Rendicontabili Poste", "flag_tavolo_non_rendicontabili_poste = 1"),
        ("Oggetto fuori sla", f"{_LATE} AND flag_oggetto_tavoli_poste = 0"),
        ("Oggetto restituito al mittente (esito destinatario deceduto)", _DEAD),
        (
            "Oggetto esitato per Furto / Non Rendicontabile",
            " OR ".join(listed(f"coalesce({c}, '')", presets.STOLEN_OR_UNREPORTABLE) for c in ("certificazione_recapito_stato", "fine_recapito_stato")),
        ),
        ("Errore rendicontazione/assenza eventi intermedi", f"{_WRONG} AND {_CLOSED}"),
        ("Oggetto con rendicontazione corretta in analisi Team Prodotto", _CLOSED),
    ),
    "Oggetto in corso di postalizzazione",
)
REFINEMENT_STATES = DecisionTable(
    "progress_state",
    "refinement",
    (
        ("Oggetto fuori sla", _LATE),
        ("Oggetto restituito al mittente (esito destinatario deceduto)", _DEAD),
        ("Errore rendicontazione/assenza eventi intermedi", f"{_WRONG} AND {_CLOSED}"),
        ("Oggetto con rendicontazione corretta in analisi Team Prodotto", _CLEAN),
    ),
    "Oggetto in corso di postalizzazione",
)

# Error texts by flag, in report order.
_ERROR_TEXTS = [
    ("errore rend. causale", "controllo_causale"),
    ("errore rend. date business", "controllo_date_business"),
    ("errore rend. tripletta", "controllo_tripletta"),
    ("errore rend. tempistiche compiuta giacenza", "controllo_tempistiche_compiuta_giacenza"),
    ("errore rend. inesito casi giacenza", "controllo_inesito_casi_giacenza"),
    ("assenza inesito", "assenza_inesito"),
    ("assenza messa in giacenza", "assenza_messa_in_giacenza"),
    ("assenza pre-esito", "assenza_pre_esito"),
    ("assenza demat 23l_ar / plico", "assenza_dematerializzazione_23l_ar_plico"),
    ("assenza demat ARCAD", "assenza_demat_arcad"),
    ("assenza RECAG012", "assenza_recag012"),
    ("errore documentType", "controllo_documenttype"),
]
ERROR_DETAILS = DecisionTable("error_detail", "weekly", tuple((text, f"{c} = 1") for text, c in _ERROR_TEXTS))
# Errors count for closed items only; clean ones are told apart by the first attempt's feedback.
REFINEMENT_DETAILS = DecisionTable(
    "error_detail",
    "refinement",
    (
        *((text, f"{c} = 1 AND {_CLOSED}") for text, c in _ERROR_TEXTS),
        ("da perfezionare", f"{_CLEAN} AND flag_feedback_attempt_0 = 0"),
        ("bloccato al primo attempt", f"{_CLEAN} AND flag_feedback_attempt_0 = 1"),
    ),
)


def progress_state(df: DataFrame, out: str = "stato_avanzamento_oggetti", table: DecisionTable = PROGRESS_STATES) -> DataFrame:
    """First matching progress state of an item, on the flagged item table.

    Needs the columns of :func:`control_flags` and :func:`missing_events`.
    """
    return df.withColumn(out, table.decide())


def error_detail(table: DecisionTable = ERROR_DETAILS) -> Column:
    """Comma-separated texts of the raised flags, in report order."""
    return table.texts()


def cluster_summary(df: DataFrame, cluster: str, item: str, paid: str) -> DataFrame:
    """Distinct items and distinct paid items per cluster."""
    return df.groupBy(cluster).agg(
        F.countDistinct(item).alias("items"),
        F.countDistinct(F.when(F.col(paid).isNotNull(), F.col(item))).alias("paid_items"),
    )
