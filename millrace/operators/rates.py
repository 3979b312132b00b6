"""Rate cards and the cost charged to the citizen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import presets
from millrace.functions.rules import band_code, first_match
from millrace.functions.text import decimal_comma_cents, digits_only, no_digits, postcode
from millrace.operators.ordered import top_row

# Products of the card and their names abroad (None: not sold).
FOREIGN_PRODUCT = {"RS": "RIS", "AR": "RIR", "890": None}
# Column suffixes of the weight bands on the card.
BAND_SUFFIXES = ["20", "21_50", "51_100", "101_250", "251_350", "351_1000", "1001_2000"]


def card_to_long(
    card: DataFrame,
    *,
    key: str = "CAP",
    products: Sequence[str] = ("RS", "AR", "890"),
    bands: Sequence[tuple[int, int, int]] = presets.WEIGHT_BANDS,
    suffixes: Sequence[str] = BAND_SUFFIXES,
    fields: Mapping[str, str] | None = None,
    amounts: Sequence[str] = ("costo_plico", "costo_foglio", "costo_demat"),
) -> DataFrame:
    """Wide rate card (one row per postcode) to one row per product and band.

    Columns are named ``<product>_<suffix>``. ``fields`` maps output names to
    the suffixes of the per-product columns; those in ``amounts`` and all band
    prices are decimal-comma texts and become whole cents.
    """
    names = fields or {
        "recapitista": "Recapitista",
        "lotto": "Lotto",
        "costo_plico": "Plico",
        "costo_foglio": "Foglio",
        "costo_demat": "dem",
    }
    present = {c.strip(): c for c in card.columns}  # some headers carry blanks

    def source(product: str, suffix: str) -> Column:
        return F.col(f"`{present[f'{product}_{suffix}']}`").cast("string")

    # Amounts become cents before the rows are multiplied, once per card cell.
    priced = card.withColumns(
        {
            f"__{p}_{s}": decimal_comma_cents(source(p, s))
            for p in products
            for s in [*[v for k, v in names.items() if k in amounts], *suffixes]
        }
    )
    rows = []
    for product in products:
        per_product = [
            (F.col(f"__{product}_{s}") if n in amounts else source(product, s)).alias(n) for n, s in names.items()
        ]
        base = F.col(f"__{product}_{suffixes[0]}")
        for (_, low, high), suffix in zip(bands, suffixes):
            rows.append(
                F.struct(
                    F.lit(product).alias("product"),
                    *per_product,
                    F.lit(low).alias("min"),
                    F.lit(high).alias("max"),
                    F.col(f"__{product}_{suffix}").alias("costo"),
                    base.alias("costo_base_20gr"),
                )
            )
    long = priced.select(postcode(key).alias(key), F.explode(F.array(*rows)).alias("r"))
    return long.select(key, "r.*").withColumn("recapitista", F.trim("recapitista"))


def price_zones(
    long: DataFrame,
    zones: DataFrame,
    *,
    key: str = "CAP",
    zone: str = "zone",
    country: str = "countryIt",
    start: str,
    end: str,
) -> DataFrame:
    """Replace zones by countries and rename the products sold abroad."""
    z = zones.select(F.col(zone).alias("__zone"), F.col(country).alias("__country"))
    joined = long.join(z, F.col(key) == F.col("__zone"), "left")
    abroad = F.col("__country").isNotNull()
    renamed = first_match(
        [(abroad & (F.col("product") == home), F.lit(away)) for home, away in FOREIGN_PRODUCT.items()], F.col("product")
    )
    return (
        joined.withColumn("geokey", F.coalesce("__country", key))
        .withColumn("product", renamed)
        .filter(F.col("product").isNotNull())
        .withColumns({"startDate": F.lit(start), "endDate": F.lit(end)})
        .drop("__zone", "__country", key)
    )


def split_by_key_kind(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(national rows with numeric keys padded, rows whose key has no digit)."""
    national = df.filter(digits_only(key)).withColumn(key, F.lpad(F.col(key), 5, "0"))
    return national, df.filter(no_digits(key))


def with_band(df: DataFrame, weight: Column | str, out: str, bands=presets.WEIGHT_BANDS) -> DataFrame:
    return df.withColumn(out, band_code(weight, bands))


def check_card(card: DataFrame, tests: DataFrame, on: Sequence[str], compare: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Left join measured prices on the composite key and compare them.

    ``compare`` maps a flag to (card cents column, measured cents column). The
    overall flag is the conjunction, NULL when something is not measured. The
    key is compared part by part: concatenated text keys can collide.
    """
    measured = sorted({m for _, m in compare.values()})
    t = tests.select(*[F.col(k).alias(f"__t_{k}") for k in on], *[F.col(m).alias(f"__m_{m}") for m in measured])
    cond = None
    for k in on:
        part = F.col(k) == F.col(f"__t_{k}")
        cond = part if cond is None else cond & part
    joined = card.join(t, cond, "left")
    flags = {flag: F.col(c) == F.col(f"__m_{m}") for flag, (c, m) in compare.items()}
    overall = None
    for flag in flags:
        overall = F.col(flag) if overall is None else overall & F.col(flag)
    return (
        joined.withColumns(flags).withColumn("all_correct", overall).drop(*[f"__t_{k}" for k in on], *[f"__m_{m}" for m in measured])
    )


def payments(df: DataFrame, keep: Sequence[str], recipients: str = "recipients") -> DataFrame:
    """One row per payment notice of every recipient, with its position."""
    each = df.select(*keep, F.posexplode(recipients).alias("recindex", "__r"))
    paid = each.withColumn("__p", F.explode("__r.payments"))
    return paid.select(
        *keep,
        "recindex",
        F.col("__r.recipientid").alias("recipientid"),
        F.col("__r.recipienttype").alias("recipienttype"),
        F.col("__p.creditortaxid").alias("creditortaxid"),
        F.col("__p.noticecode").alias("noticecode"),
        F.col("__p.applycost").alias("applycost"),
    )


def json_cost_sum(df: DataFrame, keys: Mapping[str, Column], details: str, path: str, out: str) -> DataFrame:
    """Sum of an amount inside JSON text per key."""
    amount = F.get_json_object(details, path).try_cast("bigint")
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.sum(amount).alias(out))


def citizen_cost(
    *, applies: str, refused: str, cancelled: str, policy: str, fee: str, shipping: str, vat: str, base_fee: int = 100
) -> Column:
    """Cents charged to the citizen for a notice.

    Nothing when the notice does not apply costs, was refused or cancelled, or
    has a flat rate; else the sender's fee, a base fee and shipping with VAT.
    """
    none = ~F.col(applies) | F.col(refused) | F.col(cancelled) | (F.col(policy) == "FLAT_RATE")
    gross = F.col(shipping).cast("decimal(18,0)") * (F.col(vat).cast("decimal(9,0)") + 100) / 100
    full = F.coalesce(F.col(fee), F.lit(0)) + base_fee + F.round(gross, 0)
    return F.when(F.coalesce(none, F.lit(False)), F.lit(0)).otherwise(full).cast("bigint")


def latest_notice(df: DataFrame, keys: Sequence[str], sent: str, tie: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Most recent notification per payment notice, with the wanted ``columns`` (all by default)."""
    return top_row(df, keys, [sent, *tie], columns=columns)


def reconcile(expected: DataFrame, found: DataFrame, on: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(found rows that are expected, expected rows that were not found)."""
    cond = None
    left = expected.select(*[F.col(e).alias(f"__e_{e}") for e in on]).distinct()
    for e, f in on.items():
        part = F.col(f) == F.col(f"__e_{e}")
        cond = part if cond is None else cond & part
    matched = found.join(left, cond, "left_semi")
    right = found.select(*[F.col(f).alias(f"__f_{f}") for f in on.values()]).distinct()
    anti = None
    for e, f in on.items():
        part = F.col(e) == F.col(f"__f_{f}")
        anti = part if anti is None else anti & part
    return matched, expected.join(right, anti, "left_anti")
