"""Monthly consolidation of the account base with ten companion sources.

Every source carries the month key ``mes`` (e.g. ``2025-03``), and the month
is part of every join key, so a backfill over many months is ONE job (the
reference loops month by month). Rows without a base row are never built:
the base is filtered first (entry date not "Manual", brand not "Castigo" -
the reference applies both at the very end of a full outer chain, which
keeps exactly the base rows) and the sources are LEFT-joined, each reduced
to one row per key first (no fan-out on duplicate keys).
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field, fields
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands, classify, dates, fixed, keys
from ..functions.text import clean_header
from ..operators import consolidate, contacts, geo, joins, outcomes
from ..operators.topn import keyed_distinct, slot_columns
from ..sources import bucketed, committed
from ..sources.delimited import data_files, read_by_header

MONTH = "mes"
KEY = ["CUENTA_NEXT", MONTH]
MONTH_CONSTANTS = ["MES DE ASIGNACION", "PERIODO DE ASIGNACION"]
BASE_DROP, SCIENCE, ADDED, FINAL, RENAMES = fixed.BASE_DROP, fixed.SCIENCE, fixed.ADDED, fixed.FINAL, fixed.RENAMES
DAY_COLUMNS = [f"Dia_{d}" for d in range(1, fixed.DAY_SLOTS + 1)]
SLOT_COLUMNS = DAY_COLUMNS + [f"phone{i}" for i in range(1, fixed.PHONE_SLOTS + 1)] + \
    [f"email{i}" for i in range(1, fixed.EMAIL_SLOTS + 1)]



@dataclass
class MonthlySources:
    """The eleven inputs; each has the month column ``mes``."""
    base: DataFrame
    assignment: DataFrame
    contacts: DataFrame
    touches: DataFrame
    queues: DataFrame
    ranking: DataFrame
    excluded_documents: DataFrame
    excluded_accounts: DataFrame
    unapplied_payments: DataFrame
    no_management: DataFrame
    report: DataFrame
    missing: list[str] = field(default_factory=list)   # monthly files not found (reported)


# relative file names per source; {year} and {month} are filled per month
DEFAULT_LAYOUT = {
    "base": "base/base {year}-{month}.csv",
    "assignment": "assignment/assignment {year}-{month}.csv",
    "contacts": "contacts/contacts {year}-{month}.csv",
    "touches": "touches/touches {year}-{month}.csv",
    "queues": "queues/queues {year}-{month}.csv",
    "ranking": "ranking/ranking {year}-{month}.csv",
    "excluded_documents": "exclusions/documents {year}-{month}.csv",
    "excluded_accounts": "exclusions/accounts {year}-{month}.csv",
    "unapplied_payments": "unapplied/unapplied {year}-{month}.csv",
    "no_management": "no_management/no_management {year}-{month}.csv",
    "report": "report/report-{year}-{month}.csv",
}


def month_range(start: tuple[int, int], end: tuple[int, int]) -> list[tuple[int, int]]:
    """(year, month) from start to end inclusive (rolls over December)."""
    (y, m), out = start, []
    while (y, m) <= end:
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def read_months(spark: SparkSession, folder: str, months: list[tuple[int, int]],
                layout: dict[str, str] = DEFAULT_LAYOUT, sep: str = ";",
                encoding: str | None = None, other_months: list[tuple[int, int]] = ()) -> MonthlySources:
    """All months of every source as one DataFrame per source, by column
    name: one scan for all monthly files with the same header, unioned by
    name; the month comes from the file name
    (``{year}-{month}`` in the layout, read back from
    ``_metadata.file_path``, whose URI encoding leaves digits and '-' alone).
    A source without a file in ``months`` takes its columns, and no row, from
    ``other_months``."""
    out = {}
    missing: list[str] = []
    for f in fields(MonthlySources)[:11]:
        try:
            out[f.name] = read_source(spark, folder, f.name, months, layout, sep, encoding, missing)
        except FileNotFoundError:
            if not other_months:
                raise
            out[f.name] = read_source(spark, folder, f.name, list(other_months), layout, sep, encoding).limit(0)
    return MonthlySources(**out, missing=missing)


def read_source(spark: SparkSession, folder: str, name: str, months: list[tuple[int, int]],
                layout: dict[str, str] = DEFAULT_LAYOUT, sep: str = ";", encoding: str | None = None,
                missing: list[str] | None = None) -> DataFrame:
    """The months of one source (a file, or a folder of files, each);
    ``missing`` collects the paths that don't exist."""
    if "{year}-{month}" not in layout[name]:
        raise ValueError(f"layout for {name} must contain '{{year}}-{{month}}'")
    paths = [os.path.join(folder, layout[name].format(year=y, month=f"{m:02d}")) for y, m in months]
    present = [p for p in paths if committed.exists(spark, p)]
    if missing is not None:
        missing += [p for p in paths if p not in present]
    if not present:
        raise FileNotFoundError(f"no monthly file for source {name!r} (e.g. {paths[0]})")
    files = [f for p in present for f in data_files(spark, p)]
    df = read_by_header(spark, files, sep=sep, encoding=encoding or "UTF-8", file_column="_file")
    # the year-month stands in the path where the layout has it (paths are URI-encoded)
    before, after = (re.escape(quote(part)) for part in layout[name].split("{year}-{month}", 1))
    return df.withColumn(MONTH, F.regexp_extract("_file", rf"{before}(\d{{4}}-\d{{2}}){after}", 1)).drop("_file")


def month_files(spark: SparkSession, folder: str, months: list[tuple[int, int]], layout: dict[str, str] = DEFAULT_LAYOUT) -> dict[str, list[str]]:
    """Month -> the files of all sources that it is made from."""
    out = {}
    for y, m in months:
        paths = [os.path.join(folder, p.format(year=y, month=f"{m:02d}")) for p in layout.values()]
        out[f"{y}-{m:02d}"] = [f for p in paths if committed.exists(spark, p) for f in data_files(spark, p)]
    return out


def _acc(c: str) -> Column:
    """Every source's account goes through the one key function, so that all spellings meet."""
    return keys.account_key(F.col(f"`{c}`"))


def contact_rows(contacts_: DataFrame, mobile_count, landline_count) -> DataFrame:
    """One row per account and month: the contacts of all its documents,
    merged and ranked into the slots anew, with the counts and the label."""
    wide = contacts_.withColumn("CUENTA_NEXT", _acc("cuenta"))
    merged = contacts.merged_slots(wide, KEY, slot_columns("phone", fixed.PHONE_SLOTS), slot_columns("email", fixed.EMAIL_SLOTS),
                                   mobile_count, landline_count)
    profile = contacts.contact_profile(merged)
    return profile.withColumnsRenamed({"num_movil": "NumMovil", "num_fijo": "NumFijo", "num_email": "NumEmail",
                                       "filtro_demografico": "Filtro Demografico"})


def prepare_sources(src: MonthlySources, mobile_count=fixed.MOBILE_COUNT_RANGE, landline_count=fixed.LANDLINE_COUNT_RANGE
                    ) -> tuple[DataFrame, list[tuple[DataFrame, list[str]]], DataFrame]:
    """The filtered base, the sides that join on (account, month), and the
    excluded documents, which join on (document, month) when all else is done."""
    base = src.base.drop(*BASE_DROP).withColumn("CUENTA_NEXT", _acc("CUENTA_NEXT"))
    base = base.where(~F.col("`FECHA INGRESO`").contains("Manual") & (F.col("Marca") != fixed.BRAND_CASTIGO))

    demo = contact_rows(src.contacts, mobile_count, landline_count)

    touch = src.touches.select(
        _acc("Cuenta_Real").alias("CUENTA_NEXT"), MONTH,
        *[F.col(f"`Toques por {ch}`").try_cast("bigint").alias(f"Toques por {ch}")
          for ch in fixed.TOUCH_CHANNELS])
    touch = touch.groupBy(*KEY).agg(*[F.sum(f"`Toques por {ch}`").alias(f"Toques por {ch}")
                                      for ch in fixed.TOUCH_CHANNELS])

    data = src.assignment.drop(*MONTH_CONSTANTS).withColumn("CUENTA_NEXT", _acc("CUENTA_NEXT")).withColumnsRenamed(
        {"MARCA": "MARCA DATA", "FECHA INGRESO": "FECHA INGRESO DATA", "FECHA RETIRO": "FECHA RETIRO DATA"})
    data = keyed_distinct(data, KEY, ["CUENTA"])

    # only the fact of a queued payment reaches the report
    queues = src.queues.select(_acc("Cuenta").alias("CUENTA_NEXT"), MONTH).dropDuplicates() \
        .withColumn("FILTRO COLAS", F.lit(fixed.LIST_FLAG))

    ranking = keyed_distinct(src.ranking.select(_acc("CUENTA").alias("CUENTA_NEXT"), MONTH,
                                                F.col("SERVICIOS").alias("SERVICIOS RANKING"),
                                                F.col("ESTADO").alias("ESTADO RANKING")),
                             KEY, ["ESTADO RANKING", "SERVICIOS RANKING"])
    exc_doc = src.excluded_documents.select("DOCUMENTO", MONTH).where(F.col("DOCUMENTO").isNotNull()) \
        .dropDuplicates().withColumn("EXCLUSION DOCUMENTO", F.lit(fixed.LIST_FLAG))
    exc_acc = src.excluded_accounts.select(_acc("CUENTA").alias("CUENTA_NEXT"), MONTH).dropDuplicates() \
        .withColumn("EXCLUSION CUENTA", F.lit(fixed.LIST_FLAG))
    psa = src.unapplied_payments.groupBy(_acc("CUENTA").alias("CUENTA_NEXT"), MONTH) \
        .agg(F.sum(F.col("RECUENTO").try_cast("bigint")).alias("RECUENTO PAGOS SIN APLICAR"))
    ng = src.no_management.groupBy(_acc("CUENTA").alias("CUENTA_NEXT"), MONTH) \
        .agg(F.sum(F.col("RECUENTO").try_cast("bigint")).alias("RECUENTO NO GESTION"))

    rep = consolidate.trim_headers(src.report)
    rep = rep.select(_acc("Cuenta").alias("CUENTA_NEXT"),  # D7
                     MONTH, outcomes.outcome_group("tipificacion").alias("_g"))
    report = rep.groupBy(*KEY).agg(*[c.alias(n.upper()) for n, c in outcomes.outcome_counts("_g").items()]) \
        .withColumn("FILTRO_REPORTE_GESTION", outcomes.outcome_label(
            "CANTIDAD_CONTACTO_DIRECTO", "CANTIDAD_CONTACTO_INDIRECTO", "CANTIDAD_NOCONTACTO"))

    # every join copies the row so far: the wide sides (contact slots, assignment) come last
    return base, [(side, KEY) for side in (queues, exc_acc, psa, ng, ranking, touch, report, demo, data)], exc_doc


def exclude_documents(df: DataFrame, exc_doc: DataFrame) -> DataFrame:
    """Marks the documents on the month's list. Rows without a document (no
    assignment row) are spread over all partitions by their account."""
    key = joins.spread_null_key(F.col("DOCUMENTO"), F.col("CUENTA_NEXT"))
    marks = exc_doc.withColumnsRenamed({"DOCUMENTO": "_doc", MONTH: "_mes"})
    j = df.withColumn("_key", key)
    return j.join(marks, (j["_key"] == marks["_doc"]) & (j[MONTH] == marks["_mes"]), "left").drop("_key", "_doc", "_mes")


def monthly_consolidation(src: MonthlySources, patterns: geo.PatternDictionary,
                          base_columns: list[str] | None = None, mobile_count=fixed.MOBILE_COUNT_RANGE,
                          landline_count=fixed.LANDLINE_COUNT_RANGE,
                          store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``base_columns``: names, after the renames and header cleaning, of the
    base's columns that the report keeps (default: the report's catalogue).
    ``store`` keeps the prepared base and sides, e.g. as co-bucketed tables
    (:func:`bucketed_store`), and hands back what the chain reads.

    The department is resolved on the narrow, filtered base; then one chain
    on (account, month), which needs one shuffle of the growing row; the
    document exclusion, on another key, comes last."""
    base, sides, exc_doc = prepare_sources(src, mobile_count, landline_count)
    wanted = fixed.BASE_COLUMNS if base_columns is None else base_columns
    kept = {clean_header(RENAMES.get(c, c)) for c in base.columns}
    df = geo.resolve_departments(base, "Ciudad", patterns, out_city="_ciudad") \
        .withColumnRenamed("departamento", "DEPARTAMENTO").drop("_ciudad")
    if store is not None:
        df = store(df, "base")
        sides = [(store(side, f"side{k}"), on) for k, (side, on) in enumerate(sides)]
    df = consolidate.consolidate(df, None, sides)
    df = exclude_documents(df, exc_doc)
    df = df.withColumn("FILTRO DESCUENTO", classify.discount_filter(F.col("PORCENTAJE").try_cast(classify.PERCENTAGE)))
    df = consolidate.rename(df, RENAMES)
    counts = [F.coalesce(F.col(c).try_cast("int"), F.lit(0)) if c in df.columns else F.lit(0)
              for c in ("CANTIDAD_MOVILES", "CANTIDAD_FIJOS", "CANTIDAD_EMAILS")]
    mora_entry = F.col("`FECHA INGRESO DATA`") if "FECHA INGRESO DATA" in df.columns else F.lit(None)
    mora_due = F.col("`Fecha de Vencimiento`") if "Fecha de Vencimiento" in df.columns else F.lit(None)
    mora, mora_band = dates.arrears(mora_entry.cast("string"), mora_due.cast("string"))
    df = df.withColumns({
        "CANTIDAD_DEMOGRAFICOS": counts[0] + counts[1] + counts[2],   # D9: missing counts as 0
        "RANGO_DE_DIAS_RETIRADA": bands.day_band(F.col("DIAS_RETIRADA").try_cast("int"))
        if "DIAS_RETIRADA" in df.columns else F.lit(fixed.DAY_BAND_OUT),
        "RANGO_DE_DIAS_EN_BASE": bands.day_band(F.col("DIAS_EN_BASE").try_cast("int"))
        if "DIAS_EN_BASE" in df.columns else F.lit(fixed.DAY_BAND_OUT),
        "DIAS_MORA": mora,
        "RANGO_DE_DIAS_MORA": mora_band,
        "FILTRO_PAGOS_SIN_APLICAR": bands.count_flag("RECUENTO PAGOS SIN APLICAR"),
        "FILTRO_PAGOS_NO_GESTION": bands.count_flag("RECUENTO NO GESTION"),
    })
    df = consolidate.clean_headers(df)
    families = {
        fixed.PREFIX_BASE: [c for c in wanted if c in kept],
        fixed.PREFIX_SCIENCE: SCIENCE,
        fixed.PREFIX_ADDED: ADDED,
        None: FINAL,
        fixed.PREFIX_SLOTS: SLOT_COLUMNS,
    }
    return consolidate.prefix_families(df, families, keep=[MONTH])


def bucketed_store(spark: SparkSession, folder: str, buckets: int, prefix: str = "mensual") -> Callable[[DataFrame, str], DataFrame]:
    """Keeps each prepared source as a table bucketed by (account, month).
    The chain over them then joins bucket by bucket, without an exchange,
    however many reports or re-runs read the same tables."""
    return lambda df, name: bucketed.write_bucketed(df, f"{prefix}_{name}", KEY, buckets, os.path.join(folder, name))


def write_monthly(df: DataFrame, path: str, sep: str = ";", files_per_month: int | None = None) -> bool:
    """One folder per month (``mes=yyyy-MM``)."""
    from ..sources.delimited import write_delimited
    return write_delimited(df, path, sep=sep, partition_by=[MONTH], files_per_partition=files_per_month)


def rerun_months(spark: SparkSession, folder: str, out_path: str, months: list[tuple[int, int]], patterns: geo.PatternDictionary,
                 layout: dict[str, str] = DEFAULT_LAYOUT, sep: str = ";", encoding: str | None = None) -> dict[str, int]:
    """Consolidates only the months whose files changed since they were last
    written, in one job, and rewrites their folders; the others keep their
    files. Returns month -> rows. A month without base rows keeps what it had."""
    files = month_files(spark, folder, months, layout)
    stale = committed.stale_partitions(spark, out_path, files)
    if not stale:
        return {}
    src = read_months(spark, folder, [(y, m) for y, m in months if f"{y}-{m:02d}" in stale], layout, sep, encoding, months)
    return committed.rewrite_partitions(monthly_consolidation(src, patterns), out_path, MONTH, {v: files[v] for v in stale}, sep)
