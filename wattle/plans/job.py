"""The consolidation job: every source pipeline, per-source outputs, one
consolidated table, and a run report.

    python -m wattle.plans.job --sf-dir /root/testdata/sf0.01 --out <shared folder>
    python -m wattle.plans.job --raw-dir <folder of raw files> --out <shared folder> [--changed-only] [--allow-missing-files]

Raw files are scanned once: ``ledger.split`` parts typed rows from rejected lines, whose
number is in the report (table ``rejects``). A failing source is reported and the job
goes on with the others; an electricity file that cannot be read fails its source unless
that is allowed. The consolidated table and its finalised and analysis-ready exports
(K2/K3) are written only when every source is in. All tables are published as versions
(``sources.versions``): a run that dies leaves the old tables as they were. With
``changed_only`` a source whose input files are as they were is taken from its
published table instead of being built again. Exit code 1 when any source failed.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import half_even_long
from ..sources import files, ledger, versions
from . import consolidate as C

SOURCES = {
    "electricity": C.electricity_standin, "carbon": C.carbon_standin, "climate": C.climate_long,
    "production": C.production_long, "gas": C.gas_long, "economy": C.economy_long,
}


# Files of each raw source in ``--raw-dir`` (globs, a parameter) and how they become a long table.
RAW_FILES = {"electricity": "*M15_*_English.csv", "carbon": "carbon*.csv", "climate": "climate*.csv",
             "production": "production*.csv", "gas": "gas*.csv", "economy": "econom*.csv"}
LABEL_FILES = "meta*.csv"
# Geographies of the climate file; its indicators are those that it holds.
CLIMATE_GEOS = ("AT", "EU27_2020")


def raw_sources(spark: SparkSession, raw_dir: str, out: str, failures: list, rejects: dict, patterns=RAW_FILES,
                allow_missing_files: bool = False) -> dict:
    """Source name -> function that reads its raw files and returns the long table; the rejected
    lines of a source that was read are in ``rejects``."""
    def path(name: str) -> str:
        return f"{raw_dir.rstrip('/')}/{patterns[name]}"

    def typed(name: str, readings: DataFrame, key: str) -> DataFrame:
        rows, rejects[name] = ledger.split(readings, key, f"{out}/readings/{name}")
        return rows

    def electricity():
        found = [p for _, p in files.discover_files(spark, path("electricity"))]
        if not found:
            raise FileNotFoundError(path("electricity"))
        readings = files.read_electricity(spark, found, failures=failures, trace=True)
        if failures and not allow_missing_files:
            raise OSError(f"{len(failures)} of {len(found)} files cannot be read")
        return C.electricity_long(typed("electricity", readings, "timestamp"))

    def climate():
        wide = C.climate_wide(typed("climate", files.read_climate(spark, path("climate"), trace=True), "month").drop("month"),
                              None, CLIMATE_GEOS)
        wide = wide.withColumnsRenamed({c: c.replace("_eu27_2020", "_eu") for c in wide.columns})
        return C.monthly_long(wide, "month", [c for c in wide.columns if c != "month"])

    def production():
        p = typed("production", files.read_production(spark, path("production"), files.PRODUCTION_COLUMNS, trace=True), "month")
        return p.select(*C.base_columns("month", "monthly"),
                        *[half_even_long(c).alias(c) for c in files.PRODUCTION_COLUMNS.values()])

    def sheet(name, read, columns):
        return lambda: C.monthly_long(typed(name, read(spark, path(name), trace=True), "month"), "month", list(columns.values()))

    return {"electricity": electricity,
            "carbon": lambda: C.carbon_long(typed("carbon", files.read_carbon(spark, path("carbon"), trace=True), "Date")),
            "climate": climate, "production": production, "gas": sheet("gas", files.read_gas_sheet, files.GAS_COLUMNS),
            "economy": sheet("economy", files.read_economy_sheet, files.ECONOMY_COLUMNS)}


def write_reports(cons: DataFrame, out: str, labels: DataFrame | None = None) -> None:
    """Report exports of the written table: describe statistics of the monthly rows
    and first/last date with data per column, ';'-separated with decimal comma. With a
    label library (column, label, unit) both name and unit stand beside the column."""
    def labelled(df: DataFrame) -> DataFrame:
        if labels is None:
            return df
        known = labels.dropDuplicates(["column"])
        return df.join(known, "column", "left").select("column", F.coalesce("label", "column").alias("label"),
                                                       F.coalesce("unit", F.lit("")).alias("unit"), *[c for c in df.columns if c != "column"])
    from ..operators import quality as Q
    from ..sources.sinks import write_report_csv
    value_cols = [c for c in cons.columns if c not in ("date", "aggregation_level", "month_name")]
    monthly = cons.filter(F.col("aggregation_level") == "monthly")
    desc = Q.profile(monthly, value_cols, {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min,
        "p25": lambda x: F.percentile(x, 0.25), "p50": lambda x: F.percentile(x, 0.5),
        "p75": lambda x: F.percentile(x, 0.75), "max": F.max})
    write_report_csv(labelled(desc), f"{out}/reports/describe")
    long = cons.select("date", *[F.col(c).cast("string").alias(c) for c in value_cols]) \
        .unpivot(["date"], value_cols, "column", "value")
    v = F.col("value")
    avail = long.groupBy("column").agg(F.min(F.when(v.isNotNull(), F.col("date"))).alias("first_date"),
                                       F.max(F.when(v.isNotNull(), F.col("date"))).alias("last_date"),
                                       F.count(v).alias("n_values"))
    write_report_csv(labelled(avail), f"{out}/reports/availability")


def run(spark: SparkSession, sf_dir: str | None, out: str, how: str = "join", reports: bool = True,
        raw_dir: str | None = None, changed_only: bool = False, allow_missing_files: bool = False) -> DataFrame:
    """One row a source, and one a failed file; status 'ok', 'kept' (unchanged), 'failed'."""
    out = out.rstrip("/")
    report, tables, failures, rejects = [], [], [], {}
    if raw_dir:
        sources = raw_sources(spark, raw_dir, out, failures, rejects, allow_missing_files=allow_missing_files)
        inputs = {n: versions.input_state(spark, f"{raw_dir.rstrip('/')}/{RAW_FILES[n]}") for n in sources}
    else:
        from .materialize import _fingerprint
        sources = {name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in SOURCES.items()}
        inputs = dict.fromkeys(sources, _fingerprint(spark, sf_dir))
    for name, build in sources.items():
        t0, path = time.perf_counter(), f"{out}/sources/{name}"
        took = lambda: round(time.perf_counter() - t0, 3)
        try:
            state = versions.current(spark, path)
            kept = changed_only and state is not None and state["inputs"] == inputs[name]
            if not kept:
                state = versions.publish(build(), path, ["aggregation_level"], inputs[name])
            tables.append(versions.read(spark, path))
            report.append((name, "kept" if kept else "ok", state["rows"], len(tables[-1].columns), took(),
                           rejects[name].count() if name in rejects else 0, None))
        except Exception as ex:  # keep going; the report carries the failure
            report.append((name, "failed", 0, 0, took(), rejects[name].count() if name in rejects else 0, str(ex)))
    report += [(p, "failed file", 0, 0, 0.0, 0, error) for p, error in failures]
    if rejects:
        every = [r.select(F.lit(n).alias("source"), "*") for n, r in rejects.items()]
        ledger_rows = every[0]
        for r in every[1:]:
            ledger_rows = ledger_rows.unionByName(r)
        versions.publish(ledger_rows, f"{out}/rejects")
    if len(tables) == len(sources):
        versions.publish(C.merge_sources(tables, how=how), f"{out}/consolidated", ["aggregation_level"])
        cons = versions.read(spark, f"{out}/consolidated")
        versions.publish(C.finalised(cons), f"{out}/finalised", ["aggregation_level"])
        if all(c in cons.columns for c in (*C.RENEWABLE, *C.NON_RENEWABLE)):
            versions.publish(C.analysis_ready(cons), f"{out}/analysis_ready", ["aggregation_level"])
        if reports:
            library = f"{raw_dir.rstrip('/')}/{LABEL_FILES}" if raw_dir else ""
            write_reports(cons, out, files.read_meta_library(spark, library) if raw_dir and versions.input_state(spark, library) else None)
    else:
        report.append(("consolidated", "not written", 0, 0, 0.0, 0, "a source is missing"))
    return spark.createDataFrame(report, "source string, status string, rows long, columns int, seconds double, rejected long, error string")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", help="driver tables (stand-in sources)")
    ap.add_argument("--raw-dir", help="folder of raw source files")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--how", default="join", choices=["join", "union"])
    ap.add_argument("--changed-only", action="store_true", help="build only sources whose files changed")
    ap.add_argument("--allow-missing-files", action="store_true", help="publish although an electricity file cannot be read")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if not (a.sf_dir or a.raw_dir):
        ap.error("--sf-dir or --raw-dir is needed")
    from ..session import build_session, input_bytes, size_shuffles
    spark = build_session(a.master, app="wattle-consolidate")
    size_shuffles(spark, input_bytes(spark, a.raw_dir or a.sf_dir))
    rep = run(spark, a.sf_dir, a.out, a.how, raw_dir=a.raw_dir, changed_only=a.changed_only,
              allow_missing_files=a.allow_missing_files)
    rows = rep.collect()   # one row per source
    for r in rows:
        print(f"{r.source:12s} {r.status:7s} rows={r.rows} cols={r.columns} rejected={r.rejected} {r.seconds}s {r.error or ''}")
    return 1 if any(r.status not in ("ok", "kept") for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
