"""Readers for the raw source files (CSV and sheet exports).

Every reader scans text as strings with a declared or header schema (no
inference pass), keeps the file name from ``_metadata`` where the year lives
in it, and leaves typing to the lenient Column casts in ``functions``. A line
with more or fewer fields than the header keeps its raw text in
``_corrupt_record``; typed readers pass that on as ``malformed_line`` (NULL for
good lines), so nothing is cut without a trace and no line fails the job. With
``trace=True`` they also keep the lines whose key does not parse and the columns
that ``ledger.split`` needs.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import cleaning as cl

ELECTRICITY_YEAR_PATTERN = r"M15_(\d{4})_English"
CORRUPT, SURPLUS = "_corrupt_record", "_surplus"

#: What cp1252 has where ISO-8859-1 has control characters (27 of the 32 places are taken).
CP1252_C1 = {}
for _i in range(0x80, 0xA0):
    try:
        CP1252_C1[chr(_i)] = bytes([_i]).decode("cp1252")
    except UnicodeDecodeError:
        pass


def fix_cp1252(c):
    """Map the cp1252-only characters (euro sign, dashes, quotes, ...) read through ISO-8859-1."""
    return F.translate(c, "".join(CP1252_C1), "".join(CP1252_C1.values()))


def file_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, str]]:
    """path -> (encoding, first line): one job over all lines of all files.

    A file is UTF-8 if every line of it is valid UTF-8, else cp1252."""
    t = spark.read.text(list(paths)).select(        # the text source keeps the bytes as they are
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"), "value")
    rows = t.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
                                 F.min_by(F.col("value").cast("binary"), F.struct("at", "line")).alias("first")
                                 ).collect()   # a row a file
    out = {}
    for r in rows:
        enc = "utf-8" if r.utf8 else "cp1252"
        out[r.path] = (enc, bytes(r["first"]).decode(enc, errors="replace").lstrip("\ufeff"))
    return out


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line; empty or repeated names get their position."""
    names: list[str] = []
    for i, n in enumerate(next(csv.reader([line], delimiter=sep), [])):
        names.append(n if n and n not in names else f"{n}_c{i}")
    return names


def read_lines_as(spark: SparkSession, paths: Sequence[str], names: Sequence[str], sep: str, encoding: str,
                  header: bool) -> DataFrame:
    """Delimited files of one header and encoding in one scan: all strings, ``_corrupt_record``, ``source_file``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    single = encoding.lower() in ("cp1252", "windows-1252")     # Spark's reader lacks cp1252; the bytes are the same
    df = (spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
          .option("encoding", "ISO-8859-1" if single else encoding).option("columnNameOfCorruptRecord", CORRUPT)
          .option("columnPruning", False).csv(list(paths)))
    cols = [cl.named(c) for c in df.columns]
    if single:
        cols = [fix_cp1252(c).alias(n) for c, n in zip(cols, df.columns)]
    return df.select(*cols, F.col("_metadata.file_name").alias("source_file"), (n_fields(F.col(CORRUPT), sep) > len(names)).alias(SURPLUS))


def n_fields(line, sep: str):
    """Fields of a delimited line; separators inside quotes do not count."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), "[" + sep + "]", -1))


def traced(key_text) -> list:
    """The columns of ``ledger.TRACE`` from those of ``read_lines_as``."""
    return [F.col("source_file"), key_text.alias("key_text"), F.col(CORRUPT).alias("malformed_line"), F.col(SURPLUS).alias("surplus_fields")]


def read_text_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None,
                  header: bool = True, n_columns: int | None = None) -> DataFrame:
    """One delimited file, all columns as strings, plus ``_corrupt_record`` and ``source_file``.

    ``encoding`` None: UTF-8 or cp1252, decided on the whole file. ``n_columns``
    declares positional columns ``_c0``... for files with banner lines."""
    enc, line = encoding, ""
    if enc is None or (header and n_columns is None):
        (found, line), = file_heads(spark, [path]).values()
        enc = enc or found
    names = [f"_c{i}" for i in range(n_columns)] if n_columns else header_names(line, sep)
    return read_lines_as(spark, [path], names, sep, enc, header)


def year_from_file(df: DataFrame, pattern: str = ELECTRICITY_YEAR_PATTERN) -> DataFrame:
    """``source_year`` parsed from the file name (multi-file discovery by glob)."""
    y = F.regexp_extract(F.col("source_file"), pattern, 1)
    return df.withColumn("source_year", F.when(y != "", y.cast("int")))


def discover_files(spark: SparkSession, pattern: str, year_pattern: str = ELECTRICITY_YEAR_PATTERN) -> list[tuple]:
    """Files matching a glob, with the year taken from the file name, in
    chronological order (Hadoop FS glob: local, HDFS and object stores alike).
    Only file *names* are listed on the driver; no data is read."""
    import re
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for st in fs.globStatus(p) or []:
        path = st.getPath().toString()
        m = re.search(year_pattern, st.getPath().getName())
        if m:
            found.append((int(m.group(1)), path))
    return sorted(found)


def first_column_containing(columns: Sequence[str], *marks: str) -> str | None:
    """First header that contains every mark (name-based feed choice)."""
    for c in columns:
        if all(m in c for m in marks):
            return c
    return None


def read_electricity(spark: SparkSession, paths: Sequence[str], ts_format: str = "dd.MM.yyyy HH:mm",
                     eras: Mapping[str, tuple] | None = None, failures: list | None = None, trace: bool = False) -> DataFrame:
    """Yearly 15-minute price files -> timestamp, source_year, price_exaa_raw, price_mc_raw, malformed_line.

    Headers differ between years: one job finds every file's encoding and
    header, files with the same ones are one scan, and the scans are one union.
    A file that cannot be resolved is left out and recorded in ``failures``
    (path, error); the others still load."""
    from ..plans.consolidate import REFERENCE_ERAS, select_era_columns
    eras = eras or REFERENCE_ERAS
    failures = [] if failures is None else failures
    heads: dict[str, tuple[str, str]] = {}
    try:
        found = file_heads(spark, paths)
        heads = {p: next(h for q, h in found.items() if unquote(q).endswith(p.split(":", 1)[-1])) for p in paths}
    except Exception:                            # one of them cannot be read: find out which
        for p in paths:
            try:
                (heads[p],) = file_heads(spark, [p]).values()
            except Exception as ex:
                failures.append((p, str(ex) or "no line"))
    groups: dict[tuple, list[str]] = defaultdict(list)
    for p, (enc, line) in heads.items():
        groups[(enc, *header_names(line, ","))].append(p)
    parts = []
    for (enc, *names), group in groups.items():
        exaa = first_column_containing(names, "EXAA", "EUR")
        mc = first_column_containing(names, "MC Auction", "EUR")
        if exaa is None and mc is None:
            failures += [(p, "no price column") for p in group]
            continue
        raw = year_from_file(read_lines_as(spark, group, names, ",", enc, True))
        clean = cl.standardize_missing(raw, names)
        parts.append(clean.select(
            cl.lenient_timestamp(cl.named(names[0]), ts_format).alias("timestamp"), "source_year",
            *[(cl.lenient_double(cl.named(c)) if c else F.lit(None).cast("double")).alias(n)
              for c, n in ((exaa, "price_exaa_raw"), (mc, "price_mc_raw"))],
            *(traced(cl.named(names[0])) if trace else [F.col(CORRUPT).alias("malformed_line")])))
    if not parts:
        raise ValueError(f"no readable electricity file: {failures}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return select_era_columns(out, "source_year", eras)


def read_carbon(spark: SparkSession, path: str, date_column: str = "Date", sep: str = ",",
                decimal: str = ".", date_format: str = "yyyy-MM-dd", trace: bool = False) -> DataFrame:
    """Delimited carbon sheet: date parsed, value columns lenient doubles, junk and empty columns dropped."""
    own = ("source_file", SURPLUS, CORRUPT)
    raw = read_text_csv(spark, path, sep)
    raw = cl.standardize_missing(raw, [c for c in raw.columns if c not in own])
    conv = cl.decimal_comma_double if decimal == "," else cl.lenient_double
    cols = [F.try_to_date(cl.named(date_column), date_format).alias(date_column)]
    for c in raw.columns:
        if c not in (date_column, *own):
            cols.append(conv(cl.named(c)).alias(c) if "Market Currency" not in c else cl.named(c))
    # Spark fills the corrupt-record column only in scans that ask for it, so the junk names are found first
    values = cl.drop_junk_columns(raw.select(*cols)).columns
    if trace:
        return raw.select(*cols, *traced(cl.named(date_column))).select(*[cl.named(c) for c in values], "source_file", "key_text",
                                                                         "malformed_line", "surplus_fields")
    out = raw.select(*cols, F.col(CORRUPT).alias("malformed_line")).select(*[cl.named(c) for c in values], "malformed_line")
    return out.filter(cl.named(date_column).isNotNull())


def read_climate(spark: SparkSession, path: str, trace: bool = False) -> DataFrame:
    """Eurostat long file: the 4 used columns, ``malformed_line`` (with ``trace`` also ``month``)."""
    raw = read_text_csv(spark, path)
    cols = ["TIME_PERIOD", "indic_nrg", "geo", cl.lenient_double("OBS_VALUE").alias("OBS_VALUE")]
    if trace:
        return raw.select(*cols, F.try_to_date("TIME_PERIOD", "yyyy-MM").alias("month"), *traced(F.col("TIME_PERIOD")))
    return raw.select(*cols, F.col(CORRUPT).alias("malformed_line"))


def read_production(spark: SparkSession, path: str, mapping: Mapping[str, str],
                    month_column: str = "Header & Timestamp", month_format: str = "yyyy-MM",
                    trace: bool = False) -> DataFrame:
    """``;``-separated, decimal comma, ISO-8859-1, with header-metadata rows under the
    header: data rows are the ones whose first field parses as a month."""
    raw = read_text_csv(spark, path, sep=";", encoding="ISO-8859-1")
    m = F.try_to_date(F.trim(cl.named(month_column)), month_format)
    cols = [m.alias("month"), *[cl.decimal_comma_double(cl.named(src)).alias(dst) for src, dst in mapping.items()]]
    if trace:
        return raw.select(*cols, *traced(cl.named(month_column)))
    return raw.select(*cols, F.col(CORRUPT).alias("malformed_line")).filter(F.col("month").isNotNull())


def sheet_header(spark: SparkSession, path: str, mark: str, sep: str) -> list[str]:
    """Trimmed names of the first line that holds ``mark`` as a field: the header under a sheet's banner."""
    lines = (spark.read.text(path).select(F.monotonically_increasing_id().alias("i"), "value")
             .filter(F.col("value").contains(mark)))
    first = lines.filter(F.array_contains(F.transform(F.split("value", sep, -1), lambda x: F.trim(F.translate(x, '"', ""))), mark)) \
        .agg(F.min(F.struct("i", "value")).alias("h")).first()["h"]
    if first is None:
        raise ValueError(f"no header with {mark!r} in {path}")
    return [n.strip() for n in next(csv.reader([first["value"]], delimiter=sep))]


def read_sheet_export(spark: SparkSession, path: str, mapping: Mapping[str, str], date_column: str, parse,
                      shape=None, sep: str = ",", trace: bool = False) -> DataFrame:
    """CSV export of a spreadsheet with banner rows and a footer; columns are chosen by header name.

    ``mapping``: header name -> column. Banner, unit and footer rows fall out
    because the date field must have month shape (``shape``) and parse. A
    missing column raises; columns that are not named are left out; a data row
    with surplus fields keeps its text in ``malformed_line``."""
    header = sheet_header(spark, path, date_column, sep)
    lacking = [c for c in mapping if c not in header]
    if lacking:
        raise ValueError(f"columns {lacking} are not in {path}")
    raw = read_text_csv(spark, path, sep=sep, encoding="UTF-8", header=False, n_columns=len(header))
    d = F.trim(F.col(f"_c{header.index(date_column)}"))
    month = parse(d) if shape is None else F.when(shape(d), parse(d))
    cols = [cl.lenient_double(cl.null_if_token(F.trim(F.col(f"_c{header.index(c)}")))).alias(n) for c, n in mapping.items()]
    if trace:
        return raw.select(month.alias("month"), *cols, *traced(d))
    surplus = F.when(F.col(SURPLUS), F.col(CORRUPT))
    return raw.select(month.alias("month"), *cols, surplus.alias("malformed_line")).filter(F.col("month").isNotNull())


# Header names of the sources and the columns they become.
GAS_COLUMNS = {"Monat": "oegpi_month", "Quartal": "oegpi_quarter", "Saison": "oegpi_season", "Jahr": "oegpi_year"}
PRODUCTION_COLUMNS = {
    "15": "prod_gross_electricity_production", "16": "prod_gross_electricity_consumption",
    "37": "prod_hydropower_production_total", "38": "prod_fossil_sk_production", "39": "prod_fossil_DvfB_production",
    "40": "prod_fossil_DvOe_production", "41": "prod_fossil_gas_production", "42": "prod_fossil_subtotal_production",
    "43": "prod_renewable_bio_production", "44": "prod_renewable_SoBio_production", "45": "prod_other_fuels_production",
    "46": "prod_fuel_production_total", "47": "prod_wind_total", "48": "prod_pv_total", "49": "prod_geothermal_total",
    "51": "prod_power_production_total", "57": "prod_electricity_imports", "58": "prod_electricity_exports"}
ECONOMY_COLUMNS = {
    "Produktionsindex Industrie (at; 2021=100)": "econ_prod_index_industry",
    "Verbraucherpreisindex (2015=100)": "econ_consumer_price_index",
    "Ausfuhren Insgesamt in €": "econ_exports_total_EUR",
    "Umsatzindex Handel (nom.; 2021=100)": "econ_turnover_index_commercial_sales",
    "Nächtigungen": "econ_count_overnight_stays",
    "Umsatz Industrie inTsd.€ (KJE)": "econ_turnover_industry",
    "Beschäftigte Industrie gesamt (KJE)": "econ_count_employees_industry",
    "Produktionsindex Bau (at; 2021=100)": "econ_prod_index_construction",
    "Technische Gesamtproduktion Bau in Tsd. € (KJE)": "econ_total_production_construction",
    "Umsatzindex Bau (2021=100)": "econ_turnover_index_construction",
    "Umsatz Bau in Tsd. € (KJE)": "econ_turnover_construction",
    "Beschäftigte Bau gesamt (KJE)": "econ_count_employees_construction",
    "Umsatzindex - Großhandel (G46; nom.; 2021=100)": "econ_turnover_index_wholesale",
    "Umsatzindex - Einzelhandel (G47; nom.; 2021=100)": "econ_turnover_index_retail",
    "Beschäftigtenindex Handel  (2021=100)": "econ_count_employees_retail",
    "Umsatzindex - KfZ-Handel (G45; nom.; 2021=100)": "econ_turnover_index_car_retail",
    "Einfuhren Insgesamt in €": "econ_imports_total_EUR",
    "Einfuhren Insg. SITC-3 Brennstoffe, Energie in €": "econ_imports_energy_EUR"}


def read_gas_sheet(spark: SparkSession, path: str, mapping: Mapping[str, str] = GAS_COLUMNS, sep: str = ",",
                   trace: bool = False) -> DataFrame:
    return read_sheet_export(spark, path, mapping, "Datum", cal.parse_german_month, sep=sep, trace=trace)


def read_economy_sheet(spark: SparkSession, path: str, mapping: Mapping[str, str] = ECONOMY_COLUMNS, sep: str = ",",
                       trace: bool = False) -> DataFrame:
    return read_sheet_export(spark, path, mapping, "Berichtszeitraum", cal.parse_austrian_month, cal.is_month_token, sep, trace)


SEPARATORS = (",", ";", "\t", "|")


def find_separator(spark: SparkSession, path: str, candidates: Sequence[str] = SEPARATORS) -> str:
    """The separator of a delimited file: the candidate for which most lines agree on a number of fields
    above one (ties: more fields, then the order of ``candidates``). One pass over all lines; separators
    inside quotes do not count, blank lines neither."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    counts = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), n_fields(F.col("value"), c).alias("fields"))
                                 for i, c in enumerate(candidates)]))
    # candidates x different field counts
    seen = lines.select(counts.alias("c")).groupBy("c.i", "c.fields").agg(F.count("*").alias("n")).filter("fields > 1")
    best = seen.orderBy(F.desc("n"), F.desc("fields"), "i").first()
    if best is None:
        raise ValueError(f"no separator of {candidates} divides the lines of {path}")
    return candidates[best["i"]]


def read_meta_library(spark: SparkSession, path: str) -> DataFrame:
    """Label library (column, label, unit): encoding and separator from the whole file; names of any case."""
    (enc, line), = file_heads(spark, [path]).values()
    sep = find_separator(spark, path)
    lib = read_text_csv(spark, path, sep=sep, encoding=enc)
    names = {n.strip().lower(): n for n in header_names(line, sep)}
    lacking = [c for c in ("column", "label", "unit") if c not in names]
    if lacking:
        raise ValueError(f"columns {lacking} are not in {path}")
    return lib.select(*[F.trim(cl.named(names[c])).alias(c) for c in ("column", "label", "unit")])


def sample_per_file(df: DataFrame, n: int, key: str = "source_year", order: str = "timestamp") -> DataFrame:
    """First ``n`` rows of each file for structure profiling (top-k limited)."""
    from ..operators.quality import first_k_by
    return first_k_by(df, [key], [F.col(order)], n).drop("rn")
