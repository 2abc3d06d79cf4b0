import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattle.functions.calendar import is_month_token, parse_austrian_month
from wattle.sources import files
from wattle.sources.sinks import decimal_comma_text, write_csv, write_parquet


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_electricity_files_year_rules_and_dst(spark, tmp_path):
    f19 = _write(tmp_path / "Day Ahead Preise_M15_2019_English.csv",
                 "Time from [CET/CEST],Time to,Price EXAA 10:15 Auction [EUR/MWh],Price MC Auction [EUR/MWh]\n"
                 "01.01.2019 00:00,01.01.2019 00:15,30.5,-\n"
                 "27.10.2019 2A:00,27.10.2019 2A:15,31.0,n/a\n")
    f21 = _write(tmp_path / "Day Ahead Preise_M15_2021_English.csv",
                 "Time from [CET/CEST],Time to,Price EXAA 10:15 Auction [EUR/MWh],Price MC Auction [EUR/MWh]\n"
                 "01.01.2021 00:00,01.01.2021 00:15,NULL,50.25\n"
                 "01.01.2021 00:15,01.01.2021 00:30,41.0,bad\n")
    r = files.read_electricity(spark, [f19, f21]).orderBy("source_year", "price_exaa_raw").collect()
    assert [x.source_year for x in r] == [2019, 2019, 2021, 2021]
    assert r[0].timestamp is None or r[1].timestamp is None       # "2A" hour does not parse
    assert {x.price_mc_raw for x in r if x.source_year == 2019} == {None}   # MC feed not in 2019
    assert sorted(x.price_mc_raw for x in r if x.price_mc_raw is not None) == [50.25]
    assert sorted(x.price_exaa_raw for x in r if x.source_year == 2021 and x.price_exaa_raw) == [41.0]


def test_production_semicolon_decimal_comma_metadata_rows(spark, tmp_path):
    p = _write(tmp_path / "prod.csv",
               "Header & Timestamp;15;16\nEinheit;GWh;GWh\nQuelle;x;y\n2020-01;1.234,5;12,5\n2020-02;-;7\n",
               "iso-8859-1")
    out = files.read_production(spark, p, {"15": "prod_hydro", "16": "prod_wind"}).orderBy("month").collect()
    assert [x.month for x in out] == [dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    assert out[0].prod_wind == 12.5 and out[0].prod_hydro is None     # thousands dot is not parsed
    assert out[1].prod_hydro is None and out[1].prod_wind == 7.0


def test_economy_sheet_banner_units_footer(spark, tmp_path):
    p = _write(tmp_path / "econ.csv",
               "Statistik Austria,,\n,Berichtszeitraum,Index\n,Einheit,2021=100\n"
               ",Jän.09,101.5\n,Feb.09,102\n,Mär.09,-\n,Quelle: Statistik Austria,\n")
    out = files.read_economy_sheet(spark, p, {"Index": "econ_index"}).orderBy("month").collect()
    assert [(x.month, x.econ_index) for x in out] == [(dt.date(2009, 1, 1), 101.5), (dt.date(2009, 2, 1), 102.0),
                                                      (dt.date(2009, 3, 1), None)]


def test_gas_sheet_german_months(spark, tmp_path):
    p = _write(tmp_path / "gas.csv", "OeGPI\n\nDatum,Monat\n2020-Jan,10.5\n2020-Mrz,11\n2020-Xyz,12\n")
    out = files.read_gas_sheet(spark, p, {"Monat": "oegpi_month"}).orderBy("month").collect()
    assert [(x.month, x.oegpi_month) for x in out] == [(dt.date(2020, 1, 1), 10.5), (dt.date(2020, 3, 1), 11.0)]


def test_meta_library_separator_detection(spark, tmp_path):
    p = _write(tmp_path / "meta.csv", "column;label;unit\nprice_exaa_mean;Preis EXAA;EUR/MWh\n")
    r = files.read_meta_library(spark, p).first()
    assert (r.column, r.label, r.unit) == ("price_exaa_mean", "Preis EXAA", "EUR/MWh")


def test_separator_is_found_from_all_lines(spark, tmp_path):
    cases = {"a": ('column,label,unit\nx,"Preis; EXAA; alt",EUR\ny,"a;b;c;d",t\n', "utf-8", ","),
             "b": ("column;label;unit\nx;Preis, \u00f6ffentlich, neu;\u20ac/MWh\n\ny;a, b, c;t\n", "cp1252", ";"),
             "c": ("Column\tLabel\tUnit\nx\ta,b\tc;d\n", "utf-8", "\t")}
    for name, (text, enc, sep) in cases.items():
        p = _write(tmp_path / f"{name}.csv", text, enc)
        assert files.find_separator(spark, p) == sep
    got = {r.column: (r.label, r.unit) for r in files.read_meta_library(spark, str(tmp_path / "b.csv")).collect()}
    assert got["x"] == ("Preis, \u00f6ffentlich, neu", "\u20ac/MWh") and got["y"] == ("a, b, c", "t")
    assert files.read_meta_library(spark, str(tmp_path / "a.csv")).filter("column = 'x'").first().label == "Preis; EXAA; alt"
    with pytest.raises(ValueError):
        files.find_separator(spark, _write(tmp_path / "d.csv", "one\ntwo\n"))
    with pytest.raises(ValueError):
        files.read_meta_library(spark, _write(tmp_path / "e.csv", "a,b\n1,2\n"))


def test_climate_prunes_columns(spark, tmp_path):
    p = _write(tmp_path / "clim.csv", "DATAFLOW,freq,indic_nrg,geo,TIME_PERIOD,OBS_VALUE,OBS_FLAG\nx,M,HDD,AT,2020-01,410.2,\n")
    df = files.read_climate(spark, p)
    assert df.columns == ["TIME_PERIOD", "indic_nrg", "geo", "OBS_VALUE", "malformed_line"] and df.first().OBS_VALUE == 410.2


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-01", "daily", 1.5, None), ("2020-02-01", "monthly", None, 2)],
                               "date string, aggregation_level string, v double, n long")
    write_parquet(df, str(tmp_path / "pq"), partition_by=["aggregation_level"])
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert sorted(back.select("date", "v").collect()) == sorted(df.select("date", "v").collect())
    assert back.filter(F.col("aggregation_level") == "daily").count() == 1
    write_csv(df, str(tmp_path / "csv"))
    txt = "".join(open(f).read() for f in sorted((tmp_path / "csv").glob("part-*.csv")))
    assert "2020-02-01,monthly,,2" in txt
    assert decimal_comma_text(df).first().v == "1,5"


def test_electricity_cp1252_fallback_and_file_isolation(spark, tmp_path):
    ok = _write(tmp_path / "Day Ahead Preise_M15_2021_English.csv",
                "Time from [CET/CEST],Time to,Price EXAA 10:15 Auction [€/MWh EUR],Price MC Auction [EUR/MWh]\n"
                "01.01.2021 00:00,01.01.2021 00:15,40.5,50.25\n", "cp1252")
    bad = str(tmp_path / "Day Ahead Preise_M15_2022_English.csv")   # does not exist
    failures = []
    r = files.read_electricity(spark, [ok, bad], failures=failures).collect()
    assert len(r) == 1 and r[0].price_exaa_raw == 40.5 and r[0].price_mc_raw == 50.25
    assert [p for p, _ in failures] == [bad]


def test_discover_files_chronological(spark, tmp_path):
    for y in (2021, 2019, 2020):
        _write(tmp_path / f"Day Ahead Preise_M15_{y}_English.csv", "a\n1\n")
    _write(tmp_path / "notes.csv", "a\n")
    got = files.discover_files(spark, str(tmp_path / "*.csv"))
    assert [y for y, _ in got] == [2019, 2020, 2021]
    assert all(p.endswith(f"M15_{y}_English.csv") for y, p in got)
