"""Readers' hard cases, and the job from hand-made raw files to its exports."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattle.operators.merge import consolidate
from wattle.plans import consolidate as C
from wattle.plans.job import run
from wattle.sources import files, versions

HEAD = "Time from [CET/CEST],Time to,Price EXAA 10:15 Auction [EUR/MWh],Price MC Auction [EUR/MWh]\n"


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_encoding_is_decided_on_the_whole_file(spark, tmp_path):
    p = _write(tmp_path / "a.csv", "a,b\n1,x\n2,\u2013 5 \u20ac \u201eja\u201c\n", "cp1252")
    got = {r.a: r.b for r in files.read_text_csv(spark, p).collect()}
    assert got == {"1": "x", "2": "\u2013 5 \u20ac \u201eja\u201c"}
    q = _write(tmp_path / "b.csv", "a,b\n1,\u00e4\u20ac\n")
    assert files.read_text_csv(spark, q).first().b == "\u00e4\u20ac"
    assert len(files.CP1252_C1) == 27


def test_surplus_fields_leave_a_trace(spark, tmp_path):
    p = _write(tmp_path / "Day Ahead Preise_M15_2021_English.csv",
               HEAD + "01.01.2021 00:00,01.01.2021 00:15,1,2\n01.01.2021 00:15,01.01.2021 00:30,3,4,SURPLUS\n")
    rows = files.read_electricity(spark, [p]).orderBy("timestamp").collect()
    assert [r.price_exaa_raw for r in rows] == [1.0, 3.0]
    assert rows[0].malformed_line is None and rows[1].malformed_line.endswith("4,SURPLUS")


def test_headers_with_dots_load_and_alike_headers_share_a_scan(spark, tmp_path):
    dotted = HEAD.replace("Time to", "Time.to").replace("[EUR/MWh]", "[EUR/MWh v1.0]")
    ps = [_write(tmp_path / f"Day Ahead Preise_M15_{y}_English.csv", h + f"01.01.{y} 00:00,x,{y},{y}\n")
          for y, h in ((2020, HEAD), (2021, dotted), (2022, HEAD))]
    df = files.read_electricity(spark, ps)
    assert sorted((r.source_year, r.price_exaa_raw) for r in df.collect()) == [(2020, 2020.0), (2021, 2021.0), (2022, 2022.0)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_sheet_columns_are_chosen_by_name(spark, tmp_path):
    p = _write(tmp_path / "gas.csv", "banner,,,,\n\nJahr , Datum,extra,Monat,Quartal,Saison\n4,2020-Mrz,z,1,2,3\n9,2020-Xyz,z,1,2,3\n")
    r = files.read_gas_sheet(spark, p).collect()
    assert [(x.month, x.oegpi_month, x.oegpi_quarter, x.oegpi_season, x.oegpi_year) for x in r] == [(dt.date(2020, 3, 1), 1, 2, 3, 4)]
    with pytest.raises(ValueError):
        files.read_gas_sheet(spark, p, {"Wochen": "w"})


def test_unlisted_indicator_and_repeated_month_fail(spark):
    cols = "TIME_PERIOD string, indic_nrg string, geo string, OBS_VALUE double"
    ok = [("2020-01", "CDD", "AT", 1.0), ("2020-01", "HDD", "AT", 2.0), ("2020-01", "CDD", "FR", 5.0)]
    wide = lambda rows: C.climate_wide(spark.createDataFrame(rows, cols), ("CDD", "HDD"), ("AT",))
    r = wide(ok).first()
    assert (r.month, r.climate_cdd_at, r.climate_hdd_at) == (dt.date(2020, 1, 1), 1.0, 2.0)
    for bad in (("2020-01", "XDD", "AT", 1.0), ("2020-01", "CDD", "AT", 9.0)):
        with pytest.raises(PySparkException):
            wide([*ok, bad]).collect()


def test_a_repeated_key_in_a_joined_block_fails(spark):
    a = spark.createDataFrame([("2020-01-01", "monthly", 1.0)], "date string, aggregation_level string, a double")
    b = spark.createDataFrame([("2020-01-01", "monthly", 1.0), ("2020-01-01", "monthly", 2.0)],
                              "date string, aggregation_level string, b double")
    assert consolidate([a, b.limit(1)], how="union").count() == 1
    with pytest.raises(PySparkException):
        consolidate([a, b], how="union").collect()


def _raw_folder(d):
    for y in (2020, 2021):
        _write(d / f"Day Ahead Preise_M15_{y}_English.csv", HEAD + "".join(
            f"0{m}.01.{y} 00:00,x,{10 * m},{20 * m}\n" for m in range(1, 4)) + f"05.01.{y} 2A:00,x,9,9\n")
    _write(d / "carbon.csv", "Date,Exchange rate EUR/USD(<2019),Exchange rate EUR/USD(>2018),Primary Market(<2019),"
           "Primary Market(>2018),Secondary Market(>2018),Unnamed: 6\n2020-01-02,1,1.1,20,25,24,\n2021-01-04,1,1.2,30,35,34,\n")
    _write(d / "climate.csv", "freq,indic_nrg,geo,TIME_PERIOD,OBS_VALUE\n" + "".join(
        f"M,{i},{g},2020-01,{n}\n" for n, (i, g) in enumerate([(i, g) for i in ("CDD", "HDD") for g in ("AT", "EU27_2020", "FR")])))
    names = list(files.PRODUCTION_COLUMNS)
    _write(d / "production.csv", "Header & Timestamp;" + ";".join(names) + "\nEinheit" + ";GWh" * len(names)
           + "\n2020-01" + ";1,5" * len(names) + "\n", "iso-8859-1")
    _write(d / "gas.csv", "b,,,,\nDatum,Monat,Quartal,Saison,Jahr\n2020-Jan,1,2,3,4\n")
    econ = list(files.ECONOMY_COLUMNS)
    _write(d / "economy.csv", "Statistik\n,Berichtszeitraum," + ",".join(f'"{c}"' for c in econ) + "\n,Einheit" + ",x" * len(econ)
           + "\n,J\u00e4n.20" + ",7" * len(econ) + "\n,Quelle: x\n")


def test_job_from_raw_files_to_exports(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    _write(raw / "Day Ahead Preise_M15_2022_English.csv", "nothing,useful\n1,2\n")
    _write(raw / "meta.csv", "column;label;unit\noegpi_month;Gas, monthly;index\n")
    rep = {r.source: r for r in run(spark, None, out, raw_dir=str(raw), allow_missing_files=True).collect()}
    assert {k for k, r in rep.items() if r.status == "ok"} == {"electricity", "carbon", "climate", "production", "gas", "economy"}
    assert [r.error for k, r in rep.items() if k.endswith("M15_2022_English.csv")] == ["no price column"]
    cons = versions.read(spark, out + "/consolidated")
    assert len(cons.columns) == 59
    fin = versions.read(spark, out + "/finalised")
    assert len(fin.columns) == 60 and dict(fin.dtypes)["date_dt"] == "date"
    jan = fin.filter("aggregation_level = 'monthly' AND date = '2020-01-01'").first()
    assert (jan.climate_cdd_at, jan.climate_hdd_eu, jan.oegpi_year, jan.econ_imports_energy_EUR) == (0.0, 4.0, 4.0, 7.0)
    assert rep["electricity"].rejected == 2                       # the hours "2A"
    describe = spark.read.option("header", True).option("sep", ";").csv(out + "/reports/describe")
    assert {r.column: (r.label, r.unit) for r in describe.collect()}["oegpi_month"] == ("Gas, monthly", "index")
    ready = versions.read(spark, out + "/analysis_ready")
    assert not set(C.ANALYSIS_DROPPED) & set(ready.columns)
    assert ready.filter(F.col("price_combined").isNull()).count() == 0
    r = ready.filter("aggregation_level = 'monthly' AND date = '2020-01-01'").first()
    assert r.prod_renewable == 10.0 and r.prod_total == 14.0


def test_a_missing_source_keeps_the_old_table(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    run(spark, None, out, raw_dir=str(raw), reports=False)
    (raw / "gas.csv").unlink()
    rep = {r.source: r.status for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    assert rep["gas"] == "failed" and rep["consolidated"] == "not written"
    assert "oegpi_year" in versions.read(spark, out + "/consolidated").columns


def test_an_unreadable_file_blocks_publication(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    run(spark, None, out, raw_dir=str(raw), reports=False)
    _write(raw / "Day Ahead Preise_M15_2022_English.csv", "nothing,useful\n1,2\n")
    rep = {r.source: r.status for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    assert rep["electricity"] == "failed" and rep["consolidated"] == "not written"
    assert versions.read(spark, out + "/consolidated").count() > 0


def test_every_source_feeds_the_ledger(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    before = {r.source: r for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    rows = sorted(map(str, versions.read(spark, out + "/consolidated").collect()))
    cut = {}
    for f, sep in (("Day Ahead Preise_M15_2020_English.csv", ","), ("carbon.csv", ","), ("climate.csv", ","), ("production.csv", ";"),
                   ("gas.csv", ","), ("economy.csv", ",")):
        lines = (raw / f).read_bytes().split(b"\n")
        at = max(i for i, x in enumerate(lines) if x.count(sep.encode()) > 1 and b"Quelle" not in x and b"2A:00" not in x)
        cut[f] = lines[at] + (sep + "SURPLUS").encode() * 40
        (raw / f).write_bytes(b"\n".join([*lines[:at + 1], cut[f], *lines[at + 1:]]))
    rep = {r.source: r for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    assert all(rep[s].status == "ok" and rep[s].rejected == before[s].rejected + 1 for s in
               ("electricity", "carbon", "climate", "production", "gas", "economy"))
    lines = versions.read(spark, out + "/rejects").filter("reason = 'too many fields'").collect()
    assert {r.source_file.replace("%20", " ") for r in lines} == set(cut) and all("SURPLUS" in r.line for r in lines)
    assert sorted(map(str, versions.read(spark, out + "/consolidated").collect())) == rows       # the good lines are as before


def test_found_indicators_become_columns(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    with open(raw / "climate.csv", "a") as f:
        f.write("M,WND,AT,2020-01,42\n")
    rep = {r.source: r.status for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    cons = versions.read(spark, out + "/consolidated")
    assert rep["climate"] == "ok" and cons.filter("climate_wnd_at = 42").count() == 1 and "climate_wnd_eu" not in cons.columns
    with open(raw / "climate.csv", "a") as f:
        f.write("M,WND,AT,2020-01,43\n")
    rep = {r.source: r for r in run(spark, None, out, raw_dir=str(raw), reports=False).collect()}
    assert rep["climate"].status == "failed" and "WND" in rep["climate"].error and rep["consolidated"].status == "not written"


def test_a_run_that_dies_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    first = versions.publish(df, path, ["k"], "a")
    dying = df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("killed"))).otherwise(F.col("id")))
    with pytest.raises(Exception):
        versions.publish(dying, path, ["k"], "b")
    assert versions.current(spark, path) == first and versions.read(spark, path).count() == 10
    second = versions.publish(df.filter("id < 3"), path, ["k"])
    assert second["before"] == first["version"] and versions.read(spark, path).count() == 3
    versions.publish(df.limit(0), path, ["k"])
    assert versions.read(spark, path).columns == ["id", "k"] and versions.read(spark, path).count() == 0
    kept = {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")}
    assert len(kept) == 2 and first["version"] not in kept
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_only_a_changed_source_is_built_again(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    _raw_folder(raw)
    run(spark, None, out, raw_dir=str(raw), reports=False)
    stamp = {s: versions.current(spark, f"{out}/sources/{s}")["version"] for s in files_of(out)}
    _write(raw / "gas.csv", "b,,,,\nDatum,Monat,Quartal,Saison,Jahr\n2020-Jan,1,2,3,99\n")
    rep = {r.source: r.status for r in run(spark, None, out, raw_dir=str(raw), reports=False, changed_only=True).collect()}
    assert rep == dict.fromkeys(stamp, "kept") | {"gas": "ok"}
    now = {s: versions.current(spark, f"{out}/sources/{s}")["version"] for s in stamp}
    assert {s for s in stamp if now[s] != stamp[s]} == {"gas"}
    assert versions.read(spark, out + "/consolidated").filter("oegpi_year = 99").count() == 1


def files_of(out):
    from pathlib import Path
    return [p.name for p in Path(out, "sources").iterdir()]
