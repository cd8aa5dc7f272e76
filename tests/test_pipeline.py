"""The batch job from CSV files to the tested warehouse."""

import pathlib
from dataclasses import replace

import pytest
from frames import rows_of

from fairlead import sinks, snapshots
from fairlead.config import JobConfig, scratch_dir
from fairlead.plans import analytics, ingest, ledger, marts, pipeline, quality
from fairlead.schemas import RAW_EXPORTS
from fairlead.sources import landing
from fairlead.sources.files import SOURCE, read_parquet_by_name

EXPORT_HEADER = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"
IMPORT_HEADER = EXPORT_HEADER + ";VL_FRETE;VL_SEGURO"

CODE_FILES = {
    "NCM": ("CO_NCM;CO_SH6;CO_UNID;NO_NCM_POR", "00101600;010160;11;Café", "12019000;120190;10;Soja"),
    "NCM_SH": (
        "CO_SH6;CO_SH4;CO_SH2;NO_SH6_POR;NO_SH4_POR;NO_SH2_POR",
        "010160;0101;01;a;b;c",
        "120190;1201;12;d;e;f",
    ),
    "PAIS": (
        "CO_PAIS;CO_PAIS_ISON3;CO_PAIS_ISOA3;NO_PAIS;NO_PAIS_ING;NO_PAIS_ESP",
        "049;76;BRA;Brasil;Brazil;Brasil",
        "160;156;CHN;China;China;China",
    ),
    "PAIS_BLOCO": ("CO_PAIS;CO_BLOCO;NO_BLOCO", "160;39;Ásia", "160;41;BRICS"),
    "UF": ("SG_UF;CO_UF;NO_UF;NO_REGIAO", "SP;35;São Paulo;Sudeste", "RO;11;Rondônia;Norte"),
    "VIA": ("CO_VIA;NO_VIA", "01;Marítima"),
    "URF": ("CO_URF;NO_URF", "0817600;Guarulhos"),
}


def export(year, value, ncm="00101600", state="SP"):
    return f"{year};04;{ncm};11;160;{state};01;0817600;1;2;{value}"


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join(lines).encode("latin-1") + b"\n")


@pytest.fixture
def config(tmp_path):
    landing = tmp_path / "landing"
    put(landing / "exp" / "EXP_2020.csv", EXPORT_HEADER, export(2020, 100), export(2020, 100))
    put(landing / "exp" / "EXP_2021.csv", EXPORT_HEADER, export(2021, 50, ncm="99999999"))
    put(landing / "imp" / "IMP_2020.csv", IMPORT_HEADER, export(2020, 30, state="RO") + ";5;")
    for name, lines in CODE_FILES.items():
        put(landing / "aux" / f"{name}.csv", *lines)
    return JobConfig(str(landing), str(tmp_path / "warehouse"), allow_missing=True)


def statuses(report):
    return dict(report.select(SOURCE, "status").collect())


def test_whole_run(spark, config):
    report = pipeline.run(spark, config)
    assert dict(report.groupBy("status").count().collect()) == {"pass": 63, "warn": 2}
    warned = rows_of(report.where("status = 'warn'"), "model", "columns", "failures")
    assert warned == [("core_comercio", "co_ncm", 1), ("stg_exportacoes", "co_ncm", 1)]

    stored = pipeline.stored_marts(spark, config.layout)
    assert rows_of(stored["mart_balanca_comercial"], "ano", "sg_uf", "saldo_fob_usd") == [
        (2020, "RO", -30.0),
        (2020, "SP", 200.0),
        (2021, "SP", 50.0),
    ]
    assert rows_of(stored["mart_importacoes_por_estado"], "vl_cif_usd") == [(35.0,)]
    products = rows_of(stored["mart_top_produtos"], "ano", "direcao", "co_ncm", "no_ncm_pt", "rank_ano_direcao")
    assert products == [
        (2020, "EXP", "00101600", "Café", 1),
        (2020, "IMP", "00101600", "Café", 1),
        (2021, "EXP", "99999999", None, 1),
    ]
    assert rows_of(analytics.list_blocs(stored["mart_blocos_economicos"])) == [("39", "Ásia"), ("41", "BRICS")]

    assert pipeline.warehouse_exists(spark, config.layout)
    status = pipeline.freshness(spark, config.layout).first()
    assert (status.linhas_core, status.ano_min, status.ano_max) == (4, 2020, 2021)
    assert status.atualizado_em is not None


def test_stored_fact_is_pruned_by_direction_and_year(spark, config):
    pipeline.run(spark, config)
    fact = pipeline.stored_core(spark, config.layout)["core_comercio"]
    plan = (
        fact.where("direcao = 'EXP' AND ano = 2021")
        .groupBy("sg_uf")
        .sum("vl_fob_usd")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "(direcao" in scan.split("PartitionFilters")[1] and "(ano" in scan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<sg_uf:string,vl_fob_usd:double>" in scan


def test_report_and_selection(spark, config):
    chosen = JobConfig(
        config.landing_root,
        config.warehouse_root,
        directions=("EXP",),
        file_years=(2021,),
        code_tables=False,
    )
    row = ingest.convert(spark, chosen).first()
    assert (row.arquivo, row.linhas, row.colunas, row.status) == ("EXP_2021", 1, 11, "OK")
    assert row.bytes_csv > 0 and row.bytes_parquet > 0
    assert row.razao == row.bytes_csv / row.bytes_parquet


def test_files_already_converted_are_skipped_unless_forced(spark, config, tmp_path):
    ingest.convert(spark, config)
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, 7), export(2021, 8))
    put(tmp_path / "landing/exp/EXP_2022.csv", EXPORT_HEADER, export(2022, 9))

    kept = JobConfig(config.landing_root, config.warehouse_root, force=False)
    assert statuses(ingest.convert(spark, kept)) == {
        **{name: "SKIPPED" for name in CODE_FILES},
        "EXP_2020": "SKIPPED",
        "EXP_2021": "SKIPPED",
        "EXP_2022": "OK",
        "IMP_2020": "SKIPPED",
    }
    values = lambda: rows_of(spark.read.parquet(config.layout.raw("EXP")), SOURCE, "VL_FOB")
    assert values() == [("EXP_2020", 100), ("EXP_2020", 100), ("EXP_2021", 50), ("EXP_2022", 9)]

    # A forced run of one year replaces that year only, stray rows of other years included.
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, 7), export(2020, 8))
    ingest.convert(
        spark, JobConfig(config.landing_root, config.warehouse_root, file_years=(2021,), code_tables=False)
    )
    assert values() == [
        ("EXP_2020", 100),
        ("EXP_2020", 100),
        ("EXP_2021", 7),
        ("EXP_2021", 8),
        ("EXP_2022", 9),
    ]


def test_file_that_lost_its_rows_is_emptied(spark, config, tmp_path):
    ingest.convert(spark, config)
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER)
    put(tmp_path / "landing/exp/EXP_2022.csv", EXPORT_HEADER)
    report = ingest.convert(spark, config)
    assert rows_of(report.where("arquivo LIKE 'EXP%'"), SOURCE, "linhas", "status") == [
        ("EXP_2020", 2, "OK"),
        ("EXP_2021", 0, "OK"),
        ("EXP_2022", 0, "OK"),
    ]
    assert rows_of(spark.read.parquet(config.layout.raw("EXP")), SOURCE) == [("EXP_2020",), ("EXP_2020",)]


def test_failed_refresh_keeps_the_stored_rows(spark, config, tmp_path):
    ingest.convert(spark, config)
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, "many"))
    report = ingest.convert(spark, config)
    failed = rows_of(report.where("status = 'FAILED'"), SOURCE, "linhas", "bytes_parquet")
    assert failed == [("EXP_2021", None, None)]
    stored = spark.read.parquet(config.layout.raw("EXP"))
    assert rows_of(stored, SOURCE, "VL_FOB") == [("EXP_2020", 100), ("EXP_2020", 100), ("EXP_2021", 50)]


def test_failed_refresh_keeps_a_stored_code_table(spark, config, tmp_path):
    ingest.convert(spark, config)
    put(tmp_path / "landing/aux/VIA.csv", "CO_VIA;NO_VIA", "01")
    report = ingest.convert(spark, config)
    assert statuses(report)["VIA"] == "FAILED"
    assert rows_of(spark.read.parquet(config.layout.code_table("VIA"))) == [("01", "Marítima")]


def test_report_gives_real_columns_reasons_and_unknown_files(spark, config, tmp_path):
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER + ";MORE", export(2021, 5) + ";x")
    put(tmp_path / "landing/exp/EXP_2022.csv", EXPORT_HEADER.replace("VL_FOB", "VALUE"), export(2022, 5))
    put(tmp_path / "landing/exp/EXP_2023.csv", EXPORT_HEADER, export("year", 5))
    put(tmp_path / "landing/exp/exp_2024.csv", EXPORT_HEADER, export(2024, 5))
    rows = {row.arquivo.rsplit("/", 1)[-1]: row for row in ingest.convert(spark, config).collect()}
    assert (rows["EXP_2020"].colunas, rows["EXP_2021"].colunas, rows["VIA"].colunas) == (11, 12, 2)
    assert rows["EXP_2022"].status == rows["EXP_2023"].status == "FAILED"
    assert "lacks VL_FOB" in rows["EXP_2022"].motivo and "year" in rows["EXP_2023"].motivo
    assert rows["EXP_2020"].motivo is None
    assert (rows["exp_2024.csv"].status, rows["exp_2024.csv"].linhas) == ("UNKNOWN", None)


def test_staged_rows_of_converted_files_are_pruned_by_year(spark, config):
    ingest.convert(spark, config)
    staged = pipeline.stage(pipeline.stored_raw(spark, config.layout), 2021, 2021)["stg_exportacoes"]
    scan = next(x for x in staged._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "GreaterThanOrEqual(ano,2021)" in scan and "LessThanOrEqual(ano,2021)" in scan
    assert rows_of(staged, "ano", "vl_fob_usd") == [(2021, 50.0)]


def test_raw_tables_of_several_generations_are_united(spark, config):
    """A file stored by another converter: numeric codes, another order, no integer year."""
    ingest.convert(spark, config)
    old = spark.createDataFrame([(5, 101600, "2019")], "VL_FOB bigint, CO_NCM bigint, CO_ANO string")
    old.write.parquet(f"{config.layout.raw('EXP')}/{SOURCE}=EXP_2019")
    raw = pipeline.stored_raw(spark, config.layout)["EXP"]
    assert rows_of(raw, "ano", "CO_NCM", "VL_FOB") == [
        (2019, "101600", 5),
        (2020, "00101600", 100),
        (2020, "00101600", 100),
        (2021, "99999999", 50),
    ]


def test_bad_file_fails_alone(spark, config, tmp_path):
    put(tmp_path / "landing/exp/EXP_2020.csv", EXPORT_HEADER, export(2020, "many"))
    found = statuses(ingest.convert(spark, config))
    assert (found["EXP_2020"], found["EXP_2021"], found["IMP_2020"]) == ("FAILED", "OK", "OK")
    assert rows_of(spark.read.parquet(config.layout.raw("EXP")), SOURCE) == [("EXP_2021",)]
    with pytest.raises(RuntimeError, match="EXP_2020"):
        pipeline.run(spark, config)


def test_failed_test_stops_the_build_before_the_next_layer(spark, config, tmp_path):
    put(tmp_path / "landing/aux/VIA.csv", "CO_VIA;NO_VIA", "01;a", "01;b", ";c")
    with pytest.raises(quality.QualityError) as failure:
        pipeline.run(spark, config)
    assert str(failure.value) == "stg_vias.co_via not_null: 1; stg_vias.co_via unique: 1"
    assert not pipeline.warehouse_exists(spark, config.layout)

    lenient = JobConfig(config.landing_root, config.warehouse_root, fail_fast=False, allow_missing=True)
    report = pipeline.run(spark, lenient)
    assert rows_of(report.where("status = 'fail'"), "model", "test") == [
        ("stg_vias", "not_null"),
        ("stg_vias", "unique"),
    ]


def test_failed_test_of_the_fact_keeps_the_core_of_the_last_build(spark, config, tmp_path):
    pipeline.run(spark, config)
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, "2021;13;1;11;160;SP;01;1;1;2;3", "2021;;1;11;160;SP;01;1;1;2;3")
    with pytest.raises(quality.QualityError, match="stg_exportacoes.mes accepted_values: 1; stg_exportacoes.mes not_null: 1"):
        pipeline.run(spark, config)
    assert pipeline.stored_core(spark, config.layout)["core_comercio"].count() == 4
    assert sorted(p.name for p in (tmp_path / "warehouse/core").iterdir() if "comercio" in p.name) == ["core_comercio"]


def test_run_without_any_file_of_a_direction(spark, config, tmp_path):
    only_exports = JobConfig(config.landing_root, str(tmp_path / "other"), directions=("EXP",), allow_missing=True)
    pipeline.run(spark, only_exports)
    balance = pipeline.stored_marts(spark, only_exports.layout)["mart_balanca_comercial"]
    assert rows_of(balance.selectExpr("sum(vl_imp_fob_usd)")) == [(0.0,)]


def test_config_refuses_nonsense():
    with pytest.raises(ValueError, match="unknown directions"):
        JobConfig("in", "out", directions=("EXP", "ambos"))
    with pytest.raises(ValueError, match="empty year window"):
        JobConfig("in", "out", first_year=2024, last_year=2020)


def test_scratch_space_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_run_refuses_missing_files(spark, config, tmp_path):
    strict = JobConfig(config.landing_root, str(tmp_path / "strict"), first_year=2020, last_year=2021)
    assert pipeline.missing_files(spark, strict) == ["IMP_2021"]
    with pytest.raises(RuntimeError, match="IMP_2021"):
        pipeline.run(spark, strict)


def test_a_label_landed_twice_stops_the_conversion(spark, config, tmp_path):
    put(tmp_path / "landing" / "more" / "EXP_2020.csv", EXPORT_HEADER, export(2020, 7))
    with pytest.raises(ValueError, match="EXP_2020 landed twice"):
        ingest.convert(spark, config)


def test_a_renamed_column_fails_its_file_only(spark, config, tmp_path):
    put(tmp_path / "landing" / "imp" / "IMP_2021.csv", IMPORT_HEADER.replace("VL_FRETE", "vl_frete"), export(2021, 1) + ";1;1")
    found = statuses(ingest.convert(spark, config))
    assert found["IMP_2021"] == ingest.FAILED and found["IMP_2020"] == ingest.OK


def jobs_of(spark, work):
    """How many Spark jobs a piece of work submits."""
    context = spark.sparkContext
    context.setJobGroup("counted", "", False)
    before = len(context.statusTracker().getJobIdsForGroup("counted"))
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup("counted")) - before


def test_bad_files_cost_no_further_read_of_good_ones_nor_jobs_by_file(spark, tmp_path, monkeypatch):
    read = []
    rows = ingest._rows
    monkeypatch.setattr(ingest, "_rows", lambda s, paths, *more: (read.append(sorted(paths)), rows(s, paths, *more))[1])
    jobs = []
    for n in (3, 12):
        root = tmp_path / f"landing-{n}"
        for k in range(n):
            put(root / f"EXP_{2000 + k}.csv", EXPORT_HEADER, export(2000 + k, "many" if k % 3 == 1 else k))
        config = JobConfig(str(root), str(tmp_path / f"out-{n}"), directions=("EXP",), code_tables=False)
        read.clear()
        report = []
        jobs.append(jobs_of(spark, lambda: report.extend(ingest.convert(spark, config).collect())))
        found = {r.arquivo: (r.status, r.linhas, r.motivo) for r in report}
        for k in range(n):
            expected = ("FAILED", None) if k % 3 == 1 else ("OK", 1)
            assert found[f"EXP_{2000 + k}"][:2] == expected
        assert "1 malformed rows, such as: 2001;04" in found["EXP_2001"][2]
        # Everything once, then only the bad ones for their reason.
        assert [len(paths) for paths in read] == [n, n // 3]
    # Nine files more; adaptive execution alone may add or save a job.
    assert abs(jobs[0] - jobs[1]) <= 2


def test_part_files_with_different_headers_fail_their_dataset(spark, config, tmp_path):
    put(tmp_path / "landing/exp/EXP_2022.csv/part-0.csv", EXPORT_HEADER, export(2022, 1))
    put(tmp_path / "landing/exp/EXP_2022.csv/part-1.csv", ";".join(reversed(EXPORT_HEADER.split(";"))), export(2022, 1))
    put(tmp_path / "landing/exp/EXP_2023.csv", "")
    found = {row.arquivo: (row.status, row.motivo) for row in ingest.convert(spark, config).collect()}
    assert found["EXP_2022"][0] == "FAILED" and "different headers" in found["EXP_2022"][1]
    assert found["EXP_2023"][0] == "FAILED" and "lacks CO_ANO" in found["EXP_2023"][1]
    assert found["EXP_2020"][0] == "OK"


def marts_of(spark, layout):
    return {name: rows_of(frame) for name, frame in pipeline.stored_marts(spark, layout).items()}


def test_failing_mart_test_leaves_the_whole_last_warehouse(spark, config, tmp_path, monkeypatch):
    pipeline.run(spark, config)
    before, fact = marts_of(spark, config.layout), pipeline.stored_core(spark, config.layout)["core_comercio"].count()
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, 70), export(2021, 1))
    plain = marts.trade_balance
    monkeypatch.setattr(marts, "trade_balance", lambda t: plain(t).selectExpr("* EXCEPT (sg_uf)", "CAST(NULL AS STRING) AS sg_uf"))
    with pytest.raises(quality.QualityError, match="mart_balanca_comercial.sg_uf not_null"):
        pipeline.run(spark, config)
    assert marts_of(spark, config.layout) == before
    assert pipeline.stored_core(spark, config.layout)["core_comercio"].count() == fact
    for table in (*marts.TOTALS, "core_comercio", "core_produtos"):
        assert len(list((tmp_path / "warehouse/core" / table).glob("versao=*"))) == 1
    monkeypatch.undo()
    pipeline.run(spark, config)
    assert marts_of(spark, config.layout) != before


def test_publish_that_dies_leaves_a_readable_warehouse(spark, config, monkeypatch):
    pipeline.run(spark, config)
    before = marts_of(spark, config.layout)
    # Dies while the snapshot is written: its folder exists, without a committed file.
    number = snapshots._newest(spark, config.layout) + 1
    path = snapshots._path(config.layout, number)
    (pathlib.Path(path) / "_temporary/0").mkdir(parents=True)
    (pathlib.Path(path) / "_temporary/0/part-0.parquet").write_bytes(b"half")
    assert marts_of(spark, config.layout) == before
    assert snapshots._newest(spark, config.layout) == number - 1


def test_nothing_is_renamed_when_a_build_is_published(spark, config, monkeypatch):
    ingest.convert(spark, config)
    renamed = []
    publish = sinks.publish
    monkeypatch.setattr(sinks, "publish", lambda s, staged, path: (renamed.append(path), publish(s, staged, path))[1])
    for _ in range(4):
        pipeline.build(spark, config, pipeline.stored_raw(spark, config.layout))
    assert {path.rsplit("/", 2)[1] for path in renamed} == {"quality"}
    # Old builds go, the last ones stay for readers under way.
    assert len(list(pathlib.Path(config.layout.core("core_comercio")).glob("versao=*"))) == snapshots.KEPT
    assert len(list(pathlib.Path(config.layout.snapshots()).glob("0*"))) == snapshots.KEPT


def test_refresh_of_a_file_equals_a_whole_build_and_reads_no_other_fact(spark, config, tmp_path):
    put(tmp_path / "landing/exp/EXP_2022.csv", EXPORT_HEADER, export(2022, 5), export(2021, 6), export(2020, 7, state="RO"))
    pipeline.run(spark, config)
    others = [e for e in snapshots.current(spark, config.layout) if e.part and e.part != "EXP_2022"]
    put(tmp_path / "landing/exp/EXP_2022.csv", EXPORT_HEADER, export(2022, 50, ncm="99999999"), export(2021, 60))
    # The stored fact of the other files cannot be read while the refresh runs.
    hidden = [f for e in others if e.table == "core_comercio" for f in pathlib.Path(e.folder).rglob("*.parquet")]
    kept = {f: f.read_bytes() for f in hidden}
    for f in hidden:
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
        f.write_bytes(b"no parquet")
    report = pipeline.run(spark, replace(config, force=False, revised=True))
    for f, content in kept.items():
        f.write_bytes(content)
    assert hidden and report.where("status = 'fail'").count() == 0
    warned = rows_of(report.where("status = 'warn'"), "model", "columns", "failures")
    assert warned == [("core_comercio", "co_ncm", 2), ("stg_exportacoes", "co_ncm", 2)]
    refreshed, status = marts_of(spark, config.layout), pipeline.freshness(spark, config.layout).first()

    whole = replace(config, warehouse_root=str(tmp_path / "whole"))
    pipeline.run(spark, whole)
    assert refreshed == marts_of(spark, whole.layout)
    assert status[:3] == pipeline.freshness(spark, whole.layout).first()[:3] == (6, 2020, 2022)
    assert rows_of(pipeline.stored_core(spark, config.layout)["core_comercio"]) == rows_of(
        pipeline.stored_core(spark, whole.layout)["core_comercio"]
    )


def test_refresh_follows_emptied_files_and_other_windows(spark, config, tmp_path):
    pipeline.run(spark, config)
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER)
    revised = replace(config, force=False, revised=True)
    pipeline.run(spark, revised)
    assert pipeline.freshness(spark, config.layout).first()[:3] == (3, 2020, 2020)
    # Built for other years: everything is built.
    pipeline.run(spark, replace(revised, first_year=2021))
    assert pipeline.freshness(spark, config.layout).first()[:3] == (0, None, None)
    pipeline.run(spark, revised)
    assert pipeline.freshness(spark, config.layout).first()[:3] == (3, 2020, 2020)


def test_revised_files_are_found_by_the_ledger(spark, config, tmp_path):
    ingest.convert(spark, config)
    revised = replace(config, force=False, revised=True)
    assert set(statuses(ingest.convert(spark, revised)).values()) == {"SKIPPED"}
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, 7), export(2021, 8))
    put(tmp_path / "landing/imp/IMP_2021.csv", IMPORT_HEADER)
    put(tmp_path / "landing/aux/VIA.csv", "CO_VIA;NO_VIA", "01;Marítima", "02;Fluvial")
    landed = landing.inventory(spark, config.landing_root)
    assert rows_of(ledger.pending(spark, config.layout, landed), SOURCE) == [("EXP_2021",), ("IMP_2021",), ("VIA",)]
    found = statuses(ingest.convert(spark, revised))
    assert sorted(k for k, v in found.items() if v == "OK") == ["EXP_2021", "IMP_2021", "VIA"]
    assert rows_of(spark.read.parquet(config.layout.raw("EXP")).where("arquivo = 'EXP_2021'"), "VL_FOB") == [(7,), (8,)]
    assert set(statuses(ingest.convert(spark, revised)).values()) == {"SKIPPED"}
    # A failed conversion is no conversion.
    put(tmp_path / "landing/exp/EXP_2021.csv", EXPORT_HEADER, export(2021, "bad"))
    for _ in range(2):
        assert statuses(ingest.convert(spark, revised))["EXP_2021"] == "FAILED"


def test_fact_tests_do_not_read_the_fact(spark, config, monkeypatch):
    """Row-level tests are counted in the write, references from the totals."""
    ingest.convert(spark, config)
    scanned = []
    row_level, orphans = quality._row_level, quality._orphans
    monkeypatch.setattr(quality, "_row_level", lambda df, checks: (scanned.append(checks[0].model), row_level(df, checks))[1])
    monkeypatch.setattr(
        quality, "_orphans", lambda models, checks, counted: (scanned.extend(
            c.model for c in checks if (c.model, c.columns[0]) not in counted), orphans(models, checks, counted))[1]
    )
    report = pipeline.build(spark, config, pipeline.stored_raw(spark, config.layout))
    assert not {"core_comercio", "stg_exportacoes", "stg_importacoes"} & set(scanned)
    assert report.where("model = 'core_comercio'").count() == 8


def test_status_reads_the_snapshot_only(spark, config):
    pipeline.run(spark, config)
    plan = pipeline.freshness(spark, config.layout)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1
    place = scans[0].split("Location")[1].split("PartitionFilters")[0]
    assert "/published/" in place and "/core/" not in place


def test_schemas_of_many_datasets_take_a_fixed_number_of_jobs(spark, config):
    def stored(n, old):
        root = f"{config.warehouse_root}/many-{n}-{old}"
        for k in range(n):
            rows = spark.createDataFrame([(k, 5, "2019") if k < old else (k, "00005", "2020")],
                                         f"VL_FOB bigint, CO_NCM {'bigint' if k < old else 'string'}, CO_ANO string")
            rows.write.parquet(f"{root}/d-{k:02d}")
        return [f"{root}/d-{k:02d}" for k in range(n)]

    def jobs(paths):
        return jobs_of(spark, lambda: read_parquet_by_name(spark, paths, RAW_EXPORTS, {"ano": "int(CO_ANO)"}))

    assert jobs(stored(4, 0)) == jobs(stored(16, 0)) == 1
    mixed = stored(16, 8)
    assert jobs(mixed) <= 3
    rows = rows_of(read_parquet_by_name(spark, mixed, RAW_EXPORTS, {"ano": "int(CO_ANO)"}), "VL_FOB", "CO_NCM", "ano")
    assert sorted(rows) == [(k, "5", 2019) if k < 8 else (k, "00005", 2020) for k in range(16)]
