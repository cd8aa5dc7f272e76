"""Readers, sinks and the landing inventory."""

import pytest
from frames import raw_exports, rows_of, table
from pyspark.errors import PySparkException

from fairlead import sinks
from fairlead.plans.ingest import JOB_FAILURES
from fairlead.schemas import RAW_EXPORTS
from fairlead.sources import landing
from fairlead.sources.files import SOURCE, MissingColumns, first_lines, read_code_csv, read_parquet_by_name, read_trade_csv

HEADER = '"CO_ANO";"CO_MES";"CO_NCM";"CO_UNID";"CO_PAIS";"SG_UF_NCM";"CO_VIA";"CO_URF";"QT_ESTAT";"KG_LIQUIDO";"VL_FOB"'


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join(lines).encode("latin-1") + b"\n")
    return str(path)


def test_codes_keep_zeros_and_empty_fields_are_null(spark, tmp_path):
    path = write(
        tmp_path / "EXP_2020.csv",
        HEADER,
        '"2020";"04";"00101600";"11";"049";"SP";"01";"0817600";"";10;20',
        '"2020";"04";"";"11";"049";;"01";"0817600";5;;20',
    )
    assert rows_of(read_trade_csv(spark, [path], "EXP")) == [
        ("2020", "04", "00101600", "11", "049", "SP", "01", "0817600", None, 10, 20, "EXP_2020"),
        ("2020", "04", None, "11", "049", None, "01", "0817600", 5, None, 20, "EXP_2020"),
    ]


def test_headers_in_another_order_are_read_by_name(spark, tmp_path):
    names = HEADER.split(";")
    values = ['"2020"', '"04"', '"1"', '"11"', '"049"', '"SP"', '"01"', '"08"', "2", "9", "1"]
    first = write(tmp_path / "EXP_2020.csv", HEADER, ";".join(values))
    second = write(tmp_path / "EXP_2021.csv", ";".join(reversed(names)), ";".join(reversed(['"2021"', *values[1:8], "4", "9", "3"])))
    rows = read_trade_csv(spark, [first, second], "EXP")
    assert rows_of(rows, "CO_ANO", "VL_FOB", "QT_ESTAT", "CO_NCM", SOURCE) == [
        ("2020", 1, 2, "1", "EXP_2020"),
        ("2021", 3, 4, "1", "EXP_2021"),
    ]


def test_a_header_without_a_contract_column_fails(spark, tmp_path):
    path = write(tmp_path / "EXP_2020.csv", HEADER.replace("VL_FOB", "vl_fob"), '"2020";"04";"1";"11";"049";"SP";"01";"08";1;2;3')
    with pytest.raises(MissingColumns, match="lacks VL_FOB"):
        read_trade_csv(spark, [path], "EXP")


def test_accents_separators_and_quotes_in_code_tables(spark, tmp_path):
    path = write(tmp_path / "UF.csv", '"CO_UF";"NO_UF"', '"01";"Rondônia; ""norte"""')
    assert rows_of(read_code_csv(spark, path)) == [("01", 'Rondônia; "norte"')]


@pytest.mark.parametrize("number", ["abc", "12.5"])
def test_text_in_a_number_fails_the_read(spark, tmp_path, number):
    path = write(tmp_path / "EXP_2020.csv", HEADER, f'"2020";"04";"1";"11";"049";"SP";"01";"08";1;2;{number}')
    with pytest.raises(JOB_FAILURES, match="Malformed records"):
        read_trade_csv(spark, [path], "EXP").collect()


def test_parquet_generations_are_united_by_name(spark, tmp_path):
    numeric, text = str(tmp_path / "a"), str(tmp_path / "b")
    table(spark, "VL_FOB bigint, CO_NCM bigint, CO_ANO string", (5, 101600, "2019")).write.parquet(numeric)
    raw_exports(spark, {"CO_NCM": "00101600", "VL_FOB": 6}).write.parquet(text)
    rows = read_parquet_by_name(spark, [numeric, text], RAW_EXPORTS)
    assert rows.schema["CO_NCM"].dataType.simpleString() == "string"
    assert rows_of(rows, "CO_ANO", "CO_NCM", "VL_FOB", "CO_MES") == [
        ("2019", "101600", 5, None),
        ("2020", "00101600", 6, "01"),
    ]


def test_inventory_lists_files_and_folders_and_what_is_missing(spark, tmp_path):
    write(tmp_path / "exp" / "EXP_2020.csv", "x", "1")
    write(tmp_path / "exp" / "EXP_2021.csv" / "part-0.csv", "x", "1")
    write(tmp_path / "exp" / "EXP_2021.csv" / "part-1.csv", "x", "1")
    write(tmp_path / "aux" / "NCM_SH.csv", "x", "1")
    write(tmp_path / "aux" / "notes.csv", "x", "1")
    found = landing.inventory(spark, str(tmp_path))
    assert rows_of(found, SOURCE, "bytes") == [("EXP_2020", 4), ("EXP_2021", 8), ("NCM_SH", 4)]
    wanted = landing.expected(spark, (2020, 2021, 2022), ("EXP",))
    assert {row[0] for row in landing.missing(wanted, found).collect()} == {
        "EXP_2022",
        "NCM",
        "PAIS",
        "PAIS_BLOCO",
        "UF",
        "VIA",
        "URF",
    }


def test_empty_landing_zone(spark, tmp_path):
    assert landing.inventory(spark, str(tmp_path / "nowhere")).count() == 0
    assert not landing.exists(spark, str(tmp_path / "nowhere"))


def test_ignore_leaves_a_stored_table_untouched(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    sinks.write_table(spark.range(9), path, mode="ignore")
    assert spark.read.parquet(path).count() == 3


def test_failed_write_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        sinks.write_table(spark.range(9).selectExpr("assert_true(id < 8)", "id"), path)
    assert not landing.exists(spark, path)


def test_failed_overwrite_keeps_the_stored_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(PySparkException):
        sinks.write_table(spark.range(9).selectExpr("assert_true(id < 8)", "id"), path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_overwrite_replaces_all_partitions_and_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(6).selectExpr("id % 3 AS k", "id"), path, ["k"])
    sinks.write_table(spark.read.parquet(path).where("k < 2"), path, ["k"])
    assert rows_of(spark.read.parquet(path), "k", "id") == [(0, 0), (0, 3), (1, 1), (1, 4)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_files_of_no_published_name_are_listed(spark, tmp_path):
    write(tmp_path / "EXP_2020.csv", "x", "1")
    write(tmp_path / "exp_2021.csv", "x", "1")
    write(tmp_path / "EXP_2022.CSV", "x", "1")
    write(tmp_path / "OTHER.csv", "x", "1")
    found = {row[0].rsplit("/", 1)[1] for row in landing.unknown(spark, str(tmp_path)).collect()}
    assert found == {"exp_2021.csv", "EXP_2022.CSV", "OTHER.csv"}


def test_tables_are_compressed_with_zstd(spark, tmp_path):
    sinks.write_table(spark.range(3), str(tmp_path / "t"))
    assert [p.name.endswith(".zstd.parquet") for p in (tmp_path / "t").glob("*.parquet")]
    assert all(p.name.endswith(".zstd.parquet") for p in (tmp_path / "t").glob("*.parquet"))


@pytest.mark.parametrize("settings_hold", [True, False])
def test_headers_of_many_files_whatever_shares_a_task(spark, tmp_path, monkeypatch, settings_hold):
    paths = []
    for k in range(30):
        folder = tmp_path / f"EXP_{2000 + k}.csv"
        header = ";".join(f'"C{k}_{j}"' for j in range(3))
        write(folder / "part-0.csv", "", " ", header, *["1;2;3"] * 50)
        write(folder / "part-1.csv", header if k % 5 else '"other; one"', "4;5;6")
        paths.append(str(folder))
    (tmp_path / "EXP_1999.csv").write_bytes(b"")
    if not settings_hold:
        # Several files in a task, and some cut into several.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        monkeypatch.setattr(type(spark.conf), "set", lambda self, key, value: None)
    try:
        found = first_lines(spark, [*paths, str(tmp_path / "EXP_1999.csv")])
    finally:
        monkeypatch.undo()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for k, path in enumerate(paths):
        own = [f"C{k}_{j}" for j in range(3)]
        assert found[path] == sorted([own] if k % 5 else [own, ["other; one"]])
    assert found[str(tmp_path / "EXP_1999.csv")] == []
