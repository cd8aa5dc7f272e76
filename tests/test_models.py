"""Rules of the staging, core and mart models on hand-built rows."""

from datetime import date

import pytest
from frames import raw_exports, raw_imports, rows_of, table, trade

from fairlead.plans import analytics, core, marts, staging


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_codes_are_padded_from_text_and_numbers(spark, kind):
    codes = table(spark, "CO_URF string, NO_URF string", ("817600", "A"), ("12", "B"))
    padded = staging.customs_units(codes.selectExpr(f"CAST(CO_URF AS {kind}) AS CO_URF", "NO_URF"))
    assert rows_of(padded) == [("0000012", "B"), ("0817600", "A")]


def test_padding_keeps_padded_codes_and_cuts_long_ones(spark):
    codes = table(spark, "CO_URF string, NO_URF string", ("0817600", "A"), ("12345678", "B"))
    assert rows_of(staging.customs_units(codes)) == [("0817600", "A"), ("1234567", "B")]


def test_unpadded_codes_stay_as_they_are(spark):
    modes = staging.modes(table(spark, "CO_VIA string, NO_VIA string", ("01", "sea"), ("1", "air")))
    assert rows_of(modes) == [("01", "sea"), ("1", "air")]


def test_year_window_keeps_both_ends(spark):
    raw = raw_exports(spark, *[{"CO_ANO": str(y)} for y in (2018, 2019, 2021, 2022)])
    assert rows_of(staging.exports(raw, 2019, 2021), "ano") == [(2019,), (2021,)]


def test_month_is_padded_and_dated(spark):
    staged = staging.exports(raw_exports(spark, {"CO_MES": "7"}), 2020, 2020)
    assert rows_of(staged, "mes", "data_ref") == [("07", date(2020, 7, 1))]


def test_missing_charges_cost_nothing_but_missing_fob_has_no_cif(spark):
    staged = staging.imports(
        raw_imports(
            spark,
            {"VL_FOB": 10, "VL_FRETE": 2, "VL_SEGURO": 1},
            {"VL_FOB": 10, "VL_FRETE": None, "VL_SEGURO": None},
            {"VL_FOB": None, "VL_FRETE": 2, "VL_SEGURO": 1},
        ),
        2020,
        2020,
    )
    assert rows_of(staged, "vl_cif_usd") == [(10.0,), (13.0,), (None,)]


def test_fact_is_a_bag_and_exports_have_no_charges(spark):
    exports = staging.exports(raw_exports(spark, {"VL_FOB": 5}, {"VL_FOB": 5}), 2020, 2020)
    imports = staging.imports(raw_imports(spark, {"VL_FOB": 7}), 2020, 2020)
    fact = core.trade(exports, imports)
    assert rows_of(fact, "direcao", "vl_fob_usd", "vl_cif_usd") == [
        ("EXP", 5.0, None),
        ("EXP", 5.0, None),
        ("IMP", 7.0, 7.0),
    ]


def test_state_with_one_direction_has_zero_on_the_other_side(spark):
    balance = marts.trade_balance(trade(spark, {"sg_uf": "SP", "vl_fob_usd": 3.0}))
    assert rows_of(balance, "vl_exp_fob_usd", "vl_imp_fob_usd", "saldo_fob_usd") == [(3.0, 0.0, 3.0)]


def test_share_of_a_zero_month_is_null(spark):
    mart = marts.exports_by_state(
        trade(spark, {"sg_uf": "SP", "vl_fob_usd": 0.0}, {"sg_uf": "RJ", "vl_fob_usd": 0.0})
    )
    assert rows_of(mart, "share_nacional_mes", "rank_mes") == [(None, 1), (None, 1)]


PRODUCTS = (
    "co_ncm string, no_ncm_pt string, co_unid string, co_sh2 string, no_sh2_pt string, "
    "co_sh4 string, no_sh4_pt string, co_sh6 string, no_sh6_pt string"
)


def test_products_without_a_dimension_row_stay_and_form_one_chapter(spark):
    products = table(spark, PRODUCTS, ("A", "soy", "1", "12", "seeds", "1201", "soya", "120100", "soya"))
    mart = marts.top_products(
        trade(
            spark,
            {"co_ncm": "A", "vl_fob_usd": 6.0},
            {"co_ncm": "B", "vl_fob_usd": 3.0},
            {"co_ncm": "C", "vl_fob_usd": 1.0},
        ),
        products,
    )
    assert rows_of(mart, "co_ncm", "no_ncm_pt", "share_direcao_ano", "rank_ano_direcao") == [
        ("A", "soy", 0.6, 1),
        ("B", None, 0.3, 2),
        ("C", None, 0.1, 3),
    ]
    assert rows_of(analytics.top_chapters(mart, "EXP", 2020)) == [("12", "seeds", 6.0), (None, None, 4.0)]


def test_tie_at_the_limit_returns_more_products_by_rank(spark):
    rows = [{"co_ncm": c, "vl_fob_usd": v} for c, v in (("A", 9.0), ("B", 5.0), ("C", 5.0), ("D", 1.0))]
    mart = marts.top_products(trade(spark, *rows), table(spark, PRODUCTS))
    top = analytics.top_products(mart, "EXP", 2020, 2)
    assert rows_of(top, "co_ncm", "rank_ano_direcao") == [("A", 1), ("B", 2), ("C", 2)]


def test_tie_at_the_limit_returns_exactly_n_states(spark):
    rows = [{"sg_uf": uf, "vl_fob_usd": v} for uf, v in (("SP", 9.0), ("RJ", 5.0), ("MG", 5.0))]
    balance = marts.trade_balance(trade(spark, *rows))
    assert rows_of(analytics.balance_top_states(balance, None, 2020, 2020, 2), "sg_uf") == [("MG",), ("SP",)]


BLOCS = "co_pais string, co_bloco string, no_bloco string"


def test_blocs_fan_out_and_countries_in_none_drop_out(spark):
    rows = [{"co_pais": c, "vl_fob_usd": 10.0, "kg_liquido": 1} for c in ("001", "002", "003")]
    blocs = table(spark, BLOCS, ("001", "10", "EU"), ("001", "20", "OECD"), ("002", "10", "EU"))
    mart = marts.economic_blocs(trade(spark, *rows), blocs)
    assert rows_of(mart, "co_bloco", "vl_fob_usd", "kg_liquido") == [("10", 20.0, 2), ("20", 10.0, 1)]


def test_bloc_queries_merge_codes_sharing_a_name(spark):
    rows = [{"co_pais": c, "vl_fob_usd": 10.0, "kg_liquido": 1} for c in ("001", "002")]
    blocs = table(spark, BLOCS, ("001", "10", "EU"), ("002", "11", "EU"), ("002", "30", "Asia"))
    mart = marts.economic_blocs(trade(spark, *rows), blocs)
    assert rows_of(analytics.bloc_annual_share(mart, "EXP")) == [
        (2020, "Asia", 10.0, 1 / 3),
        (2020, "EU", 20.0, 2 / 3),
    ]


def test_partner_share_counts_every_import_of_the_year(spark):
    rows = [
        {"direcao": "IMP", "co_pais": "160", "vl_fob_usd": 1.0},
        {"direcao": "IMP", "co_pais": "999", "vl_fob_usd": 3.0},
        {"direcao": "EXP", "co_pais": "160", "vl_fob_usd": 50.0},
    ]
    countries = table(spark, "co_pais string, no_pais string", ("160", "China"))
    selected = analytics.partner_import_share(trade(spark, *rows), countries, ["160"])
    assert rows_of(selected) == [(2020, "160", "China", 1.0, 0.25)]
    assert analytics.partner_import_share(trade(spark, *rows), countries).count() == 2


def test_sorted_queries_put_null_keys_last(spark):
    """Hand-built marts, scattered so that nothing is in order by chance."""
    balance = table(
        spark,
        "ano int, mes string, data_ref date, sg_uf string, vl_exp_fob_usd double, vl_imp_fob_usd double, "
        "saldo_fob_usd double, corrente_comercio_usd double",
        *[
            (year, "01", None, state, value, 0.0, value, value)
            for year, state, value in [
                (2021, "SP", 1.0), (None, "RO", 9.0), (2020, None, 5.0), (2020, "MG", None), (2020, "AC", 7.0), (2021, "BA", 3.0),
            ]
        ],
    ).repartition(5)
    assert [r[0] for r in analytics.list_states(balance).collect()] == ["AC", "BA", "MG", "RO", "SP"]
    detail = analytics.balance_detail(balance, None, 2020, 2021).collect()
    assert [(r.ano, r.saldo_usd) for r in detail] == [(2020, 7.0), (2020, 5.0), (2020, None), (2021, 3.0), (2021, 1.0)]
    assert [r.ano for r in analytics.balance_by_year(balance).collect()] == [2020, 2021, None]
    states = analytics.balance_top_states(balance, None, 2020, 2021, 9).collect()
    assert [r.sg_uf for r in states] == ["AC", None, "BA", "SP", "MG"]

    blocs = table(
        spark,
        "ano int, mes string, data_ref date, direcao string, co_bloco string, no_bloco string, vl_fob_usd double, kg_liquido bigint",
        *[(2020, "02", None, "EXP", code, name, value, 1) for code, name, value in [("3", None, 2.0), ("2", "b", None), ("1", "a", 4.0)]],
        (2020, "01", None, "EXP", "2", "b", 1.0, 1),
    ).repartition(5)
    assert [r.co_bloco for r in analytics.list_blocs(blocs).collect()] == ["1", "2", "3"]
    assert [r.no_bloco for r in analytics.bloc_annual_series(blocs, None, "EXP").collect()] == ["a", "b", None]
    assert [(r.mes, r.vl_fob_usd) for r in analytics.bloc_detail(blocs, None, "EXP").collect()] == [
        ("01", 1.0), ("02", 4.0), ("02", 2.0), ("02", None),
    ]


def test_unknown_direction_is_refused(spark):
    with pytest.raises(ValueError, match="unknown direction"):
        marts.state_month_totals(trade(spark), "XXX", "vl_fob_usd")


def test_invariants_on_the_star_tables(spark):
    from checks.star_models import StarModels

    m = StarModels(spark, "/root/testdata/sf0.001")
    balance, out, inc = m.balance().toPandas(), m.exports_by_state().toPandas(), m.imports_by_state().toPandas()
    assert (balance.saldo_fob_usd == balance.vl_exp_fob_usd - balance.vl_imp_fob_usd).all()
    assert out.vl_fob_usd.sum() == balance.vl_exp_fob_usd.sum()
    assert inc.vl_fob_usd.sum() == balance.vl_imp_fob_usd.sum()
    assert abs(out.groupby(["ano", "mes"]).share_nacional_mes.sum() - 1).max() < 1e-9
    assert (inc.vl_cif_usd >= inc.vl_fob_usd).all()
    # Counts published with the mapping of the star tables.
    assert (len(balance), len(out), len(inc)) == (1386, 1119, 1134)
    assert m.top_products().count() == 1778
    assert m.trade("ano", "direcao").groupBy("direcao").count().orderBy("direcao").collect() == [
        ("EXP", 2211),
        ("IMP", 2221),
    ]


def test_state_marts_are_the_same_from_monthly_totals(spark):
    from checks.star_models import BALANCE_COLUMNS, StarModels

    fact = StarModels(spark, "/root/testdata/sf0.001").trade(*BALANCE_COLUMNS, "kg_liquido", "vl_cif_usd")
    unpriced = trade(spark, {"sg_uf": "SP"}, {"sg_uf": "RJ"}, {"sg_uf": "RJ", "direcao": "IMP", "vl_fob_usd": 1.0})
    for rows in (fact, unpriced):
        totals = marts.state_months(rows)
        for mart in (marts.trade_balance, marts.exports_by_state, marts.imports_by_state):
            assert rows_of(mart(totals)) == rows_of(mart(rows))
