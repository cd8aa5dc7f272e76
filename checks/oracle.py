"""Plain SQL for every registered query, over the same star tables.

Written from the definition of each result, apart from the DataFrame code: named
subqueries first, then one statement per query.
"""

from __future__ import annotations

_RAW = """
raw_exp AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS "CO_ANO",
         lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS "CO_MES",
         CAST(l_partkey AS VARCHAR) AS "CO_NCM",
         CAST(p_size AS VARCHAR) AS "CO_UNID",
         CAST(c_nationkey AS VARCHAR) AS "CO_PAIS",
         p_brand AS "SG_UF_NCM",
         l_returnflag AS "CO_VIA",
         CAST(l_suppkey AS VARCHAR) AS "CO_URF",
         CAST(l_linenumber AS BIGINT) AS "QT_ESTAT",
         CAST(l_quantity AS BIGINT) AS "KG_LIQUIDO",
         CAST(round(l_extendedprice * 100) AS BIGINT) AS "VL_FOB"
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  WHERE l_linestatus = 'O'
),
raw_imp AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS "CO_ANO",
         lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS "CO_MES",
         CAST(l_partkey AS VARCHAR) AS "CO_NCM",
         CAST(p_size AS VARCHAR) AS "CO_UNID",
         CAST(s_nationkey AS VARCHAR) AS "CO_PAIS",
         p_brand AS "SG_UF_NCM",
         l_returnflag AS "CO_VIA",
         CAST(l_suppkey AS VARCHAR) AS "CO_URF",
         CAST(l_linenumber AS BIGINT) AS "QT_ESTAT",
         CAST(l_quantity AS BIGINT) AS "KG_LIQUIDO",
         CAST(round(l_extendedprice * 100) AS BIGINT) AS "VL_FOB",
         nullif(CAST(round(l_extendedprice * l_tax * 100) AS BIGINT), 0) AS "VL_FRETE",
         nullif(CAST(round(l_extendedprice * l_discount * 10) AS BIGINT), 0) AS "VL_SEGURO"
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  WHERE l_linestatus = 'F'
)"""

_FACT = """
fact AS (
  SELECT * REPLACE (
           lpad(co_ncm, 8, '0') AS co_ncm,
           lpad(co_pais, 3, '0') AS co_pais,
           lpad(co_urf, 7, '0') AS co_urf),
         make_date(ano, CAST(mes AS INTEGER), 1) AS data_ref,
         CASE WHEN direcao = 'IMP'
              THEN vl_fob_usd + ifnull(vl_frete_usd, 0) + ifnull(vl_seguro_usd, 0) END AS vl_cif_usd
  FROM (
    SELECT CAST("CO_ANO" AS INTEGER) AS ano, "CO_MES" AS mes, 'EXP' AS direcao, "CO_NCM" AS co_ncm,
           "CO_UNID" AS co_unid, "CO_PAIS" AS co_pais, "SG_UF_NCM" AS sg_uf, "CO_VIA" AS co_via,
           "CO_URF" AS co_urf, "QT_ESTAT" AS qt_estat, "KG_LIQUIDO" AS kg_liquido,
           CAST("VL_FOB" AS DOUBLE) AS vl_fob_usd, CAST(NULL AS DOUBLE) AS vl_frete_usd,
           CAST(NULL AS DOUBLE) AS vl_seguro_usd
    FROM raw_exp
    UNION ALL
    SELECT CAST("CO_ANO" AS INTEGER), "CO_MES", 'IMP', "CO_NCM", "CO_UNID", "CO_PAIS", "SG_UF_NCM",
           "CO_VIA", "CO_URF", "QT_ESTAT", "KG_LIQUIDO", CAST("VL_FOB" AS DOUBLE),
           CAST("VL_FRETE" AS DOUBLE), CAST("VL_SEGURO" AS DOUBLE)
    FROM raw_imp
  )
  WHERE ano >= 1996 AND ano <= 2000
)"""

_CODES = """
ncm AS (
  SELECT p_partkey, p_size, p_name FROM part WHERE p_partkey % 97 <> 0
),
ncm_sh AS (
  SELECT DISTINCT p_size AS sh6, p_size // 5 AS sh4, p_size // 25 AS sh2 FROM part WHERE p_size <> 50
),
products AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS co_ncm,
         p_name AS no_ncm_pt,
         CAST(p_size AS VARCHAR) AS co_unid,
         lpad(CAST(p_size AS VARCHAR), 6, '0') AS co_sh6,
         lpad(CAST(sh4 AS VARCHAR), 4, '0') AS co_sh4,
         lpad(CAST(sh2 AS VARCHAR), 2, '0') AS co_sh2,
         'SH6 ' || CAST(sh6 AS VARCHAR) AS no_sh6_pt,
         'SH4 ' || CAST(sh4 AS VARCHAR) AS no_sh4_pt,
         'SH2 ' || CAST(sh2 AS VARCHAR) AS no_sh2_pt
  FROM ncm LEFT JOIN ncm_sh ON sh6 = p_size
),
countries AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS co_pais,
         lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS co_pais_ison3,
         'N' || CAST(n_nationkey AS VARCHAR) AS co_pais_isoa3,
         n_name AS no_pais, n_name AS no_pais_en, n_name AS no_pais_es
  FROM nation
),
states AS (
  SELECT DISTINCT p_brand AS sg_uf, split_part(p_brand, '#', 2) AS co_uf, p_brand AS no_uf,
         'R' || CAST(CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5 AS VARCHAR) AS no_regiao
  FROM part
),
modes AS (
  SELECT DISTINCT l_returnflag AS co_via, 'VIA ' || l_returnflag AS no_via FROM lineitem
),
customs_units AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS co_urf, s_name AS no_urf FROM supplier
),
blocs AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS co_pais,
         CAST(10 + n_regionkey AS VARCHAR) AS co_bloco, r_name AS no_bloco
  FROM nation, region WHERE n_regionkey = r_regionkey AND n_nationkey <> 24
  UNION ALL
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), '99', 'CROSS'
  FROM nation WHERE n_nationkey <> 24 AND n_nationkey % 2 = 0
)"""

_MARTS = """
m_balance AS (
  SELECT ano, mes, data_ref, sg_uf, e AS vl_exp_fob_usd, i AS vl_imp_fob_usd,
         e - i AS saldo_fob_usd, e + i AS corrente_comercio_usd
  FROM (
    SELECT ano, mes, data_ref, sg_uf,
           coalesce(sum(vl_fob_usd) FILTER (direcao = 'EXP'), 0) AS e,
           coalesce(sum(vl_fob_usd) FILTER (direcao = 'IMP'), 0) AS i
    FROM fact GROUP BY ALL
  )
),
month_totals AS (
  SELECT direcao, ano, mes, data_ref, sg_uf, sum(vl_fob_usd) AS vl_fob_usd,
         sum(vl_cif_usd) AS vl_cif_usd, CAST(sum(kg_liquido) AS BIGINT) AS kg_liquido
  FROM fact GROUP BY ALL
),
m_states AS (
  SELECT s.*, s.vl_fob_usd / nullif(t.total, 0) AS share_nacional_mes,
         1 + (SELECT count(*) FROM month_totals o
              WHERE o.direcao = s.direcao AND o.ano = s.ano AND o.mes = s.mes
                AND o.vl_fob_usd > s.vl_fob_usd) AS rank_mes
  FROM month_totals s
  JOIN (SELECT direcao, ano, mes, sum(vl_fob_usd) AS total FROM month_totals GROUP BY ALL) t
    USING (direcao, ano, mes)
),
product_totals AS (
  SELECT ano, direcao, co_ncm, sum(vl_fob_usd) AS vl_fob_usd,
         CAST(sum(kg_liquido) AS BIGINT) AS kg_liquido
  FROM fact GROUP BY ALL
),
product_ranks AS (
  SELECT *, vl_fob_usd / nullif(sum(vl_fob_usd) OVER g, 0) AS share_direcao_ano,
         rank() OVER (g ORDER BY vl_fob_usd DESC) AS rank_ano_direcao
  FROM product_totals WINDOW g AS (PARTITION BY ano, direcao)
),
m_products AS (
  SELECT r.ano, r.direcao, r.co_ncm, d.no_ncm_pt, d.co_sh2, d.no_sh2_pt, d.co_sh4, d.no_sh4_pt,
         r.vl_fob_usd, r.kg_liquido, r.share_direcao_ano, r.rank_ano_direcao
  FROM product_ranks r LEFT JOIN products d ON d.co_ncm = r.co_ncm
),
m_blocs AS (
  SELECT ano, mes, data_ref, direcao, co_bloco, no_bloco, sum(vl_fob_usd) AS vl_fob_usd,
         CAST(sum(kg_liquido) AS BIGINT) AS kg_liquido
  FROM fact JOIN blocs USING (co_pais) GROUP BY ALL
)"""

_WITH = "WITH " + ",".join([_RAW, _FACT, _CODES, _MARTS]) + "\n"

_EXPORT_COLUMNS = "ano, mes, data_ref, co_ncm, co_unid, co_pais, sg_uf, co_via, co_urf, qt_estat, kg_liquido, vl_fob_usd"
_STATE_LIST = "('Brand#1', 'Brand#7', 'Brand#13')"
_BLOC_LIST = "('10', '12', '99')"


def _kpis(condition: str) -> str:
    return f"""
SELECT sum(b) AS saldo_total, sum(f) AS corrente_total,
       count(*) FILTER (b > 0) AS ufs_positivas, count(*) AS ufs_total
FROM (SELECT sg_uf, sum(saldo_fob_usd) AS b, sum(corrente_comercio_usd) AS f
      FROM m_balance WHERE {condition} GROUP BY sg_uf)"""


def _not_null() -> str:
    """Required columns per model; the relations are the subqueries above."""
    required = {
        "stg_exportacoes": ("fact WHERE direcao = 'EXP'", "ano mes data_ref co_ncm co_pais vl_fob_usd"),
        "stg_importacoes": ("fact WHERE direcao = 'IMP'", "ano mes co_ncm co_pais vl_fob_usd vl_cif_usd"),
        "stg_ncm": ("products", "co_ncm"),
        "stg_paises": ("countries", "co_pais"),
        "stg_uf": ("states", "sg_uf"),
        "stg_vias": ("modes", "co_via"),
        "stg_urf": ("customs_units", "co_urf"),
        "stg_blocos": ("blocs", "co_pais co_bloco"),
        "core_comercio": ("fact", "ano mes direcao co_ncm co_pais vl_fob_usd"),
        "core_produtos": ("products", "co_ncm"),
        "mart_balanca_comercial": ("m_balance", "ano mes sg_uf saldo_fob_usd"),
        "mart_exportacoes_por_estado": ("m_states WHERE direcao = 'EXP'", "ano sg_uf rank_mes"),
        "mart_importacoes_por_estado": ("m_states WHERE direcao = 'IMP'", "ano sg_uf"),
        "mart_top_produtos": ("m_products", "ano direcao co_ncm rank_ano_direcao"),
        "mart_blocos_economicos": ("m_blocs", "ano direcao co_bloco no_bloco"),
    }
    return " UNION ALL ".join(
        _check(model, column, "not_null", "error", f"SELECT count(*) - count({column}) FROM {relation}")
        for model, (relation, columns) in required.items()
        for column in columns.split()
    )


def _unique() -> str:
    keys = {
        "stg_ncm": ("products", "co_ncm"),
        "stg_paises": ("countries", "co_pais"),
        "stg_uf": ("states", "sg_uf"),
        "stg_vias": ("modes", "co_via"),
        "stg_urf": ("customs_units", "co_urf"),
        "core_produtos": ("products", "co_ncm"),
    }
    return " UNION ALL ".join(
        _check(model, key, "unique", "error", _repeats(relation, key))
        for model, (relation, key) in keys.items()
    )


def _accepted() -> str:
    months = "'01','02','03','04','05','06','07','08','09','10','11','12'"
    directions = "'EXP','IMP'"
    lists = [
        ("stg_exportacoes", "fact WHERE direcao = 'EXP'", "mes", months),
        ("stg_importacoes", "fact WHERE direcao = 'IMP'", "mes", months),
        ("core_comercio", "fact", "direcao", directions),
        ("mart_top_produtos", "m_products", "direcao", directions),
        ("mart_blocos_economicos", "m_blocs", "direcao", directions),
    ]
    return " UNION ALL ".join(
        _check(
            model,
            column,
            "accepted_values",
            "error",
            f"SELECT count(*) FROM (SELECT DISTINCT {column} AS v FROM {relation}) WHERE v NOT IN ({values})",
        )
        for model, relation, column, values in lists
    )


def _relationships() -> str:
    links = [
        ("stg_exportacoes", "direcao = 'EXP' AND", "co_ncm", "products"),
        ("stg_exportacoes", "direcao = 'EXP' AND", "co_pais", "countries"),
        ("stg_exportacoes", "direcao = 'EXP' AND", "sg_uf", "states"),
        ("stg_importacoes", "direcao = 'IMP' AND", "co_ncm", "products"),
        ("stg_importacoes", "direcao = 'IMP' AND", "co_pais", "countries"),
        ("core_comercio", "", "co_ncm", "products"),
    ]
    return " UNION ALL ".join(
        _check(
            model,
            key,
            "relationships",
            "warn",
            f"SELECT count(*) FROM fact WHERE {where} {key} IS NOT NULL AND {key} NOT IN "
            f"(SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)",
        )
        for model, where, key, parent in links
    )


def _grain() -> str:
    grains = {
        "mart_balanca_comercial": ("m_balance", "ano, mes, sg_uf"),
        "mart_exportacoes_por_estado": ("m_states WHERE direcao = 'EXP'", "ano, mes, sg_uf"),
        "mart_importacoes_por_estado": ("m_states WHERE direcao = 'IMP'", "ano, mes, sg_uf"),
        "mart_top_produtos": ("m_products", "ano, direcao, co_ncm"),
        "mart_blocos_economicos": ("m_blocs", "ano, mes, direcao, co_bloco"),
    }
    return " UNION ALL ".join(
        _check(model, key, "unique_combination", "error", _repeats(relation, key))
        for model, (relation, key) in grains.items()
    )


def _repeats(relation: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {relation} GROUP BY {key} HAVING count(*) > 1)"


def _check(model: str, column: str, test: str, severity: str, failures: str) -> str:
    outcome = "warn" if severity == "warn" else "fail"
    return (
        f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE '{outcome}' END AS status FROM ("
        f"SELECT '{model}' AS model, '{column}' AS columns, '{test}' AS test, "
        f"'{severity}' AS severity, ({failures}) AS failures)"
    )


# Codes as the Parquet tables of the fixture hold them.
_STORED_CODES = (
    'CAST("CO_NCM" AS BIGINT) AS "CO_NCM", CAST("CO_PAIS" AS INTEGER) AS "CO_PAIS", CAST("CO_URF" AS BIGINT) AS "CO_URF"'
)


def _converted_files() -> str:
    """Rows and columns of every published file, counted from what it holds."""
    width = "CAST(len(json_keys(to_json(any_value(t)))) AS INTEGER) AS colunas"
    files = [
        f"SELECT '{direction}_' || \"CO_ANO\" AS arquivo, count(*) AS linhas, {width} "
        f"FROM raw_{direction.lower()} t GROUP BY \"CO_ANO\""
        for direction in ("EXP", "IMP")
    ]
    files += [f"SELECT '{name}', count(*), {width} FROM ({_STATEMENTS[f'scan_aux_{name.lower()}']}) t" for name in _CODE_FILES]
    return (
        "SELECT *, true AS tem_csv, true AS tem_razao, 'OK' AS status, CAST(NULL AS VARCHAR) AS motivo "
        f"FROM ({' UNION ALL '.join(files)})"
    )


_CODE_FILES = ("NCM", "NCM_SH", "PAIS", "PAIS_BLOCO", "UF", "VIA", "URF")


def _years(direction: str) -> str:
    return f"SELECT DISTINCT '{direction}_' || \"CO_ANO\" AS arquivo FROM raw_{direction.lower()}"


_STATEMENTS = {
    # Sources and sinks
    "scan_exports_csv": "SELECT * FROM raw_exp",
    "scan_imports_csv": "SELECT * FROM raw_imp",
    "scan_aux_ncm": """
SELECT CAST(p_partkey AS VARCHAR) AS "CO_NCM", CAST(p_size AS VARCHAR) AS "CO_SH6",
       CAST(p_size AS VARCHAR) AS "CO_UNID", p_name AS "NO_NCM_POR" FROM ncm""",
    "scan_aux_ncm_sh": """
SELECT CAST(sh6 AS VARCHAR) AS "CO_SH6", CAST(sh4 AS VARCHAR) AS "CO_SH4", CAST(sh2 AS VARCHAR) AS "CO_SH2",
       'SH6 ' || sh6 AS "NO_SH6_POR", 'SH4 ' || sh4 AS "NO_SH4_POR", 'SH2 ' || sh2 AS "NO_SH2_POR" FROM ncm_sh""",
    "scan_aux_pais": """
SELECT CAST(n_nationkey AS VARCHAR) AS "CO_PAIS", CAST(n_nationkey AS VARCHAR) AS "CO_PAIS_ISON3",
       co_pais_isoa3 AS "CO_PAIS_ISOA3", no_pais AS "NO_PAIS", no_pais_en AS "NO_PAIS_ING",
       no_pais_es AS "NO_PAIS_ESP" FROM nation JOIN countries ON CAST(co_pais AS INTEGER) = n_nationkey""",
    "scan_aux_pais_bloco": """
SELECT CAST(CAST(co_pais AS INTEGER) AS VARCHAR) AS "CO_PAIS", co_bloco AS "CO_BLOCO", no_bloco AS "NO_BLOCO"
FROM blocs""",
    "scan_aux_uf": """
SELECT sg_uf AS "SG_UF", co_uf AS "CO_UF", no_uf AS "NO_UF", no_regiao AS "NO_REGIAO" FROM states""",
    "scan_aux_via": 'SELECT co_via AS "CO_VIA", no_via AS "NO_VIA" FROM modes',
    "scan_aux_urf": 'SELECT CAST(s_suppkey AS VARCHAR) AS "CO_URF", s_name AS "NO_URF" FROM supplier',
    "scan_union_by_name": """
SELECT * REPLACE (CASE WHEN CAST("CO_ANO" AS INTEGER) >= 1998 THEN "CO_VIA" END AS "CO_VIA")
FROM raw_exp""",
    "ingest_select": """
SELECT 'IMP_' || "CO_ANO" AS arquivo, count(*) AS linhas, CAST(sum("VL_FOB") AS BIGINT) AS vl_fob
FROM raw_imp WHERE "CO_ANO" IN ('1997', '1998') GROUP BY ALL""",
    "landing_missing": f"""
SELECT arquivo FROM (
  SELECT d || '_' || CAST(y AS VARCHAR) AS arquivo
  FROM (VALUES ('EXP'), ('IMP')) AS t(d), range(1993, 2004) AS r(y)
  UNION ALL
  SELECT * FROM (VALUES ('NCM'), ('NCM_SH'), ('PAIS'), ('PAIS_BLOCO'), ('UF'), ('VIA'), ('URF'))
)
EXCEPT
(VALUES ('PAIS'), ('PAIS_BLOCO') UNION ALL {_years('EXP')} UNION ALL {_years('IMP')})""",
    "sink_parquet_roundtrip": f"SELECT * REPLACE ({_STORED_CODES}), 'EXP_' || \"CO_ANO\" AS arquivo FROM raw_exp",
    "sink_skip_existing": f"""
SELECT * REPLACE ({_STORED_CODES},
                  CASE WHEN "CO_ANO" < '1998' THEN "VL_FOB" ELSE "VL_FOB" * 2 END AS "VL_FOB"),
       'EXP_' || "CO_ANO" AS arquivo FROM raw_exp""",
    "sink_refresh_year": f"""
SELECT * REPLACE ({_STORED_CODES},
                  CASE WHEN "CO_ANO" = '1998' THEN "VL_FOB" * 2 ELSE "VL_FOB" END AS "VL_FOB"),
       'EXP_' || "CO_ANO" AS arquivo FROM raw_exp""",
    # Filters
    "filter_year_window": """
SELECT CAST("CO_ANO" AS INTEGER) AS ano, "CO_MES", "VL_FOB" FROM raw_exp
WHERE "CO_ANO" IN ('1996', '1997', '1998', '1999', '2000')""",
    "filter_direction": "SELECT ano, mes, direcao, co_ncm, vl_fob_usd FROM fact WHERE direcao = 'IMP'",
    "filter_optional_in_uf": f"SELECT * FROM m_balance WHERE sg_uf IN {_STATE_LIST}",
    "filter_optional_in_uf_empty": "SELECT * FROM m_balance",
    "filter_optional_in_bloc": f"SELECT * FROM m_blocs WHERE co_bloco IN {_BLOC_LIST}",
    "filter_optional_in_bloc_empty": "SELECT * FROM m_blocs",
    # Joins
    "join_left_sh_hierarchy": "SELECT co_ncm, co_sh6, co_sh4, co_sh2, no_sh6_pt FROM products",
    "join_inner_bloc_fanout": """
SELECT co_pais, ano, mes, data_ref, direcao, sum(vl_fob_usd) AS vl_fob_usd,
       CAST(sum(kg_liquido) AS BIGINT) AS kg_liquido, co_bloco, no_bloco
FROM fact JOIN blocs USING (co_pais) GROUP BY ALL""",
    "join_left_product_dim": """
SELECT t.*, no_ncm_pt, co_sh2, no_sh2_pt, co_sh4, no_sh4_pt
FROM product_totals t LEFT JOIN products USING (co_ncm)""",
    # Aggregates, windows, unions
    "agg_sum_by_state_month": """
SELECT ano, mes, data_ref, sg_uf, vl_fob_usd, kg_liquido FROM month_totals WHERE direcao = 'EXP'""",
    "agg_conditional_pivot": "SELECT ano, mes, sg_uf, vl_exp_fob_usd, vl_imp_fob_usd FROM m_balance",
    "window_share_month": "SELECT ano, mes, sg_uf, share_nacional_mes FROM m_states WHERE direcao = 'EXP'",
    "window_rank_month": "SELECT ano, mes, sg_uf, rank_mes FROM m_states WHERE direcao = 'IMP'",
    "window_share_year_direction": "SELECT * EXCLUDE (rank_ano_direcao) FROM product_ranks",
    "window_rank_year_direction": "SELECT * EXCLUDE (share_direcao_ano) FROM product_ranks",
    "union_all_trade": """
SELECT ano, mes, direcao, co_ncm, co_via, co_urf, qt_estat, vl_fob_usd, vl_frete_usd, vl_cif_usd FROM fact""",
    # Scalars
    "scalar_pad_codes": "SELECT mes, co_ncm, co_pais, co_urf FROM fact WHERE direcao = 'IMP'",
    "scalar_casts": "SELECT ano, co_unid, qt_estat, kg_liquido, vl_fob_usd FROM fact WHERE direcao = 'EXP'",
    "scalar_month_start": "SELECT DISTINCT ano, mes, data_ref FROM fact",
    "scalar_cif": "SELECT vl_fob_usd, vl_frete_usd, vl_seguro_usd, vl_cif_usd FROM fact WHERE direcao = 'IMP'",
    "scalar_safe_share": """
SELECT ano, direcao, co_via, v AS vl_frete_usd,
       v / nullif(sum(v) OVER (PARTITION BY ano, direcao), 0) AS peso,
       rank() OVER (PARTITION BY ano, direcao ORDER BY v DESC) AS posicao
FROM (SELECT ano, direcao, co_via, coalesce(sum(vl_frete_usd), 0) AS v FROM fact GROUP BY ALL)""",
    "format_kpis": """
SELECT ano, translate(format('{:,.2f}', f / 1e9), ',.', '.,') || ' bi US$' AS corrente,
       translate(format('{:,.2f}', b / 1e6), ',.', '.,') || ' mi US$' AS saldo,
       replace(format('{:.1f}', e / nullif(f, 0) * 100), '.', ',') || '%' AS peso_exp,
       replace(format('{:,}', n), ',', '.') AS linhas
FROM (SELECT ano, sum(corrente_comercio_usd) AS f, sum(saldo_fob_usd) AS b, sum(vl_exp_fob_usd) AS e,
             count(*) AS n FROM m_balance GROUP BY ano)""",
    "format_missing": """
SELECT ano, direcao,
       coalesce(translate(format('{:,.2f}', t / 1e9), ',.', '.,') || ' bi US$', '—') AS frete_bi,
       coalesce(translate(format('{:,.2f}', t / 1e6), ',.', '.,') || ' mi US$', '—') AS frete_mi,
       coalesce(replace(format('{:.2f}', t / nullif(f, 0) * 100), '.', ',') || '%', '—') AS peso_frete
FROM (SELECT ano, direcao, sum(vl_fob_usd) AS f, sum(vl_frete_usd) AS t FROM fact GROUP BY ALL)""",
    # Models
    "stg_exports": f"SELECT {_EXPORT_COLUMNS} FROM fact WHERE direcao = 'EXP'",
    "stg_imports": f"""
SELECT {_EXPORT_COLUMNS}, vl_frete_usd, vl_seguro_usd, vl_cif_usd FROM fact WHERE direcao = 'IMP'""",
    "stg_products": "SELECT * FROM products",
    "stg_countries": "SELECT * FROM countries",
    "stg_states": "SELECT * FROM states",
    "stg_modes": "SELECT * FROM modes",
    "stg_customs_units": "SELECT * FROM customs_units",
    "stg_country_blocs": "SELECT * FROM blocs",
    "core_trade": "SELECT * FROM fact",
    "core_products": "SELECT * FROM products",
    "mart_trade_balance": "SELECT * FROM m_balance",
    "mart_exports_by_state": "SELECT * EXCLUDE (direcao, vl_cif_usd) FROM m_states WHERE direcao = 'EXP'",
    "mart_imports_by_state": "SELECT * EXCLUDE (direcao) FROM m_states WHERE direcao = 'IMP'",
    "mart_top_products": "SELECT * FROM m_products",
    "mart_economic_blocs": "SELECT * FROM m_blocs",
    # Analytic queries
    "list_states": "SELECT DISTINCT sg_uf FROM m_balance WHERE sg_uf IS NOT NULL ORDER BY sg_uf",
    "list_blocs": "SELECT co_bloco, no_bloco FROM m_blocs GROUP BY ALL ORDER BY no_bloco, co_bloco",
    "year_range": "SELECT min(ano) AS ano_min, max(ano) AS ano_max FROM m_balance",
    "warehouse_status": """
SELECT count(*) AS linhas_core, min(ano) AS ano_min, max(ano) AS ano_max FROM fact""",
    "warehouse_freshness": """
SELECT count(*) AS linhas_core, min(ano) AS ano_min, max(ano) AS ano_max, true AS atualizado_em
FROM fact""",
    "balance_kpis": _kpis("ano BETWEEN 1996 AND 2000"),
    "balance_kpis_states": _kpis(f"ano BETWEEN 1997 AND 1999 AND sg_uf IN {_STATE_LIST}"),
    "balance_kpis_empty_period": _kpis("ano BETWEEN 1901 AND 1902"),
    "balance_monthly_series": f"""
SELECT data_ref, sum(vl_exp_fob_usd) AS exp_usd, sum(vl_imp_fob_usd) AS imp_usd,
       sum(saldo_fob_usd) AS saldo_usd, sum(corrente_comercio_usd) AS corrente_usd
FROM m_balance WHERE sg_uf IN {_STATE_LIST} GROUP BY ALL ORDER BY data_ref""",
    "balance_top_states": """
SELECT sg_uf, sum(vl_exp_fob_usd) AS exp_usd, sum(vl_imp_fob_usd) AS imp_usd,
       sum(saldo_fob_usd) AS saldo_usd
FROM m_balance GROUP BY ALL ORDER BY saldo_usd DESC, sg_uf LIMIT 10""",
    "balance_detail": """
SELECT ano, sg_uf, sum(vl_exp_fob_usd) AS exp_usd, sum(vl_imp_fob_usd) AS imp_usd,
       sum(saldo_fob_usd) AS saldo_usd, sum(corrente_comercio_usd) AS corrente_usd
FROM m_balance GROUP BY ALL ORDER BY ano, saldo_usd DESC""",
    "top_products": """
SELECT co_ncm, no_ncm_pt, co_sh2, no_sh2_pt, vl_fob_usd, kg_liquido, share_direcao_ano,
       rank_ano_direcao
FROM m_products WHERE direcao = 'EXP' AND ano = 1998 AND rank_ano_direcao <= 10
ORDER BY rank_ano_direcao""",
    "top_chapters": """
SELECT * FROM (SELECT co_sh2, no_sh2_pt, sum(vl_fob_usd) AS vl_fob_usd FROM m_products
               WHERE direcao = 'EXP' AND ano = 1998 GROUP BY ALL)
WHERE vl_fob_usd > 0 ORDER BY vl_fob_usd DESC""",
    "bloc_annual_series": f"""
SELECT ano, no_bloco, sum(vl_fob_usd) AS vl_fob_usd FROM m_blocs
WHERE direcao = 'EXP' AND co_bloco IN {_BLOC_LIST} GROUP BY ALL ORDER BY ano, no_bloco""",
    "bloc_annual_share": """
SELECT ano, no_bloco, v AS vl_fob_usd, v / nullif(sum(v) OVER (PARTITION BY ano), 0) AS share_ano
FROM (SELECT ano, no_bloco, sum(vl_fob_usd) AS v FROM m_blocs WHERE direcao = 'EXP' GROUP BY ALL)
ORDER BY ano, no_bloco""",
    "bloc_detail": """
SELECT ano, mes, no_bloco, direcao, sum(vl_fob_usd) AS vl_fob_usd,
       CAST(sum(kg_liquido) AS BIGINT) AS kg_liquido
FROM m_blocs WHERE direcao = 'IMP' GROUP BY ALL ORDER BY ano, mes, vl_fob_usd DESC""",
    "top_export_states_year": """
SELECT sg_uf, sum(vl_fob_usd) / 1e9 AS exp_bilhoes_usd FROM m_states
WHERE direcao = 'EXP' AND ano = 1998 GROUP BY sg_uf ORDER BY exp_bilhoes_usd DESC, sg_uf LIMIT 5""",
    "balance_by_year": """
SELECT ano, sum(vl_exp_fob_usd) / 1e9 AS exp_bi, sum(vl_imp_fob_usd) / 1e9 AS imp_bi,
       sum(saldo_fob_usd) / 1e9 AS saldo_bi FROM m_balance GROUP BY ano ORDER BY ano""",
    # Data quality
    "dq_not_null": _not_null(),
    "dq_unique": _unique(),
    "dq_accepted_values": _accepted(),
    "dq_relationships": _relationships(),
    "dq_grain": _grain(),
    "dq_report": " UNION ALL ".join([_not_null(), _unique(), _accepted(), _relationships(), _grain()]),
}

_STATEMENTS["ingest_report_rows"] = (
    _converted_files()
    + """
UNION ALL
SELECT 'EXP_2003', NULL, NULL, true, NULL, 'FAILED', CAST(count(*) AS VARCHAR) || ' malformed rows'
FROM raw_exp WHERE "CO_ANO" = '1998' AND CAST("CO_MES" AS INTEGER) % 2 = 0"""
)
_STATEMENTS["ingest_revised"] = f"""
SELECT 'EXP_' || "CO_ANO" AS arquivo, CASE WHEN "CO_ANO" = '1998' THEN 'OK' ELSE 'SKIPPED' END AS status,
       CAST(sum(CASE WHEN "CO_ANO" = '1998' THEN 2 * "VL_FOB" ELSE "VL_FOB" END) AS BIGINT) AS vl_fob
FROM raw_exp GROUP BY "CO_ANO"
UNION ALL
SELECT unnest([{", ".join(f"'{name}'" for name in _CODE_FILES)}]), 'SKIPPED', NULL"""
_STATEMENTS["refresh_year_to_marts"] = """
SELECT ano, mes, data_ref, sg_uf, e AS vl_exp_fob_usd, i AS vl_imp_fob_usd,
       e - i AS saldo_fob_usd, e + i AS corrente_comercio_usd
FROM (
  SELECT ano, mes, data_ref, sg_uf,
         coalesce(sum(CASE WHEN ano = 1998 THEN 2 * vl_fob_usd ELSE vl_fob_usd END) FILTER (direcao = 'EXP'), 0) AS e,
         coalesce(sum(vl_fob_usd) FILTER (direcao = 'IMP'), 0) AS i
  FROM fact GROUP BY ALL
)"""
_STATEMENTS["top_products_mart"] = _STATEMENTS["top_products"]
_STATEMENTS["sink_csv_roundtrip"] = _STATEMENTS["balance_detail"]

_PARTNER_SHARE = """
SELECT ano, co_pais, no_pais, v AS vl_fob_usd, v / nullif(total, 0) AS share_importacoes
FROM (SELECT ano, co_pais, sum(vl_fob_usd) AS v FROM fact WHERE direcao = 'IMP' GROUP BY ALL)
JOIN (SELECT ano, sum(vl_fob_usd) AS total FROM fact WHERE direcao = 'IMP' GROUP BY ano) USING (ano)
LEFT JOIN countries USING (co_pais)"""
_STATEMENTS["partner_import_share"] = _PARTNER_SHARE
_STATEMENTS["partner_import_share_selected"] = _PARTNER_SHARE + " WHERE co_pais IN ('003', '011')"


def statements() -> dict[str, str]:
    return {name: _WITH + sql.strip() for name, sql in _STATEMENTS.items()}
