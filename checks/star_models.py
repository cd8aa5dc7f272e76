"""Library models over the star tables, built from only the columns a query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead import sinks
from fairlead.config import Layout
from fairlead.jobs import side_by_side
from fairlead.plans import core, marts, pipeline, staging
from fairlead.schemas import CODE_TABLES, EXPORT, IMPORT, RAW_TRADE, TRADE
from fairlead.sources import star
from fairlead.sources.files import CSV_FORMAT, SOURCE

# The star tables span 1995 to 2001, so the window cuts both ends.
FIRST_YEAR, LAST_YEAR = 1996, 2000

# Raw columns behind each column of the fact.
_RAW_COLUMNS = {
    "ano": "CO_ANO",
    "mes": "CO_MES",
    "data_ref": "CO_ANO CO_MES",
    "direcao": "",
    "co_ncm": "CO_NCM",
    "co_unid": "CO_UNID",
    "co_pais": "CO_PAIS",
    "sg_uf": "SG_UF_NCM",
    "co_via": "CO_VIA",
    "co_urf": "CO_URF",
    "qt_estat": "QT_ESTAT",
    "kg_liquido": "KG_LIQUIDO",
    "vl_fob_usd": "VL_FOB",
    "vl_frete_usd": "VL_FRETE",
    "vl_seguro_usd": "VL_SEGURO",
    "vl_cif_usd": "VL_FOB VL_FRETE VL_SEGURO",
}

BALANCE_COLUMNS = ("ano", "mes", "data_ref", "direcao", "sg_uf", "vl_fob_usd")
PRODUCT_COLUMNS = ("ano", "direcao", "co_ncm", "vl_fob_usd", "kg_liquido")
# What the stored totals of the job are summed from.
TOTAL_COLUMNS = (
    "ano", "mes", "data_ref", "direcao", "sg_uf", "co_ncm", "co_pais", "vl_fob_usd", "vl_cif_usd", "kg_liquido"
)
COUNTRY_COLUMNS = ("ano", "mes", "data_ref", "direcao", "co_pais", "vl_fob_usd", "kg_liquido")


class StarModels:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.tables = star.StarTables(spark, folder)

    # -- raw and staging -------------------------------------------------------

    def raw(self, direction: str, *columns: str) -> DataFrame:
        """All files of a direction; only ``columns`` if any are named."""
        table = star.raw_trade(self.tables, direction, columns or None)
        return table.select(*columns) if columns else table

    def labelled(self, direction: str, *columns: str) -> DataFrame:
        """Raw rows with the name of the yearly file they are published in."""
        return self.raw(direction, *columns).selectExpr("*", f"concat('{direction}_', CO_ANO) AS {SOURCE}")

    def code(self, name: str) -> DataFrame:
        return star.code_table(self.tables, name)

    def staged(self, direction: str, *columns: str) -> DataFrame:
        """Staged rows; raw columns that ``columns`` do not need are not looked up."""
        needed = {raw for c in columns or TRADE.names for raw in _RAW_COLUMNS[c].split()} | {"CO_ANO"}
        table = star.raw_trade(self.tables, direction, needed)
        stage = staging.exports if direction == EXPORT else staging.imports
        typed = stage(table, FIRST_YEAR, LAST_YEAR)
        return typed.select(*columns) if columns else typed

    # -- core and marts --------------------------------------------------------

    def trade(self, *columns: str) -> DataFrame:
        own = [c for c in columns if c != "direcao"]
        exports = [c for c in own if c not in ("vl_frete_usd", "vl_seguro_usd", "vl_cif_usd")]
        fact = core.trade(self.staged(EXPORT, *exports), self.staged(IMPORT, *own))
        return fact.select(*columns) if columns else fact

    def products(self) -> DataFrame:
        return core.products(staging.products(self.code("NCM"), self.code("NCM_SH")))

    def countries(self) -> DataFrame:
        return staging.countries(self.code("PAIS"))

    def country_blocs(self) -> DataFrame:
        return staging.country_blocs(self.code("PAIS_BLOCO"))

    def balance(self) -> DataFrame:
        return marts.trade_balance(self.trade(*BALANCE_COLUMNS))

    def exports_by_state(self) -> DataFrame:
        return marts.exports_by_state(self.trade(*BALANCE_COLUMNS, "kg_liquido"))

    def imports_by_state(self) -> DataFrame:
        return marts.imports_by_state(self.trade(*BALANCE_COLUMNS, "kg_liquido", "vl_cif_usd"))

    def top_products(self) -> DataFrame:
        return marts.top_products(self.trade(*PRODUCT_COLUMNS), self.products())

    def blocs(self) -> DataFrame:
        return marts.economic_blocs(self.trade(*COUNTRY_COLUMNS), self.country_blocs())

    # -- whole warehouse -------------------------------------------------------

    def store_raw(self, layout: Layout, copies: int = 1) -> None:
        """Write the raw tables where the converter would, with the year it adds.

        ``copies`` repeats every trade row, for a table of a given size. The copies are
        scattered by hash: side by side they would be stored far smaller than real rows.
        """

        def store(name: str) -> None:
            if name in RAW_TRADE:
                rows = staging.dated(self.labelled(name))
                if copies > 1:
                    rows = rows.selectExpr("*", f"explode(sequence(1, {copies})) AS copia")
                    rows = rows.sortWithinPartitions(F.xxhash64(*rows.columns)).drop("copia")
                sinks.write_table(sinks.rebalanced(rows, SOURCE), layout.raw(name), [SOURCE])
            else:
                sinks.write_table(self.code(name), layout.code_table(name))

        side_by_side(self.spark, store, [*RAW_TRADE, *CODE_TABLES])

    def staged_code_tables(self) -> dict[str, DataFrame]:
        return pipeline.stage_code_tables({name: self.code(name) for name in CODE_TABLES})

    # -- landing zone ----------------------------------------------------------

    def land(self, root: str, direction: str, *columns: str) -> None:
        sinks.land_csv(self.labelled(direction, *columns), f"{root}/{direction.lower()}")

    def land_code_table(self, root: str, name: str) -> None:
        path = f"{root}/aux/{name}.csv"
        self.code(name).write.options(**CSV_FORMAT, quoteAll="true").csv(path)
