"""The 21 silver data products and their load contract.

``PRODUCTS`` maps each product to its kind, load mode, merge keys and builder.
``build_product`` returns the DataFrame; ``load_product`` writes it to a
versioned table: ``upsert`` products are merged on their keys (never deleted),
``replace`` products are written as a new version.  Both stamp the silver load
timestamp with the explicit ``as_of``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import merge as M
from ...sources.schema import align_to_target
from ...sources.store import VersionedTable, stamp
from . import commercial, opex_trace, production, reports
from .common import Bronze, ProductParams, ProductSpec, TableBronze

PRODUCTS: dict[str, ProductSpec] = {s.name: s for s in [
    ProductSpec("DIM_CONDICAO_PAGAMENTO", "dimension", "upsert", ("CODCPG",), commercial.payment_terms,
                ("E028CPG",),
                order=("ULTATU",), descending=True),
    ProductSpec("DIM_PRODUTO", "dimension", "upsert", ("CHAVE_ITEM",), commercial.product_variants,
                ("E075DER", "E075PRO", "E013AGP", "E022CLF"),
                order=("CODITEM",), descending=True),
    ProductSpec("DIM_REPRESENTANTE", "dimension", "upsert", ("CODREP",), commercial.sales_reps,
                ("E090REP", "E026RAM", "USU_T017RVR"),
                order=("DT_CADASTRO",), descending=True),
    ProductSpec("DIM_REGIONAL", "dimension", "upsert", ("ID_REGIONAL",), commercial.regions,
                ("USU_T017RVR", "R999USU"),
                order=("DT_CADASTRO",), descending=True),
    ProductSpec("FAT_METAS", "fact", "upsert", ("CODEMP", "MESANO", "CODTIP", "SEQREG"), commercial.targets,
                ("USU_T101MET", "USU_T101TIP", "USU_T101CRI", "USU_T017RVR", "E090REP", "E013AGP", "E075PRO"),
                order=("MESANO",), descending=True),
    ProductSpec("DIM_CLIENTE", "dimension", "upsert", ("COD_CLIENTE",), commercial.customers,
                ("E140NFV", "E001TNS", "E140IDE", "E085CLI", "E069GRE", "E026RAM", "E085HCL", "USU_T017RVR",
                 "USU_TPCRCPC", "USU_TPCRCDG", "E066FPG", "E028CPG", "USU_TPCAPFC", "USU_TPCAMNC", "E073TRA",
                 "E090REP"),
                order=("COD_CLIENTE",), descending=True),
    ProductSpec("FAT_FATURAMENTO", "fact", "replace", (), commercial.billing,
                ("E120IPD", "E120PED", "E140IPV", "E140IDE", "E001TNS", "E140NFV", "E140PVD", "E140ISV",
                 "E440IPC", "E440NFC", "E095FOR", "E085CLI", "E085HCL", "E069GRE", "E090REP")),
    ProductSpec("FAT_ORCAMENTO_OPEX", "fact", "replace", (), opex_trace.opex_budget,
                ("USU_T650ORC", "USU_T650CUS", "E044CCU", "R910USU", "E043PCM")),
    ProductSpec("FAT_RASTREABILIDADE", "fact", "replace", (), opex_trace.traceability,
                ("E140IPV", "E140NFV", "E085CLI", "E090REP", "E026RAM", "E075PRO", "E120IPD", "USU_T140QRC",
                 "USU_VZRASLAU", "sheet:Cadastro")),
    ProductSpec("DIM_PRODUTO_PRODUCAO", "dimension", "upsert", ("CODEMP", "CODPRO"), production.production_products,
                ("E075PRO", "E075DER", "E013AGP", "E012FAM", "input:legacy")),
    ProductSpec("DIM_CENTRO_CUSTO_PRODUCAO", "dimension", "upsert", ("CODCCU", "CODETG", "CODCRE", "CODOPR"),
                production.cost_centres, ("E720OPR", "E044CCU", "E093ETG", "E725CRE", "input:listed_resources")),
    ProductSpec("DIM_CUSTO_PADRAO_PRODUCAO", "dimension", "replace", (), production.standard_cost, ("sheet:CP",)),
    ProductSpec("FAT_PARADAS_PRODUCAO", "fact", "replace", (), production.stoppages,
                ("E930MPR", "E018MTV", "E093ETG", "E044CCU")),
    ProductSpec("FAT_CUSTO_CC_PRODUCAO", "fact", "replace", (), production.budget_entries,
                ("E626ORC", "E047NTG", "E621MTC")),
    ProductSpec("FAT_UTILIZACAO_META_PRODUCAO", "fact", "replace", (), production.utilisation_target, ("sheet:BD",)),
    ProductSpec("FAT_DESEMPENHO_PRODUCAO", "fact", "replace", (), production.performance,
                ("E900EOQ", "E900COP", "E900OOP", "E093ETG", "E725CRE", "E900QDO", "E630SPE", "E621MTC", "E626TAX",
                 "E210MVP", "E075PRO", "E930MPR", "E018MTV", "E044CCU", "E626ORC", "E047NTG")),
    ProductSpec("DIM_INDICE_RMA", "dimension", "replace", (), reports.rma_index, ("sheet:Planilha1",)),
    ProductSpec("DIM_RECLASSIF_DEFEITOS", "dimension", "replace", (), reports.defect_reclassification,
                ("sheet:DescDefeitos",)),
    ProductSpec("DIM_RECLASSIF_PRODUTOS", "dimension", "replace", (), reports.product_reclassification,
                ("sheet:ClassifProdutos",)),
    ProductSpec("FAT_VENDAS_RMA", "fact", "replace", (), reports.rma_sales,
                ("E140NFV", "E140IPV", "E140IDE", "E001TNS")),
    ProductSpec("FAT_LAUDOS", "fact", "replace", (), reports.report_items,
                ("USU_TLAUITE", "USU_TLAUGER", "USU_TLAUTIP", "USU_TLAUDEF", "USU_TLAUSIT", "USU_TLAUPRB", "E440NFC",
                 "E095FOR", "E075PRO", "E075DER", "E013AGP", "R910USU", "E140NFV", "E073TRA", "USU_TLAUCOR",
                 "USU_VZRASLAU")),
]}

#: Keyword inputs of the builders that no bronze table holds.
PRODUCT_INPUTS = {"DIM_REGIONAL": ("by_region", "by_login"), "DIM_PRODUTO_PRODUCAO": ("legacy",),
                  "DIM_CENTRO_CUSTO_PRODUCAO": ("listed_resources",)}
SHEET_PRODUCTS = {"DIM_CUSTO_PADRAO_PRODUCAO", "DIM_INDICE_RMA", "DIM_RECLASSIF_DEFEITOS", "DIM_RECLASSIF_PRODUTOS"}


def build_product(name: str, bronze: Bronze | None = None, params: ProductParams | None = None,
                  sheet: DataFrame | None = None, **inputs) -> DataFrame:
    spec = PRODUCTS[name]
    params = params or ProductParams()
    if name in SHEET_PRODUCTS:
        return spec.build(sheet)
    if name == "FAT_UTILIZACAO_META_PRODUCAO":
        if sheet is None:
            raise ValueError(f"{name} needs its sheet")
        return spec.build(sheet, params)
    if name == "FAT_RASTREABILIDADE":
        return spec.build(bronze, params, mix_sheet=sheet)
    return spec.build(bronze, params, **inputs)


def _order(spec: ProductSpec, batch: DataFrame) -> list[str]:
    """The dedup order; a key column in it orders nothing within its key."""
    return [c for c in spec.order if c in batch.columns and c not in spec.keys]


def load_product(name: str, df: DataFrame, target: VersionedTable, as_of: str) -> int:
    """Write a product: merge on its keys (upsert) or a new version (replace)."""
    spec = PRODUCTS[name]
    batch = stamp(df, as_of, layer="silver")
    meta = {"as_of": str(as_of)}                      # freshness for downstream consumers
    if spec.load == "upsert" and target.has_rows():
        # a product that gained a column keeps it; older rows read NULL (SNK-09)
        current = target.read()
        batch = align_to_target(batch, current.schema, "add_nullable")
        current = current.withColumns({f.name: F.lit(None).cast(f.dataType) for f in batch.schema.fields if f.name not in current.columns})
        merged = M.upsert(current, batch, list(spec.keys), _order(spec, batch), spec.descending)
        return target.write(merged, meta=meta)
    if spec.load == "upsert":
        batch = M.dedup_first(batch, list(spec.keys), _order(spec, batch), spec.descending)
    return target.write(batch, meta=meta)


def _instant(text: str) -> datetime:
    """A moment from ISO text; without a zone it is UTC."""
    moment = datetime.fromisoformat(text.strip())
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def stale_inputs(name: str, bronze, fresh_after: str) -> list[str]:
    """Bronze inputs of a product whose last load is older than ``fresh_after``
    (REC-14); read from the version manifests, no data scanned."""
    if not isinstance(bronze, TableBronze):
        return []
    stale = []
    for t in PRODUCTS[name].inputs:
        if ":" in t:                                  # sheets and caller inputs
            continue
        loaded = VersionedTable(bronze.spark, f"{bronze.root}/{t}").loaded_as_of()
        if loaded is None or _instant(loaded) < _instant(fresh_after):
            stale.append(t)
    return stale


def run_products(spark, names, bronze: Bronze, silver_root: str, params: ProductParams,
                 sheets: dict | None = None, inputs: dict | None = None, parallelism: int = 1,
                 fresh_after: str | None = None) -> DataFrame:
    """Build and load several products (one silver cycle, E2).

    Each product is an independent job: a failure is reported in its metrics
    row and the others still run; with ``parallelism`` > 1 products are
    submitted concurrently.  ``sheets`` maps product name -> sheet DataFrame,
    ``inputs`` maps product name -> extra keyword inputs (override tables,
    legacy variant list, listed resources).  With ``fresh_after`` a product
    whose bronze inputs were last loaded before that instant is skipped and
    reported ``STALE_INPUT`` (REC-14).
    """
    sheets, inputs = sheets or {}, inputs or {}

    def one(name):
        t0 = time.time()
        if fresh_after is not None:
            stale = stale_inputs(name, bronze, fresh_after)
            if stale:
                return (name, PRODUCTS[name].load, 0, "STALE_INPUT: " + ",".join(stale), 0.0)
        try:
            df = build_product(name, bronze, params, sheet=sheets.get(name), **inputs.get(name, {}))
            saved = load_product(name, df, VersionedTable(spark, f"{silver_root}/{name}"), params.as_of)
            return (name, PRODUCTS[name].load, saved, "OK", round(time.time() - t0, 3))
        except Exception as e:  # noqa: BLE001 - isolation is the point
            return (name, PRODUCTS[name].load, 0, f"ERROR: {type(e).__name__}", round(time.time() - t0, 3))

    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(one, names))
    else:
        rows = [one(n) for n in names]
    return spark.createDataFrame(rows, "product string, load string, saved long, status string, seconds double")


__all__ = ["PRODUCTS", "ProductParams", "TableBronze", "build_product", "load_product", "run_products"]
