"""Silver layer: typed, renamed, de-duplicated views over the bronze logs.

Each stager is ``bronze DataFrame -> silver DataFrame``.  Output columns are
declared as ``(name, source column, SQL template)``; an output whose source
column is absent from the input is skipped, so the same stager serves the
ERP schema and narrower sources.  Everything stays lazy: when a silver
frame feeds a gold query, Catalyst prunes columns and pushes filters through
it down to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.dates import month_start, parse_series_date
from tributary.operators.dedup import latest_version

# (output name, source column, template over ``{c}``); None = pass through.
Spec = Sequence[tuple[str, str, str | None]]

SALES_SPEC: Spec = (
    ("venda_id", "id", None),
    ("cliente_id", "cliente_id", None),
    ("loja_id", "loja_id", None),
    ("data_venda", "data_venda", "cast({c} as timestamp)"),
    ("data_venda_date", "data_venda", "to_date(cast({c} as timestamp))"),
    ("status", "status", None),
    ("total", "total", "cast({c} as double)"),
    ("updated_at", "updated_at", "cast({c} as timestamp)"),
)

ITEMS_SPEC: Spec = (
    ("item_id", "id", None),
    ("venda_id", "venda_id", None),
    ("produto_id", "produto_id", None),
    ("quantidade", "quantidade", "cast({c} as bigint)"),
    ("preco_unit", "preco_unit", "cast({c} as double)"),
    ("subtotal", "subtotal", "cast({c} as double)"),
)

CUSTOMERS_SPEC: Spec = (
    ("cliente_id", "id", None),
    ("cliente_nome", "nome", None),
    ("email", "email", None),
    ("cidade", "cidade", None),
    ("uf", "uf", None),
)

STORES_SPEC: Spec = (
    ("loja_id", "id", None),
    ("loja_nome", "nome", None),
    ("cidade", "cidade", None),
    ("uf", "uf", None),
    ("regiao", "regiao", None),
)

PRODUCTS_SPEC: Spec = (
    ("produto_id", "id", None),
    ("sku", "sku", None),
    ("produto_nome", "nome", None),
    ("categoria", "categoria", None),
    ("custo", "custo", "cast({c} as double)"),
    ("preco", "preco", "cast({c} as double)"),
)

TARGETS_SPEC: Spec = (
    ("ano", "ano", "cast({c} as bigint)"),
    ("mes", "mes", "cast({c} as bigint)"),
    ("loja_id", "loja_id", "cast({c} as bigint)"),
    ("categoria", "categoria", None),
    ("meta_valor", "meta_valor", "cast({c} as double)"),
)


def project(df: DataFrame, spec: Spec) -> DataFrame:
    """Apply a column spec (rename + cast); absent sources are skipped."""
    present = set(df.columns)
    cols: list[Column] = []
    for out, src, template in spec:
        if src not in present:
            continue
        expr = F.col(src) if template is None else F.expr(template.format(c=f"`{src}`"))
        cols.append(expr.alias(out))
    return df.select(*cols)


def _dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
           tiebreak: Sequence[str] | None) -> DataFrame:
    """The newest version per key; without ``keys`` the rows are that already, as a stored state's are."""
    if not keys:
        return df
    order = [c for c in order_by if c in df.columns]
    return latest_version(df, keys, order, tiebreak)


def stage_sales(bronze: DataFrame, completed: str = "concluida",
                keys: Sequence[str] = ("id",), order_by: Sequence[str] = ("_loaded_at",),
                tiebreak: Sequence[str] | None = None, spec: Spec = SALES_SPEC) -> DataFrame:
    """Latest version per sale, kept only when that version is completed.

    The status filter runs *after* de-duplication: a sale whose newest
    version is cancelled disappears even if an older version was completed.
    """
    latest = _dedup(bronze, keys, order_by, tiebreak)
    return project(latest.where(F.col("status") == F.lit(completed)), spec)


def stage_items(bronze: DataFrame, keys: Sequence[str] = ("id",),
                order_by: Sequence[str] = ("_loaded_at",),
                tiebreak: Sequence[str] | None = None, spec: Spec = ITEMS_SPEC) -> DataFrame:
    """Latest version per line item, quantities as bigint, money as double."""
    return project(_dedup(bronze, keys, order_by, tiebreak), spec)


def stage_customers(bronze: DataFrame, keys: Sequence[str] = ("id",),
                    order_by: Sequence[str] = ("_loaded_at",),
                    tiebreak: Sequence[str] | None = None,
                    spec: Spec = CUSTOMERS_SPEC) -> DataFrame:
    """Latest version per customer."""
    return project(_dedup(bronze, keys, order_by, tiebreak), spec)


def stage_stores(bronze: DataFrame, spec: Spec = STORES_SPEC) -> DataFrame:
    """Stores, every bronze version kept (no de-duplication at this layer)."""
    return project(bronze, spec)


def stage_products(bronze: DataFrame, spec: Spec = PRODUCTS_SPEC) -> DataFrame:
    """Products, every bronze version kept (no de-duplication at this layer)."""
    return project(bronze, spec)


def stage_targets(bronze: DataFrame, spec: Spec = TARGETS_SPEC) -> DataFrame:
    """Monthly targets with typed keys and the month's first day."""
    typed = project(bronze, spec)
    return typed.withColumn("data_mes", month_start("ano", "mes"))


def parse_series(bronze: DataFrame, value_name: str, date_col: str = "data",
                 value_col: str = "valor", permissive: bool = False,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Bronze series ``(data text, valor)`` → ``(data date, <value_name> double)``,
    plus the ``keep`` columns (e.g. the series name of a long table)."""
    value = F.col(value_col).cast("double")
    if permissive:
        value = F.col(value_col).try_cast("double")
    return bronze.select(*keep, parse_series_date(date_col, permissive).alias("data"),
                         value.alias(value_name))
