"""Declared schemas of the sources and of the bronze tables (FIXTURES.md).

Reading with a declared schema skips inference and keeps an append log's
schema from drifting between batches.
"""

from __future__ import annotations

from pyspark.sql import types as T

_I, _L, _S, _D, _TS = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), \
    T.TimestampType()
_MONEY = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Relational source tables.
ERP_SOURCE = {
    "lojas": _struct(("id", _I), ("nome", _S), ("cidade", _S), ("uf", _S), ("regiao", _S),
                     ("created_at", _TS)),
    "produtos": _struct(("id", _I), ("sku", _S), ("nome", _S), ("categoria", _S),
                        ("custo", _MONEY), ("preco", _MONEY), ("created_at", _TS)),
    "clientes": _struct(("id", _I), ("nome", _S), ("email", _S), ("cidade", _S), ("uf", _S),
                        ("created_at", _TS), ("updated_at", _TS)),
    "vendas": _struct(("id", _I), ("cliente_id", _I), ("loja_id", _I), ("data_venda", _TS),
                      ("status", _S), ("total", _MONEY), ("created_at", _TS),
                      ("updated_at", _TS)),
    "itens_venda": _struct(("id", _I), ("venda_id", _I), ("produto_id", _I),
                           ("quantidade", _I), ("preco_unit", _MONEY), ("subtotal", _MONEY),
                           ("created_at", _TS)),
}

AUDIT = (("_loaded_at", _S), ("_source", _S))


def bronze_of(source: T.StructType) -> T.StructType:
    """Bronze form of a source table: temporal columns as ISO text, decimals
    as double, plus the audit columns (what ``normalise_types`` produces)."""
    fields = []
    for f in source.fields:
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            t = _S
        elif isinstance(t, T.DecimalType):
            t = _D
        fields.append(T.StructField(f.name, t))
    return T.StructType(fields + [T.StructField(n, t) for n, t in AUDIT])


ERP_BRONZE = {name: bronze_of(schema) for name, schema in ERP_SOURCE.items()}

SERIES_BRONZE = _struct(("data", _S), ("valor", _D), *AUDIT)

# Landing-file bronze tables (CSV columns plus audit columns).
TARGETS_BRONZE = _struct(("ano", _L), ("mes", _L), ("loja_id", _L), ("categoria", _S),
                         ("meta_valor", _D), *AUDIT)
STORES_FILE_BRONZE = _struct(("id", _L), ("nome", _S), ("cidade", _S), ("uf", _S),
                             ("regiao", _S), *AUDIT)

# Every bronze table the daily run writes, by table name.
BRONZE = {
    **{f"erp_{name}": schema for name, schema in ERP_BRONZE.items()},
    "files_metas_vendas": TARGETS_BRONZE,
    "files_lojas": STORES_FILE_BRONZE,
    "series": T.StructType(SERIES_BRONZE.fields + [T.StructField("serie", _S)]),
}
