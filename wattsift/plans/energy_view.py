"""The energy-shaped raw table, derived from orders and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattsift.profile import ENERGY
from wattsift.session import spread

_SOURCES = tuple(c.removesuffix("_pct") for c in ENERGY.shares[1:])  # the first share is written out below


def _other_sources(q: str) -> str:
    lines = []
    for i, name in enumerate(_SOURCES):
        value = f"case when o_orderkey % 37 % 11 = {i} then 100 - o_orderkey % 101 else 0 end"
        if name == "charbon":
            value += " + case when o_orderkey % 17 = 0 then 5 else 0 end"
        value = f"cast({value} as double)"
        if name == "houille":
            value = f"case when o_orderkey % 19 = 0 then null else {value} end"
        lines.append(f"{value} as {q}{name}_%{q}")
    return ",\n ".join(lines)


def raw_energy_sql(quote: str = '"', orders: str = "orders", customer: str = "customer") -> str:
    q = quote
    return f"""select o_orderkey as source_row_id,
 case when o_orderkey % 29 = 0 then null when o_orderkey % 13 = 0 then '2010-2019'
  else cast(2020 + o_orderkey % 4 as varchar(4)) end as annee_de_consommation,
 case o_orderstatus when 'F' then '1A' when 'O' then '1B' else '2' end as cas_assujettissement_efa,
 c_mktsegment as categorie_activite_majoritaire_efa,
 concat(c_mktsegment, '/', o_orderpriority) as sous_categorie_activite_majoritaire_efa,
 cast(1 + o_orderkey % 3 as bigint) as nombre_de_categories_activite_distinctes,
 cast(1 + o_orderkey % 5 as bigint) as nombre_de_sous_categories_activite_distinctes,
 case when o_orderkey % 23 = 0 then 'n/c' else cast(cast(floor(o_totalprice / 100) as bigint) as varchar(20)) end
  as ratio_de_consommation_ajustee_du_climat_kwh_par_m2,
 cast(cast(floor(o_totalprice / 100) as bigint) + o_orderkey % 41 - 20 as varchar(20))
  as ratio_de_consommation_brut_kwh_par_m2,
 cast(o_orderkey % 97 as double) as {q}consommation_individuelle_%{q},
 case when o_orderkey % 31 = 0 then null else cast(0 as double) end as {q}consommation_espaces_communs_%{q},
 cast(100 - o_orderkey % 97 - case when o_orderkey % 43 = 0 then 3 else 0 end as double) as {q}consommation_repartie_%{q},
 cast(o_orderkey % 101 as double) as {q}electricite_%{q},
 {_other_sources(q)}
from {orders} join {customer} on o_custkey = c_custkey"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_energy(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    sql = raw_energy_sql("`", "{orders}", "{customer}")
    orders = table(spark, sf_dir, "orders")
    return spark.sql(sql, orders=spread(orders) if spread_rows else orders, customer=table(spark, sf_dir, "customer"))
