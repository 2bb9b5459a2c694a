"""Property inputs laid over the star tables of TESTDATA.md, as plain SQL templates.

The SQL only states what the raw inputs look like; Spark and the SQL check both run it. It plants the
difficulties the pipeline must handle: a price repeated on every line, exact copies, dirty texts,
missing surfaces and coordinates, several communes inside one sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

RAW_LINES = """
with j as (
  select l.*, o.*, c.c_custkey, cn.n_regionkey as dep, sn.n_nationkey as com,
         sn.n_name as com_name, p.p_type
  from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
  join {customer} c on c.c_custkey = o.o_custkey
  join {nation} cn on cn.n_nationkey = c.c_nationkey
  join {supplier} s on s.s_suppkey = l.l_suppkey
  join {nation} sn on sn.n_nationkey = s.s_nationkey
  join {part} p on p.p_partkey = l.l_partkey),
t as (select
  cast(l_orderkey as string) as id_mutation,
  case when l_orderkey % 97 = 0 then 'n/a' when l_orderkey % 89 = 0 then ''
       else cast(cast(o_orderdate as date) as string) end as date_mutation,
  case when o_orderstatus = 'P' and l_orderkey % 3 = 0 then 'Echange' else 'Vente' end
    as nature_mutation,
  case when l_orderkey % 101 = 0 then '' when l_orderkey % 103 = 0 then '0'
       else cast(cast(o_totalprice as decimal(18,2)) as string) end as valeur_fonciere,
  cast(10000 + com * 100 + l_suppkey % 3 as string) as code_postal,
  cast(100 + com as string) as code_commune, com_name as nom_commune,
  cast(dep as string) as code_departement,
  cast(l_partkey as string) as id_parcelle,
  case when l_linenumber % 4 = 0 then '' else cast(l_linenumber as string) end as nombre_lots,
  case when p_type in ('STANDARD','MEDIUM') then 'Appartement' when p_type = 'SMALL' then 'Maison'
       when p_type = 'ECONOMY' then 'Dépendance'
       when p_type = 'PROMO' then 'Local industriel. commercial ou assimilé' else '' end
    as type_local,
  case when l_partkey % 29 = 0 then ''
       else cast(cast(l_quantity as decimal(18,2)) as string) end as surface_reelle_bati,
  cast(l_linenumber as string) as nombre_pieces_principales,
  cast(cast(l_extendedprice as decimal(18,2)) as string) as surface_terrain,
  case when c_custkey % 50 = 0 then ''
       else cast(cast(2.0 + ((c_custkey * 3571) % 7000) / 10000.0 as decimal(9,4)) as string) end
    as longitude,
  case when c_custkey % 50 = 0 then ''
       else cast(cast(48.6 + ((c_custkey * 7919) % 4000) / 10000.0 as decimal(9,4)) as string) end
    as latitude,
  case when l_orderkey % 7 = 0 then 2 else 1 end as copies
  from j)
select id_mutation, date_mutation, nature_mutation, valeur_fonciere, code_postal, code_commune,
  nom_commune, code_departement, id_parcelle, nombre_lots, type_local, surface_reelle_bati,
  nombre_pieces_principales, surface_terrain, longitude, latitude from t
union all
select id_mutation, date_mutation, nature_mutation, valeur_fonciere, code_postal, code_commune,
  nom_commune, code_departement, id_parcelle, nombre_lots, type_local, surface_reelle_bati,
  nombre_pieces_principales, surface_terrain, longitude, latitude from t where copies = 2
"""

# one row per station and line; about a third as many stations as suppliers
STATION_LINES = """
select 'Gare ' || cast(k as string) as nom_gares,
  case s_suppkey % 5 when 0 then 'RER' when 1 then 'metro ' when 2 then 'TRAIN' when 3 then 'VAL'
       else 'TRAMWAY' end as mode,
  'L' || cast(s_suppkey % 7 as string) as res_com,
  case when s_suppkey % 61 = 60 then 'x' else
    cast(cast(48.6 + (k * 6007 % 4000) / 10000.0 as decimal(9,4)) as string) end as latitude,
  cast(cast(2.0 + (k * 4967 % 7000) / 10000.0 as decimal(9,4)) as string) as longitude
from (select s_suppkey, cast(floor(s_suppkey / 3) as bigint) as k from {supplier}) s
"""

PLANNED_LINES = """
select ' Arret ' || cast(k as string) as nom_arret,
  case s_suppkey % 6 when 0 then 'Métro 14' when 1 then 'Métro 15 Sud' when 2 then 'Metro 16'
       when 3 then 'métro 18' when 4 then 'Tram 1' else 'Métro 11' end as nom_projet,
  case s_suppkey % 7 when 5 then ' Bus' when 6 then null else 'Metro ' end as mode,
  case when s_suppkey % 11 = 0 then 'x' else cast(s_suppkey % 4 as string) end as phase,
  case when s_suppkey % 2 = 0 then 'Travaux ' else 'Etudes' end as statut,
  cast(cast(48.6 + (k * 5003 % 4000) / 10000.0 as decimal(9,4)) as string) as latitude,
  cast(cast(2.0 + (k * 3049 % 7000) / 10000.0 as decimal(9,4)) as string) as longitude
from (select s_suppkey, cast(floor(s_suppkey / 2) as bigint) as k from {supplier}) s
"""

# one row per commune; the three quantiles are added by income_raw()
INCOME_BASE = """
select ' ' || cast(100 + n_nationkey as string) as code_commune, n_name || ' ' as libelle_commune,
  n_nationkey from {nation}
"""

ENERGY_LINES = """
select cast(100 + cast(substr(p_brand, 7) as int) as string) || ' ' as code_commune,
  case p_size % 8 when 0 then 'A' when 1 then ' b' when 2 then 'C' when 3 then 'D ' when 4 then 'e'
       when 5 then 'F' when 6 then 'g' else 'N.C.' end as etiquette_dpe,
  cast(count(*) as string) as nb_dpe
from {part} group by 1, 2
"""

SEED = """
select cast(r_regionkey as string) as code_departement, r_name as nom_departement,
  case when r_regionkey = 0 then 'Paris' when r_regionkey <= 2 then 'Petite couronne'
       else 'Grande couronne' end as zone
from {region}
"""

CITY_DEPARTMENT = "0"
AS_OF = "2001-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in template}
    return spark.sql(template, **used)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RAW_LINES)


def income_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns like the published file; one commune is under statistical secrecy."""
    from pyspark.sql import functions as F

    from cadastria.functions import columns as C
    from cadastria.operators.quantiles import exact_quantiles

    balance = F.col("c_acctbal") + 15000.0
    customers = table(spark, sf_dir, "customer")
    levels = exact_quantiles(customers, ["c_nationkey"], {
        "revenu_median": (balance, 0.5), "revenu_d1": (balance, 0.1), "revenu_d9": (balance, 0.9),
    })
    counts = customers.groupBy("c_nationkey").agg(F.count("*").alias("nb_menages"))

    def text(c: str):
        euros = C.round_half_away(c, 0).cast("bigint").cast("string")
        return F.when(F.col("n_nationkey") == 7, "").otherwise(euros).alias(c)

    return (
        run(spark, sf_dir, INCOME_BASE)
        .join(levels, F.col("n_nationkey") == F.col("c_nationkey"), "left").drop("c_nationkey")
        .join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select(
            "code_commune", "libelle_commune", F.col("nb_menages").cast("string"),
            text("revenu_median"), text("revenu_d1"), text("revenu_d9"),
            (F.col("n_nationkey") + 10).cast("string").alias("part_pensions_pct"),
            F.lit("2021").alias("millesime"),
        )
    )
