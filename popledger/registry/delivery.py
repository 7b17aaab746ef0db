"""Sources and sinks over the whole test tables: written to the shared folder, read back, compared with the table itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from popledger.operators import ordering as O, reshape as R
from popledger.plans import exclusions, inpatient, mart
from popledger.registry.base import query, shared_folder
from popledger.sources import readers as rd, writers as wr

C = F.col
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders"


def _folder(r) -> str:
    """A new folder for one delivery."""
    return f"{shared_folder(r.m.spark)}/delivery-{uuid.uuid4().hex[:12]}"


@query("io_delimited", ORDERS_SQL)
def _(r):
    path = _folder(r)
    wr.export_csv(r.m.table("orders").select(*ORDERS), path)
    types = [T.LongType(), T.LongType(), T.StringType(), T.StringType()]
    return rd.read_delimited(r.m.spark, path, T.StructType([T.StructField(c, t) for c, t in zip(ORDERS, types)]))


@query("io_guessed", "select o_orderkey, o_totalprice, o_orderpriority from orders")
def _(r):
    path = _folder(r)
    wr.export_csv(r.m.table("orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    guessed = rd.read_guessed(r.m.spark, path)
    return guessed.withColumn("o_orderkey", C("o_orderkey").cast("bigint"))


@query("io_fixed_width", "select cast(c_custkey as varchar) as hicno, trim(c_mktsegment) as market from customer")
def _(r):
    path = _folder(r)
    line = F.concat(F.rpad(C("c_custkey").cast("string"), 12, " "), F.rpad("c_mktsegment", 16, " "))
    lines = r.m.table("customer").select(line.alias("HICNO       MARKET"))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").option("ignoreTrailingWhiteSpace", False).csv(path)
    return rd.read_fixed_width(r.m.spark, path, {"hicno": 12, "market": 16})


@query(
    "io_xml_control",
    "select case p_brand when 'Brand#11' then 'Beneficiary Declined' else p_brand end as beneexcreason, count(*) as n, cast(0 as bigint) as control_off from part group by 1",
)
def _(r):
    """Records and a control total as XML; the total agrees with what is read."""
    spark, path = r.m.spark, _folder(r)
    people = r.m.table("part").select(C("p_partkey").cast("string").alias("hicno"), F.when(C("p_brand") == "Brand#11", "BD").otherwise(C("p_brand")).alias("beneexcreason"))
    people.write.format("xml").option("rootTag", "file").option("rowTag", "bene").save(f"{path}/rows")
    people.agg(F.count(F.lit(1)).alias("recordcount")).write.format("xml").option("rootTag", "file").option("rowTag", "ctl").save(f"{path}/control")
    fields = T.StructType([T.StructField("hicno", T.StringType()), T.StructField("beneexcreason", T.StringType())])
    rows = rd.read_xml(spark, f"{path}/rows", "bene", fields)
    control = rd.read_xml(spark, f"{path}/control", "ctl", T.StructType([T.StructField("recordcount", T.LongType())]))
    off = exclusions.control_mismatch(rows, control).agg(F.count(F.lit(1)).alias("control_off"))
    return exclusions.bene_exclusion(rows).groupBy("beneexcreason").agg(F.count(F.lit(1)).alias("n")).crossJoin(off)


@query("io_copy_partitioned", "select o_orderkey, o_custkey, o_orderpriority, o_orderstatus from orders")
def _(r):
    """A table written by status, copied, and read from the copy."""
    path = _folder(r)
    wr.write_table(r.m.table("orders").select(*ORDERS), f"{path}/a/orders", partition_by=["o_orderstatus"])
    wr.copy_tables(r.m.spark, f"{path}/a", f"{path}/b", ["orders"])
    return rd.read_parquet(r.m.spark, f"{path}/b/orders", columns=["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])


@query("io_export_flat", "select 'customer' as name_table, count(*) as n, count(distinct c_name) as names from customer union all select 'supplier', count(*), count(distinct s_name) from supplier")
def _(r):
    """A mart as delimited text, one folder per table."""
    spark, path = r.m.spark, _folder(r)
    for t, c in (("customer", "c_name"), ("supplier", "s_name")):
        wr.write_table(r.m.table(t).select(C(c).alias("name")), f"{path}/mart/{t}")
    wr.export_flat(spark, f"{path}/mart", f"{path}/flat", ["customer", "supplier"])
    read = [rd.read_guessed(spark, f"{path}/flat/{t}").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("names")).select(F.lit(t).alias("name_table"), "n", "names") for t in ("customer", "supplier")]
    return R.stack(read)


@query("io_newest_snapshot", "select max(o_orderstatus) as status, count(*) as n from orders where o_orderstatus = (select max(o_orderstatus) from orders)")
def _(r):
    """Snapshot folders are listed by name, and the newest is read."""
    path = _folder(r)
    r.m.table("orders").select(*ORDERS).write.partitionBy("o_orderstatus").parquet(path)
    files = rd.list_files(r.m.spark, path, "*.parquet", recursive=True).withColumn("name", F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1))
    newest = rd.newest_file(files.where("length > 0"))
    orders = rd.read_parquet(r.m.spark, path)
    return orders.join(newest.select("name"), C("o_orderstatus") == C("name")).agg(F.max("o_orderstatus").alias("status"), F.count(F.lit(1)).alias("n"))


@query("u_interleave", "select 'customer' as side, c_nationkey as nationkey, count(*) as n from customer group by 2 union all select 'supplier', s_nationkey, count(*) from supplier group by 2 order by nationkey, side")
def _(r):
    """Two sorted tables read as one in the order of their key."""
    n = F.count(F.lit(1)).alias("n")
    a = r.m.table("customer").groupBy(C("c_nationkey").alias("nationkey")).agg(n).withColumn("side", F.lit("customer"))
    b = r.m.table("supplier").groupBy(C("s_nationkey").alias("nationkey")).agg(n).withColumn("side", F.lit("supplier"))
    return O.sorted_output(R.stack([a, b]), C("nationkey"), C("side"))


@query(
    "io_discharge_texts",
    """select coalesce(t, 'Other') as discharge_status_desc, count(*) as n from med left join (values ('01', 'Discharged to Home'), ('62', 'Discharged to IRF'), ('03', 'Discharged to SNF'),
      ('06', 'Discharged to Home Health Care'), ('20', 'Died')) v(c, t) on dischargestatus = c group by 1""",
)
def _(r):
    """The crosswalk of discharge codes as a delivered text file, read and put on the claims."""
    path = _folder(r)
    wr.export_csv(r.m.discharge_crosswalk, path)
    fields = T.StructType([T.StructField("dischargestatus", T.StringType()), T.StructField("discharge_status_desc", T.StringType())])
    texts = rd.read_delimited(r.m.spark, path, fields)
    return inpatient.with_discharge_text(r.outclaims.select("dischargestatus"), texts).groupBy("discharge_status_desc").agg(F.count(F.lit(1)).alias("n"))


def _sum(table: str, columns: str) -> str:
    """The manifest's checksum in SQL; a trailing # marks a fraction."""
    parts = []
    for c in sorted(columns.split()):
        value = f"cast(cast({c[:-1]} as decimal(38,9)) as varchar)" if c.endswith("#") else f"cast({c} as varchar)"
        parts.append(f"coalesce(length({value}) || ':' || {value}, 'N')")
    return (
        f"select '{table}' as name_table, count(*) as rows, cast(sum(cast(('0x' || substr(md5({' || '.join(parts)}), 1, 15)) as bigint)) as varchar) as checksum from {table}"
    )


MANIFEST = {
    "region": "r_name r_regionkey",
    "nation": "n_name n_nationkey n_regionkey",
    "customer": "c_acctbal# c_custkey c_mktsegment c_name c_nationkey",
    "supplier": "s_acctbal# s_name s_nationkey s_suppkey",
    "part": "p_brand p_name p_partkey p_retailprice# p_size p_type",
    "orders": "o_custkey o_orderdate o_orderkey o_orderpriority o_orderstatus o_totalprice#",
    "lineitem": "l_discount# l_extendedprice# l_linenumber l_linestatus l_orderkey l_partkey l_quantity# l_returnflag l_shipdate l_suppkey l_tax#",
}


@query("table_manifest", " union all ".join(_sum(t, c) for t, c in MANIFEST.items()))
def _(r):
    """Rows and checksum over all columns."""
    return mart.manifest({t: r.m.table(t) for t in MANIFEST})
