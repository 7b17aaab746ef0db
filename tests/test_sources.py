"""Readers and writers, round trip in a temporary folder."""

from pyspark.sql import functions as F, types as T

from popledger.plans.exclusions import bene_exclusion, control_mismatch
from popledger.plans.groups import market_lists, numbered_lists, ragged_lists, restrict, wide_lists_to_long
from popledger.sources import readers as rd, writers as wr
from popledger.sources.schema import FIELDS, MartSchema, conform, empty_table, labels_of, schema_violations, value_violations


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_delimited_text_with_quotes_and_short_lines(spark, tmp_path):
    p = write(tmp_path / "x.csv", 'disch_code,disch_desc\n01,"Home, sweet"\n20,Died\n99\n')
    schema = T.StructType([T.StructField("disch_code", T.StringType()), T.StructField("disch_desc", T.StringType())])
    assert [tuple(r) for r in rd.read_delimited(spark, p, schema).collect()] == [("01", "Home, sweet"), ("20", "Died"), ("99", None)]


def test_guessed_types(spark, tmp_path):
    p = write(tmp_path / "g.csv", "a,b,c\n1,x,1.5\n2,,2.5\n")
    df = rd.read_guessed(spark, p)
    assert [t for _, t in df.dtypes] == ["int", "string", "double"]


def test_fixed_width_without_header(spark, tmp_path):
    p = write(tmp_path / "f.txt", "HICNO      MARKET\nA1         north shore\nB22        MA\n")
    df = rd.read_fixed_width(spark, p, {"hicno": 11, "market_name_orig": 16})
    assert sorted(tuple(r) for r in df.collect()) == [("A1", "north shore"), ("B22", "MA")]
    tidy = market_lists(df, first_word=True)
    assert [tuple(r) for r in tidy.collect()] == [("A1", "North")]


def test_xml_rows_with_control_total(spark, tmp_path):
    p = write(tmp_path / "b.xml", "<f><ctl><recordcount>2</recordcount></ctl><bene><hicno>A</hicno><beneexcreason>BD</beneexcreason></bene><bene><hicno>B</hicno><beneexcreason>ZZ</beneexcreason></bene></f>")
    rows = rd.read_xml(spark, p, "bene", T.StructType([T.StructField("hicno", T.StringType()), T.StructField("beneexcreason", T.StringType())]))
    control = rd.read_xml(spark, p, "ctl", T.StructType([T.StructField("recordcount", T.LongType())]))
    assert {r.hicno: r.beneexcreason for r in bene_exclusion(rows).collect()} == {"A": "Beneficiary Declined", "B": "ZZ"}
    assert control_mismatch(rows, control).isEmpty()
    assert not control_mismatch(rows.limit(1), control).isEmpty()


def test_files_newest_by_name_and_digest(spark, tmp_path):
    for n in ("P.BNEXC.D160101.xml", "P.BNEXC.D160301.xml", "other.txt"):
        write(tmp_path / n, n)
    files = rd.list_files(spark, str(tmp_path), "*BNEXC*")
    assert rd.newest_file(files).first()["name"] == "P.BNEXC.D160301.xml"
    assert sorted(r.stamp for r in rd.snapshots_by_stamp(files).collect()) == ["160101", "160301"]
    assert wr.file_digests(spark, str(tmp_path), "*.txt").count() == 1


def test_tables_copy_export_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, t string")
    wr.write_table(df, str(tmp_path / "m" / "t1"))
    wr.copy_tables(spark, str(tmp_path / "m"), str(tmp_path / "n"), ["t1"])
    wr.export_flat(spark, str(tmp_path / "n"), str(tmp_path / "csv"), ["t1"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "t1")).count() == 2
    back = rd.read_parquet(spark, str(tmp_path / "m" / "t1"), str(tmp_path / "n" / "t1"))
    assert back.count() == 4
    shuffled = df.orderBy(F.col("id").desc())
    assert wr.checksum(df, "t").collect() == wr.checksum(shuffled, "t").collect()
    assert wr.checksum(df, "t").first().checksum != wr.checksum(df.limit(1), "t").first().checksum


def test_checksum_tells_rows_apart(spark):
    sums = [
        wr.checksum(spark.createDataFrame([row], "a string, b string, c double"), "t").first().checksum
        for row in [("x|y", "z", 1.0), ("x", "y|z", 1.0), (None, "z", 1.0), ("~", "z", 1.0), ("N", "z", 1.0), ("x", "y|z", 1.5), ("1:x", "z", None), (None, None, None)]
    ]
    assert len(set(sums)) == len(sums)


def test_checksum_is_the_sum_of_whole_digests(spark, tmp_path):
    """Digests are summed as whole numbers, in parts, by the checksum and by the writer, and the total is that of the digests themselves."""
    import hashlib

    from popledger.sources.schema import MartSchema

    rows = [(f"m{i}", None if i % 3 else "x", i) for i in range(200)]
    text = lambda row: "".join("N" if v is None else f"{len(str(v))}:{v}" for v in row)
    want = sum(int(hashlib.md5(text(row).encode()).hexdigest()[:15], 16) for row in rows)
    df = wr.checksum(spark.createDataFrame(rows, "a string, b string, c long"), "t")
    assert (df.first()["rows"], df.first().checksum) == (200, str(want)) and want > 2**60
    assert "decimal(20,0)" not in df._jdf.queryExecution().executedPlan().toString().lower()
    assert wr.checksum(spark.createDataFrame([], "a string"), "t").first().checksum == "0"
    schema = MartSchema.declared()
    costs = spark.createDataFrame([("C", f"m{i}", "w", i / 4) for i in range(100)], schema.struct("member_costs"))
    seen = wr.write_observed(costs, schema, "member_costs", str(tmp_path))
    again = wr.checksum(spark.read.parquet(str(tmp_path / "member_costs")), "member_costs").first()
    assert (seen["rows"], seen["checksum"]) == (again["rows"], again.checksum) and seen["checksum"] != "0"


def test_absent_source_is_an_empty_typed_table(spark):
    s = MartSchema.declared()
    assert empty_table(spark, s, "member_costs").count() == 0
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert rd.optional_table(spark, None, schema).schema == schema


def test_declared_schema_from_csv_equals_built_in(tmp_path):
    built = MartSchema.declared()
    fields = write(tmp_path / "f.csv", "name_field,label,data_type,data_size,allow_nulls,whitelist_nonnull_values,require_label_ifnotallnull\n" + "\n".join(
        ",".join([n, "", t, str(s or ""), "NY"[nulls], "~".join(allowed), "NY"[lab]]) for n, t, s, nulls, allowed, lab in FIELDS
    ))
    tables = write(tmp_path / "t.csv", "name_field,name_table,key_table,key_global\n" + "\n".join(
        f"{c},{t},{'Y' if c in built.keys(t) else 'N'},N" for t in built.tables for c in built.columns(t)
    ))
    read = MartSchema.from_csv(fields, tables)
    assert read.tables == built.tables
    assert all(read.fields[n] == f for n, f in built.fields.items() if n != "risk_score_type")


def test_conform_types_labels_and_violations(spark):
    s = MartSchema.declared()
    raw = spark.createDataFrame([("C", "m1  ", "P", 1), ("C", None, "P", 2)], "name_client string, member_id string, time_period string, total_cost int")
    df = conform(raw, s, "member_costs", {"total_cost": "Total"})
    assert df.schema["total_cost"].dataType == T.DoubleType() and labels_of(df) == {"total_cost": "Total"}
    assert df.first().member_id == "m1" and schema_violations(df, s, "member_costs") == []
    assert schema_violations(raw, s, "member_costs") != []
    assert [tuple(r) for r in value_violations(df, s, "member_costs").collect()] == [("member_costs", "member_id", "null", 1)]


def test_lists_long_and_ragged(spark):
    wide = spark.createDataFrame([("a", "b"), ("c", None)], "North string, South string")
    long = wide_lists_to_long(wide)
    assert sorted(tuple(r) for r in long.collect()) == [("North", "a"), ("North", "c"), ("South", "b")]
    table = spark.createDataFrame([("a", 1), ("b", 2)], "member_id string, v int")
    assert restrict(table, long, "North").collect()[0].v == 1
    again = ragged_lists(numbered_lists(long.selectExpr("group as market_name", "member_id as hicno")), ["North", "South"])
    assert again.count() == 2


def test_staged_tables_go_to_the_checkpoint_folder(spark):
    folder = wr.staging_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = wr.materialise(spark.range(3).toDF("id"), "three", folder)
    assert df.count() == 3 and all(folder in f for f in df.inputFiles())
    assert wr.materialise(df, "none", None) is df


def test_staging_needs_a_shared_folder():
    import pytest

    class Session:
        conf = {}

    with pytest.raises(ValueError):
        wr.staging_folder(Session())
