"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from brightloom.plans.registry import query, table
from brightloom.session import scratch_path
from brightloom.sources import readers, writers


@query("s01_text_lines", sql="""
    SELECT o_orderkey || ' ' || o_custkey AS value FROM orders""")
def text_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    writers.write_lines(table(spark, sf_dir, "orders").select(F.concat_ws(" ", "o_orderkey", "o_custkey")), path)
    return readers.read_lines(spark, path)


@query("s02_number_range", sql="""
    SELECT r.id, CAST(count(l.l_orderkey) AS BIGINT) AS n_lines
    FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id) r
    LEFT JOIN lineitem l ON l.l_orderkey = r.id GROUP BY r.id""")
def number_range(spark, sf_dir):
    """Lines per order key of the whole key range, also for keys without lines."""
    top = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"))
    return (
        readers.number_range(spark, 0, top + 1)
        .join(lines, "id", "left")
        .select("id", F.coalesce("n", F.lit(0)).alias("n_lines"))
    )


@query("s03_csv_strings", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def csv_strings(spark, sf_dir):
    path = scratch_path(spark, "customer")
    writers.write_csv(table(spark, sf_dir, "customer"), path)
    return readers.read_csv_strings(spark, path, ["c_custkey", "c_name", "c_mktsegment"])


PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType(), False),
    T.StructField("p_name", T.StringType()),
    T.StructField("p_size", T.IntegerType()),
    T.StructField("p_retailprice", T.DoubleType()),
])


@query("s04_csv_schema_trimmed", sql="""
    SELECT p_partkey, p_name, p_size, p_retailprice FROM part""")
def csv_schema(spark, sf_dir):
    """Fields are written with blanks around them, which the reader trims."""
    path = scratch_path(spark, "part")
    padded = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_size", "p_retailprice")
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_csv_typed(spark, path, PART_SCHEMA)


@query("s05_csv_drop_malformed", sql="""
    SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size >= 10""")
def csv_drop_malformed(spark, sf_dir):
    """Sizes of one digit are written with a unit, so those rows do not fit the schema."""
    path = scratch_path(spark, "part")
    writers.write_csv(table(spark, sf_dir, "part").select(
        "p_partkey", "p_name",
        F.when(F.col("p_size") < 10, F.concat("p_size", F.lit("cm"))).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        "p_retailprice"), path)
    return readers.read_csv_typed(spark, path, PART_SCHEMA, drop_malformed=True)


@query("s06_csv_named_columns", sql="""
    SELECT CAST(s_suppkey AS VARCHAR) AS supplier, s_name AS name FROM supplier""")
def csv_named(spark, sf_dir):
    path = scratch_path(spark, "supplier")
    writers.write_csv(table(spark, sf_dir, "supplier"), path, header=False)
    return readers.read_csv_named(spark, path, "supplier, name, nation, balance", ["supplier", "name"])


@query("s07_csv_inferred", sql="""
    SELECT p_name, p_brand, p_size, p_retailprice FROM part""")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "part")
    writers.write_csv(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row"), "p_name", "p_brand", "p_size", "p_retailprice"), path)
    return readers.read_csv_inferred(spark, path, index_column="row")


@query("s08_tagged_stack", sql="""
    SELECT 'customer' AS origin, CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
    UNION ALL
    SELECT 'supplier', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier""")
def tagged_stack(spark, sf_dir):
    paths = {}
    for name, columns in {"customer": ("c_custkey", "c_nationkey"), "supplier": ("s_suppkey", "s_nationkey")}.items():
        paths[name] = scratch_path(spark, name)
        writers.write_csv(table(spark, sf_dir, name).select(*columns).toDF("id", "nation"), paths[name])
    return readers.read_tagged(paths, lambda path: readers.read_csv_strings(spark, path), "origin")


@query("s09_delimited_lines", sql="""
    SELECT n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
    UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""")
def delimited_lines(spark, sf_dir):
    """Tab-separated lines whose first field is an index."""
    lines = table(spark, sf_dir, "nation").select(F.concat_ws("\t", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    more = table(spark, sf_dir, "supplier").select(F.concat_ws("\t", "s_suppkey", "s_name", "s_nationkey").alias("value"))
    return readers.split_lines(lines.union(more), ["n_name", "n_regionkey"], index_first=True)


@query("s10_rows_with_schema", sql="""
    SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price FROM orders""")
def rows_with_schema(spark, sf_dir):
    schema = T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("customer", T.LongType(), False),
        T.StructField("price", T.DoubleType()),
    ])
    lines = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_totalprice").alias("value"))
    return readers.apply_schema(readers.split_lines(lines, ["a", "b", "c"], sep=","), schema)


@query("s11_enumerated_values", sql="""
    SELECT CAST(row_number() OVER (ORDER BY p_name) - 1 AS BIGINT) AS index, p_name AS id
    FROM (SELECT DISTINCT p_name FROM part)""")
def enumerated_values(spark, sf_dir):
    return readers.enumerate_values(table(spark, sf_dir, "part"), "p_name")


@query("s12_partitioned_parquet", sql="""
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""")
def partitioned_parquet(spark, sf_dir):
    """The filter on the partition column reads one folder only."""
    path = scratch_path(spark, "by-segment")
    writers.write_partitioned(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, "c_mktsegment")
    return readers.read_parquet(spark, path).filter(F.col("c_mktsegment") == "BUILDING")


@query("s13_parquet_read", sql="""
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45""")
def parquet_read(spark, sf_dir):
    return (
        readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
        .filter(F.col("l_quantity") >= 45)
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query("s14_csv_write", sql="""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders""")
def csv_write(spark, sf_dir):
    """The second write replaces the first."""
    path = scratch_path(spark, "orders")
    writers.write_csv(table(spark, sf_dir, "orders").select("o_orderkey"), path)
    writers.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), path)
    return readers.read_csv_strings(spark, path)


@query("s15_reuse_saved_result", sql="""
    SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand""")
def reuse_saved(spark, sf_dir):
    path = scratch_path(spark, "brands")
    for _ in range(2):
        df = writers.reuse_or_compute(
            spark, path, lambda: table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n")))
    return df


@query("s16_sql_over_view", sql="""
    SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""")
def sql_over_view(spark, sf_dir):
    return writers.run_sql(
        table(spark, sf_dir, "customer"),
        "SELECT c_mktsegment, count(*) AS n FROM balances WHERE c_acctbal > 0 GROUP BY c_mktsegment",
        "balances",
    )
