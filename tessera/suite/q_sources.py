"""Sources. Files are first written from the given tables, then read back by the operator."""

from pyspark.sql import functions as F

from tessera.config import Entity
from tessera.layout import bronze, read_table, silver
from tessera.operators import sinks
from tessera.session import scratch
from tessera.sources import readers, streams
from tessera.streaming import events, tables
from tessera.suite import inputs
from tessera.suite.inputs import sql, table
from tessera.suite.registry import ORACLES, query

RECORD_SEPARATOR = "\u0001"


@query("src_csv", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", "true").csv(path)
    return readers.csv(spark, path)


@query("src_json", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def src_json(spark, sf_dir):
    path = scratch(spark, "json")
    events_table = table(spark, sf_dir, "events")
    events_table.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return readers.json(spark, path, events_table.schema)


@query(
    "src_parquet",
    "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'",
)
def src_parquet(spark, sf_dir):
    rows = readers.parquet(spark, f"{sf_dir}/lineitem.parquet")
    recent = rows.where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return recent.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query("src_xml", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def src_xml(spark, sf_dir):
    path = scratch(spark, "xml")
    table(spark, sf_dir, "part").write.format("xml").option("rowTag", "row").save(path)
    return readers.xml(spark, path)


@query(
    "src_text_documents",
    "SELECT text AS value, text AS extracted_text, 'TEXT' AS document_type FROM documents",
)
def src_text_documents(spark, sf_dir):
    path = scratch(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", RECORD_SEPARATOR).text(path)
    return readers.text_documents(spark, path, RECORD_SEPARATOR).drop("path")


@query("src_table_read", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def src_table_read(spark, sf_dir):
    layout = bronze(scratch(spark, "lake"), "orders")
    sinks.overwrite(table(spark, sf_dir, "orders"), layout)
    return readers.table(spark, layout)


@query(
    "src_jdbc",
    "SELECT * FROM orders WHERE (o_orderstatus = 'F') AND o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
)
def src_jdbc(spark, sf_dir):
    """The sub-select the reader sends to a database, run on the table itself."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("tessera_src_orders")
    text = readers.jdbc_query(
        "tessera_src_orders", "o_orderstatus = 'F'", "o_orderdate", "1998-01-01 00:00:00", "datetime"
    )
    return spark.sql(text)


@query(
    "src_cdc_changes",
    """SELECT upper(lpad(to_hex(o_orderkey), 20, '0')) AS lsn, o_custkey, o_totalprice
       FROM orders WHERE o_orderkey > 255""",
)
def src_cdc_changes(spark, sf_dir):
    changes = table(spark, sf_dir, "orders").withColumn(
        "__$start_lsn", F.unhex(F.lpad(F.hex("o_orderkey"), 20, "0"))
    )
    found = readers.cdc_changes(changes, "FF")
    return found.select(F.hex("`__$start_lsn`").alias("lsn"), "o_custkey", "o_totalprice")


@query(
    "src_document_store",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS _ts, props FROM events WHERE floor(epoch(ts)) > 1705276800",
)
def src_document_store(spark, sf_dir):
    """The changed-since filter on document-shaped rows; the connector itself is an option set."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("_ts"), "props"
    )
    return readers.since_epoch(rows, 1705276800)


@query("src_api_pages", "SELECT event_id, event_type, value FROM events")
def src_api_pages(spark, sf_dir):
    """Pages of up to 100 records in the four envelope forms, one page per line of the landed files."""
    page = F.floor(F.col("event_id") / 100)
    records = table(spark, sf_dir, "events").select(
        page.alias("page"), F.to_json(F.struct("event_id", "event_type", "value")).alias("record")
    )
    pages = records.groupBy("page").agg(F.array_join(F.collect_list("record"), ",").alias("list"))
    body = F.concat(F.lit("["), "list", F.lit("]"))
    kind = F.col("page") % 4
    envelope = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit('{"data":'), body, F.lit(',"hasMore":true}')))
        .when(kind == 2, F.concat(F.lit('{"results":'), body, F.lit("}")))
        .otherwise(F.concat(F.lit('{"items":'), body, F.lit("}")))
    )
    path = scratch(spark, "pages")
    pages.select(envelope.alias("value")).write.text(path)
    return readers.api_records(spark.read.text(path), "struct<event_id:bigint,event_type:string,value:double>")


@query(
    "src_dispatch",
    """SELECT 'adls-csv' AS source, count(*) AS n, sum(n_regionkey)::BIGINT AS total FROM nation
       UNION ALL SELECT 'adls-json', count(*), sum(s_nationkey)::BIGINT FROM supplier
       UNION ALL SELECT 'file-parquet', count(*), sum(o_custkey)::BIGINT FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01'""",
)
def src_dispatch(spark, sf_dir):
    csv, js = scratch(spark, "csv"), scratch(spark, "json")
    table(spark, sf_dir, "nation").write.option("header", "true").csv(csv)
    table(spark, sf_dir, "supplier").write.json(js)
    entities = {
        "n_regionkey": Entity(1, "nation.csv", "adls-csv", location=csv),
        "s_nationkey": Entity(2, "supplier.json", "adls-json", location=js),
        "o_custkey": Entity(
            3,
            "orders.parquet",
            "file-parquet",
            "FILE",
            f"{sf_dir}/orders.parquet",
            load_type="INCREMENTAL",
            watermark_column="o_orderdate",
            last_watermark="1997-06-01",
        ),
    }
    parts = [
        readers.read_entity(spark, e)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("total"))
        .select(F.lit(e.source_name).alias("source"), "n", "total")
        for c, e in entities.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def transaction_json(df):
    """Transactions as the JSON text a producer sends."""
    return df.select(
        F.to_json(
            F.struct(
                F.col("TransactionId").alias("transactionId"),
                F.col("Timestamp").alias("timestamp"),
                F.col("UserId").alias("userId"),
                F.col("Amount").alias("amount"),
                F.col("Currency").alias("currency"),
                F.col("MerchantId").alias("merchantId"),
                F.col("Status").alias("status"),
            ),
            {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
        ).alias("value")
    )


_TXN = """SELECT TransactionId, Timestamp, UserId, CAST(Amount AS DOUBLE) AS Amount, Currency, MerchantId,
                 Status FROM txn_raw"""


@query("src_json_mapping", sql(_TXN, "txn_raw"))
def src_json_mapping(spark, sf_dir):
    values = transaction_json(inputs.transactions(spark, sf_dir))
    return events.map_json(values, events.MAPPINGS["Transactions"])


@query("src_stream_kafka", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_stream_kafka(spark, sf_dir):
    """Topic records (binary JSON values) from a stream of the orders file through the record parser."""
    orders = inputs.stream(spark, sf_dir, "orders")
    messages = orders.select(F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice")).cast("binary").alias("value"))
    parsed = streams.records(messages, "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    return landed(spark, parsed, "kafka_orders")


@query("src_stream_eventhub", "SELECT CAST(user_id AS VARCHAR) AS DeviceId, value AS Temperature FROM events")
def src_stream_eventhub(spark, sf_dir):
    """Hub records use the same parser as topics."""
    rows = inputs.readings(spark, sf_dir, inputs.stream(spark, sf_dir, "events"))
    messages = rows.select(F.to_json(F.struct("DeviceId", "Temperature")).cast("binary").alias("value"))
    return landed(spark, streams.records(messages, "DeviceId string, Temperature double"), "hub_readings")


def landed(spark, stream, name):
    """A stream run to its end into a table, and the table."""
    layout = bronze(scratch(spark, "lake"), name)
    tables.append_table(stream, layout, scratch(spark, "checkpoint")).awaitTermination()
    return read_table(spark, layout)


@query(
    "src_stream_cdc",
    """WITH c AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_orderstatus = 'P' AS gone FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
            s AS (SELECT *, CASE WHEN gone THEN '-' ELSE o_orderpriority END AS state FROM c),
            k AS (SELECT *, lag(state) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before FROM s
                  QUALIFY before IS NULL OR before <> state),
            v AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS next FROM k)
       SELECT o_custkey, o_orderpriority, o_orderdate, o_orderdate AS ValidFrom,
              strftime(coalesce(next, TIMESTAMP '9999-12-31 23:59:59'), '%Y-%m-%d %H:%M:%S') AS ValidUntil, next IS NULL AS IsCurrent
       FROM v WHERE NOT gone""",
)
def src_stream_cdc(spark, sf_dir):
    """Orders as changes of their customer, in several files without order, one file per micro-batch."""
    path = scratch(spark, "changes")
    columns = ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    orders.repartition(5, "o_orderkey").write.parquet(path)
    changes = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)
    layout = bronze(scratch(spark, "lake"), "customer_changes")
    tables.change_table(changes, layout, scratch(spark, "checkpoint")).awaitTermination()
    history = tables.read_history(
        spark, layout, ["o_custkey"], ["o_orderpriority"], "o_orderdate",
        [F.col("o_orderkey").desc()], F.col("o_orderstatus") == "P",
    )
    return history.select(
        "o_custkey", "o_orderpriority", "o_orderdate", "ValidFrom",
        F.date_format("ValidTo", "yyyy-MM-dd HH:mm:ss").alias("ValidUntil"), "IsCurrent",
    )


@query("src_stream_cdc_keyed", ORACLES["src_stream_cdc"])
def src_stream_cdc_keyed(spark, sf_dir):
    """The same changes and history, kept by bucket of the key: each batch rewrites the histories of its keys only."""
    path, base = scratch(spark, "changes"), scratch(spark, "lake")
    columns = ["o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    orders.repartition(3, "o_orderkey").write.parquet(path)
    changes = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(path)
    history = silver(base, "customer_history")
    tables.change_history(
        changes, bronze(base, "customer_changes"), history, scratch(spark, "checkpoint"), ["o_custkey"], ["o_orderpriority"],
        "o_orderdate", [F.col("o_orderkey").desc()], F.col("o_orderstatus") == "P",
    ).awaitTermination()
    return read_table(spark, history).select(
        "o_custkey", "o_orderpriority", "o_orderdate", "ValidFrom",
        F.date_format("ValidTo", "yyyy-MM-dd HH:mm:ss").alias("ValidUntil"), "IsCurrent",
    )


@query(
    "src_query_lookup",
    """SELECT '{"c_nationkey":' || c_nationkey || ',"n":' || count(*) || '}' AS json
       FROM customer GROUP BY c_nationkey""",
)
def src_query_lookup(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("tessera_lookup_customer")
    return readers.query_lookup(
        spark, "SELECT c_nationkey, count(*) AS n FROM tessera_lookup_customer GROUP BY c_nationkey"
    )
