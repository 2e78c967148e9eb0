"""Readers on small files and on the texts they build."""

import pytest

from tessera.config import Entity
from tessera.operators import standardize
from tessera.sources import readers, streams
from tests.conftest import rows


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_csv_json_xml(spark, tmp_path):
    csv = readers.csv(spark, write(tmp_path, "a.csv", "id,name\n1,x\n2,\n"))
    assert rows(csv) == [(1, "x"), (2, None)]
    js = readers.json(spark, write(tmp_path, "a.json", '{"id":1,"n":"x"}\n{"id":2}\n'))
    assert rows(js) == [(1, "x"), (2, None)]
    xml = readers.xml(spark, write(tmp_path, "a.xml", "<r><row><id>1</id></row><row><id>2</id></row></r>"))
    assert rows(xml) == [(1,), (2,)]


def test_whole_text_files(spark, tmp_path):
    write(tmp_path, "a.txt", "one\ntwo\n")
    write(tmp_path, "b.pdf", "x")
    found = {r["document_type"]: r for r in readers.text_documents(spark, str(tmp_path)).collect()}
    assert found["TEXT"]["extracted_text"] == "one\ntwo\n" and found["TEXT"]["path"].endswith("a.txt")
    assert set(found) == {"TEXT", "PDF"}


def test_api_envelopes(spark):
    pages = spark.createDataFrame(
        [
            ('[{"id":1},{"id":2}]',),
            ('{"data":[{"id":3}],"hasMore":true}',),
            ('{"results":[{"id":4}]}',),
            (' {"items":[{"id":5},{"id":6}]} ',),
            ('{"id":7}',),
            ('{"data":[]}',),
        ],
        "value string",
    )
    assert [r["id"] for r in readers.api_records(pages, "struct<id:int>").orderBy("id").collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_cdc_position(spark):
    changes = spark.sql("SELECT unhex(lpad(hex(id), 20, '0')) AS `__$start_lsn`, id FROM range(300)")
    assert readers.cdc_changes(changes, "ff").count() == 44
    assert readers.cdc_changes(changes, "").count() == 300
    with pytest.raises(ValueError):
        readers.cdc_changes(changes, "xyz")


def test_jdbc_query_text():
    assert readers.jdbc_query("t") == "SELECT * FROM t"
    assert readers.jdbc_query("t", "a = 1") == "SELECT * FROM t WHERE (a = 1)"
    assert readers.jdbc_query("t", None, "at", "2024-01-01") == "SELECT * FROM t WHERE at > '2024-01-01'"
    assert readers.jdbc_query("t", "a = 1 OR b", "id", "7", "int") == "SELECT * FROM t WHERE (a = 1 OR b) AND id > 7"
    assert readers.jdbc_query("t", None, "n", "o'x", "text") == "SELECT * FROM t WHERE n > 'o''x'"


@pytest.mark.parametrize(
    "name, declared, expected",
    [("adls-logs", "", "FILE"), ("api-sales", "", "API"), ("mongodb-x", "", "COSMOS"), ("plain", "", "SQL"), ("azsql-a", "file", "FILE")],
)
def test_source_type(name, declared, expected):
    assert readers.source_type(Entity(1, "e", name, declared)) == expected


def test_entity_of_api_pages(spark, tmp_path):
    write(tmp_path, "p1.json", '{"data":[{"id":1,"at":"2024-01-01"},\n {"id":2,"at":"2024-02-01"}]}')
    entity = Entity(
        1, "sales", "api-sales", location=str(tmp_path), load_type="INCREMENTAL", watermark_column="at",
        watermark_type="text", last_watermark="2023-12-15", options={"schema": "struct<id:int,at:string>"},
    )
    assert rows(readers.read_entity(spark, entity)) == [(1, "2024-01-01"), (2, "2024-02-01")]


def test_eventhub_options():
    options = streams.eventhub_options("ns.example.net", "iot", "group")
    assert options["kafka.bootstrap.servers"] == "ns.example.net:9093" and options["subscribe"] == "iot"


def test_unparsable_values_become_null(spark):
    df = spark.createDataFrame([("2024-02-30", "x"), ("2024-02-28", "2024-01-01 10:00:00")], "d string, t string")
    found = standardize.apply(df, {"d": "date", "t": "timestamp"})
    assert [r["d"] is None for r in found.collect()] == [True, False]
    assert [r["t"] is None for r in found.collect()] == [True, False]
    assert rows(standardize.safe_cast(spark.createDataFrame([("1",), ("a",)], "v string"), "v", "int")) == [(1,), (None,)]


def test_text_after_delimiter(spark):
    df = spark.createDataFrame([("a@b@c",), ("none",), (None,)], "m string")
    assert [r["d"] for r in standardize.after_delimiter(df, "m", "@", "d").collect()] == ["b@c", "", None]


def test_json_schema_is_inferred_over_all_rows(spark):
    data = [('{"a":1,"b":{"c":"x"}}',), ('{"a":2.5,"d":[1,2]}',), ("broken",), (None,)]
    df = spark.createDataFrame(data, "j string")
    found = standardize.json_flatten(df, "j")
    assert found.columns == ["j", "a", "b", "d"]
    assert [r["a"] for r in found.collect()] == [1.0, 2.5, None, None]
    assert [r["d"] for r in found.collect()][1] == [1, 2]
    given = standardize.json_flatten(df, "j", "a double")
    assert given.columns == ["j", "a"]


def test_date_parts_go_by_type(spark):
    df = spark.sql("SELECT DATE'2024-05-06' AS OrderDate, 'text' AS UpdateDate, TIMESTAMP'2024-01-01' AS _loaded")
    found = standardize.date_parts(df)
    assert found.columns == [*df.columns, "OrderDateYear", "OrderDateMonth", "OrderDateDay", "OrderDateQuarter"]
    assert tuple(found.first())[3:] == (2024, 5, 6, 2)


def test_generated_queries_carry_position_and_filter():
    assert readers.cdc_query("cdc.orders_CT", "1f") == f"SELECT * FROM cdc.orders_CT WHERE __$start_lsn > 0x{'1f'.rjust(20, '0')}"
    assert readers.cdc_query("t", None, "a = 1") == "SELECT * FROM t WHERE (a = 1)"
    assert readers.document_query(None) == "SELECT * FROM c"
    assert readers.document_query("17", "c.kind = 'x;--y'") == "SELECT * FROM c WHERE (c.kind = 'x;--y') AND c._ts > 17"
    options = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4", "user": "u"}
    assert readers.partition_of(options) == ("id", "0", "9", 4) and options == {"user": "u"}
    assert readers.partition_of({"partitionColumn": "id"}) is None


@pytest.mark.parametrize("call", [
    lambda: readers.jdbc_query("t; DROP TABLE x"),
    lambda: readers.jdbc_query("t", "1 = 1; DELETE FROM t"),
    lambda: readers.jdbc_query("t", "a = 'x"),
    lambda: readers.jdbc_query("t", None, "at OR 1=1", "5", "int"),
    lambda: readers.cdc_query("t", "0; x"),
    lambda: readers.document_query("1 OR 1"),
])
def test_unchecked_text_is_refused(call):
    with pytest.raises(ValueError):
        call()


def test_calculated_columns_are_arithmetic(spark):
    from tessera.operators import standardize

    df = spark.sql("SELECT 2 AS a, 3 AS b")
    assert standardize.calculated_columns(df, {"c": "(a + b) * 2 - 1"}).first()["c"] == 9
    for text in ("upper(a)", "a; b", "(SELECT 1)", "a || 'x'"):
        with pytest.raises(ValueError):
            standardize.calculated_columns(df, {"c": text})
