import itertools
import json

import pytest
from pyspark.sql import types as T

from tidemark.config import LOG_BASED, Settings
from tidemark.functions.types import from_json_schema, json_schema, nullable, spark_type
from tidemark.plans.catalog import Catalog, Catalogs, StreamSpec, of_frame, schema_names
from tidemark.sources.connection import Connection
from tidemark.sources.tables import JdbcTables

ANY = ["string", "number", "integer", "array", "object", "boolean"]


SCALARS = {
    "integer": ["smallint", "int4", "BIGINT", "serial"],
    "number": ["real", "double  precision", "numeric", "decimal(12, 3)"],
    "string": ["uuid", "inet", "character varying(20)", "interval", "time(6)", "tsvector"],
    "boolean": ["bool", "Boolean"],
}
TIMES = {"date": ["date"], "date-time": ["timestamp(3)", "timestamptz", "timestamp with time zone"]}


def expected(name, as_object, as_text):
    for kind, names in SCALARS.items():
        if name in names:
            return {"type": kind}
    for kind, names in TIMES.items():
        if name in names:
            return {"type": ["string", "null"]} if as_text else {"type": "string", "format": kind}
    some = ["object", "null"] if as_object or name == "hstore" else ANY
    return {"type": some, "additionalProperties": True}


@pytest.mark.parametrize("as_object, as_text, dimensions", itertools.product([True, False], [True, False], [0, 1, 2]))
def test_types(as_object, as_text, dimensions):
    for name in [*itertools.chain(*SCALARS.values(), *TIMES.values()), "jsonb", "json", "hstore"]:
        want = expected(name, as_object, as_text)
        for _ in range(dimensions):
            want = {"type": "array", "items": want}
        assert json_schema(spark_type(name + "[]" * dimensions), json_as_object=as_object, dates_as_string=as_text) == want, name


def test_types_of_our_own_catalog_come_back():
    kinds = {"a": T.TimestampType(), "b": T.TimestampNTZType(), "c": T.DecimalType(20, 5), "d": T.ArrayType(T.IntegerType()), "e": T.FloatType(), "f": T.MapType(T.StringType(), T.StringType())}
    s = StreamSpec("public", "t", {c: json_schema(k) for c, k in kinds.items()}, types=kinds)
    again = Catalog.of_dict(json.loads(json.dumps(Catalog([s]).to_dict()))).streams[0]
    assert {c: again.type_of(c) for c in kinds} == kinds
    assert from_json_schema({"type": "string", "format": "date-time"}) == T.StringType() and from_json_schema({"type": ["number", "null"]}) == T.VariantType()


def test_numeric_and_dates():
    assert spark_type("numeric(10,2)") == T.DecimalType(10, 2) and spark_type("numeric") == T.DecimalType(38, 18)
    assert spark_type("numeric(60,2)", T.StringType()) == T.StringType()
    assert json_schema(T.DateType(), dates_as_string=True) == {"type": ["string", "null"]}
    assert from_json_schema({"type": ["array", "null"], "items": {"type": "integer"}}) == T.ArrayType(T.LongType())
    assert from_json_schema({"type": ANY}) == T.VariantType() and from_json_schema({"type": "string", "format": "date"}) == T.DateType()


def test_plain_type_is_promoted_once():
    assert nullable({"type": "string"})["type"] == ["string", "null"] == nullable(nullable({"type": "string"}))["type"]


def spec():
    return StreamSpec("public", "t", {"id": {"type": "integer"}, "name": {"type": ["string", "null"]}, "at": {"type": "string", "format": "date-time"}}, ("id",), ("id",))


def test_round_trip_and_selection():
    s = spec()
    assert Catalog.of_dict(Catalog([s]).to_dict()).streams[0].to_entry() == s.to_entry()
    entry = s.to_entry()
    for m in entry["metadata"]:
        if m["breadcrumb"] in (["properties", "name"], ["properties", "id"]):
            m["metadata"]["selected"] = False
    assert StreamSpec.of_entry(entry).columns == ["id", "at"]
    assert "name" not in StreamSpec.of_entry(entry).to_json_schema()["properties"]
    entry["metadata"][-1]["metadata"]["selected"] = False
    assert Catalog.of_dict({"streams": [entry]}).selected == []
    with pytest.raises(ValueError):
        StreamSpec.of_entry(entry | {"replication_method": "NONE"})


def test_log_based():
    s = spec().as_log_based()
    assert s.required == () and s.method == LOG_BASED and s.real_columns == ["id", "name", "at"]
    assert all(p["type"].count("null") == 1 for p in s.properties.values())
    assert s.properties["_sdc_lsn"]["type"] == ["integer", "null"] and s.properties["_sdc_deleted_at"]["type"] == ["string", "null"]


def test_given_catalog_wins():
    calls = []
    given = Catalog([spec()]).to_dict()
    assert Catalogs(lambda: calls.append(1), given).get().streams[0].name == "public-t" and not calls
    c = Catalogs(lambda: calls.append(1) or Catalog([spec()]))
    assert c.get() is c.get() and calls == [1]


def test_schema_names():
    s = Settings.of({"url": "postgresql://u:p@h/d"})
    assert schema_names(["a", "b"], s) == ["a", "b"]
    assert schema_names(["a"], Settings.of({"url": "postgresql://u:p@h/d", "filter_schemas": ["x"]})) == ["x"]


def test_of_frame(spark):
    df = spark.createDataFrame([(1, "a")], "id int not null, name string")
    s = of_frame("public", "t", df, None, ["id"])
    assert s.required == ("id",) and s.properties == {"id": {"type": "integer"}, "name": {"type": ["string", "null"]}}


def test_database_query_keeps_predicates_apart(spark):
    tables = JdbcTables(spark, Connection("h", 1, "d", "u", "p"))
    assert tables.query(spec(), ["a = 1 OR b = 2", "c"]) == 'SELECT "id", "name", "at" FROM "public"."t" WHERE (a = 1 OR b = 2) AND (c)'
