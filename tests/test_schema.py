import pytest
from pyspark.sql import types as T

from tidemark.errors import ContractError, SchemaChangeError
from tidemark.operators import schema
from tidemark.operators.merge import merge
from tidemark.operators.quality import enforce_contract


def ddl(text):
    return T.StructType.fromDDL(text)


def test_diff():
    diff = schema.schema_diff(ddl("id long, b string, c string"), ddl("ID long, a string, b int"))
    assert diff.source_not_in_target == ["c"] and diff.target_not_in_source == ["a"]
    assert list(diff.new_types) == ["b"]
    assert not schema.schema_diff(ddl("id long"), ddl("ID long"))


def test_modes():
    source, target = ddl("id long, b string, c string"), ddl("id long, a string, b int")
    assert schema.evolved_schema(target, source, "ignore") == target
    assert schema.evolved_schema(target, source, "append_new_columns").simpleString() == (
        "struct<id:bigint,a:string,b:int,c:string>"
    )
    assert schema.evolved_schema(target, source, "sync_all_columns").simpleString() == (
        "struct<id:bigint,b:string,c:string>"
    )
    with pytest.raises(SchemaChangeError, match=r"\['c'\].*\['a'\].*'b': 'string'"):
        schema.evolved_schema(target, source, "fail")
    assert schema.evolved_schema(target, target, "fail") == target
    with pytest.raises(SchemaChangeError):
        schema.evolved_schema(target, source, "other")


def test_three_levels_grow_in_source_order(spark, rows):
    target = spark.sql(
        "SELECT 1 AS id, named_struct('l1', 'a', 'two', named_struct('l2', 'b', 'three', named_struct('l3', 'c'))) AS p"
    )
    source = spark.sql(
        "SELECT 2 AS id, named_struct('l1', 'd', 'two', named_struct('l2', 'e', 'three', "
        "named_struct('l3', 'f', 'n3', 'g'), 'n2', 'h'), 'n1', 'i') AS p"
    )
    grown = schema.evolve(target, source.schema, "append_new_columns")
    assert grown.schema["p"].dataType.simpleString() == (
        "struct<l1:string,two:struct<l2:string,three:struct<l3:string,n3:string>,n2:string>,n1:string>"
    )
    flat = schema.flatten(merge(grown, source, "id"))
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [
        (1, "a", "b", "c", None, None, None), (2, "d", "e", "f", "g", "h", "i")
    ]


def test_nested_removal_is_refused():
    target, source = ddl("s struct<a: int, b: int>"), ddl("s struct<a: int>")
    for mode in ("append_new_columns", "sync_all_columns"):
        with pytest.raises(SchemaChangeError, match="cannot be removed"):
            schema.evolved_schema(target, source, mode)


def test_null_structs_and_arrays_of_structs(spark):
    df = spark.sql(
        "SELECT 1 AS id, array(named_struct('a', 1), NULL) AS l, CAST(NULL AS STRUCT<a: INT>) AS s "
    )
    grown = schema.conform(df, ddl("id int, l array<struct<b: string, a: int>>, s struct<a: int, b: string>"))
    row = grown.first()
    assert [None if x is None else tuple(x) for x in row["l"]] == [(None, 1), None]
    assert row["s"] is None


def test_flatten_and_nest_are_inverse(spark, rows):
    df = spark.sql("SELECT 1 AS id, named_struct('x', 1, 'y', named_struct('z', 'q')) AS s, array(1) AS l")
    flat = schema.flatten(df)
    assert flat.columns == ["id", "s.x", "s.y.z", "l"]
    assert schema.nest(flat).schema.simpleString() == df.schema.simpleString()
    zipped = spark.sql("SELECT array(1, 2) AS `a.x`, array('p', 'q') AS `a.y`")
    nested = schema.nest(zipped, arrays=["a"])
    assert [tuple(e) for e in nested.first()["a"]] == [(1, "p"), (2, "q")]
    with pytest.raises(SchemaChangeError):
        schema.nest(spark.sql("SELECT 1 AS a, 2 AS `a.b`"))


def test_declared_columns(spark):
    kinds = schema.nested_types(
        {"id": "bigint", "b": "array", "b.first": "string", "b.last": "string", "c.user.id": "bigint", "c.user.ok": "boolean"}
    )
    empty = schema.empty_like(spark, {"id": "bigint", "b": "array", "b.first": "string", "c.user.id": "bigint"})
    assert kinds["b"] == "array<struct<`first`: string, `last`: string>>"
    assert kinds["c"] == "struct<`user`: struct<`id`: bigint, `ok`: boolean>>"
    assert empty.count() == 0
    assert empty.schema.simpleString() == "struct<id:bigint,b:array<struct<first:string>>,c:struct<user:struct<id:bigint>>>"
    with pytest.raises(SchemaChangeError):
        schema.nested_types({"id": None})


def test_drop_columns(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s")
    assert schema.drop_columns(df, ["s"]).columns == ["id"]
    with pytest.raises(SchemaChangeError):
        schema.drop_columns(df, ["s.a"])


def test_contract(spark, rows):
    df = spark.sql("SELECT named_struct('y', 'q', 'x', 1) AS s, 5L AS id")
    made = enforce_contract(df, "id bigint, s struct<x: int, y: string>")
    assert made.schema.simpleString() == "struct<id:bigint,s:struct<x:int,y:string>>"
    for broken in ("id int, s struct<x: int, y: string>", "id bigint", "id bigint, s struct<x: int, y: string>, z int", "id bigint, s struct<x: int>"):
        with pytest.raises(ContractError):
            enforce_contract(df, broken)
    with pytest.raises(ContractError):
        enforce_contract(df, made.schema, primary_key=["nope"])
    with pytest.raises(ContractError):
        enforce_contract(df, made.schema, unsupported=["check"])


def test_contract_not_null(spark):
    df = spark.sql("SELECT 1L AS id, named_struct('x', CAST(NULL AS INT)) AS s UNION ALL SELECT 2L, NULL")
    assert enforce_contract(df.where("id = 2"), df.schema, not_null=["s.x"]).count() == 1
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="s.x is NULL"):
            getattr(enforce_contract(df, df.schema, not_null=["id", "s.x"]), action)()
