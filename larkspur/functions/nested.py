"""JSON, structs, arrays and maps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import cut_lineage

# Fixed layout: the 21 fields of a click message, in message order.
CLICK_SCHEMA = T.StructType(
    [T.StructField("_id", T.StringType()), T.StructField("time_stamp", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in [
            "ip", "user_agent", "resolution", "user_id_db", "device_id", "api_version", "store_id", "local_time", "show_recommendation",
            "current_url", "referrer_url", "email_address", "recommendation", "utm_source", "utm_medium", "collection", "product_id",
        ]
    ]
    + [
        T.StructField("option", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("id", T.StringType()),
    ]
)


def parse_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Typed columns from a JSON text column; unreadable text gives a row of NULLs.

    The parsed struct goes through a one-element array, which the optimizer does not look
    behind. Otherwise a later filter on a parsed or derived column would be pushed below
    the parser and parse the text once more for every mention of a column.
    """
    data = F.from_json(F.col(column).cast("string"), schema)
    return df.select(F.explode(F.array(data)).alias("data")).select("data.*")


def list_of(text: Column, element: str) -> Column:
    """An array from a field that arrives as '', an object or an array; NULL stays NULL."""
    array = f"array<{element}>"
    start = F.substring(F.ltrim(text), 1, 1)
    return (
        F.when(text == "", F.array().cast(array))
        .when(start == "[", F.from_json(text, array))
        .when(start == "{", F.array(F.from_json(text, element)))
    )


def blank_to_null(df: DataFrame) -> DataFrame:
    """'' to NULL in every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


def key_value_rows(df: DataFrame, keys: list[str], column: str, name: str = "key_value") -> DataFrame:
    """A map of lists as rows 'key_value'."""
    return (
        df.select(*keys, F.explode(column).alias("_k", "_vs"))
        .select(*keys, "_k", F.explode("_vs").alias("_v"))
        .select(*keys, F.concat_ws("_", "_k", "_v").alias(name))
    )


def python_type(value: str) -> Column:
    """Python-style type name of a variant column."""
    kind = F.expr(f"schema_of_variant({value})")
    names = {"STRING": "str", "BIGINT": "int", "BOOLEAN": "bool"}
    whole = kind.rlike(r"^DECIMAL\(\d+,\s*0\)$")
    out = F.when(kind.isNull() | (kind == "VOID"), "NoneType")
    out = out.when(kind.startswith("OBJECT"), "dict").when(kind.startswith("ARRAY"), "list")
    for spark_name, name in names.items():
        out = out.when(kind == spark_name, name)
    out = out.when(whole, "int")
    return out.otherwise("float")


_CHILDREN = """flatten(transform({level}, n -> case
    when schema_of_variant(n.v) like 'OBJECT%' then transform(
        map_entries(cast(n.v as map<string, variant>)),
        e -> named_struct('path', if(n.path = '', e.key, concat(n.path, '.', e.key)), 'named', true, 'v', e.value))
    when schema_of_variant(n.v) like 'ARRAY%' then transform(
        cast(n.v as array<variant>), x -> named_struct('path', n.path, 'named', false, 'v', x))
    else array() end))"""


def type_profile(df: DataFrame, json: str, label: str, levels: int = 6) -> DataFrame:
    """How often each type occurs at each path of a JSON text column, per label value.

    Every document is unfolded inside its own row, so the table is read once and only (label, path, type) counts are
    shuffled. Elements of a list carry the path of the list. A document that is no JSON counts as type ``unreadable``
    at the empty path. Documents may be nested to any depth: what lies below so many ``levels`` is written and unfolded
    in a further round, until nothing is left. A table of shallow documents takes one round.
    """
    spark = df.sparkSession
    todo = df.select(F.col(label).alias("label"), F.lit("").alias("path"), F.col(json).alias("text"))
    counted = None
    while True:
        nodes = todo.select("label", "path", F.try_parse_json("text").alias("v"), F.col("text").isNotNull().alias("given")).selectExpr(
            "label", "given and v is null as unreadable", "array(named_struct('path', path, 'named', false, 'v', v)) as l0"
        )
        for depth in range(levels):
            nodes = nodes.selectExpr("*", _CHILDREN.format(level=f"l{depth}") + f" as l{depth + 1}")
        # the last level is counted here, and goes on if it has children
        inner = ", ".join(f"l{depth + 1}" for depth in range(levels))
        nothing = "array(named_struct('path', '', 'named', true, 'v', cast(null as variant)))"
        deeper = F.expr(f"filter(l{levels}, n -> schema_of_variant(n.v) like 'OBJECT<_%' or schema_of_variant(n.v) like 'ARRAY<_%')")
        # one more row for each document, without a path, has the number of nodes that go on
        last = "array(named_struct('path', cast(null as string), 'named', true, 'v', cast(null as variant)))"
        watched = nodes.withColumn("deeper", F.size(deeper))
        found = watched.selectExpr("label", "unreadable", "deeper", f"explode(concat(if(unreadable, {nothing}, concat({inner})), {last})) as n").where("n.named")
        kind = F.when(F.col("unreadable"), "unreadable").otherwise(python_type("v"))
        typed = found.select("label", "unreadable", "deeper", F.col("n.path").alias("path"), F.col("n.v").alias("v"))
        counts = typed.groupBy("label", "path", kind.alias("type")).agg(F.count("*").alias("n"), F.sum("deeper").alias("deeper"))
        counts = cut_lineage(spark, counts, "profile")
        real = counts.where("path is not null").drop("deeper")
        counted = real if counted is None else counted.unionByName(real)
        if not counts.where("path is null").agg(F.sum("deeper")).first()[0]:
            break
        rest = nodes.select("label", F.explode(deeper).alias("n")).select("label", F.col("n.path").alias("path"), F.to_json("n.v").alias("text"))
        todo = cut_lineage(spark, rest, "deeper")
    return counted.groupBy("label", "path", "type").agg(F.sum("n").alias("n"))


def path_types(profile: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The sorted type names of each path, as text; there are at most seven per path."""
    return profile.groupBy(*by, "path").agg(F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))


SIMPLE_TYPES = {
    "str": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "ObjectId": T.StringType(),
}


def schema_from_paths(types: dict[str, set[str]]) -> T.StructType:
    """An all-nullable schema for profiled documents.

    Lists become arrays (of structs where element paths are known), objects become maps
    of text, whole and decimal numbers together become double; other mixtures, and paths
    that are always null, become text.
    """

    below: dict[str, list[str]] = {}
    for path in types:
        if path:
            below.setdefault(path.rpartition(".")[0], []).append(path)

    def children(parent: str) -> list[str]:
        return below.get(parent, [])

    def data_type(path: str) -> T.DataType:
        kinds = set(types[path]) - {"NoneType"}
        if kinds == {"list"}:
            inner = children(path)
            return T.ArrayType(record(path) if inner else T.StringType())
        if kinds == {"dict"}:
            return T.MapType(T.StringType(), T.StringType())
        if kinds == {"int", "float"}:
            return T.DoubleType()
        if len(kinds) == 1:
            return SIMPLE_TYPES[kinds.pop()]
        return T.StringType()

    def record(parent: str) -> T.StructType:
        fields = [T.StructField(p.rsplit(".", 1)[-1], data_type(p)) for p in sorted(children(parent))]
        return T.StructType(fields)

    return record("")


def target_schema(profile: DataFrame) -> T.StructType:
    """Schema for the documents behind a type profile. Only the paths reach the driver, as many as the schema has fields."""
    rows = path_types(profile.where("type != 'unreadable'")).collect()
    return schema_from_paths({r["path"]: set(r["types"].split(",")) for r in rows})
