"""Schema drift of raw lines (S1a, P2): what files hold against what is declared.

A declared schema reads any line: fields it does not know vanish, fields it
misses are NULL, values of another type are NULL or text. So the lines are also
parsed to VARIANT, without a schema, and the fields and types of every file
gathered: one pass, one grouped count per file and field. The comparison names
fields that are `unknown`, `absent` from the whole file, or `retyped`, with the
types seen and the number of lines. Embedded structs are compared field by
field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoset.session import scratch_path
from chronoset.sources.json_scan import as_struct

UNKNOWN, ABSENT, RETYPED, BROKEN = "unknown", "absent", "retyped", "broken"
#: VARIANT types that a declared type reads without loss.
READS = {
    "string": {"STRING"}, "boolean": {"BOOLEAN"}, "struct": {"OBJECT"}, "array": {"ARRAY"}, "map": {"OBJECT"},
    "tinyint": {"BIGINT"}, "smallint": {"BIGINT"}, "int": {"BIGINT"}, "bigint": {"BIGINT"},
    "float": {"BIGINT", "DECIMAL", "DOUBLE"}, "double": {"BIGINT", "DECIMAL", "DOUBLE"}, "decimal": {"BIGINT", "DECIMAL"},
    "date": {"STRING"}, "timestamp": {"STRING"}, "timestamp_ntz": {"STRING"},
}


def declared(schema, accept: dict[str, set[str]] | None = None, prefix: str = "") -> dict[str, set[str]]:
    """Every declared field, structs unfolded as `struct.field`, with the VARIANT types it may have.

    `accept` adds types for some fields, e.g. numbers for an amount kept as text.
    """
    out: dict[str, set[str]] = {}
    for f in as_struct(schema).fields:
        path = prefix + f.name
        out[path] = READS[f.dataType.simpleString().split("(")[0].split("<")[0]] | (accept or {}).get(path, set())
        if isinstance(f.dataType, T.StructType):
            out |= declared(f.dataType, accept, path + ".")
    return out


def fields_seen(spark: SparkSession, lines: DataFrame, by: list[str], structs: list[str], line_col: str = "value") -> DataFrame:
    """by, field, kind and number of lines: the fields of the parsed lines, and those of the named structs.

    A NULL value has kind VOID. Lines that are no JSON object count as the
    field "" of kind BROKEN.
    """
    parsed = lines.select(*by, F.try_parse_json(line_col).alias("__v"))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^(\w+)", 1)
    parsed = parsed.withColumn("__k", F.coalesce(F.regexp_extract(F.schema_of_variant("__v"), r"^(\w+)", 1), F.lit("")))
    objects = parsed.where(F.col("__k") == "OBJECT")

    def unfolded(rows: DataFrame, prefix: str) -> DataFrame:
        each = rows.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer()))
        return each.select(*by, F.concat(F.lit(prefix), F.col("key")).alias("field"), kind.alias("kind"))

    seen = unfolded(objects, "")
    for s in structs:
        inner = objects.select(*by, F.try_variant_get("__v", f"$.{s}", "variant").alias("__v"))
        inner = inner.where(F.regexp_extract(F.schema_of_variant("__v"), r"^(\w+)", 1) == "OBJECT")
        seen = seen.unionByName(unfolded(inner, s + "."))
    broken = parsed.where(F.col("__k") != "OBJECT").select(*by, F.lit("").alias("field"), F.lit("BROKEN").alias("kind"))
    return seen.unionByName(broken).groupBy(*by, "field", "kind").agg(F.count(F.lit(1)).alias("n_lines"))


def drift(spark: SparkSession, lines: DataFrame, schema, by: list[str], accept: dict[str, set[str]] | None = None, line_col: str = "value") -> DataFrame:
    """by, field, drift, kinds (comma list) and n_lines, a row for each field of a file that is not as declared."""
    want = declared(schema, accept)
    structs = [f.name for f in as_struct(schema).fields if isinstance(f.dataType, T.StructType)]
    # parsed once: the counts, a row per file, field and kind, are written and read twice
    path = scratch_path(spark, "fields")
    fields_seen(spark, lines, by, structs, line_col).write.parquet(path)
    counted = spark.read.parquet(path)
    # a declaration is a small fixed list
    told = spark.createDataFrame([(f, sorted(k)) for f, k in want.items()], "field string, reads array<string>")
    odd = ~F.array_contains("reads", F.col("kind")) & (F.col("kind") != "VOID")
    what = F.when(F.col("field") == "", BROKEN).when(F.col("reads").isNull(), UNKNOWN).when(odd, RETYPED)
    differ = counted.join(F.broadcast(told), "field", "left").withColumn("drift", what).where("drift is not null")
    differ = differ.groupBy(*by, "field", "drift").agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.sum("n_lines").alias("n_lines"))
    known = F.collect_set(F.when(F.col("field").isin(*want), F.col("field")))
    missing = counted.groupBy(*by).agg(F.array_except(F.lit(sorted(want)), known).alias("__m"))
    # the fields of an absent struct are not told one by one
    lone = F.filter("__m", lambda f: ~F.array_contains(F.col("__m"), F.regexp_extract(f, r"^(.*)\.[^.]*$", 1)))
    absent = missing.select(*by, F.explode(lone).alias("field"))
    return differ.unionByName(absent.select(*by, "field", F.lit(ABSENT).alias("drift"), F.lit("").alias("kinds"), F.lit(0).cast("long").alias("n_lines")))
