"""The structure of landed JSON documents as it is, and where it departs from the declared one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stored
from barloom.settings import Settings
from barloom.sources.landing import RUN_SUMMARY_SCHEMA, file_path, scan

#: Names of the variant kinds that stand for the types a schema can declare.
KINDS = {T.StringType: "STRING", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN"}
NO_KIND = "VOID"  # a JSON null, which fits any type
NO_JSON = "not JSON"


def landed_documents(spark: SparkSession, glob: str) -> DataFrame:
    """(source_file, document): every file that matches as one variant, read once and stored; null for text that is no
    JSON."""
    texts = scan(spark, glob, "text", wholetext=True)
    return stored(texts.select(file_path().alias("source_file"), F.try_parse_json("value").alias("document")))


def inferred_schema(documents: DataFrame) -> DataFrame:
    """(inferred): one row with the schema that all documents fit, merged by partial aggregation."""
    return documents.agg(F.schema_of_variant_agg("document").alias("inferred"))


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def document_paths(documents: DataFrame) -> DataFrame:
    """(source_file, path, kind) of everything in the documents, kinds of one path (elements of an array) joined by ``|``.

    Objects and arrays are opened level by level; each level is stored, so none is computed twice, and there are as many
    rounds as the deepest document has levels. A path joins names by dots, ``[]`` stands for the elements of an array."""
    spark = documents.sparkSession
    level = documents.where("document IS NOT NULL").select("source_file", F.lit("").alias("path"), F.col("document").alias("value"))
    levels = []
    while True:
        level = stored(level.withColumn("kind", _kind(F.col("value"))))
        levels.append(level.select("source_file", "path", "kind"))
        inner = level.where("kind IN ('OBJECT', 'ARRAY')")
        if inner.isEmpty():
            break
        level = spark.sql(
            "SELECT source_file, CASE WHEN key IS NULL THEN path || '[]' WHEN path = '' THEN key ELSE path || '.' || key END AS path, e.value "
            "FROM {inner} t, LATERAL variant_explode(t.value) e",
            inner=inner,
        )
    found = reduce(DataFrame.unionByName, levels).where("path <> ''").groupBy("source_file", "path")
    return found.agg(F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kind"))


def declared_paths(schema: T.StructType, above: str = "") -> list[tuple[str, str]]:
    """(path, kind) of a declared schema, names of objects included."""
    out = []
    for field in schema:
        path, kind = above + field.name, field.dataType
        if isinstance(kind, T.StructType):
            out += [(path, "OBJECT"), *declared_paths(kind, path + ".")]
        else:
            out.append((path, KINDS[type(kind)]))
    return out


def document_drift(documents: DataFrame, schema: str = RUN_SUMMARY_SCHEMA) -> DataFrame:
    """(source_file, path, change, declared, found): what a document has that ``schema`` does not declare (added), lacks
    (missing) or has as another type (retyped); a document that is no JSON has one row with an empty path.

    Names inside an added object are added, those inside a missing or retyped one are missing. A null fits any type and
    an object or array of nulls counts as itself. Every document carries the declared paths with it, so nothing is
    joined; paths meet in one grouped pass."""
    declared = declared_paths(T.DataType.fromDDL(schema))
    wanted = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.lit(k).alias("declared")) for p, k in declared]))
    none = F.lit(None).cast("string")
    owed = documents.where("document IS NOT NULL").select("source_file", wanted.alias("w")).select("source_file", "w.*", none.alias("found"))
    there = document_paths(documents).select("source_file", "path", none.alias("declared"), F.col("kind").alias("found"))
    both = owed.unionByName(there).groupBy("source_file", "path").agg(F.max("declared").alias("declared"), F.max("found").alias("found"))
    change = (
        F.when(F.col("declared").isNull(), "added")
        .when(F.col("found").isNull(), "missing")
        .when(~F.col("found").isin(NO_KIND) & (F.col("found") != F.col("declared")), "retyped")
    )
    changed = both.withColumn("change", change).where("change IS NOT NULL").select("source_file", "path", "change", "declared", "found")
    broken = documents.where("document IS NULL").select(
        "source_file", F.lit("").alias("path"), F.lit(NO_JSON).alias("change"), none.alias("declared"), none.alias("found")
    )
    return changed.unionByName(broken)


def summary_drift(spark: SparkSession, settings: Settings) -> DataFrame:
    """The drift of all landed run summaries."""
    return document_drift(landed_documents(spark, settings.landed(settings.summary_glob)))
