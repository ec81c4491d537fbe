"""Response bodies to typed columns, JVM-side (``from_json``)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The token record's fields, all strings.
TOKEN_SCHEMA = T.StructType([
    T.StructField("access_token", T.StringType()),
    T.StructField("token_type", T.StringType()),
    T.StructField("expires_in", T.StringType()),
    T.StructField("refresh_token", T.StringType()),
])

BODY_TYPES = ("json",)


def infer_json_schema(df: DataFrame, body_col: str = "body_text", **options) -> T.StructType:
    """Schema of all JSON bodies in a column, inferred by one distributed pass in the JVM; nothing is copied.

    ``samplingRatio`` limits the pass if wanted.
    """
    spark = df.sparkSession
    bodies = df.select(F.col(body_col).cast("string").alias("value")).where("value IS NOT NULL")
    jvm = spark._jvm
    texts = getattr(bodies._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read()
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return T.StructType.fromJson(json.loads(reader.json(texts).schema().json()))


def json_body(body: Column | str, schema, **options) -> Column:
    """``from_json`` (JVM-side); ``options`` are Spark's JSON options."""
    col = F.col(body) if isinstance(body, str) else body
    return F.from_json(col, schema, {k: str(v) for k, v in options.items()})


def parse_body(df: DataFrame, body_col: str = "body_text", object_type: str = "json",
               schema=None, alias: str = "parsed", **options) -> DataFrame:
    """Add a typed ``alias`` column parsed from a response body.

    ``object_type`` ``json`` parses (schema declared, or inferred over all
    bodies when omitted); any other type yields a null column, as bodies of
    other types are meant to be staged as files and scanned.
    """
    kind = str(object_type).lower()
    if kind not in BODY_TYPES:
        return df.withColumn(alias, F.lit(None).cast("string"))
    if schema is None:
        schema = infer_json_schema(df, body_col)
    return df.withColumn(alias, json_body(body_col, schema, **options))


def parse_token(body: Column | str) -> Column:
    """Token record ``(access_token, token_type, expires_in, refresh_token)``.

    Non-string JSON values (``"expires_in": 3600``) come back as their text.
    """
    return json_body(body, TOKEN_SCHEMA)


_BROKEN = "_broken_xml_"


def parse_unlike(df: DataFrame, body_col: str = "body_text", xml_schema=None, alias: str = "parsed", **options) -> DataFrame:
    """Add ``alias``, a VARIANT of each body whatever its layout, and ``<alias>_kind``.

    The kind is ``json`` (one whole value), ``xml`` (a body that begins with ``<``; a record of
    ``xml_schema``, declared, with Spark's XML options), ``empty`` (null or
    blank) or ``malformed``.  No row is lost and no body stops the job: empty and
    malformed ones, and xml without a schema, have a null VARIANT and keep their
    text.  Fields are taken with ``try_variant_get(parsed, path, type)``.
    """
    body = F.col(f"`{body_col}`").cast("string")
    json_value, like_xml = F.try_parse_json(body), F.ltrim(body).startswith("<")
    # the parser stops behind the first value: a body that goes on fits in neither an array nor an object
    json_is_whole = (json_value.isNotNull() & F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).isNotNull()
                     & F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}"))).isNotNull())
    xml_value, xml_is_whole = F.lit(None).cast("variant"), F.lit(xml_schema is None)
    if xml_schema is not None:
        fields = T.StructType.fromDDL(xml_schema) if isinstance(xml_schema, str) else xml_schema
        with_broken = T.StructType([*fields.fields, T.StructField(_BROKEN, T.StringType())])
        # a body of another kind never reaches the xml parser
        record = F.from_xml(F.when(like_xml, body), with_broken,
                            {**{k: str(v) for k, v in options.items()}, "columnNameOfCorruptRecord": _BROKEN})
        xml_is_whole = record[_BROKEN].isNull()
        xml_value = F.to_variant_object(F.struct(*[record[f.name].alias(f.name) for f in fields]))
    kind = (F.when(body.isNull() | (F.trim(body) == ""), "empty").when(like_xml & xml_is_whole, "xml")
            .when(json_is_whole, "json").otherwise("malformed"))
    return (df.withColumn(f"{alias}_kind", kind)
            .withColumn(alias, F.when(F.col(f"{alias}_kind") == "json", json_value)
                        .when(F.col(f"{alias}_kind") == "xml", xml_value)))


def unlike_schema(df: DataFrame, alias: str = "parsed") -> str:
    """The one schema (DDL) that holds every VARIANT of a column; one aggregate, merged map-side.

    Fields that differ in type are VARIANT there; ``void`` if there is no value.
    """
    return df.select(F.schema_of_variant_agg(alias).alias("s")).first().s or "VOID"
