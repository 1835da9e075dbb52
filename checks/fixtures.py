"""Clinical fixtures derived row by row from the test tables.

Every resource is made from one table row, so making them needs no shuffle and
each rule can be restated in plain SQL on the base table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "http://fixture.example/"


# Tables whose rows are spread over the cores, and how many rows a task gets at most on average.
SPREAD_TABLES = ("customer", "supplier", "orders", "lineitem", "events", "part")
ROWS_A_TASK = 200_000
# Rows that a task may read from the file by itself: more than the usual row group of 2**20 rows.
MOST_ROWS = 6 * ROWS_A_TASK


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, its rows dealt to tasks by a hash of the row where the file holds them unevenly.

    The splits of a file don't show where its rows are: a row group is read by one task, however
    many splits it lies in, and a file may have one row group only. Where no split has many more
    rows than its share, they stay where they are: dealing them costs their bytes on disk.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in SPREAD_TABLES:
        return df
    tasks = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > 1:
        splits = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("rows"))
        found = splits.agg(F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
        rows, most = found["rows"] or 0, found["most"] or 0
        if most <= min(MOST_ROWS, 2 * rows / tasks):
            return df
        tasks = max(tasks, -(-rows // ROWS_A_TASK))
    placed = df.withColumn("__place", F.xxhash64(*df.columns))
    return placed.repartition(tasks, "__place").drop("__place")


def _resource(df: DataFrame, resource_type: str, id_col: Column, body: Column) -> DataFrame:
    return df.select(
        F.lit(resource_type).alias("resource_type"), id_col.alias("id"), F.to_json(body).alias("json")
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per customer, except every 17th; every 5th without an identifier."""
    k = F.col("c_custkey")
    rid = F.concat(F.lit("p"), k)
    identifier = F.when(
        k % 5 != 0,
        F.array(
            F.struct(
                F.concat(F.lit(BASE + "id/"), F.col("c_nationkey")).alias("system"),
                F.col("c_name").alias("value"),
            )
        ),
    )
    year = F.when(k % 23 == 0, F.lit("unknown")).otherwise(
        F.concat((1930 + k % 70).cast("string"), F.lit("-05-17"))
    )
    body = F.struct(
        F.lit("Patient").alias("resourceType"), rid.alias("id"), identifier.alias("identifier"),
        year.alias("birthDate"),
    )
    return _resource(table(spark, sf_dir, "customer").where(k % 17 != 0), "Patient", rid, body)


def _coding(system: str, code: Column, display: Column | None = None) -> Column:
    return F.struct(
        F.lit(BASE + system).alias("system"),
        code.alias("code"),
        (F.lit(None).cast("string") if display is None else display).alias("display"),
    )


def _text(c: Column | None) -> Column:
    return F.lit(None).cast("string") if c is None else c


def _component(kind: Column, code: str) -> Column:
    """A component whose value type is chosen by ``kind`` (0 to 5)."""
    value = F.col("value")
    return F.struct(
        F.struct(F.array(_coding("part", F.lit(code), F.lit("Part " + code))).alias("coding")).alias(
            "code"
        ),
        F.when(
            kind == 0, F.struct(value.alias("value"), F.lit("mmol").alias("unit"))
        ).alias("valueQuantity"),
        F.when(kind == 1, F.col("k")).alias("valueInteger"),
        F.when(kind == 2, F.concat(F.lit("text "), F.col("event_type"))).alias("valueString"),
        F.when(kind == 3, value > 50).alias("valueBoolean"),
        F.when(kind == 4, F.col("stamp")).alias("valueDateTime"),
        F.when(
            kind == 5,
            F.struct(
                F.array(_coding("grade", F.lit("g"), F.concat(F.lit("grade "), F.col("event_type"))))
                .alias("coding")
            ),
        ).alias("valueCodeableConcept"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per event; ``event_id % 8`` picks the kind of value.

    0 quantity with unit, 1 quantity, 2 integer, 3 text, 4 coded with the display
    in the second coding, 5 two components, 6 root and component, 7 no value.
    """
    e = F.col("event_id")
    src = (
        table(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .withColumn("stamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    kind = e % 8
    sub = F.floor(e / 8) % 6
    rid = F.concat(F.lit("o"), e)
    subject = F.when(e % 101 == 0, F.lit("Group/g")).otherwise(
        F.when(e % 3 == 0, F.concat(F.lit(BASE + "fhir/Patient/p"), F.col("user_id")))
        .when(e % 3 == 1, F.concat(F.lit("Patient/p"), F.col("user_id"), F.lit("/_history/2")))
        .otherwise(F.concat(F.lit("Patient/p"), F.col("user_id")))
    )
    date = (
        F.when(e % 11 == 0, F.lit(None).cast("string"))
        .when(e % 13 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(e % 29 == 0, F.date_format("ts", "yyyy-MM"))
        .otherwise(F.col("stamp"))
    )
    plain = F.array(_coding("event", F.col("event_type"), F.concat(F.lit("Event "), "event_type")))
    mixed = F.array(
        _coding("event", F.col("event_type")),
        _coding("alt", F.concat(F.lit("alt-"), "event_type"), F.concat(F.lit("Alt "), "event_type")),
    )
    coded = F.struct(
        F.array(
            _coding("flag", F.lit("f1")),
            _coding("flag2", F.lit("f2"), F.concat(F.lit("flag "), F.col("event_type"))),
        ).alias("coding")
    )
    body = F.struct(
        F.lit("Observation").alias("resourceType"),
        rid.alias("id"),
        F.when(e % 103 != 0, F.struct(subject.alias("reference"))).alias("subject"),
        date.alias("effectiveDateTime"),
        F.struct(F.when(e % 7 == 0, mixed).otherwise(plain).alias("coding")).alias("code"),
        F.when(
            kind.isin(0, 1, 6),
            F.struct(F.col("value").alias("value"), F.when(kind != 1, F.lit("mg")).alias("unit")),
        ).alias("valueQuantity"),
        F.when(kind == 2, F.col("k")).alias("valueInteger"),
        F.when(kind == 3, F.concat(F.lit("note "), F.col("event_type"))).alias("valueString"),
        F.when(kind == 4, coded).alias("valueCodeableConcept"),
        F.when(kind == 5, F.array(_component(sub, "a"), _component((sub + 3) % 6, "b")))
        .when(kind == 6, F.array(_component(sub, "c")))
        .alias("component"),
    )
    return _resource(src, "Observation", rid, body)


def _null_answers(**given: Column) -> Column:
    """An array with one answer that has the given value fields."""
    return F.array(F.struct(*[v.alias(k) for k, v in given.items()]))


def order_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order: status, priority, grouped total, one varying answer."""
    k = F.col("o_orderkey")
    rid = F.concat(F.lit("qo"), k)
    date = (
        F.when(k % 19 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    ref = (
        F.when(k % 31 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.lit(BASE + "fhir/Questionnaire/q1"))
        .when(k % 3 == 1, F.lit("Questionnaire/q2"))
        .otherwise(F.lit("Questionnaire/q3|2.0"))
    )
    kind = k % 6
    text = F.col("o_orderpriority")
    status = F.struct(
        F.lit("status").alias("linkId"),
        F.lit(None).cast("string").alias("text"),
        _null_answers(valueCoding=_coding("status", F.col("o_orderstatus"))).alias("answer"),
    )
    priority = F.struct(
        F.lit("priority").alias("linkId"),
        F.lit("Priority").alias("text"),
        _null_answers(valueCoding=_coding("priority", F.substring(text, 1, 1), text)).alias(
            "answer"
        ),
    )
    pricing = F.struct(
        F.lit("pricing").alias("linkId"),
        F.lit("Pricing").alias("text"),
        F.array(
            F.struct(
                F.when(k % 37 != 0, F.lit("total")).alias("linkId"),
                F.lit("Total price").alias("text"),
                _null_answers(valueDecimal=F.col("o_totalprice")).alias("answer"),
            )
        ).alias("item"),
    )
    misc = F.struct(
        F.lit("misc").alias("linkId"),
        F.when(k % 41 != 0, F.lit("Misc")).alias("text"),
        F.array(
            F.struct(
                F.when(kind == 0, text).alias("valueString"),
                F.when(kind == 1, k % 1000).alias("valueInteger"),
                F.when(kind == 2, k % 2 == 0).alias("valueBoolean"),
                F.when(kind == 3, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("valueDate"),
                F.when(kind == 4, F.lit("08:30:00")).alias("valueTime"),
                F.when(kind == 5, F.concat(F.lit("urn:x:"), k)).alias("valueUri"),
            ),
            F.struct(
                F.lit("second answers are not read").alias("valueString"),
                F.lit(None).cast("bigint").alias("valueInteger"),
                F.lit(None).cast("boolean").alias("valueBoolean"),
                F.lit(None).cast("string").alias("valueDate"),
                F.lit(None).cast("string").alias("valueTime"),
                F.lit(None).cast("string").alias("valueUri"),
            ),
        ).alias("answer"),
    )
    body = F.concat(
        F.lit('{"resourceType":"QuestionnaireResponse","id":"'), rid, F.lit('"'),
        F.coalesce(F.concat(F.lit(',"authored":"'), date, F.lit('"')), F.lit("")),
        F.coalesce(F.concat(F.lit(',"questionnaire":"'), ref, F.lit('"')), F.lit("")),
        F.lit(',"subject":{"reference":"Patient/p'), F.col("o_custkey"), F.lit('"},"item":['),
        F.concat_ws(",", *[F.to_json(i) for i in (status, priority, pricing, misc)]),
        F.lit("]}"),
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("QuestionnaireResponse").alias("resource_type"), rid.alias("id"), body.alias("json")
    )


def line_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order line, nested four levels deep through items and answers."""
    p, line = F.col("l_partkey"), F.col("l_linenumber")
    rid = F.concat(F.lit("ql"), F.col("l_orderkey"), F.lit("-"), line)
    code = (
        F.when(F.col("l_quantity") < 15, F.lit("S"))
        .when(F.col("l_quantity") < 30, F.lit("M"))
        .when(F.col("l_quantity") < 45, F.lit("L"))
        .otherwise(F.lit("X"))
    )
    number = F.struct(
        F.lit("line").alias("linkId"), F.lit("Line number").alias("text"),
        _null_answers(valueInteger=line).alias("answer"),
    )
    price = F.struct(
        F.concat(F.lit("price"), p).alias("linkId"),
        F.lit("Price paid").alias("text"),
        F.array(
            F.struct(
                F.struct(
                    F.col("l_extendedprice").alias("value"),
                    F.when(line % 2 == 0, F.lit("EUR")).alias("unit"),
                ).alias("valueQuantity"),
                F.array(number).alias("item"),
            )
        ).alias("answer"),
    )
    brand = F.struct(
        F.concat(F.lit("brand"), p).alias("linkId"),
        F.lit("Brand (response)").alias("text"),
        F.array(
            F.struct(F.col("l_returnflag").alias("valueString"), F.array(price).alias("item"))
        ).alias("answer"),
    )
    size = F.struct(
        F.concat(F.lit("size"), p).alias("linkId"),
        _null_answers(valueCoding=_coding("size", code)).alias("answer"),
    )
    body = F.concat(
        F.lit('{"resourceType":"QuestionnaireResponse","id":"'), rid,
        F.lit('","authored":"'), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('","questionnaire":"Questionnaire/q'), p,
        F.lit('","subject":{"reference":"Patient/p'), F.col("l_suppkey"),
        F.lit('"},"item":[{"linkId":"sec'), p, F.lit('","item":['),
        F.to_json(size), F.lit(","), F.to_json(brand), F.lit("]}]}"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.lit("QuestionnaireResponse").alias("resource_type"), rid.alias("id"), body.alias("json")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_responses(spark, sf_dir).unionByName(line_responses(spark, sf_dir))


def _option(code: str, display: Column | None) -> Column:
    return F.struct(
        F.struct(
            F.lit(BASE + "option").alias("system"), F.lit(code).alias("code"),
            _text(display).alias("display"),
        ).alias("valueCoding")
    )


def questionnaires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per part (``q<key>``) and one per supplier (``u<key>``, never referenced).

    All parts' definitions share the link id ``line``, each with another text.

    ``q1`` and ``q2`` share the link id ``status`` with different texts and option
    displays; the suppliers' definitions use it too, but nothing refers to them.
    """
    p = F.col("p_partkey")
    size = F.struct(
        F.concat(F.lit("size"), p).alias("linkId"),
        F.concat(F.lit("Size of "), F.col("p_name")).alias("text"),
        F.array(
            _option("S", F.lit("Small")), _option("M", None),
            _option("L", F.concat(F.lit("Large "), F.col("p_brand"))),
        ).alias("answerOption"),
    )
    price = F.struct(
        F.concat(F.lit("price"), p).alias("linkId"), F.when(p % 4 != 0, F.lit("Price")).alias("text")
    )
    brand = F.struct(
        F.concat(F.lit("brand"), p).alias("linkId"), F.lit("Brand").alias("text"),
        F.lit(BASE + "ValueSet/brand").alias("answerValueSet"), F.array(price).alias("item"),
    )
    first = F.when(p == 1, F.lit("Order status")).otherwise(F.lit("Status of the order"))
    open_text = F.when(p == 1, F.lit("Open")).otherwise(F.lit("Still open"))
    status = F.struct(
        F.lit("status").alias("linkId"), first.alias("text"),
        F.array(_option("O", open_text), _option("F", F.lit("Filled"))).alias("answerOption"),
    )
    body = F.concat(
        F.lit('{"resourceType":"Questionnaire","id":"q'), p, F.lit('","item":[{"linkId":"sec'), p,
        F.lit('","text":"'), F.col("p_name"), F.lit('","item":['), F.to_json(size), F.lit(","),
        F.to_json(brand), F.lit("]}"),
        F.when(p.isin(1, 2), F.concat(F.lit(","), F.to_json(status))).otherwise(F.lit("")),
        F.lit(',{"linkId":"line","text":"Line of '), F.col("p_name"), F.lit('"}'),
        F.lit("]}"),
    )
    used = table(spark, sf_dir, "part").select(
        F.lit("Questionnaire").alias("resource_type"), F.concat(F.lit("q"), p).alias("id"),
        body.alias("json"),
    )
    s = F.col("s_suppkey")
    rid = F.concat(F.lit("u"), s)
    unused_body = F.struct(
        F.lit("Questionnaire").alias("resourceType"), rid.alias("id"),
        F.array(
            F.struct(F.lit("status").alias("linkId"), F.col("s_name").alias("text"))
        ).alias("item"),
    )
    return used.unionByName(
        _resource(table(spark, sf_dir, "supplier"), "Questionnaire", rid, unused_body)
    )


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        patients(spark, sf_dir)
        .unionByName(observations(spark, sf_dir))
        .unionByName(responses(spark, sf_dir))
        .unionByName(questionnaires(spark, sf_dir))
    )
