"""Clinical resources derived from the retail tables.

The supplied tables hold no FHIR files, so customers become patients, orders
become encounters and claims, order lines become conditions and events become
observations. Every field is a fixed function of its own row: nothing is
grouped or collected, and defects of each kind occur at known keys so that the
same rows can be predicted in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.schemas import LOINC_NAMES, RESOURCE_TYPES

ICD_CODES = (
    "E11.9", "I10", "E78.5", "I50.9", "I48.91", "N18.3", "M06.9", "M81.0", "F32.1",
    "K21.0", "I69.30", "J44.9", "J45.909", "I25.10", "E10.9", "I12.9", "J06.9",
    "S52.5", "R51", "Z00.0",
)

RETAIL_INGESTED_AT = "2024-02-01T00:00:00+00:00"

#: Rows of a table that one task turns into resources: some 250 MB of JSON.
TASK_ROWS = 250_000

#: Names of landed files, which are compressed.
LANDED = "*.txt*"

_ISO = "yyyy-MM-dd\\'T\\'HH:mm:ss"


def _sql_array(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _coding(code: str, system: str = "'urn:codes'", display: str = "null") -> str:
    return (
        f"array(named_struct('system', {system}, 'code', {code}, "
        f"'display', cast({display} as string)))"
    )


def _concept(code: str, system: str = "'urn:codes'", display: str = "null",
             text: str = "null") -> str:
    return (
        f"named_struct('coding', {_coding(code, system, display)}, "
        f"'text', cast({text} as string))"
    )


def _json(*fields: str) -> str:
    return "to_json(named_struct(" + ", ".join(fields) + "))"


def _with_field(body: str, name: str, value_json: str) -> str:
    """Put a field with ready-made JSON text in front of an object's fields."""
    return (
        f"if({value_json} is null, {body}, "
        f"concat('{{\"{name}\":', {value_json}, ',', substr({body}, 2)))"
    )


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """Spread a table over tasks of at most ``TASK_ROWS`` rows, and over all cores, before the JSON work.

    A file split holds far more JSON than Parquet, and what sorts or groups texts in a task grows
    with it. The count reads file footers only; the shuffle moves the narrow input columns. A
    table with splits enough is left alone.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def _emit(rows: DataFrame, resource_type: str, id_sql: str, source: str,
          bundle: str, stamp: str) -> DataFrame:
    return rows.select(
        F.lit(resource_type).alias("resource_type"),
        F.col("resource"),
        F.lit(f"landing/{source}.json").alias("source_file"),
        F.expr(bundle).alias("bundle_id"),
        F.expr(f"concat('urn:uuid:', {id_sql})").alias("full_url"),
        F.expr(stamp).alias("ingestion_timestamp"),
    )


def _stamp(column: str) -> str:
    return f"concat(date_format({column}, '{_ISO}'), '+00:00')"


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _read(spark, sf_dir, "nation").join(
        _read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = (
        # The hint keeps Spark from broadcasting the customers, if their file is the smaller guess,
        # and from shuffling them by their few nations: both leave the JSON work to a task or few.
        _spread(_read(spark, sf_dir, "customer"))
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("k"), "c_name", "n_name", "r_name")
    )
    phone = "named_struct('system', 'phone', 'value', concat('555-', k), 'use', 'home')"
    email = (
        "named_struct('system', if(k % 55 = 2, 'pigeon', 'email'), "
        "'value', concat('p', k, '@example.org'), 'use', if(k % 65 = 3, 'office', 'work'))"
    )
    work = (
        "named_struct('use', 'work', 'line', array('1 Office Park'), 'city', 'Worktown', "
        "'state', 'WK', 'postalCode', '00001', 'country', 'US')"
    )
    home = (
        "named_struct('use', 'home', 'line', if(k % 5 = 0, "
        "array(concat(k, ' Main St'), concat('Apt ', k % 9)), array(concat(k, ' Main St'))), "
        "'city', n_name, 'state', r_name, 'postalCode', lpad(k % 90000, 5, '0'), "
        "'country', 'US')"
    )
    body = _json(
        "'resourceType', 'Patient'",
        "'id', if(k % 120 = 119, null, concat('patient-', k))",
        "'meta', if(k % 3 = 0, null, named_struct('versionId', cast(1 + k % 2 as string), "
        "'lastUpdated', '2024-01-15T10:00:00Z'))",
        "'identifier', if(k % 33 = 0, null, array("
        "named_struct('use', 'secondary', 'system', 'http://hl7.org/fhir/sid/us-ssn', "
        "'value', concat('SSN-', k)), "
        "named_struct('use', if(k % 45 = 1, 'bogus', 'official'), "
        "'system', if(k % 10 = 9, 'urn:other', 'http://hospital.example.org/MRN'), "
        "'value', concat('MRN-', k))))",
        "'active', case when k % 7 <> 0 then true when k % 2 = 0 then false end",
        f"'telecom', if(k % 6 = 0, array({phone}), array({email}, {phone}))",
        "'gender', case when k % 40 = 7 then null when k % 25 = 0 then 'M' "
        "when k % 11 = 5 then 'other' when k % 2 = 0 then 'male' else 'female' end",
        "'birthDate', if(k % 60 = 11, "
        "concat(13 + k % 15, '/', lpad(1 + k % 12, 2, '0'), '/', 1930 + k % 80), "
        "concat(1930 + k % 80, '-', lpad(1 + k % 12, 2, '0'), '-', lpad(1 + k % 28, 2, '0')))",
        f"'address', case when k % 17 = 0 then null when k % 9 = 4 then array({work}) "
        f"else array({work}, {home}) end",
        "'maritalStatus', if(k % 8 = 0, null, " + _concept("if(k % 2 = 0, 'M', 'S')") + ")",
        "'communication', if(k % 12 = 0, null, array("
        f"named_struct('language', {_concept(chr(39) + 'xx' + chr(39))}, 'preferred', false), "
        f"named_struct('language', {_concept('if(k % 4 = 1, ' + repr('es') + ', ' + repr('en-US') + ')')}, "
        "'preferred', true)))",
    )
    name = (
        "case when k % 70 = 13 then null when k % 70 = 14 then '\"Anonymous\"' else to_json(array("
        "named_struct('use', 'nickname', 'family', 'Nick', 'given', array('N')), "
        "named_struct('use', 'official', 'family', c_name, 'given', if(k % 4 = 0, "
        "array(concat('Given', k % 100)), "
        "array(concat('Given', k % 100), concat('Mid', k % 10)))))) end"
    )
    rows = (
        rows.withColumn("body", F.expr(body))
        .withColumn("name", F.expr(name))
        .withColumn("body", F.expr(_with_field("body", "name", "name")))
        .withColumn("note", F.expr("if(k % 90 = 1, '{\"by\":\"intake\"}', null)"))
        .withColumn("resource", F.expr(_with_field("body", "_note", "note")))
    )
    return _emit(rows, "Patient", "concat('patient-', k)", "customer",
                 "concat('bundle-patient-', k)", f"'{RETAIL_INGESTED_AT}'")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(
        _read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("customer"),
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        )
    )


_ENCOUNTER_JSON = _json(
    "'resourceType', 'Encounter'",
    "'id', concat('encounter-', k)",
    "'status', case when k % 101 = 0 then 'bogus' when k % 103 = 0 then null "
    "when o_orderstatus = 'F' then 'finished' when o_orderstatus = 'O' then 'planned' "
    "else 'in-progress' end",
    "'class', if(k % 79 = 0, null, named_struct('code', case when k % 83 = 0 then 'HH' "
    "when o_orderpriority = '1-URGENT' then 'EMER' when o_orderpriority = '2-HIGH' "
    "then 'IMP' else 'AMB' end))",
    "'type', array(" + _concept(
        "'185349003'", "'http://snomed.info/sct'", "'Encounter for check up'",
        "if(k % 4 = 0, 'Check-up visit', null)") + ")",
    "'subject', if(k % 109 = 0, null, named_struct('reference', "
    "if(k % 107 = 0, concat('Group/group-', customer), "
    "concat('Patient/patient-', customer))))",
    "'period', if(k % 89 = 0, null, named_struct("
    f"'start', concat(date_format(started, '{_ISO}'), start_zone), "
    f"'end', concat(date_format(ended, '{_ISO}'), end_zone)))",
    "'reasonCode', if(k % 3 = 0, array(" + _concept(
        "'73211009'", "'http://snomed.info/sct'", "'Diabetes mellitus'") + "), null)",
    "'hospitalization', if(o_orderpriority = '2-HIGH', named_struct("
    "'admitSource', " + _concept("'emd'") + ", 'dischargeDisposition', "
    + _concept("'home'") + "), null)",
    "'serviceProvider', if(k % 13 = 0, null, "
    "named_struct('reference', concat('Organization/', k % 20), "
    "'display', concat('Hospital ', k % 20)))",
)


def _with_times(orders: DataFrame) -> DataFrame:
    return (
        orders.withColumn(
            "started", F.expr("o_orderdate + make_dt_interval(0, cast(k % 24 as int))")
        )
        .withColumn(
            "ended",
            F.expr(
                "if(k % 97 = 0, started - make_dt_interval(0, 5), "
                "started + make_dt_interval(0, 0, cast(((k * 13) % 480) * 15 as int)))"
            ),
        )
        .withColumn("start_zone", F.expr("if(k % 5 = 1, '+02:00', 'Z')"))
        .withColumn(
            "end_zone",
            F.expr(
                "case when k % 50 = 3 then '' when k % 5 = 1 then '+02:00' "
                "when k % 5 = 2 then '+01:00' else 'Z' end"
            ),
        )
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_times(_orders(spark, sf_dir)).withColumn("resource", F.expr(_ENCOUNTER_JSON))
    return _emit(rows, "Encounter", "concat('encounter-', k)", "orders",
                 "concat('bundle-visit-', k)", _stamp("o_orderdate"))


_CLAIM_JSON = _json(
    "'resourceType', 'Claim'",
    "'id', concat('claim-', k)",
    "'status', case when k % 127 = 0 then 'submitted' when k % 4 = 1 then 'cancelled' "
    "else 'active' end",
    "'type', if(k % 131 = 0, null, " + _concept(
        "if(k % 3 = 0, 'institutional', 'professional')", "'urn:claim-type'",
        "if(k % 3 = 0, 'Institutional', null)", "if(k % 6 = 1, 'Office', null)") + ")",
    "'use', if(k % 149 = 0, 'bogus-use', 'claim')",
    "'patient', named_struct('reference', concat('Patient/patient-', customer))",
    "'billablePeriod', if(k % 157 = 0, null, named_struct("
    "'start', date_format(o_orderdate, 'yyyy-MM-dd'), "
    "'end', date_format(o_orderdate + make_dt_interval("
    "if(k % 151 = 0, -2, cast(k % 5 as int))), 'yyyy-MM-dd')))",
    "'created', date_format(o_orderdate + make_dt_interval(1), 'yyyy-MM-dd')",
    "'item', if(k % 4 = 0, null, transform(sequence(1L, greatest(k % 4, 1L)), i -> named_struct("
    "'sequence', i, 'productOrService', named_struct('coding', array(named_struct("
    "'code', concat('99', 200 + (k + i) % 20)))), "
    "'net', named_struct('value', cast(k % 9973 + i * 25 as double) / 4, "
    "'currency', 'USD'))))",
    "'total', if(k % 163 = 0, null, named_struct('value', "
    "if(k % 211 = 0, -o_totalprice, o_totalprice), "
    "'currency', case when k % 113 = 0 then 'US' when k % 17 = 0 then null else 'USD' end))",
)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).withColumn("resource", F.expr(_CLAIM_JSON))
    return _emit(rows, "Claim", "concat('claim-', k)", "orders",
                 "concat('bundle-visit-', k)", _stamp("o_orderdate"))


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        _spread(
            _read(spark, sf_dir, "lineitem").select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                "l_shipdate",
            )
        )
        .withColumn("k", F.expr("concat(l_orderkey, '-', l_linenumber)"))
        .withColumn(
            "status",
            F.expr(
                "case when l_partkey % 131 = 0 then 'weird' when l_returnflag = 'R' then 'active' "
                "when l_returnflag = 'A' then 'resolved' when l_suppkey % 3 = 0 then 'active' "
                "when l_suppkey % 3 = 1 then 'recurrence' else 'remission' end"
            ),
        )
    )
    icd = f"element_at({_sql_array(ICD_CODES)}, cast((l_suppkey + l_linenumber) % 20 as int) + 1)"
    body = _json(
        "'resourceType', 'Condition'",
        "'id', concat('condition-', k)",
        "'meta', if(l_suppkey % 4 = 0, named_struct('versionId', "
        "cast(1 + l_linenumber % 2 as string), 'lastUpdated', "
        f"concat(date_format(l_shipdate, '{_ISO}'), 'Z')), null)",
        "'clinicalStatus', if(l_partkey % 137 = 0, null, " + _concept("status") + ")",
        "'verificationStatus', " + _concept("'confirmed'"),
        "'category', if(l_linenumber % 2 = 0, array(" + _concept("'problem-list-item'")
        + "), null)",
        "'code', if(l_partkey % 139 = 0, null, " + _concept(
            icd, "'http://hl7.org/fhir/sid/icd-10-cm'", f"concat('Dx ', {icd})",
            f"if(l_linenumber % 3 = 0, null, concat('Diagnosis ', {icd}))") + ")",
        "'subject', named_struct('reference', concat('Patient/patient-', l_partkey))",
        "'onsetDateTime', if(l_linenumber % 2 = 1, "
        f"concat(date_format(l_shipdate, '{_ISO}'), 'Z'), date_format(l_shipdate, 'yyyy-MM-dd'))",
        "'abatementDateTime', case when l_orderkey % 61 = 0 then "
        "date_format(l_shipdate - make_dt_interval(3), 'yyyy-MM-dd') "
        "when status = 'resolved' then "
        "date_format(l_shipdate + make_dt_interval(14), 'yyyy-MM-dd') end",
        "'recordedDate', date_format(l_shipdate + make_dt_interval(1), 'yyyy-MM-dd')",
    )
    rows = rows.withColumn("resource", F.expr(body))
    # Copies of a diagnosis arrive at distinct moments unless they are identical.
    arrival = (
        f"concat(date_format(l_shipdate + make_dt_interval(0, 0, 0, l_partkey % 86400), '{_ISO}'), "
        "'.', lpad((l_suppkey % 10000) * 100 + ascii(l_returnflag), 6, '0'), '+00:00')"
    )
    return _emit(rows, "Condition", "concat('condition-', k)", "lineitem",
                 "concat('bundle-condition-', k)", arrival)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spread(
        _read(spark, sf_dir, "events").select(
            F.col("event_id").alias("k"), "ts", "user_id", "event_type", "value"
        )
    )
    loinc = f"element_at({_sql_array(LOINC_NAMES)}, cast(k % 15 as int) + 1)"
    body = _json(
        "'resourceType', 'Observation'",
        "'id', concat('obs-', k)",
        "'status', case when k % 77 = 0 then 'DONE' when k % 78 = 0 then '' "
        "when k % 119 = 0 then null else 'final' end",
        "'category', array(" + _concept(
            "case when event_type in ('view', 'click') then 'vital-signs' "
            "when event_type in ('purchase', 'error') then 'laboratory' else 'survey' end") + ")",
        "'code', " + _concept(loinc, "'http://loinc.org'", f"concat('Lab ', {loinc})",
                              "if(k % 2 = 0, concat('Test ', k % 15), null)"),
        "'subject', named_struct('reference', if(k % 50 = 0, "
        "concat('Patient/patient-ghost-', k % 7), concat('Patient/patient-', user_id)))",
        "'encounter', case when k % 3 = 0 then null when k % 10 = 1 then "
        "named_struct('reference', 'unlinked') else "
        "named_struct('reference', concat('Encounter/encounter-', k)) end",
        "'effectiveDateTime', case when k % 400 = 9 then 'not-a-date' when k % 400 = 10 then "
        "date_format(ts, 'yyyy/MM/dd HH:mm') else "
        f"concat(date_format(ts, '{_ISO}'), 'Z') end",
        "'interpretation', if(value > 250, array(" + _concept("'H'") + "), null)",
        "'referenceRange', if(k % 2 = 0, array(named_struct('text', 'Normal: < 250')), null)",
    )
    quantity = (
        "case when k % 201 = 0 then null "
        "when k % 200 = 3 then '{\"value\":\"high\",\"unit\":\"mg/dL\"}' "
        "when k % 203 = 0 then '{\"value\":true,\"unit\":\"mg/dL\"}' "
        "else to_json(named_struct('value', value, 'unit', 'mg/dL', 'code', 'mg/dL')) end"
    )
    rows = (
        rows.withColumn("body", F.expr(body))
        .withColumn("quantity", F.expr(quantity))
        .withColumn("resource", F.expr(_with_field("body", "valueQuantity", "quantity")))
    )
    return _emit(rows, "Observation", "concat('obs-', k)", "events",
                 "concat('bundle-observation-', k)", _stamp("ts"))


_BUILDERS = {
    "Patient": patients,
    "Encounter": encounters,
    "Condition": conditions,
    "Observation": observations,
    "Claim": claims,
}


def resources(
    spark: SparkSession, sf_dir: str, types: tuple[str, ...] = RESOURCE_TYPES
) -> DataFrame:
    """Resources of the given types, as bundle reading would deliver them."""
    parts = [_BUILDERS[t](spark, sf_dir) for t in types]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def bundle_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundle documents, one per source row, as they would land.

    An order gives a visit bundle of encounter and claim; some visits also hold
    an entry without resource or of a type that is not supported. One customer
    in fifty brings a broken document, another one in fifty a bare resource.
    """

    def wrap(bundle_id: str, *entries: str) -> str:
        listed = f"concat_ws(',', {', '.join(entries)})"
        return (
            f"concat('{{\"resourceType\":\"Bundle\",\"id\":\"', {bundle_id}, "
            f"'\",\"type\":\"collection\",\"entry\":[', {listed}, ']}}')"
        )

    entry = "concat('{\"fullUrl\":\"', full_url, '\",\"resource\":', resource, '}')"
    singles = resources(
        spark, sf_dir, ("Patient", "Condition", "Observation")
    ).select(
        "resource_type",
        F.expr(wrap("bundle_id", entry)).alias("good"),
        "resource",
        F.try_to_number(
            F.regexp_extract("bundle_id", r"^bundle-patient-(\d+)$", 1), F.lit("9" * 18)
        ).cast("long").alias("k"),
    )
    singles = singles.select(
        F.when(F.col("k") % 50 == 1, F.expr("substr(good, 1, length(good) - 20)"))
        .when(F.col("k") % 50 == 2, F.col("resource"))
        .otherwise(F.col("good"))
        .alias("value"),
        F.expr("pmod(hash(good), 16)").alias("batch"),
    )
    visits = _with_times(_orders(spark, sf_dir)).select(
        "k",
        F.expr(_ENCOUNTER_JSON).alias("encounter"),
        F.expr(_CLAIM_JSON).alias("claim"),
    )
    visit_entries = (
        "concat('{\"fullUrl\":\"urn:uuid:encounter-', k, '\",\"resource\":', encounter, '}')",
        "if(k % 97 = 5, '{\"fullUrl\":\"urn:uuid:empty\"}', null)",
        "if(k % 50 = 3, '{\"resource\":{\"resourceType\":\"Practitioner\",\"id\":\"dr\"}}', null)",
        "concat('{\"fullUrl\":\"urn:uuid:claim-', k, '\",\"resource\":', claim, '}')",
    )
    visits = visits.select(
        F.expr(wrap("concat('bundle-visit-', k)", *visit_entries)).alias("value"),
        F.expr("pmod(k, 16)").cast("int").alias("batch"),
    )
    return singles.unionByName(visits)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound bundle documents in two deliveries: ``value, delivery``.

    Half of all rows come with either. A sixth of the visits comes twice: as a draft with another
    patient, price and length of stay, then as it is.
    """
    def bundled(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.expr(
                "concat('{\"resourceType\":\"Bundle\",\"id\":\"', bundle_id, '\",\"entry\":[{\"fullUrl\":\"', "
                "full_url, '\",\"resource\":', resource, '}]}')"
            ).alias("value"),
            "delivery",
        )

    singles = resources(spark, sf_dir, ("Patient", "Condition", "Observation"))
    singles = singles.withColumn("delivery", F.expr("cast(pmod(hash(full_url), 2) + 1 AS int)"))
    orders = _orders(spark, sf_dir)
    late = F.expr("if(k % 6 = 0, 2, cast(k % 2 + 1 AS int))")
    drafts = orders.filter("k % 6 = 0").withColumns(
        {"customer": F.col("customer") + 1, "o_totalprice": F.col("o_totalprice") * 3}
    )
    parts = [bundled(singles)]
    for rows, delivery, stay in ((orders, late, 0), (drafts, F.lit(1), 10)):
        timed = _with_times(rows).withColumn("ended", F.expr(f"ended + make_dt_interval({stay})"))
        for kind, body in (("Encounter", _ENCOUNTER_JSON), ("Claim", _CLAIM_JSON)):
            made = timed.withColumn("delivery", delivery).withColumn("resource", F.expr(body))
            parts.append(
                bundled(made.selectExpr(
                    "resource", "delivery", "concat('bundle-visit-', k) AS bundle_id",
                    f"concat('urn:uuid:{kind.lower()}-', k) AS full_url",
                ))
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _write_lines(texts: DataFrame, path: str, *folders: str) -> None:
    """Write texts as compressed line files; JSON takes a tenth of its size or less."""
    texts.write.mode("overwrite").option("compression", "gzip").partitionBy(*folders).text(path)


def land_delivery(spark: SparkSession, sf_dir: str, path: str, delivery: int) -> str:
    """Write one delivery as line files into a folder of its own."""
    found = deliveries(spark, sf_dir).filter(F.col("delivery") == delivery).select("value")
    _write_lines(found, f"{path}/delivery={delivery}")
    return path


def land(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the bundle documents as line files and return the folder."""
    _write_lines(bundle_texts(spark, sf_dir).select("value"), path)
    return path


def land_in_batches(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the visit bundles in sixteen delivery folders ``batch=0`` to ``batch=15``."""
    _write_lines(bundle_texts(spark, sf_dir), path, "batch")
    return path
