from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import sinks, sources
from layerloom.fixed_values import PART_FILE_PREFIX
from layerloom.operators import named_like, non_blank, union_all
from layerloom.workspace import new_run_dir
from workload.registry import fresh_config, query, table

CONVERSATION_RECORD = "conv_id bigint, turn struct<number: bigint, role: string>, text string"
SETTINGS_DOCUMENT = (
    "event_type string, pipeline_version string, last_run string, "
    "settings struct<batch_size: bigint, retention_days: bigint>"
)


@query("select * from orders")
def scan_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    config = fresh_config(spark, "scan_layer")
    sinks.write_layer(orders, config, "bronze", "orders")
    return sources.read_layer(spark, config, "bronze", "orders")


@query("select * from customer")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = sinks.write_csv(customers, new_run_dir(spark, "scan_csv"))
    return sources.read_csv(spark, path, schema=customers.schema)


@query(
    """select cast(p_partkey as integer) p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
       from part"""
)
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_csv(table(spark, sf_dir, "part"), new_run_dir(spark, "scan_csv_inferred"))
    return sources.read_csv(spark, path)


@query("select * from customer")
def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    path = new_run_dir(spark, "scan_json_array")
    sinks.write_json_array(customers, path, pretty=True)
    return sources.read_json_array(spark, path, customers.schema)


#: Some 300 MB of JSON: a file of several splits that one task still writes.
LINES_PER_ARRAY = 2_000_000


@query("select * from lineitem")
def scan_json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Huge array files, as another system would land them, each read by a task per split."""
    lines = table(spark, sf_dir, "lineitem")
    path = new_run_dir(spark, "scan_json_array_split")
    # One file is written by one task, so their number grows with the table.
    files = max(1, -(-lines.count() // LINES_PER_ARRAY))
    sinks.write_json_array(lines.coalesce(files), path)
    return sources.read_json_array_split(spark, path, lines.schema)


@query("select doc_id, text, lang from documents")
def scan_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line breaks and all, in CSV files that are read in splits."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = sinks.write_csv(documents, new_run_dir(spark, "scan_csv_split"))
    return sources.read_csv_split(spark, path, documents.schema)


@query(
    """select o_orderpriority as priority, count(*) as order_count
       from (select o_orderpriority from orders
             union all
             select unnest(['1-URGENT', '2-HIGH', '6-NONE']))
       group by 1"""
)
def scan_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    literal = sources.literal_rows(
        spark, [("1-URGENT",), ("2-HIGH",), ("6-NONE",)], "o_orderpriority string"
    )
    stored = table(spark, sf_dir, "orders").select("o_orderpriority")
    return (
        union_all([stored, literal])
        .groupBy(F.col("o_orderpriority").alias("priority"))
        .agg(F.count("*").alias("order_count"))
    )


@query("select range as id from range((select count(*) from orders))")
def scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.id_range(spark, table(spark, sf_dir, "orders").count())


@query("select conv_id, turn as number, role, text from conversations")
def records_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct(F.col("turn").alias("number"), "role").alias("turn")
    bodies = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct("conv_id", turn, "text")).alias("body")
    )
    records = sources.records_from_json(bodies, "body", CONVERSATION_RECORD)
    return records.select("conv_id", "turn.number", "turn.role", "text")


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of three subjects, whose ``props`` are an object here and a string there."""
    turn = F.struct(F.col("turn").alias("number"), "role").alias("turn")
    turns = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct("conv_id", turn, F.split("text", " ").alias("words"))).alias("body")
    )
    props = F.from_json("props", "k bigint").alias("props")
    events = table(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", F.struct(props, "user_id").alias("event"))).alias("body")
    )
    prices = F.array(F.struct(F.col("o_totalprice").alias("price"), F.lit(True).alias("open")))
    orders = table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(
                F.struct(F.col("o_orderstatus").alias("props")).alias("event"), prices.alias("prices")
            )
        ).alias("body")
    )
    return union_all([turns, events, orders])


@query(
    """with bodies as (
           select to_json({'conv_id': conv_id, 'turn': {'number': turn, 'role': role},
                           'words': string_split(text, ' ')}) as body from conversations
           union all
           select to_json({'event_id': event_id, 'event': {
                               'props': cast(props as json), 'user_id': user_id}}) from events
           union all
           select to_json({'event': {'props': o_orderstatus},
                           'prices': [{'price': o_totalprice, 'open': true}]}) from orders),
       found as (select json_group_structure(body) as structure from bodies)
       select replace(replace(fullkey, '$.', ''), '[0]', '[]') as path,
              case atom ->> '$' when 'VARCHAR' then 'text' when 'BOOLEAN' then 'truth'
                   when 'DOUBLE' then 'number' when 'JSON' then 'mixed' else 'whole number' end as kind
       from found, json_tree(structure) where atom is not null"""
)
def records_schema_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of all bodies, as a row per leaf."""
    schema = sources.found_schema(mixed_records(spark, sf_dir), "body")
    leaves = sources.literal_rows(spark, sources.schema_paths(schema), "path string, type string")
    kind = (
        F.when(F.col("type") == "string", "text")
        .when(F.col("type") == "boolean", "truth")
        .when(F.col("type") == "variant", "mixed")
        .when(F.regexp_like("type", F.lit("^(decimal|double)")), "number")
        .otherwise("whole number")
    )
    return leaves.select("path", kind.alias("kind"))


@query("select conv_id, turn as number, role, text from conversations")
def records_of_found_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read by the schema that was found, with the conflicting fields beside them."""
    records = sources.records_from_json(mixed_records(spark, sf_dir), "body")
    turns = records.filter(F.col("conv_id").isNotNull())
    return turns.select("conv_id", "turn.number", "turn.role", F.array_join("words", " ").alias("text"))


@query(
    """select line, count(*) as line_count
       from (select unnest(string_split(text, chr(10))) as line from documents)
       where trim(line) <> '' group by 1"""
)
def scan_whole_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "scan_whole_text")
    sinks.write_text(table(spark, sf_dir, "documents"), path, "text")
    files = sources.read_whole_text(spark, path)
    lines = files.select(F.explode(F.split("value", "\n")).alias("line"))
    return non_blank(lines, "line").groupBy("line").agg(F.count("*").alias("line_count"))


@query(
    """select event_type, '1.0' as pipeline_version,
              strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') as last_run,
              count(*) as batch_size,
              date_diff('day', cast(min(ts) as date), cast(max(ts) as date)) as retention_days
       from events group by 1"""
)
def scan_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = F.struct(
        F.count("*").alias("batch_size"),
        F.datediff(F.max("ts"), F.min("ts")).cast("bigint").alias("retention_days"),
    )
    documents = (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.lit("1.0").alias("pipeline_version"),
            F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_run"),
            settings.alias("settings"),
        )
    )
    path = sinks.write_json_documents(documents, new_run_dir(spark, "scan_json_document"))
    return sources.read_json_document(spark, path, SETTINGS_DOCUMENT).select(
        "event_type", "pipeline_version", "last_run", "settings.*"
    )


@query(
    """select event_type, true as all_listed, count(*) as row_count
       from events group by 1"""
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = fresh_config(spark, "file_inventory")
    path = sinks.write_layer(
        table(spark, sf_dir, "events"), config, "bronze", "events", partition_by=["event_type"]
    )
    files = named_like(sources.file_inventory(spark, path), "name", PART_FILE_PREFIX, ".parquet")
    stored = files_read(spark, path, "event_type")
    same = ["name", "path", "size"]
    return (
        stored.join(files.withColumn("listed", F.lit(True)), same, "left")
        .groupBy("event_type")
        .agg(
            F.every(F.coalesce("listed", F.lit(False))).alias("all_listed"),
            F.sum("rows").alias("row_count"),
        )
    )


def files_read(spark: SparkSession, path: str, key: str) -> DataFrame:
    """What Spark's scan itself says of the files it reads: ``name, path, size`` and ``rows``."""
    file = [
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
    ]
    return spark.read.parquet(path).groupBy(key, *file).agg(F.count("*").alias("rows"))


@query(
    """select 'o_orderstatus=' || o_orderstatus as name, true as is_dir, true as same_size,
              count(*) as row_count
       from orders group by 1
       union all
       select '_SUCCESS', false, true, 0"""
)
def directory_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    config = fresh_config(spark, "directory_entries")
    path = sinks.write_layer(
        orders, config, "bronze", "orders", partition_by=["o_orderstatus"], cluster=False
    )
    entries = sources.directory_entries(spark, path)
    key = F.concat(F.lit("o_orderstatus="), "o_orderstatus").alias("name")
    stored = files_read(spark, path, "o_orderstatus").groupBy(key).agg(
        F.sum("size").alias("bytes"), F.sum("rows").alias("rows")
    )
    return entries.join(stored, "name", "left").select(
        "name",
        "is_dir",
        (F.col("size") == F.coalesce("bytes", F.lit(0))).alias("same_size"),
        F.coalesce("rows", F.lit(0)).alias("row_count"),
    )


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response body per document: its lines are the elements, ``lang`` is a parameter."""
    element = lambda line, position: F.struct(
        F.struct(F.col("doc_id").alias("id")).alias("league"),
        position.alias("position"),
        line.alias("line"),
    )
    lines = F.split("text", "\n")
    body = F.struct(F.size(lines).alias("results"), F.transform(lines, element).alias("response"))
    return table(spark, sf_dir, "documents").select("lang", F.to_json(body).alias("body"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that are no JSON: a web page instead of a response."""
    return table(spark, sf_dir, "pages").select(
        F.lit("html").alias("lang"), F.col("html").alias("body")
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid JSON without results: empty requests, with neither elements nor rejects."""
    return table(spark, sf_dir, "events").select(
        F.lit("none").alias("lang"), F.col("props").alias("body")
    )


def landed_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's body cut, doubled, and closed early by a body that goes on."""
    documents = landed_documents(spark, sf_dir)
    cut = F.substring("body", F.lit(1), F.length("body") - 2)
    early = F.concat("body", F.lit('], "more": [1'))
    closed = F.concat("body", F.lit('], "end": true}, {"y": [1'))
    bodies = F.array(cut, F.concat("body", "body"), early, closed)
    return documents.select(F.lit("broken").alias("lang"), F.explode(bodies).alias("body"))


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [land(spark, sf_dir) for land in (landed_documents, landed_pages, landed_events)]
    )


ELEMENT = "league struct<id: bigint>, position bigint, line string"


@query(
    """select lang, doc_id as id, unnest(range(len(lines))) as position, unnest(lines) as line
       from (select lang, doc_id, string_split(text, chr(10)) as lines from documents)"""
)
def ingest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sources.accepted(landed_responses(spark, sf_dir), element=ELEMENT)
    return rows.select("lang", "element.league.id", "element.position", "element.line")


@query(
    """select 'html' as lang, count(*) as request_count, count(distinct html) as body_count
       from pages
       union all
       select 'broken', 4 * count(*), 4 * count(distinct doc_id) from documents"""
)
def envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every broken body is a reject, and no other is; rejects keep their bodies."""
    landed = union_all([landed_responses(spark, sf_dir), landed_broken(spark, sf_dir)])
    rejects = sources.rejected(landed, element=ELEMENT)
    # Bodies are told apart by a digest, so that no task holds whole ones to count them.
    body = F.unhex(F.sha2("rejected_body", 256))
    return rejects.groupBy("lang").agg(
        F.count("*").alias("request_count"), F.countDistinct(body).alias("body_count")
    )


@query(
    """select outcome, lang, count(*) as row_count
       from (select 'accepted' as outcome, lang, unnest(string_split(text, chr(10))) from documents
             union all
             select 'rejected', 'html', html from pages
             union all
             select 'empty', 'none', props from events)
       group by 1, 2"""
)
def envelope_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sources.opened(landed_responses(spark, sf_dir))
    return rows.groupBy("outcome", "lang").agg(F.count("*").alias("row_count"))
