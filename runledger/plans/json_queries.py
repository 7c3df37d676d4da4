"""JSON-load driver queries: validation, enrichment, upsert, write results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import json_items as ji
from runledger.operators import stages as st
from runledger.operators.keyed import upsert
from runledger.plans.registry import register, table
from runledger.session import new_run_dir
from runledger.sources import keyed_table

# Fixed clock for deterministic ids/timestamps (passed in, never "now").
CLOCK = "2024-02-01 00:00:00"


def _event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON items, one batch per user.  ``name`` is left out of
    low-value views; ``category`` is present but null for small ``k``."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k")
    drop_name = (F.col("event_type") == "view") & (F.col("value") < 0.5)
    item = F.create_map(
        F.lit("name"), F.col("event_type"),
        F.lit("category"), F.when(k.try_cast("int") >= 10, k),
        F.lit("description"), F.col("props"))
    item = F.when(drop_name, F.map_filter(item, lambda key, _: key != "name")
                  ).otherwise(item)
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"))
        .alias("batch_id"),
        F.col("event_id").alias("item_index"),
        F.parse_json(F.to_json(item)).alias("item"),
        (F.col("event_type") != "error").alias("write_ok"))


_ITEMS_SQL = """
WITH i AS (SELECT 'U' || CAST(user_id AS VARCHAR) AS batch_id,
                  event_id AS item_index, event_type,
                  (event_type = 'view' AND value < 0.5) AS miss_name,
                  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)
                            >= 10 THEN json_extract_string(props, '$.k') END
                      AS category,
                  event_type <> 'error' AS write_ok
           FROM events),
v AS (SELECT batch_id, CAST(count(*) AS BIGINT) AS received_items,
             CAST(count_if(miss_name) AS BIGINT) AS missing_name,
             CAST(0 AS BIGINT) AS missing_category,
             CAST(count_if(miss_name) AS BIGINT) AS violations,
             CAST(coalesce(min(CASE WHEN miss_name THEN item_index END), -1)
                  AS BIGINT) AS first_violation_index,
             count_if(miss_name) = 0 AS valid
      FROM i GROUP BY batch_id)
"""


@register("json_items_validate", "S5 P3 P4 P5", sql=_ITEMS_SQL + """
SELECT * FROM v
""")
def json_items_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items written as JSON lines, read back with an explicit schema and
    validated per batch (presence of the required fields)."""
    path = new_run_dir(spark, "json_items")
    (_event_items(spark, sf_dir).drop("write_ok")
     .write.json(path))
    items = ji.read_item_lines(spark, path)
    return ji.batch_validation(items)


@register("json_accepted_items", "J6 P5 P7", sql=_ITEMS_SQL + """
SELECT i.batch_id, i.item_index, i.event_type AS name,
       coalesce(i.category, '') AS category
FROM i JOIN v ON i.batch_id = v.batch_id WHERE v.valid
""")
def json_accepted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _event_items(spark, sf_dir)
    accepted = ji.accepted_items(items, ji.batch_validation(items))
    return accepted.select(
        "batch_id", "item_index",
        *[F.coalesce(F.try_variant_get("item", f"$.{f}", "string"),
                     F.lit("")).alias(f) for f in ("name", "category")])


@register("json_items_enrich", "S5 P6 P7 F11 F12", sql=f"""
WITH c AS (SELECT 'C' || CAST(conv_id AS VARCHAR) AS batch_id,
                  turn AS item_index, role, text FROM conversations)
SELECT sha256(batch_id || '|' || CAST(item_index AS VARCHAR)) AS id,
       batch_id, item_index,
       TIMESTAMP '{CLOCK}' AS timestamp, TIMESTAMP '{CLOCK}' AS processed_at,
       CASE WHEN item_index <> 0 THEN role END AS name,
       '{{"deep":[true,null],"turn":' || CAST(item_index AS VARCHAR) || '}}'
           AS category,
       CASE WHEN role = 'system' THEN '' ELSE text END AS description,
       '{{"category":{{"deep":[true,null],"turn":'
           || CAST(item_index AS VARCHAR) || '}}'
           || CASE WHEN role = 'system' THEN ''
                   ELSE ',"description":' || to_json(text) END
           || ',"name":' || CASE WHEN item_index <> 0 THEN to_json(role)
                                 ELSE 'null' END
           || ',"score":' || CAST(item_index AS VARCHAR) || '.5}}'
           AS metadata,
       CAST(epoch(TIMESTAMP '{CLOCK}') AS BIGINT) + 2592000 AS ttl
FROM c
""")
def json_items_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as items through the whole preprocess path: JSON
    lines, validation, all-or-nothing acceptance, then id, timestamps,
    flattening and TTL.  Items have a nested object, numbers and booleans;
    system turns carry no description, first turns a null name."""
    conv = table(spark, sf_dir, "conversations")
    turn = F.col("turn").cast("string")
    name = F.when(F.col("turn") != 0, F.to_json(F.struct(F.col("role")
                                                         .alias("name")))
                  ).otherwise(F.lit('{"name":null}'))
    text = F.when(F.col("role") == "system", F.lit("")).otherwise(
        F.concat(F.lit(","), F.expr(
            "substring(to_json(struct(text as description)), 2, "
            "length(to_json(struct(text as description))) - 2)")))
    item = F.concat(F.expr("substring(n, 1, length(n) - 1)"),
                    F.lit(',"category":{"turn":'), turn,
                    F.lit(',"deep":[true,null]},"score":'), turn,
                    F.lit('.5'), F.col("t"), F.lit("}"))
    path = new_run_dir(spark, "json_conv")
    lines = conv.withColumn("n", name).withColumn("t", text).select(F.concat(
        F.lit('{"batch_id":"C'), F.col("conv_id").cast("string"),
        F.lit('","item_index":'), turn, F.lit(',"item":'), item, F.lit("}")))
    lines.write.text(path)
    items = ji.read_item_lines(spark, path)
    accepted = ji.accepted_items(items, ji.batch_validation(items))
    return ji.enrich_items(accepted, CLOCK)


@register("json_field_violations", "P4", sql=_ITEMS_SQL + """
SELECT batch_id, item_index, 'name' AS field,
       'アイテム' || CAST(item_index AS VARCHAR)
           || ': 必須フィールド''name''が存在しません' AS message
FROM i WHERE miss_name
""")
def json_field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every missing required field with its message."""
    return ji.field_violations(_event_items(spark, sf_dir))


@register("keyed_upsert", "S6 W2", sql="""
WITH u AS (SELECT o_custkey AS id, o_totalprice AS balance,
                  o_orderkey AS last_order, o_orderdate AS updated_at,
                  row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC,
                                              o_orderkey DESC,
                                              o_totalprice DESC) AS rn
           FROM orders)
SELECT c_custkey AS id, c_acctbal AS balance, CAST(-1 AS BIGINT) AS last_order,
       CAST(NULL AS TIMESTAMP) AS updated_at
FROM customer WHERE c_custkey NOT IN (SELECT id FROM u)
UNION ALL
SELECT id, balance, last_order, updated_at FROM u WHERE rn = 1
""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are the stored items; every order is a put of its
    customer's item (last write wins by order date, then order key).  The
    base is a stored version; the upsert writes the next version."""
    root = new_run_dir(spark, "keyed")
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.lit(-1).cast("bigint").alias("last_order"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    base.write.parquet(f"{root}/v=1")
    updates = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("balance"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderdate").alias("updated_at"))
    current = spark.read.parquet(f"{root}/v=1")
    upsert(current, updates, ["id"], ["updated_at", "last_order"]) \
        .write.parquet(f"{root}/v=2")
    return spark.read.parquet(f"{root}/v=2")


@register("keyed_upsert_buckets", "S6 W2", sql="""
WITH u AS (SELECT o_custkey AS id, o_totalprice AS balance,
                  o_orderkey AS last_order, o_orderdate AS updated_at,
                  row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC,
                                              o_orderkey DESC,
                                              o_totalprice DESC) AS rn
           FROM orders),
t AS (SELECT c_custkey AS id, c_acctbal AS balance,
             CAST(-1 AS BIGINT) AS last_order,
             CAST(NULL AS TIMESTAMP) AS updated_at
      FROM customer WHERE c_custkey NOT IN (SELECT id FROM u)
      UNION ALL
      SELECT id, balance, last_order, updated_at FROM u WHERE rn = 1)
SELECT id, CASE WHEN id = m THEN 0 ELSE balance END AS balance,
       CASE WHEN id = m THEN -2 ELSE last_order END AS last_order, updated_at,
       CAST(1 AS BIGINT) AS rewritten
FROM t, (SELECT max(c_custkey) AS m FROM customer)
""")
def keyed_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same puts to a table in hash buckets; then one more customer is
    put, which rewrites one bucket."""
    path = new_run_dir(spark, "keyed-buckets")
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.lit(-1).cast("bigint").alias("last_order"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    updates = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("balance"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"))
    order = ["updated_at", "last_order", "balance"]
    for rows in (base, updates):
        keyed_table.put(rows, path, base.schema, ["id"], order, 64)
    held = keyed_table.read(spark, path, base.schema)
    last = held.orderBy(F.desc("id")).limit(1).select(
        "id", F.lit(0.0).alias("balance"),
        F.lit(-2).cast("bigint").alias("last_order"), "updated_at")
    touched = keyed_table.put(last, path, base.schema, ["id"], order)
    return keyed_table.read(spark, path, base.schema).withColumn(
        "rewritten", F.lit(len(touched)).cast("bigint"))


_RESULTS_SQL = """
WITH r AS (SELECT 'U' || CAST(user_id AS VARCHAR) AS batch_id,
                  event_id AS item_index, event_type <> 'error' AS ok
           FROM events)
"""


def _write_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_items(spark, sf_dir).select(
        "batch_id", "item_index", F.col("write_ok").alias("ok"),
        F.lit(None).cast("string").alias("error"))


@register("write_outcome", "A5 F8", sql=_RESULTS_SQL + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS total_items,
       CAST(count_if(ok) AS BIGINT) AS success_count,
       CAST(count_if(NOT ok) AS BIGINT) AS failed_count,
       CAST(count_if(ok) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS success_rate,
       CAST(count_if(ok) AS DOUBLE) / CAST(count(*) AS DOUBLE) >= 0.9
           AS success,
       CASE WHEN CAST(count_if(ok) AS DOUBLE) / CAST(count(*) AS DOUBLE)
                 >= 0.9 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END AS status
FROM r GROUP BY batch_id
""")
def write_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a write; error events are the failed writes."""
    return ji.write_outcome(_write_results(spark, sf_dir))


@register("failed_items_topn", "W1", sql=_RESULTS_SQL + """
SELECT batch_id, item_index, ok, CAST(NULL AS VARCHAR) AS error, rank
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id
                                   ORDER BY item_index) AS rank
      FROM r WHERE NOT ok)
WHERE rank <= 5
""")
def failed_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ji.first_failures(_write_results(spark, sf_dir))


def _json_stages(spark: SparkSession, sf_dir: str):
    items = _event_items(spark, sf_dir)
    validation = ji.batch_validation(items)
    accepted = ji.accepted_items(items, validation)
    results = accepted.select("batch_id", "item_index",
                              F.col("write_ok").alias("ok"),
                              F.lit(None).cast("string").alias("error"))
    return validation, results


@register("json_batch_stats", "A6 J4 P20", sql=_ITEMS_SQL + """
, w AS (SELECT i.batch_id, count_if(i.write_ok) AS s,
               count_if(NOT i.write_ok) AS f, count(*) AS n
        FROM i JOIN v ON i.batch_id = v.batch_id WHERE v.valid
        GROUP BY i.batch_id)
SELECT v.batch_id,
       CASE WHEN NOT v.valid THEN 'FAILED'
            WHEN CAST(w.s AS DOUBLE) / CAST(w.n AS DOUBLE) >= 0.9
                THEN 'SUCCESS'
            ELSE 'PARTIAL_SUCCESS' END AS status,
       v.received_items AS input_items,
       CAST(CASE WHEN v.valid THEN v.received_items ELSE 0 END AS BIGINT)
           AS preprocessed_items,
       CAST(CASE WHEN v.valid THEN w.s ELSE 0 END AS BIGINT)
           AS dynamodb_success,
       CAST(CASE WHEN v.valid THEN w.f ELSE 0 END AS BIGINT)
           AS dynamodb_failed,
       CASE WHEN v.valid AND v.received_items > 0
            THEN CAST(w.s AS DOUBLE) / CAST(v.received_items AS DOUBLE)
            ELSE 0.0 END AS success_rate
FROM v LEFT JOIN w ON v.batch_id = w.batch_id
""")
def json_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocess and write stages joined per batch; rejected batches never
    reach the write stage (absent stage -> zeros)."""
    validation, results = _json_stages(spark, sf_dir)
    pre = validation.select(
        "batch_id", F.col("received_items").alias("received"),
        F.when(F.col("valid"), F.col("received_items")).otherwise(0)
        .alias("processed"), F.col("valid").alias("ok"))
    outcome = ji.write_outcome(results)
    write = outcome.select("batch_id",
                           F.col("success_count").alias("success"),
                           F.col("failed_count").alias("failed"),
                           F.col("success").alias("ok"))
    joined = st.join_stages(validation.select("batch_id"),
                            {"pre": pre, "write": write})
    return st.json_batch_statistics(joined)


@register("json_batch_failures", "U2 W1", sql=_ITEMS_SQL + """
SELECT batch_id, 'json_preprocess' AS step, item_index,
       'アイテム' || CAST(item_index AS VARCHAR)
           || ': 必須フィールド''name''が存在しません' AS error
FROM i WHERE miss_name
UNION ALL
SELECT batch_id, 'dynamodb_write', item_index, 'Write failed'
FROM (SELECT i.batch_id, i.item_index,
             row_number() OVER (PARTITION BY i.batch_id
                                ORDER BY i.item_index) AS rk
      FROM i JOIN v ON i.batch_id = v.batch_id
      WHERE v.valid AND NOT i.write_ok)
WHERE rk <= 3
""")
def json_batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, results = _json_stages(spark, sf_dir)
    errors = ji.validation_errors(ji.field_violations(
        _event_items(spark, sf_dir)))
    return ji.batch_failures(errors, results)


@register("json_batch_documents", "S5 P3 P4", sql="""
WITH d AS (SELECT 'T' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR)
                      AS batch_id, role, turn, conv_id FROM conversations)
SELECT batch_id,
       CAST(CASE WHEN role = 'system' OR role = 'assistant' AND turn % 2 = 1
                      OR turn = 0 THEN 0
                 WHEN role = 'user' THEN 1 ELSE 2 END AS BIGINT)
           AS received_items,
       CAST(0 AS BIGINT) AS missing_name,
       CAST(CASE WHEN role = 'assistant' AND turn % 2 = 0 AND turn <> 0
                 THEN 1 ELSE 0 END AS BIGINT) AS missing_category,
       CAST(CASE WHEN role = 'assistant' AND turn % 2 = 0 AND turn <> 0
                 THEN 1 ELSE 0 END AS BIGINT) AS violations,
       CAST(CASE WHEN role = 'assistant' AND turn % 2 = 0 AND turn <> 0
                 THEN 1 ELSE -1 END AS BIGINT) AS first_violation_index,
       CASE WHEN role = 'system' AND conv_id % 3 = 0
                THEN 'データがDict形式ではありません'
            WHEN role = 'system' THEN '''items''キーが存在しません'
            WHEN role = 'assistant' AND turn % 2 = 1
                THEN '''items''がリスト形式ではありません'
            WHEN turn = 0 THEN '''items''が空です' END AS structure_error,
       role = 'user' AND turn <> 0 AS valid
FROM d
""")
def json_batch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn becomes one JSON batch document:
    system turns carry no ``items`` or are a string that holds a document,
    odd assistant turns have an object or a string instead of a list, turn 0
    an empty list, user turns one complete item and even assistant turns two
    items, the second without ``category``.  Documents
    are read, structure-checked, exploded and validated."""
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text")
    item = F.struct(F.col("role").alias("name"),
                    F.lit("turn").alias("category"),
                    F.col("text").alias("description"))
    partial = F.struct(F.col("role").alias("name"))
    role, turn = F.col("role"), F.col("turn")
    whole = F.to_json(F.struct(F.array(item).alias("items")))
    text_list = F.to_json(F.struct(F.to_json(F.array(item)).alias("items")))
    data = (F.when((role == "system") & (F.col("conv_id") % 3 == 0),
                   # The document as a string: looks right, is none.
                   F.regexp_extract(F.to_json(F.struct(whole.alias("d"))),
                                    r"^\{\"d\":(.*)\}$", 1))
            .when(role == "system",
                  F.to_json(F.struct(F.col("text").alias("key1"))))
            .when((role == "assistant") & (turn % 4 == 1), text_list)
            .when((role == "assistant") & (turn % 2 == 1),
                  F.to_json(F.struct(item.alias("items"))))
            .when(turn == 0, F.lit('{"items": []}'))
            .when(role == "user", F.to_json(F.struct(F.array(item)
                                                      .alias("items"))))
            .otherwise(F.concat(F.lit('{"items": ['), F.to_json(item),
                                F.lit(", "), F.to_json(partial),
                                F.lit("]}"))))
    batch_id = F.concat(F.lit("T"), F.col("conv_id").cast("string"),
                        F.lit("_"), turn.cast("string"))
    head = F.to_json(F.struct(batch_id.alias("batch_id")))
    # '{"batch_id":"T1_0"' + ', "input_data": ...}'
    docs = conv.select(F.concat(
        F.substring_index(head, "}", 1),
        F.lit(', "input_data": '), data, F.lit("}")).alias("doc"))
    path = new_run_dir(spark, "json_docs")
    docs.write.text(path)                  # one document per line
    raw = ji.read_batch_documents(spark, path, multi_line=False)
    checked = ji.structure_check(raw)
    items = ji.explode_items(checked)
    return ji.batch_validation(items, checked)


@register("json_preprocess_evidence", "S18 Q25 P12 S12", sql=_ITEMS_SQL + """
SELECT batch_id, 'json_preprocess' AS step,
       'json-to-dynamodb-pipeline' AS flow, valid AS ok,
       'JSON前処理' || CASE WHEN valid THEN '成功' ELSE '失敗' END || ': '
           || CAST(received_items AS VARCHAR) || '→'
           || CAST(CASE WHEN valid THEN received_items ELSE 0 END AS VARCHAR)
           || '件' AS note,
       received_items AS input_items,
       CAST(CASE WHEN valid THEN received_items ELSE 0 END AS BIGINT)
           AS output_items,
       TIMESTAMP '2024-02-01 00:00:00' AS ts
FROM v
""")
def json_preprocess_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preprocess step logs its evidence as ``EVIDENCE`` lines, which
    are parsed back like any other step's evidence."""
    from runledger.operators import evidence as evo
    items = _event_items(spark, sf_dir)
    records = ji.preprocess_evidence(ji.batch_validation(items), CLOCK)
    lines = evo.evidence_log_lines(
        records, "/aws/lambda/json-preprocessor",
        F.concat(F.lit("pre-"), F.col("batch_id")))
    parsed = evo.parse_log_events(lines, None, CLOCK)
    return parsed.select(
        "batch_id", "step", "flow", "ok", "note",
        F.col("evidence.input.items").alias("input_items"),
        F.col("evidence.output.items").alias("output_items"), "ts")
