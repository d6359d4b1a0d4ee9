"""Vector stores: one catalog table per store, Parquet files underneath.

A store is partitioned by ``vector_slice``. A slice is a set of files in a folder of
its own, and its value names the range of ids that it may hold, so that Catalyst
prunes slices by id. Every write is staged in a new folder, checked there, and then
made visible by a change of the catalog:

* an append is one slice (or ``slices`` ranges of ids) and one ADD PARTITION;
* a delete or an update writes the slices that hold a hit again and points these
  partitions at the new files; all other files stay as they are. A change of several
  partitions is first written down in the store's folder and named in a table property;
  if its job dies, the next function of this module that looks at the table finishes it.

A failed or killed job leaves the table as it was. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkvec.functions.jsons import json_path, json_type
from sparkvec.functions.vectors import check_metric
from sparkvec.operators.checks import check_dimensions, check_table_name
from sparkvec.operators.running import with_running_offsets

SCHEMA = (
    "id BIGINT, document_text STRING, metadata STRING, "
    "embedding ARRAY<FLOAT>, created_at TIMESTAMP, updated_at TIMESTAMP"
)
COLUMNS = ["id", "document_text", "metadata", "embedding", "created_at", "updated_at"]
SLICE = "vector_slice"
#: Types of promoted metadata columns, by the JSON type of their values.
PROMOTED_TYPES = {"string": "STRING", "number": "DOUBLE", "boolean": "BOOLEAN"}
PREVIEW_ROWS, PREVIEW_LENGTH = 5, 100
ROWS_PER_FILE = 250_000
BYTES_PER_FILE = 128 << 20  # of texts, metadata and vectors, uncompressed
_INSERT = re.compile(
    r"insert\s+(?P<kind>into|overwrite)\s+(?:table\s+)?(?P<table>[\w.`]+)\s*(?:\((?P<columns>[\w\s,`]+)\)(?=\s*(?:select|values|table|from|with|\()\b))?",
    re.IGNORECASE,
)
_TOKEN = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|[()]|\w+|\s+|.", re.DOTALL)


@dataclass(frozen=True)
class VectorStoreConfig:
    table: str
    dimensions: int = 384
    distance: str = "cosine"
    drop_if_exists: bool = False
    location: str | None = None  # parent of the store's own folder; default: the warehouse
    #: Metadata keys that get a typed column of their own: key -> "string", "number" or "boolean".
    promoted: dict[str, str] = field(default_factory=dict)

    def checked(self) -> VectorStoreConfig:
        check_table_name(self.table)
        check_dimensions(self.dimensions)
        check_metric(self.distance)
        unknown = set(self.promoted.values()) - set(PROMOTED_TYPES)
        if unknown:
            raise ValueError(f"unknown types of promoted keys: {sorted(unknown)}")
        return self


# --- catalog ---------------------------------------------------------------


def active_session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise ValueError("there is no active SparkSession")
    return spark


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(check_table_name(table))


def _require(spark: SparkSession, table: str) -> None:
    if not table_exists(spark, table):
        raise ValueError(f"table {table!r} does not exist")
    _settle(spark, table)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def promoted_columns(spark: SparkSession, table: str) -> dict[str, tuple[str, str]]:
    """Metadata key -> (column, type) of the keys that have a column of their own."""
    found = json.loads(_properties(spark, table).get("vector.promoted") or "{}")
    return {key: tuple(value) for key, value in found.items()}


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_vector_store(spark: SparkSession, config: VectorStoreConfig) -> dict:
    """Create the fixed six-column table; dimension and metric become table properties."""
    config.checked()
    if config.drop_if_exists:
        drop_table(spark, config.table)
    metric = check_metric(config.distance)
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    base = f"{(config.location or warehouse).rstrip('/')}/{config.table}-{uuid.uuid4().hex}"
    columns = {key: (f"meta_{at}", kind) for at, (key, kind) in enumerate(config.promoted.items())}
    typed = "".join(f", {name} {PROMOTED_TYPES[kind]}" for name, kind in columns.values())
    listed = _quoted(json.dumps(columns))
    # the folder is this table's alone, whatever other databases call theirs
    spark.sql(
        f"CREATE TABLE {config.table} ({SCHEMA}{typed}, {SLICE} STRING) USING parquet "
        f"PARTITIONED BY ({SLICE}) LOCATION '{base}' "
        f"TBLPROPERTIES ('vector.dimensions' = '{config.dimensions}', "
        f"'vector.distance' = '{metric}', 'vector.folder' = '{base}', 'vector.promoted' = {listed})"
    )
    return {
        "table": config.table,
        "dimensions": config.dimensions,
        "distance_metric": metric,
        "schema": [part.strip() for part in SCHEMA.split(",")],
    }


def drop_table(spark: SparkSession, table: str) -> bool:
    """Drop a table if it exists; a store's folder goes with it."""
    folder = None
    if table_exists(spark, table):
        folder = _properties(spark, table).get("vector.folder")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if folder:
        _delete_folder(spark, folder)
    return True


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


def list_vector_tables(spark: SparkSession) -> list[str]:
    """Tables with a vector column; tables that cannot be read are skipped."""
    found = []
    for name in list_tables(spark):
        try:
            fields = spark.table(name).schema.fields
        except Exception:  # noqa: BLE001 - a broken table must not hide the others
            continue
        if any(f.dataType.simpleString() in ("array<float>", "array<double>") for f in fields):
            found.append(name)
    return found


def store_metric(table: str) -> str | None:
    return _properties(active_session(), table).get("vector.distance")


def resolve_store(
    store: DataFrame | str, metric: str | None = None
) -> tuple[DataFrame, str]:
    """A store's rows and the metric to use: the argument, else the table's, else cosine."""
    if isinstance(store, DataFrame):
        return store, check_metric(metric or "cosine")
    spark = active_session()
    _require(spark, store)
    chosen = metric or store_metric(store) or "cosine"
    return spark.table(store), check_metric(chosen)


def vector_config(spark: SparkSession, table: str) -> dict | None:
    properties = _properties(spark, table)
    if "vector.dimensions" not in properties:
        return None
    return {
        "dimensions": int(properties["vector.dimensions"]),
        "distance_metric": properties["vector.distance"],
    }


def table_sample(spark: SparkSession, table: str) -> DataFrame:
    return (
        spark.table(table)
        .select("id", F.substring("document_text", 1, PREVIEW_LENGTH).alias("preview"))
        .orderBy("id")
        .limit(PREVIEW_ROWS)
    )


def table_info(spark: SparkSession, table: str) -> dict:
    """Row count, columns, a five-row preview (as a DataFrame) and the vector settings."""
    _require(spark, table)
    df = spark.table(table)
    return {
        "name": table,
        "row_count": df.count(),
        "columns": [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name != SLICE],
        "sample_data": table_sample(spark, table),
        "vector_config": vector_config(spark, table),
    }


# --- reading ---------------------------------------------------------------


def get_record(spark: SparkSession, table: str, record_id: int) -> DataFrame:
    """Zero or one row, without the vector. The id filter reaches the Parquet scan."""
    _require(spark, table)
    df = spark.table(table)
    if SLICE in df.columns:
        df = df.filter(_may_hold(record_id, record_id))
    return (
        df.filter(F.col("id") == F.lit(record_id))
        .select(
            "id",
            "document_text",
            F.coalesce("metadata", F.lit("{}")).alias("metadata"),
            "created_at",
            "updated_at",
        )
    )


def get_record_by_id(spark: SparkSession, table: str, record_id: int) -> dict | None:
    row = get_record(spark, table, record_id).head()
    if row is None:
        return None
    record = row.asDict()
    record["metadata"] = json.loads(record["metadata"])
    return record


def execute_query(spark: SparkSession, sql: str, params: list | dict | None = None) -> DataFrame:
    """A parameterised SELECT, lazily."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def _split_insert(sql: str) -> tuple[re.Match[str], str] | None:
    """The INSERT clause of a statement, and the query whose rows it writes; None for other statements."""
    depth, at, head = 0, 0, ""
    for token in _TOKEN.finditer(sql):
        word = token.group()
        depth += (word == "(") - (word == ")")
        blank = word.isspace() or word.startswith(("--", "/*"))
        if not blank and not head and word.lower() not in ("with", "insert"):
            return None
        if not blank:
            head = head or word.lower()
        if depth == 0 and word.lower() == "insert":
            at = token.start()
            into = _INSERT.match(sql, at)
            return (into, f"{sql[:at]} {sql[into.end() :]}") if into else None
    return None


def execute_command(spark: SparkSession, sql: str, params: list | dict | None = None) -> int:
    """A parameterised DDL or INSERT statement; the number of rows it writes, else 0.

    Rows for a vector store go through ``insert_embeddings`` and its checks. Columns
    are matched by position, or by the statement's list of columns.
    """
    parts = _split_insert(sql)
    if parts is None:
        row = execute_query(spark, sql, params).head()
        return row.asDict().get("num_affected_rows", 0) if row else 0
    into, query = parts
    table, append = into["table"], into["kind"].lower() == "into"
    if re.match(r"\s*(partition|replace|by|if)\b", sql[into.end() :], re.IGNORECASE):
        raise ValueError("INSERT with a PARTITION, BY NAME, IF or REPLACE clause is not supported here")
    rows = execute_query(spark, query, params)
    into_store = "vector.folder" in _properties(spark, table)
    given = [c.strip(" `\n\t") for c in into["columns"].split(",")] if into["columns"] else None
    names = given or [c for c in spark.table(table).columns if not into_store or c in COLUMNS]
    if into_store and not given:
        rows = rows.select(*(F.col(f"`{c}`") for c in rows.columns if c != SLICE and not c.startswith("meta_")))
    if len(rows.columns) != len(names):
        raise ValueError(f"{len(rows.columns)} columns for the {len(names)} of {table!r}")
    rows = rows.toDF(*names)
    if into_store:
        if not append:
            raise ValueError("a vector store is not overwritten by a statement; drop it or delete its rows")
        return insert_embeddings(spark, table.strip("`"), rows)
    target = spark.table(table).schema
    rows = rows.select(*((F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in target))
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=not append)
    spark.catalog.refreshTable(table)
    return counted.get["rows"]


# --- appending -------------------------------------------------------------


def _promoted_values(promoted: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """The promoted columns of a row, from its metadata; NULL where the value is of another JSON type."""
    made = {}
    for key, (name, kind) in promoted.items():
        path = json_path(key)
        value, found = F.get_json_object("metadata", path), json_type(F.col("metadata"), path)
        if kind == "number":
            fits = ~found.isin("STRING", "BOOLEAN", "VOID") & ~found.startswith("OBJECT") & ~found.startswith("ARRAY")
        else:
            fits = found == PROMOTED_TYPES[kind]
        made[name] = F.when(value.isNotNull() & fits, value.try_cast(PROMOTED_TYPES[kind]))
    return made


def _checked_rows(df: DataFrame, dimensions: int) -> DataFrame:
    """Fail the write at the first row that breaks the table's contract, in the same pass."""
    vector = F.col("embedding").cast("array<float>")
    bad_vector = (
        vector.isNull()
        | (F.size(vector) != dimensions)
        | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    vector_error = F.raise_error(
        F.concat(F.lit(f"embedding of row is not {dimensions} numbers; id="), F.col("id"))
    )
    text_error = F.raise_error(F.concat(F.lit("document_text is NULL; id="), F.col("id")))
    id_error = F.raise_error(F.lit("id is NULL")).cast("long")
    json_error = F.raise_error(F.concat(F.lit("metadata is not JSON; id="), F.col("id"))).cast("string")
    no_json = F.col("metadata").isNotNull() & F.try_parse_json("metadata").isNull()
    return df.select(
        F.coalesce(F.col("id").cast("long"), id_error).alias("id"),
        F.when(F.col("document_text").isNull(), text_error.cast("string"))
        .otherwise(F.col("document_text"))
        .alias("document_text"),
        F.when(no_json, json_error).otherwise(F.coalesce("metadata", F.lit("{}"))).alias("metadata"),
        F.when(bad_vector, vector_error.cast("array<float>")).otherwise(vector).alias("embedding"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )


def next_id(spark: SparkSession, table: str) -> int:
    """One more than the largest id; reads the ids of the slices that may hold it.

    No slice is empty, so that the largest id is not below the start of any.
    """
    rows = spark.table(table)
    if SLICE in rows.columns:
        names = F.split(F.split("partition", "=")[1], "_")
        top = spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(names[0].cast("long"))).head()[0]
        if top is None:
            return 0
        rows = rows.filter(_may_hold(top, (1 << 63) - 1))
    largest = rows.agg(F.max("id")).head()[0]
    return 0 if largest is None else largest + 1


def with_new_ids(
    spark: SparkSession, table: str, rows: DataFrame, order_by: str | None = None
) -> DataFrame:
    """Give rows ids above those in the table.

    With ``order_by`` the ids are dense in that order, at the price of one
    shuffle. Without it they are unique but have gaps, and nothing is shuffled.
    """
    first = next_id(spark, table)
    if order_by is None:
        return rows.withColumn("id", F.lit(first) + F.monotonically_increasing_id())
    numbered = with_running_offsets(rows, order_by, {"_number": F.lit(1)})
    return numbered.withColumn("id", F.lit(first) + F.col("_number")).drop("_number")


def _range(slice_name: Column) -> tuple[Column, Column]:
    """The least and the largest id that a slice may hold, as said by its name."""
    parts = F.split(slice_name, "_")
    return F.element_at(parts, 1).cast("long"), F.element_at(parts, 2).cast("long")


def _may_hold(low: int, high: int) -> Column:
    """Slices that may hold an id from ``low`` to ``high``: a condition on the partition column alone."""
    least, largest = _range(F.col(SLICE))
    return (least <= F.lit(high)) & (largest >= F.lit(low))


def _slice_name(low: int, high: int) -> str:
    return f"{low}_{high}_{uuid.uuid4().hex[:12]}"


def refuse_repeated_ids(spark: SparkSession, table: str, ids: DataFrame, low: int, high: int) -> None:
    """Raise if an ``id`` occurs twice, there or together with the table's.

    Of the table, only ids from ``low`` to ``high`` are read, of slices that may hold them.
    """
    twice = ids.groupBy("id").count().filter("count > 1").select("id")
    within = F.col("id").between(low, high)
    there = spark.table(table).filter(_may_hold(low, high)).filter(within).select("id")
    found = twice.unionByName(ids.join(there, "id", "left_semi")).head()
    if found is not None:
        raise ValueError(f"id {found['id']} would stand twice in {table!r}")


def insert_embeddings(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    *,
    order_by: str | None = None,
    check_ids: bool = True,
    slices: int = 1,
    once: tuple[str, int] | None = None,
) -> int:
    """Append rows with ``document_text`` and ``embedding``; returns how many.

    Optional columns: ``metadata`` (JSON text, ``{}`` by default), ``id``,
    ``created_at``. All rows appear with one change of the catalog, or none. Given ids
    must be new and distinct; that is checked over the ids as written, before they appear,
    unless the caller knows it (``check_ids=False``). An append is one slice, which
    later changes rewrite as a whole; ``slices`` cuts a large one by ranges of ids, at
    the price of a shuffle.

    ``once`` is the name of a source and the number of its batch. The number is kept with
    the table by the same change that shows the rows: a batch that is there already, or
    one before it, is not appended again, and 0 is returned.
    """
    _require(spark, table)
    config = vector_config(spark, table)
    if config is None:
        raise ValueError(f"table {table!r} is not a vector store")
    missing = {"document_text", "embedding"} - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    if once is not None and already_appended(spark, table, once):
        return 0
    if "metadata" not in rows.columns:
        rows = rows.withColumn("metadata", F.lit("{}"))
    given_ids = "id" in rows.columns
    if not given_ids:
        rows = with_new_ids(spark, table, rows, order_by)
    if "created_at" not in rows.columns:
        rows = rows.withColumn("created_at", F.current_timestamp())
    if "updated_at" not in rows.columns:
        rows = rows.withColumn("updated_at", F.col("created_at"))
    folder = _folder(spark, table)
    staged = f"{folder}/{uuid.uuid4().hex}"
    written = Observation()
    measures = [F.count(F.lit(1)).alias("rows"), F.min("id").alias("low"), F.max("id").alias("high")]
    checked = _checked_rows(rows, config["dimensions"])
    checked = checked.withColumns(_promoted_values(promoted_columns(spark, table))).observe(written, *measures)
    try:
        if slices > 1:
            _write_slices(checked, staged, slices)
        else:
            checked.write.parquet(staged)
        found = written.get
        if found["rows"] and given_ids and check_ids:
            refuse_repeated_ids(spark, table, spark.read.parquet(staged).select("id"), found["low"], found["high"])
    except BaseException:
        _delete_folder(spark, staged)
        raise
    if not found["rows"]:
        _delete_folder(spark, staged)
        return 0
    add = _named_slices(spark, staged) if slices > 1 else {_slice_name(found["low"], found["high"]): staged}
    _commit(spark, table, add=add, once=once)
    return found["rows"]


def _batch_property(source: str) -> str:
    return f"vector.batch.{hashlib.sha256(source.encode()).hexdigest()[:32]}"


def already_appended(spark: SparkSession, table: str, once: tuple[str, int]) -> bool:
    """Whether this batch of a source, or a later one, is in the table."""
    _require(spark, table)
    source, number = once
    return int(_properties(spark, table).get(_batch_property(source), -1)) >= number


# --- staging and switching ----------------------------------------------------


def _folder(spark: SparkSession, table: str) -> str:
    folder = _properties(spark, table).get("vector.folder")
    if folder is None:
        raise ValueError(f"table {table!r} is not a vector store")
    return folder


def _write_slices(rows: DataFrame, staged: str, slices: int) -> None:
    """A file and a folder for each of ``slices`` ranges of ids, ordered by id."""
    cut = rows.repartitionByRange(slices, "id").sortWithinPartitions("id")
    cut.withColumn(SLICE, F.spark_partition_id()).write.partitionBy(SLICE).parquet(staged)


def _named_slices(spark: SparkSession, staged: str) -> dict[str, str]:
    """Slice -> folder of what ``_write_slices`` wrote; reads the ids."""
    found = spark.read.parquet(staged).groupBy(SLICE).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return {_slice_name(r["low"], r["high"]): f"{staged}/{SLICE}={r[SLICE]}" for r in found.collect()}


def _commit(
    spark: SparkSession,
    table: str,
    add: dict[str, str] | None = None,
    move: dict[str, str] | None = None,
    drop: list[str] | None = None,
    old_folders: list[str] | None = None,
    once: tuple[str, int] | None = None,
) -> None:
    """Make staged files visible: new slices, slices at a new folder, and slices that go."""
    change = {"add": add or {}, "move": move or {}, "drop": drop or [], "old": old_folders or []}
    if len(change["add"]) == 1 and not (move or drop or once):
        _apply(spark, table, change)
        return
    # from the moment the property names it, the change is made; if this process ends, _settle finishes it
    journal = f"{_folder(spark, table)}/change-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(change),)], "change string").coalesce(1).write.parquet(journal)
    batch = f", '{_batch_property(once[0])}' = '{int(once[1])}'" if once else ""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('vector.change' = '{journal}'{batch})")
    _settle(spark, table)


def _settle(spark: SparkSession, table: str) -> None:
    """Finish a change that was decided but not made; every step may be repeated."""
    journal = _properties(spark, table).get("vector.change")
    if journal:
        _apply(spark, table, json.loads(spark.read.parquet(journal).head()["change"]))
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('vector.change')")
        _delete_folder(spark, journal)


def _apply(spark: SparkSession, table: str, change: dict) -> None:
    spec = lambda name: f"PARTITION ({SLICE} = '{name}')"
    if change["add"]:
        parts = " ".join(f"{spec(name)} LOCATION '{folder}'" for name, folder in change["add"].items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for name, folder in change["move"].items():
        spark.sql(f"ALTER TABLE {table} {spec(name)} SET LOCATION '{folder}'")
    if change["drop"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(spec, change["drop"])))
    spark.catalog.refreshTable(table)
    for folder in change["old"]:
        _delete_folder(spark, folder)
        parent = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
        files = parent.getFileSystem(spark._jsc.hadoopConfiguration())
        if parent.getName().startswith("change-") or not files.exists(parent):
            continue
        if f"{SLICE}=" in folder and not any(f.isDirectory() for f in files.listStatus(parent)):
            files.delete(parent, True)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _with_folder(df: DataFrame) -> DataFrame:
    return df.withColumn("_folder", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))


def _folders(rows: DataFrame) -> dict[str, str]:
    """Slice -> folder of the slices that hold a row of ``rows``; one row per slice comes to the driver."""
    return {r[0]: r[1] for r in rows.groupBy(SLICE).agg(F.min("_folder")).collect()}


def _replace(spark: SparkSession, table: str, folder: str, old: dict[str, str], rows: DataFrame) -> None:
    """Write ``rows`` as the slices ``old`` (slice -> folder) and switch these; all other slices keep their files."""
    staged = f"{folder}/{uuid.uuid4().hex}"
    try:
        rows.select(*spark.table(table).columns).write.partitionBy(SLICE).parquet(staged)
    except BaseException:
        _delete_folder(spark, staged)
        raise
    new = {name: f"{staged}/{SLICE}={name}" for name in old}
    move = {name: path for name, path in new.items() if _exists(spark, path)}
    _commit(spark, table, move=move, drop=sorted(set(old) - set(move)), old_folders=sorted(old.values()))
    if not move:
        _delete_folder(spark, staged)


# --- deleting and updating ----------------------------------------------------


def delete_records(
    spark: SparkSession, table: str, condition: str, params: dict[str, object] | None = None
) -> int:
    """Delete the rows for which the SQL condition is true; returns how many.

    ``params`` are named (``:name`` in the condition) and bound, not spliced. Only
    slices that hold such a row are written again.
    """
    _require(spark, table)
    if not condition.strip():
        raise ValueError("the delete condition is blank")
    folder = _folder(spark, table)
    flag = f"coalesce({condition}, false)"
    hits = f"SELECT {SLICE}, _metadata FROM {table} WHERE {flag}"
    old = _folders(_with_folder(spark.sql(hits, args=params or {})))
    if not old:
        return 0
    flagged = spark.sql(f"SELECT *, {flag} AS _gone FROM {table}", args=params or {})
    counted = Observation()
    # counted where the rows are dropped, so that the number is that of the rows that go
    flagged = flagged.filter(F.col(SLICE).isin(*old)).observe(counted, F.count_if("_gone").alias("gone"))
    _replace(spark, table, folder, old, flagged.filter(~F.col("_gone")).drop("_gone"))
    return counted.get["gone"]


def _update(spark: SparkSession, table: str, old: dict[str, str], rewritten) -> dict:
    """Write slices again with other metadata; ``rewritten`` adds ``_hit`` and ``_value`` to their rows."""
    observed = Observation()
    rows = rewritten(spark.table(table).filter(F.col(SLICE).isin(*old)))
    stamped = F.when(F.col("_hit"), F.current_timestamp()).otherwise(F.col("updated_at"))
    valid = F.try_parse_json("_value").isNotNull()
    error = F.raise_error(F.concat(F.lit("metadata is not JSON; id="), F.col("id"))).cast("string")
    value = F.when(F.col("_value").isNull(), F.lit("{}")).when(valid, F.col("_value")).otherwise(error)
    rows = rows.withColumn("metadata", F.when(F.col("_hit"), value).otherwise(F.col("metadata")))
    rows = rows.withColumn("updated_at", stamped).observe(observed, F.count_if("_hit").alias("changed"))
    rows = rows.withColumns(_promoted_values(promoted_columns(spark, table)))
    _replace(spark, table, _folder(spark, table), old, rows)
    return observed.get


def update_metadata(spark: SparkSession, table: str, record_id: int, metadata: dict) -> bool:
    """Replace one row's metadata. False if there is no such row. Only its slice is written again."""
    _require(spark, table)
    hit = F.col("id") == F.lit(record_id)
    old = _folders(_with_folder(spark.table(table)).filter(_may_hold(record_id, record_id)).filter(hit))
    if not old:
        return False
    text = json.dumps(metadata, ensure_ascii=False)
    _update(spark, table, old, lambda rows: rows.withColumns({"_hit": hit, "_value": F.lit(text)}))
    return True


def update_metadata_bulk(spark: SparkSession, table: str, updates: DataFrame) -> int:
    """Replace metadata for many rows: ``updates(id, metadata)``; returns how many.

    An id that occurs twice in the updates fails the job, and the table stays as it was.
    Only slices that hold an updated row are written again.
    """
    _require(spark, table)
    repeated = F.raise_error(F.concat(F.lit("two updates for id "), F.col("id").cast("string")))
    new = updates.groupBy(F.col("id").cast("long").alias("id")).agg(
        F.count(F.lit(1)).alias("_times"), F.any_value("metadata").alias("_value")
    )
    value = F.when(F.col("_times") > 1, repeated.cast("string")).otherwise(F.col("_value"))
    new = new.select("id", F.struct(value.alias("value")).alias("_new"))
    bounds = updates.agg(F.min(F.col("id").cast("long")), F.max(F.col("id").cast("long"))).head()
    if bounds[0] is None:
        return 0
    there = _with_folder(spark.table(table)).filter(_may_hold(*bounds)).filter(F.col("id").between(*bounds))
    old = _folders(there.join(updates.select(F.col("id").cast("long").alias("id")), "id", "left_semi"))
    if not old:
        return 0

    def rewritten(rows: DataFrame) -> DataFrame:
        joined = rows.join(new, "id", "left")
        return joined.withColumns({"_hit": F.col("_new").isNotNull(), "_value": F.col("_new.value")})

    return _update(spark, table, old, rewritten)["changed"]


def optimize_table(
    spark: SparkSession, table: str, rows_per_file: int = ROWS_PER_FILE
) -> dict:
    """Rewrite into evenly sized slices of one file, ordered by id: lookups skip the others, and changes leave them.

    A file is of ``rows_per_file`` rows and about ``BYTES_PER_FILE``, whichever is less, as one task writes it.
    """
    _require(spark, table)
    df = spark.table(table)
    held = [F.octet_length("document_text"), F.octet_length("metadata"), F.size("embedding") * 4]
    weight = sum((F.coalesce(size.cast("long"), F.lit(0)) for size in held), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).head()
    old = _folders(_with_folder(df))
    if old:
        staged = f"{_folder(spark, table)}/{uuid.uuid4().hex}"
        try:
            _write_slices(df.drop(SLICE), staged, max(1, -(-rows // rows_per_file), -(-total // BYTES_PER_FILE)))
            add = _named_slices(spark, staged)
        except BaseException:
            _delete_folder(spark, staged)
            raise
        _commit(spark, table, add=add, drop=sorted(old), old_folders=sorted(old.values()))
    return {"table": table, "status": "optimized", "row_count": rows}
