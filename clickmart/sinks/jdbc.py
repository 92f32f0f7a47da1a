"""JDBC reads and writes of the stored tables (A6, A7, A8, B1, B5 for databases).

``conf`` carries ``url``, ``driver``, optional ``user``/``password`` and any
other option of Spark's JDBC source, which all reach it.  Writes go out from
the executors, one connection per partition; ``numPartitions`` caps the number
of concurrent connections so a large batch cannot flood the database.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schema import REQUIRED_TABLES, TABLE_SCHEMAS
from clickmart.sinks.tables import DEFAULT_STREAM, conform

JdbcConf = Mapping[str, str]
BATCHES_TABLE = "batch_times"
LONGEST = 32_000  # characters of a text value on its way through the staging table
_TEXT = {"page_url": 2048, "referrer": 2048}
_TYPES = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP", T.DateType: "DATE"}


def _options(conf: JdbcConf) -> dict[str, str]:
    return {k: str(v) for k, v in conf.items() if v is not None}


def read_table(spark: SparkSession, conf: JdbcConf, name: str, partition_column: str | None = None, partitions: int = 8) -> DataFrame:
    """A database table as a DataFrame (filters and column lists are pushed
    into the SELECT the JDBC source sends).

    With ``partition_column`` it is read by about ``partitions`` tasks with about
    as many rows each: the database is asked for the values that part the ordered
    column evenly (at most ``partitions`` of them come back), each range between
    two of them is one task, and so are the NULLs.  Rows alike in that column stay
    together, so a unique column parts best."""
    if not partition_column:
        return spark.read.format("jdbc").options(**_options(conf)).option("dbtable", name).load()
    given = _options(conf)
    ranges = split_ranges(spark, conf, name, partition_column, partitions)
    rest = {k: v for k, v in given.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(given["url"], name, predicates=ranges, properties=rest)


def split_ranges(spark: SparkSession, conf: JdbcConf, name: str, column: str, partitions: int) -> list[str]:
    """Conditions on ``column`` that part the rows of a table evenly, the NULLs apart."""
    reader = spark.read.format("jdbc").options(**_options(conf))
    quoted = f'"{column}"'
    n = reader.option("dbtable", f"(SELECT COUNT({quoted}) AS n FROM {name}) counted").load().first()[0]
    step = max(1, -(-int(n) // max(1, int(partitions))))
    ordered = f"SELECT {quoted} AS v FROM {name} WHERE {quoted} IS NOT NULL ORDER BY {quoted}"
    numbered = f"SELECT v, ROW_NUMBER() OVER () AS r FROM ({ordered}) o"
    ask = f"(SELECT v FROM (SELECT v, r FROM ({numbered}) p WHERE MOD(r, {step}) = 1 AND r > 1) q) points"
    points = sorted({r[0] for r in reader.option("dbtable", ask).load().collect()}) if n > step > 1 else []
    said = [_literal(p) for p in points]
    if not said:
        return [f"{quoted} IS NOT NULL", f"{quoted} IS NULL"]
    inner = [f"{quoted} >= {lo} AND {quoted} < {hi}" for lo, hi in zip(said, said[1:], strict=False)]
    return [f"{quoted} < {said[0]}", *inner, f"{quoted} >= {said[-1]}", f"{quoted} IS NULL"]


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"{{ts '{value.isoformat(sep=' ')}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value.isoformat()}'}}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def write_jdbc(df: DataFrame, conf: JdbcConf, name: str, mode: str = "append") -> None:
    """B1: append (or ``mode``) rows to a table, columns matched by name."""
    df.write.format("jdbc").options(**_options(conf)).option("dbtable", name).mode(mode).save()


def _connect(spark: SparkSession, conf: JdbcConf):
    jvm = spark.sparkContext._jvm
    if conf.get("driver"):
        jvm.java.lang.Class.forName(conf["driver"])
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if conf.get(k):
            props.setProperty(k, conf[k])
    return jvm.java.sql.DriverManager.getConnection(conf["url"], props)


def _execute(spark: SparkSession, conf: JdbcConf, *statements: str) -> None:
    """Run statements on the driver in one transaction (none moves rows through it)."""
    con = _connect(spark, conf)
    try:
        con.setAutoCommit(False)
        for sql in statements:
            st = con.createStatement()
            st.executeUpdate(sql)
            st.close()
        con.commit()
    except Exception:
        con.rollback()
        raise
    finally:
        con.close()


def columns_of(spark: SparkSession, conf: JdbcConf, name: str) -> list[str] | None:
    """The columns of a table as the database spells them; None if there is no
    such table.  Any other error is raised."""
    con = _connect(spark, conf)
    try:
        meta = con.getMetaData()
        for spelled in dict.fromkeys((name, name.upper(), name.lower())):
            rows, found = meta.getColumns(None, None, spelled, None), []
            while rows.next():
                found.append(str(rows.getString("COLUMN_NAME")))
            rows.close()
            if found:
                return found
        return None
    finally:
        con.rollback() if not con.getAutoCommit() else None
        con.close()


def _sql_type(f: T.StructField) -> str:
    if isinstance(f.dataType, T.DecimalType):
        return f"DECIMAL({f.dataType.precision},{f.dataType.scale})"
    if isinstance(f.dataType, T.StringType):
        return f"VARCHAR({_TEXT.get(f.name, 255)})"
    return _TYPES[type(f.dataType)]


def create_tables(spark: SparkSession, conf: JdbcConf, names: Iterable[str] = REQUIRED_TABLES) -> list[str]:
    """A8 for databases: create the tables that are missing, with typed columns and
    an index on (stream_id, batch_id), by which a replay finds its rows."""
    made = []
    for name in names:
        if columns_of(spark, conf, name) is None:
            body = ", ".join(f'"{f.name}" {_sql_type(f)}' for f in TABLE_SCHEMAS[name].fields)
            _execute(spark, conf, f"CREATE TABLE {name} ({body})", f'CREATE INDEX {name}_batch ON {name} ("stream_id", "batch_id")')
            made.append(name)
    return made


def verify_tables(spark: SparkSession, conf: JdbcConf, required: Iterable[str] = REQUIRED_TABLES) -> dict[str, list[str]]:
    """A7 for databases: per required table the declared columns it lacks (all of
    them if it is missing); from metadata, without reading rows."""
    out = {}
    for name in required:
        have = {c.lower() for c in columns_of(spark, conf, name) or ()}
        out[name] = [f.name for f in TABLE_SCHEMAS[name].fields if f.name not in have]
    return out


def require_tables(spark: SparkSession, conf: JdbcConf, required: Iterable[str] = REQUIRED_TABLES) -> None:
    """Fail with the name of the first missing or incomplete table."""
    for name, missing in verify_tables(spark, conf, required).items():
        if missing:
            raise RuntimeError(f"required table {name} is missing or lacks columns {missing}")


def batch_time(spark: SparkSession, conf: JdbcConf, stream_id: str, batch_id: int, now: dt.datetime) -> dt.datetime:
    """The time of a batch: ``now`` when it is first seen, the same on a replay."""
    if columns_of(spark, conf, BATCHES_TABLE) is None:
        _execute(spark, conf, f'CREATE TABLE {BATCHES_TABLE} ("stream_id" VARCHAR(255), "batch_id" BIGINT, "seen" VARCHAR(40))')
    where = f""""stream_id" = '{stream_id}' AND "batch_id" = {int(batch_id)}"""
    ask = f'(SELECT "seen" FROM {BATCHES_TABLE} WHERE {where}) t'
    row = spark.read.format("jdbc").options(**_options(conf)).option("dbtable", ask).load().first()
    if row is None:
        _execute(spark, conf, f"INSERT INTO {BATCHES_TABLE} VALUES ('{stream_id}', {int(batch_id)}, '{now.isoformat()}')")
        return now
    return dt.datetime.fromisoformat(row[0])


def replace_batch(df: DataFrame, conf: JdbcConf, name: str, batch_id: int, stream_id: str = DEFAULT_STREAM) -> None:
    """Put ``df`` in the place of the rows that batch ``batch_id`` of ``stream_id``
    has in table ``name``.

    The executors write a staging table; one transaction then deletes the old
    rows and copies the new ones inside the database, so readers see the old
    batch or the new one, never a part.  A table without the two batch columns
    cannot be written safely again and is refused; columns it lacks otherwise
    are left out."""
    spark = df.sparkSession
    have = columns_of(spark, conf, name)
    if have is None:  # not one of the five: made from the frame, by Spark's types
        (df.filter(F.lit(False)).write.format("jdbc").options(**_options(conf)).option("dbtable", name)
         .option("createTableColumnTypes", "stream_id VARCHAR(255)").mode("append").save())
        have = columns_of(spark, conf, name)
    spelled = {c.lower(): c for c in have}
    if "batch_id" not in spelled or "stream_id" not in spelled:
        raise RuntimeError(f"table {name} has no batch_id and stream_id; add them, or a replayed batch would be stored twice")
    cols = [c for c in df.columns if c in spelled]
    stage = f"{name}_stage"
    write_jdbc(df.select(*cols), conf, stage, mode="overwrite")
    # Spark stores text in the database's type for long text; a value too long for the table is an error there.
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    into = ", ".join(f'"{spelled[c]}"' for c in cols)
    source = ", ".join(f'CAST("{c}" AS VARCHAR({LONGEST}))' if c in text else f'"{c}"' for c in cols)
    where = f""""{spelled['batch_id']}" = {int(batch_id)} AND "{spelled['stream_id']}" = '{stream_id}'"""
    _execute(spark, conf, f"DELETE FROM {name} WHERE {where}", f"INSERT INTO {name} ({into}) SELECT {source} FROM {stage}")
    _execute(spark, conf, f"DROP TABLE {stage}")


def write_jdbc_idempotent(df: DataFrame, conf: JdbcConf, name: str, batch_id: int, table_schema: str | None = None,
                          stream_id: str = DEFAULT_STREAM, batch_date: dt.date | None = None) -> None:
    """B5 for a database: conform ``df`` to the stored layout of ``name`` (or
    ``table_schema``) and replace the batch's rows (:func:`replace_batch`)."""
    out = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    layout = table_schema or name
    if columns_of(df.sparkSession, conf, name) is None and layout in TABLE_SCHEMAS and layout == name:
        create_tables(df.sparkSession, conf, [name])
    replace_batch(conform(out, layout, stream_id, batch_date), conf, name, batch_id, stream_id)
