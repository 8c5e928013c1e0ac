"""Thin builders for outside systems; each needs its Spark package or server and is otherwise only options."""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], start: str = "latest") -> DataFrame:
    """A stream of Kafka records from some topics."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", start).load()


def kafka_sink(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None):
    """Write value (and topic, unless one is fixed) to Kafka, at least once."""
    w = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
    return (w.option("topic", topic) if topic else w).start()


def jdbc_rules(spark: SparkSession, url: str, jobs: list[str] | None = None, rules: str = "tag_conf", **options) -> DataFrame:
    """The rule table over JDBC, of some jobs only if given; the filter is pushed to the database."""
    df = spark.read.format("jdbc").options(url=url, dbtable=rules, **options).load()
    return df.where(F.col("task_name").isin(jobs)) if jobs else df


def _quoted(meta, name: str) -> str:
    q = meta.getIdentifierQuoteString()
    return ".".join(f"{q}{part}{q}" for part in name.split("."))


def _there(connection, name: str) -> bool:
    """Whether the database has a table of this name, as it spells names that are not quoted or as written."""
    meta = connection.getMetaData()
    plain = name.rpartition(".")[2]
    return any(meta.getTables(None, None, n, None).next() for n in (plain, plain.upper(), plain.lower()))


LEDGER = "sensorloom_batches"


def jdbc_batches(url: str, target: str, query: str = "default", ledger: str = LEDGER, **options) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that adds each batch to ``target`` exactly once.

    Tasks write the batch in parallel to a table of its own beside the target; one transaction then moves its rows and
    notes (``query``, batch id) in ``ledger``. A batch that is noted is passed over, one that failed before has left
    nothing in the target. ``query`` names the stream: two streams may share a target. Names are created and used quoted.
    """
    if not all(re.fullmatch(r"\w+(\.\w+)?", n) for n in (target, ledger)):
        raise ValueError("target and ledger must be plain names")

    def write(df: DataFrame, batch_id: int) -> None:
        jvm = df.sparkSession._jvm
        properties = jvm.java.util.Properties()
        for k, v in options.items():
            properties.setProperty(k, str(v))
        if "driver" in options:
            jvm.java.lang.Class.forName(options["driver"])
        to = lambda table: {"batchsize": 10_000, **options, "url": url, "dbtable": table}
        connection = jvm.java.sql.DriverManager.getConnection(url, properties)
        try:
            meta = connection.getMetaData()
            staging = f"{target}_batch_{batch_id}"
            name = {n: _quoted(meta, n) for n in (target, ledger, staging)}
            cells = ", ".join(_quoted(meta, c) for c in df.columns)
            run = connection.createStatement()
            if not _there(connection, ledger):
                run.executeUpdate(f"CREATE TABLE {name[ledger]} (query_name VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, PRIMARY KEY (query_name, batch_id))")
            noted = connection.prepareStatement(f"SELECT 1 FROM {name[ledger]} WHERE query_name = ? AND batch_id = ?")
            noted.setString(1, query)
            noted.setLong(2, batch_id)
            if noted.executeQuery().next():
                return
            if not _there(connection, target):
                df.limit(0).write.format("jdbc").options(**to(name[target])).mode("append").save()
            df.write.format("jdbc").options(**to(name[staging])).mode("overwrite").save()
            connection.setAutoCommit(False)
            try:
                run.executeUpdate(f"INSERT INTO {name[target]} ({cells}) SELECT {cells} FROM {name[staging]}")
                note = connection.prepareStatement(f"INSERT INTO {name[ledger]} VALUES (?, ?)")
                note.setString(1, query)
                note.setLong(2, batch_id)
                note.executeUpdate()
                connection.commit()
            except Exception:
                connection.rollback()
                raise
            run.executeUpdate(f"DROP TABLE {name[staging]}")
            connection.commit()
        finally:
            connection.close()

    return write


def micro_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "1 second"):
    """Start a query that hands what came in each interval to ``write``; without ``every`` it ends when all is read."""
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function whose batches have folders of their own, so that a repeated batch replaces itself."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def http_rows(url: str, fetch: Callable[[str], str] | None = None) -> list[str]:
    """The elements of a JSON array behind a URL, as JSON texts; ``fetch`` stands in for HTTP in tests."""
    def get(u: str) -> str:
        with urllib.request.urlopen(u, timeout=10) as r:
            return r.read().decode()

    return [json.dumps(x) for x in json.loads((fetch or get)(url))]


def http_table(spark: SparkSession, url: str, schema: str, fetch=None) -> DataFrame:
    """One poll of a JSON array as a DataFrame."""
    texts = spark.createDataFrame([(x,) for x in http_rows(url, fetch)], "value string")
    return texts.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")


def post_rows(df: DataFrame, send: Callable[[str, str], int] | None = None, pool: int = 20, tries: int = 3, timeout: float = 10.0) -> DataFrame:
    """(url, body) -> url, body, status, tries: POST every row, some at a time per task; -1 where all tries failed."""
    def post(url: str, body: str) -> int:
        req = urllib.request.Request(url, body.encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(req, timeout=timeout) as r:
            return r.status

    def one(row):
        for k in range(1, tries + 1):
            try:
                return (send or post)(*row), k
            except OSError:
                if k < tries:
                    time.sleep(0.1 * 2**k)
        return -1, tries

    def work(batches):
        with ThreadPoolExecutor(pool) as threads:
            for pdf in batches:
                done = list(threads.map(one, zip(pdf.url, pdf.body)))  # in the order of the rows
                yield pdf.assign(status=[s for s, _ in done], tries=[k for _, k in done])

    return df.select("url", "body").mapInPandas(work, "url string, body string, status int, tries int")


def post_batches(path: str, send: Callable[[str, str], int] | None = None, **how) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that posts each batch's rows (url, body) and keeps what became of them.

    Every row stands with its status under ``path``/posted/batch=number, written once all rows of the batch have been
    tried; a batch that stands there is not posted again. A batch that failed on its way is posted anew, so a receiver may
    see a row twice but no row is left out. ``dead_letters`` are the rows that no try got through (D20).
    """
    def write(df: DataFrame, batch_id: int) -> None:
        if (batch_id,) not in _whole(df.sparkSession, f"{path}/posted", "batch=*"):
            post_rows(df, send, **how).write.mode("overwrite").parquet(f"{path}/posted/batch={batch_id}")

    return write


POSTED = "url string, body string, status int, tries int"


def _whole(spark: SparkSession, path: str, pattern: str) -> list[tuple[int, ...]]:
    """The numbers in the names of the folders under ``path`` that match ``pattern`` (batch=*) and have been written to their end."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    deep = pattern.count("/") + 1
    return sorted(tuple(int(p.partition("=")[2]) for p in x.getPath().getParent().toString().split("/")[-deep:]) for x in found or [])


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """url, body, status, tries of all rows under ``path`` that were not accepted, by the last try at each."""
    batches, rounds = _whole(spark, f"{path}/posted", "batch=*"), _whole(spark, f"{path}/reposted", "round=*/upto=*")
    number, upto = rounds[-1] if rounds else (-1, -1)
    folders = [f"{path}/posted/batch={b}" for (b,) in batches if b > upto] + [f"{path}/reposted/round={number}/upto={upto}"] * bool(rounds)
    if not folders:
        return spark.createDataFrame([], POSTED)
    return spark.read.schema(POSTED).parquet(*folders).where("status is null or status not between 200 and 299")


def repost(spark: SparkSession, path: str, send: Callable[[str, str], int] | None = None, **how) -> DataFrame:
    """Post the dead letters again; gives those that are left."""
    batches, rounds = _whole(spark, f"{path}/posted", "batch=*"), _whole(spark, f"{path}/reposted", "round=*/upto=*")
    if batches:
        dead = dead_letters(spark, path)  # of the batches up to this one, whatever comes meanwhile
        post_rows(dead, send, **how).write.mode("overwrite").parquet(f"{path}/reposted/round={rounds[-1][0] + 1 if rounds else 0}/upto={batches[-1][0]}")
    return dead_letters(spark, path)


def generated(spark: SparkSession, tags: list[str], per_second: int = 1) -> DataFrame:
    """An endless stream of random values, ``per_second`` a tag."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second * len(tags)).load()
    name = F.element_at(F.array(*[F.lit(t) for t in tags]), (F.col("value") % len(tags) + 1).cast("int"))
    return rate.select(name.alias("name"), F.col("timestamp").alias("ts"), F.floor(F.pmod(F.xxhash64("value"), F.lit(800))).cast("decimal(18,4)").alias("value"), F.col("value").alias("seq"))


class HttpPolls(DataSource):
    """``spark.readStream.format("http_polls")``: a JSON array behind the option ``url``, read once a micro-batch.

    Each element is a row with its JSON text in ``value``; the trigger's interval is the polling interval. A poll that
    fails brings no rows. What a poll brought is written to the folder in the option ``store`` before its offset is told,
    so a micro-batch that is repeated, by a new process too, brings the rows that it brought before; the folder belongs
    to one query, as its checkpoint does.
    """

    @classmethod
    def name(cls) -> str:
        return "http_polls"

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema):
        return _Polls(self.options["url"], self.options["store"])


class _Polls(SimpleDataSourceStreamReader):
    def __init__(self, url: str, store: str, fetch: Callable[[str], str] | None = None):
        from pyarrow import fs

        self.url, self.fetch = url, fetch
        self.files, self.root = fs.FileSystem.from_uri(store if "://" in store else f"file://{store}")
        self.files.create_dir(self.root, recursive=True)

    def _path(self, poll: int) -> str:
        return f"{self.root}/{poll:012d}.json"

    def _kept(self, poll: int) -> list[tuple] | None:
        """The rows of a poll that is in the store."""
        from pyarrow import fs

        if self.files.get_file_info(self._path(poll)).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(self._path(poll)) as f:
            return [(x,) for x in json.loads(f.read().decode())]

    def _keep(self, poll: int, texts: list[str]) -> None:
        with self.files.open_output_stream(f"{self._path(poll)}.tmp") as f:
            f.write(json.dumps(texts).encode())
        self.files.move(f"{self._path(poll)}.tmp", self._path(poll))  # whole or not there

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def read(self, start: dict):
        rows = self._kept(start["poll"])  # kept by a process that ended before it could tell the offset
        if rows is None:
            try:
                texts = http_rows(self.url, self.fetch)
            except OSError:
                texts = []
            if not texts:
                return iter([]), start
            self._keep(start["poll"], texts)
            rows = [(x,) for x in texts]
        return iter(rows), {"poll": start["poll"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict):
        found = [(k, self._kept(k)) for k in range(start["poll"], end["poll"])]
        lost = [k for k, rows in found if rows is None]
        if lost:
            raise OSError(f"polls {lost} are not in the store {self.root}")
        return iter([r for _, rows in found for r in rows])

    def commit(self, end: dict) -> None:
        """Polls before ``end`` are never asked for again."""
        from pyarrow import fs

        for x in self.files.get_file_info(fs.FileSelector(self.root)):
            if x.base_name.endswith(".json") and int(x.base_name[:-5]) < end["poll"]:
                self.files.delete_file(x.path)


def http_stream(spark: SparkSession, url: str, schema: str, store: str) -> DataFrame:
    """The polled rows of a JSON array as a stream; elements that don't fit the schema go. ``store``: see HttpPolls."""
    spark.dataSource.register(HttpPolls)
    texts = spark.readStream.format("http_polls").option("url", url).option("store", store).load()
    return texts.select(F.from_json("value", schema).alias("r")).where("r is not null").select("r.*")


def create_rule_tables(spark: SparkSession, conf: DataFrame, column: str = "sink_table") -> list[str]:
    """The result tables that online rules name, each made if it is not there yet; a name that is no plain one raises."""
    names = sorted(r[0] for r in conf.where(F.col(column).isNotNull() & (F.col("status") == 1)).select(column).distinct().collect())
    bad = [n for n in names if not re.fullmatch(r"\w+(\.\w+)?", n)]
    if bad:
        raise ValueError(f"not a table's name: {bad}")
    for n in names:
        create_result_table(spark, n)
    return names


def create_result_table(spark: SparkSession, name: str) -> None:
    """The table of results, if it is not there yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (out_name STRING, tag_topic STRING, value DOUBLE, calculate_time TIMESTAMP, calculate_type STRING, calculate_params STRING, job_name STRING, line_id INT) USING parquet")
