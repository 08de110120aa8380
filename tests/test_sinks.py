import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes
from millrace.session import checkpoint_root
from millrace.sinks import checked, files, jdbc, kafka
from millrace.sources import feeds
from millrace.streaming import jobs
from tests.conftest import rows

CHANGES = "id string, v string, seq long, gone boolean"


def batch(spark, *data):
    return spark.createDataFrame(list(data), CHANGES)


def test_upsert_table(spark, tmp_path):
    table = files.UpsertTable(str(tmp_path / "dim"), ["id"], ["seq"], deleted="gone")
    with pytest.raises(ValueError):
        table.read(spark)
    table.create(spark, batch(spark).schema)
    assert table.read(spark).count() == 0
    table.write(batch(spark, ("1", "a", 1, False), ("1", "b", 2, False), ("2", "c", 3, False)), 0)
    table.create(spark, batch(spark).schema)
    assert rows(table.read(spark), "id", "v") == [("1", "b"), ("2", "c")]
    second = batch(spark, ("2", None, 5, True), ("3", "d", 6, False))
    table.write(second, 1)
    table.write(second, 1)  # replay
    want = [("1", "b"), ("3", "d")]
    assert rows(table.read(spark), "id", "v") == want
    table.compact(spark, 1)
    assert rows(table.read(spark), "id", "v") == want
    table.write(batch(spark, ("2", "old", 4, False), ("4", "e", 7, False)), 2)
    assert rows(table.read(spark), "id", "v") == want + [("4", "e")]
    table.compact(spark, 2)
    table.write(batch(spark, ("1", "z", 9, False)), 3)
    assert rows(table.read(spark), "id", "v") == [("1", "z"), ("3", "d"), ("4", "e")]
    assert "BroadcastHashJoin" in table.read(spark)._jdf.queryExecution().executedPlan().toString()


def test_by_topic_and_replay(spark, tmp_path):
    df = spark.createDataFrame([("t1", '{"a":1}'), ("t2", '{"a":2}')], "topic string, value string")
    for _ in range(2):
        files.by_topic(str(tmp_path))(df, 4)
    back = spark.read.json(str(tmp_path))
    assert rows(back, "topic", "value", "batch_id") == [("t1", '{"a":1}', 4), ("t2", '{"a":2}', 4)]


def test_dated_archive_append_and_many(spark, tmp_path):
    df = spark.createDataFrame([("x", "2021-01-01 10:00:00"), ("y", "2021-01-02 10:00:00")], "value string, t string")
    dated, plain = str(tmp_path / "dated"), str(tmp_path / "plain")
    files.to_many(files.dated(dated, "t", ["value"]), files.append(plain, ["t", "value"]))(df, 0)
    assert rows(spark.read.parquet(dated), "value", F.col("dt").cast("string")) == [("x", "2021-01-01"), ("y", "2021-01-02")]
    assert spark.read.parquet(plain + "/batch_id=0").columns == ["t", "value"]
    files.archive(str(tmp_path / "raw"))(df.select("value"), 0)
    assert rows(spark.read.text(str(tmp_path / "raw")), "value") == [("x",), ("y",)]


def dim(path, columns=("id", "a", "b"), **options):
    return files.UpsertTable(str(path), ["id"], ["batch", "seq"], image="image", columns=columns, **options)


def change_rows(spark, *data):
    return spark.createDataFrame(list(data), "id string, image map<string,string>, batch long, seq long")


def test_changes_set_only_the_columns_they_carry(spark, tmp_path):
    table = dim(tmp_path / "d")
    table.declare(spark)
    assert table.read(spark).count() == 0 and table.read(spark).columns == ["id", "a", "b", "batch", "seq"]
    table.write(change_rows(spark, ("1", {"id": "1", "a": "x", "b": "y"}, 0, 0), ("2", {"id": "2", "a": "p"}, 0, 1), ("2", {"b": "q"}, 0, 2)), 0)
    table.write(change_rows(spark, ("1", {"a": "z"}, 1, 0), ("2", {"a": None}, 1, 1)), 1)
    want = [("1", "z", "y"), ("2", None, "q")]
    assert rows(table.read(spark), "id", "a", "b") == want
    table.compact(spark, 1)
    assert rows(table.read(spark), "id", "a", "b") == want
    # a column added by configuration appears, for old rows without a value
    table.write(change_rows(spark, ("2", {"c": "new"}, 2, 0)), 2)
    wider = dim(tmp_path / "d", ("id", "a", "b", "c"))
    assert rows(wider.read(spark), "id", "a", "b", "c") == [("1", "z", "y", None), ("2", None, "q", "new")]


def test_unfinished_folders_are_not_read(spark, tmp_path):
    table = files.UpsertTable(str(tmp_path / "t"), ["id"], ["seq"])
    table.write(batch(spark, *[(str(k), "a", k, False) for k in range(10)]), 0)
    table.compact(spark, 0)
    table.write(batch(spark, ("3", "b", 20, False)), 1)
    # writers that have not finished: files are there, the mark is not
    for folder in ("snapshots/upto=5", "changes/batch_id=6"):
        batch(spark, ("0", "broken", 99, False)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_path}/t/{folder}")
    got = dict(rows(table.read(spark), "id", "v"))
    assert len(got) == 10 and got["3"] == "b" and got["0"] == "a"


def test_folders_stay_few(spark, tmp_path):
    table = files.UpsertTable(str(tmp_path / "t"), ["id"], ["seq"], compact_every=5)
    most = 0
    for k in range(36):
        table.write(batch(spark, (str(k % 4), f"v{k}", k, False)).coalesce(1), k)
        most = max(most, *(len(list((tmp_path / "t" / part).glob("*=*"))) for part in ("changes", "snapshots") if (tmp_path / "t" / part).exists()))
    assert most <= 11 and rows(table.read(spark), "id", "v") == [("0", "v32"), ("1", "v33"), ("2", "v34"), ("3", "v35")]


def test_kafka_options_and_messages(spark):
    assert feeds.kafka_options("h:1", "t", "g")["startingOffsets"] == "latest"
    assert feeds.kafka_options("h:1", "t", "g")["groupIdPrefix"] == "g"
    assert "topic" not in kafka.kafka_options("h:1") and kafka.kafka_options("h:1", "t")["topic"] == "t"
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert kafka.messages(df, "id").first().asDict() == {"key": "1", "value": '{"id":1,"v":"a"}'}
    assert kafka.messages(df).columns == ["value"]


def test_routed_messages(spark):
    df = spark.createDataFrame([("t", "insert", {"id": "1", "x": "2"})], "tableName string, type string, data map<string,string>")
    routes = spark.sql("SELECT 't' sourceTable, 'insert' operateType, 'kafka' sinkType, 'dwd' sinkTable, 'id' sinkColumns, "
                       "CAST(NULL AS STRING) sinkPk, CAST(NULL AS STRING) sinkExtend")
    assert rows(kafka.routed_messages(changes.route_by_config(df, routes))) == [("dwd", '{"id":"1"}')]


def test_jdbc_insert_orders_columns_and_drops_transients():
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen["options"] = options
            return self

        def mode(self, mode):
            seen["mode"] = mode
            return self

        def save(self):
            seen["saved"] = True

    class Batch:
        write = Writer()

        def select(self, *columns):
            seen["columns"] = columns
            return self

    jdbc.insert("jdbc:x", "stats", ["b", "a", "ids"], transient=["ids"], batch_size=5)(Batch(), 0)
    assert seen["columns"] == ("b", "a") and seen["mode"] == "append" and seen["saved"]
    assert seen["options"]["dbtable"] == "stats" and seen["options"]["batchsize"] == "5"


def test_checkpoint_folder_comes_from_the_session():
    class Session:
        def __init__(self, conf):
            self.conf = conf

    assert checkpoint_root(Session({"spark.checkpoint.dir": "/cluster/ck/"}), "/other") == "/cluster/ck"
    assert checkpoint_root(Session({}), "/shared/x/") == "/shared/x"
    with pytest.raises(ValueError):
        checkpoint_root(Session({}))


def test_bulk_write_reports_its_items(spark, tmp_path):
    """A null id and an oversized document are reported; the others of the batch are written, once."""
    docs = spark.createDataFrame(
        [("a", "x", 1), (None, "y", 2), ("b", "z" * 900, 3), ("c", None, 4), (None, "w" * 900, 5)], "doc_id string, `a.text` string, ts long")
    told = []
    table = files.UpsertTable(str(tmp_path / "t"), ["doc_id"], ["ts"])
    write = checked.reporting(table.write, files.append(str(tmp_path / "bad")), most_bytes=500, report=lambda n, c: told.append((n, c)))
    for _ in range(2):
        write(docs, 3)
    assert rows(table.read(spark), "doc_id") == [("a",), ("c",)]
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert rows(bad, "doc_id", "reason", "batch_id") == sorted([("b", "too large", 3), (None, "no id", 3), (None, "no id", 3)], key=str)
    assert sorted(r.document is None for r in bad.collect()) == [False, True, True]
    assert told == [(3, {"written": 2, "too large": 1, "no id": 2})] * 2
    write(docs.where("false"), 4)
    assert told[-1] == (4, {"written": 0})


def test_message_ids_as_headers(spark):
    sent = kafka.with_headers(spark.createDataFrame([("t", "v", "db/0/7")], "topic string, value string, message_id string"))
    assert sent.columns == ["topic", "value", "headers"]
    assert sent.select(kafka.message_id_of(F.col("headers"))).first()[0] == "db/0/7"
    assert sent.select(kafka.message_id_of(F.slice("headers", 1, 0))).first()[0] is None


def test_a_batch_sent_twice_is_read_once(spark, tmp_path):
    """Routed facts of a batch that failed after sending: the reader takes each change once."""
    line = lambda k: json.dumps({"database": "s", "tableName": "order_info", "type": "insert", "data": {"id": str(k % 3)}})
    source = spark.createDataFrame([(line(k), "db", k % 2, k // 2) for k in range(6)], "value string, topic string, partition int, offset long")
    routes = lambda: spark.sql(
        "SELECT 'order_info' sourceTable, 'insert' operateType, 'kafka' sinkType, 'dwd' sinkTable, 'id' sinkColumns, "
        "CAST(NULL AS STRING) sinkPk, CAST(NULL AS STRING) sinkExtend")
    sent = []

    def send(facts, batch_id):
        facts.write.json(f"{tmp_path}/sent/{len(sent)}")
        sent.append(batch_id)

    write = jobs.base_db_writer(routes, send, None, order="offset", position=["topic", "partition", "offset"])
    write(source, 0)
    write(source, 0)
    spark.createDataFrame([("dwd", "plain")] * 2, "topic string, value string").write.json(f"{tmp_path}/sent/2")
    stream = spark.readStream.schema("topic string, value string, message_id string").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/sent/*")
    read = kafka.once(stream.withColumn("timestamp", F.col("_metadata.file_modification_time")))
    query = jobs.start(read, files.append(str(tmp_path / "got")), checkpoint=str(tmp_path / "check"), every=None)
    assert query.awaitTermination(120) and not query.exception()
    got = spark.read.parquet(str(tmp_path / "got"))
    assert rows(got.where("message_id IS NOT NULL"), "message_id") == [(f"db/{k % 2}/{k // 2}",) for k in (0, 2, 4, 1, 3, 5)]
    assert got.where("message_id IS NULL").count() == 2
