from streamloom.operators.sessions import SessionTable, sessions
from streamloom.streaming import session_counts, session_sink, windowed_counts

D = "/root/testdata/sf0.001"


def test_stream_and_batch_sessions_agree(spark, tmp_path):
    ev = spark.read.parquet(f"{D}/events.parquet").select("user_id", "ts").repartition(3)
    ev.write.parquet(str(tmp_path / "in"))
    batch = {tuple(r) for r in session_counts(ev, ["user_id"], "ts", "6 hours").collect()}
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in"))
    q = session_counts(stream, ["user_id"], "ts", "6 hours", "400 days").writeStream.format("memory").queryName("ses").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("ses").collect()} == batch
    assert windowed_counts(ev, "user_id", "ts", "1 day").count() > 0


def test_micro_batches_feed_the_session_table(spark, tmp_path):
    rows = spark.createDataFrame([("a", t, t + 2, 1) for t in (0, 5, 40, 44, 22)], "k string, s long, e long, n long")
    for n, (lo, hi) in enumerate([(0, 10), (40, 50), (20, 30)]):
        rows.where(f"s >= {lo} and s < {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = SessionTable.create(spark, ["k"], "s", "e", 20, {"n": "sum"})
    q = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).writeStream.foreachBatch(session_sink(table)).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    want = sorted(map(tuple, sessions(rows, ["k"], "s", "e", 20, {"n": "sum"}).collect()))
    assert sorted(map(tuple, table.read().collect())) == want
    session_sink(table)(rows, 1)  # delivered again
    assert sorted(map(tuple, table.read().collect())) == want
