import datetime as dt

from pyspark.sql import functions as F

from heatline import schemas
from heatline.sources import files, messages, tables

ODD = ['say "hi", ok', "plain", "two\nlines, here", 'ends with "', "", "back\\slash, x", "é"]


def test_csv_round_trip_keeps_quotes_commas_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(ODD)], schemas.MESSAGES)
    files.write_csv(df, str(tmp_path / "out"))
    got = files.read_csv(spark, str(tmp_path / "out"), schemas.MESSAGES).orderBy("timestamp")
    # an empty text is stored as such but reads as NULL
    assert [r.text for r in got.collect()] == [t or None for t in ODD]


def test_csv_written_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('timestamp,text\n1,"a ""quoted"", word"\n2,b\n')
    got = files.read_csv(spark, str(path), schemas.MESSAGES).orderBy("timestamp").collect()
    assert [r.text for r in got] == ['a "quoted", word', "b"]


def test_malformed_rows_are_dropped(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("timestamp,prediction\n1,0.5\n2,abc\n3,1.5\n")
    got = files.read_csv(spark, str(path), schemas.SERIES)
    assert sorted(r.prediction for r in got.collect()) == [0.5, 1.5]


def test_legacy_encoding(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("timestamp,text\n1,déjà vu\n".encode("latin-1"))
    assert files.read_legacy_csv(spark, str(path), schemas.MESSAGES).first().text == "déjà vu"


def test_corpus_leaves_out_its_own_output(spark, tmp_path):
    for name, rows in [("tweets_a.csv", "1,a,0.1\n"), ("tweets_b.csv", "2,b,0.2\n3,c,x\n"),
                       ("timeseries.csv", "9,no,0\n"), ("tweets_training.csv", "1,a,10\n")]:
        (tmp_path / name).write_text("timestamp,text,toxicity\n" + rows)
    got = files.read_corpus(spark, str(tmp_path), schemas.SCORED_MESSAGES)
    assert sorted(r.text for r in got.collect()) == ["a", "b", "c"]
    assert got.columns == ["timestamp", "text", "toxicity"]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(5)
    for batch in (0, 1, 1, 0):
        tables.write_batch(df, path, batch)
    assert tables.read_table(spark, path).count() == 10


def test_append_table(spark):
    spark.sql("DROP TABLE IF EXISTS appended")
    for _ in range(2):
        tables.append_table(spark.range(3), "appended")
    assert spark.table("appended").count() == 6


def test_read_series_is_pushed_down(spark, tables_folder="/root/testdata/sf0.001"):
    df = tables.read_series(spark.read.parquet(f"{tables_folder}/orders.parquet"),
                            "o_orderpriority", ["5-LOW"], "o_orderdate", "1996-01-01", "1996-12-31",
                            ["o_orderdate", "o_totalprice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plan and "EqualTo" in plan
    assert "o_custkey" not in plan


def test_messages_to_and_from_json(spark):
    stamp = dt.datetime(2019, 4, 18, 10, 31, 30)
    df = spark.createDataFrame([(stamp, 'a "b"')], "timestamp timestamp_ntz, text string")
    values = messages.to_values(df)
    assert values.first().value == '{"timestamp":"2019-04-18 10:31:30","text":"a \\"b\\""}'
    broken = spark.createDataFrame([("{oops",), ('{"text":"no time"}',)], "value string")
    parsed = messages.parse_messages(values.unionAll(broken))
    got = messages.readable(parsed).collect()
    assert [(r.timestamp, r.text) for r in got] == [(stamp, 'a "b"')]
    assert messages.unreadable(parsed).count() == 2
    binary = messages.parse_messages(values.select(F.encode("value", "UTF-8").alias("value")))
    assert messages.readable(binary).count() == 1


def test_kafka_options():
    got = messages.kafka_options("host:1", "politics", **{"security.protocol": "SSL"})
    assert got == {"kafka.bootstrap.servers": "host:1", "subscribe": "politics",
                   "startingOffsets": "latest", "kafka.security.protocol": "SSL"}


def test_a_series_file_is_read_in_its_order(spark, tmp_path):
    rows = spark.createDataFrame([(30, "3.5"), (-5, "1.5"), (7, "n/a"), (8, "2.5"), (None, "9")],
                                 "position bigint, prediction string")
    files.write_series(rows.repartition(3), str(tmp_path / "s"))
    got = files.read_series(spark, str(tmp_path / "s")).orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(0, 1.5), (1, 2.5), (2, 3.5)]


def test_legacy_files_hold_one_byte_a_letter(spark, tmp_path):
    schema = "id string, text string"
    df = spark.createDataFrame([("1", 'Ñandú "ß", ÿ'), ("2", "日本 – ok"), ("3", None)], schema)
    files.write_legacy_csv(df, str(tmp_path / "l"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "l").glob("part-*")))
    assert "Ñandú".encode("latin-1") in raw and b"?? ? ok" in raw
    got = {r.id: r.text for r in files.read_legacy_csv(spark, str(tmp_path / "l"), df.schema).collect()}
    assert got == {"1": 'Ñandú "ß", ÿ', "2": "?? ? ok", "3": None}
