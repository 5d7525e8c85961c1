"""Streaming cleaning over a folder of parquet pairs (available-now trigger)."""

from bitext.streaming.cleaning import clean_pairs_stream, start_parquet_sink


def test_stream_cleaning(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(0, "_Open  file", "Abrir archivo"), (1, "OK", "OK"), (2, "EspaÃ±a is here", "España está aquí")]
    spark.createDataFrame(rows, "line_no long, source string, target string").write.parquet(src)
    stream = spark.readStream.schema("line_no long, source string, target string").parquet(src)
    out = str(tmp_path / "out")
    q = start_parquet_sink(clean_pairs_stream(stream), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = sorted((r.line_no, r.source, r.target) for r in spark.read.parquet(out).collect())
    assert got == [(0, "Open file", "Abrir archivo"), (2, "España is here", "España está aquí")]


def test_stream_dedup_within_watermark(spark, tmp_path):
    import datetime as dt
    src = str(tmp_path / "in2")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, "Open the file", "Abrir el archivo", t0), (1, "Open the file", "Abrir el archivo", t0),
            (2, "Save it now", "Guardalo ahora", t0)]
    spark.createDataFrame(rows, "line_no long, source string, target string, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("line_no long, source string, target string, ts timestamp").parquet(src)
    out = str(tmp_path / "out2")
    q = start_parquet_sink(clean_pairs_stream(stream, event_time="ts", watermark="1 hour"), out,
                           name="dedup_test", checkpoint=str(tmp_path / "ckpt2"))
    q.awaitTermination(120)
    got = sorted((r.source, r.target) for r in spark.read.parquet(out).collect())
    assert got == [("Open the file", "Abrir el archivo"), ("Save it now", "Guardalo ahora")]
