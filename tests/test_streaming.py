from citeloom.streaming.ingest import append_mentions, read_documents


def test_stream_appends_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    doc = lambda i: spark.createDataFrame([("SCC", i, f"2020 SCC {i}", 2020, f"see Beacon v. Dune, [1999] 2 S.C.R. {i}.")], "court string, corpus_row_index long, citation string, year int, text string")
    for i in (1, 2):
        doc(i).write.mode("append").parquet(src)
        append_mentions(read_documents(spark, src), out, mark).awaitTermination()
    got = spark.read.parquet(out).where("shape_name = 'shape_bracket'")
    assert sorted(r.raw_string for r in got.collect()) == ["[1999] 2 S.C.R. 1", "[1999] 2 S.C.R. 2"]
