import os

from tessera.operators import text as T
from tessera.streaming.terms import running_term_frequency, stream_lines


def test_stream_counts_match_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("Ba,Na:Na.123 banana 42\napple Apple\n")
    with open(os.path.join(src, "b.txt"), "w") as fh:
        fh.write("banana cherry\n")
    q = (running_term_frequency(stream_lines(spark, src)).writeStream.outputMode("complete")
         .format("memory").queryName("tf_stream")
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
    try:
        q.processAllAvailable()
        got = {r["term"]: r["tf"] for r in spark.sql("SELECT * FROM tf_stream").collect()}
    finally:
        q.stop()
    batch = {r["term"]: r["tf"] for r in T.term_frequency(spark.read.text(src), text="value").collect()}
    assert got == batch == {"banana": 3, "apple": 2, "cherry": 1}
