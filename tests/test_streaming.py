import random

from seqloom import streaming
from seqloom.operators import kmers, search


def test_annotated_stream_equals_batch(spark, tmp_path):
    rng = random.Random(1)
    refs = [(i, "".join(rng.choice("ACGT") for _ in range(800))) for i in range(4)]
    asked = [(100 + i, refs[i % 4][1][50:600]) for i in range(6)]
    sketch = kmers.bit_sketch(spark.createDataFrame(refs, "entity bigint, seq string"), 2048, 11).withColumnRenamed("entity", "ref").cache()
    labels = spark.createDataFrame([(i, f"species {i}") for i in range(4)], "ref bigint, species string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(asked, "entity bigint, seq string").repartition(2)
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    streaming.annotate_stream(stream, sketch, labels, out, str(tmp_path / "check"), 2048, 11).awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(out).drop("batch").collect()}
    want = {tuple(r) for r in search.annotate(kmers.bit_sketch(df, 2048, 11), sketch, labels).collect()}
    assert got == want and len(got) == 6 and all(r[1] == (r[0] - 100) % 4 for r in got)


def test_windows_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source = str(tmp_path / "in")
    events.write.parquet(source)
    stream = streaming.telemetry_windows(spark.readStream.schema(events.schema).parquet(source))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {tuple(r) for r in spark.table("windows").collect()} == {tuple(r) for r in streaming.telemetry_windows(events).collect()}
