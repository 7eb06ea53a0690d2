from pyspark.sql import functions as F

from lodestar import predict


def test_predict_on_a_stream(spark):
    src = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{src}/embeddings.parquet").schema
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "embeddings.parquet")
        .parquet(src)
        .select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"))
    )
    batch = spark.read.parquet(f"{src}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )
    centers = [list(r.features) for r in batch.orderBy("id").limit(4).collect()]
    q = predict(stream, centers).writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r.id: r.cid for r in spark.sql("SELECT id, cid FROM scored").collect()}
    want = {r.id: r.cid for r in predict(batch, centers).collect()}
    assert got == want and len(got) == batch.count()
