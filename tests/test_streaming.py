from storyloom.config import Params
from storyloom.operators import copypaste, stories
from storyloom.streaming import online

BODY = "the same long text of two outlets 0123456789"


def test_flag_arrivals(spark, tmp_path):
    rows = [(1, BODY, "a", 1000, "x"), (2, "quite another text 987654321", "a", 1000, "x")], [(3, BODY, "b", 2000, "x")]
    kinds = "id long, content string, media_name string, published_at long, origin string"
    for k, part in enumerate(rows):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(kinds).parquet(f"{tmp_path}/in")
        online.flag_arrivals(stream, f"{tmp_path}/out").awaitTermination(120)
    got = {r.id: r.copypaste_rule for r in spark.read.parquet(f"{tmp_path}/out/flags").collect()}
    every = spark.createDataFrame(rows[0] + rows[1], kinds)
    assert got == {r.id: r.copypaste_rule for r in copypaste.flags(every).collect()} and got[3] == "earlier_cross_outlet"


def test_cluster_arrivals(spark, tmp_path):
    kinds = "id long, vec array<double>, published_at long, shard string"
    parts = [(1, [1.0, 0.0], 1, "s"), (2, [0.0, 1.0], 2, "s")], [(3, [0.9, 0.1], 3, "s"), (4, [1.0, 0.0], 4, "t")]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = online.cluster_arrivals(spark.readStream.schema(kinds).parquet(f"{tmp_path}/in"), "shard")
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    got = {r.id: r.cluster_id for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    every = spark.createDataFrame(parts[0] + parts[1], kinds)
    assert got == {r.id: r.cluster_id for r in stories.online_clusters(every, "shard", Params()).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}
