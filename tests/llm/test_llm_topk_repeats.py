import random

from pyspark.sql import functions as F

from burnlens.llm import topk


def test_repeated_query_ids_do_not_depend_on_the_blocks(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(40)] + [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(0, 40, 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    one, many = (sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 4 == 0, block_queries=n).collect())) for n in (1024, 4))
    assert one == many
    assert len({r[:2] for r in many}) == len(many)  # each rank once
