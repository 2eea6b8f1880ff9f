"""python tests/llm/recall.py N...: recall of the neighbour search at larger sizes, against brute force.

The vectors are noisy copies of those of the given table, derived by Spark.
"""

import os
import sys
import time

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from waybill.llm import neighbours  # noqa: E402
from waybill.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.1"


def main(sizes):
    spark = build_session("recall", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g", spark__sql__shuffle__partitions="16")
    given = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").dropna()
    n = given.count()
    for size in sizes:
        copies = given.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(-(-size // n) - 1))))
        noise = lambda v, i: v + (F.xxhash64("vec_id", "copy", i) % 1000) / 1000.0 * 0.05
        table = copies.select((F.col("copy") * 1_000_000 + F.col("vec_id")).alias("vec_id"), F.transform("embedding", noise).alias("embedding"))
        path = f"{spark.conf.get('spark.checkpoint.dir', '/tmp')}/recall-{time.time():.0f}"
        table.write.parquet(path)
        table = spark.read.parquet(path)
        began = time.time()
        rows = neighbours.nearest(table, lambda v: v % 50 == 0).collect()
        took = time.time() - began
        data = table.toPandas()
        ids, x = data.vec_id.to_numpy(), np.array(data.embedding.tolist())
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        got = {}
        for r in rows:
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        asked = np.flatnonzero(ids % 50 == 0)
        hits = 0
        for i in asked:
            near = x @ x[i]
            near[i] = -2
            hits += len(set(ids[np.argpartition(-near, 5)[:5]]) & got.get(ids[i], set()))
        print(f"{len(ids)} vectors, {len(asked)} queries: recall@5 {hits / 5 / len(asked):.4f}, {took:.0f} s", flush=True)


main([int(a) for a in sys.argv[1:]])
