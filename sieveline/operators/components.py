"""Connected components by local union-find and alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.session import compacted, remove, shared_path

#: Edges that one local union-find holds.
LOCAL_EDGES = 200_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of each LOCAL_EDGES as stars on the smallest node of their local components."""
    parent: dict = {}
    seen = 0

    def find(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def stars(schema: pa.Schema) -> pa.RecordBatch:
        pairs = [(x, find(x)) for x in list(parent)]
        out = [(x, top) for x, top in pairs if x != top]
        columns = zip(*out, strict=True) if out else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        seen += batch.num_rows
        if seen >= LOCAL_EDGES:
            yield stars(schema)
            parent.clear()
            seen = 0
    if schema is not None:
        yield stars(schema)


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 100) -> DataFrame:
    """Rows (node, root) for every node of ``edges``; root is the smallest node it reaches.

    Each round first contracts the edges a task holds, then makes large and small stars: two
    aggregations with map-side combine and two joins that adaptive execution can split at a hub, so
    no neighbourhood is ever gathered in one task. Rounds end when all edges are stars; each is
    written to the shared folder, and the driver sees only counts. What contraction leaves is
    finished in one task once it is no more than LOCAL_EDGES edges. Null ends and self loops are
    dropped; no edges give no rows. The number of rounds grows with the logarithm of the longest
    chain.
    """
    spark = edges.sparkSession

    def settle(df: DataFrame, local: bool = True) -> tuple[DataFrame, str]:
        path = shared_path(spark, "components")
        proper = df.where("u is not null and v is not null and u <> v")
        compacted((proper.mapInArrow(_contract, df.schema) if local else proper).distinct()).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    def settled(df: DataFrame) -> bool:
        """Whether each node points to one other that points to none."""
        if done:
            return True
        ends = df.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(df.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in")))
        each = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
        return each.where("out > 1 or out = 1 and in = 1").limit(1).count() == 0

    done = False
    now, path = settle(edges.select(F.col(u).alias("u"), F.col(v).alias("v")))
    for _ in range(max_rounds):
        if now.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES:
            last = shared_path(spark, "components")
            now.coalesce(1).mapInArrow(_contract, now.schema).write.parquet(last)
            remove(spark, path)
            now, path, done = spark.read.schema(now.schema).parquet(last), last, True
        if settled(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, middle = settle(large, local=False)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = down.join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, after_path = settle(small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))))
        remove(spark, middle)
        remove(spark, path)
        now, path = after, after_path
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
