"""A keyed Parquet table with atomic upserts.

Rows live in hash buckets of their key.  An upsert reads only the buckets its
source touches, merges them, writes them as a new version and then replaces a
small pointer file that lists, per bucket, which version is current.  Readers
follow the pointer, so they see the old state or the new one, never a mix, and
a lost executor or a failed job leaves the table as it was.  One writer at a
time is assumed, as with any MERGE on a plain file table, and a file system
whose rename replaces a file in one step.

A batch rewrites the buckets it touches, which for random keys are all of
them: choose the number of buckets by the size of the table, not by the number
of cores.  Several tasks share a bucket in reading, merging and writing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog.operators.upsert import merge
from clipcatalog.sources.session import landed

BUCKET = "_bucket"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: dict[str, Callable] | list[str],
                 buckets: int):
        """``keys``: key column names, or name -> function of a column picker
        for keys that are computed (see ``merge``).  ``buckets`` is stored with the
        first write; opening the table with another number is an error."""
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path, schema, keys, buckets

    # -- pointer file, kept on the same file system as the data ---------------

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _pointer(self) -> dict:
        jvm, fs = self._fs()
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current.json")
        if not fs.exists(where):
            return {"batch": -1, "number": self.buckets, "buckets": {}}
        stream = fs.open(where)
        try:
            state = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if state["number"] != self.buckets:
            raise ValueError(f"the table has {state['number']} buckets, not {self.buckets}")
        return state

    def _publish(self, state: dict) -> None:
        jvm, fs = self._fs()
        hpath = jvm.org.apache.hadoop.fs.Path
        temp = hpath(f"{self.path}/_current-{uuid.uuid4().hex}.tmp")
        stream = fs.create(temp, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(temp, hpath(f"{self.path}/_current.json"), overwrite)

    # -- reading and writing ------------------------------------------------------

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        return self._read([f"{self.path}/{v}" for v in self._pointer()["buckets"].values()])

    def last_batch(self) -> int:
        return self._pointer()["batch"]

    def _key_columns(self) -> list[Column]:
        def pick(name: str) -> Column:
            return F.col(name)

        if isinstance(self.keys, dict):
            return [build(pick) for build in self.keys.values()]
        return [F.col(k) for k in self.keys]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._key_columns()), F.lit(self.buckets)).cast("int")

    def read_beside(self, source: DataFrame) -> DataFrame:
        """The rows of those buckets that keys of ``source`` fall into."""
        hit = source.select(self._bucket().alias(BUCKET)).distinct().collect()  # at most one row per bucket
        return self._buckets_of(self._pointer(), [r[BUCKET] for r in hit])

    def _buckets_of(self, state: dict, numbers: list[int]) -> DataFrame:
        return self._read([f"{self.path}/{state['buckets'][str(b)]}" for b in sorted(numbers)
                           if str(b) in state["buckets"]])

    def merged(self, touched: list[int], source: DataFrame, rules: dict | None = None, inserts: dict | None = None,
               default_rule: Callable | None = None) -> DataFrame:
        """The rows of the touched buckets after an upsert.

        A full outer join, which Spark never broadcasts: a stream merges many batches, and each
        broadcast would pass a whole batch through the driver.
        """
        return merge(self._buckets_of(self._pointer(), touched), source, self.keys, rules, inserts, default_rule)

    def upsert(self, source: DataFrame, rules: dict | None = None, inserts: dict | None = None,
               default_rule: Callable | None = None, batch: int | None = None) -> bool:
        """Merge a source that is unique on the key; False for a replayed batch.

        The source is written to the shared folder first: the check for repeated
        keys and the merge see the same rows, also after executors are lost.
        """
        state = self._pointer()
        if batch is not None and batch <= state["batch"]:
            return False
        # only the table's columns; an untyped NULL column takes the table's type
        types = {f.name: f.dataType for f in self.schema}
        source = landed(source.select(*[
            F.col(f.name).cast(types[f.name]) if isinstance(f.dataType, T.NullType) else F.col(f.name)
            for f in source.schema if f.name in types
        ]), "upsert")
        keys = {f"_key{i}": c for i, c in enumerate(self._key_columns())}
        per_key = source.select(self._bucket().alias(BUCKET), *[c.alias(n) for n, c in keys.items()]).groupBy(
            BUCKET, *keys).agg(F.count(F.lit(1)).alias("_n"))
        repeated = F.col("_n") > 1
        for name in keys:  # a NULL key matches nothing, so it may repeat
            repeated = repeated & F.col(name).isNotNull()
        # one row per bucket
        found = per_key.groupBy(BUCKET).agg(F.count_if(repeated).alias("_repeated")).collect()
        if any(r["_repeated"] for r in found):
            raise ValueError("the source of an upsert must hold each key once")
        touched = [r[BUCKET] for r in found]
        if touched:
            merged = self.merged(touched, source, rules, inserts, default_rule)
            version = f"v-{uuid.uuid4().hex}"
            (
                # brings a bucket's rows together, and adaptive execution cuts large buckets into several tasks
                merged.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
                .write.partitionBy(BUCKET).parquet(f"{self.path}/{version}")
            )
            state["buckets"].update({str(b): f"{version}/{BUCKET}={b}" for b in touched})
        if batch is not None:
            state["batch"] = batch
        self._publish(state)
        return True
