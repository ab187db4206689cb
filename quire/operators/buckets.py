"""Tables in key buckets with a manifest: a merge rewrites the buckets that its rows touch and no others.

A table is a folder with data files and manifests numbered by version; a manifest names, for each bucket, the folder that holds its rows.
A merge writes the touched buckets into new folders first and a new manifest last, so one that fails leaves the table as it
was, and readers of an older version keep their files until `vacuum`.  Two merges that run at once do not both win: a version is
written only where it is not there yet.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources import stores


def versions(path: str) -> list[int]:
    return sorted(int(name[9:-5]) for name in stores.sizes(path, ".json") if name.startswith("manifest-"))


def manifest(path: str, version: int | None = None) -> dict:
    """The newest, or the named, state of a table: version, keys, number of buckets, schema, and the folder of each bucket."""
    found = versions(path)
    if not found:
        raise FileNotFoundError(f"{path} has no table")
    return json.loads(stores.content(f"{path}/manifest-{found[-1] if version is None else version:08d}.json"))


def _publish(path: str, state: dict) -> None:
    name = f"{path}/manifest-{state['version']:08d}.json"
    if stores.content(name) is not None:
        raise RuntimeError(f"another merge has written version {state['version']} of {path}")
    stores.put(name, json.dumps(state).encode())


def _bucket(keys: list[str], n: int):
    return F.pmod(F.xxhash64(*(F.col(k) for k in keys)), F.lit(n)).cast("int")


def _written(df: DataFrame, path: str, keys: list[str], n: int) -> dict[str, str]:
    """Rows in a folder a bucket; {bucket: folder} of those that have rows."""
    part = f"data-{uuid.uuid4().hex}"
    dealt = df.withColumn("bucket", _bucket(keys, n)).repartition("bucket")
    dealt.sortWithinPartitions("bucket", *keys).write.partitionBy("bucket").parquet(f"{path}/{part}")
    return {b: f"{part}/bucket={b}" for b in sorted({name.split("/")[0].removeprefix("bucket=") for name in stores.sizes(f"{path}/{part}", ".parquet")})}


def create(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    _publish(path, {"version": 0, "keys": keys, "n": buckets, "schema": df.schema.json(), "buckets": _written(df, path, keys, buckets)})


def read(spark: SparkSession, path: str, version: int | None = None, only: list[str] | None = None) -> DataFrame:
    """The table's rows, or those of some buckets."""
    from pyspark.sql.types import StructType

    state = manifest(path, version)
    schema = StructType.fromJson(json.loads(state["schema"]))
    folders = [f"{path}/{f}" for b, f in state["buckets"].items() if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge(spark: SparkSession, path: str, rows: DataFrame, deleted: DataFrame | None = None) -> list[str]:
    """Rows replace those of their keys, or are added; keys of `deleted` go.  Returns the buckets that were rewritten.

    Of several new rows of a key there must be one; else the merge fails.  The list of touched buckets, at most all of them, comes to the driver.
    """
    state = manifest(path)
    keys, n = state["keys"], state["n"]
    columns = [f["name"] for f in json.loads(state["schema"])["fields"]]
    rows = rows.select(*columns)
    gone = rows.select(*keys) if deleted is None else rows.select(*keys).unionByName(deleted.select(*keys))
    touched = sorted(str(r["b"]) for r in gone.select(_bucket(keys, n).alias("b")).distinct().collect())
    if rows.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"several new rows of one key of {path}")
    old = read(spark, path, only=touched)
    new = old.join(gone.distinct(), keys, "left_anti").select(*columns).unionByName(rows)
    fresh = _written(new, path, keys, n)
    kept = {b: f for b, f in state["buckets"].items() if b not in touched}
    _publish(path, state | {"version": state["version"] + 1, "buckets": kept | fresh})
    return touched


def files(path: str, version: int | None = None) -> set[str]:
    """Data files of a version."""
    folders = tuple(f"{f}/" for f in manifest(path, version)["buckets"].values())
    return {name for name in stores.sizes(path, ".parquet") if name.startswith(folders)}
