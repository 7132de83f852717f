"""A table kept by micro-batches: each commit adds a layer to the parts it touches.

Rows are dealt to parts by a column (a bucket of the key, a day, ...).  Commit
number n writes one folder per touched part, ``data/layer=<n>/part=<p>``, and
then a manifest ``log/<n>.json`` that lists the layers of every part; only the
newest manifest is read, so a crash before it is written changes nothing (the
next commit overwrites what was left).  The manifest keeps the batch's id, so
a batch that is run again is left out.  A part that gathers more than
``max_layers`` is rewritten as one layer by ``compact``, a commit of its own.
Manifests but the last two, and layers that neither lists, are removed.

Layers are merged when read (``merge``), by the tables built on this:
``UpsertedTable`` here, the window store and the key store in their modules.
One writer at a time, as one streaming query is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART, LAYER = "part", "layer"


class Folder:
    """The few file system calls that are needed, on any store Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self._fs = self._of("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _of(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        p = self._of(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._of(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        out = self._fs.create(self._of(f"{name}.tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(self._of(f"{name}.tmp"), self._of(name)):
            raise OSError(f"could not put {name} below {self.path}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._of(name), True)


class LayeredTable:
    """See the module's text.  ``schema`` is the rows' without the part; ``merge`` reduces the rows of several
    layers (which have PART and LAYER, later layers greater) to those of one."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame] | None = None, max_layers: int = 8):
        self.spark, self.folder = spark, Folder(spark, path)
        self.schema, self.merge, self.max_layers = schema, merge, max_layers

    # ------------------------------------------------------------- manifests

    def commits(self) -> list[str]:
        return [n.removesuffix(".json") for n in self.folder.names("log") if n.endswith(".json")]

    def state(self) -> dict:
        """The newest manifest: ``layers`` by part, and ``notes`` of its commit."""
        found = self.commits()
        return json.loads(self.folder.read(f"log/{found[-1]}.json")) if found else {"layers": {}, "notes": {}, "batch": -1, "commit": 0}

    def has(self, batch_id: int) -> bool:
        """Whether the batch, or one after it, is committed."""
        return self.state()["batch"] >= batch_id

    def _commit(self, state: dict) -> None:
        """``state`` becomes the table's, under the commit number it names."""
        self.folder.put(f"log/{state['commit']:012d}.json", json.dumps(state))
        kept = self.commits()[-2:]
        live = {(layer, part) for c in kept for part, layers in json.loads(self.folder.read(f"log/{c}.json"))["layers"].items() for layer in layers}
        for c in self.commits()[:-2]:
            self.folder.remove(f"log/{c}.json")
        for name in self.folder.names("data"):
            layer = name.removeprefix(f"{LAYER}=")
            parts = {p for held, p in live if held == layer}
            if not parts:
                self.folder.remove(f"data/{name}")
                continue
            for p in self.folder.names(f"data/{name}"):
                if p.startswith(f"{PART}=") and p.removeprefix(f"{PART}=") not in parts:
                    self.folder.remove(f"data/{name}/{p}")

    # ------------------------------------------------------------------ rows

    def _write(self, rows: DataFrame, layer: str) -> list[str]:
        rows.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(f"{self.folder.path}/data/{LAYER}={layer}")
        return [n.removeprefix(f"{PART}=") for n in self.folder.names(f"data/{LAYER}={layer}") if n.startswith(f"{PART}=")]

    def append(self, rows: DataFrame, batch_id: int, notes: dict | None = None) -> bool:
        """Adds a batch's rows (with a PART column, plain letters and digits); False if it was committed before."""
        state = self.state()
        if state["batch"] >= batch_id:
            return False
        layer = f"{state['commit'] + 1:012d}"
        for part in self._write(rows, layer):
            state["layers"].setdefault(part, []).append(layer)
        self._commit(state | {"notes": notes or state["notes"], "batch": batch_id, "commit": state["commit"] + 1})
        self.compact()
        return True

    def _scan(self, layers: dict[str, list[str]]) -> DataFrame:
        paths = [f"{self.folder.path}/data/{LAYER}={x}/{PART}={p}" for p, xs in layers.items() for x in xs]
        schema = f"{self.schema}, {LAYER} string, {PART} string"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder.path}/data").parquet(*paths)

    def _merged(self, layers: dict[str, list[str]]) -> DataFrame:
        """Parts of one layer are read as they are, only the others are merged."""
        one = {p: x for p, x in layers.items() if len(x) < 2}
        out = self._scan(one).drop(LAYER)
        if self.merge is None:
            return self._scan(layers).drop(LAYER)
        more = {p: x for p, x in layers.items() if p not in one}
        return out.unionByName(self.merge(self._scan(more)).select(*out.columns)) if more else out

    def files(self, parts: Iterable[str] | None = None) -> dict[str, list[str]]:
        """The layers of the parts (all by default)."""
        layers = self.state()["layers"]
        return layers if parts is None else {p: layers[p] for p in sorted(set(parts)) if p in layers}

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of the parts, merged, with PART."""
        return self._merged(self.files(parts))

    def compact(self, least: int | None = None) -> bool:
        """Rewrites parts of more than ``max_layers`` (or ``least``) layers as one."""
        state = self.state()
        full = {p: x for p, x in state["layers"].items() if len(x) > (least or self.max_layers)}
        if not full:
            return False
        layer = f"{state['commit'] + 1:012d}"
        written = self._write(self._merged(full), layer)
        for p in full:
            state["layers"][p] = [layer] if p in written else []
        self._commit(state | {"commit": state["commit"] + 1})
        return True

    def drop_parts(self, parts: Iterable[str]) -> None:
        """Lets go of whole parts (their rows are out of date)."""
        state = self.state()
        gone = set(parts) & state["layers"].keys()
        if gone:
            self._commit(state | {"layers": {p: x for p, x in state["layers"].items() if p not in gone}, "commit": state["commit"] + 1})


class UpsertedTable(LayeredTable):
    """The latest row per key: a micro-batch writes only its own rows, to the buckets it touches.

    Of the rows of one batch the latest by ``order`` counts; a later batch's
    row replaces an earlier one's, as saving an entity does.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: list[str], buckets: int = 16, max_layers: int = 8):
        super().__init__(spark, path, schema, self._latest_layer, max_layers)
        self.key, self.order, self.buckets = key, order, buckets

    def _latest(self, rows: DataFrame, *by: str) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.key]
        return rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r")).select(*self.key, "_r.*")

    def _latest_layer(self, rows: DataFrame) -> DataFrame:
        return self._latest(rows, LAYER)

    def _bucket(self):
        return F.format_string("b%04d", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)))

    def upsert(self, batch: DataFrame, batch_id: int) -> bool:
        return self.append(self._latest(batch, *self.order).withColumn(PART, self._bucket()), batch_id)

    def lookup(self, **key) -> DataFrame:
        """The row of one key; reads one bucket."""
        typed = self.spark.createDataFrame([], self.schema).schema
        one = self.spark.range(1).select(*(F.lit(key[k]).cast(typed[k].dataType).alias(k) for k in self.key))
        part = one.select(self._bucket()).first()[0]
        found = self.read([part])
        for k in self.key:
            found = found.where(F.col(k) == F.lit(key[k]).cast(typed[k].dataType))
        return found
