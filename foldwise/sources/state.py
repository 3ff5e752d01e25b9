"""Saving and reloading fitted state (S6): a versioned folder of Parquet tables, Spark ML models and a manifest.

``save_state`` takes any fitted state of the library (a State dataclass, a ``Lookup``, a Spark ML model, or lists and
dictionaries of them), writes every table and model under ``<path>/<version>/`` on the file system Spark uses, and the
manifest last. The manifest is the state's outline in JSON, with the row count of each table. ``load_state`` reads the
newest version that has a manifest, so a save that broke off is never taken: an older version stays in force, and without
one the folder is refused. Tables are checked against their row counts, so a version that lost files is refused too.

Tables that were small enough to broadcast when they were fitted come back as local relations, others as scans. Only
dataclasses of this package are rebuilt, and no code is read from the folder.
"""

from __future__ import annotations

import base64
import datetime
import importlib
import json
from dataclasses import fields, is_dataclass
from decimal import Decimal

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators.lookup import Lookup, local_table

FORMAT = 1
PACKAGE = __name__.split(".")[0]
SCALARS = {"date": (datetime.date, datetime.date.isoformat, datetime.date.fromisoformat), "time": (datetime.datetime, datetime.datetime.isoformat, datetime.datetime.fromisoformat), "decimal": (Decimal, str, Decimal), "bytes": (bytes, lambda b: base64.b64encode(b).decode(), base64.b64decode)}


class StateError(ValueError):
    """The folder holds no whole state."""


class _Writer:
    def __init__(self, folder: str):
        self.folder, self.tables, self.models = folder, [], 0

    def outline(self, x):
        if isinstance(x, np.generic):
            x = x.item()
        if x is None or isinstance(x, (bool, str, int)):
            return x
        if isinstance(x, float):
            return {"float": repr(x)}  # also nan and the infinities
        for name, (kind, to_text, _) in SCALARS.items():
            if type(x) is kind:
                return {name: to_text(x)}
        if isinstance(x, (list, tuple)):
            return {type(x).__name__: [self.outline(y) for y in x]}
        if isinstance(x, dict):
            return {"dict": [[self.outline(k), self.outline(v)] for k, v in x.items()]}
        if isinstance(x, Lookup):
            return {"lookup": self.table(x.df), "local": x.broadcastable}
        if isinstance(x, DataFrame):
            return {"table": self.table(x)}
        if isinstance(x, (Model, Transformer)):
            self.models += 1
            PipelineModel([x]).write().save(f"{self.folder}/models/{self.models}")
            return {"model": self.models}
        if is_dataclass(x) and type(x).__module__.split(".")[0] == PACKAGE:
            return {"state": f"{type(x).__module__}:{type(x).__qualname__}", "fields": {f.name: self.outline(getattr(x, f.name)) for f in fields(x)}}
        raise TypeError(f"{type(x).__name__} is no fitted state")

    def table(self, df: DataFrame) -> int:
        path = f"{self.folder}/tables/{len(self.tables) + 1}"
        # columns by place: names may hold what file formats refuse or clash but for case
        df.toDF(*[f"c{i}" for i in range(len(df.columns))]).write.parquet(path)
        rows = df.sparkSession.read.parquet(path).count()
        self.tables.append({"rows": rows, "schema": df.schema.jsonValue()})
        return len(self.tables)


class _Reader:
    def __init__(self, spark: SparkSession, folder: str, tables: list):
        self.spark, self.folder, self.tables = spark, folder, tables

    def built(self, x):
        if not isinstance(x, dict):
            return x
        kind = next(iter(x))
        if kind == "float":
            return float(x[kind])
        if kind in SCALARS:
            return SCALARS[kind][2](x[kind])
        if kind in ("list", "tuple"):
            return {"list": list, "tuple": tuple}[kind](self.built(y) for y in x[kind])
        if kind == "dict":
            return {self.built(k): self.built(v) for k, v in x[kind]}
        if kind == "lookup":
            df = self.table(x["lookup"])
            return Lookup(local_table(self.spark, df.toArrow(), df.schema) if x["local"] else df, x["local"])
        if kind == "table":
            return self.table(x["table"])
        if kind == "model":
            return PipelineModel.load(f"{self.folder}/models/{x['model']}").stages[0]
        module, name = x["state"].split(":")
        if module.split(".")[0] != PACKAGE:
            raise StateError(f"{module} is not of this package")
        found = getattr(importlib.import_module(module), name)
        if not is_dataclass(found):
            raise StateError(f"{name} is no state")
        return found(**{k: self.built(v) for k, v in x["fields"].items()})

    def table(self, n: int) -> DataFrame:
        kept = self.tables[n - 1]
        schema = T.StructType.fromJson(kept["schema"])
        stored = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])
        df = self.spark.read.schema(stored).parquet(f"{self.folder}/tables/{n}")
        if (rows := df.count()) != kept["rows"]:
            raise StateError(f"{self.folder}/tables/{n} has {rows} rows of {kept['rows']}")
        return df.toDF(*schema.names)


def _manifests(spark: SparkSession, path: str) -> dict[int, dict]:
    """{version: manifest} of all versions that were written to the end."""
    try:
        rows = spark.read.text(f"{path}/*/manifest", wholetext=True).select("value", F.input_file_name().alias("file")).collect()  # one of each version
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()) or "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    out = {}
    for r in rows:
        try:
            found = json.loads(r["value"])
        except ValueError:
            continue
        if isinstance(found, dict) and found.get("format") == FORMAT:
            out[found["version"]] = found
    return out


def save_state(spark: SparkSession, state, path: str) -> int:
    """Writes ``state`` as a new version under ``path`` and returns its number. Earlier versions stay."""
    path = path.rstrip("/")
    taken = _manifests(spark, path)
    version = max(taken, default=0) + 1
    while True:  # a number that a broken-off save has begun is passed over
        try:
            spark.createDataFrame([(str(version),)], "value string").coalesce(1).write.text(f"{path}/{version}/begun")
            break
        except AnalysisException:
            version += 1
    writer = _Writer(f"{path}/{version}")
    outline = writer.outline(state)
    manifest = json.dumps({"format": FORMAT, "version": version, "tables": writer.tables, "state": outline})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{path}/{version}/manifest")
    return version


def load_state(spark: SparkSession, path: str, version: int | None = None):
    """The state saved last under ``path``, or the version asked for."""
    path = path.rstrip("/")
    found = _manifests(spark, path)
    version = version if version is not None else max(found, default=0)
    if version not in found:
        raise StateError(f"{path} has no whole state" + (f" of version {version}" if version else ""))
    reader = _Reader(spark, f"{path}/{version}", found[version]["tables"])
    try:
        return reader.built(found[version]["state"])
    except AnalysisException as e:
        raise StateError(f"{path}/{version} is not whole: {e}") from e
