"""Probabilities of candidate pairs: a fixed linear scorer and boosted trees."""

from __future__ import annotations

import json
import secrets
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..plans.stages import kept
from . import boosting
from .features import FEATURES
from .link import linked

#: Logistic weights of the fixed scorer; all of its features stay in the JVM.
BIAS = -4.0
WEIGHTS = {"name_lev_sim": 3.0, "name_char_3gram": 3.0, "name_token_overlap": 1.0, "addr_lev_sim": 1.5, "num_has_match": 1.5, "num_has_mismatch": -2.0, "exact_core_no_addr": 2.0}

#: Parameters of the boosted presets. Rows are not sampled by the second, which samples them only where a frequency is set.
PRESETS = {
    "xgboost": boosting.Settings(rounds=500, rate=0.035, depth=7, rows=0.85, columns=0.85, smooth=1.0, least_weight=1.0, seed=42),
    "lightgbm": boosting.Settings(rounds=450, rate=0.035, depth=7, leaves=63, rows=1.0, columns=0.85, smooth=0.0, least_weight=1e-3, least_rows=30, from_average=True, seed=42),
}
ALIASES = {"xgboost_gpu": "xgboost", "xgb_gpu": "xgboost", "xgb": "xgboost"}
#: Rows that a part of a fit holds at least, unless it is the only one.
PART_ROWS = 20_000


def single(c: Column) -> Column:
    """The value in single precision: a model's features and probabilities are, so 0.70 as a probability is below the threshold 0.70."""
    return c.cast("float").cast("double")


def linear(df: DataFrame) -> DataFrame:
    """df with prob, the fixed scorer's, a multiple of 1e-9 in single precision, of features in single precision."""
    z = sum((w * single(F.col(x)) for x, w in WEIGHTS.items()), F.lit(BIAS))
    return df.withColumn("prob", single(F.round(1 / (1 + F.exp(-z)), 9)))


def number_penalty(df: DataFrame) -> DataFrame:
    """Street numbers that are known and differ make a pair ten times less likely, unless the core names are equal."""
    clash = F.col("primary_num1").isNotNull() & F.col("primary_num2").isNotNull() & (F.col("primary_num1") != F.col("primary_num2")) & (F.col("name_exact_core") < 1.0)
    return df.withColumn("prob", F.when(clash, F.col("prob") * 0.1).otherwise(F.col("prob")))


def packed(df: DataFrame, label: str, weight: str | None, key: list[str] | None) -> DataFrame:
    """A row for each Arrow batch of df: how many rows it holds, the largest weight, and features, labels, weights and hashes of key one after another."""
    every = df.select(*[F.col(c).cast("float").alias(c) for c in FEATURES], F.col(label).cast("double").alias("__y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("__w"), F.xxhash64(*(key or df.columns)).alias("__key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                column = lambda c: b.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                x = np.stack([column(c).astype(np.float32) for c in FEATURES], 1)
                yield pa.record_batch([[b.num_rows], [float(column("__w").max())], *[[a.tobytes()] for a in (x, column("__y"), column("__w"), column("__key"))]], ["n", "heaviest", "x", "y", "w", "key"])

    return every.mapInArrow(run, "n long, heaviest double, x binary, y binary, w binary, key binary")


def _features_of(block: bytes) -> np.ndarray:
    return np.frombuffer(block, np.float32).reshape(-1, len(FEATURES))


def counts(blocks: DataFrame, bits: int, left: int, opened: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """What boosting.bin_edges asks for, summed over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(len(o) << bits, np.int64) for o in opened]
        for b in batches:
            for block in b.column("x"):
                boosting.counted(_features_of(block.as_py()), bits, left, opened, tables)
        for c, (o, table) in enumerate(zip(opened, tables, strict=True)):
            at = np.flatnonzero(table)
            yield pa.record_batch([np.full(len(at), c), o[at >> bits] << bits | at & ((1 << bits) - 1), table[at]], ["c", "begin", "n"])

    found = blocks.select("x").mapInArrow(run, "c long, begin long, n long").groupBy("c", "begin").agg(F.sum("n").alias("n")).toArrow()
    c, begin, n = (found.column(x).to_numpy() for x in ("c", "begin", "n"))
    order = np.lexsort((begin, c))
    ends = np.searchsorted(c[order], np.arange(len(opened) + 1))
    return [(begin[order[a:b]], n[order[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def together(blocks: DataFrame, plan: boosting.Plan, settings: boosting.Settings, parts: int) -> boosting.Forest:
    """The forest of all blocks' rows, fitted by ``parts`` tasks that run at once, each of which holds its share of the rows (some 90 bytes a row)."""
    secret = secrets.token_bytes(32)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [plan.codes(_features_of(x.as_py())).tobytes() for x in b.column("x")]
            yield pa.record_batch([pa.array(codes, pa.binary()), *[b.column(c) for c in ("y", "w", "key")]], ["code", "y", "w", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"code": [np.zeros((len(plan.groups), 0), np.uint16)], "y": [np.zeros(0)], "w": [np.zeros(0)], "key": [np.zeros(0, np.uint64)]}
        for b in batches:
            for c, arrays in held.items():
                for x in b.column(c):
                    a = np.frombuffer(x.as_py(), arrays[0].dtype)
                    arrays.append(a.reshape(len(plan.groups), -1) if c == "code" else a)
        code, y, w, key = (np.concatenate(held.pop(c), axis=-1) for c in list(held))
        with linked(BarrierTaskContext.get(), secret) as link:
            forest = boosting.fit_parts(code, y, w, key, plan, settings, link, link.root)
        if forest is not None:
            yield pa.record_batch([[json.dumps(forest.as_dict())]], ["forest"])

    dealt = blocks.mapInArrow(coded, "code binary, y binary, w binary, key binary").repartition(parts)
    return boosting.Forest.of_dict(json.loads(dealt.mapInArrow(run, "forest string", barrier=True).collect()[0][0]))


class Matcher:
    """A boosted-tree matcher on the 36 features: fit, score, save, load. params override those of the preset by name."""

    def __init__(self, model_type: str = "xgboost_gpu", **params) -> None:
        preset = PRESETS.get(ALIASES.get(model_type, model_type))
        if preset is None:
            raise ValueError(f"Unknown model type: {model_type}")
        self.model_type, self.settings, self.forest = model_type, replace(preset, **params), None

    def fit(self, df: DataFrame, label: str = "label", weight: str | None = None, key: list[str] | None = None, parts: int | None = None) -> Matcher:
        """Fit on all rows. They are drawn for a tree by a hash of the columns key (all of df), so rows that are equal there are drawn together.

        The rows' features are computed once; bins come from counts of all values, and then
        all parts (as many as tasks run at once, if there are rows enough) fit together.
        """
        blocks = kept(packed(df, label, weight, key))
        n, heaviest = blocks.agg(F.sum("n"), F.max("heaviest")).first()
        if not n:
            raise ValueError("no rows to fit on")
        edges = boosting.bin_edges(lambda *asked: counts(blocks, *asked), n, len(FEATURES))
        parts = parts or max(1, min(df.sparkSession.sparkContext.defaultParallelism, n // PART_ROWS))
        self.forest = together(blocks, boosting.Plan(edges, boosting.unit(n, heaviest)), self.settings, parts)
        return self

    def score(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """df with prob; of its columns only those of keep, if that is given, so that the others don't come back from Python."""
        if self.forest is None:
            raise ValueError("the model isn't fitted")
        keep = df.columns if keep is None else keep
        forest, kind = self.forest, StructType([*[df.schema[c] for c in keep], StructField("prob", DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float32) for c in FEATURES], 1)
                prob = forest.probabilities(x).astype(np.float64) if len(x) else np.zeros(0)
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(prob)], [*keep, "prob"])

        # only what is read or returned goes to Python
        return df.select(*keep, *[c for c in FEATURES if c not in keep]).mapInArrow(run, kind)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as one line of JSON into a folder that Spark can reach."""
        line = json.dumps({"model_type": self.model_type, "settings": vars(self.settings), "forest": self.forest.as_dict() if self.forest else None})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Matcher:
        found = json.loads(spark.read.text(path).first()[0])
        out = cls(found["model_type"], **found["settings"])
        out.forest = boosting.Forest.of_dict(found["forest"]) if found["forest"] else None
        return out
