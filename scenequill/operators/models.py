"""Seams for models: a registry of backends by role and name, and one way to run them over a table.

A backend is a class; each Python worker makes one instance and feeds it batches, so weights load once a worker. A row that
fails, or whose input is null, gives null for itself alone. The stubs stand in for models in tests and dry runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

#: role: result type of its backends, whose ``predict(list of inputs)`` gives a list of results.
ROLES = {
    "embedding": "array<float>",
    "caption": "string",
    "describe": "string",
    "reason": "string",
    "answer": "string",
    "judge": "string",
    "depth": "array<float>",
    "orientation": "array<double>",
    "pose": "array<struct<name:string,x:double,y:double,visible:boolean>>",
    "detect": "array<struct<x1:double,y1:double,x2:double,y2:double,score:double,label:string>>",
    "match": "array<struct<ax:double,ay:double,bx:double,by:double,caption:string,distance:double>>",
    "locate": "string",
}
BACKENDS: dict[tuple[str, str], type] = {}


def register(role: str, name: str, backend: type) -> type:
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}; there are {', '.join(ROLES)}")
    if not isinstance(backend, type) or not callable(getattr(backend, "predict", None)):
        raise TypeError("a backend is a class with a method predict")
    BACKENDS[role, name] = backend
    return backend


def backend(role: str, name: str | type) -> type:
    """A registered class by its name, or a class as it is."""
    if isinstance(name, type):
        return name
    if (role, name) not in BACKENDS:
        raise ValueError(f"unknown {role} backend {name!r}; there are {', '.join(n for r, n in BACKENDS if r == role) or 'none'}")
    return BACKENDS[role, name]


def run_model(df: DataFrame, role: str, name: str | type, out: str, *inputs: str, **options) -> DataFrame:
    """``df`` with the column ``out``: what the backend makes of the input columns, one value or a tuple of them."""
    make = backend(role, name)
    ship(df.sparkSession)

    @F.pandas_udf(ROLES[role])
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = make(**options)
        for cols in batches:
            rows = list(zip(*(cols if isinstance(cols, tuple) else (cols,)), strict=True))
            args = [r[0] if len(r) == 1 else r for r in rows]
            use = [i for i, r in enumerate(rows) if all(x is not None for x in r)]
            got: list = [None] * len(rows)
            try:
                for i, x in zip(use, model.predict([args[i] for i in use]), strict=True):
                    got[i] = x
            except Exception:  # noqa: BLE001  then one by one, so that only the row that fails is null
                for i in use:
                    try:
                        got[i] = model.predict([args[i]])[0]
                    except Exception:  # noqa: BLE001
                        got[i] = None
            yield pd.Series(got, dtype=object)

    return df.withColumn(out, predict(*inputs))


def _sum(x: object) -> int:
    return sum(x) if isinstance(x, (bytes, bytearray)) else sum(str(x).encode())


class StubEmbedding:
    """A unit vector of four from the sum of the input's bytes."""

    def predict(self, inputs: list) -> list:
        return [np.eye(4, dtype=np.float32)[_sum(x) % 4] for x in inputs]


class StubText:
    """Says a fixed text, with the inputs in it."""

    def __init__(self, says: str = "seen: {}"):
        self.says = says

    def predict(self, inputs: list) -> list:
        return [self.says.format(x if isinstance(x, str) else _sum(x)) for x in inputs]


class StubJudge:
    """True where the prediction has the truth in it; inputs are question, prediction, truth."""

    def predict(self, inputs: list) -> list:
        return ["True" if str(g).lower() in str(p).lower() else "False" for _, p, g in inputs]


class StubVector:
    def __init__(self, length: int = 4, value: float = 1.0):
        self.length, self.value = length, value

    def predict(self, inputs: list) -> list:
        return [np.full(self.length, self.value) for _ in inputs]


class StubPose:
    """A nose in the middle of a unit image, and nothing else."""

    def predict(self, inputs: list) -> list:
        return [[{"name": "nose", "x": 0.5, "y": 0.5, "visible": True}] for _ in inputs]


class StubNothing:
    """Finds nothing."""

    def predict(self, inputs: list) -> list:
        return [[] for _ in inputs]


for _role in ("caption", "describe", "reason", "answer", "locate"):
    register(_role, "stub", StubText)
for _role in ("depth", "orientation"):
    register(_role, "stub", StubVector)
for _role in ("detect", "match"):
    register(_role, "stub", StubNothing)
register("embedding", "stub", StubEmbedding)
register("judge", "stub", StubJudge)
register("pose", "stub", StubPose)


def judged(reply: Column) -> Column:
    """1 if a judge's reply says true, else 0; null without a reply."""
    return F.when(reply.isNotNull(), F.contains(F.lower(reply), F.lit("true")).cast("double"))


def answers(items: DataFrame, name: str | type = "stub") -> DataFrame:
    """id, prediction of benchmark items (id, question, options, images): the question with its options, asked of the first
    image; an item without an image gets the empty text."""
    from .reports import options_text

    q = F.when(F.size("options") > 0, F.concat("question", F.lit("\n"), options_text(F.col("options")))).otherwise(F.col("question"))
    asked = items.select("id", q.alias("q"), F.get("images", F.lit(0)).alias("image"))
    return run_model(asked, "answer", name, "said", "q", "image").select("id", F.coalesce("said", F.lit("")).alias("prediction"))


def embeddings(df: DataFrame, image: str, name: str | type = "stub", scale: bool = True) -> DataFrame:
    """``df`` with ``embedding``, of unit length if asked."""
    out = run_model(df, "embedding", name, "embedding", image)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return out.withColumn("embedding", F.when(F.lit(scale) & (norm > 0), F.transform("embedding", lambda x: (x / norm).cast("float"))).otherwise(F.col("embedding")))


def device(gigabytes: float | None) -> str:
    """Which size of models a machine with so much graphics memory takes."""
    return "cpu" if not gigabytes else "small" if gigabytes < 12 else "large"
