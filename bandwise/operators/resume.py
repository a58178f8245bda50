"""Training state in the shared folder: a stopped run goes on from its last saved step."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = ("run string, step int, t int, params array<double>, m array<double>, v array<double>, "
          "rng string, history array<array<double>>")


@dataclass
class TrainingState:
    """One appended row per ``every`` steps: parameters, the optimiser's moments, the generator's state and
    the log since the row before. Spark's commit keeps torn rows out. A folder belongs to one run: ``run`` names its settings,
    and a folder of other settings is an error. Without a ``path`` nothing is kept."""

    spark: SparkSession
    path: str | None
    every: int
    run: dict

    def load(self, steps: int):
        """(step, t, params, m, v, generator state, log) of the last saved step, or None."""
        if self.path is None:
            return None
        try:
            rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        last = rows.orderBy(F.desc("step")).limit(1).collect()
        if not last:
            return None
        last = last[0]
        if json.loads(last["run"]) != json.loads(json.dumps(self.run)):
            raise ValueError(f"{self.path} holds a run of other settings: {last['run']}")
        if last["step"] > steps:
            raise ValueError(f"{self.path} holds {last['step']} steps, more than the {steps} asked for")
        log = [tuple(h) for r in rows.orderBy("step").select("history").collect() for h in r["history"]]
        arrays = (np.array(last[k]) for k in ("params", "m", "v"))
        return (last["step"], last["t"], *arrays, json.loads(last["rng"]), [(int(s), a, b) for s, a, b in log])

    def save(self, step: int, steps: int, params: np.ndarray, opt, rng, history: list) -> None:
        """Keep the state after ``step`` steps if it is one in ``every``, or the last."""
        if self.path is None or step % self.every and step != steps:
            return
        since = (step - 1) // self.every * self.every
        rows = [[float(x) for x in h] for h in history if h[0] >= since]
        self.spark.createDataFrame(
            [(json.dumps(self.run), step, opt.t, params.tolist(), opt.m.tolist(), opt.v.tolist(),
              json.dumps(rng.bit_generator.state), rows)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
