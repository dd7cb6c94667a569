"""One-step forecasts on a stream: each arriving observation is scored, then moves the state.

The state of a series is typed: its parameters, read once when the stream starts; the end of its history, as long as
its lag polynomials; and the observations that came ahead of their turn, which wait until the gap before them closes
or is given up. So the result equals the batch ``walk_forward`` in whatever order the rows come within that bound.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from panelcast.kernels import arima as kernel
from panelcast.operators.arima import COEFFICIENTS, fitted_model, with_interval, without_nan
from panelcast.operators.packing import key_schema

KEYS = ("series_id",)
MAX_WAIT = 10_000
MODEL_STATE = "ar array<double>, ma array<double>, beta array<double>, sigma double"
PAST_STATE = "expected long, u array<double>, e array<double>, n_waiting long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def score_arrivals(
    arrivals: DataFrame,
    models: DataFrame,
    exog: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    start: int = 0,
    alpha: float = 0.05,
    max_wait: int = MAX_WAIT,
    patience: float | None = None,
) -> DataFrame:
    """Stream of ``keys, tick, log_y, exog…`` to ``keys, tick, log_y, log_hat, y_hat, interval, status``.

    ``tick`` counts the steps of the series (weeks, hours); the first one is ``start``. The forecast
    uses only ticks before its own and is NULL while the history is too short, and for a series without
    a model. Every arrival gives one row: ``scored`` in its turn; ``late`` and without a forecast if its
    tick is before ``start``, was scored before or was given up. A tick is given up (``missing``, without
    a value) once one more than ``max_wait`` ticks ahead of it has come; its forecast then stands in for
    it, or the history starts anew. So a state never holds more than ``max_wait`` waiting ticks. With
    ``patience`` (seconds) a timer gives up what others have waited for so long, also where no more arrives.

    ``models`` are read once, as the initial state of a new stream; a stream that goes on from its checkpoint keeps
    the parameters it has. Typed state needs the RocksDB store, which is set for the session here unless another
    choice has been made for it.
    """
    keys, exog, spark = list(keys), list(exog), arrivals.sparkSession
    if not (spark.conf.get(PROVIDER, None) or "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)
    parameters = models.filter("message IS NULL").select(*keys, "order", "seasonal", "exog", *COEFFICIENTS, "sigma2")
    rows = arrivals.select(*keys, "tick", "log_y", *(F.col(c).cast("double").alias(c) for c in exog))
    fields = f"{key_schema(arrivals, keys)}, tick long, log_y double, log_hat double, sigma double, status string"
    scored = rows.groupBy(*keys).transformWithStateInPandas(
        WalkForward(keys, exog, start, max_wait, patience),
        fields,
        "append",
        "none" if patience is None else "processingTime",
        parameters.groupBy(*keys),
    )
    return with_interval(without_nan(scored), alpha)


def run_ahead(u, e, run, ar, ma):
    """Forecasts of the disturbances ``run`` that follow the histories ``u`` and ``e`` without a gap, in one pass: NaN while
    the history is shorter than the autoregression looks back, and innovations 0 there."""
    reach = len(ar) - 1
    short = min(max(reach - len(u), 0), len(run))
    errors = np.zeros(len(run))
    if short < len(run):
        known = np.concatenate([u, run])
        w = np.convolve(known, ar)[len(u) + short : len(known)]
        if len(ma) > 1:
            # Innovations before the run that the moving average still reaches.
            before = np.concatenate([np.zeros(max(len(ma) - 1 - len(e) - short, 0)), e, np.zeros(short)])
            tail = before[len(before) - len(ma) + 1 :]
            w[: len(ma) - 1] -= np.convolve(tail, ma)[len(tail) : len(tail) + len(w)]
        errors[short:] = kernel.invert(w[None], ma[None], 1)[0]
    ahead = run - errors
    ahead[:short] = np.nan
    return ahead, errors


class WalkForward(StatefulProcessor):
    """Scores the arrivals of one series; see ``score_arrivals``."""

    def __init__(self, keys: list[str], exog: list[str], start: int, max_wait: int, patience: float | None):
        self.keys, self.exog, self.start, self.max_wait, self.patience = keys, exog, start, max_wait, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.model = handle.getValueState("model", MODEL_STATE)
        self.past = handle.getValueState("past", PAST_STATE)
        self.waiting = handle.getMapState("waiting", "tick long", "log_y double, effect double")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.to_dict("records")[0]
        spec, params = fitted_model(row)
        if spec.exog != tuple(self.exog[: len(spec.exog)]):
            raise ValueError(f"the model of {key} has regressors {spec.exog}, the stream {self.exog}")
        ar, ma = kernel.polynomials(spec.kernel_order(), params)
        beta = np.zeros(len(self.exog))
        beta[: len(spec.exog)] = params[: len(spec.exog)]
        self.model.update((ar.tolist(), ma.tolist(), beta.tolist(), float(np.sqrt(row["sigma2"]))))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)
        model = self._model()
        x = arrived[self.exog].to_numpy(float) if self.exog else np.zeros((len(arrived), 0))
        effects = x @ (model[2] if model else np.zeros(len(self.exog)))
        expected, u, e, held = self._restore()
        late, fresh = [], set()
        for t, y, effect in zip(arrived["tick"].tolist(), arrived["log_y"].tolist(), effects.tolist()):
            if t < expected or t in held:
                late.append((*key, t, y, None, np.nan, "late"))
            else:
                held[t] = (y, effect)
                fresh.add(t)
        newest = max(held, default=expected)
        expected, u, e, out = self._close(key, model, expected, u, e, held, newest - self.max_wait)
        self._store(expected, u, e, held, fresh, timerValues)
        yield self._frame(late + out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expected, u, e, held = self._restore()
        if not held:
            return
        expected, u, e, out = self._close(key, self._model(), expected, u, e, held, min(held))
        self._store(expected, u, e, held, set(), timerValues)
        yield self._frame(out)

    def close(self) -> None:
        pass

    def _model(self):
        found = self.model.get() if self.model.exists() else None
        return None if found is None else [np.asarray(v, float) for v in found[:3]] + [found[3]]

    def _restore(self) -> tuple:
        if not self.past.exists():
            return self.start, np.zeros(0), np.zeros(0), {}
        expected, u, e, n_waiting = self.past.get()
        self._held_before = {k[0]: tuple(v) for k, v in self.waiting.iterator()} if n_waiting else {}
        return expected, np.asarray(u, float), np.asarray(e, float), dict(self._held_before)

    def _store(self, expected, u, e, held, fresh, timerValues) -> None:
        before = getattr(self, "_held_before", {})
        for t in before:
            if t not in held:
                self.waiting.removeKey((int(t),))
        for t in fresh:
            if t in held:
                self.waiting.updateValue((int(t),), tuple(float(v) for v in held[t]))
        self._held_before = {}
        self.past.update((int(expected), u.tolist(), e.tolist(), len(held)))
        if self.patience is not None:
            pending = list(self.handle.listTimers())
            if held and not pending:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.patience * 1_000))
            for timer in pending if not held else ():
                self.handle.deleteTimer(timer)

    def _close(self, key, model, expected, u, e, held, give_up) -> tuple:
        """Score the runs without a gap from ``expected`` on; ticks before ``give_up`` that have not come are given up."""
        ar, ma, _, sigma = model if model else (np.ones(1), np.ones(1), None, np.nan)
        ticks, out = sorted(held), []
        while True:
            n = 0
            while n < len(ticks) and ticks[n] == expected + n:
                n += 1
            if n:
                own = [held.pop(t) for t in ticks[:n]]
                y, effect = (np.array(v, float) for v in zip(*own))
                ahead, errors = run_ahead(u, e, y - effect, ar, ma) if model else (np.full(n, np.nan), np.zeros(n))
                out += [
                    (*key, t, *row, sigma, "scored") for t, *row in zip(ticks[:n], y.tolist(), (ahead + effect).tolist())
                ]
                u, e = np.concatenate([u, y - effect]), np.concatenate([e, errors])
                expected, ticks = expected + n, ticks[n:]
            u, e = u[max(len(u) + 1 - len(ar), 0) :], e[max(len(e) - max(len(ma) - 1, 1), 0) :]
            if expected >= give_up:
                return expected, u, e, out
            out.append((*key, expected, np.nan, None, sigma, "missing"))
            if model and len(u) == len(ar) - 1:
                past = np.concatenate([np.zeros(max(len(ma) - 1 - len(e), 0)), e])
                u, e = np.append(u, kernel.next_value(u, past, ar, ma)), np.append(e, 0.0)
            else:
                u, e = np.zeros(0), np.zeros(0)
            expected += 1

    def _frame(self, rows) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[*self.keys, "tick", "log_y", "log_hat", "sigma", "status"])
        return frame.astype({"tick": "int64", "log_y": "float64", "log_hat": "float64", "sigma": "float64"})
