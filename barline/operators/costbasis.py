"""Cost-basis distribution: at which prices the holders of a code bought, by decayed daily volume profiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators.windows import lag

COLUMNS = ("avg_cost", "winners", "width90", "deviation", "peak_gap")


#: Bars whose distributions are held at once, and the decay (as a logarithm) beyond which a block of bars ends.
BLOCK, DEEPEST = 64, -500.0


class Holdings:
    """What a code's holders paid: mass by cell, where cell j is at ``origin`` + j steps of the logarithm of price.

    There are ``cells`` steps from a tenth to ten times the first close; the cells held are those that trades
    have reached, so no row depends on later ones.
    """

    def __init__(self, cells: int, origin: float | None = None, first: int = 0, mass: np.ndarray | None = None):
        self.step, self.origin, self.first = np.log(100) / (cells - 1), origin, first
        self.mass = np.zeros(0) if mass is None else mass

    def _reach(self, low: int, high: int) -> None:
        """Makes room for the cells from ``low`` to ``high``."""
        if not len(self.mass):
            self.first = low
        before, last = max(0, self.first - low), self.first + len(self.mass) - 1
        self.mass = np.pad(self.mass, (before, max(0, high - last)))
        self.first -= before

    def advance(self, high: np.ndarray, low: np.ndarray, close: np.ndarray, turnover: np.ndarray) -> np.ndarray:
        """The columns of the bars that follow, in order of date; what is held moves on with them.

        A bar's mass is what it bought and, by the decay since, all that was bought before: in a block of bars a running
        sum over the (bar, cell) matrix of purchases, each raised by the decay up to it.
        """
        traded = np.clip(np.nan_to_num(turnover.astype(float)), 0, 1)
        h, l, c = (np.log(x.astype(float)) for x in (high, low, close))
        if self.origin is None and len(c):
            self.origin = c[0] - np.log(10)
        with np.errstate(divide="ignore"):
            kept = np.log1p(-traded)
        out, at = np.full((len(c), len(COLUMNS)), np.nan), 0
        while at < len(c):
            fall = np.cumsum(kept[at : at + BLOCK])
            n = max(1, int(np.searchsorted(-fall, -DEEPEST)))
            rows = slice(at, at + n)
            out[rows] = self._block(h[rows], l[rows], c[rows], traded[rows], fall[:n])
            at += n
        return out

    def _block(self, h: np.ndarray, l: np.ndarray, c: np.ndarray, traded: np.ndarray, fall: np.ndarray) -> np.ndarray:
        lowest = np.ceil((l - self.step - self.origin) / self.step).astype(int)[:, None]
        highest = np.floor((h + self.step - self.origin) / self.step).astype(int)[:, None]
        self._reach(int(lowest.min()), int(highest.max()))
        j = np.arange(self.first, self.first + len(self.mass))
        x = self.origin + j * self.step
        shape = 1 - np.abs(x - ((h + l + c) / 3)[:, None]) / np.maximum((h - l) / 2, self.step)[:, None]
        shape = np.where((j >= lowest) & (j <= highest), np.maximum(shape, 0), 0)
        bought = shape / shape.sum(1, keepdims=True) * traded[:, None]
        if np.isinf(fall[0]):  # a bar in which all changed hands begins anew
            mass, fall = bought, np.zeros(len(fall))
        else:
            mass = np.exp(fall)[:, None] * (self.mass + np.cumsum(bought * np.exp(-fall)[:, None], axis=0))
        self.mass = mass[-1]
        total = mass.sum(1, keepdims=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(total > 0, mass / total, np.nan)
        price, now = np.exp(x), np.exp(c)
        average = share @ price
        below = np.cumsum(share, axis=1)
        low_end, high_end = (price[np.minimum((below < q).sum(1), len(x) - 1)] for q in (0.05, 0.95))
        peak = price[(share >= share.max(1, keepdims=True) * (1 - 1e-9)).argmax(1)]  # of equal cells the lowest
        columns = np.stack([average, np.where(x <= c[:, None], share, 0).sum(1), (high_end - low_end) / average, now / average - 1, peak / now - 1], axis=1)
        return np.where(total > 0, columns, np.nan)

    def packed(self) -> bytes:
        return np.concatenate([[self.origin, self.first], self.mass]).astype("<f8").tobytes()

    @classmethod
    def unpacked(cls, cells: int, data: bytes) -> Holdings:
        held = np.frombuffer(data, "<f8")
        return cls(cells, float(held[0]), int(held[1]), held[2:].copy())


def cost_basis(panel: DataFrame, cells: int = 360) -> DataFrame:
    """Adds average cost, share of winners, width of the middle 90 %, deviation of the close, gap to the peak, and the width's change over 20 rows.

    The distribution of a row follows from that of the row before, so a code's bars, a few
    thousand at most, pass through one grouped function; codes are independent.
    """
    schema = "code long, date date, " + ", ".join(f"{c} double" for c in COLUMNS)

    def per_code(bars: pd.DataFrame) -> pd.DataFrame:
        bars = bars.sort_values("date")
        sound = bars[(bars[["high", "low", "close"]] > 0).all(axis=1)]
        values = Holdings(cells).advance(*(sound[c].to_numpy() for c in ("high", "low", "close", "turnover")))
        return pd.concat([sound[["code", "date"]].reset_index(drop=True), pd.DataFrame(values, columns=COLUMNS)], axis=1)

    needed = panel.select(F.col("code").cast("long").alias("code"), "date", "high", "low", "close", "turnover")
    d = needed.groupBy("code").applyInPandas(per_code, schema)
    d = d.select("code", "date", *(F.nanvl(c, F.lit(None)).alias(c) for c in COLUMNS))
    return d.withColumn("width_change20", F.col("width90") - lag("width90", 20))


def base_runs(panel: DataFrame, starts: DataFrame, amplitude: float = 0.3) -> DataFrame:
    """For each start (code, pos): how many bars back the closes stay within an amplitude, and whether all bars do.

    The run goes to the breach or to the code's first bar.  Bars of a code pass once through
    a grouped function, whose two queues hold the extremes of the run, so work is in proportion to bars.
    """
    rows = panel.select("code", "pos", "close").join(starts.select("code", "pos", F.lit(True).alias("start")), ["code", "pos"], "left")

    def per_code(bars: pd.DataFrame) -> pd.DataFrame:
        bars = bars.sort_values("pos")
        close, pos = bars["close"].to_numpy(), bars["pos"].to_numpy()
        wanted = bars["start"].fillna(False).to_numpy(bool)
        from collections import deque

        most, least, left, out = deque(), deque(), 0, []
        for t in range(len(close)):
            if wanted[t] and t:
                out.append((pos[t], t - left, left == 0))
            for queue, worse in ((most, np.less_equal), (least, np.greater_equal)):
                while queue and worse(close[queue[-1]], close[t]):
                    queue.pop()
                queue.append(t)
            while close[most[0]] / close[least[0]] - 1 > amplitude:
                left += 1
                for queue in (most, least):
                    if queue[0] < left:
                        queue.popleft()
        frame = pd.DataFrame(out, columns=["start", "run", "to_the_end"])
        frame.insert(0, "code", bars["code"].iloc[0])
        return frame

    return rows.groupBy("code").applyInPandas(per_code, "code long, start long, run long, to_the_end boolean")
