"""Betweenness from pivots: distances, path counts and dependencies of all pivots at once.

Every edge lies in the part of its end of lower degree. A node that is the higher end of no
edge has all its edges in one part, and its values there follow from those of its neighbours;
only the other nodes, the core, have a row of state, with one number per pivot. In a round a
part gets the rows of the core nodes it touches and returns what its edges say about them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, shared_folder

EDGES_A_PART = 100_000
CHUNK = 10_000  # edges whose numbers for all pivots are in memory at a time
ROWS_A_BUCKET = 20_000  # rows of numbers that one task combines
KINDS = ("dist", "paths", "dependency")
STATE = "node long, dist binary, paths binary, dependency binary"


def _matrix(column, width: int) -> np.ndarray:
    """A row per binary value."""
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, width)


def _rows(matrix: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(matrix, np.float64)]


def _own(ids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Which of the nodes is which pivot."""
    return ids[:, None] == pivots[None, :]


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """The edges of a part in the order of their lower ends, with places instead of ids."""
    frame = frame.sort_values(["low", "high"])
    low, count = np.unique(frame["low"].to_numpy(), return_counts=True)
    inner = np.unique(frame["low"].to_numpy()[frame["low_core"].to_numpy()])
    core = np.union1d(frame["high"].to_numpy(), inner)
    place = np.where(np.isin(low, inner), np.searchsorted(core, low), -1)
    packed = {
        "core": core, "low": low, "count": count.astype(np.int64), "place": place.astype(np.int64),
        "high": np.searchsorted(core, frame["high"].to_numpy()).astype(np.int32),
        "weight": frame["weight"].to_numpy(),
    }
    return pd.DataFrame({"part": frame["part"].iloc[:1], **{k: [v.tobytes()] for k, v in packed.items()}})


PACKED = "part long, core binary, low binary, count binary, place binary, high binary, weight binary"


class _Part:
    """The edges of a part and the rows of its core nodes."""

    def __init__(self, packed: pd.DataFrame, sent: pd.DataFrame, pivots: np.ndarray):
        row = packed.iloc[0]
        self.core, self.low, self.count, self.place = (
            np.frombuffer(row[k], np.int64) for k in ("core", "low", "count", "place")
        )
        self.high = np.frombuffer(row["high"], np.int32)
        self.weight = np.frombuffer(row["weight"], np.float64)
        self.pivots = pivots
        sent = sent.sort_values("node")
        self.state = {k: _matrix(sent[k], len(pivots)) for k in KINDS if k in sent}
        self.is_pivot = _own(self.core, pivots)

    def chunks(self):
        """Slices of lower ends with the slice of their edges."""
        ends = np.cumsum(self.count)
        first = 0
        while first < len(ends):
            begin = ends[first] - self.count[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
            yield slice(first, last), slice(begin, ends[last - 1])
            first = last

    def run(self, kind: str):
        """(what the edges say of ``kind`` about each core node, sums of dependencies of the others)."""
        d, s, t = (self.state.get(k) for k in KINDS)
        found = np.full(self.is_pivot.shape, np.inf if kind == "dist" else 0.0)
        combine = np.minimum if kind == "dist" else np.add
        sums = []
        for lows, edges in self.chunks():
            high, weight, place = self.high[edges], self.weight[edges, None], self.place[lows]
            count = self.count[lows]
            starts, owner = np.cumsum(count) - count, np.repeat(np.arange(len(count)), count)
            inner = place >= 0
            own = _own(self.low[lows], self.pivots)
            order = np.argsort(high, kind="stable")
            heads = np.flatnonzero(np.diff(high[order], prepend=-1))

            def tell(down, up):
                """Values for lower ends that are core nodes, and for higher ends."""
                found[place[inner]] = combine(found[place[inner]], down[inner])
                met = high[order][heads]
                found[met] = combine(found[met], combine.reduceat(up[order], heads))

            there = np.round(d[high] + weight, 9)
            least = np.minimum.reduceat(there, starts)
            near = np.where(inner[:, None], d[place], np.where(own, 0.0, least))
            back = np.round(near[owner] + weight, 9)
            if kind == "dist":
                tell(least, back)
                continue
            # Steps of shortest paths, which never lead to the pivot itself.
            reached = np.isfinite(there) & np.isfinite(back)
            down = reached & (there == near[owner]) & ~own[owner]
            up = reached & (back == d[high]) & ~self.is_pivot[high]
            ways = np.add.reduceat(np.where(down, s[high], 0.0), starts)
            many = np.where(inner[:, None], s[place], np.where(own, 1.0, ways))
            if kind == "paths":
                tell(ways, np.where(up, many[owner], 0.0))
                continue
            ns, nd = many[owner], s[high]
            known = ~np.isnan(ns) & ~np.isnan(nd)
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = np.where(up & known, ns / nd * (1.0 + t[high]), 0.0)
                total = np.add.reduceat(gains, starts)
                far = np.where(inner[:, None], t[place], total)
                tell(total, np.where(down & known, nd / ns * (1.0 + far[owner]), 0.0))
            sums.append(np.where(own, 0.0, total).sum(axis=1)[~inner])
        outer = self.low[self.place < 0]
        return found, (outer, np.concatenate(sums) if sums else np.zeros(0))


class Parts:
    """The core of a graph of ``low, high, weight`` with ``pivots``, and its rounds.

    ``low`` and ``high`` are ids of nodes, ``high`` the one that comes later in an order of
    all nodes by degree.
    """

    def __init__(self, edges: DataFrame, pivots: list[int]):
        spark = edges.sparkSession
        self.pivots = np.array(pivots, np.int64)
        folder = shared_folder(spark, "edges")
        edges.write.parquet(folder)
        edges = spark.read.parquet(folder)
        core = cut_lineage(edges.select(F.col("high").alias("node")).distinct())
        parts = 1 + edges.count() // EDGES_A_PART
        flagged = edges.join(core.select(F.col("node").alias("low"), F.lit(True).alias("_core")), "low", "left")
        placed = flagged.select(
            F.pmod(F.xxhash64("low"), F.lit(parts)).alias("part"), "low", "high", "weight",
            F.coalesce("_core", F.lit(False)).alias("low_core"),
        )
        packed = placed.groupBy("part").applyInPandas(_pack, PACKED)
        self.packed = cut_lineage(packed)
        self.touch = cut_lineage(self._core_of_parts())
        self.buckets = 1 + self.touch.count() // ROWS_A_BUCKET
        self.state = self._start(core)

    def _core_of_parts(self) -> DataFrame:
        def read(frames):
            for frame in frames:
                for part, core in zip(frame["part"], frame["core"]):
                    yield pd.DataFrame({"node": np.frombuffer(core, np.int64)}).assign(part=part)

        return self.packed.select("part", "core").mapInPandas(read, "node long, part long")

    def _start(self, core: DataFrame) -> DataFrame:
        pivots = self.pivots

        def make(frames):
            for frame in frames:
                own = _own(frame["node"].to_numpy(), pivots)
                yield frame.assign(
                    dist=_rows(np.where(own, 0.0, np.inf)),
                    paths=_rows(np.where(own, 1.0, np.nan)),
                    dependency=_rows(np.full(own.shape, np.nan)),
                )

        return cut_lineage(core.mapInPandas(make, STATE))

    def _told(self, kind: str, schema: str, make: Callable) -> DataFrame:
        """``make`` of each part after its run."""
        pivots = self.pivots
        needed = KINDS[: KINDS.index(kind) + 1]

        def compute(packed, sent):
            part = _Part(packed, sent, pivots)
            return make(part, *part.run(kind))

        sent = self.touch.join(self.state.select("node", *needed), "node")
        return self.packed.groupBy("part").cogroup(sent.groupBy("part")).applyInPandas(compute, schema)

    def settle(self, kind: str) -> None:
        """Rounds until no number of ``kind`` changes."""
        pivots, before = self.pivots, None

        def rows(part, found, _):
            if kind == "dist":  # only what is better
                better = (found < part.state["dist"]).any(axis=1)
                return pd.DataFrame({"node": part.core[better], kind: _rows(found[better])})
            return pd.DataFrame({"node": part.core, kind: _rows(found)})

        def merge(frame):
            old = frame["old"].to_numpy()
            frame = pd.concat([frame[old], frame[~old]])
            values = _matrix(frame[kind], len(pivots))
            held = int(old.sum())
            nodes, mine = frame["node"].to_numpy()[:held], values[:held]
            order = np.argsort(nodes)
            nodes, mine = nodes[order], mine[order]
            place = np.searchsorted(nodes, frame["node"].to_numpy()[held:])
            if kind == "dist":
                new = mine.copy()
                np.minimum.at(new, place, values[held:])
                moved = (new != mine).sum(axis=1)
            else:
                new = np.zeros(mine.shape)
                np.add.at(new, place, values[held:])
                if kind == "paths":
                    new[_own(nodes, pivots)] = 1.0
                moved = np.isnan(new).sum(axis=1)
            kept = frame[:held].iloc[order]
            return kept[["node", *KINDS]].assign(**{kind: _rows(new), "moved": moved})

        while True:
            told = self._told(kind, f"node long, {kind} binary", rows).withColumn("old", F.lit(False))
            both = self.state.withColumn("old", F.lit(True)).unionByName(told, allowMissingColumns=True)
            bucket = F.pmod(F.xxhash64("node"), F.lit(self.buckets))
            merged = cut_lineage(both.groupBy(bucket).applyInPandas(merge, f"{STATE}, moved long"))
            # Distances: numbers that fell. Others: numbers still unknown, which stay so on cycles.
            moved = merged.agg(F.coalesce(F.sum("moved"), F.lit(0))).first()[0]
            self.state = merged.drop("moved")
            if moved == 0 or (kind != "dist" and moved == before):
                return
            before = moved

    def sums(self) -> DataFrame:
        """``id, total``: the dependencies of all pivots but itself on each node."""
        pivots = self.pivots

        def outer(part, _, sums):
            return pd.DataFrame({"id": sums[0], "total": sums[1]})

        def core(frames):
            for frame in frames:
                ids = frame["node"].to_numpy()
                values = _matrix(frame["dependency"], len(pivots))
                total = np.where(_own(ids, pivots), 0.0, values).sum(axis=1)
                yield pd.DataFrame({"id": ids, "total": total})

        inner = self.state.select("node", "dependency").mapInPandas(core, "id long, total double")
        return self._told("dependency", "id long, total double", outer).unionByName(inner)
