"""A sample whose category shares match targets in two dimensions at once."""

from __future__ import annotations

import heapq
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Parts into which each cell is split before its first draw.
SALTS = 16
# Costs of one row: within the floor, up to the target, in the target's last fraction, beyond it, of no target.
FLOOR, TARGET, FRACTION, BEYOND, UNTARGETED = -1000, -100, -50, 1, 20
# Costs of one row that is wanted and not had: kept out by the other dimension; not there at all.
CONFLICT, SCARCE = 1, 1000
# Costs of a cell's next row after the whole part of its share: where chance gives it one, and where not.
LIKELY, UNLIKELY = 1, 8
# What a wanted row is worth: more than any slack costs, so that all demand is answered.
WANTED = -100_000


class Flow:
    """Min-cost flow by successive shortest paths with potentials; all paths of one length are used at once."""

    def __init__(self) -> None:
        self.ids: dict = {}
        self.out: list[list[int]] = []
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def node(self, name) -> int:
        if name not in self.ids:
            self.ids[name] = len(self.out)
            self.out.append([])
        return self.ids[name]

    def arc(self, tail, head, capacity: int, cost: int = 0) -> int:
        a, b = self.node(tail), self.node(head)
        for x, y, room, c in ((a, b, max(0, capacity), cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.head))
            self.head.append(y)
            self.room.append(room)
            self.cost.append(c)
        return len(self.head) - 2

    def used(self, arc: int) -> int:
        return self.room[arc + 1]

    def _distances(self, source: int, potential: list[float]) -> list[float]:
        far = [float("inf")] * len(self.out)
        far[source], heap = 0, [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for a in self.out[u]:
                if self.room[a] and (e := d + self.cost[a] + potential[u] - potential[v := self.head[a]]) < far[v]:
                    far[v] = e
                    heapq.heappush(heap, (e, v))
        return far

    def send(self, source, sink, most: int, gainful: bool = False) -> int:
        """Sends up to `most` units at least cost, or as long as that lowers the cost; returns how many went.

        The network must have no negative cycle.
        """
        s, t, sent = self.node(source), self.node(sink), 0
        potential: list[float] = [0] * len(self.out)
        for _ in range(len(self.out)):  # first potentials: costs may be negative
            changed = False
            for u in range(len(self.out)):
                for a in self.out[u]:
                    if self.room[a] and potential[u] + self.cost[a] < potential[self.head[a]]:
                        potential[self.head[a]], changed = potential[u] + self.cost[a], True
            if not changed:
                break
        while sent < most:
            far = self._distances(s, potential)
            if far[t] == float("inf"):
                break
            potential = [p + min(d, far[t]) for p, d in zip(potential, far)]
            if gainful and potential[t] - potential[s] >= 0:
                break
            while sent < most and (gone := self._augment(s, t, most - sent, potential)):
                sent += gone
        return sent

    def _augment(self, s: int, t: int, most: int, potential: list[float]) -> int:
        """One path over arcs of no reduced cost."""
        came: dict[int, int] = {s: -1}
        stack = [s]
        while stack and t not in came:
            u = stack.pop()
            for a in self.out[u]:
                v = self.head[a]
                if self.room[a] and v not in came and self.cost[a] + potential[u] - potential[v] == 0:
                    came[v] = a
                    stack.append(v)
        if t not in came:
            return 0
        path, v = [], t
        while v != s:
            path.append(came[v])
            v = self.head[came[v] ^ 1]
        gone = min([most, *(self.room[a] for a in path)])
        for a in path:
            self.room[a] -= gone
            self.room[a ^ 1] += gone
        return gone


def shortfalls(margins: list[dict], cells: dict[tuple, int]) -> list[dict]:
    """Adds `scarce` and `conflict` to each margin: wanted rows that do not exist, and those the other dimension keeps out.

    Every margin demands its wanted rows.  They come through its availability
    arc and a cell, which answers a margin of each dimension, or through slack arcs: a cheap one behind the availability
    arc, a dear one beside it.  The dear one carries flow exactly where more is
    wanted than there is.
    """
    flow, arcs = Flow(), []
    for i, m in enumerate(margins):
        first, key = m["first"], (m["dim"], m["category"])
        ends = (("source", (key, "want")), ((key, "want"), (key, "have")), ((key, "have"), "sink"), ((key, "want"), "sink"))
        if not first:
            ends = tuple((b.replace("sink", "source") if isinstance(b, str) else b, "sink" if a == "source" else a) for a, b in ends)
        flow.arc(*ends[0], m["wanted"], WANTED)
        flow.arc(*ends[1], m["available"])
        arcs.append((flow.arc(*ends[3], m["wanted"], SCARCE), flow.arc(*ends[2], m["wanted"], CONFLICT)))
    dims = {m["first"]: m["dim"] for m in margins}
    for (a, b), n in cells.items():
        ka, kb = ((dims.get(True), a), "have"), ((dims.get(False), b), "have")
        if ka in flow.ids and kb in flow.ids:
            flow.arc(ka, kb, n)
    flow.send("source", "sink", sum(m["wanted"] for m in margins), gainful=True)
    return [m | {"scarce": flow.used(s), "conflict": flow.used(c)} for m, (s, c) in zip(margins, arcs)]


def spread(stock: np.ndarray, rows: np.ndarray, columns: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Proportional fitting of the stock to margins, no cell beyond its stock.

    Each cell's expected draw is stock x min(1, row factor x column factor), the
    form that shares of a random sample with these margins have.  It need not
    be exact: the integers come from a flow.
    """
    a, b = np.ones(len(rows)), np.ones(len(columns))
    for _ in range(rounds):
        for factor, goal, axis in ((a, rows, 1), (b, columns, 0)):
            got = (stock * np.minimum(1, np.outer(a, b))).sum(axis=axis)
            factor *= np.divide(goal, got, out=np.ones(len(goal)), where=got > 0)
            np.clip(factor, 0, 1e12, out=factor)
    return stock * np.minimum(1, np.outer(a, b))


def _margin_arcs(flow: Flow, margins: dict, keys: list[tuple], sample_size: int, scale: int) -> list[int]:
    """Arcs of each category's floor, target, fraction and rest; those of one category follow each other."""
    arcs = []
    for first, name in keys:
        ends = ("source", (first, name)) if first else ((first, name), "sink")
        m = margins.get((first, name))
        whole = m["share_bp"] * sample_size // 10_000 if m else 0
        part = bool(m and m["share_bp"] * sample_size % 10_000)
        floor = m["min_rows"] if m else 0
        arcs.append(flow.arc(*ends, floor, FLOOR * scale))
        arcs.append(flow.arc(*ends, whole - floor, TARGET * scale))
        arcs.append(flow.arc(*ends, int(part and whole >= floor), FRACTION * scale))
        arcs.append(flow.arc(*ends, sample_size, (BEYOND if m else UNTARGETED) * scale))
    return arcs


def cell_quotas(margins: list[dict], cells: dict[tuple, int], sample_size: int, seed: int | str = 0) -> dict[tuple, int]:
    """Rows to draw from each cell, at random: floors before targets before fractions of a row before rows beyond the targets.

    A first flow gives the margins that can be had; which of equally good ones
    is left to chance.  Its cells would be those of one corner of all optimal
    flows, so the cells are spread in proportion to what there is, and a second
    flow with the same costs rounds them: a cell's whole part is dear to leave
    out, rows beyond the next are dear to add, and the next row is cheap with
    the probability of the share's fraction.  Costs of margins come before all
    of these.
    """
    rng, of = random.Random(f"{seed}"), {(m["first"], m["category"]): m for m in margins if m["category"] is not None}
    cells = {cell: n for cell, n in sorted(cells.items(), key=lambda x: str(x[0])) if n > 0}
    keys = [(True, a) for a in dict.fromkeys(a for a, _ in cells)] + [(False, b) for b in dict.fromkeys(b for _, b in cells)]
    rng.shuffle(keys)
    order = list(cells)
    rng.shuffle(order)

    flow = Flow()
    arcs = _margin_arcs(flow, of, keys, sample_size, 1)
    for a, b in order:
        flow.arc((True, a), (False, b), cells[a, b])
    sent = flow.send("source", "sink", sample_size)
    total = {k: sum(flow.used(x) for x in arcs[4 * i : 4 * i + 4]) for i, k in enumerate(keys)}

    names = [[name for first, name in keys if first == side] for side in (True, False)]
    stock = np.array([[cells.get((a, b), 0) for b in names[1]] for a in names[0]], dtype=float).reshape(len(names[0]), len(names[1]))
    goals = [np.array([total[side, name] for name in own], dtype=float) for side, own in zip((True, False), names)]
    share = spread(stock, *goals)
    at = [{name: i for i, name in enumerate(own)} for own in names]

    flow = Flow()
    dear = UNLIKELY * (len(keys) + 1)  # more than the next rows of all cells that one change can go through
    _margin_arcs(flow, of, keys, sample_size, 2 * dear * (len(keys) + 1))
    parts = {}
    for a, b in order:
        n, x = cells[a, b], float(share[at[0][a], at[1][b]])
        whole = min(n, int(x + 1e-6))
        likely = rng.random() < x - whole
        ends = ((True, a), (False, b))
        parts[a, b] = (flow.arc(*ends, whole, -dear), flow.arc(*ends, min(1, n - whole), LIKELY if likely else UNLIKELY), flow.arc(*ends, n - whole - 1, dear))
    flow.send("source", "sink", sent)
    return {cell: n for cell, own in parts.items() if (n := sum(map(flow.used, own)))}


def bare_category(c: Column) -> Column:
    """Category without case and surrounding blanks; null for a null, blank or NA one."""
    bare = F.upper(F.trim(c))
    return F.when(~bare.isin("", "NA"), bare)


def _prepared(candidates: DataFrame, targets: DataFrame, dims: tuple[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = candidates.where("candidate_id is not null").select(
        "release_tag", "candidate_id", *[bare_category(F.col(d)).alias(f"__{i}") for i, d in enumerate(dims)]
    )
    wanted = targets.where(F.col("dim").isin(*dims)).select(
        "release_tag", "dim", "category", bare_category(F.col("category")).alias("__cat"), "share_bp", "min_rows", "sample_size"
    ).distinct()
    has = (
        rows.select("release_tag", "candidate_id", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(f"__{i}").alias("__cat")) for i, d in enumerate(dims)])).alias("x"))
        .select("release_tag", "candidate_id", "x.dim", "x.__cat").where("__cat is not null")
        .groupBy("release_tag", "dim", "__cat").agg(F.countDistinct("candidate_id").alias("available"))
    )
    margins = wanted.join(has, ["release_tag", "dim", "__cat"], "left").fillna(0, ["available"])
    once = rows.groupBy("release_tag", "candidate_id").agg(F.min(F.struct("__0", "__1")).alias("c")).select(
        "release_tag", "candidate_id", "c.__0", "c.__1"
    )
    for i, d in enumerate(dims):  # a category that no target names is none
        named = wanted.where(F.col("dim") == d).select("release_tag", F.col("__cat").alias(f"__{i}"), F.lit(True).alias("__named")).distinct()
        once = once.join(named, ["release_tag", f"__{i}"], "left").withColumn(f"__{i}", F.when(F.col("__named"), F.col(f"__{i}"))).drop("__named")
    cells = once.groupBy("release_tag", "__0", "__1").agg(F.count("*").alias("__n"))
    return margins, once, cells


def _solved(margins: DataFrame, cells: DataFrame, dims: tuple[str, str], schema: str, make) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        for m in rows:
            m["first"] = m["dim"] == dims[0]
            m["wanted"] = max(m["min_rows"] or 0, -(-(m["sample_size"] or 0) * (m["share_bp"] or 0) // 10_000))
            m["share_bp"], m["min_rows"] = m["share_bp"] or 0, m["min_rows"] or 0
        stock = {(r["__0"], r["__1"]): r["__n"] for r in right.to_pylist()}
        return make(rows, stock)

    sides = [df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy("release_tag") for df in (margins, cells)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def target_report(candidates: DataFrame, targets: DataFrame, dims: tuple[str, str] = ("population", "centre_name")) -> DataFrame:
    """release_tag, dim, category, wanted, available, scarce, conflict for each row of targets.

    wanted: the larger of min_rows and sample_size x share_bp / 10,000 rounded
    up.  available: different candidate_ids of that category, ignoring case and
    surrounding blanks.  scarce: wanted rows that do not exist.  conflict:
    wanted rows that exist and cannot all be had together with what the other
    dimension wants.  Null, blank and NA categories are none; candidates
    without an id cannot be counted; repeated candidates and repeated targets
    count once.  Groups are
    one release's cross-classified counts, never its candidates.
    """
    margins, _, cells = _prepared(candidates, targets, dims)
    names = ["wanted", "available", "scarce", "conflict"]

    def make(rows: list[dict], stock: dict) -> pa.Table:
        for m in rows:
            m["key"], m["category"] = m["category"], m["__cat"]
        found = shortfalls(rows, stock)
        return pa.table(
            {n: pa.array([m[k] for m in found], pa.string()) for n, k in (("release_tag", "release_tag"), ("dim", "dim"), ("category", "key"))}
            | {n: pa.array([m[n] for m in found], pa.int64()) for n in names}
        )

    return _solved(
        margins, cells, dims, "release_tag string, dim string, category string, " + ", ".join(f"{n} long" for n in names), make
    )


def matched_sample(
    candidates: DataFrame, targets: DataFrame, dims: tuple[str, str] = ("population", "centre_name"), seed: int = 17
) -> DataFrame:
    """release_tag, candidate_id and the two categories (upper case) of a sample for each release in targets.

    Integer quotas of the cells of both dimensions are drawn at random among the
    least costly flows of sample_size units, in proportion to what each cell
    has; within a cell candidates are drawn in the order of a seeded hash of
    their id.  One seed gives one sample, whatever fails and is run again.  A release with fewer candidates than its sample
    size gives all it may.  Each cell is first cut to its quota in 16 parts, so
    that one task never ranks a whole hot cell.
    """
    margins, once, cells = _prepared(candidates, targets, dims)

    def make(rows: list[dict], stock: dict) -> pa.Table:
        for m in rows:
            m["category"] = m["__cat"]
        tag = rows[0]["release_tag"] if rows else None
        quotas = cell_quotas(rows, stock, max((m["sample_size"] or 0 for m in rows), default=0), f"{seed} {tag}") if rows else {}
        return pa.table(
            {
                "release_tag": pa.array([tag] * len(quotas), pa.string()),
                "__0": pa.array([c[0] for c in quotas], pa.string()),
                "__1": pa.array([c[1] for c in quotas], pa.string()),
                "__quota": pa.array(list(quotas.values()), pa.int64()),
            }
        )

    quotas = _solved(margins, cells, dims, "release_tag string, __0 string, __1 string, __quota long", make)
    o, q = once.alias("o"), quotas.alias("q")
    drawn = o.join(
        q,
        F.col("o.release_tag").eqNullSafe(F.col("q.release_tag")) & F.col("o.__0").eqNullSafe(F.col("q.__0")) & F.col("o.__1").eqNullSafe(F.col("q.__1")),
    ).select("o.*", "__quota").withColumn("__draw", F.xxhash64(F.lit(seed), "candidate_id"))
    cell = ["release_tag", "__0", "__1"]
    order = ["__draw", "candidate_id"]
    salted = drawn.withColumn("__salt", F.pmod(F.xxhash64("candidate_id"), F.lit(SALTS)))
    part = salted.withColumn("__rank", F.row_number().over(W.partitionBy(*cell, "__salt").orderBy(*order))).where("__rank <= __quota")
    final = part.withColumn("__rank", F.row_number().over(W.partitionBy(*cell).orderBy(*order))).where("__rank <= __quota")
    return final.select("release_tag", "candidate_id", F.col("__0").alias(dims[0]), F.col("__1").alias(dims[1]))
