"""Most similar vectors for every vector, by collision counting.

Vectors are put into overlapping cells around pivots. Inside a cell every vector is a query: its
projections on random lines are kept as sorted arrays, query-centred windows on them are widened
level by level (virtual rehashing), and vectors that fall into enough windows are verified by their
exact similarity. A query whose neighbours lie within a level's radius is settled; for those that are
left the windows widen until they hold the whole cell, which is then verified as a whole. Queries that
no cell settles are sent on to several wide cells, each of which they are compared with as a whole.

Defined results
* A vector is valid when it has ``dims`` finite values, not all zero; only ids in ``known`` count.
  Vectors need not be of unit length. Rows that repeat an id count once (the smallest vector).
* Each id gets at most k neighbours, never itself; ties go by id. Equal vectors are neighbours;
  the index holds one of them, and the others enter the lists by id.
* An empty table gives an empty result; fewer than k+1 vectors give all others. Extra columns
  are not read.
* Nothing is capped: a cell above ``Plan.cell`` members is cut into overlapping cells of its own, and
  where that can't make it smaller (copies) its blocks are compared one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavra.session import staged

#: Pivots are at most this many vectors, whatever the data's size; so is what is broadcast (25 MB at 192 dims).
MAX_PIVOTS = 32_768
#: Rows searched at once, columns counted or multiplied at once, and steps that a projection is kept in for each unit of length.
BLOCK, WIDTH, STEPS = 128, 4096, 32
#: Share of the pairs in a block's windows above which comparing every member is cheaper than counting.
DENSE = 0.04


@dataclass(frozen=True)
class Plan:
    dims: int = 192
    k: int = 5
    per_pivot: int = 2500  # vectors for each pivot
    probes: int = 4  # cells that each vector joins
    lines: int = 32  # projections
    share: float = 0.75  # of the windows that a candidate falls into
    reach: float = 1.5  # half window as a multiple of the radius
    radii: tuple[float, ...] = (0.57, 1.14)  # after the last one the windows hold the whole cell
    cell: int = 60_000  # members above which a cell is cut into overlapping ones
    wide: int = 10  # neighbours kept while searching
    settled: float = 0.5  # similarity of the k-th neighbour below which a query goes on to the wide cells
    far_pivot: int = 20_000  # vectors for each wide cell; every vector lies in one
    far_probes: int = 6  # wide cells that a query is compared with


def valid_vectors(vectors: DataFrame, known: DataFrame, dims: int = 192) -> DataFrame:
    """(num, id, vec): one row for each valid id, staged; ``known`` is a table of ids.

    Values stay as they are given: they compress far better than unit vectors, which are made
    where they are used. One shuffle both drops repeated rows and keeps the known ids.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            keep = np.flatnonzero(np.asarray(lists.value_lengths().fill_null(0)) == dims)
            if not len(keep):
                continue
            rows = lists.take(pa.array(keep))
            v = np.asarray(rows.flatten().cast(pa.float32()).to_numpy(zero_copy_only=False)).reshape(-1, dims)
            with np.errstate(all="ignore"):
                length = (v.astype(np.float64) ** 2).sum(1)
            ok = np.isfinite(v).all(1) & (length > 0)
            take = pa.array(keep[ok])
            values = pa.array(np.ascontiguousarray(v[ok]).ravel())
            offsets = pa.array(np.arange(0, (int(ok.sum()) + 1) * dims, dims, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), pa.ListArray.from_arrays(offsets, values)], ["id", "vec"])

    v = vectors.filter("id is not null").select("id", "vector").mapInArrow(check, "id string, vec array<float>").withColumn("known", F.lit(False))
    ids = known.filter("id is not null").select("id", F.lit(None).cast("array<float>").alias("vec"), F.lit(True).alias("known"))
    one = v.unionByName(ids).groupBy("id").agg(F.min("vec").alias("vec"), F.bool_or("known").alias("known")).filter("known and vec is not null")
    return staged(one.select(F.monotonically_increasing_id().alias("num"), "id", "vec"), "vectors")  # numbers are fixed once written


def matrix(column, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as unit vectors of float32."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.empty((0, dims), np.float32)
    v = np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float32).reshape(-1, dims)
    for a in range(0, len(v), 4096):
        part = v[a : a + 4096].astype(np.float64)
        v[a : a + 4096] = part / np.sqrt((part * part).sum(1))[:, None]
    return v


def choose_pivots(vectors: DataFrame, n: int, per_pivot: int, dims: int) -> np.ndarray:
    """The vectors with the smallest hashed ids, one for every ``per_pivot``."""
    want = int(min(MAX_PIVOTS, max(1, -(-n // per_pivot))))
    # hashes are even, so a share of them holds about as many rows; some more are taken, so that no sort is needed
    share = min(1.0, (want + 8 * want**0.5 + 64) / n)
    h = F.xxhash64("id")
    near = vectors if share == 1 else vectors.filter(h < F.lit(int(share * 2**64) - 2**63))
    rows = sorted((r for r in near.select(h.alias("h"), "id", "vec").collect()), key=lambda r: (r[0], r[1]))[:want]
    return matrix(pa.array([list(r[2]) for r in rows], pa.list_(pa.float32())), dims)


def nearest(v: np.ndarray, pivots: np.ndarray, t: int) -> np.ndarray:
    """Indexes of each row's t nearest pivots."""
    t = min(t, len(pivots))
    out = np.empty((len(v), t), np.int32)
    for a in range(0, len(v), 2048):
        s = v[a : a + 2048] @ pivots.T
        out[a : a + 2048] = np.argpartition(-s, t - 1, 1)[:, :t] if t < len(pivots) else np.arange(t)
    return out


def spread(vectors: DataFrame, plan: Plan) -> DataFrame:
    """(cell, id, vec): each vector once for every cell that it joins."""
    return _sent(vectors, _pivots(vectors, plan.per_pivot, plan.dims), plan.probes, plan.dims)


def _pivots(vectors: DataFrame, per_pivot: int, dims: int):
    n = vectors.count()
    return vectors.sparkSession.sparkContext.broadcast(choose_pivots(vectors, n, per_pivot, dims) if n else np.zeros((1, dims), np.float32))


def _sent(vectors: DataFrame, shared, probes: int, dims: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for b in batches:
            if b.num_rows:
                cells = nearest(matrix(b.column(1), dims), pivots, probes)
                take = pa.array(np.repeat(np.arange(b.num_rows), cells.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel(), pa.int32()), b.column(0).take(take), b.column(1).take(take)], ["cell", "id", "vec"])

    return vectors.select("id", "vec").mapInArrow(send, "cell int, id string, vec array<float>")


class Lists:
    """The best neighbours of each row so far: indexes and similarities, best first, ties by index."""

    def __init__(self, n: int, k: int):
        self.at, self.sim = np.full((n, k), -1, np.int32), np.full((n, k), -2, np.float32)

    def offer(self, rows: np.ndarray, at: np.ndarray, sim: np.ndarray) -> None:
        """Merge candidate lists (one row each) into those of ``rows``."""
        k = self.at.shape[1]
        at, sim = np.concatenate((self.at[rows], at), 1), np.concatenate((self.sim[rows], sim), 1)
        # equal candidates are neighbours after sorting by index; all but the first lose their similarity
        o = np.argsort(at, 1, kind="stable")
        at, sim = np.take_along_axis(at, o, 1), np.take_along_axis(sim, o, 1)
        sim[:, 1:][at[:, 1:] == at[:, :-1]] = -2
        sim[at < 0] = -2
        o = np.argsort(-sim, 1, kind="stable")[:, :k]
        self.at[rows], self.sim[rows] = np.take_along_axis(at, o, 1), np.take_along_axis(sim, o, 1)
        self.at[rows] = np.where(self.sim[rows] > -2, self.at[rows], -1)

    def offer_pairs(self, rows: np.ndarray, r: np.ndarray, at: np.ndarray, sim: np.ndarray) -> None:
        """The same from pairs sorted by ``r``, the place of their row in ``rows``."""
        if not len(r):
            return
        each = np.bincount(r, minlength=len(rows))
        some = np.flatnonzero(each)
        place = np.arange(len(r)) - np.repeat(np.cumsum(each) - each, each)
        row = np.searchsorted(some, r)
        wide, near = np.full((len(some), each.max()), -1, np.int32), np.full((len(some), each.max()), -2, np.float32)
        wide[row, place], near[row, place] = at, sim
        self.offer(rows[some], wide, near)


def collisions(lines: np.ndarray, rows: np.ndarray, lo: int, hi: int, half: int, need: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(place in rows, column) of the columns in ``need`` windows or more, or None where these are many."""
    start = (lines[:, rows].astype(np.int16) - half).astype(np.uint8)  # below zero it wraps, as the difference does
    found_r, found_c, most = [], [], DENSE * len(rows) * max(1, hi - lo)
    shape = (len(rows), min(WIDTH, max(0, hi - lo)))
    apart, inside, count = np.empty(shape, np.uint8), np.empty(shape, bool), np.empty(shape, np.uint8)
    for b in range(lo, hi, WIDTH):
        n = min(WIDTH, hi - b)
        count[:, :n] = 0
        for line, s in zip(lines, start):
            np.subtract(line[None, b : b + n], s[:, None], out=apart[:, :n])
            np.less_equal(apart[:, :n], np.uint8(2 * half), out=inside[:, :n])
            np.add(count[:, :n], inside[:, :n].view(np.uint8), out=count[:, :n])
        r, c = np.nonzero(count[:, :n] >= need)
        most -= len(r)
        if most < 0:
            return None
        found_r.append(r)
        found_c.append(c + b)
    if not found_r:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    r, c = np.concatenate(found_r), np.concatenate(found_c)
    order = np.argsort(r, kind="stable")
    return r[order], c[order]


def compare_all(x: np.ndarray, members: np.ndarray, rows: np.ndarray, lists: Lists, first: int = 0) -> None:
    """Offer these rows of x their neighbours among all of x, or those from ``first`` on."""
    k = lists.at.shape[1]
    for a in range(0, len(rows), 2 * BLOCK):
        own = rows[a : a + 2 * BLOCK]
        for b in range(first, len(x), WIDTH):
            sim = x[own] @ x[b : b + WIDTH].T
            here = np.flatnonzero((own >= b) & (own < b + WIDTH))
            sim[here, own[here] - b] = -2
            hit = sim >= np.maximum(lists.sim[members[own], k - 1], -1)[:, None]  # what may still enter a list
            if np.count_nonzero(hit) > DENSE * hit.size:
                m = min(k, sim.shape[1])
                at = np.argpartition(-sim, m - 1, 1)[:, :m] if m < sim.shape[1] else np.broadcast_to(np.arange(m), sim.shape)
                best = np.take_along_axis(sim, at, 1)
                lists.offer(members[own], np.where(best > -2, members[b : b + WIDTH][at], -1), best)
            else:
                r, c = np.nonzero(hit)
                lists.offer_pairs(members[own], r, members[b : b + WIDTH][c], sim[r, c])


def search_cell(v: np.ndarray, members: np.ndarray, lines: np.ndarray, lists: Lists, plan: Plan) -> None:
    """Offer each member its neighbours among the members."""
    members = members[np.argsort(lines[0, members], kind="stable")]
    own, x = np.ascontiguousarray(lines[:, members]), v[members]
    first, need = own[0].astype(np.int16), int(np.ceil(plan.share * len(lines)))
    left = []
    dense = [False] * len(plan.radii)  # windows of this radius were found to hold too much of this cell
    for a in range(0, len(members), BLOCK):
        active = np.arange(a, min(a + BLOCK, len(members)))
        for i, radius in enumerate(plan.radii):
            half = int(plan.reach * radius * STEPS)
            if half > 127 or dense[i] or not len(active):
                break
            # the sorted first line bounds what can lie in the windows of this block
            lo, hi = np.searchsorted(first, [first[active[0]] - half, first[active[-1]] + half + 1])
            found = collisions(own, active, int(lo), int(hi), half, need)
            if found is None:
                dense[i] = True
                break
            r, c = found
            r, c = r[c != active[r]], c[c != active[r]]
            lists.offer_pairs(members[active], r, members[c], np.einsum("ij,ij->i", x[active[r]], x[c]))
            # a query is settled when its k-th neighbour lies within the radius that was searched
            active = active[lists.sim[members[active], plan.k - 1] < 1 - radius * radius / 2]
        left.append(active)
    # the next windows hold the whole cell for all that is left
    compare_all(x, members, np.concatenate(left) if left else np.empty(0, np.int64), lists)


def cells_of(v: np.ndarray, members: np.ndarray, plan: Plan, depth: int = 0) -> Iterator[np.ndarray]:
    """The cell itself or, above ``plan.cell`` members, overlapping cells around some of them."""
    if len(members) <= plan.cell or depth == 4:
        yield members
        return
    pivots = v[members[:: plan.cell // 8]]
    near = nearest(v[members], pivots, plan.probes)
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    who = members[np.repeat(np.arange(len(members)), near.shape[1])[order]]
    for part in np.split(who, np.flatnonzero(np.diff(flat[order])) + 1):
        yield from cells_of(v, part, plan, depth + 1) if len(part) < 0.8 * len(members) else iter((part,))


def search_members(v: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, similarities) of each row's neighbours among the rows, -1 where there are fewer."""
    rng = np.random.default_rng(20240501)
    axes = rng.standard_normal((plan.dims, plan.lines)).astype(np.float32)
    lines = (np.clip(np.rint((v @ axes) * STEPS), -127, 127) + 128).astype(np.uint8).T.copy()
    lists = Lists(len(v), max(plan.k, plan.wide))
    for part in cells_of(v, np.arange(len(v)), plan):
        search_cell(v, part, lines, lists, plan)
    return _exact(v, lists)


def _exact(v: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """The lists with similarities in double precision: a pair has the same one wherever it is met."""
    sim = np.full(lists.at.shape, -2.0)
    for a in range(0, len(v), 512):
        near = lists.at[a : a + 512]
        sim[a : a + 512] = np.where(near >= 0, np.einsum("ijk,ik->ij", v[np.maximum(near, 0)].astype(np.float64), v[a : a + 512].astype(np.float64)), -2.0)
    order = np.lexsort((lists.at, -sim), axis=1)
    return np.take_along_axis(lists.at, order, 1), np.take_along_axis(sim, order, 1)


def sorted_members(table: pa.Table, dims: int, by: str = "id") -> tuple[pa.Array, np.ndarray]:
    """(ids, unit vectors) of a cell in the order of the ids, so that ties of similarity go by id."""
    table = table.select([by, "vec"]).combine_chunks()
    table = table.take(pc.sort_indices(table, sort_keys=[(by, "ascending")]))
    ids = table.column(by).combine_chunks()
    return ids, matrix(table.column("vec"), dims)


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vectors, copies): of equal vectors the one with the smallest id, and (id, rep) of all that have equals, staged.

    Vectors are equal when two hashes of theirs are, so only these are shuffled.
    """
    keyed = vectors.select("id", F.xxhash64("vec").alias("h"), F.hash("vec").alias("g"))
    groups = keyed.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep")).filter("n > 1")
    copies = staged(keyed.join(groups, ["h", "g"]).select("id", "rep"), "copies")
    return vectors.join(copies.filter("id <> rep").select("id"), "id", "left_anti"), copies


def with_copies(lists: DataFrame, copies: DataFrame, k: int) -> DataFrame:
    """(id, c) for every vector, from the lists (id, c) of the distinct ones: equal vectors come by id, k of each at most."""
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("id"))
    first = copies.withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy("rep").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    first = staged(first, "copies")
    near = lists.select("id", F.explode("c").alias("x")).join(first.withColumnRenamed("rep", "to"), F.col("x.neighbour") == F.col("to"), "left")
    each = near.select("id", "x.d", F.explode(F.coalesce("ids", F.array("x.neighbour"))).alias("neighbour"))
    full = each.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", "neighbour"))), 1, k).alias("c"))
    own = copies.join(first, "rep").join(full.withColumnRenamed("id", "rep"), "rep", "left")
    equal = F.transform(F.filter("ids", lambda i: i != F.col("id")), lambda i: F.struct(F.lit(-1.0).alias("d"), i.alias("neighbour")))
    none = F.array().cast("array<struct<d:double,neighbour:string>>")
    own = own.select("id", F.slice(F.sort_array(F.concat(equal, F.coalesce("c", none))), 1, k).alias("c"))
    return full.join(copies.select("id"), "id", "left_anti").unionByName(own)


def nearest_vectors(vectors: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(id, neighbour, similarity, rank): the k most similar vectors of each (id, vec)."""

    def search(table: pa.Table) -> pa.Table:
        ids, v = sorted_members(table, plan.dims)
        at, sim = search_members(v, plan)
        at, sim = at[:, : plan.k], sim[:, : plan.k]
        r, c = np.nonzero(at >= 0)
        return pa.table({"id": ids.take(pa.array(r)), "neighbour": ids.take(pa.array(at[r, c])), "similarity": pa.array(sim[r, c])})

    def search_far(table: pa.Table) -> pa.Table:
        """Neighbours of a wide cell's queries among its members; a query with the id of a member isn't its neighbour."""
        ids, v = sorted_members(table.filter(pc.invert(table.column("query"))), plan.dims)
        own, q = sorted_members(table.filter(table.column("query")), plan.dims)
        lists = Lists(len(q) + len(v), plan.wide)
        both = np.concatenate((q, v))
        compare_all(both, np.arange(len(both)), np.arange(len(q)), lists, first=len(q))
        at, sim = _exact(both, lists)
        r, c = np.nonzero(at[: len(q)] >= 0)
        near, asked = ids.take(pa.array(at[r, c] - len(q))), own.take(pa.array(r))
        out = pa.table({"id": asked, "neighbour": near, "similarity": pa.array(sim[r, c])})
        return out.filter(pc.not_equal(near, asked))

    schema = "id string, neighbour string, similarity double"
    one, copies = distinct_vectors(vectors)
    lists = staged(_merged(spread(one, plan).groupBy("cell").applyInArrow(search, schema), plan.k), "lists")
    # queries without k neighbours of the similarity that settles them go on to wide cells
    last = F.get("c", F.lit(plan.k - 1))["d"]
    settled = lists.filter(F.coalesce(last <= -plan.settled, F.lit(False)))
    pivots = _pivots(one, plan.far_pivot, plan.dims)
    asked = one.join(settled.select("id"), "id", "left_anti")
    members, queries = _sent(one, pivots, 1, plan.dims).withColumn("query", F.lit(False)), _sent(asked, pivots, plan.far_probes, plan.dims).withColumn("query", F.lit(True))
    far = members.unionByName(queries).groupBy("cell").applyInArrow(search_far, schema)
    near = lists.join(settled.select("id"), "id", "left_anti").select("id", F.explode("c").alias("x")).select("id", "x.neighbour", (-F.col("x.d")).alias("similarity"))
    lists = settled.unionByName(_merged(far.unionByName(near), plan.k))
    if copies.limit(1).count():
        lists = with_copies(staged(lists, "lists"), copies, plan.k)  # read twice, searched once
    top = lists.select("id", F.posexplode("c").alias("p", "x"))
    return top.select("id", "x.neighbour", (-F.col("x.d")).alias("similarity"), (F.col("p") + 1).alias("rank"))


def _merged(found: DataFrame, k: int) -> DataFrame:
    """(id, c): the k best of the candidates (id, neighbour, similarity), of which each of a few cells gives a few."""
    best = found.groupBy("id").agg(F.collect_set(F.struct((-F.col("similarity")).alias("d"), "neighbour")).alias("c"))
    # a pair may be met in several cells; the first of each neighbour stays
    once = F.aggregate(F.sort_array("c"), F.array().cast("array<struct<d:double,neighbour:string>>"),
                       lambda a, x: F.when(F.exists(a, lambda y: y["neighbour"] == x["neighbour"]), a).otherwise(F.concat(a, F.array(x))))
    return best.select("id", F.slice(once, 1, k).alias("c"))


def mutual_pairs(found: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b: pairs of at least this similarity where each is among the other's neighbours."""
    p = found.filter(F.col("similarity") >= least).select(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b"))
    return p.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select("a", "b")
