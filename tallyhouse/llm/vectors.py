"""Near-duplicate vectors by randomised-rotation binary codes.

Every unit vector o is rotated by one random orthogonal matrix and stored as
the signs of the result (its binary code) with one correction factor, the
inner product <code, o>. For a query q, <code, q> / <code, o> estimates <o, q>
without bias, and its error is below ``sureness`` standard errors of
sqrt(1 - <o, q>²) sqrt((1 - f²) / f²) / sqrt(D - 1) with f the factor. At the
limit or above it the first root is sqrt(1 - limit²) at most, so pairs whose
estimate falls short of the limit by more than that allows are dropped; the
others are computed exactly, in double precision.

Pairs to estimate come from cells: centroids are fitted on a bounded sample,
every vector has its nearest cell as home and also visits every cell whose
border with its home is within half the limit's angle. Of two linked vectors
with different homes, the angles to the border between these add up to the
limit's angle at most, so one of the two visits the other's home: no link is
lost however many cells there are. Cells are large: to estimate a vector
against some thousands of others costs less than to ship it to one more cell.
A cell's vectors are dealt to blocks, and each pair of blocks is one piece of
work, so a cell with very many vectors is not one task. A piece is worked off
in strips of a bounded number of pairs; what leaves it is one row per vector,
with its number of links and a vector it is connected to, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import components, slices
from tallyhouse.session import written


class Plan(NamedTuple):
    """``limit``: least cosine of a link; ``cell_rows``: vectors wanted per cell; ``probes``: cells a vector
    is compared in at least, more as the limit demands; ``block``: vectors per block; ``strip``: pairs estimated
    at once; ``sample`` bounds the vectors that centroids are fitted on and ``most_cells`` the cells;
    ``sureness``: standard errors of the bound; a linked pair falls out with a chance below one in three million."""
    limit: float = 0.9
    cell_rows: int = 8192
    probes: int = 1
    block: int = 8192
    strip: int = 1 << 22
    sample: int = 20_000
    most_cells: int = 4096
    sureness: float = 5.0
    seed: int = 7


class Index(NamedTuple):
    """Centroids and rotation by the number of components."""
    centroids: dict[int, np.ndarray]
    rotations: dict[int, np.ndarray]
    offsets: dict[int, int]


def units(vectors: list) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so squares neither vanish nor overflow."""
    rows = np.asarray(vectors, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit(classes: DataFrame, plan: Plan) -> Index:
    """Spherical k-means of a few rounds on a sample drawn by a hash of the vectors."""
    total = classes.count()
    share = min(1.0, plan.sample / max(total, 1))
    drawn = F.xxhash64("embedding", F.lit("centroids")).bitwiseAND(F.lit((1 << 40) - 1)) < share * (1 << 40)
    rows = [row.embedding for row in classes.where(drawn).select("embedding").collect()]  # about plan.sample
    dims = sorted({row.n for row in classes.select(F.size("embedding").alias("n")).distinct().collect()})
    centroids, rotations, offsets, at = {}, {}, {}, 0
    draw = np.random.default_rng(plan.seed)
    for dim in dims:
        own = [row for row in rows if len(row) == dim]
        points = units(own) if own else np.eye(1, dim)
        wanted = math.ceil(total * share * len(own) / max(len(rows), 1) / share / plan.cell_rows) if own else 1
        k = max(1, min(wanted, plan.most_cells, len(points)))
        centres = points[draw.choice(len(points), k, replace=False)]
        for _ in range(6):
            nearest = (points @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points)
            norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
        centroids[dim], offsets[dim] = centres, at
        at += k
        rotations[dim] = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
    return Index(centroids, rotations, offsets)


_PLACED = "cell int, home int, probes array<int>, cid long, copies long, vector binary, code binary, factor float"


def visited(unit: np.ndarray, centres: np.ndarray, plan: Plan) -> list[np.ndarray]:
    """For each row the cells it is compared in: its home first, then the others within half the limit's angle of the border."""
    near = unit @ centres.T
    home = near.argmax(axis=1)
    squares = (centres * centres).sum(axis=1)
    apart = np.sqrt(np.maximum(squares[home][:, None] + squares - 2 * centres[home] @ centres.T, 0))
    reach = math.sin(math.acos(min(1.0, max(-1.0, plan.limit))) / 2)
    # A cosine that rounds up to the limit may come with an angle a little beyond it.
    cross = near[np.arange(len(unit)), home][:, None] - near <= reach * apart + 1e-7
    order = np.argsort(-near, axis=1, kind="stable")
    cross[np.arange(len(unit))[:, None], order[:, :plan.probes]] = True
    return [cells[row[cells]] for cells, row in zip(order, cross)]


def _placed(classes: DataFrame, index: Index, plan: Plan) -> DataFrame:
    """One row per class and cell it is compared in, with code and correction factor."""
    schema = pa.schema([("cell", pa.int32()), ("home", pa.int32()), ("probes", pa.list_(pa.int32())),
                        ("cid", pa.int64()), ("copies", pa.int64()), ("vector", pa.binary()),
                        ("code", pa.binary()), ("factor", pa.float32())])
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches):
            vectors = batch.column("embedding").to_pylist()
            for dim in {len(v) for v in vectors}:
                some = [i for i, v in enumerate(vectors) if len(v) == dim]
                unit = units([vectors[i] for i in some])
                visits = visited(unit, index.centroids[dim], plan)
                rotated = unit @ index.rotations[dim].T
                codes = np.packbits(rotated > 0, axis=1)
                factors = (np.abs(rotated).sum(axis=1) / math.sqrt(dim)).astype(np.float32)
                sizes = np.array([len(cells) for cells in visits])
                cells = (np.concatenate(visits) + index.offsets[dim]).astype(np.int32)
                row = np.repeat(np.arange(len(some)), sizes)
                first = (np.cumsum(sizes) - sizes)[row]
                # Only at home a vector is asked which cells it visits.
                upto = np.append(np.where(np.arange(len(row)) == first, first, first + sizes[row]), len(row))
                own = [batch.column(c).take(pa.array(some)) for c in ("cid", "copies")]
                wide = [pa.array([x.tobytes() for x in part], pa.binary()) for part in (unit, codes)]
                for at in range(0, len(row), 4096):
                    part = slice(at, at + 4096)
                    of = pa.array(row[part])
                    bounds = upto[at:at + len(of) + 1]
                    probes = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)),
                                                      pa.array(cells[bounds[0]:bounds[-1]]))
                    columns = [pa.array(cells[part]), pa.array(cells[first[part]]), probes, *(c.take(of) for c in own),
                               *(c.take(of) for c in wide), pa.array(factors[row[part]])]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return classes.mapInArrow(run, _PLACED)


class _Side(NamedTuple):
    """Vectors of one side of a piece; ``visitor`` and ``cell`` list the cells each one visits."""
    cid: np.ndarray
    copies: np.ndarray
    home: np.ndarray
    visitor: np.ndarray
    cell: np.ndarray
    unit: np.ndarray
    code: list
    factor: np.ndarray


def _side(rows: pa.Table) -> _Side:
    rows = rows.combine_chunks()
    probes = rows.column("probes")
    cells = np.concatenate([part.flatten().to_numpy() for part in probes.chunks])
    visitor = np.repeat(np.arange(len(rows)), pc.list_value_length(probes).to_numpy())
    unit = np.frombuffer(b"".join(rows.column("vector").to_pylist()), np.float64).reshape(len(rows), -1)
    return _Side(*(rows.column(c).to_numpy() for c in ("cid", "copies", "home")), visitor, cells,
                 unit, rows.column("code").to_pylist(), rows.column("factor").to_numpy().astype(np.float64))


def _signs(codes: list, factors: np.ndarray, dim: int) -> np.ndarray:
    """Codes as rows of numbers, corrected by their factors."""
    bits = np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1, count=dim)
    return (bits.astype(np.float32) * 2 - 1) / (math.sqrt(dim) * factors[:, None]).astype(np.float32)


def _spread(factors: np.ndarray, dim: int, sureness: float) -> np.ndarray:
    return sureness * np.sqrt(np.maximum(1 - factors ** 2, 0)) / factors / math.sqrt(max(dim - 1, 1))


def estimates(codes: list, factors: np.ndarray, queries: np.ndarray, sureness: float) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the inner products (one row per code) and each code's bound of the error.

    The bound holds for any inner product x; it may be multiplied by sqrt(1 - x²).
    """
    dim = queries.shape[1]
    return _signs(codes, factors, dim) @ queries.T.astype(np.float32), _spread(factors, dim, sureness)


def _links(members: _Side, queries: _Side, same: bool, rotation: np.ndarray,
           plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs (member, query), each pair of vectors once, a strip of members at a time."""
    dim = len(rotation)
    signs = _signs(members.code, members.factor, dim)
    turned = (queries.unit @ rotation.T).astype(np.float32).T
    # float32 sums may be off by a few units in the last place, which the bound need not cover.
    least = (plan.limit - 1e-5 - math.sqrt(max(1 - plan.limit ** 2, 0))
             * _spread(members.factor, dim, plan.sureness)).astype(np.float32)
    # Found from the other cell as well if the member visits it: the smaller cell counts it.
    homes, home = np.unique(queries.home, return_inverse=True)
    elsewhere = np.zeros((len(signs), len(homes)), bool)
    place = np.minimum(np.searchsorted(homes, members.cell), len(homes) - 1)
    meant = (homes[place] == members.cell) & (members.cell < members.home[members.visitor])
    elsewhere[members.visitor[meant], place[meant]] = True
    step = max(1, plan.strip // len(queries.cid))
    for first in range(0, len(signs), step):
        left, right = np.nonzero(signs[first:first + step] @ turned >= least[first:first + step, None])
        left += first
        fine = ~elsewhere[left, home[right]]
        if same:
            fine &= left < right
        left, right = left[fine], right[fine]
        close = [np.einsum("ij,ij->i", members.unit[left[at:at + (1 << 16)]], queries.unit[right[at:at + (1 << 16)]]) >= plan.limit
                 for at in range(0, len(left), 1 << 16)]
        if close:
            close = np.concatenate(close)
            yield left[close], right[close]


def _connect(root: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Merge in place the groups that the pairs connect; ``root`` names each position's smallest one of its group."""
    while True:
        a, b = root[one], root[other]
        apart = a != b
        if not apart.any():
            return
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def vector_groups(table: DataFrame, plan: Plan = Plan(), id_column: str = "vec_id",
                  vector_column: str = "embedding") -> DataFrame:
    """One row per row of ``table``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Rows with equal vectors are one class until the end and link with each
    other. Vectors that are null, empty or zero or hold null or non-finite
    components link with nothing, as do vectors with another number of
    components. Null ids count as largest. A vector id that repeats is a
    vector of its own each time. An empty table gives no rows.
    """
    vector = F.col(vector_column)
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("embedding"), usable.alias("usable"))
    good = rows.where("usable").select("vec_id", "embedding")
    classes = written(good.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    index = fit(classes, plan)
    placed = written(_placed(classes.select("cid", "copies", "embedding"), index, plan), "placed")
    is_home = F.col("cell") == F.col("home")
    sizes = placed.groupBy("cell").agg(F.sum(is_home.cast("int")).alias("own"), F.sum((~is_home).cast("int")).alias("guests"))
    blocks = F.broadcast(sizes.select(  # one row per cell, at most plan.most_cells
        "cell", F.ceil(F.col("own") / plan.block).cast("int").alias("own_blocks"),
        F.ceil(F.col("guests") / plan.block).cast("int").alias("guest_blocks")))
    mark = F.xxhash64("cid", F.lit("block"))
    own = F.pmod(mark, F.greatest("own_blocks", F.lit(1))).cast("int")
    guest = F.pmod(mark, F.greatest("guest_blocks", F.lit(1))).cast("int") + F.col("own_blocks")
    upto = lambda first, last: F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    as_member = F.transform(upto(own, F.col("own_blocks") + F.col("guest_blocks") - 1), lambda j: F.struct(
        own.alias("i"), j.alias("j"), F.lit(True).alias("member")))
    as_query = F.transform(upto(F.lit(0), own - 1), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("member")))
    as_guest = F.transform(upto(F.lit(0), F.col("own_blocks") - 1), lambda i: F.struct(
        i.alias("i"), guest.alias("j"), F.lit(False).alias("member")))
    dealt = (placed.join(blocks, "cell")
             .withColumn("task", F.explode(F.when(is_home, F.concat(as_member, as_query)).otherwise(as_guest)))
             .select(F.struct("cell", "task.i", "task.j").alias("piece"), "task.member", "cid", "copies", "home", "probes",
                     "vector", "code", "factor"))
    shared = classes.sparkSession.sparkContext.broadcast(index)
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])

    def compare(piece: pa.Table) -> pa.Table:
        member = piece.column("member").to_numpy()
        place = piece.column("piece")[0].as_py()
        same = place["i"] == place["j"]
        if not member.any() or (not same and member.all()):
            return schema.empty_table()
        members = _side(piece.filter(pa.array(member)))
        queries = members if same else _side(piece.filter(pa.array(~member)))
        rotation = shared.value.rotations[members.unit.shape[1]]
        shift = 0 if same else len(members.cid)
        cids = members.cid if same else np.concatenate((members.cid, queries.cid))
        counts, root = np.zeros(len(cids), np.int64), np.arange(len(cids))
        for left, right in _links(members, queries, same, rotation, plan):
            np.add.at(counts, left, queries.copies[right])
            np.add.at(counts, right + shift, members.copies[left])
            _connect(root, left, right + shift)
        some = np.flatnonzero(counts)
        return pa.table({"u": pa.array(cids[some]), "v": pa.array(cids[root[some]]), "n": pa.array(counts[some])}, schema=schema)

    linked = written(dealt.groupBy("piece").applyInArrow(compare, "u long, v long, n long"), "linked")
    counted = linked.groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
    found = components(linked.select("u", "v"), "vectors").withColumnRenamed("node", "cid")
    placed_in = classes.select("cid", "first").join(found, "cid")
    # Stored for the same reason: one root may have very many members.
    of_root = written(placed_in.groupBy("root").agg(F.min("first").alias("lowest")), "lowest")
    lowest = placed_in.join(of_root, "root").select("cid", "lowest")
    # Stored, so that the join below shuffles both sides itself and a very common vector's rows can be split.
    told = written(classes.join(counted, "cid", "left").join(lowest, "cid", "left")
                   .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                           F.coalesce("lowest", "first").alias("component_id")), "told")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (good.join(told, "embedding").select("vec_id", "n_links", "component_id").unionAll(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
