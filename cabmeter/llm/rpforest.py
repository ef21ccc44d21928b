"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits its vectors again and again along random directions near the
median; vectors close to a split go to both sides (spill), so close pairs are
seldom parted, and over many trees hardly ever.  Vectors are compared within
leaves only, in double precision.

Trees are grown in passes.  In each, every leaf that is still too large gets
a subtree from a bounded sample of its own vectors, and all its vectors are
sent down that subtree.  So the leaves stay small at any size of the table,
and no task holds more than a sample or a block of a leaf.

Equal vectors are one vector with a weight.  Splits would part a crowd of near
copies, in which a vector has more links than a leaf has room for.  So where
the sample shows a crowd, a ball around one of its vectors is taken out first:
whatever is within the ball or linked to it goes to a leaf of its own, and what
is outside the ball goes on, which parts no link.  A leaf that is one crowd is
not split; large leaves are compared block by block.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabmeter.llm.components import components
from cabmeter.llm.tables import drop_written, written

TREES = 10
LEAF = 256
SPILL = 0.06
SAMPLE = 4096
LEVELS = 12
BLOCK = 2048
PART = 4096
CROWD = 0.1
THIN = 64
COLUMNS = 4096


def direction(seed: int, node: int, dims: int) -> np.ndarray:
    """A random unit vector that only the node's name decides."""
    v = np.random.default_rng([seed & (2**64 - 1), node]).standard_normal(dims)
    return v / np.linalg.norm(v)


def unit_vectors(column) -> np.ndarray:
    """The vectors of an Arrow list column, all of one length, at length 1."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    m = np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow of the squares
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _crowd(x: np.ndarray, least: float, share: float, leaf: int) -> tuple | None:
    """The ball of a crowd among sampled vectors: (pivot, cosine at its edge,
    cosine at which links of what it holds may end); None if there is none.

    A crowd is a vector's links, if they are a tenth of all and so many that
    leaves would part them.  The ball is the one, of four, with the fewest
    further vectors within a link of it.
    """
    some = x[:: -(-len(x) // 512)]
    near = (some @ some.T >= least).sum(axis=1)
    most = int(near.argmax())
    enough = max(CROWD * len(some), 4, leaf / 4 / (share * len(x) / len(some)))
    if near[most] < enough:
        return None
    cosine, far = x @ some[most], np.arccos(np.clip(least, -1, 1))
    found = None
    for part in (1, 2, 4, 8):
        edge, reach = np.cos(far / part), np.cos(min(far / part + far, np.pi))
        inner, outer = np.count_nonzero(cosine >= edge), np.count_nonzero(cosine >= reach)
        if part == 1 or inner >= CROWD * len(x) and outer / inner < found[0]:
            found = outer / max(inner, 1), some[most], edge, reach
    return found[1:]


def grow_subtree(seed: int, sample: np.ndarray, share: float, leaf: int, spill: float, levels: int, least: float) -> bytes:
    """Splits for a leaf from a sample of its vectors.

    share: how many of its vectors each sampled one stands for.  Returns
    (node, low, high, dims, direction): vectors up to high along the direction
    go left, those from low on go right.  dims is 0 if only the node's name
    decides the direction, which is a crowd's pivot else, reversed.  A node is
    split until about ``leaf`` vectors are left, or the sample is too thin, or
    it is one crowd, or splitting does not divide it.
    """
    out = []

    def split(node: int, at: np.ndarray, level: int) -> None:
        if level == levels or len(at) * share <= leaf or len(at) < (THIN if share > 1 else 16):
            return
        own, ball = sample[at], b""
        crowd = _crowd(own, least, share, leaf)
        if crowd:
            pivot, edge, reach = crowd
            x, low, high, ball = -(own @ pivot), -edge - 1e-9, -reach + 1e-9, (-pivot).tobytes()
            if np.count_nonzero(x <= high) > 0.8 * len(at):
                return
        else:
            x = own @ direction(seed, node, sample.shape[1])
            low, high = np.quantile(x, [0.5 - spill, 0.5 + spill])
        left, right = at[x <= high], at[x >= low]
        if max(len(left), len(right)) > (0.95 if crowd else 0.8) * len(at):
            return
        out.append(struct.pack("<qddq", node, low, high, len(ball) // 8) + ball)
        split(2 * node, left, level + 1)
        split(2 * node + 1, right, level + 1)

    split(1, np.arange(len(sample)), 0)
    return b"".join(out)


def descend(seed: int, subtree: bytes, vectors: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The leaves of a subtree and the rows that reach each."""
    nodes, start = {}, 0
    while start < len(subtree):
        node, low, high, dims = struct.unpack_from("<qddq", subtree, start)
        nodes[node] = low, high, np.frombuffer(subtree, np.float64, dims, start + 32)
        start += 32 + 8 * dims
    done, todo = [], [(1, np.arange(len(vectors)))]
    while todo:
        node, at = todo.pop()
        if node not in nodes or not len(at):
            if len(at):
                done.append((node, at))
            continue
        low, high, ball = nodes[node]
        x = vectors[at] @ (ball if len(ball) else direction(seed, node, vectors.shape[1]))
        todo += [(2 * node, at[x <= high]), (2 * node + 1, at[x >= low])]
    return done


def _name(leaf: int, node: int) -> int:
    """The name of a node's leaf, from its tree's or parent leaf's name."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(struct.pack("<qq", leaf, node), digest_size=8).digest(), "little", signed=True)


def _grow(leaf: int, spill: float, levels: int, least: float):
    """From the sampled vectors of one leaf (leaf, vec, n): its subtree."""
    def work(table):
        import pyarrow as pa

        name = table["leaf"][0].as_py()
        m = unit_vectors(table["vec"])
        m = m[np.lexsort(m.T)]  # the same splits whatever order the rows come in
        tree = grow_subtree(name, m, table["n"][0].as_py() / len(m), leaf, spill, levels, least)
        return pa.table({"leaf": pa.array([name], pa.int64()), "subtree": pa.array([tree], pa.binary())})

    return work


def _route(rows, trees):
    """From vectors of one part of a leaf (id, leaf, part, vec) and the leaf's
    subtree: their new leaves."""
    import pyarrow as pa

    out_id, out_leaf = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if rows.num_rows and trees.num_rows:
        name, ids, m = rows["leaf"][0].as_py(), np.asarray(rows["id"]), unit_vectors(rows["vec"])
        for node, at in descend(name, trees["subtree"][0].as_py(), m):
            out_id.append(ids[at])
            out_leaf.append(np.full(len(at), _name(name, node)))
    return pa.table({"id": np.concatenate(out_id), "leaf": np.concatenate(out_leaf)})


def plant(vectors: DataFrame, trees: int, leaf: int, spill: float, sample: int, levels: int, least: float) -> DataFrame:
    """``(id, leaf)``: the leaves of every vector (id, vec) in all trees."""
    spark = vectors.sparkSession
    dims = F.size("vec")
    open_ = written(vectors.select("id", F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), dims.alias("d"))
                    .select("id", F.xxhash64("tree", "d").alias("leaf")), "leaves")
    closed = None
    while True:
        sizes = open_.groupBy("leaf").agg(F.count("*").alias("n"))
        big = written(sizes.where(F.col("n") > 2 * leaf), "big")
        small = open_.join(big, "leaf", "left_anti")
        closed = small if closed is None else closed.unionByName(small)
        if big.isEmpty():
            break
        rest = open_.join(big, "leaf")
        first = Window.partitionBy("leaf").orderBy(F.xxhash64("id", F.lit(7)), "id")
        # Salted: each part of a leaf offers its first, the best of those are the sample.
        offered = rest.withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / (8 * sample))))
        part = Window.partitionBy("leaf", "part").orderBy(F.xxhash64("id", F.lit(7)), "id")
        chosen = (offered.withColumn("r", F.row_number().over(part)).where(F.col("r") <= sample)
                  .withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample).select("id", "leaf", "n"))
        trees_ = written(chosen.join(vectors, "id").groupBy("leaf").applyInArrow(_grow(leaf, spill, levels, least), "leaf long, subtree binary"), "subtrees")
        dull = trees_.where("length(subtree) = 0").select("leaf")  # one crowd, or no split divides these
        closed = closed.unionByName(open_.join(dull, "leaf", "left_semi"))
        # A leaf goes down its subtree in parts of bounded size, each with one copy of the subtree.
        parts = F.ceil(F.col("n") / PART).cast("int")
        pieces = (trees_.where("length(subtree) > 0").join(big, "leaf")
                  .select("leaf", "subtree", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")))
        moved = (rest.withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), parts).cast("int"))
                 .join(vectors, "id").select("id", "leaf", "part", "vec")
                 .groupBy("leaf", "part").cogroup(pieces.groupBy("leaf", "part")).applyInArrow(_route, "id long, leaf long"))
        open_ = written(moved, "leaves")
    return written(closed.select("id", "leaf").distinct(), "planted")


def _earlier_leaves(leaves, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which leaves before this one the rows are in, if two rows or more are:
    (row, number of the leaf) in the order of leaves, and how many rows each
    leaf has."""
    import pyarrow as pa
    import pyarrow.compute as pc

    leaves = pa.concat_arrays(leaves.chunks)
    names = np.asarray(leaves.flatten())
    owner = np.repeat(np.arange(len(leaves)), np.asarray(pc.list_value_length(leaves)))
    owner, names = owner[names < leaf], names[names < leaf]
    _, which, counts = np.unique(names, return_inverse=True, return_counts=True)
    keep = counts[which] > 1
    owner, which = owner[keep], (np.cumsum(counts > 1) - 1)[which[keep]]
    order = np.argsort(which, kind="stable")
    return owner[order], which[order], counts[counts > 1]


def _compare(least: float):
    """Of one leaf's two blocks (leaf, i, j, side, id, vec, w, leaves): how
    many links each vector has that no earlier leaf shows, and links that join
    what those join.  A link counts as often as the other vector's weight w."""
    def work(table):
        import pyarrow as pa

        table = table.sort_by([("side", "ascending"), ("id", "ascending")])
        ids, side, weight = np.asarray(table["id"]), np.asarray(table["side"]), np.asarray(table["w"]).astype(np.float64)
        same = table["i"][0].as_py() == table["j"][0].as_py()
        a = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
        b = a if same else np.flatnonzero(side == 1)
        owner, which, counts = _earlier_leaves(table["leaves"], table["leaf"][0].as_py())
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        if not (counts == len(ids)).any():  # else an earlier leaf shows them all
            m = unit_vectors(table["vec"])
            near = m[a] @ m[b].T >= least
            near &= ids[a][:, None] != ids[b][None, :]
            linked = np.zeros(len(ids), bool)
            linked[a[near.any(axis=1)]] = True
            linked[b[near.any(axis=0)]] = True
            owner, which = owner[linked[owner]], which[linked[owner]]
            rows, columns = np.flatnonzero(linked[a]), np.flatnonzero(linked[b])
            cuts = np.searchsorted(which, np.arange(0, len(counts) + COLUMNS, COLUMNS))
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                distinct, column = np.unique(which[lo:hi], return_inverse=True)
                seen = np.zeros((len(ids), len(distinct)), np.float32)
                seen[owner[lo:hi], column] = 1
                for k in range(0, len(rows), 256):
                    part = rows[k: k + 256]
                    near[np.ix_(part, columns)] &= ~((seen[a[part]] @ seen[b[columns]].T) > 0)
            links[a] += (near @ weight[b]).astype(np.int64)
            if not same:
                links[b] += (weight[a] @ near).astype(np.int64)
            x, y = np.nonzero(near)
            pairs = np.column_stack((a[x], b[y]))
            if same:
                pairs = pairs[pairs[:, 0] < pairs[:, 1]]
            while len(pairs):  # smallest-label union of the block's links
                low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
                before = root.copy()
                np.minimum.at(root, pairs[:, 0], low)
                np.minimum.at(root, pairs[:, 1], low)
                np.minimum.at(root, before[pairs[:, 0]], low)
                np.minimum.at(root, before[pairs[:, 1]], low)
                root = root[root]
                if (root == before).all():
                    break
        out = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pa.table({"id": pa.array(ids[out]), "links": pa.array(links[out]), "other": pa.array(ids[root[out]])})

    return work


def embedding_components(df: DataFrame, least: float = 0.9, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL,
                         sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links and components of vectors with a cosine of at least ``least``.

    Returns ``id, n_links, component, kept``, one row per input row: n_links
    is the number of other vectors linked directly, component the smallest id
    reachable, kept marks it.  Cosines are in double precision; no link is
    below ``least``.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, and so do vectors of another
    number of components.  Rows with a null id link with nothing, have a null
    component and are kept.  Rows that repeat an id are one vector, the first
    by its components.  Further columns are ignored.  An empty table gives an
    empty result.

    Splits are fitted on at most ``sample`` vectors of a leaf; every vector
    is indexed.
    """
    # Floats travel as they are; tasks make doubles of them.
    kept = df.schema[vector_col].dataType.simpleString() == "array<float>"
    vec = F.col(vector_col) if kept else F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    vectors = written(rows.where(F.col("id").isNotNull() & sound).groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    classes = written(vectors.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("w")), "classes")
    copies = vectors.join(classes.where("w > 1").select("vec", F.col("id").alias("first"), "w"), "vec").select("id", "first", "w")
    planted = plant(classes.select("id", "vec"), trees, leaf, spill, sample, LEVELS, least)
    sizes = planted.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
    member = planted.groupBy("id").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (planted.join(sizes, "leaf").withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
              .select("id", "leaf", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o"))
              .select("id", "leaf", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") > F.col("o")).cast("int").alias("side")))
    found = written(placed.join(classes.join(member, "id"), "id").groupBy("leaf", "i", "j")
                    .applyInArrow(_compare(least), "id long, links long, other long"), "found")
    roots = components(found, "id", "other")
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    own = rows.select("id")
    if classes.where("w > 1").isEmpty():
        own = own.withColumns({"first": F.col("id"), "w": F.lit(1)})
    else:
        own = own.join(written(copies, "copies"), "id", "left").withColumn("first", F.coalesce("first", "id"))
    same = F.coalesce(F.col("w") - 1, F.lit(0)) * F.lit(int(least <= 1))
    out = (own.join(links.withColumnRenamed("id", "first"), "first", "left").join(roots.withColumnRenamed("node", "first"), "first", "left")
           .select("id", (F.coalesce("n_links", F.lit(0)) + same).cast("long").alias("n_links"), F.coalesce("root", "first").alias("component")))
    drop_written(vectors, planted)
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True)))
