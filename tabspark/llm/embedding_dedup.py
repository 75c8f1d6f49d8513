"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors of one label link when their cosine reaches the threshold.  Unit
vectors are rotated onto the principal axes of all vectors, so the leading
coordinates hold most of their length, and are sorted by label and by the
interleaved bits of the leading coordinates.  Runs of ``TILE`` of them are stored
as files once; a manifest has each tile's box over the first ``BOX`` axes.  Two
linked unit vectors lie within r = sqrt(2 - 2 threshold), so only tiles of a
label whose boxes come that near make a pair, and what is shuffled then is
pairs of tile names: a task reads its tiles from the files.  It multiplies the
leading coordinates of two tiles first, bounds what is left by the product of the
suffix norms, and goes on with the next coordinates only where the cosine can
still reach the threshold; survivors are compared exactly in double precision on
the vectors as given.

Scale: equal vectors of a label are one before comparing; a label or region with
a third of all rows is many tiles.  Vectors are shuffled once, for the sort; pairs
of tiles, of names and boxes, grow with the square of a region's tiles (rows /
``TILE``).  A task returns link counts per vector and a spanning forest, never the
pairs.  The rotation is one d x d matrix per dimension, from a sum over all vectors.
Files of attempts that didn't count are in no manifest and go with the others.

Defined results: vectors that are null, empty, zero, hold a null or non-finite
component or have no label link with nothing, nor do vectors of different
dimensions.  Every row counts as a vector, also repeated ones.  The component
id is the smallest vec_id reachable (nulls are passed over).  Other columns are
left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ..operators.rank import target_partitions
from ..session import checkpoint_dir, drop_stages, stage
from .arrow import file_system
from .components import components

TILE = 4096
CHUNK = 1024  # rows of a tile that are multiplied at once
LEAD, BITS, BOX = 4, 8, 8  # axes and bits of the sort, axes of a tile's box
DENSE = 0.05  # share of a chunk's pairs above which all go on together
PAIRS_PER_TASK = 16
CELL = 0.05  # least width of the cells in which tiles meet
STEPS = (4, 8, 16, 32)
SLACK = 1e-9
PIECE = 1 << 18


def _items(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v, key): v the double vector and key the digest of label and vector, null where it can't link."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("label").isNotNull() & (F.size(v) > 0)
            & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(v, lambda x: x != 0))
    key = F.unhex(F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.to_json(F.struct(v))).cast("binary"), 256))
    return rows.select("vec_id", "label", F.when(fine, v).alias("v"), F.when(fine, key).alias("key"))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that squares neither vanish nor overflow."""
    w = v / np.abs(v).max(axis=1, keepdims=True)
    return w / np.sqrt((w * w).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column])


def axes(items: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the principal axes (columns, largest first) of all unit vectors."""
    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.diff(batch.column(0).offsets.to_numpy())
            for d in np.unique(dims).tolist():
                u = unit(_rows(batch.column(0), np.flatnonzero(dims == d), d))
                total[d] = total.get(d, 0) + u.T @ u
        for d, m in total.items():
            for i, row in enumerate(m):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([row.tolist()], pa.list_(pa.float64()))],
                                                 names=["d", "i", "row"])

    def add(key, frame):
        return pd.DataFrame({"d": [key[0]], "i": [key[1]], "row": [_matrix(frame["row"]).sum(axis=0).tolist()]})

    schema = "d int, i int, row array<double>"
    rows = items.select("v").mapInArrow(sums, schema).groupBy("d", "i").applyInPandas(add, schema).collect()
    out = {}
    for d in {r["d"] for r in rows}:
        gram = np.array([r["row"] for r in sorted((r for r in rows if r["d"] == d), key=lambda r: r["i"])])
        out[d] = np.linalg.eigh(gram)[1][:, ::-1].copy()
    return out


def _rows(column: pa.Array, at: np.ndarray, d: int) -> np.ndarray:
    """The lists at ``at``, all of d elements, as a matrix."""
    return column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)


def interleaved(lead: np.ndarray) -> np.ndarray:
    """One number whose bits are those of the coordinates (in -1..1) in turn, the highest first."""
    q = np.clip(((lead + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    out = np.zeros(len(lead), np.int64)
    for bit in range(BITS - 1, -1, -1):
        for c in range(q.shape[1]):
            out = out << 1 | (q[:, c] >> bit & 1)
    return out


def _placed(items: DataFrame, rotation) -> DataFrame:
    """Adds the dimension d and the place z in the order of the leading rotated coordinates."""
    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("v"))
            dims = np.diff(column.offsets.to_numpy()).astype(np.int32)
            z = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                z[at] = interleaved(unit(_rows(column, at, int(d))) @ rotation.value[int(d)][:, :LEAD])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), pa.array(z)], names=[*batch.schema.names, "d", "z"])

    return items.mapInArrow(run, StructType(list(items.schema.fields)).add("d", "integer").add("z", "long"))


def _write_tiles(placed: DataFrame, rotation, folder: str) -> DataFrame:
    """Manifest (label, d, tile, lo, hi) of files of at most ``TILE`` vectors of one label and dimension."""
    order = ["label", "d", "z", "key"]
    ranged = placed.repartitionByRange(target_partitions(placed), *order).sortWithinPartitions(*order).select("label", "d", "key", "many", "v")
    schema = StructType([placed.schema["label"]]).add("d", "integer").add("tile", "string").add("lo", ArrayType(DoubleType())).add("hi", ArrayType(DoubleType()))

    def run(batches):
        held, size = [], 0

        def flush():
            table = pa.concat_tables([pa.Table.from_batches([h]) for h in held]).combine_chunks()
            d = table.column("d")[0].as_py()
            raw = _rows(table.column("v").chunk(0), np.arange(table.num_rows), d)
            lead = unit(raw) @ rotation.value[d][:, :BOX]
            path = f"{folder}/tile-{uuid.uuid4().hex}"
            system, at = file_system(path)
            system.create_dir(at.rsplit("/", 1)[0], recursive=True)
            packed = pa.table({"key": table.column("key"), "many": table.column("many"), "raw": pa.array([r.tobytes() for r in raw], pa.binary())})
            with system.open_output_stream(at) as out, pa.ipc.new_stream(out, packed.schema) as sink:
                sink.write_table(packed)
            return pa.RecordBatch.from_arrays(
                [table.column("label").slice(0, 1).combine_chunks(), pa.array([d], pa.int32()), pa.array([path]),
                 pa.array([lead.min(axis=0).tolist()], pa.list_(pa.float64())), pa.array([lead.max(axis=0).tolist()], pa.list_(pa.float64()))],
                names=schema.names)

        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            i = 0
            while i < len(groups):
                j = i
                while j < len(groups) and groups[j] == groups[i] and size + j - i < TILE:
                    j += 1
                if held and (own != groups[i] or j == i):
                    yield flush()
                    held, size = [], 0
                    continue
                own = groups[i]
                held.append(batch.slice(i, j - i))
                size, i = size + j - i, j
        if held:
            yield flush()

    return stage(ranged.mapInArrow(run, schema), "tiles")


def near_tiles(tiles: DataFrame, radius: float) -> DataFrame:
    """(a, b): names of tiles of one label and dimension whose boxes come within ``radius``, a <= b."""
    width = max(radius, CELL)
    cell = lambda c, by: F.floor((F.element_at(c, 1) + by) / width)
    one = tiles.select("label", "d", F.col("tile").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha"),
                       F.explode(F.sequence(cell(F.col("lo"), 0.0), cell(F.col("hi"), 0.0))).alias("cell"))
    two = tiles.select("label", "d", F.col("tile").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"),
                       F.explode(F.sequence(cell(F.col("lo"), -radius), cell(F.col("hi"), radius))).alias("cell"))
    gaps = F.transform(F.arrays_zip("la", "ha", "lb", "hb"), lambda x: F.greatest(F.lit(0.0), x["la"] - x["hb"], x["lb"] - x["ha"]))
    near = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= radius * radius
    return one.join(two, ["label", "d", "cell"]).filter((F.col("a") <= F.col("b")) & near).select("a", "b").distinct()


def matches(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float,
            same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with cosine >= threshold; a and b are rotated unit vectors; ``same``: only i < j."""
    d = a.shape[1]
    steps = [s for s in STEPS if s < d] + [d]
    left = lambda u: [np.sqrt(np.maximum(0, (u[:, s:] ** 2).sum(axis=1))) for s in steps]
    rest_a, rest_b = left(a), left(b)
    norm_a, norm_b = np.sqrt((raw_a ** 2).sum(axis=1)), np.sqrt((raw_b ** 2).sum(axis=1))
    found_i, found_j = [], []
    for at in range(0, len(a), CHUNK):
        own, k = a[at:at + CHUNK], 0
        part = own[:, :steps[0]] @ b[:, :steps[0]].T
        while True:  # all pairs of the chunk, as long as many of them may still reach the threshold
            reach = part + rest_a[k][at:at + CHUNK, None] * rest_b[k] >= threshold - SLACK
            if same:
                reach &= np.arange(len(b)) > np.arange(at, at + len(own))[:, None]
            if k + 1 == len(steps) or np.count_nonzero(reach) <= DENSE * reach.size:
                break
            part += own[:, steps[k]:steps[k + 1]] @ b[:, steps[k]:steps[k + 1]].T
            k += 1
        i, j = np.nonzero(reach)
        part, i = part[i, j], i + at
        for k in range(k + 1, len(steps)):  # then the few one by one
            on = []
            for p in range(0, len(i), PIECE):
                x, y = i[p:p + PIECE], j[p:p + PIECE]
                z = part[p:p + PIECE] = part[p:p + PIECE] + np.einsum("ij,ij->i", a[x, steps[k - 1]:steps[k]], b[y, steps[k - 1]:steps[k]])
                on.append(z + rest_a[k][x] * rest_b[k][y] >= threshold - SLACK)
            if on:
                on = np.concatenate(on)
                i, j, part = i[on], j[on], part[on]
        for p in range(0, len(i), PIECE):
            x, y = i[p:p + PIECE], j[p:p + PIECE]
            sure = np.einsum("ij,ij->i", raw_a[x], raw_b[y]) / (norm_a[x] * norm_b[y]) >= threshold
            found_i.append(x[sure])
            found_j.append(y[sure])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links (i, j) among n nodes, by passing the least label along."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(x), int(r)) for x, r in enumerate(label) if x != r]


def compare(distinct: DataFrame, threshold: float) -> DataFrame:
    """(key, other, links), staged: rows with links count a vector's links, rows with other are edges."""
    spark = distinct.sparkSession
    rotation = spark.sparkContext.broadcast(axes(distinct))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tiles-{uuid.uuid4().hex}"
    placed = stage(_placed(distinct, rotation), "placed")
    tiles = _write_tiles(placed, rotation, folder)
    pairs = stage(near_tiles(tiles, math.sqrt(2 - 2 * threshold) + SLACK), "tile-pairs")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // PAIRS_PER_TASK))

    def load(path):
        system, at = file_system(path)
        with system.open_input_stream(at) as f:
            table = pa.ipc.open_stream(f).read_all()
        raw = np.stack([np.frombuffer(r, np.float64) for r in table.column("raw").to_pylist()])
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        return table.column("key").to_pylist(), table.column("many").to_numpy(), raw, unit(raw) @ rotation.value[raw.shape[1]]

    def run(batches):
        last, first = None, None
        for batch in batches:
            for name_a, name_b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if last != name_a:
                    last, first = name_a, load(name_a)
                same = name_a == name_b
                keys_a, many_a, raw_a, turned_a = first
                keys_b, many_b, raw_b, turned_b = first if same else load(name_b)
                i, j = matches(turned_a, turned_b, raw_a, raw_b, threshold, same)
                if not len(i):
                    continue
                n = 0 if same else len(keys_a)  # place of b's vectors behind a's
                keys, many = (keys_a, many_a) if same else (keys_a + keys_b, np.r_[many_a, many_b])
                j = j + n
                links = np.bincount(i, many[j], len(keys)) + np.bincount(j, many[i], len(keys))
                linked, edges = np.flatnonzero(links), forest(len(keys), i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[x] for x in linked] + [keys[x] for x, _ in edges], pa.binary()),
                     pa.array([None] * len(linked) + [keys[r] for _, r in edges], pa.binary()),
                     pa.array(links[linked].astype(np.int64).tolist() + [0] * len(edges), pa.int64())], names=["key", "other", "links"])

    dealt = pairs.repartition(tasks, F.xxhash64("a", "b")).sortWithinPartitions("a", "b")
    found = stage(dealt.mapInArrow(run, "key binary, other binary, links long"), "links")
    drop_stages(placed, tiles, pairs)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return found


def near_vectors(rows: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    items = stage(_items(rows), "vectors")
    distinct = stage(items.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("many")), "distinct")
    found = compare(distinct.select("key", "label", "v", "many"), threshold)
    links = found.filter("other is null").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.filter("other is not null").select(F.col("key").alias("u"), F.col("other").alias("v")))
    rooted = (distinct.select("key", "least", "many").join(links, "key", "left").join(roots, F.col("key") == F.col("node"), "left")
              .select("key", "least", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "key").alias("root")))
    rooted = stage(rooted, "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    decisions = stage(rooted.join(least, "root").select("key", "n_links", "component_id"), "decisions")
    drop_stages(distinct, found, rooted, least)
    out = items.select("vec_id", "key").join(decisions, "key", "left")
    group = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), group.cast("long").alias("component_id"),
                      F.col("vec_id").eqNullSafe(group).alias("kept"))
