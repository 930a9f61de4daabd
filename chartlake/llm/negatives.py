"""Hard negatives from Hilbert-ordered blocks of vectors with zone maps.

Candidates are laid out as a stored table of blocks, one row each, in the order of label and
Hilbert key, with the smallest and largest value of every dimension beside it. Interval
arithmetic over these bounds gives the highest and lowest score that an anchor can have in a
block, and so decides which blocks are read for which anchors. Consecutive blocks form a
stripe; the anchors of a stripe are read against a whole stripe of candidates in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlake.llm.shared import chosen, staged

SCALE = 256.0
BLOCK_ROWS = 512
STRIPE_ROWS = 16_384
# The Hilbert curve runs through the dimensions of largest variance, cut into 2^BITS cells.
CURVE_DIMS, BITS = 16, 4
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these shares (per cent) of the positive's.
LOW, HIGH = 50, 95

EXACT = float(2**53)

ROWS = "vec_id long, label int, data binary"
MOMENTS = "dim int, n long, total double, squares double"
KEYED = "vec_id long, label int, data binary, curve long"
BLOCKS = (
    "part int, first long, n int, label_low int, label_high int, "
    "low array<double>, high array<double>, ids binary, labels binary, data binary"
)


# --- vectors ------------------------------------------------------------------


def packed(matrix: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them, marked by the first byte."""
    most = float(np.abs(matrix).max()) if matrix.size else 0.0
    kind = "h" if most < 2**15 else "i" if most < 2**31 else "d"
    return kind.encode() + matrix.astype("<" + {"h": "i2", "i": "i4", "d": "f8"}[kind]).tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    kind = {"h": "<i2", "i": "<i4", "d": "<f8"}[chr(data[0])]
    flat = np.frombuffer(data, kind, offset=1).astype(np.float64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def widened(matrix: np.ndarray, dims: int) -> np.ndarray:
    """Missing components are zero."""
    return np.pad(matrix, ((0, 0), (0, dims - matrix.shape[1]))) if matrix.shape[1] < dims else matrix


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, as integers; exact whatever the size of the components."""
    dims = max(a.shape[1], b.shape[1])
    a, b = widened(a, dims), widened(b, dims)
    most = (np.abs(a).max() if a.size else 0.0) * (np.abs(b).max() if b.size else 0.0) * max(dims, 1)
    if most < EXACT:
        return np.rint(a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a], object).reshape(len(a), dims)
    other = np.array([[int(x) for x in row] for row in b], object).reshape(len(b), dims)
    return (whole @ other.T).astype(np.int64)  # beyond a long this raises OverflowError


def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(256 x) of each component; null and non-finite components drop the row."""
    for batch in batches:
        ids, labels, vectors = (batch.column(i) for i in range(3))
        keep, data = [], []
        for i in range(batch.num_rows):
            values = vectors[i].values
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            if values.null_count == 0 and np.isfinite(x).all():
                keep.append(i)
                data.append(packed(np.floor(SCALE * x)))
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.take(at), labels.take(at), pa.array(data, pa.binary())], names=["vec_id", "label", "data"]
        )


def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum and sum of squares of each dimension."""
    count, total, squares = (np.zeros(0) for _ in range(3))
    for batch in batches:
        for data in batch.column(0).to_pylist():
            x = unpacked(data, 1)[0]
            if len(x) > len(total):
                grow = len(x) - len(total)
                count, total, squares = (np.pad(v, (0, grow)) for v in (count, total, squares))
            count[: len(x)] += 1
            total[: len(x)] += x
            squares[: len(x)] += x * x
    if len(total):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(total)), pa.int32()), pa.array(count.astype(np.int64)),
                pa.array(total), pa.array(squares),
            ],
            names=["dim", "n", "total", "squares"],
        )


# --- the curve ----------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of cells (rows, dims), by the transpose method.

    ``bits`` times the number of dimensions must not exceed 64.
    """
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint64(level - 1)
        for i in range(len(x)):
            high = (x[i] & np.uint64(level)) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low).astype(np.uint64)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
        level >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[-1] & np.uint64(level)) != 0, turn ^ np.uint64(level - 1), turn)
        level >>= 1
    key = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = key << np.uint64(1) | ((x[i] ^ turn) >> np.uint64(bit)) & np.uint64(1)
    return key


def curve_keys(dims: list[int], centre: np.ndarray, spread: np.ndarray):
    """A task that adds the place on the curve; it only orders rows and decides no result."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, len(dims)))
            for i, data in enumerate(batch.column("data").to_pylist()):
                row = unpacked(data, 1)[0]
                for j, d in enumerate(dims):
                    x[i, j] = row[d] if d < len(row) else 0.0
            cells = np.clip((x - centre) / spread * 2 ** (BITS - 2) + 2 ** (BITS - 1), 0, 2**BITS - 1)
            keys = hilbert_keys(np.floor(cells), BITS) ^ np.uint64(1 << 63)  # signed order
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys.view(np.int64))], names=["vec_id", "label", "data", "curve"]
            )

    return add


def on_the_curve(rows: DataFrame) -> DataFrame:
    of = (
        rows.select("data").mapInArrow(moments, MOMENTS)
        .groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect()
    )
    spread = {r["dim"]: max(r["squares"] / r["n"] - (r["total"] / r["n"]) ** 2, 0.0) ** 0.5 for r in of}
    centre = {r["dim"]: r["total"] / r["n"] for r in of}
    dims = sorted(spread, key=lambda d: (-spread[d], d))[:CURVE_DIMS] or [0]
    means = np.array([centre.get(d, 0.0) for d in dims])
    return rows.mapInArrow(curve_keys(dims, means, np.array([spread.get(d) or 1.0 for d in dims])), KEYED)


# --- blocks -------------------------------------------------------------------


def bounds(matrix: np.ndarray) -> tuple[list[float], list[float]]:
    return matrix.min(0).tolist(), matrix.max(0).tolist()


def matrix_of(vectors: list[bytes]) -> np.ndarray:
    rows = [unpacked(v, 1)[0] for v in vectors]
    dims = max(map(len, rows), default=0)
    return np.stack([np.pad(r, (0, dims - len(r))) for r in rows]) if rows else np.zeros((0, 0))


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ``BLOCK_ROWS`` rows as they come, each with its zone map."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    first, held = 0, []

    def block(rows: list[tuple]) -> pa.RecordBatch:
        rows = sorted(rows)
        ids, labels = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32)
        matrix = matrix_of([r[2] for r in rows])
        low, high = bounds(matrix)
        values = [
            part, first, len(rows), int(labels.min()), int(labels.max()), low, high,
            ids.astype("<i8").tobytes(), labels.astype("<i4").tobytes(), packed(matrix),
        ]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 2]
        names = [c.strip().split(" ")[0] for c in BLOCKS.split(",")]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, [*types, *[pa.binary()] * 3])], names=names
        )

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "data")))
        while len(held) >= BLOCK_ROWS:
            yield block(held[:BLOCK_ROWS])
            first, held = first + BLOCK_ROWS, held[BLOCK_ROWS:]
    if held:
        yield block(held)


def build_blocks(rows: DataFrame, stripe_rows: int = STRIPE_ROWS) -> DataFrame:
    """The stored blocks of ``rows``, numbered by stripes of about ``stripe_rows`` rows."""
    n = rows.count()
    ordered = (
        on_the_curve(rows)
        .repartitionByRange(max(1, -(-n // stripe_rows)), "label", "curve", "vec_id")
        .sortWithinPartitions("label", "curve", "vec_id")
    )
    blocks = staged(ordered.mapInArrow(cut_blocks, BLOCKS), "vector-blocks")
    # One small row per partition, whose rows before it say where its first stripe begins.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead")
    )
    return blocks.join(parts, "part").withColumn(
        "stripe", F.floor((F.col("ahead") + F.col("first")) / stripe_rows).cast("long")
    ).drop("part", "first", "ahead")


# --- search -------------------------------------------------------------------


def split_signs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(matrix, 0), np.minimum(matrix, 0)


def interval(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) score of each anchor with any vector between ``low`` and ``high``.

    Rounding is covered by a margin, so a bound is never too tight.
    """
    dims = max(anchors.shape[1], low.shape[1])
    anchors, low, high = widened(anchors, dims), widened(low, dims), widened(high, dims)
    above, below = split_signs(anchors)
    most, least = above @ high.T + below @ low.T, above @ low.T + below @ high.T
    margin = 1.0 + 1e-9 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - margin, most + margin


class Best:
    """The first ``k`` finds (group, score, id), by descending score and ascending id."""

    def __init__(self, groups: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.int64).copy()
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        group, score, id_ = (np.concatenate(p) for p in ((self.group, group), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, group))
        group, score, id_ = group[order], score[order], id_[order]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        keep = place < self.k
        self.group, self.score, self.id = group[keep], score[keep], id_[keep]
        last = place[keep] == self.k - 1
        self.floor[self.group[last]] = np.maximum(self.floor[self.group[last]], self.score[last])


def nulls_to(column: list, value: int) -> np.ndarray:
    return np.array([value if v is None else v for v in column], np.int64)


LEAST, MOST = -(2**62), 2**62


def read_blocks(blocks: dict, anchors: dict, same_label: bool, k: int) -> tuple[Best, int]:
    """The best ``k`` candidates in ``blocks`` for each row of ``anchors``, and blocks read.

    A row of anchors wants scores from ``floor`` to ``ceiling``. Blocks come in the order of
    what they can hold at most, and one is read only for rows whose window its bounds meet.
    """
    vectors = matrix_of(anchors["data"])
    ids, labels = np.array(anchors["vec_id"], np.int64), np.array(anchors["label"], np.int64)
    ceiling = nulls_to(anchors["ceiling"], MOST)
    best = Best(len(ids), k, nulls_to(anchors["floor"], LEAST))
    dims = max(map(len, blocks["low"]))
    low, high = (
        np.stack([np.pad(np.array(v, np.float64), (0, dims - len(v))) for v in blocks[c]]) for c in ("low", "high")
    )
    # A shorter vector counts as zero in the other dimensions, within or outside its own block.
    least, most = interval(vectors, low, high)
    first, last = np.array(blocks["label_low"]), np.array(blocks["label_high"])
    if same_label:
        apt = (labels[:, None] >= first) & (labels[:, None] <= last)
    else:
        apt = (labels[:, None] != first) | (labels[:, None] != last)
    read = 0
    for b in np.argsort(-most.max(0, initial=float(LEAST)), kind="stable"):
        who = np.flatnonzero(apt[:, b] & (most[:, b] >= best.floor) & (least[:, b] <= ceiling))
        if not len(who):
            continue
        read += 1
        n = blocks["n"][b]
        own = np.frombuffer(blocks["ids"][b], "<i8")
        of = np.frombuffer(blocks["labels"][b], "<i4")
        scores = products(vectors[who], unpacked(blocks["data"][b], n))
        wanted = (scores >= best.floor[who, None]) & (scores <= ceiling[who, None])
        if same_label:
            wanted &= (of == labels[who, None]) & (own != ids[who, None])
        else:
            wanted &= of != labels[who, None]
        row, column = np.nonzero(wanted)
        if len(row):
            best.add(who[row], scores[row, column], own[column])
    return best, read


def unit_search(same_label: bool, k: int):
    """One task: a stripe of candidates for the anchors of one stripe."""

    def search(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not candidates.num_rows or not anchors.num_rows:
            return FOUND_SCHEMA.empty_table()
        wanted = anchors.to_pydict()
        best, _ = read_blocks(candidates.to_pydict(), wanted, same_label, k)
        take = best.group.tolist()
        return pa.table(
            [
                pa.array([wanted["vec_id"][g] for g in take], pa.int64()),
                pa.array([wanted["positive_id"][g] for g in take], pa.int64()),
                pa.array([wanted["positive_score"][g] for g in take], pa.int64()),
                pa.array(best.id), pa.array(best.score),
            ],
            schema=FOUND_SCHEMA,
        )

    return search


FOUND = "anchor_id long, positive_id long, positive_score long, found_id long, score long"
FOUND_SCHEMA = pa.schema([(c.strip().split(" ")[0], pa.int64()) for c in FOUND.split(",")])
ANCHORS = "home long, vec_id long, label int, data binary"
ZONE = "low array<double>, high array<double>, label_low int, label_high int"


def anchor_rows(every: int):
    """A task that gives the anchors of the blocks: rows whose id is divisible by ``every``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids, labels = np.frombuffer(b["ids"], "<i8"), np.frombuffer(b["labels"], "<i4")
                matrix = unpacked(b["data"], b["n"])
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), b["stripe"], np.int64)), pa.array(ids[at]), pa.array(labels[at]),
                        pa.array([packed(matrix[i : i + 1]) for i in at], pa.binary()),
                    ],
                    names=["home", "vec_id", "label", "data"],
                )

    return rows


def merged(groups: str, **columns: str):
    """A function for ``applyInArrow``: the zone map of all rows of a group."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        dims = max(map(len, rows["low"]))
        pad = lambda v: np.pad(np.array(v, np.float64), (0, dims - len(v)))
        low = np.min([pad(v) for v in rows["low"]], axis=0)
        high = np.max([pad(v) for v in rows["high"]], axis=0)
        return pa.table(
            {
                groups: pa.array(rows[groups][:1], pa.int64()),
                "low": pa.array([low.tolist()], pa.list_(pa.float64())),
                "high": pa.array([high.tolist()], pa.list_(pa.float64())),
                "label_low": pa.array([min(rows["label_low"])], pa.int32()),
                "label_high": pa.array([max(rows["label_high"])], pa.int32()),
            }
        )

    return merge


def box_bounds(rows: dict) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) product of any two vectors from two boxes, for each row."""
    least, most = [], []
    for a, b, c, d in zip(rows["low"], rows["high"], rows["stripe_low"], rows["stripe_high"]):
        dims = max(len(a), len(c))
        a, b, c, d = (np.pad(np.array(v, np.float64), (0, dims - len(v))) for v in (a, b, c, d))
        corners = np.stack([a * c, a * d, b * c, b * d])
        margin = 1.0 + 1e-9 * np.abs(corners).max(0).sum()
        least.append(corners.min(0).sum() - margin)
        most.append(corners.max(0).sum() + margin)
    return np.array(least), np.array(most)


def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of an anchor box and a stripe in which a wanted score can lie."""
    for batch in batches:
        rows = batch.to_pydict()
        least, most = box_bounds(rows)
        keep = (most >= nulls_to(rows["floor"], LEAST)) & (least <= nulls_to(rows["ceiling"], MOST))
        yield pa.RecordBatch.from_arrays(
            [batch.column("home").filter(pa.array(keep)), batch.column("stripe").filter(pa.array(keep))],
            names=["home", "stripe"],
        )


def first_of(found: DataFrame, group: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Layout:
    """Stored blocks, the zone maps of their stripes, and the anchors with theirs."""

    def __init__(self, rows: DataFrame, every: int, stripe_rows: int):
        self.blocks = staged(build_blocks(rows, stripe_rows), "stripes")
        zones = self.blocks.select("stripe", "low", "high", "label_low", "label_high")
        self.stripes = staged(
            zones.groupBy("stripe").applyInArrow(merged("stripe"), f"stripe long, {ZONE}"), "stripe-zones"
        )
        slim = self.blocks.select("stripe", "n", "ids", "labels", "data")
        self.anchors = staged(slim.mapInArrow(anchor_rows(every), ANCHORS), "anchors")
        self.count = self.stripes.agg(F.max("stripe")).first()[0]

    def units(self, wanted: DataFrame, same_label: bool, which: Column) -> DataFrame:
        """(home, stripe): which stripes the anchors of a home stripe have to meet.

        ``wanted`` has the anchors with ``floor`` and ``ceiling``. The numbers of the stripes
        are joined on, so every home meets every zone map once and no rows.
        """

        def zone(table: pa.Table) -> pa.Table:
            rows = table.to_pydict()
            low, high = bounds(matrix_of(rows["data"]))
            floor, ceiling = nulls_to(rows["floor"], LEAST), nulls_to(rows["ceiling"], MOST)
            return pa.table(
                {
                    "home": pa.array(rows["home"][:1], pa.int64()),
                    "low": pa.array([low], pa.list_(pa.float64())),
                    "high": pa.array([high], pa.list_(pa.float64())),
                    "label_low": pa.array([min(rows["label"])], pa.int32()),
                    "label_high": pa.array([max(rows["label"])], pa.int32()),
                    "floor": pa.array([int(floor.min())], pa.int64()),
                    "ceiling": pa.array([int(ceiling.max())], pa.int64()),
                }
            )

        homes = wanted.select("home", "label", "data", "floor", "ceiling").groupBy("home").applyInArrow(
            zone, f"home long, {ZONE}, floor long, ceiling long"
        )
        stripes = self.stripes.select(
            "stripe", F.col("low").alias("stripe_low"), F.col("high").alias("stripe_high"),
            F.col("label_low").alias("first"), F.col("label_high").alias("last"),
        )
        pairs = homes.withColumn(
            "stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.count).cast("long")))
        ).filter(which).join(stripes, "stripe")
        if same_label:
            pairs = pairs.filter((F.col("label_low") <= F.col("last")) & (F.col("label_high") >= F.col("first")))
        else:
            one = (F.col("label_low") == F.col("label_high")) & (F.col("first") == F.col("last"))
            pairs = pairs.filter(~(one & (F.col("first") == F.col("label_low"))))
        slim = pairs.select("home", "stripe", "low", "high", "stripe_low", "stripe_high", "floor", "ceiling")
        return slim.mapInArrow(meeting, "home long, stripe long")

    def search(self, wanted: DataFrame, same_label: bool, k: int, which: Column) -> DataFrame:
        """Finds of every unit; at most ``k`` for each row of ``wanted`` and stripe."""
        units = staged(self.units(wanted, same_label, which), "units")
        blocks = units.join(self.blocks, "stripe")
        rows = units.toDF("at_home", "at_stripe").join(wanted, F.col("at_home") == F.col("home")).drop("home")
        return (
            blocks.groupBy("home", "stripe")
            .cogroup(rows.groupBy("at_home", "at_stripe"))
            .applyInArrow(unit_search(same_label, k), FOUND)
        )


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 50,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    stripe_rows: int = STRIPE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(256 x); a score is the integer inner product. Anchors are the
    rows whose id ``every`` divides. An anchor's positives are its first other rows of the
    same label, its negatives for a positive the first rows of another label whose score
    lies between ``low`` and ``high`` per cent of the positive's. Higher scores come first,
    then smaller ids.

    Rows with a null id, label, vector or component, or a component that is not finite,
    take no part. Of rows with the same id the one with the smallest label, then vector,
    takes part. Vectors of different length are compared as if the shorter ended in zeros.
    Scores beyond a long stop the job. An empty table gives no rows. Other columns are
    ignored.
    """
    plain = chosen(vectors, vec_id=id_col, label=label_col, vector=vector_col).select(
        F.col("vec_id").cast("long"), F.col("label").cast("int"), F.col("vector").cast("array<double>")
    )
    rows = staged(
        plain.dropna().mapInArrow(quantised, ROWS)
        .groupBy("vec_id").agg(F.min(F.struct("label", "data")).alias("x"))
        .select("vec_id", "x.label", "x.data"),
        "vectors",
    )
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], RESULT)
    layout = Layout(rows, every, stripe_rows)
    nothing = F.lit(None).cast("long")
    at_home = F.col("stripe") == F.col("home")
    wanted = layout.anchors.withColumns(
        {"positive_id": nothing, "positive_score": nothing, "floor": nothing, "ceiling": nothing}
    )
    # The home stripe first: its last positive is what other stripes have to reach.
    home = staged(layout.search(wanted, True, positives, at_home), "home-positives")
    last = home.groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("score").alias("score")).select(
        F.col("anchor_id").alias("vec_id"), F.when(F.col("n") >= positives, F.col("score")).alias("floor")
    )
    reach = staged(wanted.drop("floor").join(last, "vec_id", "left").select(wanted.columns), "reach")
    away = layout.search(reach, True, positives, ~at_home)
    found = staged(
        first_of(home.unionByName(away), ["anchor_id"], positives).select(
            F.col("anchor_id").alias("vec_id"), F.col("found_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # 100 negative >= low positive, and 100 negative <= high positive, in whole numbers.
    windows = staged(
        layout.anchors.join(found, "vec_id")
        .withColumn("floor", F.expr(f"-((-{low} * positive_score - pmod(-{low} * positive_score, 100)) div 100)"))
        .withColumn("ceiling", F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100"))
        .filter("floor <= ceiling")
        .select(wanted.columns),
        "windows",
    )
    mined = layout.search(windows, False, negatives, F.lit(True))
    return first_of(mined, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
