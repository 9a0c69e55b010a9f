"""Vector index: keyed Parquet rows in folders by load and cell, read in place.

Layout below the index path, for each build:

- ``rows/<build>/_load=<folder>/cell=<cell>``: the rows that a load added. They are never rewritten.
- ``sizes/<build>/<folder>``: for each cell of the load how many rows it has and how far from the cell's
  centre they reach. A search builds the paths of the cells it asks for from this table, so no other
  folder is listed or read, and nothing is counted.
- ``keys/<build>/<folder>``: key, version and cell of each change that the load took on, tombstones
  included; no vectors. Later changes find what they replace here.
- ``dead/<build>/<folder>``: key, load and cell of each older row that the load replaced or deleted.
  Readers leave these out, so rows are never grouped by key to find the latest.
- ``loads/<build>``: one row per load, written last, that makes the load count.

``centroids`` and ``meta`` are small tables; ``meta`` is written last and names the build. A failure at any
point leaves the index as it was. ``merge_loads`` makes one load of several.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from passagemill.functions.vectors import vector_fault
from passagemill.operators.changes import DELETE, UPDATE_BEFORE, latest_changes
from passagemill.operators.embed import RUN_CELLS, run_once, same_embedder
from passagemill.operators.topk import SCORE_DIGITS, ranked
from passagemill.operators.vector_search import (
    SCORE_CELLS,
    matrix,
    probe_order,
    vector_topk,
    vector_topk_in_cells,
    with_columns,
)
from passagemill.session import delete_folder, stage, staged_meanwhile

NO_CELL = -1

#: Replaced rows up to this number are broadcast to the readers; with more of them the list is joined by a
#: shuffle until the loads are merged, which ``create_or_sync`` does long before.
MOST_DEAD = 1_000_000


@dataclass(frozen=True)
class Load:
    name: str
    folder: str
    number: int
    rows: int
    dead: int


@dataclass(frozen=True)
class VectorIndex:
    path: str
    build: str
    key: str
    vector: str
    dim: int
    embedder: str
    schema: StructType
    centroids: np.ndarray

    def part(self, kind: str, folder: str) -> str:
        return f"{self.path}/{kind}/{self.build}/{folder}"

    def loads(self, spark: SparkSession) -> list[Load]:
        """The loads that count, oldest first."""
        entries = spark.read.parquet(f"{self.path}/loads/{self.build}").collect()
        replaced = {name for entry in entries for name in entry["replaces"]}
        counted = [
            Load(e["load"], e["folder"], e["number"], e["rows"], e["dead"])
            for e in entries
            if e["folder"] not in replaced
        ]
        return sorted(counted, key=lambda load: (load.number, load.folder))

    def has_load(self, spark: SparkSession, load: str) -> bool:
        entries = spark.read.parquet(f"{self.path}/loads/{self.build}")
        return not entries.where(F.col("load") == load).isEmpty()

    def parts(self, spark: SparkSession, kind: str, loads: Iterable[Load]) -> DataFrame:
        return spark.read.parquet(*[self.part(kind, load.folder) for load in loads])

    def cell_sizes(self, spark: SparkSession) -> DataFrame:
        """``_load, cell, rows`` as written with each load; some of these rows may be dead by now."""
        return self.parts(spark, "sizes", self.loads(spark))

    def dead_rows(self, spark: SparkSession, loads: Sequence[Load]) -> DataFrame | None:
        """``key, _load, cell`` of the rows that later loads replaced; none if there are none."""
        with_dead = [load for load in loads if load.dead]
        return self.parts(spark, "dead", with_dead) if with_dead else None

    def rows(
        self,
        spark: SparkSession,
        cells: Sequence[int] | None = None,
        loads: Sequence[Load] | None = None,
    ) -> DataFrame:
        """The live rows of the given cells (all if not given), with ``_commit_version`` and ``cell``.

        Only the folders of these cells are listed and read. Rows that a later load replaced are left
        out by a broadcast list of theirs; the stored rows themselves are not shuffled. ``loads`` reads
        the rows of some loads only.
        """
        counted = self.loads(spark)
        chosen = counted if loads is None else loads
        kept = self._stored(spark, chosen, cells)
        dead = self.dead_rows(spark, counted)
        if dead is not None:
            if cells is not None:
                dead = dead.where(F.col("cell").isin(list(cells)))
            dead = dead.select(self.key, "_load")
            if sum(load.dead for load in counted) <= MOST_DEAD:
                dead = F.broadcast(dead)
            kept = kept.join(dead, [self.key, "_load"], "left_anti")
        return kept.select(*self.schema.names, "cell")

    def _stored(
        self, spark: SparkSession, loads: Sequence[Load], cells: Sequence[int] | None
    ) -> DataFrame:
        root = f"{self.path}/rows/{self.build}"
        schema = StructType([*self.schema.fields]).add("_load", StringType()).add("cell", IntegerType())
        sizes = self.parts(spark, "sizes", loads) if loads else None
        if sizes is None:
            return spark.createDataFrame([], schema)
        if cells is not None:
            sizes = sizes.where(F.col("cell").isin(list(cells)))
        # one row per load and cell
        held = sizes.select("_load", "cell").collect()
        paths = [f"{root}/_load={row['_load']}/cell={row['cell']}" for row in held]
        if cells is None:
            paths = sorted({f"{root}/_load={row['_load']}" for row in held})
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", root).parquet(*paths)

    def key_states(self, spark: SparkSession, keys: DataFrame | None = None) -> DataFrame:
        """``key, _commit_version, _deleted, cell, _load`` of the last change of each key.

        Reads the narrow tables of keys. With ``keys`` only for those.
        """
        states = self.parts(spark, "keys", self.loads(spark))
        if keys is not None:
            states = states.join(keys, self.key, "left_semi")
        values = F.struct(*[name for name in states.columns if name != self.key]).alias("_state")
        packed = states.select(self.key, values)
        latest = F.max_by("_state", F.struct("_state._number", "_state._commit_version"))
        return (
            packed.groupBy(self.key)
            .agg(latest.alias("_state"))
            .select(self.key, "_state._commit_version", "_state._deleted", "_state.cell", "_state._load")
        )


def nearest_cell(vector: Column, centroids: np.ndarray) -> Column:
    """The cell whose centroid is nearest; rows without a usable vector get ``NO_CELL``.

    Every task gets the centroids: cells x width x 8 bytes, as the caller has chosen.
    """
    dim = centroids.shape[1]
    squares = (centroids**2).sum(axis=1)

    def assign(vectors: pa.Array) -> pa.Array:
        cells = np.full(len(vectors), NO_CELL, dtype=np.int32)
        widths = np.asarray(vectors.value_lengths().fill_null(0))
        usable = np.flatnonzero(widths == dim)
        rows = matrix(vectors.take(pa.array(usable)), dim)
        step = max(1, SCORE_CELLS // len(centroids))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            gaps = squares[None, :] - 2 * part @ centroids.T
            cells[usable[at : at + step]] = gaps.argmin(axis=1)
        return pa.array(cells)

    return run_once(assign, IntegerType())(vector)


def cell_reach(vector: Column, cell: Column, centroids: np.ndarray) -> Column:
    """How far a stored vector lies from its cell's centre: ``gap`` and ``angle`` (in radians).

    The angle is that of a half turn if either is zero, so that nothing is concluded from it.
    """
    dim = centroids.shape[1]

    def measure(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        of_row = np.asarray(cells)
        gaps, turns = np.empty(len(vectors)), np.empty(len(vectors))
        step = max(1, RUN_CELLS // dim)
        for at in range(0, len(vectors), step):
            rows, centres = matrix(vectors.slice(at, step), dim), centroids[of_row[at : at + step]]
            gaps[at : at + step] = np.sqrt(((rows - centres) ** 2).sum(axis=1))
            turns[at : at + step] = angles(rows, centres)
        fields = [pa.array(gaps), pa.array(turns)]
        return pa.StructArray.from_arrays(fields, ["gap", "angle"])

    return run_once(measure, "struct<gap: double, angle: double>")(vector, cell)


def angles(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The angle between each row and the row of the same number; a half turn if one is zero."""
    norms = np.sqrt((left**2).sum(axis=1) * (right**2).sum(axis=1))
    cosines = (left * right).sum(axis=1) / np.where(norms == 0, 1.0, norms)
    return np.where(norms == 0, np.pi, np.arccos(np.clip(cosines, -1, 1)))


def train_centroids(rows: DataFrame, vector: str, cells: int, seed: int = 42) -> np.ndarray:
    """k-means centres of all rows."""
    points = rows.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return np.array(KMeans(k=cells, seed=seed, maxIter=10).fit(points).clusterCenters())


def add_load(
    index: VectorIndex,
    load: str,
    number: int,
    rows: DataFrame,
    states: DataFrame,
    dead: DataFrame | None = None,
    replaces: Sequence[str] = (),
) -> None:
    """Write the parts of a load, then the entry that makes it count.

    ``rows`` are the live rows with ``cell``; ``states`` has key, ``_commit_version``, ``_deleted`` and
    ``cell`` of every change, or no ``cell``: then it is that of the row written for the key. Rows of one
    cell lie together; large cells are split over files.
    """
    spark = rows.sparkSession
    folder = f"{load}-{uuid.uuid4().hex[:12]}"

    written = index.part("rows", f"_load={folder}")
    (
        rows.hint("rebalance", F.col("cell"))
        .sortWithinPartitions("cell")
        .write.partitionBy("cell")
        .parquet(written)
    )
    held = spark.read.schema(StructType([*index.schema.fields]).add("cell", IntegerType())).parquet(written)
    reach = cell_reach(F.col(index.vector), F.col("cell"), index.centroids)
    (
        held.select("cell", reach.alias("_reach"))
        .groupBy("cell")
        .agg(
            F.count("*").alias("rows"),
            F.max("_reach.gap").alias("gap"),
            F.max("_reach.angle").alias("angle"),
        )
        .select(F.lit(folder).alias("_load"), "cell", "rows", "gap", "angle")
        .coalesce(1)
        .write.parquet(index.part("sizes", folder))
    )
    if "cell" not in states.columns:
        placed = held.select(F.col(index.key).alias("_key"), "cell")
        states = states.join(placed, F.col(index.key).eqNullSafe(F.col("_key")), "left")
    states.select(
        index.key,
        "_commit_version",
        "_deleted",
        "cell",
        F.lit(folder).alias("_load"),
        F.lit(number).alias("_number"),
    ).write.parquet(index.part("keys", folder))
    gone = 0
    if dead is not None:
        listed = index.part("dead", folder)
        dead.select(index.key, "_load", "cell").write.parquet(listed)
        gone = spark.read.parquet(listed).count()
    sizes = spark.read.parquet(index.part("sizes", folder))
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    spark.createDataFrame(
        [(load, folder, number, total, gone, list(replaces))],
        "load string, folder string, number int, rows bigint, dead bigint, replaces array<string>",
    ).coalesce(1).write.mode("append").parquet(f"{index.path}/loads/{index.build}")


def write_rejected(rows: DataFrame, path: str, load: str) -> None:
    """Keep rows that cannot be indexed, by load, so that a load that is run again replaces its own."""
    rows.write.mode("overwrite").parquet(f"{path}/rejected/load={load}")


def build_index(
    table: DataFrame,
    path: str,
    key: str = "id",
    vector: str = "embedding",
    dim: int = 256,
    cells: int = 16,
    embedder: str = "hashing",
    version: int = 0,
    centroids: np.ndarray | None = None,
) -> VectorIndex:
    """Create the index. ``meta`` is written last: an index without it does not exist yet.

    Cells come from k-means over all rows unless ``centroids`` gives their centres, one row per cell.
    Rows whose vector cannot be indexed go to ``rejected`` below the path, with the reason. The table
    is evaluated once.
    """
    spark = table.sparkSession
    build = uuid.uuid4().hex[:12]
    faulty = table.withColumn("_fault", vector_fault(F.col(vector), dim))
    with staged_meanwhile(faulty, "index-rows") as marked:
        good = marked.where("_fault is null").drop("_fault")
        if centroids is None:
            centroids = train_centroids(good, vector, cells)
        at_version = good.withColumn("_commit_version", F.lit(version).cast("bigint"))
        celled = at_version.withColumn("cell", nearest_cell(F.col(vector), centroids))
        index = VectorIndex(path, build, key, vector, dim, embedder, at_version.schema, centroids)
        with staged_meanwhile(celled, "index-placed") as placed:
            add_load(index, "build", 0, placed, placed.withColumn("_deleted", F.lit(False)))
        bad = marked.where("_fault is not null").withColumnRenamed("_fault", "fault")
        write_rejected(bad, path, "build")
    spark.createDataFrame(
        [(cell, centre) for cell, centre in enumerate(centroids.tolist())],
        "cell int, centroid array<double>",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids/{build}")
    spark.createDataFrame(
        [(build, key, vector, dim, embedder, index.schema.json(), "ONLINE")],
        "build string, key string, vector string, dim int, embedder string, columns string, status string",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return open_index(spark, path)


def add_changes(spark: SparkSession, index: VectorIndex, changes: DataFrame, load: str) -> None:
    """Take on change rows (with ``cell``) as a load. No stored row is read or rewritten.

    A change counts if no change of a higher version has come for its key, and of two with one version
    a row that is there beats a tombstone. Which changes count, and which rows they replace, is found from
    keys and versions alone; the replaced rows are listed as dead. Whole rows are dealt out by key only
    where a key comes more than once.
    """
    key, deleted = F.col(index.key), F.col("_change_type") == DELETE
    said = changes.where(F.col("_change_type") != UPDATE_BEFORE)
    now = F.struct("_commit_version", (~deleted).alias("_lives"))
    coming = said.groupBy(index.key).agg(F.max(now).alias("_now"), F.count("*").alias("_times"))
    states = index.key_states(spark, coming.select(index.key)).select(
        index.key,
        F.struct("_commit_version", (~F.col("_deleted")).alias("_lives")).alias("_had"),
        F.col("_load").alias("_old_load"),
        F.col("cell").alias("_old_cell"),
    )
    counts = F.col("_had").isNull() | (F.col("_now") >= F.col("_had"))
    judged = coming.join(states, index.key, "left").withColumn("_counts", counts)

    with staged_meanwhile(judged, "index-changes") as judged:
        accepted = judged.where("_counts")
        alive = said.where(~deleted)
        apart = judged.where("not _counts or _times > 1")
        if not apart.isEmpty():
            alive = _matching(alive, key, apart, "left_anti")
        again = accepted.where("_times > 1 and _now._lives")
        if not again.isEmpty():
            last = latest_changes(_matching(said, key, again, "left_semi"), index.key)
            alive = alive.drop("_change_type").unionByName(last.drop("_deleted"))
        number = 1 + max(held.number for held in index.loads(spark))
        replaced = accepted.where("_had._lives")
        add_load(
            index,
            load,
            number,
            alive.select(*index.schema.names, "cell"),
            accepted.select(
                index.key, "_now._commit_version", (~F.col("_now._lives")).alias("_deleted")
            ),
            replaced.select(
                index.key, F.col("_old_load").alias("_load"), F.col("_old_cell").alias("cell")
            ),
        )


def _matching(rows: DataFrame, key: Column, listed: DataFrame, how: str) -> DataFrame:
    """Rows by a list of keys, null included. The rows stay where they are unless the list is long."""
    keys = listed.select(key.alias("_listed"))
    if keys.count() <= MOST_DEAD:
        keys = F.broadcast(keys)
    return rows.join(keys, key.eqNullSafe(F.col("_listed")), how)


def merge_loads(spark: SparkSession, path: str, loads: Sequence[Load], name: str = "merged") -> None:
    """Make one load of the newest ones given; they stop to count when the new one's entry is written.

    Dead rows are not taken along. What the loads replaced in older ones stays listed.
    """
    index = open_index(spark, path)
    folders = [load.folder for load in loads]
    last = max(load.number for load in loads)
    inside = F.col("_load").isin(folders)
    states = index.key_states(spark).where(inside)
    dead = index.dead_rows(spark, loads)
    add_load(
        index,
        name,
        last,
        index.rows(spark, loads=loads),
        states,
        None if dead is None else dead.where(~inside),
        folders,
    )


def forget_replaced(spark: SparkSession, path: str) -> None:
    """Delete the rows of loads that merges have replaced. The entries stay, so their names stay known.

    Who opened the index before such a merge can no longer read it.
    """
    index = open_index(spark, path)
    counted = {load.folder for load in index.loads(spark)}
    for entry in spark.read.parquet(f"{path}/loads/{index.build}").select("folder").collect():
        if entry["folder"] not in counted:
            for kind, name in (("rows", "_load="), ("sizes", ""), ("keys", ""), ("dead", "")):
                delete_folder(spark, index.part(kind, name + entry["folder"]))


def compact_index(spark: SparkSession, path: str) -> None:
    """Make one load of all; the old ones stop to count when the new one's entry is written."""
    loads = open_index(spark, path).loads(spark)
    if len(loads) > 1:
        merge_loads(spark, path, loads, "compact")


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    meta = spark.read.parquet(f"{path}/meta").first()
    centres = spark.read.parquet(f"{path}/centroids/{meta['build']}").orderBy("cell").collect()
    return VectorIndex(
        path,
        meta["build"],
        meta["key"],
        meta["vector"],
        meta["dim"],
        meta["embedder"],
        StructType.fromJson(json.loads(meta["columns"])),
        np.array([row["centroid"] for row in centres]),
    )


def index_exists(spark: SparkSession, path: str) -> bool:
    """Whether a ready index is there. Any failure but a missing path is raised."""
    try:
        return spark.read.parquet(f"{path}/meta").first()["status"] == "ONLINE"
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def describe_index(spark: SparkSession, path: str) -> DataFrame:
    """One row: live rows, distinct keys, greatest vector width, last version, tombstones."""
    index = open_index(spark, path)
    live = index.rows(spark).agg(
        F.count("*").alias("row_count"),
        F.countDistinct(index.key).alias("key_count"),
        F.max(F.size(index.vector)).cast("bigint").alias("width"),
    )
    states = index.key_states(spark).agg(
        F.max("_commit_version").alias("last_version"),
        F.count_if(F.col("_deleted")).alias("tombstone_count"),
    )
    # one row each
    return live.withColumn("_one", F.lit(1)).join(states.withColumn("_one", F.lit(1)), "_one").drop("_one")


def rows_per_cell(spark: SparkSession, path: str) -> DataFrame:
    """Live rows of each cell that has any, from the sizes stored with the loads."""
    index = open_index(spark, path)
    sizes = index.cell_sizes(spark).select("cell", "rows")
    dead = index.dead_rows(spark, index.loads(spark))
    if dead is not None:
        sizes = sizes.unionByName(dead.groupBy("cell").agg((-F.count("*")).alias("rows")))
    total = sizes.groupBy("cell").agg(F.sum("rows").alias("row_count"))
    return total.where(F.col("row_count") > 0)


def vector_topk_indexed(
    queries: DataFrame,
    index: VectorIndex,
    embedder: tuple[str, int],
    k: int = 5,
    probes: int = 4,
    metric: str = "cosine",
    query_id: str = "query_id",
    query_vector: str = "embedding",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Approximate k nearest rows; exact when ``probes`` is the number of cells.

    ``embedder`` names the model of the questions' vectors and their width; both must be the
    index's. Only the cells that some question probes are read. ``columns`` of the index's rows are
    added to the hits. ``recall_by_probes`` tells how complete the hits are for each number of probes.
    """
    same_embedder((index.embedder, index.dim), embedder)
    spark = queries.sparkSession
    asked = stage(
        queries.select(query_id, query_vector).withColumn(
            "_cells", probe_order(F.col(query_vector), index.centroids, metric, probes)
        ),
        "index-questions",
    )
    cells = None
    if probes < len(index.centroids):
        # no more than the index has cells
        probed = asked.select(F.explode("_cells").alias("cell")).distinct().collect()
        cells = sorted(row["cell"] for row in probed)
    base = index.rows(spark, cells)
    hits = vector_topk_in_cells(
        asked,
        base,
        index.dim,
        k,
        metric,
        query_id,
        query_vector,
        index.key,
        index.vector,
        F.col("_cells"),
        "cell",
    )
    return with_columns(hits, base, columns, index.key) if columns else hits


def cells_to_look_at(
    vector: Column,
    floor: Column,
    probed: Column,
    metric: str,
    centroids: np.ndarray,
    reach: np.ndarray,
) -> Column:
    """The cells beyond ``probed`` that can hold a row of a score of at least ``floor``.

    ``reach`` has gap and angle of each cell, negative where a cell is empty. No row of a cell is nearer
    than the centre less the gap, turned towards the question by more than the angle, or has a greater
    product than the centre's plus gap times length. A null floor asks for all cells.
    """
    dim, cells = centroids.shape[1], np.arange(len(centroids))
    slack = 2 * 10.0**-SCORE_DIGITS

    def best_possible(question: np.ndarray) -> np.ndarray:
        each = np.broadcast_to(question, centroids.shape)
        if metric == "cosine":
            return np.cos(np.maximum(angles(each, centroids) - reach[:, 1], 0))
        if metric == "dot":
            return centroids @ question + reach[:, 0] * np.sqrt(question @ question)
        return -np.maximum(np.sqrt(((each - centroids) ** 2).sum(axis=1)) - reach[:, 0], 0)

    def open_cells(vectors: pa.Array, floors: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for values, least, seen in zip(vectors, floors, lists):
            if not values.is_valid or len(values) != dim:
                out.append([])
                continue
            may = reach[:, 0] >= 0
            if least.is_valid:
                bound = best_possible(np.array(values.as_py(), dtype=np.float64))
                may &= ~(bound < least.as_py() - slack * (1 + np.abs(bound)))
            out.append(np.setdiff1d(cells[may], seen.as_py()).tolist())
        return pa.array(out, pa.list_(pa.int32()))

    return run_once(open_cells, "array<int>")(vector, floor, probed)


def vector_topk_bounded(
    queries: DataFrame,
    index: VectorIndex,
    embedder: tuple[str, int],
    k: int = 5,
    probes: int = 4,
    metric: str = "cosine",
    query_id: str = "query_id",
    query_vector: str = "embedding",
) -> DataFrame:
    """Exact k nearest rows from the cells that can hold them; ``probed_cells`` says how many those were.

    The nearest ``probes`` cells give each question a k-th score. A cell whose stored reach rules out a
    score as good is never read for it; the others are searched too. The result is that of
    ``vector_topk`` over all rows.
    """
    same_embedder((index.embedder, index.dim), embedder)
    spark = queries.sparkSession
    order = probe_order(F.col(query_vector), index.centroids, metric, probes)
    asked = stage(
        queries.select(query_id, query_vector).withColumn("_probed", order), "index-questions"
    )

    def search(rows: DataFrame, lists: str) -> DataFrame:
        wanted = rows.select(F.explode(lists).alias("cell")).distinct().collect()
        base = index.rows(spark, sorted(row["cell"] for row in wanted))
        names = (query_id, query_vector, index.key, index.vector)
        cells = F.col(lists)
        return vector_topk_in_cells(rows, base, index.dim, k, metric, *names, cells, "cell")

    first = stage(search(asked, "_probed"), "first-hits")
    reach = np.full((len(index.centroids), 2), -1.0)
    for row in index.cell_sizes(spark).groupBy("cell").agg(F.max("gap"), F.max("angle")).collect():
        reach[row[0]] = row[1], row[2]
    floors = first.where(F.col("rank") == k).select(query_id, F.col("score").alias("_floor"))
    more = cells_to_look_at(
        F.col(query_vector), F.col("_floor"), F.col("_probed"), metric, index.centroids, reach
    )
    left = stage(asked.join(floors, query_id, "left").withColumn("_open", more), "open-cells")
    second = search(left, "_open")
    both = first.drop("rank").unionByName(second.drop("rank"))
    counts = left.select(query_id, (F.size("_probed") + F.size("_open")).alias("probed_cells"))
    return ranked(both, query_id, k).join(counts, query_id)


def recall_by_probes(
    queries: DataFrame, index: VectorIndex, k: int, metric: str = "cosine"
) -> DataFrame:
    """Share of the exact hits that a probed search finds, for every number of probes.

    An exact hit is found as soon as its cell is probed, so one exact search and the place of each
    hit's cell in its question's probe order give the whole curve. One row per cell of the index.
    """
    spark = queries.sparkSession
    questions = queries.select("query_id", "embedding").where(F.size("embedding") == index.dim)
    rows = index.rows(spark)
    exact = vector_topk(
        questions, rows, index.dim, k, metric, base_id=index.key, base_vector=index.vector
    )
    order = probe_order(F.col("embedding"), index.centroids, metric, len(index.centroids))
    placed = with_columns(exact, rows, ["cell"], index.key).join(
        questions.select("query_id", order.alias("order")), "query_id"
    )
    found = placed.groupBy(F.array_position("order", F.col("cell")).alias("probes")).agg(
        F.count("*").alias("hits")
    )
    numbers = spark.range(1, len(index.centroids) + 1).withColumnRenamed("id", "probes")
    # One row per cell, so the ungrouped windows are over a few rows.
    up_to = Window.orderBy("probes").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("probes").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    hits = F.coalesce("hits", F.lit(0))
    return numbers.join(found, "probes", "left").select(
        "probes",
        F.sum(hits).over(up_to).alias("found_hits"),
        F.round(F.sum(hits).over(up_to) / F.sum(hits).over(everything), 6).alias("recall"),
    )


def probes_for_recall(
    queries: DataFrame, index: VectorIndex, k: int, target: float, metric: str = "cosine"
) -> int:
    """The smallest number of probes that reaches the recall on these questions."""
    curve = recall_by_probes(queries, index, k, metric)
    reached = curve.where(F.col("recall") >= target).agg(F.min("probes")).first()[0]
    return int(reached) if reached is not None else len(index.centroids)
