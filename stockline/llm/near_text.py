"""Near-duplicate documents by a forest of sorted min-hash orders.

Texts are lower-cased (A-Z) and split at ASCII white space; a document is the
set of its runs of ``shingle`` words. Two sets are linked if 100 times their
common elements are at least ``percent`` times their union, and the result is
the components of these links.

1. Documents with equal sets form a class; only one text of it goes on.
2. ``trees`` orders: in each, a class has a label of ``depth`` min-hash values. Classes
   that share a label's first ``least`` values form a region; classes alone in
   all their regions are done.
3. In a few of the orders, sorted by label, each class is compared with its
   neighbours of longest common prefix and with recent classes that had no link. That
   joins large groups of near copies by a number of comparisons in
   proportion to their size.
4. Regions whose classes are in one component by then are done. In the others, the
   pairs of classes from different components are compared, block by
   block, so that no region, however dense, is one task's work: first by
   short sketches of the min-hash values, and what is left of them on the full sets. A pair
   is compared in the first order in which it shares a region.

Every link is confirmed on full sets. A pair right at a similarity of 0.8 shares no
region with probability (1 - 0.8**4)**25, two in a million, and far less above; the sketches pass
pairs from an estimate of 15 points below the limit. No candidate, partner or region is capped.

Defined cases: a document of fewer words than a shingle is one shingle; null texts
and texts without words are empty sets and linked with nothing; rows without an
id are linked with nothing; classes that share an id are linked, unless ``ids_link`` is off; repeated rows add nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockline.llm.common import NOT_SPACE, WordHasher, give_back, gram_hashes, lower_bytes, mix, small_batches, stored, word_spans
from stockline.operators.components import connected_components, dealt_edges

_SEEDS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def shingle_set(hasher: WordHasher, text: bytes | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    data = lower_bytes(text)
    starts, ends = word_spans(data, NOT_SPACE)
    words = hasher(data, starts, ends)
    return np.unique(gram_hashes(words, min(shingle, len(words)))) if len(words) else np.zeros(0, np.uint64)


def min_hashes(elements: np.ndarray, count: int) -> np.ndarray:
    """``count`` min-hash values of a set that is not empty."""
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(elements), 1024):
        piece = elements[start:start + 1024, None] * _SEEDS[None, :count]
        np.minimum(least, piece.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def is_linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    common = len(np.intersect1d(small, large, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


class Groups:
    """Union-find over a few keys, merging small groups for one task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def cells(batches, key: str = "cell"):
    """Tables of the rows of one key after another, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(start, end - start))
            if end < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _sign(docs: DataFrame, shingle: int, values: int) -> DataFrame:
    def run(batches):
        hasher = WordHasher()
        for batch in small_batches(batches, 16 << 20):
            sizes, keys, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(hasher, text, shingle)
                sizes.append(len(found))
                keys.append(_key(found))
                sigs.append(min_hashes(found, values).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), batch.column(2)],
                names=["doc_id", "n_shingles", "key", "sig", "row_key"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key binary, sig binary, row_key long")


def _key(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def shared_ids(members: DataFrame, classes: DataFrame, id_col: str, key: str) -> DataFrame:
    """Links ``(u, v)`` between classes (``key``, ``rep``) that hold rows of one id."""
    several = members.groupBy(id_col).agg(F.min(key).alias("least"), F.max(key).alias("most")).filter("least <> most").select(id_col)
    held = members.join(several, id_col, "left_semi").select(id_col, key).distinct().join(classes.select(key, "rep"), key).select(id_col, "rep")
    return held.join(held.groupBy(id_col).agg(F.min("rep").alias("v")), id_col).filter("rep <> v").select(F.col("rep").alias("u"), "v")


def named_components(classes: DataFrame, comps: DataFrame) -> DataFrame:
    """``(rep, component_id, chosen)``: the smallest id of each class's component, and the one class that stands for it."""
    placed = stored(comps.join(classes.select("rep", "first_id"), "rep").select(F.col("component").alias("u"), F.col("rep").alias("v"), "first_id"), "placed")
    dealt, names = dealt_edges(placed, placed.count(), F.min(F.struct("first_id", "v")))
    return dealt.join(names, ["u", "part"]).select(
        F.col("v").alias("rep"), F.col("least.first_id").alias("component_id"), (F.col("least.v") == F.col("v")).alias("chosen"))


def _labels(classes: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """One row for each class and order: the region (a hash of order and prefix) and the rest of the label."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = _matrix(pa.chunked_array([batch.column(1)]), np.uint32).reshape(batch.num_rows, trees, depth).astype(np.uint64)
            region = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), sigs.shape[:2]).copy()
            for d in range(least):
                region = mix(region * np.uint64(0x9E3779B97F4A7C15) + sigs[:, :, d])
            deep = sigs[:, :, least].astype(np.int64) << 31 | (sigs[:, :, least + 1].astype(np.int64) >> 1) if depth > least + 1 else np.zeros(region.shape, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(region.view(np.int64).ravel()), pa.array(deep.ravel()), pa.array(np.tile(np.arange(trees, dtype=np.int32), batch.num_rows)),
                 pa.array(np.repeat(batch.column(0).to_numpy(), trees))], names=["region", "deep", "tree", "rep"])

    return classes.select("rep", "sig").mapInArrow(run, "region long, deep long, tree int, rep long")


def _neighbour_links(rows: DataFrame, percent: int, held: int = 4) -> DataFrame:
    """Links between classes that follow one another in an order and share its region."""

    def run(batches):
        region, last, leaders = None, None, []
        for batch in small_batches(batches):
            us, vs = [], []
            for row in batch.to_pylist():
                own = (row["rep"], np.frombuffer(row["elements"], np.uint64))
                if row["region"] != region:
                    region, last, leaders = row["region"], None, []
                near = [last] * (last is not None) + [x for x in reversed(leaders) if x is not last]
                to = next((x for x in near if is_linked(own[1], x[1], percent)), None)
                if to is None:
                    leaders = [*leaders[-held + 1:], own]
                elif to[0] != own[0]:
                    us.append(own[0])
                    vs.append(to[0])
                last = own
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    ordered = rows.repartitionByRange("region", "deep", "rep").sortWithinPartitions("region", "deep", "rep")
    return ordered.mapInArrow(run, "u long, v long")


def _open_pairs(sketches: np.ndarray, comps: np.ndarray, sides: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of a cell are from different components, of the sides to compare, and similar enough by sketch."""
    open_ = np.triu(comps[:, None] != comps[None, :], 1) & ((sides[:, None] != sides[None, :]) | (sides[:, None] == 2))
    for i in np.flatnonzero(open_.any(axis=1)):
        js = np.flatnonzero(open_[i])
        open_[i, js] = (sketches[js] == sketches[i]).mean(axis=1) >= least
    return open_


def _likely(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of cells that have a likely partner in their cell."""

    def run(batches):
        for table in cells(batches):
            if table.num_rows > 1:
                open_ = _open_pairs(_matrix(table.column("sketch"), np.uint8), table.column("comp").to_numpy(), table.column("side").to_numpy(), percent / 100 - 0.15)
                hit = np.flatnonzero(open_.any(axis=0) | open_.any(axis=1))
                if len(hit):
                    yield from table.take(hit).select(["cell", "tree", "side", "rep", "comp"]).to_batches()

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "cell long, tree int, side int, rep long, comp long")


def _block_links(rows: DataFrame, percent: int, trees: int, depth: int, least: int) -> DataFrame:
    """Links between components within cells, confirmed on full sets; a spanning set of them."""

    def run(batches):
        for table in cells(batches):
            if table.num_rows < 2:
                continue
            sigs = _matrix(table.column("sig"), np.uint32)
            reps, comps, tree = table.column("rep").to_pylist(), table.column("comp").to_numpy(), table.column("tree")[0].as_py()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
            open_ = _open_pairs(sigs, comps, table.column("side").to_numpy(), percent / 100 - 0.15)
            heads = sigs.reshape(len(sigs), trees, depth)[:, :tree, :least]
            groups, us, vs = Groups(), [], []
            for i in np.flatnonzero(open_.any(axis=1)):
                js = np.flatnonzero(open_[i])
                js = js[~(heads[js] == heads[i]).all(axis=2).any(axis=1)]  # those met in an earlier order already
                for j in js[np.argsort(-(sigs[js] == sigs[i]).mean(axis=1), kind="stable")].tolist():
                    a, b = int(comps[i]), int(comps[j])
                    if groups.find(a) != groups.find(b) and is_linked(sets[i], sets[j], percent):
                        groups.join(a, b)
                        us.append(reps[i])
                        vs.append(reps[j])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "u long, v long")


def _mixed_cells(regions: DataFrame, comps: DataFrame, block: int) -> DataFrame:
    """Rows of regions with several components, dealt to cells of at most about two blocks.

    The largest component of a region is cut into blocks that meet the blocks
    of all others, but not one another: side 0 is its, side 1 the others', and
    side 2 the others' among themselves.
    """
    placed = regions.join(comps, "rep").select("region", "tree", "rep", "comp")
    sizes = placed.groupBy("region", "comp").agg(F.count("*").alias("n"))
    mixed = (sizes.groupBy("region").agg(F.count("*").alias("k"), F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("top")).filter("k > 1")
             .select("region", F.col("top.comp").alias("main"), F.ceil(F.col("top.n") / block).alias("m"), F.ceil((F.col("all") - F.col("top.n")) / block).alias("o")))
    rows = stored(placed.join(mixed, "region"), "mixed")
    on_main = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(on_main, F.col("m")).otherwise(F.col("o")))
    meets = lambda count, of: F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), of)
    key = lambda kind, i, j: F.xxhash64("region", F.lit(kind), i, j)
    entry = lambda side, k: F.struct(F.lit(side).alias("side"), k.alias("cell"))
    to = F.when(on_main, meets("o", lambda j: entry(0, key(0, F.col("own"), j)))).otherwise(F.concat(
        meets("m", lambda i: entry(1, key(0, i, F.col("own")))),
        meets("o", lambda j: entry(2, key(1, F.least(F.col("own"), j), F.greatest(F.col("own"), j))))))
    return rows.withColumn("own", own).select("region", "tree", "rep", "comp", F.explode(to).alias("to")).select("tree", "rep", "comp", "to.side", "to.cell")


def near_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, trees: int = 25,
                depth: int = 6, least: int = 4, close_trees: int = 3, block: int = 256, ids_link: bool = True) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, row_key, chosen)`` of every row.

    ``component_id`` is the smallest id reachable by links; ``kept`` marks the
    rows of that id, ``chosen`` those of one text that stands for the component; ``row_key`` is the
    hash of id and text. ``least`` values of a label make a region, ``close_trees``
    orders are read by neighbours, ``block`` classes at most meet in a block.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                            F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"))
    signed = stored(_sign(docs, shingle, trees * depth), "signed")
    members = signed.filter("key is not null and doc_id is not null")
    classes = stored(members.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("sig").alias("sig"))
                     .withColumn("rep", F.monotonically_increasing_id()), "classes")

    labels = _labels(classes, trees, depth, least)
    shared = _labels(classes, trees, depth, least).groupBy("region").agg(F.count("*").alias("n")).filter("n > 1").select("region")
    regions = stored(labels.join(shared, "region"), "regions")
    nodes = stored(regions.select("rep").distinct(), "nodes")

    def elements(batches):
        hasher = WordHasher()
        for batch in small_batches(batches, 16 << 20):
            sets = [shingle_set(hasher, x, shingle) for x in batch.column(2).to_pylist()]
            own = pa.array([_key(x) == key for x, key in zip(sets, batch.column(1).to_pylist(), strict=True)])  # an id may have other texts
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], names=["rep", "elements"]).filter(own)

    asked = nodes.join(classes.select("rep", "first_id", "key"), "rep")
    sets = stored(docs.join(asked, docs["doc_id"] == asked["first_id"]).select("rep", "key", "text").mapInArrow(elements, "rep long, elements binary"), "sets")
    if not sets.groupBy("rep").count().filter("count > 1").isEmpty():  # repeated rows
        sets = stored(sets.dropDuplicates(["rep"]), "sets")
    close = stored(_neighbour_links(regions.filter(F.col("tree") < close_trees).select("region", "deep", "rep").join(sets, "rep"), percent).distinct(), "close")
    comps = stored(connected_components(nodes, close, "rep").select("rep", F.col("component").alias("comp")), "comps")

    cell_rows = _mixed_cells(regions, comps, block)

    def sketch(batches):
        for batch in batches:
            if batch.num_rows:
                small = _matrix(pa.chunked_array([batch.column(1)]), np.uint32).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in small], pa.binary())], names=["rep", "sketch"])

    sketches = classes.select("rep", "sig").mapInArrow(sketch, "rep long, sketch binary")
    likely = stored(_likely(cell_rows.join(sketches, "rep").select("cell", "tree", "side", "rep", "comp", "sketch"), percent), "likely")
    full = likely.join(classes.select("rep", "sig"), "rep").join(sets, "rep").select("cell", "tree", "side", "rep", "comp", "sig", "elements")
    far = _block_links(full, percent, trees, depth, least)
    links = far.unionByName(comps.filter("rep <> comp").select(F.col("rep").alias("u"), F.col("comp").alias("v")))
    if ids_link:
        links = links.unionByName(shared_ids(members.select("doc_id", "key"), classes, "doc_id", "key"))
    links = stored(links, "links")
    linked = links.select(F.col("u").alias("rep")).unionAll(links.select(F.col("v").alias("rep"))).distinct()
    final = named_components(classes, connected_components(linked, links, "rep"))

    placed = classes.select("key", "rep", "first_id").join(final, "rep", "left").select(
        "key", "first_id", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("chosen", F.lit(True)).alias("chosen"))
    found = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id"))
    return (signed.select("doc_id", "n_shingles", "key", "row_key").join(placed, "key", "left")
            .select("doc_id", "n_shingles", found.alias("component_id"), "row_key",
                    (F.col("key").isNull() | F.col("doc_id").isNull() | F.col("chosen") & (F.col("doc_id") == F.col("first_id"))).alias("chosen"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "row_key", "chosen"))
