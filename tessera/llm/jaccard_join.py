"""Exact Jaccard join of documents' shingle sets as a metric-space join.

1. Far sets are cut off with pivots of one shingle each, in one order of all shingles. Two linked sets share
   enough of their first shingles, so a set only has to go to the regions of those; a set that meets too few
   others there has no link. Document pivots cannot do this step: unrelated texts all lie at a distance of
   about 1 from each other, where the triangle inequality tells nothing.
2. What is left shows more of its shingles and falls into islands, connected groups of shared regions; every
   link is inside one.
3. Islands are joined by document pivots: each row goes to its nearest pivot's Voronoi region and, within the
   triangle inequality's window, to those of other pivots; regions are split again until they are small, and
   inside them only rows at similar distances from the pivot are compared. Large islands are dealt out as
   pairs of blocks of rows of similar size.

Regions of the first two steps are ranges of pivots, whose members travel packed (see ``packed``). A task sends
at most ``HEAVY`` of the members that it has of one region: of more, the smallest stands for the others there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import dealt_anew, dropped, hash_words, in_arrow, mix, rolled, saved, small, utf8
from tessera.llm.components import components
from tessera.llm.packed import PAIRS, bucket_count, dealt, runs, unpacked

WIDTH = 4
LEAST = 85
BLOCK = 256
BLOCKS = 64
BLOCK_BYTES = 32_000_000
HEAVY = 256
#: Percent of a set that it shows beyond what any prefix filter needs, in the first round and in the second.
EXTRA = (5, 50)
_REGION = "bucket bigint, pivots binary, nodes binary, known binary, centres binary"


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; all words of a shorter text are one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    n = min(width, len(words))
    return np.unique(mix(rolled(hash_words(words), n) + np.uint64(n)))


def node_of(values: np.ndarray) -> tuple[int, int]:
    """Name of a set: a 128-bit hash of its members, as two signed halves. Regions go by the first."""
    import xxhash

    name = xxhash.xxh3_128_intdigest(values.tobytes())
    return (name >> 64) - (1 << 63), (name & (1 << 64) - 1) - (1 << 63)


def shown(values: np.ndarray, least: int, extra: int) -> np.ndarray:
    """The first shingles of a set, in the order of their hashes, which all sets share.

    A linked set holds at least least % of the n. So of any (n minus those) + l first ones of each, in the
    same order, at least l are shared; l is ``extra`` % of the smaller size, see ``_needed``.
    """
    return values[: len(values) * (100 - least) // 100 + len(values) * extra // 100 + 1]


def _needed(n, least: int, extra: int):
    """How many of the shingles that a set of size n shows must be shown by any set linked with it (numbers or arrays)."""
    return -(-n * least // 100) * extra // 100 + 1


class Regions:
    """Members of regions that a task has met: pairs of a pivot and a set's node, sent in packed rows."""

    def __init__(self, buckets: int):
        self.buckets, self.pivots, self.nodes, self.held = buckets, [], [], 0

    def add(self, node: int, pivots: np.ndarray) -> None:
        self.pivots.append(pivots)
        self.nodes.append(np.full(len(pivots), node, np.int64).view(np.uint64))
        self.held += len(pivots)

    def rows(self) -> list[list]:
        """Columns of ``_REGION``.

        Of a region with over ``HEAVY`` members here, only the smallest goes on, marked by its pivot's last bit;
        the others are known to share the region and have the smallest as their centre.
        """
        pivots, nodes = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (self.pivots, self.nodes))
        self.pivots, self.nodes, self.held = [], [], 0
        pivots &= ~np.uint64(1)
        order = np.lexsort((nodes, pivots))
        pivots, nodes = pivots[order], nodes[order]
        once = runs(pivots, nodes)
        pivots, nodes = pivots[once], nodes[once]
        first = runs(pivots)
        size = np.diff(np.append(first, len(pivots)))
        heavy = np.repeat(size > HEAVY, size)
        centre, goes = np.repeat(nodes[first], size), ~heavy
        goes[first] = True
        pivots[first[size > HEAVY]] |= np.uint64(1)
        known, centres = nodes[~goes], centre[~goes]
        order = np.argsort(known, kind="stable")
        return dealt(self.buckets, (pivots[goes], nodes[goes]), (known[order], centres[order]))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _batch(schema: str, given: dict) -> pa.RecordBatch:
    """A batch of the columns of ``schema``, null where nothing is given."""
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))]
    n = len(next(iter(given.values())))
    columns = [pa.nulls(n, kind) if name not in given else x if isinstance(x := given[name], pa.Array) else pa.array(x, kind) for name, kind in fields]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _met(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Members of one bucket's shared regions (node, centre, whether it stands for others), and those known before."""
    marked, nodes = unpacked(table["pivots"]), unpacked(table["nodes"])
    pivots = marked & ~np.uint64(1)
    # Marked rows come first, so that they are the ones that stay of equal pairs.
    order = np.lexsort((~marked, nodes, pivots))
    marked, pivots, nodes = marked[order], pivots[order], nodes[order]
    once = runs(pivots, nodes)
    stands, pivots, nodes = (marked[once] & np.uint64(1)).astype(bool), pivots[once], nodes[once]
    first = runs(pivots)
    size = np.diff(np.append(first, len(pivots)))
    shared = (size > 1) | (np.add.reduceat(stands, first) > 0 if len(first) else size > 1)
    keep = np.repeat(shared, size)
    return nodes[keep], np.repeat(nodes[first], size)[keep], stands[keep], (unpacked(table["known"]), unpacked(table["centres"]))


def _counted(table: pa.Table) -> pa.Table:
    """How many shared regions of one bucket each set is in."""
    nodes, _, _, (known, _) = _met(table)
    names, times = np.unique(np.concatenate([nodes, known]), return_counts=True)
    return pa.table({"node": pa.array(names.view(np.int64)), "met": pa.array(times, pa.int64())})


def _pointed(table: pa.Table, buckets: int) -> pa.Table:
    """Members of one bucket's shared regions with the regions' smallest sets, dealt by node."""
    nodes, centres, stands, (known, of) = _met(table)
    nodes, centres = np.concatenate([nodes, known]), np.concatenate([centres, of])
    stands = np.concatenate([stands, np.zeros(len(known), bool)]).astype(np.uint8)
    order = np.lexsort((centres, nodes))
    columns = dealt(buckets, (nodes[order], centres[order], stands[order]))
    return pa.table(dict(zip(("bucket", "nodes", "centres", "stands"), (pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])))))


def _edges(table: pa.Table, least: int) -> pa.Table:
    """Edges between sets and smallest sets of their regions that may stand for a link.

    A set needs so many shared regions. It may leave its weakest edges away while they stand for less than
    half of those: two linked sets then still keep an edge to a common set. An edge of a set that stands for
    others of a heavy region stays, as theirs lead to it.
    """
    nodes, centres, stands = unpacked(table["nodes"]), unpacked(table["centres"]), unpacked(table["stands"], np.uint8)
    names, sizes = unpacked(table["names"]), unpacked(table["sizes"]).astype(np.int64)
    order = np.argsort(names)
    names, sizes = names[order], sizes[order]
    order = np.lexsort((centres, nodes))
    nodes, centres, stands = nodes[order], centres[order], stands[order]
    own, met = np.unique(nodes, return_counts=True)
    need = _needed(sizes[np.searchsorted(names, own)], least, EXTRA[1]) if len(own) else met
    first = runs(nodes, centres)
    weight = np.diff(np.append(first, len(nodes)))
    firm = np.maximum.reduceat(stands, first) > 0 if len(first) else stands > 0
    nodes, centres = nodes[first], centres[first]
    at = np.searchsorted(own, nodes)
    order = np.lexsort((centres, weight, at))
    nodes, centres, firm, at = nodes[order], centres[order], firm[order], at[order]
    weight = np.where(nodes == centres, 0, weight[order])
    total = np.cumsum(weight)
    begins = runs(at)
    away = total - np.repeat(total[begins] - weight[begins], np.diff(np.append(begins, len(at))))
    keep = (nodes != centres) & (firm | (met[at] >= need[at]) & (2 * away >= need[at]))
    return pa.table({"a": pa.array(nodes[keep].view(np.int64)), "b": pa.array(centres[keep].view(np.int64))})


def _regions(rows: DataFrame, describe: Callable[[pa.RecordBatch, list[np.ndarray]], tuple], least: int, extra: int, width: int, schema: str) -> DataFrame:
    """What ``describe`` says of each row, and in rows of their own the regions of the sets met; saved."""
    buckets = bucket_count(rows.sparkSession)
    both = f"{schema}, {_REGION}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions = Regions(buckets)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                found = []
                for text in utf8(batch, "text"):
                    values = shingles(text, width)
                    found.append(values)
                    if len(values):
                        regions.add(node_of(values)[0], shown(values, least, extra))
                yield _batch(both, dict(zip(_names(schema), describe(batch, found))))
                if regions.held > PAIRS:
                    yield _batch(both, dict(zip(_names(_REGION), regions.rows())))
        if regions.held:
            yield _batch(both, dict(zip(_names(_REGION), regions.rows())))

    return saved(in_arrow(rows, run, both))


def _described(docs: DataFrame, least: int, width: int) -> DataFrame:
    """Set name and size of every document, and the regions of the first round."""

    def describe(batch: pa.RecordBatch, found: list[np.ndarray]) -> tuple:
        names = [node_of(v) if len(v) else (None, None) for v in found]
        halves = (pa.array([name[k] for name in names], pa.int64()) for k in (0, 1))
        return batch.column("doc_id"), batch.column("row"), *halves, pa.array(list(map(len, found)), pa.int64())

    return _regions(docs, describe, least, EXTRA[0], width, "doc_id bigint, row bigint, node bigint, node2 bigint, n bigint")


def _members(docs: DataFrame, described: DataFrame, sets: DataFrame, least: int, width: int) -> DataFrame:
    """Shingles of the sets that the first round leaves, from one document of each, and the regions of the second."""
    regions = described.where("bucket is not null").select(*_names(_REGION))
    counts = regions.groupBy("bucket").applyInArrow(_counted, "node bigint, met bigint").groupBy("node").agg(F.sum("met").alias("met"))
    left = sets.join(counts, "node").where(F.col("met") >= F.expr(f"cast(floor(ceil(n * {least} / 100) * {EXTRA[0]} / 100) + 1 as bigint)"))
    chosen = small(left.select("node", "node2", F.col("doc.doc_id").alias("id"), F.col("doc.row").alias("text_row")))
    texts = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["id"]) & (docs["row"] == chosen["text_row"])).select("node", "node2", "text")

    def describe(batch: pa.RecordBatch, found: list[np.ndarray]) -> tuple:
        return batch.column("node"), batch.column("node2"), pa.array(list(map(len, found)), pa.int64()), pa.array([v.tobytes() for v in found], pa.binary())

    return _regions(texts, describe, least, EXTRA[1], width, "node bigint, node2 bigint, n bigint, members binary")


def _islands(members: DataFrame, least: int) -> DataFrame:
    """``node, label`` of the sets that the second round leaves, by connected shared regions."""
    buckets = bucket_count(members.sparkSession)
    regions = members.where("bucket is not null").select(*_names(_REGION))
    pointed = regions.groupBy("bucket").applyInArrow(lambda t: _pointed(t, buckets), "bucket bigint, nodes binary, centres binary, stands binary")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "n"))
            order = np.argsort(nodes.view(np.uint64))
            columns = dealt(buckets, (nodes.view(np.uint64)[order], sizes.view(np.uint64)[order]))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["bucket", "names", "sizes"])

    sizes = in_arrow(members.where("bucket is null").select("node", "n"), sized, "bucket bigint, names binary, sizes binary")
    both = pointed.unionByName(sizes, allowMissingColumns=True)
    found = saved(both.groupBy("bucket").applyInArrow(lambda t: _edges(t, least), "a bigint, b bigint"))
    labels = components(found)
    dropped(found)
    return labels


class Sets:
    """Sets of one group as rows of codes, with exact overlaps."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        values, codes = np.unique(np.concatenate(rows), return_inverse=True)
        self.rows = np.split(codes.astype(np.int32), np.cumsum(self.sizes)[:-1])
        self.mark = np.zeros(len(values), np.uint8)

    def overlaps(self, row: int, others: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        self.mark[self.rows[row]] = 1
        out = np.add.reduceat(self.mark[flat], starts, dtype=np.int64)
        self.mark[self.rows[row]] = 0
        return out

    def flat(self, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([self.rows[o] for o in others]), np.concatenate([[0], np.cumsum(self.sizes[others])[:-1]])

    def distances(self, row: int, others: np.ndarray) -> np.ndarray:
        common = self.overlaps(row, others, *self.flat(others))
        return 1.0 - common / (self.sizes[row] + self.sizes[others] - common)


def metric_links(sets: Sets, left: np.ndarray, right: np.ndarray, least: int, depth: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(x, linked rows of ``right``) for rows x of ``left``, exactly; every pair is met once.

    ``left`` is dealt to the Voronoi regions of a few pivots. If x and y are linked and x is nearest to pivot
    p, then d(y, p) <= d(x, p) + r <= d(x, q) + r <= d(y, q) + 2 r for every pivot q: so y goes to all
    regions within 2 r of its nearest.
    """
    radius = 1.0 - least / 100 + 1e-9
    if len(left) * len(right) > 32 * 32 and depth < 6:
        pivots = left[np.linspace(0, len(left) - 1, 4).astype(int)]
        d_left, d_right = (np.array([sets.distances(p, rows) for p in pivots]) for rows in (left, right))
        home = d_left.argmin(axis=0)
        inside = d_right <= d_right.min(axis=0) + 2 * radius
        parts = [(left[home == k], right[inside[k]]) for k in range(len(pivots))]
        if sum(len(a) * len(b) for a, b in parts) <= 0.8 * len(left) * len(right):
            for a, b in parts:
                if len(a) and len(b):
                    yield from metric_links(sets, a, b, least, depth + 1)
            return
        d_left, d_right = d_left[0], d_right[0]
    else:
        d_left, d_right = sets.distances(left[0], left), sets.distances(left[0], right)
    order = np.argsort(d_right, kind="stable")
    right, d_right = right[order], d_right[order]
    flat, starts = sets.flat(right)
    ends = np.append(starts, len(flat))
    for x, d in zip(left, d_left):
        a, b = np.searchsorted(d_right, [d - radius, d + radius], side="left")
        if a >= b:
            continue
        near = right[a:b]
        common = sets.overlaps(x, near, flat[ends[a] : ends[b]], starts[a:b] - starts[a])
        linked = near[100 * common >= least * (sets.sizes[x] + sets.sizes[near] - common)]
        if len(linked):
            yield int(x), linked


def _joined(table: pa.Table, least: int) -> pa.Table:
    """Links of one group: how many each row has in it, and what they connect.

    In a whole island the smallest row of each component is the other rows' ``other``; from a pair of blocks
    come the edges of a spanning forest, and rows of their own for the counts.
    """
    nodes, block = table["id"].to_numpy(), table["block"].to_numpy()
    sets = Sets([np.frombuffer(b, np.uint64) for b in table["members"].to_pylist()])
    i, j, whole = table["i"][0].as_py(), table["j"][0].as_py(), table["whole"][0].as_py()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, forest = np.zeros(len(nodes), np.int64), []
    for x, linked in metric_links(sets, left, right, least) if len(left) and len(right) else ():
        linked = linked[linked > x] if i == j else linked
        links[x] += len(linked)
        links[linked] += 1
        for y in linked.tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[a] = b
                forest.append((x, y))
    at = np.flatnonzero(links)
    if whole:
        forest, others = [], nodes[[root(x) for x in at.tolist()]] if len(at) else nodes[:0]
    else:
        others = nodes[at]
    a = np.concatenate([nodes[at], nodes[[x for x, _ in forest]] if forest else nodes[:0]])
    b = np.concatenate([others, nodes[[y for _, y in forest]] if forest else nodes[:0]])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(np.concatenate([links[at], np.zeros(len(forest), np.int64)])), "whole": pa.array(np.full(len(a), whole))})


def _dealt(members: DataFrame, least: int) -> DataFrame:
    """Members in the groups that are joined: an island, or in a large one a pair of blocks of rows.

    Sizes of linked sets differ by a factor of at most 100 / least, the triangle inequality's window around
    the empty set under symmetric difference. So a large island's rows are dealt by the logarithm of their
    size, and only blocks of the same or the next step meet. Every pair of rows meets in one group.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / least) * (1 + 1e-9))).cast("int")
    rows = members.withColumn("step", step)
    island = Window.partitionBy("label")  # steps of one island: some hundreds at most
    beside = lambda d: F.coalesce(F.max("blocks").over(island.orderBy("step").rangeBetween(d, d)), F.lit(0))
    blocks = F.greatest(F.least(F.ceil(F.col("k") / BLOCK), F.lit(BLOCKS)), F.ceil(F.col("total") * 8 / BLOCK_BYTES)).cast("int")
    steps = rows.groupBy("label", "step").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
    large = steps.withColumns({"all": F.sum("k").over(island), "weight": F.sum("total").over(island), "blocks": blocks}).where((F.col("all") > 2 * BLOCK) | (F.col("weight") * 8 > 2 * BLOCK_BYTES))
    known = small(large.withColumns({"above": beside(1), "under": beside(-1)}).select("label", "step", "blocks", "above", "under"))
    rows = rows.join(known, ["label", "step"], "left").withColumn("own", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int"))
    # Blocks are numbered within a step; the upper step's follow those of the lower one.
    counted = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    at = lambda low, i, j, block, whole: F.struct(low.cast("int").alias("low"), i.cast("int").alias("i"), j.cast("int").alias("j"), block.cast("int").alias("block"), F.lit(whole).alias("whole"))
    none, own, step = F.lit(0), F.col("own"), F.col("step")
    same = F.transform(counted(F.col("blocks")), lambda o: at(step, F.least(own, o), F.greatest(own, o), own, False))
    lower = F.transform(counted(F.col("above")), lambda o: at(step, own, F.col("blocks") + o, own, False))
    upper = F.transform(counted(F.col("under")), lambda o: at(step - 1, o, F.col("under") + own, F.col("under") + own, False))
    places = F.when(F.col("blocks").isNull(), F.array(at(none, none, none, none, True))).otherwise(F.concat(same, lower, upper))
    return rows.select("label", "id", "members", F.explode(places).alias("at")).select("label", "at.*", "id", "members")


def _linked(members: DataFrame, least: int) -> DataFrame:
    """``id, label, n_links`` of the sets that have links; a label is shared by all that links connect."""
    groups = _dealt(members, least).groupBy("label", "low", "i", "j")
    found = saved(groups.applyInArrow(lambda table: _joined(table, least), "a bigint, b bigint, links bigint, whole boolean"))
    classes = components(found.where("not whole and a <> b").select("a", "b"))
    counts = found.where("not whole and a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    apart = classes.join(counts, "node").select(F.col("node").alias("id"), "label", "n_links")
    return found.where("whole").select(F.col("a").alias("id"), F.col("b").alias("label"), F.col("links").alias("n_links")).unionByName(apart)


def join(docs: DataFrame, least: int = LEAST, width: int = WIDTH) -> DataFrame:
    """Classes of documents linked by shingle sets of at least ``least`` % Jaccard similarity.

    Returns ``doc_id, row, n_shingles, component_id, n_links, first_row``, one row for each input row. Shingles
    are ``width`` words, of texts in lower case (A-Z only); a shorter text's words are one. ``component_id`` is the
    smallest id that links lead to, ``first_row`` the hashed text of the class's first document (smallest id,
    then hash), ``n_links`` the number of other different sets that the document's set is linked with. Null
    and empty texts and those without words are linked with nothing and stand alone under their own id. Null ids never
    name a class unless it has no other. Equal texts and equal sets are one class, repeated rows repeat; texts of any
    length are taken whole, an empty table gives none. Other columns are ignored, whatever their names.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    described = _described(docs, least, width)
    rows = described.where("bucket is null").select("doc_id", "row", "node", "node2", "n")
    doc = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    sets = saved(rows.where("n > 0").groupBy("node", "node2").agg(F.min(doc).alias("doc"), F.first("n").alias("n")))
    found = _members(docs, described, sets, least, width)
    rows, described = saved(rows), dropped(described)
    islands = _islands(found, least)
    members = found.where("bucket is null").select("node", "node2", "n", "members").join(small(islands), "node")
    if members.groupBy("node", "node2").count().where("count > 1").limit(1).count():
        # Rows that share id and text give their set several times.
        members = members.dropDuplicates(["node", "node2"])
    members, found = saved(members.withColumn("id", F.monotonically_increasing_id())), dropped(found, islands)
    linked = _linked(members, least).join(members.select("id", "node", "node2"), "id").join(sets.select("node", "node2", "doc"), ["node", "node2"])
    linked = saved(linked.select("node", "node2", "label", "n_links", "doc"))
    firsts = linked.groupBy("label").agg(F.min("doc").alias("first"))
    named = linked.join(dealt_anew(firsts), "label").select("node", "node2", "n_links", "first")
    best = saved(sets.join(named, ["node", "node2"], "left").select("node", "node2", F.coalesce("first", "doc").alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    dropped(members, sets, linked)
    out = rows.join(best, ["node", "node2"], "left")
    own = F.col("first").isNull()
    return out.select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(own, F.col("row")).otherwise(F.col("first.row")).alias("first_row"),
    )


def representatives(docs: DataFrame, least: int = LEAST, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id, a null id only where there is no other.

    Documents without words stay, null and empty texts too. Rows that share id and text are one document: of
    those that differ in other columns, the one whose columns hash lowest stays. All columns are kept, whatever their
    names; an empty table gives none.
    """
    found = saved(join(docs, least, width))
    key = [F.col("doc_id").isNull().alias("key_none"), F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.col("row").alias("key_row")]
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("row") == F.col("first_row"))
    goes = found.groupBy(*key).agg(F.count(F.lit(1)).alias("times"), F.first(kept).alias("kept")).where("not kept or times > 1")
    goes = small(goes.select("key_none", "key_id", "key_row", "kept"))
    keys = ["key_none", "key_id", "key_row"]
    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("all"), F.col("doc_id").isNull().alias("key_none"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("key_id"), F.xxhash64("text").alias("key_row"))
    several = keyed.join(goes.where("kept"), keys).groupBy(*keys).agg(F.min_by("all", F.xxhash64("all")).alias("all"))
    return keyed.join(goes, keys, "left_anti").select("all.*").unionByName(several.select("all.*"))
