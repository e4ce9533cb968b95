"""N-gram Jaccard join with signature trees.

Every document becomes the set of its distinct `SHINGLE`-word shingles; two documents link when the
sets' Jaccard similarity is `PERCENT` % or more.  Equal sets are one class from the start.

Classes meet in blocks, one signature tree for each.  A block holds the classes that agree on `ROWS`
minima of their sets under random orders, and each class lies in `BANDS` blocks.  A pair at the
threshold shares no block with probability (1 - 0.75**3)**48 < 4e-12, a more similar one more rarely
still; that, and shingle hashes of 64 bits from word hashes of 62, is all that is left to chance.  No block, bucket or partner
count is capped.

1. In each block every class is compared with the block's least one, wherever their sizes allow it.
   That is linear in the block's size, and it is what holds large groups of copies together.
2. Connected components of the links found so far.
3. Blocks that still span several components are joined by signature trees: leaves of a few classes
   of one component and like size, nodes with the OR of their token bitmaps, the range of their sizes
   and of their components.  The dual traversal drops a pair of nodes when even the largest overlap
   that the bitmaps and sizes allow is too small, or when both lie within one component, so the work
   does not follow the square of a group of copies.  A pair is named only in the first block that it
   shares.  A class names its `PARTNERS` most promising ones at first; where it has more, steps 2 and
   3 are repeated for those blocks with more of them, by when most lie in its own component.  Blocks of more than a cell's
   size are cut into cells, whose pairs are dealt out; the block's largest component meets the others
   only, so copies that it has already joined cost one row each, not one for every cell of theirs.
4. What the trees name is compared exactly, as sets, and the components are formed anew.

Defined results: texts without words, null included, are empty sets, link with nothing and are their
own component; a row without doc_id takes no part and has a null component; rows that repeat a doc_id
are judged each by its own text; an empty table gives an empty result; extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, in_arrow, written
from .text import BYTE_LOWER, SPACE, chunks, grams, mix, prefix, runs, span_hash

SHINGLE = 5
PERCENT = 75
BANDS = 48
ROWS = 3
BITS = 4096
LEAF = 16
FANOUT = 8
#: Classes of a cell: a block is cut into cells of about this size, and a task joins two of them.
CELL = 2048
#: Partners that a class names in a cell in the first round of trees; later rounds allow `MORE` times as many.
PARTNERS = 16
MORE = 16

SKETCH = "doc_id bigint, mark bigint, n int, low bigint, high bigint, bands array<bigint>, bitmap binary"
SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, and the rows' bounds in them."""
    start, end = runs(~SPACE[buf], offs)
    first = np.searchsorted(start, offs)
    words = span_hash(prefix(BYTE_LOWER[buf]), start, end)
    keys, at = grams(words, first, SHINGLE)
    row = np.searchsorted(first, at, "right") - 1
    count = np.diff(first)
    for n in range(1, SHINGLE):  # shorter texts are one shingle as a whole
        of = np.flatnonzero(count == n)
        if len(of):
            value = np.full(len(of), n, np.uint64)
            for k in range(n):
                value = mix(value * np.uint64(31) + words[first[:-1][of] + k])
            keys, row = np.concatenate([keys, value]), np.concatenate([row, of])
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    keys, row = keys[new], row[new]
    return keys, np.searchsorted(row, np.arange(len(offs)))


def _sketch(batches):
    for rows, buf, offs in chunks(batches):
        keys, bounds = shingles(buf, offs)
        size = np.diff(bounds)
        some = np.flatnonzero(size)
        n = len(rows)
        low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        bands = np.zeros((n, BANDS), np.uint64)
        bitmap = np.zeros((n, BITS), bool)
        if len(some):
            at = bounds[:-1][some]
            low[some] = np.add.reduceat(mix(keys), at)
            high[some] = np.add.reduceat(mix(keys ^ np.uint64(0x5851F42D4C957F2D)), at)
            for b in range(BANDS):
                value = np.full(len(some), b + 1, np.uint64)
                for seed in SEEDS[b * ROWS : (b + 1) * ROWS]:
                    value = mix(value + np.minimum.reduceat(keys * seed, at))
                bands[some, b] = value
            bitmap[np.repeat(np.arange(n), size), (keys & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bitmap, axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64)))
        yield pa.record_batch([rows.column("doc_id"), rows.column("mark"), pa.array(size.astype(np.int32)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), lists, pa.array([x.tobytes() for x in packed], pa.binary())], names=[f.split()[0] for f in SKETCH.split(", ")])


def _sets(batches):
    """The shingle hashes of each class."""
    for rows, buf, offs in chunks(batches):
        keys, bounds = shingles(buf, offs)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.view(np.int64)))
        yield pa.record_batch([rows.column("node"), lists], names=["node", "keys"])


def _hashed(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The members of each row's set, told apart by row, and the sets' bounds."""
    offs = lists.offsets.to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(offs)).astype(np.uint64)
    return mix(lists.flatten().to_numpy().view(np.uint64) + row * np.uint64(0x9E3779B97F4A7C15)), offs - offs[0]


def _similar(batches):
    """Pairs whose whole shingle sets reach the threshold."""
    for rows in batches:
        if not len(rows):
            continue
        (one, bounds), (two, other) = _hashed(rows.column("keys_a")), _hashed(rows.column("keys_b"))
        both = np.concatenate([[0], np.cumsum(np.isin(one, two))])
        common = both[bounds[1:]] - both[bounds[:-1]]
        linked = pa.array((100 * common >= PERCENT * (np.diff(bounds) + np.diff(other) - common)) & (common > 0))
        yield rows.select(["a", "b"]).filter(linked)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("keys").alias("keys_a")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("keys").alias("keys_b")), "b")
    return in_arrow(both.select("a", "b", "keys_a", "keys_b"), _similar, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """A written table (node, component): the least node that links (a, b) reach; nodes without links are absent.

    Every node's neighbours hang on the least of them, in turn over larger and over smaller ones, until
    nothing changes; the rounds grow with the logarithm of a component's size.
    """
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        first = written(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m")), "least")
        large = both.filter("v > u").join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.toDF("u", "v")).distinct()
        before, last = state, edges
        edges = written(small, "small")
        state = mark(edges)
        discard(large, last, first, least)
        if before == state:
            break
    out = written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "components")
    discard(edges)
    return out


class Tree:
    """A signature tree over classes in order of component, size and bitmap."""

    def __init__(self, size: np.ndarray, bitmap: np.ndarray, component: np.ndarray):
        self.order = np.lexsort((bitmap[:, 0], size, component))
        size, bitmap, component = size[self.order], bitmap[self.order], component[self.order]
        spare = size - np.bitwise_count(bitmap).sum(1, dtype=np.int64)
        # least and most size, OR of bitmaps, most tokens beyond the bits, least and most component
        self.levels = [(size, size, bitmap, spare, component, component)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            low, high, bits, spare, first, last = self.levels[-1]
            at = np.arange(0, len(low), step)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.bitwise_or.reduceat(bits, at, axis=0), np.maximum.reduceat(spare, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))
            step = FANOUT

    def _overlap(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The most tokens that classes under nodes x and y may share; -1 where no pair can be similar."""
        low, high, bits, spare, first, last = self.levels[level]
        out = np.full(len(x), -1)
        apart = np.flatnonzero((first[x] != last[x]) | (first[y] != last[y]) | (first[x] != first[y]))
        apart = apart[(100 + PERCENT) * np.minimum(high[x[apart]], high[y[apart]]) >= PERCENT * (low[x[apart]] + low[y[apart]])]
        for i in range(0, len(apart), 8192):
            at = apart[i : i + 8192]
            u, v = x[at], y[at]
            common = np.bitwise_count(bits[u] & bits[v]).sum(1, dtype=np.int64) + np.minimum(spare[u], spare[v])
            overlap = np.minimum(common, np.minimum(high[u], high[v]))
            out[at] = np.where((100 + PERCENT) * overlap >= PERCENT * (low[u] + low[v]), overlap, -1)
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Dual traversal from the root: pairs of classes that no bound excludes, with the most they may share."""
        x = y = overlap = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            if level < len(self.levels) - 1:
                step, n = LEAF if level == 0 else FANOUT, len(self.levels[level][0])
                child = np.arange(step)
                x, y = (np.repeat(x * step, step * step) + np.tile(np.repeat(child, step), len(x))), (np.repeat(y * step, step * step) + np.tile(child, len(y) * step))
                inside = (x < n) & (y < n) & (x <= y if level else x < y)
                x, y = x[inside], y[inside]
            elif level == 0:
                return (np.zeros(0, np.int64),) * 3
            overlap = self._overlap(level, x, y)
            x, y, overlap = x[overlap >= 0], y[overlap >= 0], overlap[overlap >= 0]
        return self.order[x], self.order[y], overlap


def _best(owner: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Of each owner's entries those of the `most` highest values."""
    order = np.lexsort((-value, owner))
    new = np.ones(len(order), bool)
    new[1:] = owner[order][1:] != owner[order][:-1]
    first = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < most]


def _across(partners: int):
    """Joins each cell's classes by tree; rows come sorted by block and cell."""

    def join(table: pa.Table):
        matrix = lambda c: np.frombuffer(b"".join(table[c].to_pylist()), np.uint64).reshape(table.num_rows, -1)
        node, component, pivot, cell, block = (table[c].to_numpy() for c in ("node", "component", "pivot", "side", "block"))
        x, y, overlap = Tree(table["n"].to_numpy().astype(np.int64), matrix("bitmap"), component).pairs()
        new = (component[x] != component[y]) & (node[x] != pivot[x]) & (node[y] != pivot[y])
        if cell.any():  # two cells meet: pairs inside one of them are joined elsewhere
            new &= cell[x] != cell[y]
        x, y, overlap = x[new], y[new], overlap[new]
        bands = np.array(table["bands"].combine_chunks().flatten()).reshape(table.num_rows, -1)
        here = np.concatenate([np.zeros(0, bool), *((same := bands[x[i : i + 8192]] == bands[y[i : i + 8192]])[np.arange(len(same)), same.argmax(1)] & (bands[x[i : i + 8192], same.argmax(1)] == block[0]) for i in range(0, len(x), 8192))])
        x, y, overlap = x[here], y[here], overlap[here]
        _, of, members = np.unique(component, return_inverse=True, return_counts=True)
        swap = members[of[x]] > members[of[y]]  # the class of the smaller component names the pair
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        best = _best(x, overlap, partners)
        some = np.bincount(x, minlength=table.num_rows)[x[best]] > partners
        x, y = node[x[best]], node[y[best]]
        return pa.record_batch([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(block[:1].repeat(len(x))), pa.array(some)], names=["a", "b", "block", "more"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*held, batch])
            keys = [table[c].to_numpy() for c in ("block", "one", "two")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            at = [0, *cut.tolist()]
            for a, b in zip(at[:-1], at[1:], strict=True):
                yield join(table.slice(a, b - a))
            held = table.slice(at[-1]).combine_chunks().to_batches()
        if held:
            yield join(pa.Table.from_batches(held))

    return run


def _cells(rows: DataFrame) -> DataFrame:
    """Deals large blocks out as pairs of cells; `side` tells the two cells of a pair apart.  The cells of a
    block's largest component (`main`, of `n_main` classes) come first and meet the other cells alone."""
    large = F.col("size") > CELL
    inner = large & (F.col("component") == F.col("main"))
    mains = F.when(large, F.ceil(F.col("n_main") / CELL)).otherwise(0).cast("int")
    others = F.when(large, F.ceil((F.col("size") - F.col("n_main")) / CELL)).otherwise(1).cast("int")
    dealt = rows.withColumns({"inner": inner, "mains": mains, "others": others})
    at = lambda cells: F.pmod(F.xxhash64("node"), cells).cast("int")
    dealt = dealt.withColumn("cell", F.when(F.col("inner"), at(F.col("mains"))).otherwise(F.col("mains") + at(F.col("others"))))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.when(F.col("inner"), F.col("mains")).otherwise(0), F.col("mains") + F.col("others") - 1)))
    one, two = F.least("cell", "with"), F.greatest("cell", "with")
    return dealt.withColumn("one", one).withColumn("two", two).withColumn("side", (F.col("cell") > F.col("with")).cast("int"))


def _link_classes(classes: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """Components of the classes (node, n, bands, bitmap), whose texts are those of their first rows."""
    rows = classes.select("node", "n", F.explode("bands").alias("block"))
    blocks = rows.groupBy("block").agg(F.count("*").alias("size"), F.min("node").alias("pivot"), F.min_by("n", "node").alias("pivot_n")).filter("size > 1")
    counted = written(blocks, "blocks")
    members = written(rows.join(counted, "block"), "members")
    discard(counted)
    sized = 100 * F.least("n", "pivot_n") >= PERCENT * F.greatest("n", "pivot_n")
    near = members.filter(F.col("node") != F.col("pivot")).filter(sized).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    wanted = firsts.join(members.select("node").distinct(), "node").select("doc_id", "mark", "node")
    texts = docs.join(wanted.hint("shuffle_hash"), ["doc_id", "mark"]).select("node", "text")
    sets = written(in_arrow(texts, _sets, "node bigint, keys array<bigint>"), "sets")
    tested = written(near, "near")
    links = written(_verified(tested, sets), "verified")
    found, used = components(links), [tested, links]

    scope, partners = members.filter("size > 2"), PARTNERS
    while True:
        labelled = scope.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled = written(labelled.select("block", "node", "n", "size", "pivot", "component"), "labelled")
        parts = labelled.groupBy("block", "component").agg(F.count("*").alias("n_main"))
        open_blocks = parts.groupBy("block").agg(F.max_by("component", F.struct("n_main", "component")).alias("main"), F.max("n_main").alias("n_main"), F.count("*").alias("parts")).filter("parts > 1").drop("parts")
        still = written(open_blocks, "open")
        cells = _cells(labelled.join(still, "block")).select("block", "one", "two", "side", "node", "n", "pivot", "component")
        dealt = cells.join(classes.select("node", "bitmap", "bands"), "node")
        across = written(in_arrow(dealt.repartition("block", "one", "two").sortWithinPartitions("block", "one", "two"), _across(partners), "a bigint, b bigint, block bigint, more boolean"), "across")
        new = written(across.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "new")
        linked = written(_verified(new, sets), "more")
        links, tested, used = links.union(linked), tested.union(new), [*used, new, linked]
        discard(still)
        if linked.take(1):
            before, found = found, components(links)
            discard(before)
        cut_off = across.filter("more").select("block").distinct()
        if not cut_off.take(1):
            break
        scope, partners = written(scope.join(cut_off, "block"), "scope"), partners * MORE
        used.append(scope)
        discard(labelled, across)
    discard(members, sets, labelled, across, *used)
    return found


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells rows of one doc_id apart, and the text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row as doc_id, mark, n and group, and the first row (first_id, first_mark) of every group; rows
    without an id or words have no group.  A row's class is its set, its group the component of the class."""
    docs = _marked(docs)
    sketches = written(in_arrow(docs, _sketch, SKETCH), "sketches")
    named = sketches.filter("doc_id is not null and n > 0")
    sets = named.groupBy("low", "high").agg(F.min(F.struct("doc_id", "mark")).alias("first")).select("low", "high", "first.*")
    # an id that stands for several classes names none of them
    crowded = sets.groupBy("doc_id").agg(F.count("*").alias("times")).filter("times > 1")
    node = F.when(F.col("times").isNull(), F.col("doc_id")).otherwise(F.xxhash64("low", "high", F.lit(1)))
    firsts = written(sets.join(crowded, "doc_id", "left").select("low", "high", "doc_id", "mark", node.alias("node"), F.col("times").isNotNull().alias("shared")), "firsts")
    bodies = named.join(firsts.select("low", "high", "doc_id", "mark", "node"), ["low", "high", "doc_id", "mark"])
    classes = written(bodies.select("node", "n", "bands", "bitmap").dropDuplicates(["node"]), "classes")
    keys = written(sketches.select("doc_id", "mark", "n", "low", "high"), "keys")
    discard(sketches)
    found = _link_classes(classes, firsts, docs)
    discard(classes)
    known = written(firsts.join(found, "node", "left").withColumn("group", F.coalesce("component", "node")), "known")
    discard(found)
    alone = known.filter(F.col("node") == F.col("group")).select("group", F.col("doc_id").alias("first_id"), F.col("mark").alias("first_mark"))
    if known.filter("shared").take(1):  # a node's name may be a hash, and the least node not the least id
        alone = known.groupBy("group").agg(F.min(F.struct("doc_id", "mark")).alias("f")).select("group", F.col("f.doc_id").alias("first_id"), F.col("f.mark").alias("first_mark"))
        alone = written(alone, "alone")
        known = known.join(alone.select("group", "first_id"), "group")
    else:
        known = known.withColumn("first_id", F.col("group"))
    rows = keys.join(known.select("low", "high", "group", "first_id"), ["low", "high"], "left")
    usable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return rows.select("doc_id", "mark", "n", *(F.when(usable, F.col(c)).alias(c) for c in ("group", "first_id"))), alone


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows, _ = _grouped(docs)
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("first_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group: that of least id (and, where texts repeat an id, of least hash); of rows
    that repeat both id and text the one whose other columns are least.  Rows without words stay, as do
    those without an id, once for each text.  A row goes by its own text only: another text under the same
    id stays if it links with nothing."""
    rows, firsts = _grouped(docs)
    aside = rows.filter(F.col("group").isNull()).select("doc_id", "mark").distinct()
    stay = written(firsts.select(F.col("first_id").alias("doc_id"), F.col("first_mark").alias("mark")).union(aside).toDF("stay_id", "stay_mark"), "stay")
    keyed = docs.select(docs["doc_id"].cast("bigint").alias("id"), F.xxhash64(docs["text"]).alias("mark"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    left = keyed.join(stay.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("mark") == F.col("stay_mark")), "left_semi")
    again = written(left.groupBy("id", "mark").agg(F.count("*").alias("times")).filter("times > 1").toDF("again_id", "again_mark", "times"), "again")
    marked = left.join(again, F.col("id").eqNullSafe(F.col("again_id")) & (F.col("mark") == F.col("again_mark")), "left")
    single = marked.filter("times is null").select("row")
    first = marked.filter("times is not null").groupBy("again_id", "again_mark").agg(F.min("row").alias("row")).select("row")
    return single.unionByName(first).select("row.*")


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Every document against every other one."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
