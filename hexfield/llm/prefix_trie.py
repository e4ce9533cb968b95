"""A trie of conversation prefixes, by collapsing whole sequences.

Conversations are rebuilt as `rebuilt` says, and identical ones become one weighted sequence with the list
of the conversations that end there.  Sequences that are proper prefixes of others drop out by an anti-join;
what is left are the leaves.  Weighted prefixes of the sequences are then aggregated by node.

A prefix is known by its length and a fingerprint of 124 bits: polynomials of its turns' hashes over a prime
field under four bases.  Fingerprints add up, so they follow from the rows' running sums by shifts and
differences: no sequence is ever held whole, and a conversation of a third of all rows is numbered by ranges
of its turns.  Each leaf owns the nodes that it is the least leaf of, which are the last ones of its path; so
what a subtree's distinct texts weigh is a sum over its leaves too, without a walk over the tree.

Defined results: rows without a conv_id take no part; turns come in order of turn (null first), then role,
then text, and repeated rows are turns of their own; null role or text is empty; an empty table has no root;
extra columns are ignored.  A conv_id below zero has the remainders of SQL's `%`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import discard, in_arrow, written
from .text import BASES, PRIME, powers

#: One base for each 31 bits of a fingerprint.
FOUR = (*BASES, 0x3C6EF372, 0x1B873593)
#: A shared conversation gives its first turns, fewer than this many, to the `FAMILY` conversations after it.
MOST_SHARED = 9
FAMILY = 5
#: Ids of one conversation list that are joined to a piece of text at once.
PIECE = 512

TURNS = "edge boolean, pid int, conv_id bigint, j bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, total bigint, own bigint"
HALF = np.uint64(31)


def _pack(parts: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array((parts[i] << HALF | parts[i + 1]).view(np.int64)) for i in (0, 2)]


def _numbered(batches):
    """Turns with their number, fingerprint, that of the turn before and bytes, counted from the start of the
    conversation's rows in this partition; `edge` rows repeat the end of its first and last conversation."""
    pid = TaskContext.get().partitionId()
    now, count, carry, total, runs = None, 0, [0] * 4, 0, 0
    prime = np.uint64(PRIME)

    def row(edge: bool):
        ints = [pid, now, count, carry[0] << 31 | carry[1], carry[2] << 31 | carry[3], 0, 0, total, 0]
        return pa.record_batch([pa.array([edge]), pa.array([pid], pa.int32()), *(pa.array([x], pa.int64()) for x in ints[1:])], names=names)

    names = [f.split()[0] for f in TURNS.split(", ")]
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        conv, own = batch.column("conv_id").to_numpy(), batch.column("own").to_numpy()
        start = np.flatnonzero(np.diff(conv) != 0) + 1
        start = np.concatenate([[0], start])
        length = np.diff(np.append(start, n))
        if now is not None and conv[0] != now:
            if runs == 1:
                yield row(True)
            count, carry, total = 0, [0] * 4, 0
        if now is None or conv[0] != now:
            runs += 1
        local = np.arange(n) - np.repeat(start, length)
        head = slice(0, int(length[0]))
        after, before = [], []
        for k, (column, shift) in enumerate((("e1", 0), ("e1", 33), ("e2", 0), ("e2", 33))):
            e = batch.column(column).to_numpy().view(np.uint64) >> np.uint64(shift) & prime
            term = e * powers(FOUR[k], n + 2)[0][local + 1] % prime
            sums = np.concatenate([[np.uint64(0)], np.cumsum(term)])
            zero = np.repeat(sums[start], length)
            a, b = (sums[1:] - zero) % prime, (sums[:-1] - zero) % prime
            step = np.uint64(pow(FOUR[k], count, PRIME))
            a[head] = (np.uint64(carry[k]) + step * a[head]) % prime
            b[head] = (np.uint64(carry[k]) + step * b[head]) % prime
            after.append(a)
            before.append(b)
        j = local + 1
        j[head] += count
        cum = np.concatenate([[0], np.cumsum(own)])
        cum = cum[1:] - np.repeat(cum[start], length)
        cum[head] += total
        if runs == 1 and len(start) > 1:  # the first conversation ends inside this batch
            end = int(length[0]) - 1
            last = [int(after[k][end]) for k in range(4)]
            keep = now, count, carry, total
            now, count, carry, total = int(conv[0]), int(j[end]), last, int(cum[end])
            yield row(True)
            now, count, carry, total = keep
        runs += len(start) - 1
        yield pa.record_batch([pa.array(np.zeros(n, bool)), pa.array(np.full(n, pid, np.int32)), batch.column("conv_id"), pa.array(j), *_pack(after), *_pack(before), pa.array(cum), batch.column("own")], names=names)
        now, count, carry, total = int(conv[-1]), int(j[-1]), [int(a[-1]) for a in after], int(cum[-1])
    if now is not None:
        yield row(True)


def _parts(one: Column, two: Column) -> list[Column]:
    """The four residues of a fingerprint."""
    return [F.shiftrightunsigned(one, 31), one.bitwiseAND(PRIME), F.shiftrightunsigned(two, 31), two.bitwiseAND(PRIME)]


def _joined(parts: list[Column]) -> tuple[Column, Column]:
    return F.shiftleft(parts[0], 31).bitwiseOR(parts[1]), F.shiftleft(parts[2], 31).bitwiseOR(parts[3])


def _continued(turns: DataFrame) -> DataFrame:
    """Turns counted from their conversation's start.  Only the totals at the ends of partitions, two rows of
    each at most, pass through the driver."""
    ends = sorted(turns.filter("edge").select("pid", "conv_id", "j", "p1", "p2", "total").distinct().collect())
    rows, state = [], None  # state: conversation, turns, residues and bytes so far
    for e in ends:
        own = [e.p1 >> 31, e.p1 & PRIME, e.p2 >> 31, e.p2 & PRIME]
        if state and state[0] == e.conv_id:
            _, j, parts, total = state
            step = [pow(b, j, PRIME) for b in FOUR]
            rows.append((e.pid, e.conv_id, j, *parts, *step, total))
            own = [(p + s * x) % PRIME for p, s, x in zip(parts, step, own, strict=True)]
            state = e.conv_id, j + e.j, own, total + e.total
        else:
            state = e.conv_id, e.j, own, e.total
    plain = turns.filter("not edge").drop("edge")
    if not rows:
        return plain.drop("pid")
    names = ["at", *(f"b{k}" for k in range(4)), *(f"s{k}" for k in range(4)), "so_far"]
    # a row for each partition at most
    offsets = F.broadcast(turns.sparkSession.createDataFrame(rows, f"pid int, conv_id bigint, {', '.join(f'{n} bigint' for n in names)}"))
    both = plain.join(offsets, ["pid", "conv_id"], "left")
    moved = lambda a, b: _joined([(F.col(f"b{k}") + F.col(f"s{k}") * x) % PRIME for k, x in enumerate(_parts(F.col(a), F.col(b)))])
    later = F.col("at").isNotNull()
    (p1, p2), (q1, q2) = moved("p1", "p2"), moved("q1", "q2")
    new = {"p1": p1, "p2": p2, "q1": q1, "q2": q2, "j": F.col("j") + F.col("at"), "total": F.col("total") + F.col("so_far")}
    return both.withColumns({c: F.when(later, x).otherwise(F.col(c)) for c, x in new.items()}).drop("pid", *names)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """All turns with running sums, and of every conversation how it is rebuilt: the first h turns of the
    first conversation of its family, then its own turns after its first h; h comes from a hash of its id.
    With them the tables that may go once both have been used."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    placed = named.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    hashed = placed.select("conv_id", F.xxhash64("role", "text").alias("e1"), F.xxhash64(F.lit(1), "role", "text").alias("e2"), F.octet_length("text").cast("long").alias("own"))
    numbered = written(in_arrow(hashed, _numbered, TURNS), "turns")
    turns = _continued(numbered)
    place = lambda *c: F.struct(*(F.col(x) for x in c))
    heads = F.array_sort(F.collect_list(F.when(F.col("j") < MOST_SHARED, place("j", "p1", "p2", "total"))))
    convs = written(turns.groupBy("conv_id").agg(F.max("j").alias("n"), F.max(place("j", "p1", "p2", "total")).alias("last"), heads.alias("heads")), "convs")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    own = convs.withColumns({"h": shared.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    first = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    info = own.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    none = F.struct(F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), F.lit(0).cast("long").alias("total"))
    at = lambda array, i: F.when(F.col(i) > 0, F.element_at(array, F.greatest(F.col(i), F.lit(1)))).otherwise(none)
    info = info.withColumns({"join": at("base_heads", "m"), "cut": F.when(F.col("n") > F.col("h"), at("heads", "h")), "more": F.col("n") > F.col("h")})
    k1, k2 = _shifted(F.col("last.p1"), F.col("last.p2"))
    info = info.select(
        "conv_id", "h", "m", "join", "cut", "base_heads", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        F.when(F.col("more"), k1).otherwise(F.col("join.p1")).alias("k1"), F.when(F.col("more"), k2).otherwise(F.col("join.p2")).alias("k2"),
        (F.col("join.total") + F.when(F.col("more"), F.col("last.total") - F.col("cut.total")).otherwise(0)).alias("whole"),
    )
    return turns, info, [numbered, convs]


def _shifted(one: Column, two: Column) -> tuple[Column, Column]:
    """The fingerprint of a rebuilt prefix, from that of the own turns up to the same place."""
    out = []
    for k, (x, cut, join) in enumerate(zip(_parts(one, two), _parts(F.col("cut.p1"), F.col("cut.p2")), _parts(F.col("join.p1"), F.col("join.p2")), strict=True)):
        inverse = pow(FOUR[k], -1, PRIME)
        back = F.element_at(F.array(*(F.lit(pow(inverse, s, PRIME)).cast("long") for s in range(MOST_SHARED))), (F.col("h") - F.col("m") + 1).cast("int"))
        out.append((join + back * ((x - cut + PRIME) % PRIME)) % PRIME)
    return _joined(out)


def _digests(batches):
    """SHA-256 of each node's pieces of text, which come in order, joined by commas."""
    now, state = None, None

    def done():
        return pa.record_batch([*(pa.array([x], pa.int64()) for x in now), pa.array([state.hexdigest()])], names=["depth", "k1", "k2", "ends_sha256"])

    for batch in batches:
        out = []
        for *key, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "ids")), strict=True):
            if key != now:
                if now is not None:
                    out.append(done())
                now, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield from out
    if now is not None:
        yield done()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each
    distinct prefix of the rebuilt conversations (conv_id, turn, role, text)."""
    turns, info, used = rebuilt(conversations)
    info = written(info, "info")
    sequences = info.groupBy("length", "k1", "k2").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = sequences.withColumnsRenamed({"length": "l", "k1": "l1", "k2": "l2"})
    chosen = written(info.join(sequences.select("conv_id", "weight"), "conv_id"), "sequences")

    # prefixes of each distinct sequence: the root, the shared turns, its own turns
    own = ["conv_id", "weight", "length", "whole", "k1", "k2"]
    zero = F.lit(0).cast("long")
    shared = F.transform(F.sequence(F.lit(0), F.col("m")), lambda d: F.when(d > 0, F.element_at("base_heads", F.greatest(d, F.lit(1)))).otherwise(F.struct(zero.alias("j"), zero.alias("p1"), zero.alias("p2"), zero.alias("total"))))
    pairs = F.transform(shared, lambda x, i: F.struct(i.cast("long").alias("depth"), x["p1"].alias("p1"), x["p2"].alias("p2"), F.element_at(shared, F.greatest(i, F.lit(1)))["p1"].alias("q1"), F.element_at(shared, F.greatest(i, F.lit(1)))["p2"].alias("q2"), F.element_at(shared, F.greatest(i, F.lit(1)))["total"].alias("before")))
    first = chosen.select(*own, F.explode(pairs).alias("p")).select(*own, "p.*")
    held = chosen.select(*own, "h", "m", "cut", "join").join(turns, "conv_id").filter("j > h")
    (p1, p2), (q1, q2) = _shifted(F.col("p1"), F.col("p2")), _shifted(F.col("q1"), F.col("q2"))
    rest = held.select(*own, (F.col("j") - F.col("h") + F.col("m")).alias("depth"), p1.alias("p1"), p2.alias("p2"), q1.alias("q1"), q2.alias("q2"), (F.col("join.total") + F.col("total") - F.col("cut.total") - F.col("own")).alias("before"))
    prefixes = written(first.unionByName(rest), "prefixes")

    node = ["depth", "p1", "p2"]
    inner = prefixes.filter("depth < length").select(*node).distinct()
    ends = chosen.select("conv_id", F.col("length").alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    leaves = ends.join(inner, node, "left_anti").select("conv_id")
    owners = prefixes.join(leaves, "conv_id").groupBy(*node).agg(F.min("conv_id").alias("leaf"), F.min("before").alias("before"))
    owned = written(owners.groupBy("leaf").agg(F.min("depth").alias("from"), F.min("before").alias("from_before")), "owned")
    marked = prefixes.join(owned, F.col("conv_id") == F.col("leaf"), "left")
    leaf = F.col("leaf").isNotNull()
    gross = F.sum(F.col("weight") * (F.col("whole") - F.col("before")))
    net = F.sum(F.when(leaf, F.col("whole") - F.greatest("before", "from_before")).otherwise(0))
    children = F.sum((leaf & (F.col("depth") < F.col("length")) & (F.col("depth") + 1 >= F.col("from"))).cast("long"))
    nodes = written(marked.groupBy(*node).agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), children.alias("n_children"), F.count("leaf").alias("n_leaves"), (gross - net).alias("saved_tokens"), F.min("q1").alias("q1"), F.min("q2").alias("q2")), "nodes")

    root = nodes.filter("depth = 0").select("conv_id").first()
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.filter("depth > 1").join(above.filter("depth > 1"), ["depth", "q1", "q2"])
    high = nodes.filter("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id if root else None).cast("long")))
    linked = deep.unionByName(high)

    pieces = info.groupBy(F.col("length").alias("depth"), "k1", "k2", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    lists = in_arrow(pieces.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "piece"), _digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
    found = linked.join(lists.withColumnsRenamed({"k1": "p1", "k2": "p2"}), node, "left")
    out = written(found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")), "trie")
    discard(info, chosen, prefixes, owned, nodes, *used)
    return out


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP12_SQL = """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS turn FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS base, CAST(conv_id AS VARCHAR) AS word FROM t),
bits AS (SELECT *, list_prepend(4294967295, flatten(list_transform(range(1, length(word) + 1), lambda i: [CAST(ascii(substr(word, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))) AS b FROM ids),
h AS (SELECT c, base, xor(4294967295, list_reduce(b, lambda a, x: (xor(a, x) >> 1) + CASE WHEN (xor(a, x) & 1) = 0 THEN 0 ELSE 3988292384 - 2 * ((xor(a, x) >> 1) & 3988292384) END)) % 9 AS h FROM bits),
r AS (SELECT c, 0 AS own, j, turn FROM h JOIN t ON t.conv_id = h.base AND j <= h UNION ALL SELECT c, 1, j, turn FROM h JOIN t ON t.conv_id = h.c AND j > h),
s AS (SELECT h.c, coalesce(list(turn ORDER BY own, j) FILTER (turn IS NOT NULL), []) AS seq FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
p AS (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS depth FROM s),
n AS (SELECT depth, seq[1:depth] AS node, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(seq) = depth), '')) AS ends_sha256, max(len(seq)) = depth AS leaf,
  CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(seq[depth].text)) END AS saved FROM p GROUP BY depth, seq[1:depth]),
up AS (SELECT node, leaf, saved, depth, unnest(range(0, depth + 1)) AS d FROM n),
a AS (SELECT d, node[1:d] AS node, sum(CAST(leaf AS INTEGER)) AS n_leaves, sum(saved) AS saved_tokens, sum(CAST(depth = d + 1 AS INTEGER)) AS n_children FROM up GROUP BY d, node[1:d])
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, CAST(a.n_children AS BIGINT) AS n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN a ON a.d = n.depth AND a.node = n.node LEFT JOIN n m ON m.depth = n.depth - 1 AND m.node = n.node[1:n.depth - 1] AND n.depth > 0"""
