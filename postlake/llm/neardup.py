"""Exact n-gram Jaccard join with signature trees.

Texts with equal shingle sets are one node.  A set's hashes are cut by value into more
parts than two linked sets can differ in, so linked sets have an equal non-empty part:
nodes that share a part meet at the least of them, their pivot (a row per meeting, never all pairs).
Linked sets have more equal parts than just one, so each set leaves out as many of its most
frequent parts as it can spare: the rarest equal part is then still there in both, and a
passage that very many documents hold makes few of them meet.
Meetings are verified on whole sets; nodes that are not linked to a pivot they met are
compared with the others that met it, but for those with too many tokens that none of the others
has, by signature trees: leaves of some dozen nodes carry
the OR of their token bitmaps and their range of sizes, and a dual traversal goes down only
into pairs of tree nodes whose greatest possible overlap can still link.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from postlake.llm.common import forget, fresh, map_batches, numbered, ranked, shipped, stored, text_strings, tracked
from postlake.llm.components import components
from postlake.llm.shingles import mixed, shingle_sets

LEAF = 64  # nodes of a tree leaf
FAN = 8  # children of an inner tree node
BITS = 2048  # of a token bitmap
KINDS = 8  # of nodes by their share of lone tokens, from none to the largest that can link
NODES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()),
                      T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType())])
PARTS = T.StructType([T.StructField("node", T.LongType()), T.StructField("copies", T.LongType()),
                      T.StructField("spare", T.IntegerType()), T.StructField("parts", T.ArrayType(T.LongType()))])
SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType())),
                     T.StructField("size", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def chunks(texts: list[bytes], size: int = 1 << 20):
    """Index ranges of texts of about ``size`` bytes together."""
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= size):
            total += len(texts[end])
            end += 1
        yield at, end
        at = end


def set_key(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in text_strings(texts)]


def bounds(percent: int, largest: int) -> list[int]:
    """Starts of size classes; sets that can link are in the same or neighbouring classes."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def parts_of(tokens: np.ndarray, starts: np.ndarray, percent: int) -> list[list[tuple[int, np.ndarray]]]:
    """For each set, ``(spare, hashes of its parts)`` for its own size class and the next.

    In class ``c`` (sizes up to U) linked sets differ in at most
    D = floor(2 U (100 - percent) / (100 + percent)) tokens.  With P > D parts, at least P - D
    are equal; if a set has that many empty parts, it also meets the others that have.
    Of its E empty parts at most E are equal ones, so a set can leave out any
    P - D - 1 - E others (``spare``) that come last in an order common to all sets and still
    has the first equal part.  The lowest bit of a hash is that of its class.
    """
    sizes = np.diff(starts)
    limits = bounds(percent, int(sizes.max(initial=0)))
    level = np.searchsorted(limits, sizes, side="right") - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    high = tokens >> np.uint64(32)
    scrambled = mixed(tokens)
    out: list[list[tuple[int, np.ndarray]]] = [[] for _ in sizes]
    extended = limits + [limits[-1] * 100 // percent + 1, 0]
    extended[-1] = extended[-2] * 100 // percent + 1
    for step in (0, 1):
        tag = level + step
        upper = np.array(extended)[tag + 1] - 1
        differ = 2 * upper * (100 - percent) // (100 + percent)
        number = np.where(differ == 0, 1, differ + differ // 5 + 2).astype(np.uint64)
        part = (high * number[owner]) >> np.uint64(32)
        if not len(part):
            continue
        new = np.ones(len(part), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        sums = np.add.reduceat(scrambled, at)
        held = np.diff(np.append(at, len(part))).astype(np.uint64)
        whose = owner[at]
        made = mixed(sums + mixed(part[at] * np.uint64(0x100000001B3) + held) + tag[whose].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        filled = np.bincount(whose, minlength=len(sizes))
        edges = np.concatenate([[0], np.cumsum(filled)])
        for i in np.flatnonzero(sizes):
            own, equal, empty = made[edges[i]:edges[i + 1]], int(number[i]) - int(differ[i]), int(number[i]) - int(filled[i])
            if empty >= equal:
                own = np.append(own, mixed(np.array([tag[i]], dtype=np.uint64) + np.uint64(1 << 40)))
            own = own & ~np.uint64(1) | np.uint64(tag[i] & 1)
            out[i].append((max(0, equal - 1 - empty), own.astype(np.int64)))
    return out


def nodes_of(docs: DataFrame, width: int) -> DataFrame:
    def work(keys, rows, texts):
        counts, nodes = [], []
        texts = encoded(texts)
        for lo, hi in chunks(texts):
            tokens, starts = shingle_sets(texts[lo:hi], width)
            for i in range(hi - lo):
                own = tokens[starts[i]:starts[i + 1]]
                counts.append(len(own))
                nodes.append(set_key(own) if len(own) else None)
        return {"doc_id": keys, "row": rows, "n_shingles": counts, "node": nodes}

    return map_batches(docs.select("doc_id", "row", "text"), work, NODES)


def part_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``node, copies, spare, part``; equal texts of a batch are one row with their number."""
    def work(texts):
        nodes, copies, spares, parts = [], [], [], []
        number = Counter(encoded(texts))
        texts = list(number)
        for lo, hi in chunks(texts):
            tokens, starts = shingle_sets(texts[lo:hi], width)
            made = parts_of(tokens, starts, percent)
            for i in range(hi - lo):
                own = tokens[starts[i]:starts[i + 1]]
                for spare, hashes in made[i]:
                    nodes.append(set_key(own))
                    copies.append(number[texts[lo + i]])
                    spares.append(spare)
                    parts.append(hashes)
        return {"node": nodes, "copies": copies, "spare": spares, "parts": parts}

    return map_batches(docs.select("text"), work, PARTS).select("node", "copies", "spare", F.explode("parts").alias("part"))


def meetings(parts: DataFrame) -> DataFrame:
    """``a, b, times``: the pivot ``a`` of the parts that node ``b`` does not leave out, and of how many.

    A part's pivot is the least node that has it.  Parts are ordered by rows that have them;
    a node leaves out the ``spare`` most frequent ones of each of its size classes, counting
    only parts that several nodes have.  Copies of a node become one row before nodes are shuffled.
    """
    whole = Window.partitionBy("part").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = Window.partitionBy("node", "class").orderBy(F.desc("held"), "part")
    shared = (parts.withColumn("pivot", F.first("node").over(whole)).withColumn("end", F.last("node").over(whole))
              .withColumn("held", F.sum("copies").over(whole)).where("pivot != end")
              .groupBy("part", "node").agg(*[F.first(c).alias(c) for c in ("spare", "pivot", "held")]))
    return (shared.repartition("node").withColumn("class", F.col("part").bitwiseAND(1))
            .withColumn("place", F.row_number().over(last)).where("place > spare and pivot != node")
            .groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("times")))


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    def work(texts):
        nodes, sets, bits = [], [], []
        texts = encoded(texts)
        for lo, hi in chunks(texts):
            tokens, starts = shingle_sets(texts[lo:hi], width)
            for i in range(hi - lo):
                own = tokens[starts[i]:starts[i + 1]]
                nodes.append(set_key(own) if len(own) else None)
                sets.append(own.astype(np.int64))
                bits.append(np.packbits(bitmap(own)).tobytes())
        return {"node": nodes, "tokens": sets, "size": [len(s) for s in sets], "bits": bits}

    return map_batches(docs.select("text"), work, SETS)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose whole sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    shorter, longer = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    return (pairs.join(left, "a").join(right, "b").where(100 * shorter >= percent * longer)
            .withColumn("both", both)
            .where(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b"))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=bool)
    bits[tokens.astype(np.uint64) % np.uint64(BITS)] = True
    return bits


class Tree:
    """Nodes sorted by size, in leaves; each tree node has an OR bitmap and a range of sizes."""

    def __init__(self, bitmaps: list[np.ndarray], sizes: list[int], group: int = FAN):
        self.order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        self.levels = [[(bitmaps[i], sizes[i], sizes[i]) for i in self.order]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([(np.logical_or.reduce([b[0] for b in below[k:k + group]]),
                                 min(b[1] for b in below[k:k + group]), max(b[2] for b in below[k:k + group]))
                                for k in range(0, len(below), group)])
        self.group = group


def may_link(p, q, percent: int) -> bool:
    """Whether a set under ``p`` and one under ``q`` can overlap enough.

    A token of one side whose bit the other side lacks is not shared, so a set of n tokens
    shares at most n minus the bits that every set of its side must have beyond the other's.
    For a single set these are its own bits; for an inner node only the sizes count, besides
    bits in common at all.
    """
    if 100 * min(p[2], q[2]) < percent * max(p[1], q[1]):
        return False
    common = int(np.count_nonzero(p[0] & q[0]))
    if not common:
        return False
    most = min(p[2], q[2])
    if p[1] == p[2]:
        most = min(most, p[2] - (int(np.count_nonzero(p[0])) - common) if p[3] else most)
    if q[1] == q[2]:
        most = min(most, q[2] - (int(np.count_nonzero(q[0])) - common) if q[3] else most)
    return most * (100 + percent) >= percent * (p[1] + q[1])


def dual(left: Tree, right: Tree, percent: int):
    """Pairs of positions the traversal can't rule out; the last level is compared in blocks."""
    todo = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while todo:
        i, a, j, b = todo.pop()
        p, q = left.levels[i][a], right.levels[j][b]
        if not may_link((*p, i == 0), (*q, j == 0), percent):
            continue
        if i <= 1 and j <= 1:
            xs = range(a * left.group, min((a + 1) * left.group, len(left.order))) if i else (a,)
            ys = range(b * right.group, min((b + 1) * right.group, len(right.order))) if j else (b,)
            bits = [np.stack([t.levels[0][k][0] for k in ks]).astype(np.float32) for t, ks in ((left, xs), (right, ys))]
            m = np.array([left.levels[0][k][1] for k in xs])[:, None]
            n = np.array([right.levels[0][k][1] for k in ys])[None]
            common = bits[0] @ bits[1].T
            most = np.minimum(m - (bits[0].sum(1)[:, None] - common), n - (bits[1].sum(1)[None] - common))
            for x, y in np.argwhere(most * (100 + percent) >= percent * (m + n)):
                yield left.order[xs[x]], right.order[ys[y]]
        elif i >= j:
            todo += [(i - 1, c, j, b) for c in range(a * left.group, min((a + 1) * left.group, len(left.levels[i - 1])))]
        else:
            todo += [(i, a, j - 1, c) for c in range(b * right.group, min((b + 1) * right.group, len(right.levels[j - 1])))]


def lone_tokens(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, size, bits, lone`` of the nodes of stars: how many of its tokens no other of these nodes has."""
    own = sets.join(stars.select("node").distinct(), "node")
    tokens = own.select("node", F.explode("tokens").alias("token"))
    lone = (tokens.groupBy("token").agg(F.count("*").alias("n"), F.first("node").alias("node")).where("n = 1")
            .groupBy("node").agg(F.count("*").alias("lone")))
    return own.select("node", "size", "bits").join(lone, "node", "left").withColumn("lone", F.coalesce("lone", F.lit(0)))


def lone_may_link(percent: int, shared, lone):
    """Whether sets that share ``shared`` tokens at most and have ``lone`` ones together can link."""
    return (100 - percent) * shared >= percent * lone


def tree_pairs(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that may link among nodes that met the same pivot but lie in different components.

    ``stars`` has ``pivot, node, component``.  The nodes of a pivot are dealt, by size
    class, to leaves of LEAF nodes; a component that fills leaves has its own, the others
    share.  Pairs of leaves that can link, but for two of one component, meet in a task of
    their own, at most LEAF against LEAF nodes, and are traversed there.
    Only bitmaps and sizes travel; the pairs that are left are verified on whole sets.

    A token that no other node of ``stars`` has is in no intersection and in every union of its
    node: nodes with too many of them link with nothing here and are left out, and of large
    stars the rest is dealt by its share of them, so that leaves with too many together do not meet.
    """
    shipped(stars.sparkSession)
    level = F.floor(F.log("size") / F.log(F.lit(100 / percent))).cast("long")
    kind = F.least(F.lit(KINDS - 1), F.floor(KINDS * 100 * F.col("lone") / ((100 - percent) * F.col("size")))).cast("int")
    known = lone_tokens(stars, sets).where(lone_may_link(percent, F.col("size") - F.col("lone"), F.col("lone")))
    sized = stars.join(known, "node").withColumn("level", level)
    crowded = (sized.groupBy("pivot", "level").agg(F.count("*").alias("n")).where(F.col("n") >= 2 * LEAF)
               .select("pivot", "level", F.lit(True).alias("crowded")))
    sized = sized.join(crowded, ["pivot", "level"], "left").withColumn("kind", F.when(F.col("crowded"), kind))
    large = (sized.groupBy("pivot", "level", "component").agg(F.count("*").alias("n")).where(F.col("n") >= LEAF)
             .select("pivot", "level", "component", F.col("component").alias("pure")))
    grouped = sized.join(large, ["pivot", "level", "component"], "left")
    leaves = stored(ranked(grouped, F.struct("pivot", "level", "pure", "kind"), ["node"], "place")
                    .withColumn("leaf", F.xxhash64("level", "pure", "kind", (F.col("place") / LEAF).cast("long"))), "leaves")
    heads = leaves.groupBy("pivot", "leaf").agg(F.first("pure").alias("pure"), F.min("size").alias("least"), F.max("size").alias("most"),
                                                F.min("lone").alias("lone"), F.max(F.col("size") - F.col("lone")).alias("shared"))
    other = heads.select("pivot", *[F.col(c).alias(f"{c}_2") for c in ("leaf", "pure", "least", "most", "lone", "shared")])
    pairs = stored(heads.join(other, "pivot").where(
        (F.col("leaf") <= F.col("leaf_2")) & (100 * F.col("most") >= percent * F.col("least_2"))
        & (100 * F.col("most_2") >= percent * F.col("least"))
        & lone_may_link(percent, F.least("shared", "shared_2"), F.col("lone") + F.col("lone_2"))
        & F.coalesce(F.col("pure") != F.col("pure_2"), F.lit(True))).select("pivot", "leaf", "leaf_2"), "pairs")
    a = pairs.join(leaves.select("pivot", "leaf", "node", "component", "size", "bits"), ["pivot", "leaf"])
    b = pairs.join(leaves.select("pivot", F.col("leaf").alias("leaf_2"), "node", "component", "size", "bits"), ["pivot", "leaf_2"])

    def match(met):
        x, y = met[met["side"] == 0], met[met["side"] == 1]
        out = []
        if len(x) and len(y):
            trees = [Tree([np.unpackbits(np.frombuffer(v, dtype=np.uint8)).astype(bool) for v in side["bits"]],
                          side["size"].tolist()) for side in (x, y)]
            of_x, of_y = x["component"].to_numpy(), y["component"].to_numpy()
            nodes_x, nodes_y = x["node"].to_numpy(), y["node"].to_numpy()
            for i, j in dual(*trees, percent):
                if of_x[i] != of_y[j]:
                    out.append((min(nodes_x[i], nodes_y[j]), max(nodes_x[i], nodes_y[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    sides = a.withColumn("side", F.lit(0)).unionByName(b.withColumn("side", F.lit(1)))
    return sides.groupBy("pivot", "leaf", "leaf_2").applyInPandas(match, "a long, b long").distinct()


def labelled(met: DataFrame, joined: DataFrame) -> DataFrame:
    """Meetings with the components ``of_a, of_b`` of both nodes."""
    def name(side):
        return joined.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))

    return (met.select("a", "b").join(name("a"), "a", "left").join(name("b"), "b", "left")
            .withColumn("of_a", F.coalesce("of_a", "a")).withColumn("of_b", F.coalesce("of_b", "b")))


def open_stars(met: DataFrame, joined: DataFrame) -> DataFrame:
    """``pivot, node, component`` of pivots that met nodes of several components, not all in their own."""
    marked = stored(labelled(met, joined), "marked")
    unsettled = marked.where("of_a != of_b").select("a").distinct()
    stars = marked.join(unsettled, "a", "left_semi").select(F.col("a").alias("pivot"), F.col("b").alias("node"), F.col("of_b").alias("component"))
    several = stars.groupBy("pivot").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least != most")
    return stars.join(several.select("pivot"), "pivot", "left_semi")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id",
                    row: str | None = None) -> DataFrame:
    """``found_components`` without the internal ``component``."""
    return found_components(docs, width, percent, text, key, row).drop("component")


def found_components(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id",
                     row: str | None = None) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, component``: exact components of texts that link.

    Two texts link when 100 |A & B| >= percent |A | B| for their shingle sets.  A component
    has the least ``doc_id`` in it.  Null and empty texts, and texts without words, have no
    shingle and link with nothing; a null key stays null and never names a component with others;
    repeated rows link with each other; an empty table gives no rows; other columns are ignored.
    ``row`` tells repeated rows apart: a unique number of the caller's, or the place in its
    file (anything but a plain Parquet table is written first).
    """
    if row is None:
        docs, row = numbered(docs.select(key, text)), "_row"
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[row].alias("row"), docs[text].cast("string").alias("text"))
    nodes = stored(nodes_of(rows, width), "nodes")
    met = stored(meetings(part_rows(rows, width, percent)), "met")
    wanted = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
    # one text of each node that met another
    chosen = nodes.join(wanted, "node").groupBy("node").agg(F.min("row").alias("row"))
    sets = stored(sets_of(rows.join(chosen.select("row"), "row", "left_semi"), width), "sets")
    # first the pivot each node met most often, then what is left between components
    likely = met.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a"))
    links = stored(verified(likely.select("a", "b"), sets, percent), "links")
    rest = labelled(met, components(links)).where("of_a != of_b").select("a", "b").join(likely.select("a", "b"), ["a", "b"], "left_anti")
    links = stored(links.union(verified(rest, sets, percent)), "links")
    joined = components(links)
    maybe = stored(tree_pairs(open_stars(met, joined), sets, percent), "maybe")
    found = stored(verified(maybe, sets, percent), "found")
    if found.head(1):
        joined = components(stored(links.union(found), "links"))
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component", "left").select("row", "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "component")


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, before: DataFrame | None = None) -> DataFrame:
    """One document of each component, and one of those without any shingle.

    The one with the least ``doc_id`` stays (null keys after all others; equal keys: the
    first row); columns as before, whatever their names.  ``before`` has ``doc_id`` and ``text`` as
    the texts were before an earlier step cut them: documents whose texts linked then are also one
    component, so what a cut leaves of a near copy does not stay.  Ids that are null or occur
    more than once in either table have only their present text.
    """
    name = fresh(docs, "_row")
    rows = numbered(docs, name)
    with tracked() as made:
        found = found_components(rows, width, percent, row=name)
    if before is not None:
        found = stored(found, "present")
        forget(docs.sparkSession, made)  # the second comparison needs the room
        joined = joined_before(found, before, width, percent)
        found = found.join(joined, "component", "left").withColumn("component", F.coalesce("label", "component"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    first = (found.groupBy("component")  # null: no shingle
             .agg(F.min(place).alias("first")).select(F.col("first.row").alias(name)))
    return rows.join(first, name, "left_semi").select(*docs.columns)


def joined_before(found: DataFrame, before: DataFrame, width: int, percent: int) -> DataFrame:
    """``component, label``: components of ``found`` that are one by the texts of ``before``."""
    def once(df: DataFrame) -> DataFrame:
        return df.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n = 1").select("doc_id")

    before = before.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    earlier = before.join(once(before), "doc_id", "left_semi").join(once(found), "doc_id", "left_semi")
    with tracked() as made:
        then = found_components(earlier, width, percent).select("doc_id", F.col("component").alias("then"))
    met = stored(found.where("component is not null").select("doc_id", "component").join(then.where("then is not null"), "doc_id")
                 .select("then", "component").distinct(), "then")
    forget(found.sparkSession, made)
    heads = met.groupBy("then").agg(F.min("component").alias("a"), F.count("*").alias("n")).where("n > 1")
    links = met.join(heads, "then").select("a", F.col("component").alias("b"))
    return components(links).select(F.col("node").alias("component"), F.col("component").alias("label"))
