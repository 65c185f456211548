"""N-gram Jaccard join by set-relation skipping.

A document is the set of its distinct 5-word shingles (64-bit hashes of the
lower-cased words); two documents link at a Jaccard similarity of 0.8 or more.

1. *Classes.*  Documents with equal sets form a class, known by a number from then on.
2. *Index lists.*  All shingles have one fixed order, rare ones first, by a
   hashed frequency table of fixed size and then by hash.  A set enters the list
   of each shingle of its prefix (n - ceil(0.8 n) + 1 shingles): linked sets
   share one of them, whatever the order.  Shingles in one list only are dropped.
3. *Answers of similar sets.*  Each list has a leader, the most central of its
   sets; each set is compared with the leader it shares most lists with.  A set
   that links follows its leader, at a known distance.
4. *Block skipping.*  What is left are pairs of pivots (leaders and sets that
   follow none).  Lists are cut into blocks by size, and blocks too far apart in
   size never meet; a pair must also have enough elements left behind the
   positions of its common shingle.  Two pivots without followers are compared
   only if the shingles that they share in their prefixes leave room for a link.
5. *Incremental answers.*  The answers of followers are derived from their
   pivots': what x and y share is bounded by what they and their pivots A and B
   share and by what they have in common beyond A and B, a join of the short
   differences alone (``_member_pairs``).  Only pairs whose bound is enough are
   compared, and only where their pivots are not in one component already.

No group is expanded into pairs: followers of one leader meet through it.  All
joins are on hashes or ids with both sides shuffled, so that Spark can split a
hot one; counts pre-aggregate.  The driver sees the frequency table only, whose
size is a parameter.  Exactness rests on 64-bit hashes: a collision would need
two of a pair's shingles to share one (about 1e-13 for sets of a thousand).

Defined results: a null or empty text has an empty set and links with nothing;
with fewer than five words the whole sequence is the one shingle; rows that
share a doc_id are one document, linked if any of them is; a null doc_id has a
null component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Spans, bytes_of, long_of, release, slices, window_starts, word_hashes, written
from strata.llm.components import components

WIDTH = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
TABLE_BITS = 17
CHUNK_BYTES = 1 << 20


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) and the text that each belongs to."""
    words, starts = word_hashes(texts, lower=True)
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    spans, counts = Spans(words), np.diff(starts)
    at = window_starts(starts, width)
    short = np.flatnonzero((counts > 0) & (counts < width))
    begin = np.concatenate([at, starts[short]])
    end = np.concatenate([at + width, starts[short + 1]])
    owner = np.concatenate([np.repeat(np.arange(len(texts)), np.maximum(counts - width + 1, 0)), short])
    return spans.hash(begin, end), owner


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingles([text], width)[0])


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """A class for each slot of a hashed frequency table over all shingles: 0 for rare, more for more frequent."""
    size = 1 << TABLE_BITS

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in slices(batch, [0], CHUNK_BYTES):
                found, _ = shingles(bytes_of(part.column(0)))
                counts += np.bincount((found >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=size)
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(counts[slots], pa.int64())],
                                         ["slot", "n"])

    rows = (docs.select("text").mapInArrow(run, "slot int, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())  # one row for each slot: a parameter
    counts = np.zeros(size)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    usual = counts.mean()
    over = counts - usual - 3 * np.sqrt(usual)
    return np.where(over <= 1, 0, 1 + np.log2(np.maximum(over, 1))).astype(np.uint8)


def _sets(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """doc_id, mark (hash of the text), n, two 64-bit sums that identify the set, and the prefix in order."""
    table = docs.sparkSession.sparkContext.broadcast(classes)  # 2**TABLE_BITS bytes

    def run(batches):
        for batch in batches:
            for part in slices(batch, [2], CHUNK_BYTES):
                texts = bytes_of(part.column(2))
                found, owner = shingles(texts)
                rank = table.value[(found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
                order = np.lexsort((found, rank, owner))
                found, owner = found[order], owner[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                found, owner = found[new], owner[new]
                n = np.bincount(owner, minlength=len(texts))
                ends = np.cumsum(n)
                begins = ends - n
                key1, key2 = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    with np.errstate(over="ignore"):
                        key1[full] = np.add.reduceat(found, begins[full])
                        other = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                        key2[full] = np.add.reduceat(other ^ (other >> np.uint64(32)), begins[full])
                taken = np.where(n > 0, n - (PERCENT * n + 99) // 100 + 1, 0)
                offset = np.arange(len(found)) - np.repeat(begins, n)
                head = found[offset < np.repeat(taken, n)]
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(taken)]), pa.int32()), pa.array(long_of(head)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(long_of(key1)),
                     pa.array(long_of(key2)), prefix], ["doc_id", "mark", "n", "key1", "key2", "prefix"])

    return _marked(docs).select("doc_id", "mark", "text").mapInArrow(
        run, "doc_id long, mark long, n long, key1 long, key2 long, prefix array<long>")


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, mark, text: id and mark tell a row's text, whole repeated rows share both."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")


KEYS = ["n", "key1", "key2"]


def _classes(sets: DataFrame) -> DataFrame:
    """One row for each distinct set: its number ``doc``, its smallest document and that one's text mark, prefix."""
    same = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*KEYS).agg(
        F.min(F.struct("doc_id", "mark")).alias("least"), F.first("prefix").alias("prefix"))
    return written(same.select(F.monotonically_increasing_id().alias("doc"), *KEYS, F.col("least.doc_id").alias("rep"),
                               F.col("least.mark").alias("mark"), "prefix"), "join-classes")


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, common, total (size of the union), na, nb of every pair of classes, and what one has beyond the other.

    ``rest_a`` and ``rest_b`` are given up to the distance at which followers of
    two pivots can still link.
    """
    a = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, [2, 3], CHUNK_BYTES):
                rows = []
                for x, y in zip(bytes_of(part.column(2)), bytes_of(part.column(3))):
                    left, right = shingle_set(x), shingle_set(y)
                    both = np.intersect1d(left, right, assume_unique=True)
                    total = len(left) + len(right) - len(both)
                    rest = total - len(both) <= (3 * _FAR + _EPS) * total
                    rows.append((len(both), total, len(left), len(right),
                                 long_of(np.setdiff1d(left, both, assume_unique=True)) if rest else None,
                                 long_of(np.setdiff1d(right, both, assume_unique=True)) if rest else None))
                columns = [pa.array(c, pa.int64() if i < 4 else pa.list_(pa.int64())) for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *columns],
                    ["a", "b", "common", "total", "na", "nb", "rest_a", "rest_b"])

    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, common long, total long, na long, nb long, rest_a array<long>, rest_b array<long>")


_LINKED = f"100 * common >= {PERCENT} * total"
_FAR = (100 - PERCENT) / 100
#: Slack of floating point in the bounds; it only ever lets more pairs through.
_EPS = 1e-9


def _distance():
    return 1 - F.col("common") / F.greatest(F.col("total"), F.lit(1))


def _pivot_pairs(lists: DataFrame, follow: DataFrame) -> DataFrame:
    """a < b: pivots that share a list, within the bounds of size, position and prefix."""
    own = lists.join(follow.select(F.col("a").alias("doc"), F.col("b").alias("leader")), "doc", "left")
    own = own.withColumns({
        "pivot": F.coalesce("leader", "doc"), "alone": F.col("leader").isNull().cast("int"),
        "block": F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + _EPS)})
    led = follow.select(F.col("b").alias("pivot")).distinct().withColumn("led", F.lit(1))
    entry = (own.groupBy("tok", "pivot", "block")
             .agg(F.min("n").alias("n"), F.max(F.col("n") - F.col("pos")).alias("left"),
                  F.min(F.col("n") - F.col("taken")).alias("behind"), F.min("alone").alias("alone"))
             .join(written(led, "join-led"), "pivot", "left")
             .withColumn("alone", F.col("alone") * (1 - F.coalesce("led", F.lit(0)))).drop("led"))
    # A list counts only if two pivots meet in it.
    entry = written(entry, "join-entry")
    meet = entry.groupBy("tok").agg(F.min("pivot").alias("x"), F.max("pivot").alias("y")).filter("x <> y").select("tok")
    entry = entry.join(written(meet, "join-meet"), "tok").withColumn("meet", F.explode(F.array(F.col("block"), F.col("block") + 1)))
    a, b = entry.alias("a"), entry.alias("b")
    need = F.ceil(PERCENT * (F.col("a.n") + F.col("b.n")) / (100 + PERCENT) - _EPS)
    found = a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.meet") == F.col("b.meet"))
                   & (F.col("a.pivot") < F.col("b.pivot"))
                   & (F.col("a.meet") == F.greatest("a.block", "b.block")))
    found = found.groupBy(F.col("a.pivot").alias("a"), F.col("b.pivot").alias("b")).agg(
        F.count("*").alias("shared"), F.min(F.col("a.alone") * F.col("b.alone")).alias("alone"),
        F.max(F.greatest("a.behind", "b.behind")).alias("behind"), F.min(need).alias("need"),
        F.max((F.col("a.left") >= need) & (F.col("b.left") >= need)).alias("room"))
    # Sets whose prefixes share `shared` shingles have at most behind + shared in common.
    return found.filter(F.col("room")).filter((F.col("alone") == 0) | (F.col("behind") + F.col("shared") >= F.col("need"))).select("a", "b")


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component yet."""
    for side in ("a", "b"):
        pairs = pairs.join(joined.select(F.col("node").alias(side), F.col("component").alias(f"in_{side}")), side, "left")
    return pairs.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).drop("in_a", "in_b")


def _merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    edges = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return written(components(edges.unionByName(links.select("a", "b"))), "join-components")


def _enough(common: Column, sizes: Column) -> Column:
    """Whether this many common shingles can link two sets with this sum of sizes."""
    return (100 + PERCENT) * common >= PERCENT * sizes


def _member_pairs(follow: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs of members behind unlinked pivots whose overlap, derived from the pivots', may be enough.

    x follows pivot A and y follows B.  What x and y share is at most what both
    share with A, and what x has beyond A:

        |x & y| <= min(|x & A|, min(|A & B|, |B & y|) + gy) + gx + h

    where gx counts what x and B both have beyond A, gy what y and A both have
    beyond B, and h what x has beyond A and y beyond B.  These gains are joins of
    the differences alone, which for near copies are short and mostly unique.
    """
    rest = follow.select(F.col("b").alias("a"), F.col("a").alias("x"), F.explode("rest_a").alias("tok"))
    both = near.select("a", "b", "common", F.col("rest_b").alias("rest")).unionByName(
        near.select(F.col("b").alias("a"), F.col("a").alias("b"), "common", F.col("rest_a").alias("rest")))
    gain = rest.join(both.select("a", "b", F.explode("rest").alias("tok")), ["a", "tok"])
    gain = written(gain.groupBy("a", "b", "x").agg(F.count("*").alias("g")), "join-gain")
    most = gain.groupBy(F.col("a").alias("b"), F.col("b").alias("a")).agg(F.max("g").alias("gain"))
    least = follow.groupBy(F.col("b")).agg(F.min("na").alias("least"))
    both = both.drop("rest").join(written(most, "join-most"), ["a", "b"], "left").join(
        written(least, "join-small"), "b")
    both = written(both.select("a", "b", "common", F.coalesce("gain", F.lit(0)).alias("gain"),
                               "least"), "join-both")
    member = follow.select(F.col("b").alias("a"), F.col("a").alias("x"), F.col("common").alias("cx"),
                           F.col("na").alias("nx"))
    top = F.least("cx", F.col("common") + F.col("gain"))
    plain = member.join(both, "a").filter(_enough(top, F.col("nx") + F.col("least"))).withColumn("g", F.lit(0).cast("long"))
    gained = gain.join(member, ["a", "x"]).join(both, ["a", "b"]).filter(
        _enough(top + F.col("g"), F.col("nx") + F.col("least")))
    names = ["a", "b", "x", "cx", "nx", "common"]
    x = plain.select(*names, "g").unionByName(gained.select(*names, "g")).groupBy(*names).agg(F.max("g").alias("gx"))
    x = written(x, "join-viable")
    y = x.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("x").alias("y"), F.col("cx").alias("cy"),
                 F.col("nx").alias("ny"), F.col("gx").alias("gy"))
    bound = F.least(F.least("cx", F.least("common", "cy") + F.col("gy")) + F.col("gx"),
                    F.least("cy", F.least("common", "cx") + F.col("gx")) + F.col("gy"))
    pairs = x.join(y, ["a", "b"]).filter("a < b").filter(
        _enough(bound, F.col("nx") + F.col("ny"))).select("x", "y")
    # Followers of different pivots with the same addition.
    rest = written(rest.join(near.select(F.explode(F.array("a", "b")).alias("a")).distinct(), "a"), "join-rest")
    rest2 = rest.select(F.col("a").alias("b"), F.col("x").alias("y"), "tok")
    same = rest.join(rest2, "tok").filter("a < b").select("a", "b", "x", "y").distinct()
    same = same.join(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"])
    pairs = pairs.unionByName(same.select("x", "y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _pivot_members(follow: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs of a follower x of pivot A and another pivot B that may link, from their differences from A.

    x and B differ from A in the sets Dx and DB, and share

        |x & B| = |A & B| - |A - x| + |Dx & DB|

    so a link asks for a least overlap of the differences, known for each pair.
    This is an overlap join of short sets: elements that only one side has are
    dropped, and a pair must meet in the rarest of what is left (all but as many
    elements as the least overlap that any partner asks for, less one).
    """
    both = near.select("a", "b", "common", "nb", F.concat("rest_a", "rest_b").alias("rest")).unionByName(
        near.select(F.col("b").alias("a"), F.col("a").alias("b"), "common", F.col("na").alias("nb"),
                    F.concat("rest_a", "rest_b").alias("rest")))
    # Ninths: a link needs 9 * |x & B| >= 4 * (|x| + |B|) at 80 percent; the general weights are these.
    link, size = 100 + PERCENT, PERCENT
    own = follow.select(F.col("b").alias("a"), F.col("a").alias("x"), F.concat("rest_a", "rest_b").alias("rest"),
                        (size * F.col("na") + link * (F.col("nb") - F.col("common"))).alias("ask"))
    both = both.withColumn("ask", size * F.col("nb") - link * F.col("common"))
    # What any partner asks for at least, on either side of each pivot.
    lowest = written(own.groupBy("a").agg(F.min("ask").alias("ask_x")).join(
        both.groupBy("a").agg(F.min("ask").alias("ask_b")), "a"), "join-lowest")

    def left(rows: DataFrame, other: DataFrame, name: str, theirs: str) -> DataFrame:
        """Elements that the other side has too, with the number of them and the least overlap asked for."""
        shared = written(other.select("a", F.explode("rest").alias("tok")).distinct(), "join-shared")
        kept = rows.select("a", name, "ask", F.explode("rest").alias("tok")).join(shared, ["a", "tok"])
        kept = written(kept, "join-kept-" + name)
        many = kept.groupBy("a", name).agg(F.count("*").alias("size")).join(lowest, "a")
        return kept.join(written(many.select("a", name, "size", theirs), "join-many"), ["a", name]).withColumn(
            "least", F.ceil((F.col("ask") + F.col(theirs)) / link)).filter("size >= least")

    x, b = left(own, both, "x", "ask_b"), left(both, own, "b", "ask_x")
    x, b = written(x, "join-left-x"), written(b, "join-left-b")
    often = x.groupBy("a", "tok").agg(F.count("*").alias("dx")).join(
        b.groupBy("a", "tok").agg(F.count("*").alias("db")), ["a", "tok"])
    often = written(often.select("a", "tok", (F.col("dx") * F.col("db")).alias("often")), "join-often-rest")

    def prefix(rows: DataFrame, name: str) -> DataFrame:
        order = Window.partitionBy("a", name).orderBy("often", "tok")
        # The rank runs over one member's difference, a part of one document.
        ranked = rows.join(often, ["a", "tok"], "left").fillna(0, ["often"]).withColumn("rank", F.row_number().over(order))
        return ranked.filter("rank <= size - greatest(least, 1) + 1 AND often > 0").select(
            "a", name, "tok", F.col("ask").alias(f"ask_{name}"), F.col("size").alias(f"size_{name}"))

    met = prefix(x, "x").join(prefix(b, "b"), ["a", "tok"])
    met = met.filter(link * F.least("size_x", "size_b") >= F.col("ask_x") + F.col("ask_b")).select("x", "b")
    # Pairs so uneven in size that no overlap is asked for.
    free = own.select("a", "x", F.col("ask").alias("ask_x")).join(
        written(both.select("a", "b", F.col("ask").alias("ask_b")), "join-asks"), "a").filter("ask_x + ask_b <= 0")
    return met.unionByName(free.select("x", "b")).distinct().select(F.col("x").alias("a"), "b")


def _through_pivots(follow: DataFrame, pivots: DataFrame, joined: DataFrame, texts: DataFrame) -> DataFrame:
    """Components after the links of followers, found from the answers of their pivots."""
    reach = written(follow.groupBy(F.col("b").alias("p")).agg(F.max(_distance()).alias("reach")), "join-reach")
    near = _apart(pivots.filter(f"NOT ({_LINKED})"), joined)
    for side in ("a", "b"):
        near = near.join(reach.select(F.col("p").alias(side), F.col("reach").alias(f"reach_{side}")), side, "left")
    # By the triangle inequality members at x and y of their pivots link only if x + y >= d - 0.2.
    near = near.filter(F.coalesce("reach_a", F.lit(0.0)) + F.coalesce("reach_b", F.lit(0.0))
                       >= _distance() - _FAR - _EPS)
    near = written(near.select("a", "b", "common", "na", "nb", "rest_a", "rest_b", "reach_a", "reach_b"), "join-near")
    met = written(_apart(_pivot_members(follow, near), joined), "join-met")
    if not met.isEmpty():
        joined = _merged(joined, _compared(met, texts).filter(_LINKED))
    near = written(_apart(near.filter("reach_a IS NOT NULL AND reach_b IS NOT NULL"), joined), "join-near")
    members = written(_apart(_member_pairs(follow, near), joined), "join-members")
    if members.isEmpty():
        return joined
    return _merged(joined, _compared(members, texts).filter(_LINKED))


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """component (a class number) of every class, by number, that links with another."""
    spark = docs.sparkSession
    entries = classes.select("doc", "n", F.posexplode("prefix").alias("pos", "tok"))
    often = entries.groupBy("tok").agg(F.count("*").alias("k")).filter("k > 1")
    # Aggregates are written before they are joined back on their key: a join of two plain shuffles
    # is one whose hot keys Spark can split.
    often = written(often, "join-often")
    release(spark)
    lists = entries.join(often, "tok").withColumn(
        "taken", F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).select("tok", "doc", "n", "pos", "taken", "k")
    lists = written(lists, "join-lists")
    release(spark)

    centre = written(lists.groupBy("doc").agg((F.sum("k") / F.max("taken")).alias("score")), "join-centre")
    leaders = (lists.select("tok", "doc").join(centre, "doc").groupBy("tok")
               .agg(F.max(F.struct("score", (-F.col("doc")).alias("minus"))).alias("top"))
               .select("tok", (-F.col("top")["minus"]).alias("leader")))
    leaders = written(leaders, "join-leaders")
    shared = (lists.join(leaders, "tok").filter("doc <> leader").groupBy("doc", "leader")
              .agg(F.count("*").alias("shared"), F.max("taken").alias("taken")))
    star = (shared.filter("2 * shared >= taken").groupBy("doc")
            .agg(F.max(F.struct("shared", (-F.col("leader")).alias("minus"))).alias("top"))
            .select(F.col("doc").alias("a"), (-F.col("top")["minus"]).alias("b")))
    star = written(star, "join-star")
    release(spark)

    needed = written(centre.select("doc").join(classes.select("doc", F.col("rep").alias("doc_id"), "mark"), "doc"),
                     "join-needed")
    # Whole repeated rows go before the shuffle of the texts.
    texts = _marked(docs).groupBy("doc_id", "mark").agg(F.first("text").alias("text"))
    texts = written(texts.join(needed, ["doc_id", "mark"]).select("doc", "text"), "join-texts")
    release(spark)

    follow = written(_compared(star, texts).filter(_LINKED), "join-follow")
    known = follow.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pivots = _pivot_pairs(lists, follow).join(known, ["a", "b"], "left_anti")
    pivots = written(_compared(pivots, texts), "join-pivots")
    links = known.unionByName(pivots.filter(_LINKED).select("a", "b"))
    joined = written(components(links), "join-components")
    release(spark)
    return _through_pivots(follow, pivots, joined, texts)


def _joined(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n_shingles, component_id of every row of ``docs``."""
    sets = written(_sets(docs, frequency_classes(docs)), "join-sets")
    classes = _classes(sets)
    release(docs.sparkSession)
    linked = _links(docs, classes)
    # From class numbers to documents: a component is named by the smallest document of its classes.
    named = linked.join(classes.select(F.col("doc").alias("node"), "rep"), "node")
    named = written(named.select("component", "rep"), "join-named")
    least = written(named.groupBy("component").agg(F.min("rep").alias("component_id")), "join-least")
    linked = named.join(least, "component").select("rep", "component_id").distinct()
    # Rows of one doc_id with different sets are one document: its classes are tied together.
    several = (sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min(F.struct(*KEYS)).alias("x"), F.max(F.struct(*KEYS)).alias("y")).filter("x <> y"))
    several = written(several.select("doc_id"), "join-several")
    if not several.isEmpty():
        held = sets.select("doc_id", *KEYS).join(several, "doc_id").join(classes.select(*KEYS, "rep"), KEYS)
        ties = held.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        tied = components(linked.select(F.col("rep").alias("a"), F.col("component_id").alias("b")).unionByName(ties))
        linked = tied.select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    linked = written(linked, "join-linked")
    rows = sets.select("doc_id", "mark", *KEYS).join(classes.select(*KEYS, "rep"), KEYS, "left")
    return rows.join(linked, "rep", "left").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "rep", "doc_id")).alias("component_id"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    return _joined(docs).drop("mark")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one of the smallest id, with its own columns.

    Rows that repeat id and text give one row; rows without an id give one for
    each distinct text, as they link with nothing; so do rows without words.
    """
    names = docs.columns
    kept = written(_joined(docs).filter("doc_id = component_id").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "join-kept")
    # Repeats go before the shuffle, so that no row, however often repeated, fills one task.
    one = (docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("_row"),
                       F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_mark"))
           .groupBy("_id", "_mark").agg(F.first("_row").alias("_row")))
    same = one.join(kept, ["_id", "_mark"], "left_semi").unionByName(one.filter("_id IS NULL"))
    return same.select(*[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(names)])
