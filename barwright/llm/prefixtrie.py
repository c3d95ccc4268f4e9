"""Prefix trie of conversations: a z-fast trie whose nodes are rows of a table.

A conversation is the sequence of its turns' hashes; its prefix of d turns has a hash of its own, the XOR of
its turns' hashes by place, so that equal prefixes have equal hashes and any prefix of a conversation is at
hand. The trie is compacted: only prefixes at which conversations end or part are nodes, and a node keeps the
hashes along its edge. A node is found by its handle, its prefix at the two-fattest depth of its edge, the
one divisible by the largest power of two.

Conversations with equal turns fold into one sequence, and sequences are inserted in batches. A batch finds
every sequence's exit node by fat binary search: probes of the handle table at two-fattest depths, which are
as many as the longest sequence's length has binary digits. The edge below tells how far the sequence
follows the trie. Edges that are left, or ended at, within are split there; what lies beyond becomes edges of
its own, parted where the batch's sequences part. A prefix new in the batch is carried by its smallest
conversation, so each conversation carries one unbroken chain, which is cut at the nodes.

Sums over subtrees are gathered over the compacted nodes by pointer doubling, and only then edges are
expanded to one row per prefix.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import by_value, discard, stage

by_value(__name__)

GROUP, HASHES = 5, 9
#: The sequences that each batch inserts, in 64ths: the first ones learn the prefixes that most share.
BATCHES = (4, 16, 44)
#: Up to so many nodes (some 60 bytes and their edge each) are broadcast for a look-up; more meet in a shuffle.
BROADCAST_NODES = 100_000
#: In a shuffle, the nodes that most sequences pass are copied, so that no task gets all rows that ask for one.
COPIED_NODES, COPIES = 1000, 64
_EMPTY = hashlib.sha256(b"").hexdigest()


def rebuilt(rows: DataFrame) -> tuple[DataFrame, str]:
    """The rebuilt conversations as arrays by depth (from 0): hashes xs and ys of the prefixes, bytes cs.

    Staged, with conv_id and x, y, the hashes of all turns; a row per conv_id, turnless ones included.
    """
    spark = rows.sparkSession

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    turns = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        text("role").alias("role"), text("text").alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.select(
        "conv_id", F.row_number().over(order).alias("rank"), F.xxhash64("role", "text").alias("sx"),
        F.xxhash64(F.lit("turn"), "role", "text").alias("sy"), F.octet_length("text").cast("bigint").alias("size"),
    )
    turns, turns_path = stage(turns, "turns")
    taken = F.crc32(F.col("conv_id").cast("string")) % HASHES
    ids = turns.filter("rank = 1").select("conv_id", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    firsts = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("rank") < HASHES)).withColumnRenamed("conv_id", "base")
    shared = firsts.join(ids, "base").filter("rank <= taken").select("conv_id", "rank", "sx", "sy", "size")
    none = F.lit(0).cast("bigint")
    placed = shared.union(turns.filter(F.col("rank") > taken)).union(ids.select("conv_id", F.lit(0), none, none, none))

    line = W.partitionBy("conv_id").orderBy("rank")
    so_far = line.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = placed.withColumn("d", F.row_number().over(line) - 1)

    def prefix(c):
        return F.bit_xor(F.when(F.col("d") > 0, F.xxhash64(c, "d")).otherwise(0)).over(so_far)

    prefixes = placed.select("conv_id", F.struct("d", prefix("sx").alias("x"), prefix("sy").alias("y"), F.sum("size").over(so_far).alias("c")).alias("p"))
    arrays = prefixes.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    convs = arrays.select(
        "conv_id", F.element_at("p", -1)["x"].alias("x"), F.element_at("p", -1)["y"].alias("y"), (F.size("p") - 1).alias("len"),
        F.col("p.x").alias("xs"), F.col("p.y").alias("ys"), F.col("p.c").alias("cs"),
    )
    convs, path = stage(convs, "conversations")
    discard(spark, turns_path)
    return convs, path


def two_fattest(a: str, b: str) -> Column:
    """The number in (a, b] that is divisible by the largest power of two."""
    return F.expr(f"int({b} & shiftleft(-1L, length(bin({a} ^ {b})) - 1))")


def _look_up(rows: DataFrame, known: DataFrame, n_known: int, spread: str) -> DataFrame:
    """``rows`` with the columns of ``known`` for their key (kx, ky), null where it isn't known.

    ``known`` has unique keys, and n, how often they are met. Too large to be broadcast, it is shuffled;
    the most frequent keys are copied, and rows that ask for one of them are dealt among its copies by ``spread``.
    """
    keys = ["kx", "ky"]
    if n_known <= BROADCAST_NODES:
        return rows.join(F.broadcast(known.drop("n")), keys, "left")
    often = known.orderBy(F.desc("n"), *keys).limit(COPIED_NODES).select(*keys, F.lit(COPIES).alias("copies"))
    often = F.broadcast(often)
    copied = known.drop("n").join(often, keys, "left")
    copied = copied.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    asking = rows.join(often, keys, "left").withColumn("copy", F.coalesce(F.pmod(F.xxhash64(spread), F.col("copies")).cast("int"), F.lit(0)))
    # rows that ask for nothing don't meet in one task either
    asking = asking.withColumn("kx", F.coalesce("kx", F.xxhash64(spread))).drop("copies")
    return asking.join(copied, [*keys, "copy"], "left").drop("copy")


def exits(sequences: DataFrame, nodes: DataFrame | None, n_nodes: int, longest: int) -> DataFrame:
    """Sequences with their exit edge (parent depth te's node t_x, t_y; null if none) and ``follows``, how
    many turns of theirs lie on the trie: a fat binary search over handles, then a look at the edge below.
    """
    state = sequences.withColumns({"a": F.lit(0), "b": F.col("len")})
    if nodes is None:
        none = F.lit(None)
        return state.withColumns({"follows": F.lit(0), "t_x": none.cast("bigint"), "t_y": none.cast("bigint"), "t_e": none.cast("int")}).drop("a", "b")
    x, y = F.element_at("xs", -1), F.element_at("ys", -1)
    at = (two_fattest("pe", "e") - F.col("pe") - 1).alias("at")
    handles = nodes.select(
        F.get("xs", at).alias("kx"), F.get("ys", at).alias("ky"), "n", F.col("pe").alias("t_pe"), F.col("e").alias("t_e"), x.alias("t_x"), y.alias("t_y")
    )
    for _ in range(longest.bit_length()):
        probe = F.when(F.col("a") < F.col("b"), two_fattest("a", "b"))
        state = state.withColumn("f", probe).withColumns({"kx": F.get("xs", "f"), "ky": F.get("ys", "f")})
        state = _look_up(state, handles, n_nodes, "conv_id")
        met = F.col("t_e").isNotNull()
        whole = (F.col("t_e") <= F.col("len")) & (F.get("xs", "t_e") == F.col("t_x")) & (F.get("ys", "t_e") == F.col("t_y"))
        a = F.when(met & whole, F.col("t_e")).when(met, F.col("t_pe")).otherwise(F.col("a"))
        b = F.when(met & whole, F.col("b")).when(met, F.col("t_pe")).otherwise(F.coalesce(F.col("f") - 1, "b"))
        state = state.withColumns({"a": a, "b": b}).drop("f", "kx", "ky", "t_pe", "t_e", "t_x", "t_y")
    below = nodes.select(
        F.get("xs", F.lit(0)).alias("kx"), F.get("ys", F.lit(0)).alias("ky"), "n", F.col("e").alias("t_e"), x.alias("t_x"), y.alias("t_y"),
        F.col("xs").alias("t_xs"), F.col("ys").alias("t_ys"),
    )
    state = state.withColumns({"kx": F.get("xs", F.col("a") + 1), "ky": F.get("ys", F.col("a") + 1)})
    state = _look_up(state, below, n_nodes, "conv_id")
    reach = F.sequence(F.lit(1), F.least(F.size("t_xs"), F.col("len") - F.col("a")))
    agreeing = F.filter(reach, lambda i: (F.get("t_xs", i - 1) == F.get("xs", F.col("a") + i)) & (F.get("t_ys", i - 1) == F.get("ys", F.col("a") + i)))
    follows = F.col("a") + F.when(F.col("t_e").isNotNull(), F.size(agreeing)).otherwise(0)
    return state.withColumn("follows", follows).drop("a", "b", "kx", "ky", "t_xs", "t_ys")


def _split(nodes: DataFrame, located: DataFrame) -> DataFrame:
    """The nodes, edges cut where sequences leave them or end within them."""
    cuts = located.filter("follows < t_e").groupBy("t_x", "t_y").agg(F.collect_set("follows").alias("cuts"))
    own = nodes.withColumns({"t_x": F.element_at("xs", -1), "t_y": F.element_at("ys", -1)})
    cut = own.join(cuts, ["t_x", "t_y"], "left").withColumn(
        "ends", F.array_sort(F.concat(F.coalesce("cuts", F.array().cast("array<int>")), F.array("e")))
    )
    cut = cut.select("*", F.posexplode("ends").alias("i", "to"))
    cut = cut.withColumn("since", F.when(F.col("i") == 0, F.col("pe")).otherwise(F.get("ends", F.col("i") - 1)))
    start = F.col("since") - F.col("pe")

    def part(c):
        return F.slice(c, start + 1, F.col("to") - F.col("since")).alias(c)

    def before(arrays, c):
        return F.when(start == 0, F.col(c)).otherwise(F.get(arrays, start - 1)).alias(c)

    return cut.select(
        F.col("since").alias("pe"), F.col("to").alias("e"), before("xs", "px"), before("ys", "py"), before("cs", "pc"), "n",
        part("xs"), part("ys"), part("cs"),
    )


def _grown(located: DataFrame) -> DataFrame:
    """Nodes of what lies beyond the exits: each prefix once, carried by its smallest conversation."""

    def at(i):
        return [F.get(c, i) for c in ("xs", "ys", "cs")]

    steps = F.transform(
        F.sequence(F.col("follows") + 1, F.col("len")),
        lambda d: F.struct(d.alias("d"), *[c.alias(n) for c, n in zip([*at(d), *at(d - 1), *at(d + 1)[:2]], ("x", "y", "c", "px", "py", "pc", "nx", "ny"))]),
    )
    beyond = located.filter("follows < len").select("conv_id", F.explode(steps).alias("s")).select("conv_id", "s.*")
    same = [F.min(c).alias(c) for c in ("d", "c", "px", "py", "pc")]
    parts = [f(c).alias(f"{n}_{c}") for c in ("nx", "ny") for n, f in (("min", F.min), ("max", F.max))]
    prefixes = beyond.groupBy("x", "y").agg(
        F.min("conv_id").alias("carrier"), F.count("*").alias("n"), F.count_if(F.col("nx").isNull()).alias("ends"), *same, *parts
    )
    is_node = (F.col("ends") > 0) | (F.col("min_nx") != F.col("max_nx")) | (F.col("min_ny") != F.col("max_ny"))
    ahead = W.partitionBy("carrier").orderBy("d").rowsBetween(W.currentRow, W.unboundedFollowing)
    chained = prefixes.withColumn("e", F.min(F.when(is_node, F.col("d"))).over(ahead))
    edges = chained.groupBy("carrier", "e").agg(
        F.array_sort(F.collect_list(F.struct("d", "x", "y", "c", "px", "py", "pc"))).alias("p"), F.max("n").alias("n")
    )
    top = F.get("p", F.lit(0))
    return edges.select(
        (top["d"] - 1).alias("pe"), "e", top["px"].alias("px"), top["py"].alias("py"), top["pc"].alias("pc"), "n",
        F.col("p.x").alias("xs"), F.col("p.y").alias("ys"), F.col("p.c").alias("cs"),
    )


def trie(sequences: DataFrame, longest: int, batches=BATCHES) -> tuple[DataFrame, str, int]:
    """The compacted nodes of all sequences (conv_id, len, xs, ys, cs), staged; the root is not among them.

    A node has its parent's depth pe, hashes px, py and bytes pc, its own depth e, the prefixes of its edge
    (xs, ys, cs at the depths pe + 1 to e), and n, the sequences of its batch that passed it.
    """
    spark = sequences.sparkSession
    place = F.pmod(F.xxhash64("conv_id"), F.lit(sum(batches)))
    nodes, path, n_nodes, start = None, None, 0, 0
    for share in batches:
        batch = sequences.filter((place >= start) & (place < start + share)).select("conv_id", "len", "xs", "ys", "cs")
        located, located_path = stage(exits(batch, nodes, n_nodes, longest), "located")
        grown = _grown(located)
        after, after_path = stage(grown if nodes is None else grown.unionByName(_split(nodes, located)), "nodes")
        discard(spark, located_path, *([path] if path else []))
        nodes, path, n_nodes, start = after, after_path, after.count(), start + share
    return nodes, path, n_nodes


def _digests(convs: DataFrame) -> DataFrame:
    """x, y and ends_sha256 of the conversations that end at a prefix, their ids in order, as a stream."""

    def digest(batches):
        key, hasher, out = None, None, []

        def told():
            rows = [[k[0] for k in out], [k[1] for k in out], [k[2] for k in out]]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())], ["x", "y", "ends_sha256"])

        for batch in batches:
            for x, y, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (x, y) != key:
                    if key:
                        out.append((*key, hasher.hexdigest()))
                    key, hasher = (x, y), hashlib.sha256(str(conv).encode())
                else:
                    hasher.update(b",%d" % conv)
            yield told()
        if key:
            out.append((*key, hasher.hexdigest()))
        yield told()

    rows = convs.select("x", "y", "conv_id").repartition("x", "y").sortWithinPartitions("x", "y", "conv_id")
    return rows.mapInArrow(digest, "x bigint, y bigint, ends_sha256 string")


def _summed(nodes: DataFrame, classes: DataFrame, n_nodes: int) -> tuple[DataFrame, str]:
    """Per node what its subtree holds: n conversations, their smallest one, leaves, bytes of all (total) and of
    distinct turns (below). Each round hands a node's sums to an ancestor twice as far as the last one.
    """
    spark = nodes.sparkSession
    kids = nodes.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("kids"))
    own = nodes.select(F.element_at("xs", -1).alias("x"), F.element_at("ys", -1).alias("y"), "px", "py", "pe", "pc", F.element_at("cs", -1).alias("c"))
    own = own.join(kids, ["x", "y"], "left").join(classes, ["x", "y"], "left")
    ends = F.coalesce("ends", F.lit(0))
    far = F.col("pe") > 0  # sums of the root are not handed on
    state = own.select(
        "x", "y", "px", "py", "pe", F.coalesce("kids", F.lit(0)).alias("kids"), ends.alias("n"), "first",
        F.when(F.col("kids").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"), (ends * F.col("c")).alias("total"), (F.col("c") - F.col("pc")).alias("below"),
        F.when(far, F.col("px")).alias("kx"), F.when(far, F.col("py")).alias("ky"),
    )
    state, path = stage(state, "sums")
    added = ["n", "leaves", "total", "below"]
    while not state.filter("ky is not null").isEmpty():
        handed = state.filter("ky is not null").groupBy(F.col("kx").alias("x"), F.col("ky").alias("y")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in added], F.min("first").alias("more_first")
        )
        onward = state.select(F.col("x").alias("kx"), F.col("y").alias("ky"), "n", F.col("kx").alias("next_x"), F.col("ky").alias("next_y"))
        after = _look_up(state.join(handed, ["x", "y"], "left"), onward, n_nodes, "x").select(
            "x", "y", "px", "py", "pe", "kids", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in added],
            F.least("first", "more_first").alias("first"), F.when(F.col("next_y").isNotNull(), F.col("next_x")).alias("kx"), F.col("next_y").alias("ky"),
        )
        after, after_path = stage(after, "sums")
        discard(spark, path)
        state, path = after, after_path
    return state, path


def prefix_nodes(conversations: DataFrame, batches=BATCHES) -> DataFrame:
    """Per prefix of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    Reads conv_id, turn, role and text. Turns go by turn, null first, equal ones by role and text; null roles and
    texts are empty, repeated rows are turns of their own. Rows without conv_id are left out. Groups of conv_ids
    are those of truncated division. Texts of any length count by their hash; a conversation's hashes, 24 bytes
    a turn, are one row. An empty table has no prefixes, not even the root.
    """
    spark = conversations.sparkSession
    convs, _ = rebuilt(conversations)
    told = convs.agg(F.max("len"), F.min("conv_id"), F.count("*")).first()
    longest, first, n_convs = told[0] or 0, told[1], told[2]
    classes = convs.groupBy("x", "y").agg(F.min("conv_id").alias("first"), F.count("*").alias("ends"))
    classes, classes_path = stage(classes, "classes")
    sequences = convs.join(classes.select(F.col("first").alias("conv_id")), "conv_id", "left_semi")
    nodes, _, n_nodes = trie(sequences, longest, batches)
    sums, _ = _summed(nodes, classes, n_nodes)
    discard(spark, classes_path)
    digests, _ = stage(_digests(convs), "digests")

    parents = sums.select(F.col("x").alias("kx"), F.col("y").alias("ky"), "n", F.col("first").alias("parent_first"))
    asking = sums.join(digests, ["x", "y"], "left").withColumns({"kx": F.when(F.col("pe") > 0, F.col("px")), "ky": F.when(F.col("pe") > 0, F.col("py"))})
    joined = _look_up(asking, parents, n_nodes, "x").drop("kx", "ky", "px", "py", "pe")
    edges = nodes.select(F.element_at("xs", -1).alias("x"), F.element_at("ys", -1).alias("y"), "pe", "e", "pc", "cs").join(joined, ["x", "y"])
    rows = edges.select("*", F.posexplode("cs").alias("i", "c"))
    depth = F.col("pe") + 1 + F.col("i")
    above = F.when(F.col("i") == 0, F.col("pc")).otherwise(F.get("cs", F.col("i") - 1))
    last = depth == F.col("e")
    expanded = rows.select(
        F.col("first").alias("conv_id"), depth.cast("bigint").alias("depth"),
        F.when(F.col("i") > 0, F.col("first")).otherwise(F.coalesce("parent_first", F.lit(first).cast("bigint"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("kids")).otherwise(1).cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("total") - F.col("n") * above - F.col("below") + above - F.col("pc")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(_EMPTY))).otherwise(_EMPTY).alias("ends_sha256"),
    )
    if not n_convs:
        return expanded
    zero = F.lit(0).cast("bigint")
    ended = digests.filter("x = 0 and y = 0").agg(F.max("ends_sha256")).scalar()
    root = sums.filter("pe = 0").agg(
        F.lit(first).cast("bigint").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(n_convs).cast("bigint").alias("n_convs"), F.count("*").alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum(F.col("total") - F.col("below")), zero).alias("saved_tokens"), F.coalesce(ended, F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return expanded.union(root)
