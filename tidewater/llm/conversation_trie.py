"""The prefix trie of conversations, with totals of every subtree.

Turns are range-partitioned by conversation and turn, so that a conversation of any
length spreads over as many partitions as it needs; positions and prefix hashes run
inside a partition, and the few conversations that cross a border get what stands
before it added. A prefix is known by its depth and the XOR of hashes of ``(depth,
SHA-256 of role and text)``, 128 bits; that all members of a node have the same last
turn is checked, which by induction makes equal keys equal prefixes.

Subtree totals come from parallel tree contraction: a round rakes all leaves into
their parents, then splices out, of every unary chain, the nodes whose random
priority is above both neighbours'. Each step is one aggregation of messages by
target and one join by node, both keys unique in the tree, so that neither long
chains nor nodes with very many children make a hot key. What a round removes stays
in its written table; going back through the rounds, spliced nodes get the total of
the child that stayed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .shared import scratch, written

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: The four words of a turn's SHA-256.
WORDS = ["g1", "g2", "g3", "g4"]


def _heads(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of equal keys begins, and the run of each row."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``part, conv_id, spot, g1 .. g4, chars``: each turn's number within its
    conversation and partition, the SHA-256 of its role and text, and the code points
    of its text. Turns go by ``turn``, null first, and ties by role and text."""
    if not isinstance(conversations.schema[conv_id].dataType, IntegralType):
        raise TypeError(f"{conv_id} must be an integer")
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).where(F.col("conv_id").isNotNull())
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    sides = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.unhex(F.sha2(sides.cast("binary"), 256)).alias("digest"), F.char_length("text").cast("long").alias("chars"))

    def number(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            heads, run = _heads(own)
            spot = np.arange(len(own)) - heads[run]
            if own[0] == last:
                spot[run == 0] += seen
            last, seen = own[-1], spot[-1] + 1
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), part, np.int64)), batch.column(0), pa.array(spot), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(4)), batch.column(2)],
                ["part", "conv_id", "spot", *WORDS, "chars"])

    return written(sorted_rows.mapInArrow(number, "part long, conv_id long, spot long, g1 long, g2 long, g3 long, g4 long, chars long"), "turns")


def borrowed_turns(conv_id: Column, most: int) -> Column:
    """How many turns a conversation borrows: crc32 of its decimal id modulo ``most``."""
    return F.crc32(conv_id.cast("string").cast("binary")) % F.lit(most)


def with_openings(turns: DataFrame, block: int = 0, most: int = 1) -> tuple[DataFrame, DataFrame]:
    """The turns of :func:`ordered_turns` with their depth (1, 2, ...), after each
    conversation's opening is replaced: the first ``h`` turns of conversation ``c`` by
    those of ``c - c % block`` (all that this one has), with ``h`` from
    :func:`borrowed_turns`. Without a ``block`` conversations stay as they are.
    Returns ``(turns, conversations)``, the latter with its number of ``turns``."""
    in_part = turns.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    in_part = written(in_part.select("part", "conv_id", "n", F.coalesce(F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "turn-counts")
    sizes = in_part.groupBy("conv_id").agg(F.sum("n").alias("n"))
    if block:
        named = sizes.withColumn("h", borrowed_turns(F.col("conv_id"), most)).withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
        of_base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
        shift = F.least("h", F.coalesce("base_n", F.lit(0)))
        convs = named.join(of_base, "base", "left").select("conv_id", "base", "h", shift.alias("p"), (shift + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))
    else:
        convs = sizes.select("conv_id", F.col("conv_id").alias("base"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("p"), F.col("n").alias("turns"))
    convs = written(convs, "conversations")
    # joined by partition too: a conversation with very many turns is in many of them
    where = in_part.join(convs, "conv_id").select("part", "conv_id", "before", "h", "p", "turns")
    placed = turns.join(where, ["part", "conv_id"]).withColumn("pos", F.col("spot") + F.col("before"))
    if block:
        placed = written(placed, "placed-turns")
    own = placed.where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("p") + F.col("pos") - F.col("h") + 1).alias("depth"), *WORDS, "chars", "turns")
    if block:
        first = placed.where((F.col("pos") < most) & (F.col("conv_id") % block == 0)).select(F.col("conv_id").alias("base"), "pos", *WORDS, "chars")
        lent = convs.where(F.col("p") > 0).join(first, "base").where(F.col("pos") < F.col("p"))
        own = own.unionByName(lent.select("conv_id", (F.col("pos") + 1).alias("depth"), *WORDS, "chars", "turns"))
    return own, convs.select("conv_id", "turns")


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every conversation's prefixes, the empty one too, as a written table: ``part,
    conv_id, depth, x1, x2, t1, t2, g1 .. g4, chars, last``. ``x`` are the key's hashes
    and ``t`` those of the last turn alone."""
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(g) for g in WORDS], F.lit(0).cast("long").alias("chars"), "turns")
    rows = turns.unionByName(top)
    hashed = [F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.xxhash64(F.lit(salt), "depth", *WORDS)).alias(name) for salt, name in (("first", "t1"), ("second", "t2"))]
    columns = ["conv_id", "depth", "t1", "t2", *WORDS, "chars", "last"]
    ordered = (
        rows.select("conv_id", "depth", *hashed, *WORDS, "chars", (F.col("depth") == F.col("turns")).alias("last"))
        .repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").select(*columns)
    )

    def run_on(batches):
        part, last, so_far = TaskContext.get().partitionId(), None, [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            heads, run = _heads(own)
            sums = []
            for i, name in enumerate(("t1", "t2")):
                all_before = np.concatenate([[0], np.bitwise_xor.accumulate(batch.column(name).to_numpy())])
                own_sum = all_before[1:] ^ all_before[heads][run]
                if own[0] == last:
                    own_sum[run == 0] ^= so_far[i]
                sums.append(own_sum)
            last, so_far = own[-1], [s[-1] for s in sums]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), part, np.int64)), *(pa.array(s) for s in sums), *batch.columns], ["part", "x1", "x2", *columns])

    kinds = ", ".join(f"{c} {'boolean' if c == 'last' else 'long'}" for c in ["part", "x1", "x2", *columns])
    local = written(ordered.mapInArrow(run_on, kinds), "prefix-runs")
    in_part = local.groupBy("part", "conv_id").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # conversations that go on from an earlier partition: one for each partition at most
    carried = in_part.select("part", "conv_id", F.bit_xor("b1").over(by_part).alias("c1"), F.bit_xor("b2").over(by_part).alias("c2")).where(F.col("c1").isNotNull())
    whole = local.join(F.broadcast(carried), ["part", "conv_id"], "left")
    for x, c in (("x1", "c1"), ("x2", "c2")):
        whole = whole.withColumn(x, F.col(x).bitwiseXOR(F.coalesce(F.col(c), F.lit(0))))
    return written(whole.drop("c1", "c2"), "prefixes")


KEY = ["depth", "x1", "x2"]


def _ends(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending, with commas.
    Each partition, a range of ids, joins its own; these runs are hashed as they stream."""
    runs = (
        prefixes.where("last").groupBy("part", *KEY)
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"), F.min("conv_id").alias("least"))
        .select(*KEY, "least", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )
    streamed = runs.repartition(*KEY).sortWithinPartitions(*KEY, "least").select(*KEY, "ids")

    def digest(batches):
        key, hashed = None, None

        def row():
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([hashed.hexdigest()])], [*KEY, "ends_sha256"])

        for batch in batches:
            for *own, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own == key:
                    hashed.update(b"," + ids.encode())
                else:
                    if key:
                        yield row()
                    key, hashed = own, hashlib.sha256(ids.encode())
        if key:
            yield row()

    return streamed.mapInArrow(digest, "depth long, x1 long, x2 long, ends_sha256 string")


def _sums(messages: DataFrame) -> DataFrame:
    return messages.groupBy("target").agg(
        F.sum("d_kids").alias("d_kids"), F.bit_xor("d_xor").alias("d_xor"), F.max("new_parent").alias("new_parent"),
        F.sum("d_leaves").alias("d_leaves"), F.sum("d_weight").alias("d_weight"))


def _deliver(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """``rows`` with the sums of the messages that each node has got."""
    got = rows.join(_sums(messages), F.col("node") == F.col("target"), "left")
    zero = F.lit(0)
    return got.select(
        "node", F.coalesce("new_parent", "parent").alias("parent"), (F.col("kids") + F.coalesce("d_kids", zero)).alias("kids"),
        F.col("kids_xor").bitwiseXOR(F.coalesce("d_xor", zero)).alias("kids_xor"), (F.col("leaves") + F.coalesce("d_leaves", zero)).alias("leaves"),
        (F.col("weight") + F.coalesce("d_weight", zero)).alias("weight"), "removed")


def subtree_totals(tree: DataFrame) -> DataFrame:
    """``node, leaves, weight``: the number of leaves and the sum of ``weight`` in each
    node's subtree, its top included.

    ``tree`` has ``node`` (a distinct long), ``parent`` (null at a root), ``kids``, the
    number of its children, ``kids_xor``, the XOR of their numbers, and ``weight``."""
    spark = tree.sparkSession
    schema = "node long, parent long, kids long, kids_xor long, leaves long, weight long, removed int"
    raked, spliced = [], []
    active = tree.select("node", "parent", "kids", "kids_xor", (F.col("kids") == 0).cast("long").alias("leaves"), "weight")

    def step(rows: DataFrame, messages: DataFrame, name: str) -> tuple[str, DataFrame]:
        path = scratch(spark, name)
        _deliver(rows, messages).write.parquet(path)
        kept = spark.read.schema(schema).parquet(path)
        return path, kept.where(F.col("removed").isNull()).drop("removed")

    none = F.lit(None).cast("long")
    while True:
        leaf = F.col("kids") == 0
        to_parent = active.where(leaf & F.col("parent").isNotNull()).select(
            F.col("parent").alias("target"), F.lit(-1).alias("d_kids"), F.col("node").alias("d_xor"), none.alias("new_parent"),
            F.col("leaves").alias("d_leaves"), F.col("weight").alias("d_weight"))
        path, active = step(active.withColumn("removed", F.when(leaf, F.lit(1))), to_parent, "raked")
        raked.append(path)
        if active.isEmpty():
            break
        # of neighbours in a chain at most one goes: that with the highest priority
        salt = F.lit(len(raked))
        above = [F.xxhash64("node", salt) > F.xxhash64(other, salt) for other in ("parent", "kids_xor")]
        goes = (F.col("kids") == 1) & F.col("parent").isNotNull() & above[0] & above[1]
        going = active.where(goes)
        to_parent = going.select(
            F.col("parent").alias("target"), F.lit(0).alias("d_kids"), F.col("node").bitwiseXOR(F.col("kids_xor")).alias("d_xor"), none.alias("new_parent"),
            F.col("leaves").alias("d_leaves"), F.col("weight").alias("d_weight"))
        to_child = going.select(
            F.col("kids_xor").alias("target"), F.lit(0).alias("d_kids"), F.lit(0).cast("long").alias("d_xor"), F.col("parent").alias("new_parent"),
            F.lit(0).cast("long").alias("d_leaves"), F.lit(0).cast("long").alias("d_weight"))
        path, active = step(active.withColumn("removed", F.when(goes, F.lit(2))), to_parent.unionByName(to_child), "spliced")
        spliced.append(path)

    # back through the rounds: the child that stayed was removed in a later one
    totals: list[str] = []
    final = "node long, leaves long, weight long"

    def known(of_rounds: list[str]) -> DataFrame:
        found = spark.read.schema(schema).parquet(*of_rounds).where(F.col("removed") == 1).select("node", "leaves", "weight")
        return found.unionByName(spark.read.schema(final).parquet(*totals)) if totals else found

    for at in reversed(range(len(spliced))):
        gone = spark.read.schema(schema).parquet(spliced[at]).where(F.col("removed") == 2)
        if gone.isEmpty():
            continue
        child = known(raked[at + 1:]).select(F.col("node").alias("child"), F.col("leaves").alias("child_leaves"), F.col("weight").alias("child_weight"))
        path = scratch(spark, "expanded")
        (
            gone.join(child, F.col("kids_xor") == F.col("child"))
            .select("node", (F.col("leaves") + F.col("child_leaves")).alias("leaves"), (F.col("weight") + F.col("child_weight")).alias("weight"))
            .write.parquet(path)
        )
        totals.append(path)
    return known(raked)


def conversation_trie(conversations: DataFrame, block: int = 0, most: int = 1, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``: one row per distinct sequence of first ``depth`` turns (role and
    text), the root with depth 0 included.

    ``conv_id`` is the smallest id of a conversation that starts with the sequence,
    which with ``depth`` names the node, and ``parent_conv_id`` that of the sequence
    without its last turn (null at the root). ``n_convs`` counts the conversations
    that start with it. ``n_leaves`` counts the nodes without children in its
    subtree, and ``saved_tokens`` sums ``(n_convs - 1) * code points of the last text``
    there, both with the node itself. ``ends_sha256`` is the SHA-256 of the decimal
    ids, ascending, of the conversations that are the sequence. With ``block`` and
    ``most`` conversations first borrow their opening (:func:`with_openings`).

    Turns go by ``turn``, null first; equal ones by role and text, and repeated rows
    are as many turns. Null role or text counts as empty. Rows with a null id belong
    to no conversation and don't count. An empty table gives no rows, not even a
    root. Other columns are not read. Ids must be integers (else TypeError).
    """
    turns, convs = with_openings(ordered_turns(conversations, conv_id, turn, role, text), block, most)
    prefixes = _prefixes(turns, convs)
    same = [F.min(g) == F.max(g) for g in WORDS]
    checked = F.when(same[0] & same[1] & same[2] & same[3], F.count("*")).otherwise(F.raise_error(F.lit("different turns under one hash")).cast("long"))
    nodes = written(
        prefixes.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), checked.alias("n_convs"), F.max("chars").alias("chars"), F.max("t1").alias("t1"), F.max("t2").alias("t2"))
        .select(
            F.monotonically_increasing_id().alias("node"), *KEY, "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight"),
            F.col("x1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("t2")).alias("p2")),
        "trie-nodes")
    # a node with very many children is a hot key here; its children's side can be split
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = written(nodes.join(above, ["depth", "p1", "p2"], "left").select("node", "parent", *KEY, "conv_id", "parent_conv_id", "n_convs", "weight"), "trie-links")
    kids = (
        linked.where(F.col("parent").isNotNull()).select("parent", F.col("node").alias("kid")).groupBy("parent")
        .agg(F.count("*").alias("kids"), F.bit_xor("kid").alias("kids_xor")).withColumnRenamed("parent", "node")
    )
    zero = F.lit(0)
    tree = written(
        linked.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", zero)).withColumn("kids_xor", F.coalesce("kids_xor", zero)), "trie")
    found = tree.join(subtree_totals(tree).select("node", "leaves", F.col("weight").alias("saved")), "node").join(_ends(prefixes), KEY, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
